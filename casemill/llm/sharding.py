"""Shards with equal row counts that keep linked documents together, by balanced label propagation.

Documents with equal texts are linked. Every linked document starts in the shard of its key's hash. In each round a
group asks to move its documents from each shard to the one that holds most of its own and has room; a shard grants
requests up to its quota and a little more. Rounds end when none is granted. Documents of one group in one shard are
alike, so the rounds run on their counts: one row per group and shard. The few groups that are large beside a shard are
gathered first, in part where a shard is full. In the end what a shard holds beyond its quota and the documents without
links fill every shard up to its quota, so counts are at most one apart whatever the groups. A group larger than a shard fills as few shards as the rounds find.

The size is the text's UTF-8 bytes plus 8; a null text has none, and is linked with empty texts. Null keys are a key like
others. Repeated rows are linked documents. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.sources.scratch import written

SHARDS, ROUNDS = 24, 12
#: Parts of a group that are numbered apart, and buckets in which unlinked documents and cells are.
SALTS, BUCKETS = 64, 1024
#: A group with more than this part of a quota is large; there are at most shards * LARGE of them.
LARGE = 64
#: Share of a quota that linked documents may be above it during the rounds.
SLACK = 0.1


def _lookup(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), at)


def _before(values: list[int]) -> list[int]:
    total, out = 0, []
    for value in values:
        out.append(total)
        total += value
    return out


def _sizes(cells: DataFrame, shards: int) -> list[int]:
    found = {row.shard: row.n for row in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row per shard
    return [found.get(s, 0) for s in range(shards)]


def _gather(cells: dict[int, int], free: list[int]) -> dict[int, int]:
    """One very large group: its smallest cells move to its fullest shards with room, while they gain by it."""
    cells = dict(cells)
    while True:
        targets = sorted((s for s in cells if free[s] > 0), key=lambda s: (-cells[s], s))
        sources = sorted(cells, key=lambda s: (cells[s], -s))
        if not targets or sources[0] == targets[0]:
            sources = [s for s in sources if s not in targets[:1]]
        if not targets or not sources or cells[sources[0]] > cells[targets[0]]:
            return cells
        source, target = sources[0], targets[0]
        moved = min(cells[source], free[target])
        free[source] += moved
        free[target] -= moved
        cells[target] += moved
        cells[source] -= moved
        if not cells[source]:
            del cells[source]


def propagate(cells: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(``grp``, ``shard``, ``n``) after the rounds; ``n`` documents of the group are in the shard."""
    spark, shards = cells.sparkSession, len(quotas)
    limits = [int(q * (1 + SLACK)) for q in quotas]
    large = max(min(quotas) // LARGE, 1)
    many = cells.groupBy("grp").agg(F.sum("n").alias("all")).where(F.col("all") > large)
    groups: dict[bytes, dict[int, int]] = {}
    for row in cells.join(many, "grp").orderBy(F.desc("all"), "grp", "shard").collect():  # shards * shards * LARGE rows at most
        groups.setdefault(bytes(row.grp), {})[row.shard] = row.n
    free = [limit - n for limit, n in zip(limits, _sizes(cells, shards))]
    gathered = [(grp, shard, n) for grp, own in groups.items() for shard, n in _gather(own, free).items()]
    settled = spark.createDataFrame(gathered, cells.schema)
    cells = written(cells.join(many, "grp", "left_anti").select("grp", "shard", "n"), "shard-cells")
    for _ in range(rounds):
        now = [a + b for a, b in zip(_sizes(cells, shards), _sizes(settled, shards))]
        free = [max(limit - n, 0) for limit, n in zip(limits, now)]
        room = _lookup(free, F.col("shard")) > 0
        rank = F.struct("n", F.xxhash64("grp", "shard").alias("tie"), "shard")
        best = F.max(F.when(room, rank)).over(Window.partitionBy("grp"))  # at most a row per shard in each window
        asked = cells.withColumn("best", best).where(rank < F.col("best")).select("grp", "shard", "n", F.col("best.shard").alias("target"))
        asked = written(asked.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(BUCKETS))), "shard-requests")
        granted, shut = [0] * shards, [False] * shards
        for row in asked.groupBy("target", "bucket").agg(F.sum("n").alias("n")).orderBy("target", "bucket").collect():  # shards * BUCKETS rows
            shut[row.target] |= row.n > free[row.target]
            if not shut[row.target]:
                free[row.target] -= row.n
                granted[row.target] = row.bucket + 1
        if not any(granted):
            break
        moves = asked.where(F.col("bucket") < _lookup(granted, F.col("target")))
        gone = moves.select("grp", "shard", (-F.col("n")).alias("n"))
        come = moves.select("grp", F.col("target").alias("shard"), "n")
        cells = written(cells.unionByName(gone).unionByName(come).groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-cells")
    return cells.unionByName(settled)


def sharded(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    whole = F.coalesce(documents[text], F.lit(""))
    rows = documents.select(
        documents[key].alias("key"),
        (F.coalesce(F.octet_length(documents[text]), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(whole)).alias("grp"),
    )
    mixed = F.xxhash64("key", "grp")
    rows = written(rows.withColumns({"salt": F.pmod(mixed, F.lit(SALTS)).cast("int"), "bucket": F.pmod(F.shiftright(mixed, 16), F.lit(BUCKETS)).cast("int"), "start": F.pmod(F.shiftright(mixed, 32), F.lit(shards)).cast("int")}), "shard-rows")

    counted = written(rows.groupBy("grp", "salt", "start").agg(F.count("*").alias("n")), "shard-counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    linked = counted.groupBy("grp").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("grp")
    parts = written(counted.join(linked, "grp"), "shard-linked")
    cells = propagate(parts.groupBy("grp", F.col("start").alias("shard")).agg(F.sum("n").alias("n")), quotas, rounds)

    # Slots: cells one after the other in their shard, by bucket of the group.
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(BUCKETS)))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows in each
    by_bucket = cells.groupBy("shard", "bucket").agg(F.sum("n").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    of_group = Window.partitionBy("grp").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    cells = cells.join(F.broadcast(by_bucket), ["shard", "bucket"])  # shards * BUCKETS rows
    cells = cells.select("grp", "shard", "n", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("slot"), F.coalesce(F.sum("n").over(of_group), F.lit(0)).alias("from"))
    cells = written(cells, "shard-slots")
    sizes = _sizes(cells, shards)
    plan = cells.groupBy("grp").agg(F.collect_list(F.struct("from", "n", "shard", "slot")).alias("cells"))  # a row per shard
    by_salt = Window.partitionBy("grp").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # SALTS rows
    salts = parts.groupBy("grp", "salt").agg(F.sum("n").alias("n")).select("grp", "salt", F.coalesce(F.sum("n").over(by_salt), F.lit(0)).alias("first"))
    plan = salts.join(plan, "grp")

    # Numbers: linked documents inside their part of the group, the others inside their bucket.
    rows = rows.join(plan, ["grp", "salt"], "left")
    alone = F.col("cells").isNull()
    together = Window.partitionBy(F.when(alone, F.col("bucket")), F.when(~alone, F.col("grp")), F.when(~alone, F.col("salt"))).orderBy("key", "grp", "size")
    rank = F.col("first") + F.col("number")
    cell = F.filter("cells", lambda c: (c["from"] <= rank) & (rank < c["from"] + c["n"]))[0]
    rows = rows.withColumn("number", (F.row_number().over(together) - 1).cast("long")).withColumn("cell", cell)
    rows = written(
        rows.select("key", "size", "text_crc32", F.when(alone, F.col("bucket")).alias("bucket"), "number", F.col("cell.shard").alias("shard"), (F.col("cell.slot") + rank - F.col("cell.from")).alias("slot")),
        "shard-numbers",
    )

    # Places: what a shard holds beyond its quota, then the unlinked documents, fill what is left of each.
    excess = [max(n - q, 0) for n, q in zip(sizes, quotas)]
    starts = _before([max(q - n, 0) for n, q in zip(sizes, quotas)])
    so_far = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows
    offsets = rows.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", (F.coalesce(F.sum("n").over(so_far), F.lit(0)) + sum(excess)).alias("offset"))
    rows = rows.join(F.broadcast(offsets), "bucket", "left")
    stays = F.col("slot") < _lookup(quotas, F.col("shard"))
    order = F.when(F.col("bucket").isNotNull(), F.col("offset") + F.col("number")).when(~stays, _lookup(_before(excess), F.col("shard")) + F.col("slot") - _lookup(quotas, F.col("shard")))
    rows = rows.withColumn("order", order)
    to = F.size(F.filter(F.array(*[F.lit(int(v)).cast("long") for v in starts]), lambda v: v <= F.col("order"))) - 1
    rows = rows.withColumn("to", F.when(F.col("order").isNotNull(), to))
    held = [min(n, q) for n, q in zip(sizes, quotas)]
    return rows.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.coalesce("to", "shard").cast("int").alias("shard"),
        F.coalesce(F.col("order") - _lookup(starts, F.col("to")) + _lookup(held, F.col("to")), F.col("slot")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
