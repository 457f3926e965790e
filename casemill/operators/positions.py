"""Position layout: the primitive behind every draw.

A pool of weighted items is laid out on the integer line: each item owns the interval [lo, hi) whose
length is its weight, and items of one group (an ICD category, a chapter) lie side by side. Drawing an
item is then looking up the interval that holds an integer position, and leaving out what is already
taken is a shift of that position past the taken intervals (``skip_taken``). No draw ever meets the
whole pool, so the cost of a draw does not grow with the pool.

Two steps keep hot pools distributed. Rows are pre-aggregated to distinct items before any shuffle, and
running sums are taken inside (pool, group) and then over the group totals, so one pool is spread over
as many tasks as it has groups. The lookup is an equi-join on (pool, slot), where a slot is a fixed
stretch of the line: a pool has about as many slots as items, so each position meets about two items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.functions.uniform import as_column, key_hash
from casemill.sources.scratch import written_in_buckets

#: Bits of a table's total mass on the integer line.
MASS_BITS = 61
WHOLE = ("byte", "short", "integer", "long")
MIN_SLOTS = 64
HOT_SHARE = 1024
SALTED_SLOTS = 256


def mass_scale(df: DataFrame, name: str) -> Column:
    """A power of two that brings the sum of the finite positive weights of ``df`` just below 2**MASS_BITS. The sum is
    bounded from the numbers of weights between powers of two, added in their order, so it is the same on every run. The
    column is read once, before the query that uses the scale, by a count of at most 2 100 groups, 64 for whole numbers. The
    query then holds a number, not the rows' lineage once more."""
    weight = F.col(name).cast("double")
    power = F.floor(F.log2(weight)).cast("int")
    rows = df.select(name).where((weight > 0) & (weight < float("inf")))
    bins = sorted((row["e"], row["n"]) for row in rows.groupBy(power.alias("e")).agg(F.count(F.lit(1)).alias("n")).collect())
    bound = 0.0
    for e, n in bins:
        bound += n * 2.0 ** (e + 1)
    return F.pow(F.lit(2.0), F.lit(MASS_BITS) - F.ceil(F.log2(F.lit(bound))))


def group_scales(df: DataFrame, name: str, group: list[str]) -> DataFrame:
    """``mass_scale`` of each group by itself: one row per group with ``_scale``. The numbers of weights between powers of
    two are counted before they are shuffled, at most 2 100 a group, and added in the order of the powers."""
    weight = F.col(name).cast("double")
    rows = df.where((weight > 0) & (weight < float("inf")))
    bins = rows.groupBy(*group, F.floor(F.log2(weight)).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("n"))
    ordered = bins.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("e", "n"))).alias("bins"))
    bound = F.aggregate("bins", F.lit(0.0), lambda total, b: total + b["n"] * F.pow(F.lit(2.0), b["e"] + 1))
    return ordered.select(*group, F.pow(F.lit(2.0), F.lit(MASS_BITS) - F.ceil(F.log2(bound))).alias("_scale"))


def int_weight(df: DataFrame, name: str) -> Column:
    """Integer weight. Fractions and very large weights are scaled by one power of two for the whole table, so shares
    stay as they are down to 2**-MASS_BITS of the table; a positive weight never becomes zero. Integers whose sum
    fits are taken as they are. Null, NaN, infinite and negative weights are zero."""
    kind = df.schema[name].dataType.typeName()
    weight, scale = F.col(name).cast("double"), F.coalesce(mass_scale(df, name), F.lit(1.0))
    whole = kind in WHOLE
    scaled = F.greatest(F.floor(weight * (F.least(scale, F.lit(1.0)) if whole else scale)).cast("bigint"), F.lit(1).cast("bigint"))
    if whole:
        scaled = F.when(scale >= 1, F.col(name).cast("bigint")).otherwise(scaled)
    return F.when((weight > 0) & (weight < float("inf")), scaled).otherwise(F.lit(0).cast("bigint"))


def spread(*items: Column | str, digits: int = 2) -> Column:
    """Hash group of an item: 16**digits groups, the same on every run and partitioning."""
    return F.substring(key_hash(*items), 1, digits)


POSITION_COLUMNS = ["lo", "hi", "g_lo", "g_hi", "total", "copies", "n_groups", "step"]


def lay_out(
    rows: DataFrame,
    key: list[str],
    item: list[str],
    weight: Column,
    group: Column | None = None,
    copies: Column | None = None,
    distinct: bool = False,
    nomenclature: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Lay the positive-weight rows of each pool out on the integer line, ordered by (group, item).

    Adds ``lo, hi`` (the item's interval), ``g_lo, g_hi`` (its group's), and the pool's ``total``,
    ``copies``, ``n_groups`` and slot width ``step``.

    ``distinct=True``: (key, item) is already unique; rows then keep all their other columns and the
    aggregation is left out. ``nomenclature=True``: items are codes of a fixed nomenclature, so a pool of
    distinct items has a bounded size and one window per pool will do; otherwise a pool is split by group.
    ``keep`` names columns that the key determines.
    """
    group = group if group is not None else spread(*item)
    copies = copies if copies is not None else F.lit(1).cast("bigint")
    rows = rows.withColumns({"grp": group, "w": weight, "copies": copies}).where("w > 0")
    if key:
        rows = rows.dropna(subset=key)
    if not distinct:
        rows = rows.groupBy(*key, *keep, "grp", *item).agg(F.sum("w").alias("w"), F.sum("copies").alias("copies"))
    rows = _one_window(rows, key, item) if nomenclature else _by_group(rows, key, item)
    slots = F.greatest(F.col("n_items"), F.least(F.col("total"), F.lit(MIN_SLOTS)))
    step = F.greatest(F.lit(1).cast("bigint"), F.call_function("div", "total", slots))
    return rows.withColumn("step", step).drop("n_items")


def _one_window(rows: DataFrame, key: list[str], item: list[str]) -> DataFrame:
    running = Window.partitionBy(*key).orderBy("grp", *item).rowsBetween(Window.unboundedPreceding, 0)
    in_group, in_pool = Window.partitionBy(*key, "grp"), Window.partitionBy(*key)
    opens = F.when(F.col("lo") == F.col("g_lo"), 1).otherwise(0).cast("bigint")
    return (
        rows.withColumn("hi", F.sum("w").over(running))
        .withColumn("lo", F.col("hi") - F.col("w"))
        .withColumns({"g_lo": F.min("lo").over(in_group), "g_hi": F.max("hi").over(in_group)})
        .withColumns(
            {
                "total": F.sum("w").over(in_pool),
                "copies": F.sum("copies").over(in_pool),
                "n_items": F.count(F.lit(1)).over(in_pool),
                "n_groups": F.sum(opens).over(in_pool),
            }
        )
    )


def _by_group(rows: DataFrame, key: list[str], item: list[str]) -> DataFrame:
    within = Window.partitionBy(*key, "grp").orderBy(*item).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end_in_group", F.sum("w").over(within))
    groups = rows.groupBy(*key, "grp").agg(
        F.sum("w").alias("g_w"), F.count(F.lit(1)).alias("g_items"), F.sum("copies").alias("g_copies")
    )
    ordered = Window.partitionBy(*key).orderBy("grp")
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    groups = groups.select(
        *key,
        "grp",
        (F.sum("g_w").over(running) - F.col("g_w")).alias("g_lo"),
        F.sum("g_w").over(running).alias("g_hi"),
        F.sum("g_w").over(whole).alias("total"),
        F.sum("g_copies").over(whole).alias("copies"),
        F.sum("g_items").over(whole).alias("n_items"),
        F.count(F.lit(1)).over(whole).alias("n_groups"),
    )
    return (
        rows.drop("copies")
        .join(groups, [*key, "grp"])
        .withColumn("hi", F.col("g_lo") + F.col("end_in_group"))
        .withColumn("lo", F.col("hi") - F.col("w"))
        .drop("end_in_group")
    )


def pool_totals(positions: DataFrame, key: list[str]) -> DataFrame:
    """One row per pool: ``total, copies, n_groups, step``."""
    return positions.where("lo = 0").select(*key, "total", "copies", "n_groups", "step")


def pool_groups(positions: DataFrame, key: list[str], *also: str) -> DataFrame:
    """One row per (pool, group): its span, and the pool's number of groups."""
    return positions.where("lo = g_lo").select(*key, *also, "grp", "g_lo", "g_hi", "n_groups")


def hot_pools(asked: DataFrame, totals: DataFrame) -> DataFrame:
    """pool, salts: pools that a large share of the table's mass asks for but that have few slots.

    ``asked`` has pool, w and table_total, one row per profile and pool. At most HOT_SHARE pools of each
    kind can be hot, so the result is small whatever the input. With its salts a hot pool has about
    SALTED_SLOTS places that draws spread over.
    """
    mass = asked.groupBy("pool").agg(F.sum("w").alias("asked_w"), F.max("table_total").alias("table_total"))
    hot = mass.where(F.col("asked_w") > F.call_function("div", F.col("table_total"), F.lit(HOT_SHARE).cast("bigint")))
    slots = F.ceil(F.col("total") / F.col("step"))
    salts = F.ceil(F.lit(SALTED_SLOTS) / slots).cast("int")
    return totals.join(F.broadcast(hot), "pool").select("pool", salts.alias("salts")).where("salts > 1")


def salted(positions: DataFrame, hot: DataFrame) -> DataFrame:
    """Positions with the number of ``salts`` of their pool, 1 for most."""
    return positions.join(F.broadcast(hot), "pool", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))


def slotted(rows: DataFrame) -> DataFrame:
    """One row per slot that an item's interval touches, and per salt of the pool."""
    first, last = (F.call_function("div", F.expr(edge), F.col("step")) for edge in ("lo", "hi - 1"))
    rows = rows.withColumn("slot", F.explode(F.sequence(first, last)))
    if "salts" in rows.columns:
        rows = rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return rows


PLACE = ["pool", "slot", "salt"]


def bucketed_slots(positions: DataFrame, hot: DataFrame, purpose: str) -> DataFrame:
    """The slots of all pools, written in buckets by the columns a lookup joins on: no pick shuffles them again."""
    slots = slotted(salted(positions, hot)).withColumn("salt", F.col("salt").cast("bigint")).drop("salts")
    return written_in_buckets(slots, purpose, PLACE)


def bucketed_line(positions: DataFrame, purpose: str) -> DataFrame:
    """``bucketed_slots`` of a whole table that is one pool."""
    return written_in_buckets(slotted(positions), purpose, ["slot"])


def uncut(slots: DataFrame) -> DataFrame:
    """The positions that ``slots`` were cut from, each once."""
    return slots.where(F.col("slot") == F.call_function("div", "lo", "step")).drop("slot")


def find(
    draws: DataFrame,
    pool_rows: DataFrame,
    key: dict[str, Column],
    position: Column,
    step: Column,
    take: dict[str, str],
    spread_on: str,
    large: bool = False,
    salts: Column | None = None,
) -> DataFrame:
    """Attach to each draw the item that holds ``position``; null columns where position is null.

    ``key`` maps a pool key column to the draw's value, ``take`` maps an output name to a pool column.
    Draws that look nothing up get a slot of their own below zero, so they neither match nor crowd
    into one task. ``large`` marks pool rows that grow with the input: compressed files look smaller than
    the rows they hold, so these are joined by sorting and never broadcast; other pools are broadcast
    only if Spark finds them small enough. ``salts`` is the number of salts of the draw's pool.
    """
    idle = -1 - F.pmod(F.xxhash64(spread_on), F.lit(4096))
    draws = draws.withColumn("at_position", position)
    picked = pool_rows.select(
        *[F.col(name).alias(f"in_{name}") for name in key],
        F.col("slot").alias("in_slot"),
        F.col("lo").alias("in_lo"),
        F.col("hi").alias("in_hi"),
        *([] if salts is None else [F.col("salt").alias("in_salt")]),
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    if large:
        picked = picked.hint("merge")
    same = F.coalesce(F.call_function("div", "at_position", step), idle) == F.col("in_slot")
    for name, value in key.items():
        same = same & (value == F.col(f"in_{name}"))
    same = same & (F.col("at_position") >= F.col("in_lo")) & (F.col("at_position") < F.col("in_hi"))
    if salts is not None:
        own = F.pmod(F.xxhash64(F.lit("salt"), spread_on), F.coalesce(salts, F.lit(1)))
        same = same & (own == F.col("in_salt"))
    gone = ["at_position", "in_slot", "in_salt", "in_lo", "in_hi", *[f"in_{name}" for name in key]]
    return draws.join(picked, same, "left").drop(*gone)


def taken_length(taken: Column) -> Column:
    return F.aggregate(taken, F.lit(0).cast("bigint"), lambda total, span: total + span["hi"] - span["lo"])


def skip_taken(position: Column, taken: Column) -> Column:
    """Map a position on the line without the taken spans back to the full line; null stays null."""
    return F.aggregate(
        F.sort_array(taken),
        position,
        lambda at, span: F.when(at >= span["lo"], at + span["hi"] - span["lo"]).otherwise(at),
    )


def span(lo: Column | str, hi: Column | str) -> Column:
    return F.struct(as_column(lo).cast("bigint").alias("lo"), as_column(hi).cast("bigint").alias("hi"))


def no_spans() -> Column:
    return F.array().cast("array<struct<lo:bigint,hi:bigint>>")
