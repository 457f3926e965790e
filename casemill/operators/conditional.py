"""Draws from the rows of a table that agree with a profile, where a missing profile value agrees with any.

Each set of columns a profile may leave open has pools of its own; only the sets that occur are built.
A profile then names its pool by a key, so the match is an equality and a draw is a position lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.uniform import position_below, uniform, uniform_int
from casemill.operators.positions import find, no_spans, salted, skip_taken, slotted, span, taken_length
from casemill.sources.scratch import written

ANY = "*"


def shared_columns(names: list[str], *frames: DataFrame) -> list[str]:
    """Those of ``names`` that every frame has."""
    return [n for n in names if all(n in frame.columns for frame in frames)]


def open_mask(columns: list[str]) -> Column:
    """Bit i is set where column i of the profile is missing."""
    mask = F.lit(0)
    for i, name in enumerate(columns):
        mask = mask + F.when(F.col(name).isNull(), 1 << i).otherwise(0)
    return mask


def profile_pool(kind: Column | str, columns: list[str]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat_ws("|", kind, *[F.coalesce(F.col(c).cast("string"), F.lit(ANY)) for c in columns])


def masks_in_use(columns: list[str], profiles: DataFrame) -> list[int]:
    """The sets of open columns that profiles have, at most 2**len(columns) numbers; fewer open columns first."""
    found = profiles.agg(F.collect_set(open_mask(columns)).alias("masks")).first()["masks"]
    return sorted(found, key=lambda mask: (mask.bit_count(), mask))


def pool_lattice(rows: DataFrame, columns: list[str], item: list[str], masks: list[int]) -> dict[int, DataFrame]:
    """For each mask the number of ``rows`` per item and value of the columns that it leaves closed. A mask is added up
    from the mask in use that opens most of its columns, not from the rows again, so no level has more rows than the
    level it comes from. The finest level is written, as the others come from it."""
    levels = {0: written(rows.groupBy(*columns, *item).agg(F.sum("rows").alias("rows")), "pooled-rows")}
    for mask in masks:
        if mask:
            finer = max((known for known in levels if known & mask == known), key=lambda known: (known.bit_count(), known))
            closed = [name for i, name in enumerate(columns) if not mask >> i & 1]
            levels[mask] = levels[finer].groupBy(*closed, *item).agg(F.sum("rows").alias("rows"))
    return {mask: levels[mask] for mask in masks}


def pooled_rows(rows: DataFrame, kinds: Column, columns: list[str], profiles: DataFrame, item: list[str]) -> DataFrame:
    """(``pool``, ``item``, ``rows``): each item once per kind and per set of open columns in use. A row with a missing
    value in a compared column agrees with no profile there."""
    masks = masks_in_use(columns, profiles)
    rows = rows.withColumn("kind", F.explode(kinds)).select(*columns, "kind", *item, "rows")
    lattice = pool_lattice(rows, columns, ["kind", *item], masks)
    every = None
    for mask, level in lattice.items():
        parts = [F.lit(ANY) if mask >> i & 1 else F.col(name).cast("string") for i, name in enumerate(columns)]
        pool = F.concat("kind", *[piece for part in parts for piece in (F.lit("|"), part)])
        named = level.select(pool.alias("pool"), *item, "rows").where("pool is not null")
        every = named if every is None else every.unionByName(named)
    return every if every is not None else rows.select(F.lit("").alias("pool"), *item, "rows").limit(0)


def wanted_count(seed: int, salt: str, id_col: str, copies: Column, max_nb: int = 2) -> Column:
    """Uniform in [0, min(rows in the pool, max_nb)]; null without a pool."""
    top = F.least(copies, F.lit(max_nb).cast("bigint"))
    return F.when(copies > 0, uniform_int(uniform(seed, f"{salt}_count", id_col), 0, top))


def draw_some(
    stays: DataFrame,
    id_col: str,
    positions: DataFrame,
    pool: Column,
    facts: Column,
    wanted: Column,
    picks: int,
    take: dict[str, str],
    salt: str,
    seed: int,
    distinct_groups: bool = False,
    large: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Draw up to ``wanted`` (at most ``picks``) rows of a pool without replacement.

    ``facts`` is the struct (total, step) of the stay's pool, with its salts where ``hot`` lists hot pools or ``positions`` are
    salted slots already (``bucketed_slots``). With ``distinct_groups`` each pick also
    closes its group, so every row comes from another one. Adds ``{salt}_{name}_{pick}`` for each name
    in ``take``.
    """
    bounds = {"lo": "g_lo", "hi": "g_hi"} if distinct_groups else {"lo": "lo", "unit": "unit"}
    cut = "slot" in positions.columns
    rows = positions.select(*dict.fromkeys(["pool", "lo", "hi", "step", *(["slot", "salt"] if cut else []), *bounds.values(), *take.values()]))
    slots = rows if cut else slotted(rows if hot is None else salted(rows, hot))
    salts = facts["salts"] if cut or hot is not None else None
    out = stays.withColumn(f"{salt}_taken", no_spans())
    for pick in range(1, picks + 1):
        taken = F.col(f"{salt}_taken")
        free = facts["total"]
        if pick > 1:
            out = out.withColumn(f"{salt}_free", free - taken_length(taken))
            free = F.col(f"{salt}_free")
        short = F.when(wanted >= pick, position_below(free, seed, f"{salt}_{pick}", id_col))
        out = out.withColumn(f"{salt}_at", short)
        if pick > 1:
            out = out.withColumn(f"{salt}_at", skip_taken(F.col(f"{salt}_at"), taken))
        names = {f"{salt}_{name}_{pick}": source for name, source in take.items()}
        edges = {f"{salt}_{edge}": source for edge, source in bounds.items()} if pick < picks else {}
        out = find(out, slots, {"pool": pool}, F.col(f"{salt}_at"), facts["step"], {**names, **edges}, id_col, large, salts)
        if pick < picks:
            if distinct_groups:
                closed = span(f"{salt}_lo", f"{salt}_hi")
            else:
                row = F.call_function("div", F.col(f"{salt}_at") - F.col(f"{salt}_lo"), F.col(f"{salt}_unit"))
                start = F.col(f"{salt}_lo") + row * F.col(f"{salt}_unit")
                closed = span(start, start + F.col(f"{salt}_unit"))
            grown = F.when(F.col(f"{salt}_at").isNotNull(), F.concat(taken, F.array(closed))).otherwise(taken)
            out = out.withColumn(f"{salt}_taken", grown).drop(*edges)
    return out.drop(f"{salt}_taken", f"{salt}_at", f"{salt}_free")
