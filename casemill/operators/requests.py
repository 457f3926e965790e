"""Many draws at once: a table of narrow requests, all first picks in one lookup, all second picks in another.

A request is one draw without replacement that a row wants from a pool: its key, the stage (the salt of its decisions), the
pool with its facts, and how many items it wants. Requests of all stages go through the same position table, so the number
of lookups is that of the picks, not of the stages, and what travels is a few numbers instead of the rows that ask. The
answers come back as one map per key, from stage to the items drawn, in order.

Every position is what ``draw_some`` gives for the stage: the same decisions, the same spans left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.uniform import position_below
from casemill.operators.positions import find, no_spans, skip_taken, span, taken_length

#: What a position table for requests has beside pool, slot, salt, lo, hi: the item's group and unit.
EDGES = ["g_lo", "g_hi", "unit"]


def request(stage: str, facts: Column, wanted: Column, by_group: bool = False) -> Column:
    """A request of ``wanted`` items (null or less than 1: none) from the pool of ``facts`` (pool, total, step, salts).
    ``by_group``: each pick also closes its group."""
    parts = {"stage": F.lit(stage), "facts": facts, "wanted": wanted.cast("int"), "by_group": F.lit(by_group)}
    return F.struct(*[value.alias(name) for name, value in parts.items()])


def asked(rows: DataFrame, key: str, requests: list[Column]) -> DataFrame:
    """One row per request that wants something."""
    names = [f"request_{i}" for i in range(len(requests))]
    named = rows.select(key, *[r.alias(name) for name, r in zip(names, requests)])
    wanting = named.select(key, F.inline(F.array(*names))).where("wanted >= 1 AND facts.total > 0")
    return wanting.select(key, "stage", "facts.pool", "facts.total", "facts.step", "facts.salts", "wanted", "by_group")


def answers(requests: DataFrame, key: str, slots: DataFrame, picks: int, fields: list[str], seed: int) -> DataFrame:
    """(``key``, ``answers``: map from stage to its items, structs of ``fields``) for the rows of ``asked``."""
    out = requests.withColumn("taken", no_spans())
    for pick in range(1, picks + 1):
        free = F.col("total") - taken_length(F.col("taken"))
        at = position_below(free, seed, F.concat("stage", F.lit(f"_{pick}")), key)
        out = out.withColumn("at", F.when(F.col("wanted") >= pick, skip_taken(at, F.col("taken"))))
        take = {f"{name}_{pick}": name for name in fields}
        edges = {"lo": "lo", **{name: name for name in EDGES}} if pick < picks else {}
        out = find(out, slots, {"pool": F.col("pool")}, F.col("at"), F.col("step"), {**take, **edges}, key, large=True, salts=F.col("salts"))
        item = F.struct(*[F.col(f"{name}_{pick}").alias(name) for name in fields])
        out = out.withColumn(f"item_{pick}", F.when(F.col("at").isNotNull(), item)).drop(*take)
        if pick < picks:
            start = F.col("lo") + F.call_function("div", F.col("at") - F.col("lo"), F.col("unit")) * F.col("unit")
            closed = F.when(F.col("by_group"), span("g_lo", "g_hi")).otherwise(span(start, start + F.col("unit")))
            out = out.withColumn("taken", F.when(F.col("at").isNotNull(), F.concat("taken", F.array(closed))).otherwise(F.col("taken"))).drop(*edges)
    items = F.array_compact(F.array(*[F.col(f"item_{pick}") for pick in range(1, picks + 1)]))
    entry = F.collect_list(F.struct("stage", items.alias("items")))  # an entry per stage
    return out.groupBy(key).agg(F.map_from_entries(entry).alias("answers"))
