"""Draws with replacement over one whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions.uniform import position_below
from casemill.operators.positions import POSITION_COLUMNS, WHOLE, bucketed_line, find, group_scales, int_weight, lay_out, pool_totals, slotted, spread

TABLE_SPREAD_DIGITS = 3


def sum_duplicates(table: DataFrame, weight: str | None, identity: list[str]) -> DataFrame:
    """Identical rows become one row with the summed integer weight ``w``. A null weight counts as 1;
    a table without the weight column is uniform over its rows."""
    if weight is None or weight not in table.columns:
        mass = F.lit(1).cast("bigint")
    else:
        one = F.lit(1) if table.schema[weight].dataType.typeName() != "double" else F.lit(1.0)
        table = table.withColumn(weight, F.coalesce(F.col(weight), one))
        mass = int_weight(table, weight)
    return table.groupBy(*identity).agg(F.sum(mass).alias("w")).where("w > 0")


def _scaled_in_groups(table: DataFrame, weight: str, group: list[str], item: list[str]) -> DataFrame:
    rows = table.select(*group, *item, F.coalesce(F.col(weight).cast("double"), F.lit(1.0)).alias("w"))
    rows = rows.where((F.col("w") > 0) & (F.col("w") < float("inf"))).join(group_scales(rows, "w", group), group)
    whole = F.greatest(F.floor(F.col("w") * F.col("_scale")).cast("bigint"), F.lit(1).cast("bigint"))
    return rows.groupBy(*group, *item).agg(F.sum(whole).alias("w"))


def table_positions(profiles: DataFrame, order: list[str]) -> DataFrame:
    """Positions in a whole table taken as one pool; hash groups of the order key stand in for a global
    sort, so the only window over everything runs over their totals (16**3 rows at most)."""
    return lay_out(profiles, [], order, F.col("w"), spread(*order, digits=TABLE_SPREAD_DIGITS), distinct=True)


def keyed_positions(profiles: DataFrame, name: str, key: Column) -> DataFrame:
    """``table_positions`` in the order of ``key``, a text worked out from the row and added as ``name``: rows are dealt to
    their hash groups without it, so the text is not shuffled."""
    dealt = profiles.withColumn("grp", spread(key, digits=TABLE_SPREAD_DIGITS)).repartition("grp").withColumn(name, key)
    return lay_out(dealt, [], [name], F.col("w"), F.col("grp"), distinct=True)


def draw_rows(
    ids: DataFrame,
    id_col: str,
    positions: DataFrame,
    seed: int,
    salt: str = "profile",
    empty_message: str = "no row with a positive weight to draw from",
) -> DataFrame:
    """Weighted draw with replacement: one row of ``positions`` per id, which are written, or already cut into slots
    (``bucketed_line``). The table's total is read first; an empty table raises when the query runs."""
    whole = positions.where("lo = 0").select("total", "step").first()
    total, step = (F.lit(x).cast("bigint") for x in whole or (None, None))
    if whole is None:
        total = F.raise_error(F.lit(empty_message)).cast("bigint")
    take = [c for c in positions.columns if c not in ("grp", "w", "slot", *POSITION_COLUMNS)]
    slots = positions if "slot" in positions.columns else slotted(positions)
    return find(ids, slots, {}, position_below(total, seed, salt, id_col), step, {c: c for c in take}, id_col, large=True)


def draw_with_replacement(
    table: DataFrame, weight: str | None, identity: list[str], ids: DataFrame, id_col: str, seed: int, salt: str = "profile"
) -> DataFrame:
    positions = table_positions(sum_duplicates(table, weight, identity), identity)
    return draw_rows(ids, id_col, bucketed_line(positions, "table-positions"), seed, salt)


def draw_per_group(
    draws: DataFrame, id_col: str, table: DataFrame, weight: str | None, group: list[str], item: list[str], seed: int, salt: str = "in_group"
) -> DataFrame:
    """Weighted draw with replacement inside the draw's own group: a row of ``table`` among those with the same values
    in ``group``, null where there is none. Adds the columns of ``item``. Fractions are scaled group by group, so a group
    keeps its own shares however small its weights are beside another's."""
    table = table.dropna(subset=group)
    if weight in table.columns and table.schema[weight].dataType.typeName() not in WHOLE:
        rows = _scaled_in_groups(table, weight, group, item)
    else:
        rows = sum_duplicates(table, weight, [*group, *item])
    positions = lay_out(rows, group, item, F.col("w"), distinct=True)
    totals = pool_totals(positions, group).select(*group, F.col("total").alias("group_total"), F.col("step").alias("group_step"))
    asked = draws.join(totals, group, "left")
    at = position_below(F.col("group_total"), seed, salt, id_col)
    slots = slotted(positions.select(*group, *item, "lo", "hi", "step"))
    drawn = find(asked, slots, {name: F.col(name) for name in group}, at, F.col("group_step"), {name: name for name in item}, id_col, large=True)
    return drawn.drop("group_total", "group_step")


def stay_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "stay_id")
