"""Procedure draws: the finest non-empty level of a cascade, its five heaviest codes, a few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.functions.text import display, parent_code
from casemill.functions.uniform import as_column, uniform, uniform_int
from casemill.operators.positions import int_weight

TOP = 5


def is_surgical(ghm5: Column | str) -> Column:
    """C or K anywhere in the group code."""
    return as_column(ghm5).rlike("[CK]")


def level_pools(ccam: DataFrame, surgical_only: bool = True) -> list[tuple[list[str], DataFrame]]:
    """Weight per procedure at each level: (GHM5, DP), (GHM5, first three letters of DP), (GHM5)."""
    ccam = ccam.where(is_surgical("GHM5")) if surgical_only else ccam
    base = (
        ccam.withColumn("w", int_weight(ccam, "P_CCAM"))
        .where("w > 0 and CCAM is not null")
        .groupBy("GHM5", "DP", "CCAM")
        .agg(F.sum("w").alias("w"))
        .withColumn("DP3", parent_code("DP"))
    )
    levels = []
    for key in (["GHM5", "DP"], ["GHM5", "DP3"], ["GHM5"]):
        pool = base if key == ["GHM5", "DP"] else base.groupBy(*key, "CCAM").agg(F.sum("w").alias("w"))
        levels.append((key, pool.dropna(subset=key).select(*key, "CCAM", "w")))
    return levels


def heaviest(pool: DataFrame, key: list[str], top: int = TOP) -> DataFrame:
    """The ``top`` heaviest codes of each pool; equal weights go by code. Spark limits each task's rows
    per pool before the shuffle, so a hot pool sends a handful of rows."""
    order = Window.partitionBy(*key).orderBy(F.desc("w"), "CCAM")
    return pool.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def attach_procedure_pools(profiles: DataFrame, ccam: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``ccam_pool``: at most five (code, weight, display) of the first level that has any."""
    out = profiles.withColumn("DP3", parent_code("DP"))
    names = []
    active = labels.select(F.col("code").alias("CCAM"), F.col("label").alias("ccam_label"))
    for number, (key, pool) in enumerate(level_pools(ccam), start=1):
        entry = F.struct("rank", F.col("CCAM").alias("code"), "w", display("ccam_label", "CCAM").alias("shown"))
        arrays = (
            heaviest(pool, key)
            .join(active, "CCAM", "left")
            .groupBy(*key)
            .agg(F.array_sort(F.collect_list(entry)).alias(f"ccam_pool_{number}"))
        )
        out = out.join(arrays.hint("merge"), key, "left")
        names.append(f"ccam_pool_{number}")
    chosen = F.when(is_surgical("GHM5"), F.coalesce(*names))
    level = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(i)) for i, n in enumerate(names, start=1)])
    return out.withColumns({"ccam_pool": chosen, "ccam_level": F.when(is_surgical("GHM5"), level)}).drop("DP3", *names)


def drawn_procedures(seed: int, id_col: str, n_ccam: int, field: str = "shown") -> Column:
    """Between 1 and ``n_ccam`` codes of ``ccam_pool`` without replacement: ordering by the exponential
    key -ln(u)/w is the same as drawing by weight one after the other. At most five entries per row."""
    wanted = uniform_int(uniform(seed, "ccam_count", id_col), 1, n_ccam).cast("int")
    keyed = F.transform(
        F.col("ccam_pool"),
        lambda x: F.struct(
            (-F.log(uniform(seed, "ccam", F.col(id_col), x["code"])) / x["w"]).alias("key"),
            x["code"].alias("code"),
            x["shown"].alias("shown"),
        ),
    )
    picked = F.slice(F.array_sort(keyed), 1, wanted)
    empty = F.array().cast("array<string>")
    return F.when(F.col("ccam_pool").isNull(), empty).otherwise(F.transform(picked, lambda x: x[field]))
