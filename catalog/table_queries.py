"""Queries of the table cohort over the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.functions.uniform import uniform
from casemill.operators.associated import draw_associated
from casemill.operators.draws import draw_per_group, draw_rows, draw_with_replacement
from casemill.operators.procedures import drawn_procedures
from casemill.operators.splits import draw_many
from casemill.operators.stay_length import triangular_days
from casemill.plans import table_cohort
from casemill.sources.scratch import written
from casemill.standins import view, views
from catalog.sql import SEED

INPUTS = {"dp": "pmsi_dp", "das": "pmsi_das", "ccam": "pmsi_ccam", "dms": "pmsi_dms", "rghm": "rghm", "cim10": "cim10", "ccam_ref": "ccam_ref"}

_PREPARED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(zip(INPUTS, views(spark, sf_dir, list(INPUTS.values())).values()))


def prepared(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _PREPARED:
        _PREPARED[slot] = table_cohort.prepare(tables(spark, sf_dir))
    return _PREPARED[slot]


def stay_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many stays as there are orders."""
    return view(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("stay_id"))


def joined(column: str, separator: str = ", "):
    return F.array_join(column, separator)


def weighted_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    dp = view(spark, sf_dir, "pmsi_dp").dropna(subset=["DP", "GHM5"])
    ids = stay_ids(spark, sf_dir)
    return draw_with_replacement(dp, "P_DP", table_cohort.ORDER, ids, "stay_id", SEED)


def split_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many weighted draws as there are orders, by splitting their number: each group's mass, all stays, and whether
    the group's share of them lies within six deviations. Which stay falls where comes from generators that SQL lacks."""
    dp = view(spark, sf_dir, "pmsi_dp").dropna(subset=["DP", "GHM5"])
    n = stay_ids(spark, sf_dir).count()
    drawn = written(draw_many(dp, "P_DP", table_cohort.ORDER, n, SEED).groupBy("GHM5").agg(F.count_distinct("stay_id").alias("n_drawn")), "split-groups")
    masses = dp.groupBy("GHM5").agg(F.sum("P_DP").cast("bigint").alias("w")).where("w > 0")
    total, stays = masses.agg(F.sum("w")).scalar(), drawn.agg(F.sum("n_drawn")).scalar()
    share = F.col("w") / total
    near = F.abs(F.coalesce("n_drawn", F.lit(0)) - n * share) <= 6 * F.sqrt(n * share * (1 - share)) + 6
    return masses.join(drawn, "GHM5", "full").select(F.col("GHM5").alias("ghm5"), "w", stays.alias("n_stays"), near.alias("near"))


SHARES = [1e-12, 1e-9, 1e-6, 1e-3, 0.1, 1.0, 30.0, 1e4, 1e7, 1e9]


def fractional_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with weights from 1e-10 to 1e12; one scale of ten in each group of ten parts."""
    share = F.get(F.array(*[F.lit(x) for x in SHARES]), (F.col("p_partkey") % 10).cast("int"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.select(F.col("p_partkey").alias("item"), (F.col("p_retailprice").cast("double") * share).alias("P"))


def weighted_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order one draw from all parts, and one from the parts of one scale alone: the scale of its own last digit."""
    parts = fractional_parts(spark, sf_dir).withColumn("scale", (F.col("item") % 10).cast("int"))
    ids = stay_ids(spark, sf_dir)
    every = draw_with_replacement(parts.drop("scale"), "P", ["item"], ids, "stay_id", SEED, "every").withColumnRenamed("item", "every_item")
    asked = every.withColumn("scale", (F.col("stay_id") % 10).cast("int"))
    drawn = draw_per_group(asked, "stay_id", parts, "P", ["scale"], ["item"], SEED, "scale")
    return drawn.select("stay_id", "every_item", F.col("item").alias("scale_item"))


def per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A main diagnosis for each order's group, by its share in the group; orders of the last group have none."""
    dp = view(spark, sf_dir, "pmsi_dp")
    asked = drawn_profiles(spark, sf_dir).select("stay_id", F.when(F.col("stay_id") % 7 != 0, F.col("GHM5")).alias("GHM5"))
    return draw_per_group(asked, "stay_id", dp.dropna(subset=["DP"]), "P_DP", ["GHM5"], ["DP"], SEED).withColumnsRenamed({"GHM5": "ghm5", "DP": "dp"})


def drawn_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw_rows(stay_ids(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["profile_slots"], SEED)


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = drawn_procedures(SEED, "stay_id", 3)
    return drawn_profiles(spark, sf_dir).select("stay_id", F.array_join(shown, ", ").alias("ccam"))


def associated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = drawn_profiles(spark, sf_dir).select("stay_id", "das_plans")
    ready = prepared(spark, sf_dir)
    drawn = draw_associated(stays, "stay_id", ready["das"], ready["hot"], 3, SEED, ready["das_slots"])
    return drawn.select("stay_id", joined("DAS").alias("das"), joined("DAS_CODE", ",").alias("das_codes"))


def triangular(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = drawn_profiles(spark, sf_dir)
    return stays.select("stay_id", triangular_days(uniform(SEED, "dms", "stay_id"), F.col("dms_shape")).alias("dms"))


def cohort_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_cohort.draw_prepared(prepared(spark, sf_dir), stay_ids(spark, sf_dir), seed=SEED)


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cohort_rows(spark, sf_dir).withColumns({"CCAM": joined("CCAM"), "DAS": joined("DAS")})
    return rows.select(*[F.col(c).alias(c.lower()) for c in rows.columns])


def short_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_cohort.short_scenario(cohort_rows(spark, sf_dir)).select("generation_id", "scenario")


def table_queries() -> dict:
    return {
        "draw_weighted_with_replacement": weighted_with_replacement,
        "draw_weighted_fractional": weighted_fractional,
        "draw_by_splitting": split_draws,
        "draw_per_group": per_group,
        "draw_procedures": procedures,
        "draw_associated_diagnoses": associated,
        "draw_triangular_days": triangular,
        "table_cohort": cohort,
        "short_scenario_text": short_text,
    }
