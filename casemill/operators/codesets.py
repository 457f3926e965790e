"""Code sets and what follows from membership in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill import fixed_values as V
from casemill.functions.text import parent_code


def distinct_codes(df: DataFrame, column: str = "code") -> DataFrame:
    return df.select(F.col(column).alias("code")).dropna().distinct()


def cancer_set(cancer_codes: DataFrame) -> DataFrame:
    """The codes and their three-letter parents, without contact codes (Z)."""
    codes = distinct_codes(cancer_codes, "CIM10")
    both = codes.unionByName(codes.select(parent_code("code").alias("code")))
    return both.where(~F.col("code").startswith("Z")).distinct()


def chronic_set(chronic: DataFrame, cancer: DataFrame) -> DataFrame:
    """Codes at chronic level 1 to 3, where a cancer code counts as level 3."""
    marked = chronic.join(cancer.withColumn("cancer", F.lit(True)), "code", "left")
    level = F.when(F.col("cancer"), F.lit(3)).otherwise(F.col("chronic"))
    return distinct_codes(marked.where(level.isin(1, 2, 3)))


def memberships(code_sets: DataFrame, cancer: DataFrame, chronic: DataFrame) -> DataFrame:
    """code -> names of the sets it is in."""
    named = [(cancer, "cancer"), (chronic, "chronic")]
    every = code_sets.select("set_name", "code")
    for codes, name in named:
        every = every.unionByName(codes.select(F.lit(name).alias("set_name"), "code"))
    return every.dropna().groupBy("code").agg(F.collect_set("set_name").alias("sets"))


def with_sets(df: DataFrame, code: str, members: DataFrame, out: str) -> DataFrame:
    """Add the array of set names that ``code`` belongs to (empty where it is in none)."""
    side = members.select(F.col("code").alias("set_code"), F.col("sets").alias(out))
    empty = F.array().cast("array<string>")
    return df.join(side, F.col(code) == F.col("set_code"), "left").drop("set_code").withColumn(out, F.coalesce(out, empty))


def diagnosis_type(code: Column, sets: Column) -> Column:
    """First that applies: distant metastasis, lymph-node metastasis, cancer, chronic; acute otherwise."""
    return (
        F.when(code.isin(V.DISTANT_METASTASES), "Metastasis")
        .when(code.isin(V.LYMPH_NODE_METASTASES), "Metastasis LN")
        .when(F.array_contains(sets, "cancer"), "Cancer")
        .when(F.array_contains(sets, "chronic"), "Chronic")
        .otherwise("Acute")
    )
