"""Label lookups and the small dimension tables behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def active_labels(reference: DataFrame) -> DataFrame:
    """code, label of the codes in force; one row per code."""
    return one_label(reference.where(F.col("en_cours") == 1), "code", "liblong")


def group_root_labels(rghm: DataFrame) -> DataFrame:
    """code, label of the group roots of the 2024 acute-care classification."""
    roots = rghm.where((F.col("champ") == "mco") & (F.col("version") == "v2024") & (F.col("type_code") == "racine"))
    return one_label(roots, "code", "lib")


def one_label(df: DataFrame, code: str, label: str) -> DataFrame:
    return df.groupBy(F.col(code).alias("code")).agg(F.max(label).alias("label")).where("code is not null")


def with_label(df: DataFrame, code: str, labels: DataFrame, out: str, default: str | None = None) -> DataFrame:
    """Left lookup of ``code``; without a label the default is the code itself, or the given text."""
    named = labels.select(F.col("code").alias("lookup_code"), F.col("label").alias("lookup_label"))
    fallback = F.col(code) if default is None else F.lit(default)
    joined = df.join(named, F.col(code) == F.col("lookup_code"), "left")
    return joined.withColumn(out, F.coalesce("lookup_label", fallback)).drop("lookup_code", "lookup_label")
