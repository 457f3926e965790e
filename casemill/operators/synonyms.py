"""Alternative phrasings of diagnosis codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed_values import DISTANT_METASTASES
from casemill.functions.uniform import position_below
from casemill.operators.positions import find, lay_out, pool_totals, slotted


def usable_phrases(synonyms: DataFrame) -> DataFrame:
    """All phrasings of a code; for distant metastases only those that say so."""
    says_so = F.lower("icd_code_description").contains("metastase")
    return synonyms.where(~F.col("icd_code").isin(DISTANT_METASTASES) | says_so)


def phrases_by_code(synonyms: DataFrame) -> DataFrame:
    """Phrasings of each code with their number. Kept long: a code's list may be of any length."""
    return synonyms.groupBy("icd_code", "icd_code_description").agg(F.count(F.lit(1)).alias("copies"))


def phrase_positions(synonyms: DataFrame) -> DataFrame:
    rows = usable_phrases(synonyms).dropna(subset=["icd_code", "icd_code_description"])
    return lay_out(rows, ["icd_code"], ["icd_code_description"], F.lit(1).cast("bigint"))


def draw_phrase(rows: DataFrame, id_col: str, code: str, positions: DataFrame, labels: DataFrame, seed: int, out: str = "phrase") -> DataFrame:
    """Add one random phrasing of ``code``, else its official label, else an empty text."""
    totals = pool_totals(positions, ["icd_code"]).select(
        F.col("icd_code").alias("phrase_code"), F.col("total").alias("phrase_total"), F.col("step").alias("phrase_step")
    )
    official = labels.select(F.col("code").alias("official_code"), F.col("label").alias("official"))
    asked = rows.join(totals, F.col(code) == F.col("phrase_code"), "left").join(official, F.col(code) == F.col("official_code"), "left")
    at: Column = position_below(F.col("phrase_total"), seed, "phrase", id_col, code)
    slots = slotted(positions.select("icd_code", "icd_code_description", "lo", "hi", "step"))
    found = find(asked, slots, {"icd_code": F.col(code)}, at, F.col("phrase_step"), {"drawn": "icd_code_description"}, id_col)
    phrase = F.coalesce("drawn", "official", F.lit(""))
    return found.withColumn(out, phrase).drop("phrase_code", "phrase_total", "phrase_step", "official_code", "official", "drawn")
