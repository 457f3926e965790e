"""Queries of the profile cohort over the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.operators import people, secondary
from casemill.operators.care import with_care_management
from casemill.operators.draws import draw_rows
from casemill.plans import profile_cohort
from casemill.plans.prompts import long_scenario
from casemill.standins import view, views
from catalog.sql import SEED
from catalog.table_queries import stay_ids

YEAR = 2025
INPUTS = {
    "secondary_icd": "case_secondary",
    "procedures": "case_procedures",
    **{
        name: name
        for name in (
            "icd_official", "drg_statistics", "drg_parents_groups", "specialty", "names", "hospitals", "procedure_official",
            "cancer_codes", "chronic", "cancer_treatment", "code_sets",
        )
    },
}

_PREPARED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def case_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "case_profiles")
    return rows.withColumn("icd_secondary_code", F.split("preset_codes", ",")).drop("preset_codes")


def data(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = dict(zip(INPUTS, views(spark, sf_dir, list(INPUTS.values())).values()))
    return {**tables, "profiles": case_profiles(spark, sf_dir)}


def prepared(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _PREPARED:
        _PREPARED[slot] = profile_cohort.prepare(data(spark, sf_dir))
    return _PREPARED[slot]


def hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir)["hot"]


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "rule_rows").groupBy("id").agg(F.max_by("text", "ordinal").alias("text"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw_rows(stay_ids(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["profile_slots"], SEED)


def pooled_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_cohort.with_pools(stays(spark, sf_dir), prepared(spark, sf_dir))


def grouped_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_cohort.with_facts_of_group(stays(spark, sf_dir), prepared(spark, sf_dir))


def drawn_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = [
        "admission_mode", "admission_type", "age2", "cage", "cage2", "case_management_type", "discharge_disposition",
        "drg_parent_code", "icd_primary_code", "los", "sexe",
    ]
    return stays(spark, sf_dir).select(
        "stay_id",
        *kept,
        F.when(F.size("preset.codes") > 0, F.array_join("preset.codes", ",")).alias("preset_codes"),
        F.col("primary_is_cancer").alias("is_cancer"),
    )


TREATED = ["histological_type", "score_TNM", "cancer_stage", "biomarkers", "treatment_recommandation", "chemotherapy_regimen"]


def treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secondary.draw_treatment(pooled_stays(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["treatments"], hot(spark, sf_dir), SEED)


def treatment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treated(spark, sf_dir).select("stay_id", *[F.col(c).alias(c.lower()) for c in TREATED])


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secondary.draw_secondary(treated(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["code_slots"], SEED)
    return out.select("stay_id", F.array_join("icd_secondary_code", ",").alias("icd_secondary_code"), "text_secondary_icd_official")


def procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secondary.draw_procedure(pooled_stays(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["code_slots"], SEED)
    return out.select("stay_id", "procedure", "text_procedure")


def day_texts(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in ("date_entry", "date_discharge", "date_of_birth")})


def dates_and_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile_cohort.with_administration(grouped_stays(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["people"], [YEAR - 2, YEAR - 1, YEAR], SEED)
    return day_texts(out).select("stay_id", "age", "date_entry", "date_discharge", "date_of_birth")


def people_of_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = people.draw_people(stays(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["people"], SEED)
    return out.select("stay_id", "first_name", "last_name", "first_name_med", "last_name_med", "hospital")


def care(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secondary.draw_procedure(treated(spark, sf_dir), "stay_id", prepared(spark, sf_dir)["code_slots"], SEED)
    out = profile_cohort.with_code_facts(profile_cohort.with_facts_of_group(out, prepared(spark, sf_dir)), prepared(spark, sf_dir))
    return with_care_management(out, "stay_id", SEED).select("stay_id", "situa", "coding_rule", "template_name")


def cohort_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_cohort.draw_prepared(prepared(spark, sf_dir), stay_ids(spark, sf_dir), "stay_id", YEAR, SEED)


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = day_texts(cohort_rows(spark, sf_dir)).withColumn("icd_secondary_code", F.array_join("icd_secondary_code", ","))
    plain = [
        "stay_id", "generation_id", "age", "sexe", "date_entry", "date_discharge", "date_of_birth", "first_name", "last_name",
        "drg_parent_code", "icd_primary_code", "icd_primary_description", "case_management_type", "icd_secondary_code",
        "text_secondary_icd_official", "procedure", "text_procedure", "admission_mode", "discharge_disposition", "cancer_stage",
        "histological_type", "treatment_recommandation", "chemotherapy_regimen", "biomarkers", "department", "hospital",
        "first_name_med", "last_name_med", "situa", "coding_rule", "template_name",
    ]
    return out.select(*plain, F.col("primary_is_cancer").alias("is_cancer"), F.col("score_TNM").alias("score_tnm"))


def long_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_scenario(cohort_rows(spark, sf_dir), rules(spark, sf_dir)).select("generation_id", "scenario")


def profile_queries() -> dict:
    return {
        "draw_profiles": drawn_profiles,
        "draw_cancer_treatment": treatment,
        "draw_secondary_diagnoses": diagnoses,
        "draw_stay_procedure": procedure,
        "draw_dates_and_age": dates_and_age,
        "draw_people": people_of_stay,
        "care_management": care,
        "profile_cohort": cohort,
        "long_scenario_text": long_text,
    }
