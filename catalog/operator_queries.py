"""One query per operator that the cohort queries do not show on their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from casemill.functions import in_sql
from casemill.functions.text import display, first_letter_upper, parent_code, sex_label
from casemill.functions.uniform import generation_id, uniform, uniform_int
from casemill.operators import codesets, conditional, lookups, people, positions, procedures, secondary, stay_length, synonyms
from casemill.operators.associated import attach_das_plans, layered_rows
from casemill.operators.draws import sum_duplicates
from casemill.plans import profile_cohort, prompts, table_cohort
from casemill.sources.registry import conform
from casemill.sources.scratch import written
from casemill.standins import view
from catalog import profile_queries as cases, table_queries as tabled
from catalog.sql import SEED

def seeded(salt: str, *keys: str) -> Column:
    return uniform(SEED, salt, *keys)


# --- projections, filters, predicates ---------------------------------------------------------------------


def filter_active_codes(*at) -> DataFrame:
    return lookups.active_labels(view(*at, "cim10"))


def filter_group_roots(*at) -> DataFrame:
    return lookups.group_root_labels(view(*at, "rghm"))


def filter_group_pattern(*at) -> DataFrame:
    rows = table_cohort.eligible_profiles(view(*at, "pmsi_dp"), "^0[1-5]C")
    return rows.select(*[F.col(c).alias(c.lower()) for c in table_cohort.PROFILE], "w")


def filter_missing_codes(*at) -> DataFrame:
    return table_cohort.eligible_profiles(view(*at, "pmsi_dp")).groupBy("GHM5").agg(F.sum("w").alias("w")).withColumnRenamed("GHM5", "ghm5")


def surgical_tests(*at) -> DataFrame:
    third = F.substring("ghm5", 3, 1)
    return view(*at, "part_codes").select(
        "p_partkey",
        procedures.is_surgical("ghm5").cast("int").alias("any_ck"),
        third.isin("C", "K").cast("int").alias("third_ck"),
        (third == "C").cast("int").alias("third_c"),
    )


def project_shared_columns(*at) -> DataFrame:
    rows = view(*at, "case_secondary")
    wanted = ["drg_parent_code", "icd_secondary_code", "cage2", "sexe", "nb", "not_there"]
    kept = conditional.shared_columns(wanted, rows)
    return rows.select(*kept).groupBy(*[c for c in kept if c != "nb"]).agg(F.sum("nb").alias("nb"))


def type_secondary_codes(*at) -> DataFrame:
    typed = secondary.typed_secondary(view(*at, "case_secondary"), members(*at))
    return typed.groupBy("icd_secondary_code", "type").agg(F.sum("nb").alias("nb"))


def filter_pool_by_type(*at) -> DataFrame:
    typed = secondary.typed_secondary(view(*at, "case_secondary"), members(*at))
    pooled = typed.withColumn("kind", F.explode(secondary.pool_kinds(F.col("type"))))
    return pooled.groupBy("kind", "icd_primary_code").agg(F.count(F.lit(1)).alias("n_rows"))


def eligible_names(*at) -> DataFrame:
    laid = people.people_positions(view(*at, "names"), view(*at, "hospitals"))
    return laid.select("pool", "name", "lo", "hi", "total")


def keep_raw_codes(*at) -> DataFrame:
    return tabled.cohort_rows(*at).groupBy(F.col("GHM5").alias("label"), F.col("GHM5_CODE").alias("code")).agg(F.count(F.lit(1)).alias("n"))


def parent_codes(*at) -> DataFrame:
    return view(*at, "stay_lines").groupBy(parent_code("dp").alias("parent")).agg(F.count_distinct("dp").alias("codes"))


def title_names(*at) -> DataFrame:
    return view(*at, "names").select(first_letter_upper("nom").alias("nom"), first_letter_upper("prenom").alias("prenom"))


# --- joins --------------------------------------------------------------------------------------------------


def group_facts(*at) -> DataFrame:
    groups = view(*at, "case_lines").select("drg_parent_code").distinct()
    return profile_cohort.with_group_facts(groups, cases.data(*at))


def label_or_code(*at) -> DataFrame:
    named = lookups.with_label(view(*at, "stay_lines"), "dp", lookups.active_labels(view(*at, "cim10")), "label")
    return named.select("l_orderkey", "l_linenumber", "p_partkey", "label")


def display_of_code(*at) -> DataFrame:
    codes = lookups.active_labels(view(*at, "cim10"))
    rows = view(*at, "pmsi_das").groupBy("DAS").agg(F.sum("P_DAS").alias("n")).join(codes, F.col("DAS") == F.col("code"), "left")
    return rows.select(F.col("DAS").alias("das"), "n", display("label", "DAS").alias("shown"))


def label_or_blank(*at) -> DataFrame:
    labels = lookups.one_label(view(*at, "icd_official"), "icd_code", "icd_code_description")
    named = lookups.with_label(view(*at, "case_lines"), "case_management_type", labels, "description", default="")
    return named.groupBy("case_management_type", "description").agg(F.count(F.lit(1)).alias("n"))


def procedure_cascade(*at) -> DataFrame:
    profiles = view(*at, "stay_lines").select(F.col("ghm5").alias("GHM5"), F.col("dp").alias("DP")).distinct()
    pooled = procedures.attach_procedure_pools(profiles, view(*at, "pmsi_ccam"), lookups.active_labels(view(*at, "ccam_ref")))
    codes = F.array_join(F.transform("ccam_pool", lambda x: F.concat_ws(":", x["code"], x["w"].cast("string"))), ",")
    return pooled.where("ccam_pool is not null").select(
        F.col("GHM5").alias("ghm5"), F.col("DP").alias("dp"), F.col("ccam_level").alias("lvl"), codes.alias("pool")
    )


def diagnosis_cascade(*at) -> DataFrame:
    profiles = table_cohort.eligible_profiles(view(*at, "pmsi_dp")).withColumn("profile_key", table_cohort.profile_key())
    planned = attach_das_plans(profiles, "profile_key", tabled.prepared(*at)["das"], 3)
    picks = planned.select("profile_key", F.posexplode("das_plans").alias("pick", "plan")).where("plan is not null")
    return picks.select("profile_key", (F.col("pick") + 1).alias("pick"), F.col("plan.level").alias("lvl"), F.col("plan.total").alias("total"))


def stay_length_parameters(*at) -> DataFrame:
    shapes = stay_length.triangular_parameters(view(*at, "pmsi_dms"))
    groups = view(*at, "part_codes").select(F.col("ghm5").alias("GHM5")).distinct().join(shapes, "GHM5", "left")
    return groups.select(
        F.col("GHM5").alias("ghm5"), F.col("dms_shape.left").alias("lft"), F.col("dms_shape.mode").alias("mode"), F.col("dms_shape.right").alias("rgt")
    )


def match_profile_wildcards(*at) -> DataFrame:
    """Rows of the procedure table that agree with each distinct profile, open values included."""
    profiles = cases.case_profiles(*at).select(*secondary.BY_PROCEDURE).distinct()
    laid = cases.prepared(*at)["procedures"]
    found = profiles.withColumn("pool", conditional.profile_pool("procedure", secondary.BY_PROCEDURE)).join(
        positions.pool_totals(laid, ["pool"]), "pool", "left"
    )
    return found.select(*secondary.BY_PROCEDURE, F.coalesce("copies", F.lit(0)).alias("n_rows"))


def code_set_membership(*at) -> DataFrame:
    lines = codesets.with_sets(view(*at, "case_lines"), "case_management_type", members(*at), "sets")
    return lines.select("case_management_type", F.explode("sets").alias("set_name")).groupBy("case_management_type", "set_name").agg(F.count(F.lit(1)).alias("n"))


def rows_with_set_codes(*at) -> DataFrame:
    """Semi join: lines whose main diagnosis is a cancer code."""
    cancer = codesets.cancer_set(view(*at, "cancer_codes"))
    lines = view(*at, "case_lines").withColumnRenamed("icd_primary_code", "code")
    return lines.join(cancer, "code", "left_semi").select("l_orderkey", "l_linenumber", "p_partkey", "code")


def join_rule_text(*at) -> DataFrame:
    rows = prompts.with_rule_text(cases.care(*at), cases.rules(*at))
    return rows.select("stay_id", "coding_rule", "rule_text")


# --- aggregations, sets --------------------------------------------------------------------------------------


def procedure_weights(*at) -> DataFrame:
    key, pool = procedures.level_pools(view(*at, "pmsi_ccam"), surgical_only=False)[1]
    return pool.select(F.col("GHM5").alias("ghm5"), F.col("DP3").alias("dp3"), F.col("CCAM").alias("ccam"), "w")


def diagnosis_pool_totals(*at) -> DataFrame:
    return pool_sizes(layered_rows(view(*at, "pmsi_das")))


def pool_sizes(rows: DataFrame) -> DataFrame:
    """Mass, codes and categories of each pool. Codes are added up before they are counted, then categories, both where one
    shuffle brings a category's rows: distinct counts side by side would make three rows of each."""
    rows = rows.select("pool", "DAS", "w", parent_code("DAS", 2).alias("grp")).repartition("pool", "grp")
    codes = rows.groupBy("pool", "grp", "DAS").agg(F.sum("w").alias("w"))
    groups = codes.groupBy("pool", "grp").agg(F.sum("w").alias("w"), F.count("DAS").alias("codes"))
    return groups.groupBy("pool").agg(F.sum("w").alias("total"), F.sum("codes").alias("codes"), F.count("grp").alias("categories"))


def main_specialty(*at) -> DataFrame:
    return profile_cohort.main_specialty(view(*at, "specialty"))


def synonym_phrases(*at) -> DataFrame:
    return synonyms.phrases_by_code(view(*at, "icd_synonyms"))


def pools_with_mass(*at) -> DataFrame:
    """Pools whose rows add up to more than nothing; weights of every third code are set to zero."""
    ccam = view(*at, "pmsi_ccam").withColumn("P_CCAM", F.when(F.substring("CCAM", 7, 1) < "3", F.col("P_CCAM")).otherwise(0))
    key, pool = procedures.level_pools(ccam, surgical_only=False)[0]
    return pool.groupBy(F.col("GHM5").alias("ghm5"), F.col("DP").alias("dp")).agg(F.sum("w").alias("mass"))


def normalised_weights(*at) -> DataFrame:
    rows = sum_duplicates(cases.case_profiles(*at), "nb", ["drg_parent_code"])
    total = rows.agg(F.sum("w").alias("total")).select("total").scalar()
    return rows.select("drg_parent_code", "w", (F.col("w").cast("double") / total).alias("p"))


def top_procedures(*at) -> DataFrame:
    key, pool = procedures.level_pools(view(*at, "pmsi_ccam"), surgical_only=False)[2]
    return procedures.heaviest(pool, key).select(F.col("GHM5").alias("ghm5"), F.col("CCAM").alias("ccam"), "w", "rank")


def cancer_code_set(*at) -> DataFrame:
    return codesets.cancer_set(view(*at, "cancer_codes"))


def chronic_code_set(*at) -> DataFrame:
    return codesets.chronic_set(view(*at, "chronic"), codesets.cancer_set(view(*at, "cancer_codes")))


def distinct_codes(*at) -> DataFrame:
    return codesets.distinct_codes(view(*at, "case_profiles"), "icd_primary_code")


def members(*at) -> DataFrame:
    cancer = codesets.cancer_set(view(*at, "cancer_codes"))
    return codesets.memberships(view(*at, "code_sets"), cancer, codesets.chronic_set(view(*at, "chronic"), cancer))


def orders_with_cancer_code(*at) -> DataFrame:
    """Set intersection per order as one flag."""
    lines = codesets.with_sets(view(*at, "case_lines"), "icd_secondary_code", members(*at), "sets")
    return lines.groupBy("l_orderkey").agg(F.max(F.array_contains("sets", "cancer").cast("int")).alias("any_cancer"))


# --- draws -----------------------------------------------------------------------------------------------------


def draw_counts(*at) -> DataFrame:
    return tabled.stay_ids(*at).select(
        "stay_id",
        uniform_int(seeded("ccam_count", "stay_id"), 1, 3).alias("n_ccam"),
        uniform_int(seeded("das_count", "stay_id"), 0, 3).alias("n_das"),
    )


def acute_draw(stays: DataFrame, laid: DataFrame) -> DataFrame:
    facts = F.col("pools.acute")
    wanted = conditional.wanted_count(SEED, "acute", "stay_id", facts["copies"])
    out = conditional.draw_some(stays, "stay_id", laid, facts["pool"], facts, wanted, 2, {"code": "code"}, "acute", SEED, large=True)
    return out.select("stay_id", F.col("acute_code_1").alias("first_code"), F.col("acute_code_2").alias("second_code"))


def draw_conditional_uniform(*at) -> DataFrame:
    return acute_draw(cases.pooled_stays(*at), cases.prepared(*at)["code_slots"])


def draw_conditional_weighted(*at) -> DataFrame:
    """As above, with rows weighing their count."""
    ready = cases.prepared(*at)
    labels = lookups.one_label(view(*at, "icd_official"), "icd_code", "icd_code_description")
    laid = secondary.secondary_positions(view(*at, "case_secondary"), cases.case_profiles(*at), ready["members"], labels, "nb")
    laid = written(laid.withColumnRenamed("icd_secondary_code", "code"), "weighted-positions")
    totals = positions.salted(positions.pool_totals(laid, ["pool"]), ready["hot"])
    slots = positions.bucketed_slots(laid.select("pool", "code", "lo", "hi", "unit", "step"), ready["hot"], "weighted-slots")
    stays = cases.stays(*at).select("stay_id", conditional.profile_pool("acute", secondary.BY_GROUP).alias("pool"))
    stays = stays.join(totals, "pool", "left")
    found = F.struct(F.struct("pool", "total", "copies", "step", "salts").alias("acute"))
    return acute_draw(stays.select("stay_id", F.when(F.col("total").isNotNull(), found).alias("pools")), slots)


def draw_distinct_chapters(*at) -> DataFrame:
    facts = F.col("pools.chronic")
    wanted = conditional.wanted_count(SEED, "chronic", "stay_id", facts["copies"])
    out = conditional.draw_some(
        cases.pooled_stays(*at), "stay_id", cases.prepared(*at)["code_slots"], facts["pool"], facts, wanted, 2,
        {"code": "code"}, "chronic", SEED, distinct_groups=True, large=True,
    )
    return out.select("stay_id", F.col("chronic_code_1").alias("first_code"), F.col("chronic_code_2").alias("second_code"))


def draw_normal_days(*at) -> DataFrame:
    days = stay_length.normal_days(F.col("los_mean"), F.col("los_sd"), SEED, "stay_id")
    return cases.grouped_stays(*at).select("stay_id", days.alias("days"))


def draw_day_of_year(*at) -> DataFrame:
    years = [cases.YEAR - 2, cases.YEAR - 1, cases.YEAR]
    spark = at[0]
    ids = view(*at, "orders").select(F.col("o_orderkey").alias("stay_id"), (F.col("o_orderstatus") == "O").alias("weekdays_only"))
    calendar = people.calendar_positions(spark, years)
    drawn = people.draw_day(ids, "stay_id", calendar, people.draw_year(years, SEED, "stay_id"), F.col("weekdays_only"), "day", "entry", SEED)
    return drawn.select("stay_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


def draw_day_between(*at) -> DataFrame:
    start = F.to_date("o_orderdate")
    day = people.day_between(start, F.date_add(start, (F.col("o_custkey") % 60).cast("int")), seeded("between", "o_orderkey"))
    return view(*at, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


def draw_synonym(*at) -> DataFrame:
    lines = view(*at, "case_lines").withColumn(
        "line_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "p_partkey", "l_suppkey", "qty")
    )
    labels = lookups.one_label(view(*at, "icd_official"), "icd_code", "icd_code_description")
    rows = synonyms.draw_phrase(lines, "line_id", "icd_secondary_code", synonyms.phrase_positions(view(*at, "icd_synonyms")), labels, SEED)
    return rows.select("line_id", "icd_secondary_code", "phrase")


def draw_age(*at) -> DataFrame:
    age = people.age_in_class(F.col("cage"), seeded("age", "stay_id"))
    return cases.stays(*at).select("stay_id", "cage", age.alias("age"))


def sql_ages(*at) -> DataFrame:
    """``draw_age`` in SQL."""
    in_sql.register(at[0])
    return at[0].sql(f"SELECT stay_id, cage, casemill_age(cage, casemill_uniform({SEED}, 'age', stay_id)) AS age FROM {{stays}}", stays=cases.stays(*at))


def sql_days_between(*at) -> DataFrame:
    """``draw_day_between`` in SQL."""
    in_sql.register(at[0])
    u, start = f"casemill_uniform({SEED}, 'between', o_orderkey)", "to_date(o_orderdate)"
    day = f"casemill_day({start}, date_add({start}, CAST(o_custkey % 60 AS INT)), {u})"
    return at[0].sql(f"SELECT o_orderkey, date_format({day}, 'yyyy-MM-dd') AS day FROM {{orders}}", orders=view(*at, "orders"))


def sql_triangular_days(*at) -> DataFrame:
    """``draw_triangular_days`` in SQL."""
    in_sql.register(at[0])
    days = f"casemill_days(dms_shape.left, dms_shape.mode, dms_shape.right, casemill_uniform({SEED}, 'dms', stay_id))"
    return at[0].sql(f"SELECT stay_id, {days} AS dms FROM {{stays}}", stays=tabled.drawn_profiles(*at))


def draw_branches(*at) -> DataFrame:
    delivery, chronic = seeded("delivery", "stay_id"), seeded("chronic_branch", "stay_id")
    return tabled.stay_ids(*at).select(
        "stay_id",
        F.when(delivery < 0.85, "_hospit").otherwise("_urg").alias("delivery"),
        F.when(chronic < 0.4, "D1").when(chronic < 0.6, "D9").otherwise("D5").alias("chronic"),
    )


def generation_ids(*at) -> DataFrame:
    return tabled.stay_ids(*at).select("stay_id", generation_id(SEED, "stay_id").alias("generation_id"))


# --- classification, text ------------------------------------------------------------------------------------------


def sex_labels(*at) -> DataFrame:
    lines = view(*at, "case_lines")
    return lines.groupBy("sexe", sex_label("sexe").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def secondary_lines(*at) -> DataFrame:
    labels = lookups.one_label(view(*at, "icd_official"), "icd_code", "icd_code_description")
    lines = lookups.with_label(view(*at, "case_secondary"), "icd_secondary_code", labels, "label", default="")
    return lines.groupBy(secondary.secondary_line("label", "icd_secondary_code").alias("line")).agg(F.count(F.lit(1)).alias("n"))


STAY_RECORD = "stay_id bigint, age int, sexe int, los bigint, icd_secondary_code array<string>, hospital string, admission_mode string"


def stay_records(*at) -> DataFrame:
    """Drawn profiles in an explicit schema: mixed types cast, absent columns null, missing lists empty."""
    rows = cases.case_profiles(*at).select(
        F.col("age2").cast("string").alias("age"), "sexe", "los", "icd_secondary_code", "admission_mode", F.lit(0).alias("stay_id")
    )
    out = conform(rows, StructType.fromDDL(STAY_RECORD))
    return out.groupBy("age", "sexe", "los", "hospital", "admission_mode", F.array_join("icd_secondary_code", ",").alias("codes")).agg(
        F.count(F.lit(1)).alias("n")
    )


def operator_queries() -> dict:
    named = [
        filter_active_codes, filter_group_roots, filter_group_pattern, filter_missing_codes, surgical_tests, project_shared_columns,
        type_secondary_codes, filter_pool_by_type, eligible_names, keep_raw_codes, parent_codes, title_names, group_facts, label_or_code,
        display_of_code, label_or_blank, procedure_cascade, diagnosis_cascade, stay_length_parameters, match_profile_wildcards,
        code_set_membership, rows_with_set_codes, join_rule_text, procedure_weights, diagnosis_pool_totals, main_specialty, synonym_phrases,
        pools_with_mass, normalised_weights, top_procedures, cancer_code_set, chronic_code_set, distinct_codes, orders_with_cancer_code,
        draw_counts, draw_conditional_uniform, draw_conditional_weighted, draw_distinct_chapters, draw_normal_days, draw_day_of_year,
        draw_day_between, draw_synonym, draw_age, sql_ages, sql_days_between, sql_triangular_days, draw_branches, generation_ids, sex_labels, secondary_lines, stay_records,
    ]
    return {run.__name__: run for run in named}
