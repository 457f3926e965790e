"""Cohort drawn from coded profiles: administrative data, cancer treatment, diagnoses, procedure, care management."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.text import list_text, parent_code, row_key
from casemill.functions.uniform import generation_id, uniform
from casemill.operators.care import with_care_management
from casemill.operators.codesets import cancer_set, chronic_set, memberships, with_sets
from casemill.operators.draws import draw_rows, keyed_positions, sum_duplicates
from casemill.operators.lookups import one_label, with_label
from casemill.operators.people import (
    age_in_class,
    birth_date,
    calendar_positions,
    draw_people,
    people_positions,
    stay_dates,
)
from casemill.operators.positions import bucketed_line, hot_pools, uncut
from casemill.operators.secondary import (
    asked_pools,
    attach_pools,
    code_slots,
    draw_codes,
    draw_procedure,
    draw_treatment,
    family_totals,
    found_pools,
    is_treated,
    pool_requests,
    preset_secondary,
    procedure_positions,
    secondary_line,
    secondary_positions,
    treatment_positions,
    with_pool_keys,
)
from casemill.operators.stay_length import normal_days
from casemill.sources.scratch import all_written, written

PROFILE_TYPES = {
    "drg_parent_code": "string",
    "icd_primary_code": "string",
    "case_management_type": "string",
    "icd_secondary_code": "array<string>",
    "admission_mode": "string",
    "discharge_disposition": "string",
    "admission_type": "string",
    "los": "int",
    "age2": "int",
    "cage": "string",
    "cage2": "string",
    "sexe": "int",
}

COLUMNS = [
    "generation_id", "age", "sexe", "date_entry", "date_discharge", "date_of_birth", "first_name", "last_name",
    "drg_parent_code", "drg_parent_description", "icd_primary_code", "icd_parent_code", "icd_primary_description",
    "primary_is_cancer", "case_management_type", "case_management_type_description", "icd_secondary_code",
    "text_secondary_icd_official", "procedure", "text_procedure", "admission_mode", "discharge_disposition",
    "admission_type", "cage", "cage2", "los", "los_mean", "los_sd", "cancer_stage", "score_TNM", "histological_type",
    "treatment_recommandation", "chemotherapy_regimen", "biomarkers", "department", "hospital", "first_name_med",
    "last_name_med", "situa", "coding_rule", "template_name",
]


def typed_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with every expected column: known ones cast, absent ones added as typed nulls."""
    known = {
        name: (F.col(name) if name in profiles.columns else F.lit(None)).cast(kind) for name, kind in PROFILE_TYPES.items()
    }
    return profiles.withColumns(known | {"icd_secondary_code": F.array_compact(known["icd_secondary_code"])})


def profile_key(columns: list[str]) -> Column:
    """All identifying values of a profile as one text."""
    return row_key(*[list_text(c) if c == "icd_secondary_code" else c for c in sorted(columns)])


GROUP_FACTS = ["drg_parent_description", "los_mean", "los_sd", "specialty"]


def group_descriptions(groups: DataFrame) -> DataFrame:
    return groups.groupBy("drg_parent_code").agg(F.max("drg_parent_description").alias("drg_parent_description"))


def group_stay_statistics(statistics: DataFrame) -> DataFrame:
    pair = F.max(F.struct("los_mean", "los_sd")).alias("pair")
    return statistics.groupBy("drg_parent_code").agg(pair).select("drg_parent_code", "pair.los_mean", "pair.los_sd")


def main_specialty(specialty: DataFrame) -> DataFrame:
    """The specialty with the highest ratio of each group."""
    best = F.max_by("specialty", F.struct("ratio", "specialty")).alias("specialty")
    return specialty.groupBy("drg_parent_code").agg(best)


def with_group_facts(profiles: DataFrame, data: dict[str, DataFrame]) -> DataFrame:
    """Description, stay statistics and specialty of the stay group, each only where the profiles lack it."""
    sides = [
        (["drg_parent_description"], lambda: group_descriptions(data["drg_parents_groups"])),
        (["los_mean", "los_sd"], lambda: group_stay_statistics(data["drg_statistics"])),
        (["specialty"], lambda: main_specialty(data["specialty"])),
    ]
    for names, side in sides:
        missing = [n for n in names if n not in profiles.columns]
        if missing:
            profiles = profiles.join(side().select("drg_parent_code", *missing), "drg_parent_code", "left")
    return profiles


def with_preset(profiles: DataFrame, key: str | None, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``preset``: the profile's own secondary codes in order, their lines, and whether one is a cancer
    code. Equal lists are worked out once; profiles without a list meet no lookup and are not shuffled. ``key`` is not needed
    any more."""
    none = F.array().cast("array<string>")
    listed = F.coalesce(F.size("icd_secondary_code") > 0, F.lit(False))
    profiles = profiles.withColumn("own", F.when(listed, list_text("icd_secondary_code")))
    lists = profiles.where(listed).select("own", "icd_secondary_code").distinct()
    codes = lists.select("own", F.posexplode("icd_secondary_code").alias("pos", "code"))
    codes = with_label(with_sets(codes, "code", members, "sets"), "code", labels, "label", default="")
    entry = F.struct("pos", "code", secondary_line("label", "code").alias("line"))
    known = codes.groupBy("own").agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), F.max(F.array_contains("sets", "cancer")).alias("own_cancer")
    )
    preset = F.struct(
        F.coalesce(F.transform("entries", lambda x: x["code"]), none).alias("codes"),
        F.coalesce(F.transform("entries", lambda x: x["line"]), none).alias("lines"),
        F.coalesce("own_cancer", F.lit(False)).alias("any_cancer"),
    )
    found = profiles.where(listed).join(known, "own", "left").withColumn("preset", preset).drop("own", "entries", "own_cancer")
    empty = F.struct(none.alias("codes"), none.alias("lines"), F.lit(False).alias("any_cancer"))
    return found.unionByName(profiles.where(~listed).withColumn("preset", empty).drop("own"))


def prepare(data: dict[str, DataFrame], weight: str | None = None) -> dict[str, DataFrame]:
    """Everything that depends on the input tables alone, written once: positions of every pool, and the
    distinct profiles with their positions and own codes, with what is looked up for a drawn one beside them. ``weight`` names the column that
    weighs secondary rows; without it rows are equally likely."""
    cancer = cancer_set(data["cancer_codes"])
    members = written(memberships(data["code_sets"], cancer, chronic_set(data["chronic"], cancer)), "code-sets")
    labels = one_label(data["icd_official"], "icd_code", "icd_code_description")
    procedure_labels = one_label(data["procedure_official"], "procedure", "procedure_description")

    source = typed_profiles(data["profiles"])
    identity = [c for c in source.columns if c != "nb"]
    laid = keyed_positions(sum_duplicates(source, "nb", identity), "profile_key", profile_key(identity)).drop("profile_key")
    laid = written(with_sets(laid, "icd_primary_code", members, "primary_sets"), "profile-positions")

    families = all_written(
        {
            "secondary": secondary_positions(data["secondary_icd"], source, members, labels, weight),
            "procedures": procedure_positions(data["procedures"], source, members, procedure_labels),
            "treatments": treatment_positions(data["cancer_treatment"]),
            "people": people_positions(data["names"], data["hospitals"]),
        }
    )
    of_profile = [families[name] for name in ("secondary", "procedures", "treatments")]
    totals = family_totals(*of_profile)
    requests = written(pool_requests(laid, F.array_contains("primary_sets", "cancer")), "pool-requests")
    requests = with_pool_keys(requests, F.col("primary_is_cancer"), F.col("treated"))
    hot = written(hot_pools(asked_pools(requests), totals), "hot-pools")
    pools = written(found_pools(requests, totals, hot), "profile-pools")
    profiles = laid.withColumn("icd_parent_code", F.coalesce(parent_code("icd_primary_code"), F.lit("")))
    profiles = profiles.withColumn("primary_is_cancer", F.array_contains("primary_sets", "cancer"))
    slots = code_slots(families["secondary"], families["procedures"], hot)
    line = bucketed_line(with_preset(profiles, None, members, labels), "case-profiles")
    lacking = [name for name in GROUP_FACTS if name not in laid.columns]
    groups = with_group_facts(laid.select("drg_parent_code").distinct(), data).select("drg_parent_code", *lacking)
    return {
        **families, "hot": hot, "members": members, "labels": written(labels, "labels"), "group_facts": written(groups, "group-facts"),
        "profile_pools": pools, "code_slots": slots, "profiles": uncut(line), "profile_slots": line,
    }


def with_pools(stays: DataFrame, prepared: dict[str, DataFrame]) -> DataFrame:
    """Add ``pools`` of the drawn profile. Profiles are laid out without them: they are long, and a stay has but one profile."""
    return attach_pools(with_pool_keys(stays, F.col("primary_is_cancer"), is_treated()), prepared["profile_pools"])


def with_facts_of_group(stays: DataFrame, prepared: dict[str, DataFrame]) -> DataFrame:
    """Add those of ``GROUP_FACTS`` that the profiles lack."""
    return stays.join(prepared["group_facts"], "drg_parent_code", "left")


def with_code_facts(stays: DataFrame, prepared: dict[str, DataFrame]) -> DataFrame:
    """Add the sets of the case type, and the labels of the main diagnosis and the case type."""
    stays = with_sets(stays, "case_management_type", prepared["members"], "mdp_sets")
    stays = with_label(stays, "icd_primary_code", prepared["labels"], "icd_primary_description", default="")
    return with_label(stays, "case_management_type", prepared["labels"], "case_management_type_description", default="")


def with_administration(stays: DataFrame, id_col: str, people: DataFrame, years: list[int], seed: int) -> DataFrame:
    """Age, dates, birth date, names, department and hospital."""
    calendar = calendar_positions(stays.sparkSession, years)
    drawn_days = normal_days(F.col("los_mean"), F.col("los_sd"), seed, id_col)
    stays = stays.withColumn("age", F.coalesce("age2", age_in_class(F.col("cage"), uniform(seed, "age", id_col))))
    stays = stay_dates(stays, id_col, calendar, years, drawn_days, seed)
    born = birth_date(F.col("date_entry"), F.col("age"), uniform(seed, "birth", id_col))
    stays = stays.withColumns({"date_of_birth": born, "department": F.col("specialty")})
    return draw_people(stays, id_col, people, seed)


def draw_prepared(
    prepared: dict[str, DataFrame],
    ids: DataFrame,
    id_col: str = "stay_id",
    reference_year: int = 2025,
    seed: int = 0,
    years: list[int] | None = None,
    add_secondary: bool = True,
) -> DataFrame:
    """One stay per row of ``ids``. Stays begin in one of ``years``, or in the reference year or the two before it.
    Without ``add_secondary`` a stay has its profile's own secondary codes only."""
    years = years or [reference_year - 2, reference_year - 1, reference_year]
    stays = draw_rows(ids, id_col, prepared["profile_slots"], seed, empty_message="no profile to draw from")
    stays = with_code_facts(with_facts_of_group(with_pools(stays, prepared), prepared), prepared)
    stays = draw_treatment(stays, id_col, prepared["treatments"], prepared["hot"], seed)
    if add_secondary:
        stays = draw_codes(stays, id_col, prepared["code_slots"], seed)
    else:
        stays = draw_procedure(preset_secondary(stays), id_col, prepared["code_slots"], seed)
    stays = with_administration(stays.drop("pools", "preset"), id_col, prepared["people"], years, seed)
    stays = with_care_management(stays, id_col, seed)
    return stays.withColumn("generation_id", generation_id(seed, id_col)).select(id_col, *COLUMNS)


def draw_stays(
    data: dict[str, DataFrame], ids: DataFrame, id_col: str = "stay_id", reference_year: int = 2025, seed: int = 0, weight: str | None = None
) -> DataFrame:
    """``prepare`` and ``draw_prepared`` in one call."""
    return draw_prepared(prepare(data, weight), ids, id_col, reference_year, seed)
