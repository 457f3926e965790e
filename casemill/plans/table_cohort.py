"""Cohort drawn from probability tables: profile, procedures, associated diagnoses, length of stay, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.text import row_key
from casemill.functions.uniform import generation_id, uniform
from casemill.operators.associated import SLOT_COLUMNS, asked_pools, attach_das_plans, das_positions, draw_associated
from casemill.operators.draws import draw_rows, sum_duplicates, table_positions
from casemill.operators.lookups import active_labels, group_root_labels, with_label
from casemill.operators.positions import bucketed_line, bucketed_slots, hot_pools, pool_totals, uncut
from casemill.operators.procedures import attach_procedure_pools, drawn_procedures
from casemill.operators.stay_length import triangular_days, triangular_parameters
from casemill.sources.scratch import written

PROFILE = ["AGE", "SEXE", "GHM5", "DP"]
ORDER = ["GHM5", "DP", "AGE", "SEXE"]


def eligible_profiles(dp: DataFrame, ghm5_pattern: str | None = None) -> DataFrame:
    """Rows with a group and a main diagnosis whose group matches the pattern; weights of equal profiles add up."""
    if ghm5_pattern is not None:
        dp = dp.where(F.col("GHM5").rlike(ghm5_pattern))
    return sum_duplicates(dp.dropna(subset=["DP", "GHM5"]), "P_DP", PROFILE)


def profile_key() -> Column:
    return row_key(*ORDER)


def prepare(tables: dict[str, DataFrame], n_das: int = 3, ghm5_pattern: str | None = None) -> dict[str, DataFrame | int]:
    """Everything that depends on the input tables alone, written once and shared by any number of draws:
    the positions of the associated diagnoses, and the distinct profiles with their positions, labels,
    procedure pool, plan of associated diagnoses and length-of-stay shape. Labels, procedures and shapes are looked up once
    per group and main diagnosis."""
    codes = active_labels(tables["cim10"])
    profiles = written(table_positions(eligible_profiles(tables["dp"], ghm5_pattern), ORDER), "profile-positions")
    das = written(das_positions(tables["das"], codes, profiles=profiles.select(*PROFILE), n_das=n_das), "das-positions")
    hot = written(hot_pools(asked_pools(profiles), pool_totals(das, ["pool"])), "hot-pools")
    profiles = profiles.withColumn("profile_key", profile_key())
    pairs = attach_procedure_pools(profiles.select("GHM5", "DP").distinct(), tables["ccam"], active_labels(tables["ccam_ref"]))
    pairs = pairs.join(triangular_parameters(tables["dms"]), "GHM5", "left")
    pairs = with_label(pairs, "GHM5", group_root_labels(tables["rghm"]), "ghm5_label")
    pairs = with_label(pairs, "DP", codes, "dp_label").drop("ccam_level")
    profiles = attach_das_plans(profiles, "profile_key", das, n_das, hot).drop("profile_key")
    profiles = profiles.join(pairs.hint("merge"), ["GHM5", "DP"], "left")
    slots = bucketed_slots(das.select(*SLOT_COLUMNS), hot, "das-slots")
    line = bucketed_line(profiles, "profiles")
    return {"das": das, "hot": hot, "das_slots": slots, "profiles": uncut(line), "profile_slots": line, "n_das": n_das}


def draw_prepared(
    prepared: dict[str, DataFrame | int], ids: DataFrame, id_col: str = "stay_id", n_ccam: int = 3, n_das: int = 3, seed: int = 0
) -> DataFrame:
    """One stay per row of ``ids``: one lookup for the profile and one per associated diagnosis. ``n_das`` may be at
    most what the tables were prepared for."""
    if n_das > prepared["n_das"]:
        raise ValueError(f"prepared for {prepared['n_das']} associated diagnoses, {n_das} asked for")
    stays = draw_rows(ids, id_col, prepared["profile_slots"], seed, empty_message="no profile matches the request")
    stays = stays.select(  # what the lookups of associated diagnoses carry along
        id_col,
        "AGE",
        "SEXE",
        F.col("ghm5_label").alias("GHM5"),
        F.col("GHM5").alias("GHM5_CODE"),
        F.col("dp_label").alias("DP"),
        F.col("DP").alias("DP_CODE"),
        drawn_procedures(seed, id_col, n_ccam).alias("CCAM"),
        triangular_days(uniform(seed, "dms", id_col), F.col("dms_shape")).alias("DMS"),
        "das_plans",
    )
    stays = draw_associated(stays, id_col, prepared["das"], prepared["hot"], n_das, seed, prepared["das_slots"])
    named = stays.withColumn("generation_id", generation_id(seed, id_col))
    return named.select(id_col, "generation_id", "AGE", "SEXE", "GHM5", "GHM5_CODE", "DP", "DP_CODE", "CCAM", "DAS", "DMS")


def draw_stays(
    tables: dict[str, DataFrame],
    ids: DataFrame,
    id_col: str = "stay_id",
    n_ccam: int = 3,
    n_das: int = 3,
    ghm5_pattern: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """``prepare`` and ``draw_prepared`` in one call."""
    return draw_prepared(prepare(tables, n_das, ghm5_pattern), ids, id_col, n_ccam, n_das, seed)


def short_scenario(stays: DataFrame) -> DataFrame:
    """Add the six-line ``scenario`` text; as with any concatenation a missing part makes the text missing."""

    def joined(codes: str) -> Column:
        return F.when(F.size(codes) > 0, F.array_join(codes, ", ")).otherwise(F.lit("Aucun"))

    parts = [
        ("Patient : ", F.col("SEXE").cast("string")),
        (", ", F.col("AGE").cast("string")),
        (".\nGHM : ", F.col("GHM5")),
        (" (", F.col("GHM5_CODE")),
        (").\nDiagnostic principal : ", F.col("DP")),
        (" (", F.col("DP_CODE")),
        (").\nActes CCAM : ", joined("CCAM")),
        (".\nDiagnostics associés : ", joined("DAS")),
        (".\nDurée de séjour : ", F.col("DMS").cast("string")),
    ]
    text = F.concat(*[piece for lead, value in parts for piece in (F.lit(lead), value)], F.lit(" jours."))
    return stays.withColumn("scenario", text)
