"""Pools of secondary diagnoses, procedures and cancer treatments, and what a profile finds in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill import fixed_values as V
from casemill.functions.text import parent_code
from casemill.functions.uniform import position_below
from casemill.operators.codesets import diagnosis_type, with_sets
from casemill.operators.conditional import draw_some, pooled_rows, profile_pool, shared_columns, wanted_count
from casemill.operators.lookups import with_label
from casemill.operators.positions import bucketed_slots, find, int_weight, lay_out, pool_totals, salted
from casemill.operators.requests import EDGES, answers, asked, request
from casemill.sources.scratch import written

BY_DIAGNOSIS = ["icd_primary_code", "cage2", "sexe"]
BY_GROUP = ["drg_parent_code", "cage2", "sexe"]
BY_PROCEDURE = ["drg_parent_code", "icd_primary_code", "cage2", "sexe"]
TREATMENT_FIELDS = ["histological_type", "TNM", "stage", "biomarkers", "treatment_recommandation", "chemotherapy_regimen"]
POOLS = ["chronic", "nodes", "distant", "any_metastasis", "acute", "procedure", "treatment"]
#: What a drawn code or procedure comes with.
ITEM = ["code", "text", "is_cancer", "sets"]


def typed_secondary(secondary: DataFrame, members: DataFrame) -> DataFrame:
    """Add ``type`` to each row."""
    typed = with_sets(secondary, "icd_secondary_code", members, "das_sets")
    return typed.withColumn("type", diagnosis_type(F.col("icd_secondary_code"), F.col("das_sets")))


def pool_kinds(kind: Column) -> Column:
    """The pools that rows of a type are drawn from, apart from the acute ones."""
    names = {
        "Chronic": ["chronic", "chronic_or_cancer"],
        "Cancer": ["chronic_or_cancer"],
        "Metastasis LN": ["nodes", "any_metastasis"],
        "Metastasis": ["distant", "any_metastasis"],
    }
    out = F.array().cast("array<string>")
    for name, pools in names.items():
        out = F.when(kind == name, F.array(*[F.lit(p) for p in pools])).otherwise(out)
    return out


def _counted(rows: DataFrame, columns: list[str], weight: str | None) -> DataFrame:
    """Equal rows as one row with their number; pools keep the multiplicity. A row's ``unit`` is 1, or its own ``weight``
    (missing counts as 1)."""
    unit = F.lit(1).cast("bigint")
    if weight and weight in rows.columns:
        rows = rows.withColumn(weight, F.coalesce(F.col(weight), F.lit(1).cast(rows.schema[weight].dataType)))
        unit = int_weight(rows, weight)
    return rows.withColumn("unit", unit).groupBy(*columns, "unit").agg(F.count(F.lit(1)).alias("rows"))


def _laid(rows: DataFrame, item: list[str], group: Column | None, nomenclature: bool = True, distinct: bool = True) -> DataFrame:
    mass = (F.col("rows") * F.col("unit")).cast("bigint")
    return lay_out(rows, ["pool"], [*item, "unit"], mass, group, F.col("rows"), distinct=distinct, nomenclature=nomenclature).drop("rows")


def secondary_positions(
    secondary: DataFrame, profiles: DataFrame, members: DataFrame, labels: DataFrame, weight: str | None = None
) -> DataFrame:
    """Positions of chronic, metastasis and acute pools, with ``line`` and ``is_cancer`` of each code.
    Chronic and metastasis pools go by main diagnosis, acute ones by stay group."""
    by_dp, by_drg = shared_columns(BY_DIAGNOSIS, secondary, profiles), shared_columns(BY_GROUP, secondary, profiles)
    columns = list(dict.fromkeys([*by_dp, *by_drg, "icd_secondary_code"]))
    rows = written(typed_secondary(_counted(secondary.dropna(subset=["icd_secondary_code"]), columns, weight), members).drop("das_sets"), "typed-rows")
    item = ["icd_secondary_code", "unit"]
    of_dp = pooled_rows(rows.where("type <> 'Acute'"), pool_kinds(F.col("type")), by_dp, profiles, item)
    of_drg = pooled_rows(rows.where("type = 'Acute'"), F.array(F.lit("acute")), by_drg, profiles, item)
    chapter = parent_code("icd_secondary_code", 1)
    laid = _laid(of_dp.unionByName(of_drg), ["icd_secondary_code"], chapter, nomenclature=weight is None)
    laid = with_sets(laid, "icd_secondary_code", members, "das_sets")
    laid = with_label(laid, "icd_secondary_code", labels, "das_label", default="")
    return laid.withColumns(
        {"line": secondary_line("das_label", "icd_secondary_code"), "is_cancer": F.array_contains("das_sets", "cancer")}
    ).drop("das_sets", "das_label")


def secondary_line(label: str, code: str) -> Column:
    return F.concat(F.lit("- "), F.col(label), F.lit(" ("), F.col(code), F.lit(")\n"))


def procedure_positions(procedures: DataFrame, profiles: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    columns = shared_columns(BY_PROCEDURE, procedures, profiles)
    rows = _counted(procedures.dropna(subset=["procedure"]), [*columns, "procedure"], None)
    pools = pooled_rows(rows, F.array(F.lit("procedure")), columns, profiles, ["procedure", "unit"])
    laid = _laid(pools, ["procedure"], F.substring("procedure", 1, 2))
    laid = with_sets(laid, "procedure", members, "procedure_sets")
    return with_label(laid, "procedure", labels, "text_procedure", default="")


def treatment_positions(treatment: DataFrame) -> DataFrame:
    fields = shared_columns(TREATMENT_FIELDS, treatment)
    rows = _counted(treatment.dropna(subset=["icd_parent_code"]), ["icd_parent_code", *fields], None)
    rows = rows.withColumn("pool", F.concat(F.lit("treatment|"), F.col("icd_parent_code")))
    return _laid(rows, fields, None, nomenclature=False, distinct=False)


def code_slots(secondary: DataFrame, procedures: DataFrame, hot: DataFrame) -> DataFrame:
    """Secondary diagnoses and procedures as one table of slots, for requests of either kind; pools of the two never share a key."""
    edges = ["pool", "lo", "hi", "step", *EDGES]
    codes = secondary.select(*edges, F.col("icd_secondary_code").alias("code"), F.col("line").alias("text"), "is_cancer", F.lit(None).cast("array<string>").alias("sets"))
    acts = procedures.select(*edges, F.col("procedure").alias("code"), F.col("text_procedure").alias("text"), F.lit(None).cast("boolean").alias("is_cancer"), F.col("procedure_sets").alias("sets"))
    return bucketed_slots(codes.unionByName(acts), hot, "code-slots")


def is_treated() -> Column:
    """Whether the case type is one that comes with a cancer treatment."""
    return F.coalesce(F.col("case_management_type").isin(V.TREATED_CASE_TYPES), F.lit(False))


def pool_requests(profiles: DataFrame, is_cancer: Column) -> DataFrame:
    """What the pools of a profile depend on, once for all profiles that agree in it, with their mass ``w`` and the table's
    ``total``. There are far fewer of these than profiles, and their number is bounded by the codes."""
    columns = shared_columns(BY_PROCEDURE, profiles)
    rows = profiles.select(*columns, is_cancer.alias("primary_is_cancer"), is_treated().alias("treated"), "w", "total")
    return rows.groupBy(*columns, "primary_is_cancer", "treated").agg(F.sum("w").alias("w"), F.max("total").alias("total"))


def with_pool_keys(profiles: DataFrame, is_cancer: Column, treated: Column) -> DataFrame:
    """Add ``asked``, one text for all pools of a profile, and ``pairs`` of kind and pool key."""
    by_dp, by_drg = shared_columns(BY_DIAGNOSIS, profiles), shared_columns(BY_GROUP, profiles)
    keys = {
        "chronic": profile_pool(F.when(is_cancer, "chronic").otherwise("chronic_or_cancer"), by_dp),
        "nodes": profile_pool("nodes", by_dp),
        "distant": profile_pool("distant", by_dp),
        "any_metastasis": profile_pool("any_metastasis", by_dp),
        "acute": profile_pool("acute", by_drg),
        "procedure": profile_pool("procedure", shared_columns(BY_PROCEDURE, profiles)),
        "treatment": F.when(treated, F.concat(F.lit("treatment|"), parent_code("icd_primary_code"))),
    }
    asked = F.concat_ws("/", keys["chronic"], keys["procedure"], F.coalesce(keys["treatment"], F.lit("")))
    pairs = [F.struct(F.lit(kind).alias("kind"), key.alias("pool")) for kind, key in keys.items()]
    return profiles.withColumns({"asked": asked, "pairs": F.array(*pairs)})


def family_totals(secondary: DataFrame, *others: DataFrame) -> DataFrame:
    """Facts of all pools; ``some_cancer``: the pool holds a cancer code."""
    totals = pool_totals(secondary, ["pool"])
    for family in others:
        totals = totals.unionByName(pool_totals(family, ["pool"]))
    cancer = secondary.where("is_cancer").select("pool").distinct().withColumn("some_cancer", F.lit(True))
    return totals.join(cancer.hint("merge"), "pool", "left").withColumn("some_cancer", F.coalesce("some_cancer", F.lit(False)))


def asked_pools(requests: DataFrame) -> DataFrame:
    """pool, w, table_total of ``pool_requests`` that carry their pool keys."""
    return requests.select(F.inline("pairs"), "w", F.col("total").alias("table_total")).where("pool is not null")


def found_pools(requests: DataFrame, totals: DataFrame, hot: DataFrame) -> DataFrame:
    """``asked`` and its ``pools``: for each kind the pool key with its mass, rows, slot width and salts, null where empty."""
    wanted = requests.select("asked", F.inline("pairs")).where("pool is not null")
    facts = F.struct("pool", "total", "copies", "step", "salts", "some_cancer")
    return wanted.join(salted(totals, hot).hint("merge"), "pool").groupBy("asked").agg(
        F.struct(*[F.max(F.when(F.col("kind") == kind, facts)).alias(kind) for kind in POOLS]).alias("pools")
    )


def attach_pools(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``pools`` to rows that carry their pool keys, from ``found_pools``."""
    return rows.drop("pairs").join(found.hint("merge"), "asked", "left").drop("asked")


def _facts(kind: str) -> Column:
    return F.col("pools")[kind]


def draw_treatment(stays: DataFrame, id_col: str, treatments: DataFrame, hot: DataFrame, seed: int) -> DataFrame:
    """One treatment row for the parent code of the main diagnosis; stage and TNM only where they say something."""
    take = {name: name for name in TREATMENT_FIELDS if name in treatments.columns}
    facts = _facts("treatment")
    out = draw_some(stays, id_col, treatments, facts["pool"], facts, F.lit(1), 1, take, "treatment", seed, hot=hot)

    def got(name: str) -> Column:
        return F.col(f"treatment_{name}_1") if name in take else F.lit(None).cast("string")

    def said(value: Column) -> Column:
        return F.when(~value.isin(V.NOT_GIVEN), value)

    return out.withColumns(
        {
            "histological_type": got("histological_type"),
            "score_TNM": said(got("TNM")),
            "cancer_stage": said(got("stage")),
            "biomarkers": got("biomarkers"),
            "treatment_recommandation": got("treatment_recommandation"),
            "chemotherapy_regimen": got("chemotherapy_regimen"),
        }
    ).drop(*[f"treatment_{name}_1" for name in take])


def draw_procedure(stays: DataFrame, id_col: str, slots: DataFrame, seed: int) -> DataFrame:
    """One procedure; empty texts where the profile has none."""
    facts = _facts("procedure")
    at = position_below(facts["total"], seed, "procedure_1", id_col)
    take = {"drawn_code": "code", "drawn_text": "text", "drawn_sets": "sets"}
    out = find(stays, slots, {"pool": facts["pool"]}, at, facts["step"], take, id_col, large=True, salts=facts["salts"])
    return _with_procedure(out, F.col("drawn_code"), F.col("drawn_text"), F.col("drawn_sets")).drop(*take)


def _with_procedure(stays: DataFrame, code: Column, text: Column, sets: Column) -> DataFrame:
    return stays.withColumns(
        {
            "procedure": F.coalesce(code, F.lit("")),
            "text_procedure": F.coalesce(text, F.lit("")),
            "procedure_sets": F.coalesce(sets, F.array().cast("array<string>")),
        }
    )


def preset_secondary(stays: DataFrame) -> DataFrame:
    """``icd_secondary_code`` and ``text_secondary_icd_official`` of the profile's own codes alone."""
    own = F.col("preset")
    return stays.withColumns({"icd_secondary_code": own["codes"], "text_secondary_icd_official": F.array_join(own["lines"], "")})


def _staged() -> Column:
    return F.coalesce(F.col("score_TNM"), F.lit("")) != ""


def _says(pattern: str) -> Column:
    return _staged() & F.col("score_TNM").rlike(pattern)


def secondary_requests(id_col: str, seed: int) -> list[Column]:
    """Chronic diagnoses of distinct chapters, metastases, acute complications. Whether a stay that may draw a cancer code is a
    cancer stay is known with the answers only: its metastases are asked for along with the rest."""
    chronic, acute = _facts("chronic"), _facts("acute")
    n_chronic = wanted_count(seed, "chronic", id_col, chronic["copies"])
    may_be_cancer = F.col("primary_is_cancer") | F.col("preset")["any_cancer"] | ((n_chronic >= 1) & chronic["some_cancer"])
    spread = F.when(_staged(), _facts("distant")).otherwise(_facts("any_metastasis"))
    has_spread = may_be_cancer & (~_staged() | _says("M[123x+]"))
    return [
        request("chronic", chronic, n_chronic, by_group=True),
        request("nodes", _facts("nodes"), F.when(may_be_cancer & _says("N[123x+]"), 1)),
        request("metastasis", spread, F.when(has_spread, wanted_count(seed, "metastases", id_col, spread["copies"]))),
        request("acute", acute, wanted_count(seed, "acute", id_col, acute["copies"])),
    ]


def answered(stays: DataFrame, id_col: str, slots: DataFrame, requests: list[Column], picks: int, seed: int) -> DataFrame:
    """The stays, written, with the ``answers`` of their requests. Requests and answers both read the stays, so these are worked out once."""
    stays = written(stays, "asking-stays")
    found = answers(asked(stays, id_col, requests), id_col, slots, picks, ITEM, seed)
    return stays.join(found.hint("merge"), id_col, "left")


def _items(stage: str) -> Column:
    none = F.array().cast("array<struct<code:string,text:string,is_cancer:boolean,sets:array<string>>>")
    return F.coalesce(F.try_element_at("answers", F.lit(stage)), none)


def with_secondary(stays: DataFrame) -> DataFrame:
    """``icd_secondary_code`` and ``text_secondary_icd_official`` from the answers to ``secondary_requests``: the
    profile's own codes, then chronic diagnoses of distinct chapters, metastases of cancer stays, acute complications.

    A stay is a cancer stay by its main diagnosis, or as soon as one of its codes so far is a cancer code; the metastases of other stays are let go.
    Needs ``primary_is_cancer``, ``preset`` (the profile's own lines) and ``score_TNM``.
    """
    drawn_cancer = F.exists(_items("chronic"), lambda x: F.coalesce(x["is_cancer"], F.lit(False)))
    out = stays.withColumn("cancer_stay", F.col("primary_is_cancer") | F.col("preset")["any_cancer"] | drawn_cancer)
    spread = [F.when(F.col("cancer_stay"), _items(stage)).otherwise(F.filter(_items(stage), lambda x: F.lit(False))) for stage in ("nodes", "metastasis")]
    out = out.withColumn("drawn", F.concat(_items("chronic"), *spread, _items("acute")))
    lines = F.concat(F.col("preset")["lines"], F.transform("drawn", lambda x: x["text"]))
    return out.withColumns(
        {"icd_secondary_code": F.concat(F.col("preset")["codes"], F.transform("drawn", lambda x: x["code"])), "text_secondary_icd_official": F.array_join(lines, "")}
    ).drop("cancer_stay", "drawn")


def draw_secondary(stays: DataFrame, id_col: str, slots: DataFrame, seed: int) -> DataFrame:
    """``with_secondary`` of the answers drawn from ``slots`` (``code_slots``)."""
    return with_secondary(answered(stays, id_col, slots, secondary_requests(id_col, seed), 2, seed)).drop("answers")


def draw_codes(stays: DataFrame, id_col: str, slots: DataFrame, seed: int) -> DataFrame:
    """``draw_secondary`` and ``draw_procedure`` with the same two lookups for all picks."""
    act = request("procedure", _facts("procedure"), F.lit(1))
    out = with_secondary(answered(stays, id_col, slots, [*secondary_requests(id_col, seed), act], 2, seed))
    act = F.get(_items("procedure"), F.lit(0))
    return _with_procedure(out, act["code"], act["text"], act["sets"]).drop("answers")
