"""Checks of the profile cohort, written from the definitions: candidate rows by plain comparison, one pick
after the other on the rows that are left."""

from __future__ import annotations

from casemill import fixed_values as V
from casemill.fixed_values import PROMPT, SITUATION as S
from casemill.standins import with_views
from catalog.sql import below, between, bits, generation_id, laid_out, spread, u

INPUTS = [
    "case_profiles", "case_secondary", "case_procedures", "icd_official", "drg_statistics", "drg_parents_groups", "specialty",
    "names", "hospitals", "procedure_official", "cancer_codes", "chronic", "cancer_treatment", "code_sets", "rule_rows",
]
YEAR = 2025

IDENTITY = [
    "admission_mode", "admission_type", "age2", "cage", "cage2", "case_management_type", "discharge_disposition",
    "drg_parent_code", "icd_primary_code", "preset_codes", "los", "sexe",
]
TEXT = {"preset_codes": "'=' || replace(preset_codes, ',', ',=')"}
KEY = "concat_ws('|', " + ", ".join(f"coalesce('=' || replace({TEXT.get(c, f'CAST({c} AS VARCHAR)')}, '|', '||'), '~')" for c in IDENTITY) + ")"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def listed(codes: list[str]) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


SETS = [
    (
        "cancer",
        "SELECT DISTINCT code FROM (SELECT CIM10 AS code FROM cancer_codes UNION ALL SELECT substr(CIM10, 1, 3) FROM cancer_codes)"
        " WHERE code IS NOT NULL AND code NOT LIKE 'Z%'",
    ),
    (
        "chronic_codes",
        "SELECT DISTINCT code FROM chronic WHERE CASE WHEN code IN (SELECT code FROM cancer) THEN 3 ELSE chronic END IN (1, 2, 3)",
    ),
    ("icd_label", "SELECT icd_code AS code, max(icd_code_description) AS label FROM icd_official GROUP BY 1"),
    ("procedure_label", "SELECT procedure AS code, max(procedure_description) AS label FROM procedure_official GROUP BY 1"),
]

STAYS = [
    ("cases", f"SELECT {', '.join(IDENTITY)}, {KEY} AS key, CAST(sum(coalesce(nb, 1)) AS BIGINT) AS w FROM case_profiles GROUP BY ALL"),
    ("cases_laid", laid_out("cases", [], [spread("key", digits=3), "key"])),
    ("asked", f"SELECT o_orderkey AS stay_id, {below(bits('profile', 'o_orderkey'), '(SELECT max(total) FROM cases_laid)')} AS t FROM orders"),
    (
        "stays",
        f"SELECT stay_id, {', '.join(IDENTITY)}, coalesce(icd_primary_code IN (SELECT code FROM cancer), FALSE) AS is_cancer"
        " FROM asked ASOF JOIN cases_laid ON asked.t >= cases_laid.lo",
    ),
]

FACTS = [
    ("group_text", "SELECT drg_parent_code, max(drg_parent_description) AS about_group FROM drg_parents_groups GROUP BY 1"),
    ("group_days", "SELECT drg_parent_code, max(los_mean) AS los_mean, max(los_sd) AS los_sd FROM drg_statistics GROUP BY 1"),
    (
        "group_service",
        "SELECT drg_parent_code, specialty FROM specialty QUALIFY row_number() OVER (PARTITION BY drg_parent_code"
        " ORDER BY ratio DESC, specialty DESC) = 1",
    ),
]


def picked(name: str, source: str, key: list[str], order: list[str], salt: str, when: str, keep: str, weight: str = "w") -> list[tuple[str, str]]:
    """Lay ``source`` (candidate rows per stay) out and keep the row that holds the drawn position."""
    return [
        (f"{name}_laid", laid_out(source, key, order, weight)),
        (
            name,
            f"SELECT {keep} FROM (SELECT *, {below(bits(salt, 'stay_id'), 'total')} AS t FROM {name}_laid WHERE {when})"
            f" WHERE t >= lo AND t < lo + {weight}",
        ),
    ]


FIELDS = ["histological_type", "TNM", "stage", "biomarkers", "treatment_recommandation", "chemotherapy_regimen"]
TREATMENT = [
    ("treat_rows", f"SELECT icd_parent_code, {', '.join(FIELDS)}, count(*) AS w FROM cancer_treatment GROUP BY ALL"),
    (
        "treat_for",
        "SELECT s.stay_id, r.* FROM stays s JOIN treat_rows r ON r.icd_parent_code = substr(s.icd_primary_code, 1, 3)"
        " WHERE s.case_management_type IN ('DP', 'Z511')",
    ),
    *picked("treat", "treat_for", ["stay_id"], [spread(*FIELDS, "1"), *FIELDS], "treatment_1", "TRUE", f"stay_id, {', '.join(FIELDS)}"),
    (
        "treated",
        "SELECT s.*, histological_type, CASE WHEN TNM NOT IN ('Variable', 'Non pertinent') THEN TNM END AS score_tnm,"
        " CASE WHEN stage NOT IN ('Variable', 'Non pertinent') THEN stage END AS cancer_stage, biomarkers,"
        " treatment_recommandation, chemotherapy_regimen FROM stays s LEFT JOIN treat USING (stay_id)",
    ),
]


def agrees(columns: list[str]) -> str:
    return " AND ".join(f"(k.{c} IS NULL OR k.{c} = r.{c})" for c in columns)


def same(columns: list[str], left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


def pools(name: str, rows: str, columns: list[str], item: str) -> tuple[str, str]:
    """Rows that agree with each distinct profile key, equal items counted."""
    key = ", ".join(columns)
    return (
        name,
        f"SELECT {', '.join(f'k.{c}' for c in columns)}, r.kind, r.{item}, CAST(sum(r.n) AS BIGINT) AS w"
        f" FROM (SELECT DISTINCT {key} FROM stays) k JOIN {rows} r ON {agrees(columns)} GROUP BY ALL",
    )


BY_DP = ["icd_primary_code", "cage2", "sexe"]
BY_DRG = ["drg_parent_code", "cage2", "sexe"]
BY_BOTH = ["drg_parent_code", "icd_primary_code", "cage2", "sexe"]

SECONDARY_POOLS = [
    (
        "sec_rows",
        "SELECT drg_parent_code, icd_primary_code, cage2, sexe, icd_secondary_code AS das, count(*) AS n,"
        f" CASE WHEN das IN {listed(V.DISTANT_METASTASES)} THEN 'Metastasis' WHEN das IN {listed(V.LYMPH_NODE_METASTASES)}"
        " THEN 'Metastasis LN' WHEN das IN (SELECT code FROM cancer) THEN 'Cancer' WHEN das IN (SELECT code FROM chronic_codes)"
        " THEN 'Chronic' ELSE 'Acute' END AS kind FROM case_secondary GROUP BY ALL",
    ),
    pools("dp_pools", "(SELECT * FROM sec_rows WHERE kind <> 'Acute')", BY_DP, "das"),
    pools("drg_pools", "(SELECT * FROM sec_rows WHERE kind = 'Acute')", BY_DRG, "das"),
]


def two_rows(stage: str, candidates: str) -> list[tuple[str, str]]:
    """Up to two rows without replacement; ``candidates`` has stay_id, das, w."""
    count = f"CAST(floor({u(stage + '_count', 'stay_id')} * (least(rows_in_pool, 2) + 1)) AS BIGINT)"
    salt = {"metastases": "metastasis"}.get(stage, stage)
    return [
        (f"{stage}_cand", candidates),
        (f"{stage}_n", f"SELECT stay_id, {count} AS n FROM (SELECT stay_id, sum(w) AS rows_in_pool FROM {stage}_cand GROUP BY 1)"),
        (f"{stage}_first", f"SELECT c.* FROM {stage}_cand c JOIN {stage}_n USING (stay_id) WHERE n >= 1"),
        *picked(f"{stage}_1", f"{stage}_first", ["stay_id"], ["substr(das, 1, 1)", "das"], f"{salt}_1", "TRUE", "stay_id, das"),
        (
            f"{stage}_second",
            f"SELECT c.stay_id, c.das, c.w - CASE WHEN c.das = p.das THEN 1 ELSE 0 END AS w FROM {stage}_cand c JOIN {stage}_n n"
            f" ON n.stay_id = c.stay_id JOIN {stage}_1 p ON p.stay_id = c.stay_id"
            " WHERE n >= 2 AND c.w > CASE WHEN c.das = p.das THEN 1 ELSE 0 END",
        ),
        *picked(f"{stage}_2", f"{stage}_second", ["stay_id"], ["substr(das, 1, 1)", "das"], f"{salt}_2", "TRUE", "stay_id, das"),
    ]


CHRONIC = [
    (
        "chronic_cand",
        f"SELECT s.stay_id, p.das, sum(p.w)::BIGINT AS w FROM stays s JOIN dp_pools p ON {same(BY_DP, 's', 'p')}"
        " WHERE p.kind = 'Chronic' OR (p.kind = 'Cancer' AND NOT s.is_cancer) GROUP BY 1, 2",
    ),
    (
        "chronic_n",
        f"SELECT stay_id, CAST(floor({u('chronic_count', 'stay_id')} * (least(n, 2) + 1)) AS BIGINT) AS n"
        " FROM (SELECT stay_id, sum(w) AS n FROM chronic_cand GROUP BY 1)",
    ),
    ("chronic_first", "SELECT c.* FROM chronic_cand c JOIN chronic_n USING (stay_id) WHERE n >= 1"),
    *picked("chronic_1", "chronic_first", ["stay_id"], ["substr(das, 1, 1)", "das"], "chronic_1", "TRUE", "stay_id, das"),
    (
        "chronic_second",
        "SELECT c.* FROM chronic_cand c JOIN chronic_n n ON n.stay_id = c.stay_id JOIN chronic_1 p ON p.stay_id = c.stay_id"
        " WHERE n >= 2 AND substr(c.das, 1, 1) <> substr(p.das, 1, 1)",
    ),
    *picked("chronic_2", "chronic_second", ["stay_id"], ["substr(das, 1, 1)", "das"], "chronic_2", "TRUE", "stay_id, das"),
]

SECONDARY = [
    *SECONDARY_POOLS,
    *CHRONIC,
    ("preset", "SELECT stay_id, unnest(string_split(preset_codes, ',')) AS das, generate_subscripts(string_split(preset_codes, ','), 1) AS pos"
               " FROM stays WHERE preset_codes IS NOT NULL"),
    (
        "cancer_stays",
        "SELECT stay_id FROM stays WHERE is_cancer UNION SELECT stay_id FROM (SELECT * FROM chronic_1 UNION ALL SELECT * FROM chronic_2"
        " UNION ALL SELECT stay_id, das FROM preset) WHERE das IN (SELECT code FROM cancer)",
    ),
    (
        "nodes_cand",
        f"SELECT s.stay_id, p.das, p.w FROM treated s JOIN cancer_stays USING (stay_id) JOIN dp_pools p ON {same(BY_DP, 's', 'p')}"
        " WHERE p.kind = 'Metastasis LN' AND regexp_matches(coalesce(score_tnm, ''), 'N[123x+]')",
    ),
    *picked("nodes_1", "nodes_cand", ["stay_id"], ["substr(das, 1, 1)", "das"], "nodes_1", "TRUE", "stay_id, das"),
    *two_rows(
        "metastases",
        f"SELECT s.stay_id, p.das, sum(p.w)::BIGINT AS w FROM treated s JOIN cancer_stays USING (stay_id) JOIN dp_pools p ON {same(BY_DP, 's', 'p')}"
        " WHERE (coalesce(score_tnm, '') <> '' AND regexp_matches(score_tnm, 'M[123x+]') AND p.kind = 'Metastasis')"
        " OR (coalesce(score_tnm, '') = '' AND p.kind IN ('Metastasis', 'Metastasis LN')) GROUP BY 1, 2",
    ),
    *two_rows("acute", f"SELECT s.stay_id, p.das, p.w FROM stays s JOIN drg_pools p ON {same(BY_DRG, 's', 'p')}"),
    (
        "all_codes",
        "SELECT stay_id, 0 AS stage, pos, das FROM preset UNION ALL "
        + " UNION ALL ".join(
            f"SELECT stay_id, {n}, 0, das FROM {name}"
            for n, name in enumerate(["chronic_1", "chronic_2", "nodes_1", "metastases_1", "metastases_2", "acute_1", "acute_2"], start=1)
        ),
    ),
    (
        "diagnoses",
        "SELECT stay_id, string_agg(das, ',' ORDER BY stage, pos) AS codes, string_agg('- ' || coalesce(label, '') || ' (' || das || ')'"
        " || chr(10), '' ORDER BY stage, pos) AS lines FROM all_codes LEFT JOIN icd_label ON code = das GROUP BY 1",
    ),
]

PROCEDURE = [
    ("proc_rows", "SELECT 'procedure' AS kind, drg_parent_code, icd_primary_code, cage2, sexe, procedure, count(*) AS n FROM case_procedures GROUP BY ALL"),
    pools("proc_pools", "proc_rows", BY_BOTH, "procedure"),
    ("proc_for", f"SELECT s.stay_id, p.procedure, p.w FROM stays s JOIN proc_pools p ON {same(BY_BOTH, 's', 'p')}"),
    *picked("proc", "proc_for", ["stay_id"], ["substr(procedure, 1, 2)", "procedure"], "procedure_1", "TRUE", "stay_id, procedure"),
]

TITLE = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"


def person(name: str, pool: str) -> list[tuple[str, str]]:
    total = f"(SELECT max(total) FROM people_laid p WHERE p.pool = {pool})"
    return [
        (f"at_{name}", f"SELECT stay_id, {pool} AS pool, {below(bits(name, 'stay_id'), total)} AS t FROM stays"),
        (f"got_{name}", f"SELECT stay_id, name AS {name} FROM at_{name} a JOIN people_laid p ON p.pool = a.pool AND a.t >= p.lo AND a.t < p.lo + p.w"),
    ]


PEOPLE = [
    (
        "people",
        f"SELECT pool, name, count(*) AS w FROM (SELECT 'first|' || sexe AS pool, {TITLE.format('prenom')} AS name FROM names WHERE length(prenom) > 3"
        f" UNION ALL SELECT 'last', {TITLE.format('nom')} FROM names WHERE length(nom) > 3"
        " UNION ALL SELECT 'hospital', hospital FROM hospitals) GROUP BY 1, 2",
    ),
    ("people_laid", laid_out("people", ["pool"], [spread("name"), "name"])),
    *person("first_name", "'first|' || sexe"),
    *person("last_name", "'last'"),
    *person("first_name_med", f"'first|' || {between(u('physician_sex', 'stay_id'), 1, 2)}"),
    *person("last_name_med", "'last'"),
    *person("hospital", "'hospital'"),
]

GAUSS = f"sqrt(-2 * ln({u('los_radius', 'stay_id')})) * cos(CAST(2 * pi() AS DOUBLE) * {u('los_angle', 'stay_id')})"
LOW, HIGH = r"TRY_CAST(regexp_extract(trim(cage), '^\[(\d+)-(\d+)\[', 1) AS BIGINT)", r"TRY_CAST(regexp_extract(trim(cage), '^\[(\d+)-(\d+)\[', 2) AS BIGINT)"
OPEN = r"TRY_CAST(regexp_extract(trim(cage), '^\[(\d+)-\[', 1) AS BIGINT)"
AGE = u("age", "stay_id")
DATES = [
    ("calendar", f"SELECT year, weekday_only, CAST(d AS DATE) AS day, CAST(377580 / day(last_day(d)) AS BIGINT) AS w FROM (SELECT unnest([{YEAR - 2}, {YEAR - 1}, {YEAR}]) AS year),"
                 " (SELECT unnest([FALSE, TRUE]) AS weekday_only), (SELECT unnest(generate_series(DATE '2000-01-01', DATE '2099-12-31', INTERVAL 1 DAY)) AS d)"
                 " WHERE year(d) = year AND (NOT weekday_only OR isodow(d) < 6)"),
    ("calendar_laid", laid_out("calendar", ["year", "weekday_only"], ["day"])),
    (
        "stay_facts",
        f"SELECT s.*, los_mean, los_sd, specialty, {YEAR - 2} + {between(u('year', 'stay_id'), 0, 2)} AS year,"
        f" coalesce(age2, CAST(coalesce(floor({AGE} * ({HIGH} - {LOW} + 1)) + {LOW}, floor({AGE} * (90 - {OPEN} + 1)) + {OPEN}) AS INT)) AS age,"
        " coalesce(admission_type = 'Outpatient', FALSE) AS outpatient, coalesce(admission_mode = 'URGENCES', FALSE) AS emergency"
        " FROM stays s LEFT JOIN group_days USING (drg_parent_code) LEFT JOIN group_service USING (drg_parent_code)",
    ),
    (
        "stay_at",
        f"SELECT f.*, CASE WHEN outpatient THEN 0 ELSE coalesce(los, CAST(floor(abs(coalesce(los_mean, 1) + coalesce(los_sd, 1) * {GAUSS})) AS INT)) END AS days,"
        f" {below(bits('entry', 'stay_id'), 'c.total')} AS t, NOT outpatient AND NOT emergency AS weekday_only FROM stay_facts f"
        " JOIN (SELECT DISTINCT year, weekday_only, total FROM calendar_laid) c ON c.year = f.year AND c.weekday_only = (NOT outpatient AND NOT emergency)",
    ),
    (
        "dated",
        "SELECT a.*, c.day AS date_entry, CAST(c.day + a.days AS DATE) AS date_discharge,"
        f" CAST(c.day - 365 * (coalesce(age, 0) + 1) + CAST(floor({u('birth', 'stay_id')} * 366) AS INT) AS DATE) AS date_of_birth"
        " FROM stay_at a JOIN calendar_laid c ON c.year = a.year AND c.weekday_only = a.weekday_only AND a.t >= c.lo AND a.t < c.lo + c.w",
    ),
]

ADMITTED = f"(CASE WHEN admission_type = 'Outpatient' THEN {quoted(V.OUTPATIENT)} ELSE {quoted(V.INPATIENT)} END)"
MODE = "CASE WHEN admission_type = 'Outpatient' THEN 'out' ELSE 'in' END"
MEDICAL, SURGERY = f"'medical_' || {MODE} || 'patient.txt'", f"'surgery_' || {MODE} || 'patient.txt'"
ONCO = f"'medical_' || {MODE} || 'patient_onco.txt'"
BY_CANCER = f"'medical_' || {MODE} || 'patient' || CASE WHEN is_cancer THEN '_onco' ELSE '' END || '.txt'"
PLAIN, OUT = "'medical_inpatient.txt'", "'medical_outpatient.txt'"


def member(column: str, name: str) -> str:
    return f"{column} IN (SELECT code FROM code_sets WHERE set_name = '{name}')"


def phrase(*parts: str) -> str:
    return " || ".join(quoted(S[p]) if p in S else p for p in parts)


def rules() -> list[tuple[str, str, str, str]]:
    """condition, rule, template, situation; first that holds."""
    third, drg, dp, mdp = "substr(drg_parent_code, 3, 1)", "drg_parent_code", "icd_primary_code", "case_management_type"
    group, act, name = "lower(coalesce(about_group, ''))", "lower(text_procedure)", "icd_primary_description"
    by_group, by_act = phrase("care", ADMITTED, "for", group), phrase("care", ADMITTED, "for", act)
    delivery = f"{drg} IN {listed(V.DELIVERY_GROUPS)}"
    section = f"procedure IN {listed(V.CSECTION_PROCEDURES)}"
    before = f"CASE WHEN {u('delivery', 'stay_id')} < 0.85 THEN '_hospit' ELSE '_urg' END || '.txt'"
    chronic = f"{dp} IN (SELECT code FROM chronic_codes)"
    branch = u("chronic_branch", "stay_id")
    main = f"{chronic} AND {mdp} = 'DP'"
    chemo_text = phrase("care", ADMITTED, "chemotherapy") + f" || coalesce({phrase('regimen', 'chemotherapy_regimen')}, '')"
    radio = f"{drg} IN {listed(V.RADIOTHERAPY_GROUPS)}"
    chemo = f"{drg} IN {listed(V.CHEMOTHERAPY_GROUPS)}"
    return [
        (f"histological_type IS NOT NULL AND {third} NOT IN ('C', 'K')", "other", PLAIN, phrase("cancer_care")),
        (member(mdp, "icd_codes_overnight_study"), "D3-1", OUT, phrase("overnight")),
        (member(mdp, "icd_codes_sensitization_tests"), "D3-2", OUT, phrase("sensitization")),
        (f"{drg} = '28Z14'", "T1", OUT, phrase("care_for", group)),
        (f"{drg} = '28Z16'", "T1", OUT, phrase("care_for", group)),
        (f"{dp} = 'R18'", "T2-R18", MEDICAL, phrase("ascites", ADMITTED)),
        (f"{dp} IN {listed(V.PLEURAL_EFFUSION)}", "T2-J9", MEDICAL, phrase("pleural", ADMITTED)),
        (member("procedure", "procedure_botulic_toxin") + " AND admission_type = 'Outpatient'", "T2-Toxine", MEDICAL, phrase("toxin")),
        (f"{dp} IN {listed(V.INTRACTABLE_PAIN)}", "T2-R52", MEDICAL, phrase("pain", ADMITTED)),
        (f"{third} = 'C' AND NOT {delivery}", "T3", SURGERY, by_group),
        (f"{mdp} IN {listed(V.COSMETIC_SURGERY)}", "T4", SURGERY, by_act),
        (f"{mdp} IN {listed(V.PLASTIC_SURGERY)}", "T5", SURGERY, by_act),
        (f"{mdp} = 'Z4180'", "T6", SURGERY, by_act),
        (f"{drg} = '06M17'", "T7", MEDICAL, by_group),
        (f"{dp} = 'C186'", "T8", MEDICAL, by_group),
        (f"{drg} = '23Z02'", "T11", MEDICAL, phrase("care", ADMITTED, "palliative")),
        (member(mdp, "icd_codes_legal_abortion"), "Legal_Abortion", MEDICAL, phrase("legal_abortion")),
        (member(mdp, "icd_codes_medical_abortion"), "Medical_Abortion", MEDICAL, phrase("medical_abortion")),
        (f"{delivery} AND {section}", "T12", f"'delivery_inpatient_csection' || {before}", phrase("csection")),
        (delivery, "T12", f"'delivery_inpatient' || {before}", phrase("vaginal")),
        (f"{drg} = '04M24' OR discharge_disposition = 'DECES'", "", PLAIN, phrase("deceased")),
        (f"{chronic} AND {mdp} = 'Z512'", "T1", MEDICAL, phrase("care", ADMITTED, "drug")),
        (f"{chronic} AND {radio}", "T1", ONCO, phrase("care", ADMITTED, "radiotherapy")),
        (f"{main} AND {branch} < 0.4", "D1", BY_CANCER, phrase("first_stay", ADMITTED, "discovery", name)),
        (f"{main} AND {branch} < 0.6", "D9", BY_CANCER, phrase("stay", ADMITTED, "work_up", name)),
        (f"{main} AND is_cancer", "D5", BY_CANCER, phrase("stay", ADMITTED, "relapse", name)),
        (f"{main} AND " + member(dp, "icd_codes_diabetes_chronic"), "D5", BY_CANCER, phrase("stay", ADMITTED, "strategy", name)),
        (f"{main} AND substr({dp}, 1, 3) NOT IN ('E05', 'J45', 'K85')", "D5", BY_CANCER, phrase("stay", ADMITTED, "flare", name)),
        (
            f"{chronic} AND {mdp} <> 'DP' AND " + member(mdp, "icd_codes_supervision_chronic_disease"),
            "S1-Chronic",
            BY_CANCER,
            phrase("supervision", ADMITTED, "of", name),
        ),
        (f"{chronic} AND {chemo}", "T1", ONCO, chemo_text),
        (chronic, "", PLAIN, "''"),
        (f"{mdp} = 'DP'", "other", BY_CANCER, phrase("main_diagnosis", ADMITTED)),
        ("TRUE", "other", BY_CANCER, phrase("other_care", ADMITTED, "for", "mdp_description")),
    ]


def decided() -> str:
    numbered = list(enumerate(rules()))
    which = "CASE " + " ".join(f"WHEN {rule[0]} THEN {n}" for n, rule in numbered) + " END"
    outs = []
    for name, index in (("coding_rule", 1), ("template_name", 2), ("situa", 3)):
        arms = " ".join(f"WHEN {n} THEN {quoted(rule[1]) if index == 1 else rule[index]}" for n, rule in numbered)
        outs.append(f"CASE rule_no {arms} END AS {name}")
    return f"SELECT *, {', '.join(outs)} FROM (SELECT *, {which} AS rule_no FROM described)"


CARE = [
    (
        "described",
        "SELECT t.*, coalesce(p.procedure, '') AS procedure, coalesce(pl.label, '') AS text_procedure, about_group,"
        " coalesce(dl.label, '') AS icd_primary_description, coalesce(ml.label, '') AS mdp_description FROM treated t"
        " LEFT JOIN proc p USING (stay_id) LEFT JOIN procedure_label pl ON pl.code = p.procedure"
        " LEFT JOIN group_text USING (drg_parent_code) LEFT JOIN icd_label dl ON dl.code = t.icd_primary_code"
        " LEFT JOIN icd_label ml ON ml.code = t.case_management_type",
    ),
    ("decided", decided()),
]

COHORT = [*SETS, *STAYS, *FACTS, *TREATMENT, *SECONDARY, *PROCEDURE, *PEOPLE, *DATES, *CARE]

WHOLE = (
    "whole",
    f"SELECT d.stay_id, {generation_id('d.stay_id')} AS generation_id, e.age, d.sexe, strftime(date_entry, '%Y-%m-%d') AS date_entry,"
    " strftime(date_discharge, '%Y-%m-%d') AS date_discharge, strftime(date_of_birth, '%Y-%m-%d') AS date_of_birth, first_name, last_name,"
    " d.drg_parent_code, d.icd_primary_code, d.icd_primary_description, d.is_cancer, d.case_management_type, coalesce(codes, '') AS icd_secondary_code,"
    " coalesce(lines, '') AS text_secondary_icd_official, procedure, text_procedure, d.admission_mode, d.discharge_disposition, cancer_stage,"
    " score_tnm, histological_type, treatment_recommandation, chemotherapy_regimen, biomarkers, specialty AS department, hospital,"
    " first_name_med, last_name_med, situa, coding_rule, template_name"
    " FROM decided d JOIN dated e USING (stay_id) LEFT JOIN diagnoses USING (stay_id) LEFT JOIN got_first_name USING (stay_id)"
    " LEFT JOIN got_last_name USING (stay_id) LEFT JOIN got_first_name_med USING (stay_id) LEFT JOIN got_last_name_med USING (stay_id)"
    " LEFT JOIN got_hospital USING (stay_id)",
)

RULE_TEXT = ("rule_text", "SELECT id, max_by(text, ordinal) AS text FROM rule_rows GROUP BY id")


def prompt_sql() -> str:
    nl = "chr(10)"

    def row(key: str, value: str, end: str = nl) -> str:
        return f"coalesce({quoted(PROMPT[key])} || {value} || {end}, '')"

    def day(name: str) -> str:
        return f"strftime(CAST({name} AS DATE), '%d/%m/%Y')"

    def cancer(text: str) -> str:
        return f"CASE WHEN is_cancer THEN {text} ELSE '' END"

    coded = "coalesce(icd_primary_description, '') || ' (' || coalesce(icd_primary_code, '') || ')'"
    surgical = "substr(drg_parent_code, 3, 1) IN ('C', 'K')"
    parts = [
        quoted(PROMPT["title"]),
        row("age", "age", quoted(PROMPT["years"])),
        row("sex", "CASE WHEN sexe = 1 THEN 'Masculin' WHEN sexe IS NOT NULL THEN 'Féminin' END"),
        row("entry", day("date_entry")),
        row("discharge", day("date_discharge")),
        row("birth", day("date_of_birth")),
        row("last_name", "last_name"),
        row("first_name", "first_name"),
        cancer(row("site", coded)),
        cancer(row("histology", f"coalesce(histological_type, {quoted(PROMPT['histology_free'])})")),
        cancer(row("tnm", f"coalesce(score_tnm, {quoted(PROMPT['tnm_free'])})")),
        cancer(row("stage", "cancer_stage")),
        cancer(row("biomarkers", f"coalesce(biomarkers, {quoted(PROMPT['biomarkers_free'])})")),
        row("admission", "admission_mode"),
        row("disposition", "discharge_disposition"),
        f"CASE WHEN case_management_type IS NULL THEN '' ELSE {quoted(PROMPT['context'])} || situa || '. ' || coalesce(text, '') || {nl}"
        f" || {quoted(PROMPT['coding'])} || {quoted(PROMPT['main'])} || {coded} || {nl} || {quoted(PROMPT['associated'])}"
        f" || text_secondary_icd_official || {nl} END",
        f"CASE WHEN {surgical} THEN {quoted(PROMPT['procedure'])} || lower(text_procedure) || {nl} ELSE '' END",
        row("physician", "first_name_med || ' ' || coalesce(last_name_med, '')"),
        row("department", "department"),
        row("hospital", "hospital"),
        cancer(quoted(PROMPT["cancer_case"])),
        f"CASE WHEN is_cancer AND histological_type IS NOT NULL THEN {quoted(PROMPT['episode'])} || "
        + row("recommendation", "coalesce(treatment_recommandation, '')")
        + " || "
        + row("regimen", "chemotherapy_regimen")
        + " ELSE '' END",
        cancer(quoted(PROMPT["precise"])),
    ]
    return f"SELECT stay_id, generation_id, {' || '.join(parts)} AS scenario FROM whole LEFT JOIN rule_text ON id = coding_rule"


TEXTS = [*COHORT, WHOLE, RULE_TEXT, ("prompts", prompt_sql())]


def profile_checks() -> dict[str, str]:
    start = [*SETS, *STAYS]
    return {
        "draw_profiles": with_views(INPUTS, *start, final="SELECT * FROM stays"),
        "draw_cancer_treatment": with_views(
            INPUTS, *start, *TREATMENT, final=f"SELECT stay_id, histological_type, score_tnm, cancer_stage, biomarkers, treatment_recommandation, chemotherapy_regimen FROM treated"
        ),
        "draw_secondary_diagnoses": with_views(
            INPUTS, *start, *TREATMENT, *SECONDARY,
            final="SELECT stay_id, coalesce(codes, '') AS icd_secondary_code, coalesce(lines, '') AS text_secondary_icd_official FROM stays LEFT JOIN diagnoses USING (stay_id)",
        ),
        "draw_stay_procedure": with_views(
            INPUTS, *start, *PROCEDURE,
            final="SELECT stay_id, coalesce(procedure, '') AS procedure, coalesce(label, '') AS text_procedure FROM stays LEFT JOIN proc USING (stay_id)"
            " LEFT JOIN procedure_label ON code = procedure",
        ),
        "draw_dates_and_age": with_views(
            INPUTS, *start, *FACTS, *DATES,
            final="SELECT stay_id, age, strftime(date_entry, '%Y-%m-%d') AS date_entry, strftime(date_discharge, '%Y-%m-%d') AS date_discharge,"
            " strftime(date_of_birth, '%Y-%m-%d') AS date_of_birth FROM dated",
        ),
        "draw_people": with_views(
            INPUTS, *start, *PEOPLE,
            final="SELECT stay_id, first_name, last_name, first_name_med, last_name_med, hospital FROM stays LEFT JOIN got_first_name USING (stay_id)"
            " LEFT JOIN got_last_name USING (stay_id) LEFT JOIN got_first_name_med USING (stay_id) LEFT JOIN got_last_name_med USING (stay_id)"
            " LEFT JOIN got_hospital USING (stay_id)",
        ),
        "care_management": with_views(
            INPUTS, *start, *FACTS, *TREATMENT, *PROCEDURE, *CARE, final="SELECT stay_id, situa, coding_rule, template_name FROM decided"
        ),
        "profile_cohort": with_views(INPUTS, *COHORT, WHOLE, final="SELECT * FROM whole"),
        "long_scenario_text": with_views(INPUTS, *TEXTS, final="SELECT generation_id, scenario FROM prompts"),
    }
