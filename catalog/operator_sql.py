"""Checks of the single-operator queries."""

from __future__ import annotations

from casemill.standins import with_views
from catalog import profile_sql as P, table_sql as T
from catalog.sql import below, between, bits, generation_id, laid_out, spread, u

MEMBERS = [
    *P.SETS,
    (
        "members",
        "SELECT set_name, code FROM code_sets UNION SELECT 'cancer', code FROM cancer UNION SELECT 'chronic', code FROM chronic_codes",
    ),
]


def simple(views: list[str], sql: str) -> str:
    return with_views(views, final=sql)


def cohort(sql: str, *ctes) -> str:
    return with_views(P.INPUTS, *P.SETS, *P.STAYS, *ctes, final=sql)


POOL_NAMES = [
    "'1|' || GHM5 || '|' || AGE || '|' || SEXE || '|' || DP",
    "'2|' || GHM5 || '|' || SEXE || '|' || DP",
    "'3|' || GHM5 || '|' || DP",
    "'4|' || GHM5 || '|' || substr(DP, 1, 3)",
    "'5|' || GHM5",
]

LEVEL_MATCH = [
    "p.AGE = s.AGE AND p.SEXE = s.SEXE AND p.DP = s.DP",
    "p.SEXE = s.SEXE AND p.DP = s.DP",
    "p.DP = s.DP",
    "substr(p.DP, 1, 3) = substr(s.DP, 1, 3)",
    "TRUE",
]
LEVEL_KEYS = [["AGE", "SEXE", "DP"], ["SEXE", "DP"], ["DP"], ["substr(DP, 1, 3)"], []]


def cascade_sql() -> str:
    """Categories and mass of each profile's five pools, then the first pool with enough categories."""
    parts = []
    for n, (match, key) in enumerate(zip(LEVEL_MATCH, LEVEL_KEYS), start=1):
        named = ", ".join(["GHM5", *[f"{k} AS k{i}" for i, k in enumerate(key)]])
        on = " AND ".join(["x.GHM5 = s.GHM5", *[f"x.k{i} = {'substr(s.DP, 1, 3)' if 'substr' in k else 's.' + k}" for i, k in enumerate(key)]])
        pool = f"SELECT {named}, CAST(sum(P_DAS) AS BIGINT) AS total, count(DISTINCT substr(DAS, 1, 2)) AS cats FROM pmsi_das GROUP BY ALL"
        grouped = pool.replace("GROUP BY ALL", "GROUP BY " + ", ".join(str(i + 1) for i in range(len(key) + 1)))
        parts.append(f"SELECT s.*, {n} AS lvl, x.total, x.cats FROM profiles s JOIN ({grouped}) x ON {on}")
    key = "'=' || GHM5 || '|=' || DP || '|=' || AGE || '|=' || SEXE"
    found = " UNION ALL ".join(parts)
    return with_views(
        ["pmsi_dp", "pmsi_das"],
        T.STAYS[0],
        ("found", found),
        final=f"SELECT {key} AS profile_key, pick, lvl, total FROM found JOIN (SELECT unnest([1, 2, 3]) AS pick) ON cats >= pick"
        " QUALIFY row_number() OVER (PARTITION BY GHM5, DP, AGE, SEXE, pick ORDER BY lvl) = 1",
    )


def weighted_rows() -> str:
    """Acute draws where each row weighs its count: one row leaves the pool after the first pick."""
    key = P.BY_DRG
    order = ["substr(das, 1, 1)", "das", "unit"]
    rows = (
        "SELECT drg_parent_code, cage2, sexe, icd_secondary_code AS das, nb AS unit FROM case_secondary"
        f" WHERE icd_secondary_code NOT IN {P.listed(P.V.DISTANT_METASTASES)} AND icd_secondary_code NOT IN {P.listed(P.V.LYMPH_NODE_METASTASES)}"
        " AND icd_secondary_code NOT IN (SELECT code FROM cancer) AND icd_secondary_code NOT IN (SELECT code FROM chronic_codes)"
    )
    names = ", ".join(f"k.{c}" for c in key)
    ctes = [
        ("acute_rows", rows),
        (
            "acute_pool",
            f"SELECT {names}, r.das, r.unit, count(*) AS n FROM (SELECT DISTINCT {', '.join(key)} FROM stays) k JOIN acute_rows r"
            f" ON {P.agrees(key)} GROUP BY ALL",
        ),
        ("cand", f"SELECT s.stay_id, p.das, p.unit, p.n, p.n * p.unit AS w FROM stays s JOIN acute_pool p ON {P.same(key, 's', 'p')}"),
        (
            "wanted",
            f"SELECT stay_id, CAST(floor({u('acute_count', 'stay_id')} * (least(rows_in, 2) + 1)) AS BIGINT) AS picks"
            " FROM (SELECT stay_id, sum(n) AS rows_in FROM cand GROUP BY 1)",
        ),
        ("one", "SELECT c.* FROM cand c JOIN wanted USING (stay_id) WHERE picks >= 1"),
        *P.picked("first_pick", "one", ["stay_id"], order, "acute_1", "TRUE", "stay_id, das, unit"),
        (
            "two",
            "SELECT c.stay_id, c.das, c.unit, c.w - CASE WHEN c.das = f.das AND c.unit = f.unit THEN c.unit ELSE 0 END AS w FROM cand c"
            " JOIN wanted USING (stay_id) JOIN first_pick f ON f.stay_id = c.stay_id"
            " WHERE picks >= 2 AND c.w > CASE WHEN c.das = f.das AND c.unit = f.unit THEN c.unit ELSE 0 END",
        ),
        *P.picked("second_pick", "two", ["stay_id"], order, "acute_2", "TRUE", "stay_id, das"),
    ]
    return cohort(
        "SELECT s.stay_id, f.das AS first_code, g.das AS second_code FROM stays s LEFT JOIN first_pick f USING (stay_id)"
        " LEFT JOIN second_pick g USING (stay_id)",
        *ctes,
    )


def operator_checks() -> dict[str, str]:
    both = "SELECT s.stay_id, f.das AS first_code, g.das AS second_code FROM stays s LEFT JOIN {0}_1 f USING (stay_id) LEFT JOIN {0}_2 g USING (stay_id)"
    acute = [*P.SECONDARY_POOLS, *P.two_rows("acute", f"SELECT s.stay_id, p.das, p.w FROM stays s JOIN drg_pools p ON {P.same(P.BY_DRG, 's', 'p')}")]
    line_id = "concat_ws('-', l_orderkey, l_linenumber, p_partkey, l_suppkey, qty)"
    phrase_t = below(bits("phrase", line_id, "icd_secondary_code"), "total")
    procedures = dict(T.procedures())
    checks = {
        "filter_active_codes": simple(["cim10"], "SELECT code, max(liblong) AS label FROM cim10 WHERE en_cours = 1 GROUP BY code"),
        "filter_group_roots": simple(["rghm"], dict(T.CODE_LABELS)["ghm_labels"]),
        "filter_group_pattern": simple(
            ["pmsi_dp"],
            "SELECT AGE AS age, SEXE AS sexe, GHM5 AS ghm5, DP AS dp, CAST(sum(P_DP) AS BIGINT) AS w FROM pmsi_dp"
            " WHERE regexp_matches(GHM5, '^0[1-5]C') AND DP IS NOT NULL GROUP BY ALL",
        ),
        "filter_missing_codes": simple(
            ["pmsi_dp"], "SELECT GHM5 AS ghm5, CAST(sum(P_DP) AS BIGINT) AS w FROM pmsi_dp WHERE GHM5 IS NOT NULL AND DP IS NOT NULL GROUP BY 1"
        ),
        "surgical_tests": simple(
            ["part_codes"],
            "SELECT p_partkey, CAST(contains(ghm5, 'C') OR contains(ghm5, 'K') AS INT) AS any_ck, CAST(ghm5[3] IN ('C', 'K') AS INT) AS third_ck,"
            " CAST(ghm5[3] = 'C' AS INT) AS third_c FROM part_codes",
        ),
        "project_shared_columns": simple(
            ["case_secondary"], "SELECT drg_parent_code, icd_secondary_code, cage2, sexe, CAST(sum(nb) AS BIGINT) AS nb FROM case_secondary GROUP BY ALL"
        ),
        "type_secondary_codes": with_views(
            P.INPUTS, *P.SETS, P.SECONDARY_POOLS[0],
            final="SELECT das AS icd_secondary_code, kind AS type, CAST(sum(s.nb) AS BIGINT) AS nb FROM (SELECT DISTINCT das, kind FROM sec_rows)"
            " JOIN case_secondary s ON s.icd_secondary_code = das GROUP BY ALL",
        ),
        "filter_pool_by_type": with_views(
            P.INPUTS, *P.SETS, P.SECONDARY_POOLS[0],
            final="SELECT pool AS kind, icd_primary_code, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT *, 1 AS one FROM (SELECT icd_primary_code, kind,"
            " (SELECT NULL) AS x, count(*) AS n FROM (SELECT c.icd_primary_code, k.kind FROM case_secondary c JOIN (SELECT DISTINCT das, kind FROM sec_rows) k"
            " ON k.das = c.icd_secondary_code) GROUP BY 1, 2)) JOIN (VALUES ('Chronic', 'chronic'), ('Chronic', 'chronic_or_cancer'), ('Cancer', 'chronic_or_cancer'),"
            " ('Metastasis LN', 'nodes'), ('Metastasis LN', 'any_metastasis'), ('Metastasis', 'distant'), ('Metastasis', 'any_metastasis')) v(type, pool)"
            " ON v.type = kind GROUP BY 1, 2",
        ),
        "eligible_names": with_views(P.INPUTS, *P.PEOPLE[:2], final="SELECT pool, name, lo, lo + w AS hi, total FROM people_laid"),
        "keep_raw_codes": with_views(
            T.INPUTS, *T.STAYS, *T.CODE_LABELS,
            final="SELECT coalesce(label, GHM5) AS label, GHM5 AS code, count(*) AS n FROM stays LEFT JOIN ghm_labels ON code = GHM5 GROUP BY 1, 2",
        ),
        "parent_codes": simple(["stay_lines"], "SELECT substr(dp, 1, 3) AS parent, count(DISTINCT dp) AS codes FROM stay_lines GROUP BY 1"),
        "title_names": simple(
            ["names"], f"SELECT {P.TITLE.format('nom')} AS nom, {P.TITLE.format('prenom')} AS prenom FROM names"
        ),
        "group_facts": with_views(
            P.INPUTS, *P.FACTS,
            final="SELECT drg_parent_code, about_group AS drg_parent_description, los_mean, los_sd, specialty FROM (SELECT DISTINCT drg_parent_code"
            " FROM case_lines) LEFT JOIN group_text USING (drg_parent_code) LEFT JOIN group_days USING (drg_parent_code)"
            " LEFT JOIN group_service USING (drg_parent_code)",
        ),
        "label_or_code": with_views(
            ["cim10", "stay_lines"], T.CODE_LABELS[0],
            final="SELECT l_orderkey, l_linenumber, p_partkey, coalesce(label, dp) AS label FROM stay_lines LEFT JOIN dp_labels ON code = dp",
        ),
        "display_of_code": with_views(
            ["cim10", "pmsi_das"], T.CODE_LABELS[0],
            final=f"SELECT DAS AS das, n, {T.shown('label', 'DAS')} AS shown FROM (SELECT DAS, CAST(sum(P_DAS) AS BIGINT) AS n FROM pmsi_das GROUP BY 1)"
            " LEFT JOIN dp_labels ON code = DAS",
        ),
        "label_or_blank": with_views(
            P.INPUTS, P.SETS[2],
            final="SELECT case_management_type, coalesce(label, '') AS description, count(*) AS n FROM case_lines LEFT JOIN icd_label"
            " ON code = case_management_type GROUP BY 1, 2",
        ),
        "procedure_cascade": with_views(
            T.INPUTS, ("stays", "SELECT DISTINCT ghm5 AS GHM5, dp AS DP FROM stay_lines"),
            *[(n, procedures[n]) for n in ("proc_found", "proc_level", "proc_top")],
            final="SELECT GHM5 AS ghm5, DP AS dp, lvl, string_agg(CCAM || ':' || w, ',' ORDER BY rank) AS pool FROM proc_top GROUP BY 1, 2, 3",
        ),
        "diagnosis_cascade": cascade_sql(),
        "stay_length_parameters": with_views(
            T.INPUTS, T.days()[0],
            final="SELECT p.ghm5, lft, mode, rgt FROM (SELECT DISTINCT ghm5 FROM part_codes) p LEFT JOIN shape ON shape.GHM5 = p.ghm5",
        ),
        "match_profile_wildcards": with_views(
            P.INPUTS, ("stays", "SELECT DISTINCT drg_parent_code, icd_primary_code, cage2, sexe FROM case_profiles"), *P.PROCEDURE[:2],
            final="SELECT s.drg_parent_code, s.icd_primary_code, s.cage2, s.sexe, CAST(coalesce(sum(p.w), 0) AS BIGINT) AS n_rows FROM stays s"
            f" LEFT JOIN proc_pools p ON {P.same(P.BY_BOTH, 's', 'p')} GROUP BY ALL",
        ),
        "code_set_membership": with_views(
            P.INPUTS, *MEMBERS,
            final="SELECT case_management_type, set_name, count(*) AS n FROM case_lines JOIN members ON code = case_management_type GROUP BY 1, 2",
        ),
        "rows_with_set_codes": with_views(
            P.INPUTS, *P.SETS,
            final="SELECT l_orderkey, l_linenumber, p_partkey, icd_primary_code AS code FROM case_lines WHERE icd_primary_code IN (SELECT code FROM cancer)",
        ),
        "join_rule_text": cohort(
            "SELECT stay_id, coding_rule, coalesce(text, '') AS rule_text FROM decided LEFT JOIN rule_text ON id = coding_rule",
            *P.FACTS, *P.TREATMENT, *P.PROCEDURE, *P.CARE, P.RULE_TEXT,
        ),
        "procedure_weights": simple(
            ["pmsi_ccam"], "SELECT GHM5 AS ghm5, substr(DP, 1, 3) AS dp3, CCAM AS ccam, CAST(sum(P_CCAM) AS BIGINT) AS w FROM pmsi_ccam GROUP BY 1, 2, 3"
        ),
        "diagnosis_pool_totals": simple(
            ["pmsi_das"],
            " UNION ALL ".join(
                f"SELECT {name} AS pool, CAST(sum(P_DAS) AS BIGINT) AS total, count(DISTINCT DAS) AS codes,"
                " count(DISTINCT substr(DAS, 1, 2)) AS categories FROM pmsi_das GROUP BY 1"
                for name in POOL_NAMES
            ),
        ),
        "main_specialty": with_views(P.INPUTS, P.FACTS[2], final="SELECT * FROM group_service"),
        "synonym_phrases": simple(["icd_synonyms"], "SELECT icd_code, icd_code_description, count(*) AS copies FROM icd_synonyms GROUP BY 1, 2"),
        "pools_with_mass": simple(
            ["pmsi_ccam"],
            "SELECT GHM5 AS ghm5, DP AS dp, CAST(sum(CASE WHEN substr(CCAM, 7, 1) < '3' THEN P_CCAM ELSE 0 END) AS BIGINT) AS mass FROM pmsi_ccam"
            " WHERE DP IS NOT NULL GROUP BY 1, 2 HAVING sum(CASE WHEN substr(CCAM, 7, 1) < '3' THEN P_CCAM ELSE 0 END) > 0",
        ),
        "normalised_weights": simple(
            ["case_profiles"],
            "SELECT drg_parent_code, w, CAST(w AS DOUBLE) / CAST(sum(w) OVER () AS BIGINT) AS p FROM (SELECT drg_parent_code,"
            " CAST(sum(coalesce(nb, 1)) AS BIGINT) AS w FROM case_profiles GROUP BY 1)",
        ),
        "top_procedures": simple(
            ["pmsi_ccam"],
            "SELECT GHM5 AS ghm5, CCAM AS ccam, CAST(sum(P_CCAM) AS BIGINT) AS w, row_number() OVER (PARTITION BY GHM5 ORDER BY sum(P_CCAM) DESC, CCAM) AS rank"
            " FROM pmsi_ccam GROUP BY 1, 2 QUALIFY rank <= 5",
        ),
        "cancer_code_set": with_views(P.INPUTS, P.SETS[0], final="SELECT code FROM cancer"),
        "chronic_code_set": with_views(P.INPUTS, *P.SETS[:2], final="SELECT code FROM chronic_codes"),
        "distinct_codes": simple(["case_profiles"], "SELECT DISTINCT icd_primary_code AS code FROM case_profiles WHERE icd_primary_code IS NOT NULL"),
        "orders_with_cancer_code": with_views(
            P.INPUTS, *P.SETS,
            final="SELECT l_orderkey, max(CAST(icd_secondary_code IN (SELECT code FROM cancer) AS INT)) AS any_cancer FROM case_lines GROUP BY 1",
        ),
        "draw_counts": f"SELECT o_orderkey AS stay_id, {between(u('ccam_count', 'o_orderkey'), 1, 3)} AS n_ccam,"
        f" {between(u('das_count', 'o_orderkey'), 0, 3)} AS n_das FROM orders",
        "draw_conditional_uniform": cohort(both.format("acute"), *acute),
        "draw_conditional_weighted": weighted_rows(),
        "draw_distinct_chapters": cohort(both.format("chronic"), *P.SECONDARY_POOLS, *P.CHRONIC),
        "draw_normal_days": cohort(
            f"SELECT stay_id, CAST(floor(abs(coalesce(los_mean, 1) + coalesce(los_sd, 1) * {P.GAUSS})) AS INT) AS days"
            " FROM stays LEFT JOIN group_days USING (drg_parent_code)",
            P.FACTS[1],
        ),
        "draw_day_of_year": with_views(
            [], *P.DATES[:2],
            (
                "asked",
                f"SELECT o_orderkey AS stay_id, o_orderstatus = 'O' AS weekday_only, {P.YEAR - 2} + {between(u('year', 'o_orderkey'), 0, 2)} AS year FROM orders",
            ),
            final=f"SELECT stay_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT *, {below(bits('entry', 'stay_id'), 'total')} AS t FROM asked"
            " JOIN calendar_laid USING (year, weekday_only)) WHERE t >= lo AND t < lo + w",
        ),
        "draw_day_between": "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(floor("
        + u("between", "o_orderkey") + " * (o_custkey % 60 + 1)) AS INT), '%Y-%m-%d') AS day FROM orders",
        "draw_synonym": with_views(
            [*P.INPUTS, "icd_synonyms"], P.SETS[2],
            (
                "phrases",
                "SELECT icd_code, icd_code_description, count(*) AS w FROM icd_synonyms WHERE icd_code NOT IN"
                f" {P.listed(P.V.DISTANT_METASTASES)} OR contains(lower(icd_code_description), 'metastase') GROUP BY 1, 2",
            ),
            ("phrases_laid", laid_out("phrases", ["icd_code"], [spread("icd_code_description"), "icd_code_description"])),
            (
                "asked",
                f"SELECT {line_id} AS line_id, icd_secondary_code, {phrase_t} AS t FROM case_lines LEFT JOIN (SELECT DISTINCT icd_code, total"
                " FROM phrases_laid) x ON x.icd_code = icd_secondary_code",
            ),
            final="SELECT line_id, icd_secondary_code, coalesce(icd_code_description, label, '') AS phrase FROM asked a LEFT JOIN phrases_laid p"
            " ON p.icd_code = a.icd_secondary_code AND a.t >= p.lo AND a.t < p.lo + p.w LEFT JOIN icd_label ON code = a.icd_secondary_code",
        ),
        "draw_age": cohort(
            f"SELECT stay_id, cage, CAST(coalesce(floor({P.AGE} * ({P.HIGH} - {P.LOW} + 1)) + {P.LOW}, floor({P.AGE} * (90 - {P.OPEN} + 1)) + {P.OPEN}) AS INT)"
            " AS age FROM stays"
        ),
        "draw_branches": f"SELECT o_orderkey AS stay_id, CASE WHEN {u('delivery', 'o_orderkey')} < 0.85 THEN '_hospit' ELSE '_urg' END AS delivery,"
        f" CASE WHEN {u('chronic_branch', 'o_orderkey')} < 0.4 THEN 'D1' WHEN {u('chronic_branch', 'o_orderkey')} < 0.6 THEN 'D9' ELSE 'D5' END AS chronic FROM orders",
        "generation_ids": f"SELECT o_orderkey AS stay_id, {generation_id('o_orderkey')} AS generation_id FROM orders",
        "sex_labels": simple(
            ["case_lines"], "SELECT sexe, CASE WHEN sexe = 1 THEN 'Masculin' ELSE 'Féminin' END AS label, count(*) AS n FROM case_lines GROUP BY 1"
        ),
        "secondary_lines": with_views(
            P.INPUTS, P.SETS[2],
            final="SELECT '- ' || coalesce(label, '') || ' (' || icd_secondary_code || ')' || chr(10) AS line, count(*) AS n FROM case_secondary"
            " LEFT JOIN icd_label ON code = icd_secondary_code GROUP BY 1",
        ),
        "stay_records": simple(
            ["case_profiles"],
            "SELECT age2 AS age, sexe, CAST(los AS BIGINT) AS los, CAST(NULL AS VARCHAR) AS hospital, admission_mode, coalesce(preset_codes, '') AS codes,"
            " count(*) AS n FROM case_profiles GROUP BY ALL",
        ),
    }
    return {**checks, "sql_ages": checks["draw_age"], "sql_days_between": checks["draw_day_between"], "sql_triangular_days": T.table_checks()["draw_triangular_days"]}
