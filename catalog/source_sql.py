"""Checks of the source and sink queries: the rows that were written."""

from __future__ import annotations

from casemill import fixed_values as V
from casemill.standins import with_views
from catalog import table_sql as T

SYSTEM = "Rédige un compte rendu."


def simple(views: list[str], sql: str) -> str:
    return with_views(views, final=sql)


def texts(sql: str) -> str:
    return with_views(T.INPUTS, *T.COHORT, final=sql)


def registry_sql() -> str:
    from catalog.source_queries import FILLED_LISTS

    views = [
        "icd_official", "drg_statistics", "drg_parents_groups", "chronic", "specialty", "procedure_official", "cancer_codes", "cancer_treatment",
    ]
    counts = [f"SELECT '{v}' AS name, count(*) AS n FROM {v}" for v in views]
    counts += [
        "SELECT 'names', count(*) FROM names",
        "SELECT 'hospitals', count(*) FROM hospitals",
        "SELECT 'icd_synonyms', count(*) FROM icd_synonyms WHERE substr(icd_code, 1, 1) <> 'A'",
        "SELECT 'icd_categ_weight', count(*) FROM part",
        "SELECT 'complications', count(DISTINCT icd_secondary_code) FROM case_secondary",
        "SELECT 'exclusions', count(DISTINCT drg_parent_code) FROM case_lines",
        "SELECT 'profiles', count(*) FROM case_profiles",
        "SELECT 'secondary_icd', count(*) FROM case_secondary",
        "SELECT 'procedures', count(*) FROM case_procedures",
    ]
    others = len(V.CODE_LIST_FILES) - len(FILLED_LISTS)
    counts.append(f"SELECT 'code_sets', (SELECT count(*) FROM code_sets) + {others} * (SELECT count(*) FROM case_codes WHERE code IS NOT NULL)")
    inputs = [*views, "names", "hospitals", "icd_synonyms", "case_secondary", "case_lines", "case_profiles", "case_procedures", "code_sets", "case_codes"]
    return with_views(inputs, final=" UNION ALL ".join(counts))


def source_checks() -> dict[str, str]:
    quoted = SYSTEM.replace("'", "''")
    prompts = "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) || chr(10) AS system_prompt FROM conversations GROUP BY 1"
    return {
        "source_csv_ingest": simple(["icd_official"], "SELECT icd_code AS code, icd_code_description AS liblong, 1 AS en_cours FROM icd_official"),
        "source_table_views": simple(
            ["pmsi_dp", "pmsi_das", "pmsi_ccam", "pmsi_dms", "rghm", "icd_official", "ccam_ref"],
            " UNION ALL ".join(
                f"SELECT '{name}' AS name, count(*) AS n, CAST(round(4 * sum({mass})) AS BIGINT) AS mass FROM {table}"
                for name, table, mass in [
                    ("dp", "pmsi_dp", "P_DP"), ("das", "pmsi_das", "P_DAS"), ("ccam", "pmsi_ccam", "P_CCAM"), ("dms", "pmsi_dms", "DMS_P50"),
                    ("rghm", "rghm", "length(lib)"), ("cim10", "icd_official", "length(icd_code_description)"), ("ccam_ref", "ccam_ref", "length(liblong)"),
                ]
            ),
        ),
        "source_code_lists": simple(["code_sets"], "SELECT set_name, code FROM code_sets"),
        "source_complete_rows": simple(["icd_synonyms"], "SELECT icd_code, icd_code_description FROM icd_synonyms WHERE substr(icd_code, 1, 1) <> 'A'"),
        "source_one_column": simple(["hospitals"], "SELECT hospital FROM hospitals"),
        "source_decimal_comma": "SELECT 'P' || p_partkey AS icd_code, p_retailprice AS weight FROM part",
        "source_parquet_renamed": simple(
            ["cancer_treatment"],
            "SELECT icd_parent_code, primary_site, histological_type, TNM AS tnm, stage, biomarkers, treatment_recommandation, chemotherapy_regimen"
            " FROM cancer_treatment",
        ),
        "source_latest_file": simple(
            ["case_procedures"],
            "SELECT procedure, drg_parent_code, sexe, CAST(sum(nb) AS BIGINT) AS nb FROM case_procedures WHERE sexe = 2 GROUP BY 1, 2, 3",
        ),
        "source_tolerant_rename": simple(
            ["case_lines"], "SELECT drg_parent_code, icd_secondary_code, CAST(sum(qty) AS BIGINT) AS other FROM case_lines GROUP BY 1, 2"
        ),
        "source_registry": registry_sql(),
        "source_dictionary": simple(
            ["icd_official"],
            "SELECT icd_code, '0' AS aut_mco, 'O' AS pos, '0' AS aut_ssr, substr(icd_code_description, 1, 9) AS icd_code_description_short,"
            " icd_code_description FROM icd_official",
        ),
        "source_rule_file": simple(
            ["rule_rows"], "SELECT id, arg_max(text, ordinal) AS text, id AS primary_diagnosis, max(ordinal) AS ordinal FROM rule_rows GROUP BY id"
        ),
        "source_templates": f"WITH prompts AS ({prompts}) SELECT conv_id, turn, 'system' AS role, system_prompt AS content FROM conversations"
        " JOIN prompts USING (conv_id) WHERE role = 'user'"
        " UNION ALL SELECT conv_id, turn, 'user', text FROM conversations WHERE role = 'user'",
        "build_messages": texts(
            f"SELECT generation_id, 'system' AS role, '{quoted}' AS content FROM texts UNION ALL SELECT generation_id, 'user', scenario FROM texts"
        ),
        "generate_reports": texts(
            f"SELECT generation_id, scenario, 'stub ' || length('{quoted}') || ' ' || length(scenario) AS report, 'stub' AS model FROM texts"
        ),
        "sink_reports": "SELECT count(*) AS n_rows, 0 AS too_long FROM orders",
        "sink_batches": texts(
            f"""SELECT generation_id, 'stub ' || length('{quoted}') || ' ' || length(scenario) AS report,
            CASE WHEN generation_id < '8' THEN 'low' ELSE 'high' END AS batch FROM texts"""
        ),
        "source_rescued_rows": """
            WITH lines AS (
                SELECT p_partkey, p_brand, CAST(p_retailprice AS DOUBLE) AS p, CASE WHEN p_partkey % 7 = 0 THEN 'cher' ELSE CAST(CAST(p_retailprice AS DOUBLE) AS VARCHAR) END AS price,
                    CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN 'fields' WHEN p_partkey % 7 = 0 THEN 'price' ELSE '' END AS reason
                FROM part
            )
            SELECT CASE WHEN reason = '' THEN p_partkey END AS part, CASE WHEN reason = '' THEN p_brand END AS brand, CASE WHEN reason = '' THEN p END AS price,
                CASE WHEN reason = 'price' THEN concat_ws(',', p_partkey, p_brand, price) WHEN p_partkey % 11 = 0 THEN concat_ws(';', p_partkey, p_brand)
                    WHEN reason = 'fields' THEN concat_ws(';', p_partkey, p_brand, price, '1') END AS line, reason
            FROM lines""",
        "source_inferred_schema": """
            SELECT l_returnflag, 'l_orderkey:bigint,l_linenumber:bigint,l_returnflag:string,l_quantity:double,nothing:string' AS kinds,
                CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(2 * l_quantity) AS BIGINT) AS quantity, 0 AS filled
            FROM lineitem GROUP BY 1""",
    }
