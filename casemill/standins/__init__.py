"""Stand-in inputs derived from the test tables.

The engine reads clinical extracts that do not ship with it. Each view below derives one of them from the
given tables, in SQL that Spark and DuckDB both read, so a query and its check start from the same rows.
Placeholders in braces name other views or the given tables.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.sources.scratch import CODEC, new_folder

GIVEN = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark", "conversations"}

VIEWS: dict[str, str] = {}

# --- lines shared by both cohorts -------------------------------------------------------------------

VIEWS["part_codes"] = """
SELECT p_partkey, p_name,
       lpad(substr(p_brand, 7), 2, '0') || substr('CKMZ', CAST(p_partkey % 4 + 1 AS INT), 1)
         || lpad(CAST(p_size % 3 + 1 AS STRING), 2, '0') AS ghm5,
       upper(substr(p_type, 1, 1)) || lpad(CAST(p_size AS STRING), 2, '0') || CAST(p_partkey % 10 AS STRING) AS code
FROM {part}"""

VIEWS["stay_lines"] = """
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS INT) AS qty, l_returnflag, o_orderstatus,
       p_partkey, ghm5, code AS dp, CAST(o_custkey % 2 + 1 AS INT) AS sexe,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '[0-18[' WHEN '2' THEN '[18-40[' WHEN '3' THEN '[40-65['
            WHEN '4' THEN '[65-80[' ELSE '[80-[' END AS age
FROM {lineitem} JOIN {part_codes} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey"""

# --- inputs of the table cohort ---------------------------------------------------------------------

VIEWS["pmsi_dp"] = """
SELECT age AS AGE, sexe AS SEXE,
       CASE WHEN l_suppkey % 50 = 49 AND l_linenumber = 7 THEN NULL ELSE ghm5 END AS GHM5,
       CASE WHEN l_suppkey % 50 = 48 AND l_linenumber = 7 THEN NULL ELSE dp END AS DP,
       count(*) AS P_DP
FROM {stay_lines} GROUP BY 1, 2, 3, 4"""

VIEWS["pmsi_das"] = """
SELECT ghm5 AS GHM5, age AS AGE, sexe AS SEXE, dp AS DP,
       substr('ABCDEFGHIJKLMNOPQRST', CAST(l_suppkey % 20 + 1 AS INT), 1) || lpad(CAST(qty AS STRING), 2, '0')
         || CAST(l_suppkey % 10 AS STRING) AS DAS,
       count(*) AS P_DAS
FROM {stay_lines} GROUP BY 1, 2, 3, 4, 5"""

VIEWS["pmsi_ccam"] = """
SELECT ghm5 AS GHM5, CASE WHEN p_partkey % 16 < 4 THEN substr(dp, 1, 3) || '9' ELSE dp END AS DP,
       'JQGA' || lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0') AS CCAM, count(*) AS P_CCAM
FROM {stay_lines} GROUP BY 1, 2, 3"""

VIEWS["pmsi_dms"] = """
SELECT ghm5 AS GHM5, percentile_cont(0.25) WITHIN GROUP (ORDER BY CAST(qty AS DOUBLE)) AS DMS_P25,
       percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(qty AS DOUBLE)) AS DMS_P50,
       percentile_cont(0.75) WITHIN GROUP (ORDER BY CAST(qty AS DOUBLE)) AS DMS_P75
FROM {stay_lines} WHERE substr(ghm5, 1, 2) <> '07' GROUP BY 1"""

VIEWS["rghm"] = """
SELECT DISTINCT CASE WHEN p_partkey % 97 = 0 THEN 'ssr' ELSE 'mco' END AS champ,
       CASE WHEN p_partkey % 89 = 0 THEN 'v2023' ELSE 'v2024' END AS version,
       CASE WHEN substr(ghm5, 1, 2) = '09' THEN 'ghm' ELSE 'racine' END AS type_code,
       ghm5 AS code, 'Group ' || ghm5 AS lib
FROM {part_codes}"""

VIEWS["cim10"] = """
SELECT code, min(p_name) AS liblong, CASE WHEN min(p_partkey) % 20 = 0 THEN 0 ELSE 1 END AS en_cours
FROM {part_codes} GROUP BY code
UNION ALL
SELECT DAS AS code, 'Diagnostic ' || substr(DAS, 1, 3) AS liblong,
       CASE WHEN substr(DAS, 4, 1) = '7' THEN 0 ELSE 1 END AS en_cours
FROM {pmsi_das} WHERE DAS NOT IN (SELECT code FROM {part_codes}) GROUP BY DAS"""

VIEWS["ccam_ref"] = """
SELECT CCAM AS code, 'Acte ' || substr(CCAM, 5) AS liblong, CASE WHEN substr(CCAM, 7, 1) = '3' THEN 0 ELSE 1 END AS en_cours
FROM {pmsi_ccam} GROUP BY CCAM"""

# --- inputs of the profile cohort -------------------------------------------------------------------

VIEWS["case_lines"] = """
SELECT l_orderkey, l_linenumber, l_suppkey, qty, p_partkey, sexe, age AS cage,
       CASE p_partkey % 23 WHEN 0 THEN '28Z14' WHEN 1 THEN '28Z16' WHEN 2 THEN '28Z07' WHEN 3 THEN '17M05'
            WHEN 4 THEN '17K04' WHEN 5 THEN '28Z10' WHEN 6 THEN '06M17' WHEN 7 THEN '23Z02' WHEN 8 THEN '14C03'
            WHEN 9 THEN '14Z09' WHEN 10 THEN '14C07' WHEN 11 THEN '04M24' ELSE ghm5 END AS drg_parent_code,
       CASE p_partkey % 20 WHEN 0 THEN 'C186' WHEN 1 THEN 'C509' WHEN 2 THEN 'C341' WHEN 3 THEN 'R18' WHEN 4 THEN 'J90'
            WHEN 5 THEN 'R5210' WHEN 6 THEN 'E119' WHEN 7 THEN 'E050' WHEN 8 THEN 'J459' WHEN 9 THEN 'I10'
            WHEN 10 THEN 'N185' WHEN 11 THEN 'K850' ELSE dp END AS icd_primary_code,
       CASE (l_suppkey * 7 + l_linenumber) % 24 WHEN 0 THEN 'Z511' WHEN 1 THEN 'Z512' WHEN 2 THEN 'Z0480' WHEN 3 THEN 'Z015'
            WHEN 4 THEN 'Z410' WHEN 5 THEN 'Z421' WHEN 6 THEN 'Z4180' WHEN 7 THEN 'Z640' WHEN 8 THEN 'Z641'
            WHEN 9 THEN 'Z098' WHEN 10 THEN 'Z480' ELSE 'DP' END AS case_management_type,
       CASE WHEN qty <= 15 THEN 'Outpatient' WHEN qty <= 48 THEN 'Inpatient' END AS admission_type,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN o_orderstatus = 'O' THEN 'URGENCES' ELSE 'DOMICILE' END AS admission_mode,
       CASE WHEN qty = 50 THEN 'DECES' WHEN l_returnflag = 'A' THEN 'DOMICILE' WHEN l_returnflag = 'N' THEN 'TRANSFERT'
            END AS discharge_disposition,
       CASE WHEN age = '[0-18[' THEN '[0-18[' WHEN age = '[80-[' THEN '[80-[' ELSE '[18-80[' END AS cage2,
       CASE (l_suppkey + qty) % 12 WHEN 0 THEN 'C77' || CAST(qty % 6 AS STRING) WHEN 1 THEN 'C78' || CAST(qty % 9 AS STRING)
            WHEN 2 THEN 'C79' || CAST(qty % 9 AS STRING) WHEN 3 THEN 'C50' || CAST(qty % 10 AS STRING)
            WHEN 4 THEN 'E11' || CAST(qty % 10 AS STRING) WHEN 5 THEN 'I1' || CAST(qty % 6 AS STRING)
            WHEN 6 THEN 'J45' || CAST(qty % 10 AS STRING) WHEN 7 THEN 'N18' || CAST(qty % 10 AS STRING)
            ELSE substr('ABDFGHKLMOPQRST', CAST(l_suppkey % 15 + 1 AS INT), 1) || lpad(CAST(qty AS STRING), 2, '0')
                 || CAST(l_suppkey % 10 AS STRING) END AS icd_secondary_code,
       CASE (l_suppkey + l_linenumber) % 6 WHEN 0 THEN 'JQGA00' || CAST(2 + qty % 4 AS STRING) WHEN 1 THEN 'LHLB001'
            ELSE 'JQGA' || lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0') END AS procedure
FROM {stay_lines}"""

VIEWS["case_profiles"] = """
SELECT drg_parent_code, CASE WHEN l_suppkey % 10 = 3 AND l_linenumber = 5 THEN NULL ELSE icd_primary_code END AS icd_primary_code,
       case_management_type, admission_mode, discharge_disposition, admission_type, cage, sexe,
       CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE cage2 END AS cage2,
       CASE WHEN l_linenumber = 1 THEN qty + 20 END AS age2,
       CASE WHEN l_linenumber = 2 THEN qty % 9 END AS los,
       CASE WHEN l_linenumber = 3 THEN icd_secondary_code || ',I10' END AS preset_codes,
       CASE WHEN count(*) > 3 THEN NULL ELSE count(*) END AS nb
FROM {case_lines} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"""

VIEWS["case_secondary"] = """
SELECT drg_parent_code, icd_primary_code, substr(icd_primary_code, 1, 3) AS icd_primary_parent_code, icd_secondary_code,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE cage2 END AS cage2, sexe, admission_type, count(*) AS nb
FROM {case_lines} GROUP BY 1, 2, 3, 4, 5, 6, 7"""

VIEWS["case_procedures"] = """
SELECT procedure, drg_parent_code, icd_primary_code, cage2, sexe, admission_type, count(*) AS nb
FROM {case_lines} GROUP BY 1, 2, 3, 4, 5, 6"""

VIEWS["case_codes"] = """
SELECT icd_primary_code AS code FROM {case_lines}
UNION SELECT icd_secondary_code AS code FROM {case_lines}
UNION SELECT case_management_type AS code FROM {case_lines}"""

VIEWS["icd_official"] = """
SELECT code AS icd_code, 'Libellé ' || code AS icd_code_description FROM {case_codes} WHERE substr(code, 3, 1) <> '7'"""

VIEWS["icd_synonyms"] = """
SELECT icd_secondary_code AS icd_code,
       CASE WHEN l_suppkey % 3 = 0 THEN 'Métastase ou Metastase, forme ' ELSE 'variante ' END || CAST(qty % 8 AS STRING)
         AS icd_code_description
FROM {case_lines} WHERE substr(icd_secondary_code, 2, 1) <> '9' GROUP BY 1, 2"""

VIEWS["drg_statistics"] = """
SELECT drg_parent_code, CAST(sum(qty) AS DOUBLE) / count(*) AS los_mean, CAST(max(qty) - min(qty) AS DOUBLE) / 4 AS los_sd
FROM {case_lines} WHERE substr(drg_parent_code, 1, 2) <> '05' GROUP BY 1"""

VIEWS["drg_parents_groups"] = """
SELECT DISTINCT drg_parent_code, 'Groupe ' || drg_parent_code AS drg_parent_description, l_linenumber AS ghm
FROM {case_lines} WHERE substr(drg_parent_code, 1, 2) <> '06'"""

VIEWS["specialty"] = """
SELECT drg_parent_code, 'SERVICE ' || CAST(l_suppkey % 5 AS STRING) AS specialty, CAST(count(*) AS DOUBLE) AS ratio
FROM {case_lines} WHERE substr(drg_parent_code, 1, 2) <> '08' GROUP BY 1, 2"""

VIEWS["names"] = """
SELECT CASE WHEN c_custkey % 11 = 0 THEN 'LEA' ELSE c_mktsegment || '-' || CAST(c_custkey % 97 AS STRING) END AS prenom,
       CASE WHEN c_custkey % 13 = 0 THEN 'ROY' ELSE upper(n_name) || ' ' || CAST(c_custkey % 7 AS STRING) END AS nom,
       CAST(c_custkey % 2 + 1 AS INT) AS sexe
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""

VIEWS["hospitals"] = "SELECT s_name AS hospital FROM {supplier}"

VIEWS["procedure_official"] = """
SELECT DISTINCT procedure, 'Acte De Type ' || procedure AS procedure_description FROM {case_lines} WHERE substr(procedure, 7, 1) <> '9'"""

VIEWS["cancer_codes"] = """
SELECT DISTINCT code AS CIM10 FROM {case_codes} WHERE substr(code, 1, 1) IN ('C', 'Z') AND code <> 'C186'
UNION ALL SELECT CAST(NULL AS STRING) AS CIM10 FROM {region}"""

VIEWS["chronic"] = """
SELECT code, CASE WHEN substr(code, 1, 3) IN ('E11', 'I10', 'N18', 'J45', 'E05', 'K85', 'C18') THEN 1
                  WHEN code = 'DP' THEN 0 ELSE CAST(substr(code, length(code)) AS INT) % 7 END AS chronic, code AS libelle
FROM {case_codes}"""

VIEWS["cancer_treatment"] = """
SELECT substr(icd_primary_code, 1, 3) AS icd_parent_code, 'Site ' || CAST(qty % 3 AS STRING) AS primary_site,
       CASE WHEN qty % 7 = 0 THEN NULL ELSE 'Type ' || CAST(l_suppkey % 5 AS STRING) END AS histological_type,
       CASE l_suppkey % 6 WHEN 0 THEN 'T2N1M0' WHEN 1 THEN 'T3N0M1' WHEN 2 THEN 'T1N0M0' WHEN 3 THEN 'Variable'
            WHEN 4 THEN 'Non pertinent' END AS TNM,
       CASE qty % 4 WHEN 0 THEN 'Stade I' WHEN 1 THEN 'Variable' WHEN 2 THEN 'Non pertinent' END AS stage,
       CASE WHEN l_suppkey % 2 = 0 THEN 'HER' || CAST(qty % 3 AS STRING) END AS biomarkers,
       'Traitement ' || CAST(qty % 5 AS STRING) AS treatment_recommandation,
       CASE WHEN qty % 2 = 0 THEN 'FOLFOX ' || CAST(l_linenumber AS STRING) END AS chemotherapy_regimen
FROM {case_lines} WHERE substr(icd_primary_code, 1, 1) IN ('C', 'E') GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""

VIEWS["code_sets"] = """
SELECT CASE code WHEN 'Z0480' THEN 'icd_codes_overnight_study' WHEN 'Z015' THEN 'icd_codes_sensitization_tests'
            WHEN 'Z640' THEN 'icd_codes_legal_abortion' WHEN 'Z641' THEN 'icd_codes_medical_abortion'
            WHEN 'Z098' THEN 'icd_codes_supervision_chronic_disease' ELSE 'icd_codes_diabetes_chronic' END AS set_name, code
FROM {case_codes} WHERE code IN ('Z0480', 'Z015', 'Z640', 'Z641', 'Z098') OR substr(code, 1, 3) = 'E11'
UNION ALL
SELECT DISTINCT 'procedure_botulic_toxin' AS set_name, procedure AS code FROM {case_lines} WHERE procedure = 'LHLB001'"""

VIEWS["rule_rows"] = """
SELECT CAST(item_id AS INT) AS ordinal,
       CASE item_id % 12 WHEN 0 THEN 'D1' WHEN 1 THEN 'D9' WHEN 2 THEN 'D5' WHEN 3 THEN 'T1' WHEN 4 THEN 'T3' WHEN 5 THEN 'T2-R18'
            WHEN 6 THEN 'T2-J9' WHEN 7 THEN 'T12' WHEN 8 THEN 'D3-1' WHEN 9 THEN 'S1-Chronic' WHEN 10 THEN 'T7' ELSE 'T4' END AS id,
       text
FROM {benchmark}"""

PLACEHOLDER = re.compile(r"\{(\w+)\}")


_WRITTEN: dict[tuple[str, str, str], str] = {}

#: Views over inputs of at most so many rows are dealt over all cores before they are written; larger inputs come in enough
#: splits by themselves, and dealing them out again would shuffle every line once more.
DEALT_ROWS = 1_000_000


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a stand-in view written once per application as Parquet in the shared folder.

    Real inputs are files; writing the stand-ins keeps the cohort plans from recomputing them.
    """
    if name in GIVEN:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _WRITTEN:
        path = f"{new_folder(spark, 'inputs')}/{name}.parquet"
        plan, rows = view_plan(spark, sf_dir, name), max(frame.count() for frame in needed(spark, sf_dir, name).values())
        if rows <= DEALT_ROWS:
            plan = plan.repartition(spark.sparkContext.defaultParallelism)
        plan.write.parquet(path, compression=CODEC)
        _WRITTEN[slot] = path
    return spark.read.parquet(_WRITTEN[slot])


def views(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """Several views; what they have in common is written first, the rest as concurrent jobs."""
    for shared in sorted({dep for name in names if name in VIEWS for dep in PLACEHOLDER.findall(VIEWS[name])}):
        view(spark, sf_dir, shared)
    with ThreadPoolExecutor(max_workers=4) as jobs:
        return dict(zip(names, jobs.map(lambda name: view(spark, sf_dir, name), names)))


def needed(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    """The given tables and views that a view names."""
    return {dep: view(spark, sf_dir, dep) for dep in PLACEHOLDER.findall(VIEWS[name])}


def one_part_per_code(parts: DataFrame) -> DataFrame:
    """Code with its least name and least key: all that ``cim10`` asks of the parts. The parts of NOT IN are sent whole, and
    there are few codes however many parts there are."""
    return parts.groupBy("code").agg(F.min("p_name").alias("p_name"), F.min("p_partkey").alias("p_partkey"))


def view_plan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    needs = needed(spark, sf_dir, name)
    if name == "stay_lines":  # these grow with the lines: joined by sorting, whatever their files look like
        needs |= {side: needs[side].hint("merge") for side in ("part_codes", "orders")}
    if name == "cim10":
        needs["part_codes"] = one_part_per_code(needs["part_codes"])
    return spark.sql(VIEWS[name], **needs)


def with_views(names: list[str], *ctes: tuple[str, str], final: str) -> str:
    """One SQL statement: the named views and what they need, further common tables, the final select."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in GIVEN or name in ordered:
            return
        for dep in PLACEHOLDER.findall(VIEWS[name]):
            visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    # Materialising the views keeps the engine from inlining a chain of them many times over.
    parts = [f"{n} AS MATERIALIZED ({PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[n])})" for n in ordered]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final if parts else final
