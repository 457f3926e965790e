"""Queries of the sources and sinks: the given tables are written in the format of an input and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill import fixed_values as V
from casemill.plans import prompts, reports
from casemill.sources import files, registry, report_sink
from casemill.sources.scratch import new_folder, written
from casemill.standins import view
from catalog import profile_queries as cases, table_queries as tabled


def write_csv(rows: DataFrame, path: str, sep: str = ";", header: bool = True, encoding: str = "UTF-8") -> None:
    rows.write.option("sep", sep).option("header", header).option("encoding", encoding).csv(path)


def written_tables(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """CSV files of all tables of the table cohort; the codes of ``cim10`` are those with a label."""
    official = view(spark, sf_dir, "icd_official").select(
        F.col("icd_code").alias("code"), F.col("icd_code_description").alias("liblong"), F.lit(1).alias("en_cours")
    )
    views = {"dp": "pmsi_dp", "das": "pmsi_das", "ccam": "pmsi_ccam", "dms": "pmsi_dms", "rghm": "rghm", "ccam_ref": "ccam_ref"}
    for name, table in {"cim10": official, **{name: view(spark, sf_dir, source) for name, source in views.items()}}.items():
        write_csv(table, f"{folder}/{V.TABLE_FILES[name]}", encoding=files.LATIN1)
    return list(V.TABLE_FILES)


def source_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, target = new_folder(spark, "csv"), new_folder(spark, "tables")
    names = written_tables(spark, sf_dir, folder)
    registry.ingest(spark, folder, target, names)
    return registry.ingest(spark, folder, target, names)["cim10"]  # the second call keeps what is there


def source_table_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, target = new_folder(spark, "csv"), new_folder(spark, "tables")
    names = written_tables(spark, sf_dir, folder)
    registry.ingest(spark, folder, target, names)
    registry.load_tables(spark, target, names)
    masses = {"dp": "P_DP", "das": "P_DAS", "ccam": "P_CCAM", "dms": "DMS_P50", "rghm": "length(lib)", "cim10": "length(liblong)", "ccam_ref": "length(liblong)"}
    return spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n, CAST(round(4 * sum({mass})) AS BIGINT) AS mass FROM {name}" for name, mass in masses.items()))


def write_code_lists(spark: SparkSession, sf_dir: str, folder: str, names: list[str]) -> None:
    rows = view(spark, sf_dir, "code_sets")
    for name in names:
        listed = rows.where(F.col("set_name") == name).select("code", F.concat(F.lit("Libellé "), "code").alias("description"))
        write_csv(listed, f"{folder}/{V.CODE_LIST_FILES[name]}")


FILLED_LISTS = [
    "icd_codes_overnight_study", "icd_codes_sensitization_tests", "icd_codes_legal_abortion", "icd_codes_medical_abortion",
    "icd_codes_supervision_chronic_disease", "icd_codes_diabetes_chronic", "procedure_botulic_toxin",
]


def source_code_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lists")
    write_code_lists(spark, sf_dir, folder, FILLED_LISTS)
    return files.code_lists(spark, folder, {name: V.CODE_LIST_FILES[name] for name in FILLED_LISTS})


def synonym_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.substring("icd_code", 1, 1) != "A", F.col("icd_code"))
    return view(spark, sf_dir, "icd_synonyms").select(F.col("icd_code_description").alias("dictionary_keys"), known.alias("code"))


def source_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'synonyms')}/{V.SYNONYM_FILE}"
    write_csv(synonym_file_rows(spark, sf_dir), path, sep=",")
    return files.complete_rows(spark, path, names=V.SYNONYM_NAMES)


def source_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'hospitals')}/{V.HOSPITAL_FILE}"
    write_csv(view(spark, sf_dir, "hospitals"), path, sep=",", header=False)
    return files.one_column(spark, path, "hospital")


def weight_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    comma = F.regexp_replace(F.col("p_retailprice").cast("string"), "[.]", ",")
    return view(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("diag"), comma.alias("ponderation"))


def source_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'weights')}/{V.WEIGHT_FILE}"
    write_csv(weight_file_rows(spark, sf_dir), path)
    return files.decimal_comma(spark, path, V.WEIGHT_NAMES, "weight")


def in_source_names(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.withColumnsRenamed({ours: theirs for theirs, ours in names.items()})


def source_parquet_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    file, names = V.REFERENCE_PARQUET["cancer_treatment"]
    path = f"{new_folder(spark, 'treatments')}/{file}"
    in_source_names(view(spark, sf_dir, "cancer_treatment"), names).write.parquet(path)
    rows = files.parquet(spark, path, names)
    return rows.select(*[F.col(c).alias(c.lower()) for c in rows.columns])


def source_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "extracts")
    rows = in_source_names(view(spark, sf_dir, "case_procedures"), V.SECONDARY_NAMES)
    write_csv(rows.where("sexe = 1"), f"{folder}/bn_pmsi_procedures_2023.csv")
    write_csv(rows.where("sexe = 2"), f"{folder}/bn_pmsi_procedures_2024.csv")
    newest = files.latest_file(spark, folder, V.EXTRACT_PATTERNS["procedures"], "procedures")
    read = files.csv(spark, newest, ";").withColumnsRenamed(V.SECONDARY_NAMES)
    return read.groupBy("procedure", "drg_parent_code", F.col("sexe").cast("int").alias("sexe")).agg(F.sum(F.col("nb").cast("bigint")).alias("nb"))


def source_tolerant_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "case_lines").select(
        F.col("drg_parent_code").alias("racine"), F.col("icd_secondary_code").alias("das"), F.col("qty").alias("other")
    )
    renamed = rows.withColumnsRenamed(V.SECONDARY_NAMES)
    return renamed.groupBy("drg_parent_code", "icd_secondary_code").agg(F.sum("other").alias("other"))


def write_referentials(spark: SparkSession, sf_dir: str, folder: str) -> None:
    for name, (file, names) in V.REFERENCE_PARQUET.items():
        in_source_names(view(spark, sf_dir, name), names).write.parquet(f"{folder}/{file}")
    write_csv(synonym_file_rows(spark, sf_dir), f"{folder}/{V.SYNONYM_FILE}", sep=",")
    write_csv(weight_file_rows(spark, sf_dir), f"{folder}/{V.WEIGHT_FILE}")
    write_csv(view(spark, sf_dir, "names"), f"{folder}/{V.NAME_FILE}")
    write_csv(view(spark, sf_dir, "hospitals"), f"{folder}/{V.HOSPITAL_FILE}", sep=",", header=False)
    acute = view(spark, sf_dir, "case_secondary").select(F.col("icd_secondary_code").alias("code")).distinct()
    write_csv(acute, f"{folder}/{V.COMPLICATION_FILE}", sep=",")
    groups = view(spark, sf_dir, "case_lines").select("drg_parent_code").distinct()
    write_csv(groups, f"{folder}/{V.EXCLUSION_FILE}", sep=",")
    write_code_lists(spark, sf_dir, folder, FILLED_LISTS)
    others = [name for name in V.CODE_LIST_FILES if name not in FILLED_LISTS]
    codes = view(spark, sf_dir, "case_codes").select("code", F.lit("").alias("description"))
    for name in others:
        write_csv(codes, f"{folder}/{V.CODE_LIST_FILES[name]}")


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every input of the profile cohort, loaded from files."""
    reference, extracts = new_folder(spark, "reference"), new_folder(spark, "extracts")
    write_referentials(spark, sf_dir, reference)
    in_source_names(cases.case_profiles(spark, sf_dir), V.PROFILE_NAMES).write.parquet(f"{extracts}/scenarios_2024.parquet")
    for name, key in (("related_diag", "case_secondary"), ("procedures", "case_procedures")):
        write_csv(in_source_names(view(spark, sf_dir, key), V.SECONDARY_NAMES), f"{extracts}/bn_pmsi_{name}_2024.csv")
    tables = registry.load_data(spark, extracts, reference)
    counts = [t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def source_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "dictionary")
    rows = view(spark, sf_dir, "icd_official").select(
        F.rpad("icd_code", 8, " ").alias("icd_code"), F.lit("0").alias("a"), F.lit("O").alias("b"), F.lit("0").alias("c"),
        F.substring("icd_code_description", 1, 9).alias("short"), "icd_code_description",
    )
    rows.write.option("sep", "|").option("encoding", files.LATIN1).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/dictionary.txt")
    return files.convert_dictionary(spark, f"{folder}/dictionary.txt", f"{folder}/dictionary.parquet")


RULES_PER_FILE = 50


def source_rule_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rule rows in their order, in files of ``RULES_PER_FILE`` rules; of the entries of an id the last one counts."""
    entry = F.struct(
        F.col("id").alias(V.RULE_FIELDS["id"]), F.col("text").alias(V.RULE_FIELDS["text"]),
        F.struct(F.col("id").alias("primary_diagnosis"), F.col("ordinal").cast("string").alias("ordinal")).alias(V.RULE_FIELDS["criteria"]),
    )
    place = F.format_string("%019d", F.call_function("div", "ordinal", F.lit(RULES_PER_FILE)))
    rules = view(spark, sf_dir, "rule_rows").groupBy(place.alias("place")).agg(F.array_sort(F.collect_list(F.struct("ordinal", entry.alias("rule")))).alias("rules"))
    text = F.to_json(F.struct(F.transform("rules", lambda r: r["rule"]).alias(V.RULE_FIELDS["list"])))
    folder = f"{new_folder(spark, 'rules')}/rules"
    rules.select(text.alias("value"), F.concat("place", F.lit(".yml")).alias("place")).write.partitionBy("place").text(folder)
    criteria = F.col("criteria")
    return files.rule_file(spark, folder).select("id", "text", criteria["primary_diagnosis"].alias("primary_diagnosis"), criteria["ordinal"].cast("int").alias("ordinal"))


def source_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System prompts read from template files, one of all turns of each conversation, joined to its turns as messages."""
    folder = f"{new_folder(spark, 'templates')}/templates"
    turns = view(spark, sf_dir, "conversations").withColumn("template", F.format_string("%d.txt", "conv_id"))
    said = F.array_sort(F.collect_list(F.struct("turn", "text")))
    texts = turns.groupBy("template").agg(F.array_join(said["text"], "\n").alias("value"))
    texts.write.partitionBy("template").text(folder)
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.concat(F.lit("template="), "template").alias("template_name"), F.col("text").alias("scenario"))
    out = prompts.with_messages(prompts.with_system_prompt(asked, files.templates(spark, folder)))
    return out.select("conv_id", "turn", F.inline("messages"))


def build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prompts.with_messages(tabled.short_text(spark, sf_dir), "Rédige un compte rendu.")
    return rows.select("generation_id", F.inline("messages"))


def stub_writer(messages: list[dict], model: str) -> str:
    """Stands in for a model: tells the lengths of what it was given."""
    return f"{model} {' '.join(str(len(m['content'])) for m in messages)}"


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.generate_reports(tabled.short_text(spark, sf_dir), stub_writer, "stub", "Rédige un compte rendu.")


def generate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated(spark, sf_dir).select("generation_id", "scenario", "report", "model")


def sink_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written in files of at most 1000 rows and read back; no file may hold more."""
    folder = f"{new_folder(spark, 'reports')}/reports"
    reports.write_reports(generated(spark, sf_dir), folder, 1000)
    rows = spark.read.parquet(folder).withColumn("file", F.col("_metadata.file_path"))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("n_rows"), F.max((F.col("n") > 1000).cast("int")).alias("too_long"))


def sink_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written as two batches, one of them twice, and read back: each id is there once. The writer is called once per
    stay: the reports are kept beside, and each batch is filtered from them."""
    folder = f"{new_folder(spark, 'batches')}/reports"
    made = written(generated(spark, sf_dir), "made-reports").withColumn("half", F.when(F.col("generation_id") < "8", "low").otherwise("high"))
    for half in ("low", "high", "low"):
        report_sink.write_batch(made.where(F.col("half") == half).drop("half"), folder, half)
    rows = report_sink.read_batches(spark, folder, reports.REPORT_SCHEMA)
    return rows.select("generation_id", "report", "batch")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of CSV for each part: some have a word for a number, some a field too few or too many."""
    key = F.col("p_partkey").cast("string")
    price = F.when(F.col("p_partkey") % 7 == 0, F.lit("cher")).otherwise(F.col("p_retailprice").cast("double").cast("string"))
    line = F.concat_ws(";", key, "p_brand", price)
    line = F.when(F.col("p_partkey") % 11 == 0, F.concat_ws(";", key, "p_brand")).when(F.col("p_partkey") % 13 == 0, F.concat(line, F.lit(";1"))).otherwise(line)
    return view(spark, sf_dir, "part").select(line.alias("value"))


def source_rescued_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts from a damaged file: typed where they fit, with the line and the reason where they do not."""
    path = f"{new_folder(spark, 'damaged')}/parts.csv"
    lines = damaged_lines(spark, sf_dir).withColumnRenamed("value", "part;brand;price")
    lines.write.option("sep", "|").option("quote", "").option("header", True).csv(path)  # whole lines under a header
    whole, broken = registry.rescued(files.csv_with_broken(spark, path, ";"), "part bigint, brand string, price double")
    broken = broken.select(F.col("record").alias("line"), F.array_join("reasons", ",").alias("reason"))
    return whole.withColumns({"line": F.lit(None).cast("string"), "reason": F.lit("")}).unionByName(broken, allowMissingColumns=True)


def source_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read under the schema that their first 10 000 rows give."""
    path = f"{new_folder(spark, 'items')}/items.csv"
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("double").alias("l_quantity"), F.lit(None).cast("string").alias("nothing")]
    write_csv(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*columns), path)
    text = files.csv(spark, path, ";")
    schema = files.inferred_schema(text)
    rows = registry.by_name(text, schema)
    kinds = ",".join(f"{name}:{kind}" for name, kind in rows.dtypes)
    return rows.groupBy("l_returnflag", F.lit(kinds).alias("kinds")).agg(F.sum("l_orderkey").alias("keys"), F.sum(2 * F.col("l_quantity")).cast("bigint").alias("quantity"), F.count("nothing").alias("filled"))


def source_queries() -> dict:
    named = [
        source_csv_ingest, source_table_views, source_code_lists, source_complete_rows, source_one_column, source_decimal_comma,
        source_parquet_renamed, source_latest_file, source_tolerant_rename, source_registry, source_dictionary, source_rule_file,
        source_templates, build_messages, generate_reports, sink_reports, sink_batches, source_rescued_rows, source_inferred_schema,
    ]
    return {run.__name__: run for run in named}
