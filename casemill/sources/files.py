"""Single sources: CSV, Parquet and text files as DataFrames with the names used here."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill import fixed_values as V

LATIN1 = "ISO-8859-1"
BROKEN, FROM_FILE = "broken_record", "from_file"


def opened(path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """Read a path; a path that is not there raises FileNotFoundError."""
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such input: {path}") from error
        raise


def csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
    return opened(path, (reader.schema(schema) if schema else reader).csv)


def csv_with_broken(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns of a CSV as text, with ``broken_record`` (the line, where it has too few or too many fields) and ``from_file``."""
    names = csv(spark, path, sep, encoding=encoding).columns
    schema = ", ".join(f"`{name}` string" for name in [*names, BROKEN])
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("encoding", encoding)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    return opened(path, reader.csv).withColumn(FROM_FILE, F.col("_metadata.file_path"))


def inferred_schema(rows: DataFrame, most: int = 10_000) -> str:
    """A schema for text columns from the first ``most`` rows: whole numbers if all values are, else numbers if all are,
    else text; so is a column without values."""
    names = [name for name in rows.columns if name not in (BROKEN, FROM_FILE)]
    tests = {"bigint": r"^[+-]?[0-9]{1,18}$", "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"}
    checks = [F.bool_and(F.col(f"`{name}`").rlike(test)).alias(f"{kind}_{i}") for i, name in enumerate(names) for kind, test in tests.items()]
    found = rows.limit(most).agg(*checks).first()
    kind = lambda i: next((kind for kind in tests if found[f"{kind}_{i}"]), "string")
    return ", ".join(f"`{name}` {kind(i)}" for i, name in enumerate(names))


def parquet(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Parquet with columns renamed; names that are absent are left alone."""
    return opened(path, spark.read.parquet).withColumnsRenamed(names or {})


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a folder of part files has the mark that Spark leaves when all of them are written."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def complete_rows(spark: SparkSession, path: str, sep: str = ",", names: dict[str, str] | None = None) -> DataFrame:
    """CSV rows without any missing value."""
    return csv(spark, path, sep).dropna("any").withColumnsRenamed(names or {})


def one_column(spark: SparkSession, path: str, name: str) -> DataFrame:
    return csv(spark, path, header=False, schema=f"`{name}` string")


def decimal_comma(spark: SparkSession, path: str, names: dict[str, str], number: str) -> DataFrame:
    """Semicolon CSV whose column ``number`` writes decimals with a comma."""
    rows = csv(spark, path, ";").withColumnsRenamed(names)
    return rows.withColumn(number, F.regexp_replace(number, ",", ".").try_cast("double"))


def code_lists(spark: SparkSession, folder: str, files: dict[str, str]) -> DataFrame:
    """All ``code;description`` lists as one table ``set_name, code``, each read by its own header."""
    lists = [
        csv(spark, f"{folder}/{file}", ";").select(F.lit(name).alias("set_name"), "code") for name, file in files.items()
    ]
    every = lists[0]
    for one in lists[1:]:
        every = every.unionByName(one)
    return every.dropna(subset=["code"])


def latest_file(spark: SparkSession, folder: str, patterns: list[str], what: str) -> str:
    """Path of the newest entry of ``folder`` that matches one of the patterns: a file, or a folder of part
    files dated by its newest part. Only file metadata is read."""
    found = None
    for pattern in patterns:
        try:
            listed = opened(f"{folder}/{pattern}", spark.read.format("binaryFile").load).select("path", "modificationTime")
        except FileNotFoundError:
            continue
        found = listed if found is None else found.unionByName(listed)
    if found is None:
        raise FileNotFoundError(f"no file for {what!r} in {folder} (patterns: {', '.join(patterns)})")
    inside = re.escape(re.sub("^[a-z0-9]+:/+", "/", folder.rstrip("/")))
    entry = F.regexp_extract("path", f"^(.*{inside}/[^/]+)", 1)
    return found.agg(F.max_by(entry, F.struct("modificationTime", "path")).alias("path")).first()["path"]


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Headerless latin-1 dictionary with bars between six columns; the code is trimmed."""
    schema = ", ".join(f"{name} string" for name in V.DICTIONARY_COLUMNS)
    return csv(spark, path, "|", header=False, schema=schema, encoding=LATIN1).withColumn("icd_code", F.trim("icd_code"))


def convert_dictionary(spark: SparkSession, path: str, target: str) -> DataFrame:
    dictionary(spark, path).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def templates(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``.txt`` template of a folder as (template_name, system_prompt), whole. A template is a file,
    or a folder of that name with one file in it."""
    reader = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
    name = F.regexp_extract("_metadata.file_path", r"([^/]+[.]txt)(/part-[^/]*)?$", 1)
    return opened(folder, lambda p: reader.text(p, wholetext=True)).select(name.alias("template_name"), F.col("value").alias("system_prompt"))


def _rules_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a rule file needs PyYAML on the executors") from error
    field = V.RULE_FIELDS
    for batch in batches:
        places = [(file, at, rule) for file, text in zip(batch["file"], batch["value"]) for at, rule in enumerate(yaml.safe_load(text)[field["list"]] or [])]
        rules = [rule for _, _, rule in places]
        yield pd.DataFrame(
            {
                "ordinal": [{"file": file, "at": at} for file, at, _ in places],
                "id": [str(rule[field["id"]]) for rule in rules],
                "text": [rule[field["text"]] for rule in rules],
                "criteria": [{k: str(v) for k, v in (rule[field["criteria"]] or {}).items()} for rule in rules],
            }
        )


def rule_file(spark: SparkSession, path: str) -> DataFrame:
    """Rule table of a YAML file, or of a folder of such files in the order of their names: id, text, criteria."""
    texts = opened(path, lambda p: spark.read.text(p, wholetext=True)).select(F.col("_metadata.file_path").alias("file"), "value")
    return last_rule(texts.mapInPandas(_rules_of, "ordinal struct<file:string,at:int>, id string, text string, criteria map<string,string>"))


def last_rule(rows: DataFrame) -> DataFrame:
    """One row per id; the last one in file order counts."""
    kept = [c for c in rows.columns if c not in ("id", "ordinal")]
    return rows.groupBy("id").agg(*[F.max_by(c, "ordinal").alias(c) for c in kept])
