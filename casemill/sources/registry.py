"""Named sets of sources: the inputs of each cohort, checked for presence and columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from casemill import fixed_values as V
from casemill.sources import files

REQUIRED_COLUMNS = {
    "profiles": ["drg_parent_code", "icd_primary_code", "case_management_type", "cage", "sexe"],
    "secondary_icd": ["icd_primary_code", "icd_secondary_code"],
    "procedures": ["procedure"],
}


def ingest(spark: SparkSession, folder: str, target: str, tables: list[str] | None = None, rescue: bool = False) -> dict[str, DataFrame]:
    """Convert the semicolon latin-1 CSV files of the table cohort to Parquet, each once: a table that is
    already there whole is kept, one that was left half-written is written again. All missing files are reported together.
    A value that does not fit its column ends the ingest; with ``rescue`` the table gets the rows that are whole, and the
    others are kept beside it (``broken_rows``)."""
    names = tables or list(V.TABLE_FILES)
    done, missing = {}, []
    for name in names:
        path = f"{target}/{name}.parquet"
        if files.finished(spark, path):
            done[name] = files.parquet(spark, path)
            continue
        source = f"{folder}/{V.TABLE_FILES[name]}"
        try:
            rows = (files.csv_with_broken if rescue else files.csv)(spark, source, ";", encoding=files.LATIN1)
        except FileNotFoundError:
            missing.append(V.TABLE_FILES[name])
            continue
        if rescue:
            whole, broken = rescued(rows, V.TABLE_SCHEMAS[name])
            broken.write.mode("overwrite").parquet(f"{target}/_broken_{name}.parquet")
            whole.write.mode("overwrite").parquet(path)
        else:
            by_name(rows, V.TABLE_SCHEMAS[name]).write.mode("overwrite").parquet(path)
        done[name] = files.parquet(spark, path)
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")
    return done


def rescued(rows: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``files.csv_with_broken`` as those that fit ``schema``, in it, and the others: ``from_file``, ``record`` (the line, or its
    fields as CSV) and ``reasons``: ``fields`` for a wrong number of fields, or the columns whose value does not fit."""
    fields = [f for f in StructType.fromDDL(schema).fields if f.name in rows.columns]
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    unfit = [F.when(F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull(), F.lit(f.name)) for f in fields]
    count = F.when(F.col(files.BROKEN).isNotNull(), F.array(F.lit("fields")))
    reasons = F.coalesce(count, F.array_compact(F.array(*unfit)))
    plain = [F.col(f"`{c}`") for c in rows.columns if c not in (files.BROKEN, files.FROM_FILE)]
    judged = rows.withColumn("reasons", reasons)
    whole = conform(judged.where(F.size("reasons") == 0).withColumns(typed), StructType.fromDDL(schema))
    record = F.coalesce(files.BROKEN, F.to_csv(F.struct(*plain)))
    return whole, judged.where(F.size("reasons") > 0).select(files.FROM_FILE, record.alias("record"), "reasons")


def broken_rows(spark: SparkSession, target: str, tables: list[str] | None = None) -> DataFrame:
    """Rows that ``ingest`` with ``rescue`` left out, by table, file and reason: ``name, from_file, reason, n_rows``."""
    every = None
    for name in tables or list(V.TABLE_FILES):
        path = f"{target}/_broken_{name}.parquet"
        if files.finished(spark, path):
            counts = files.parquet(spark, path).select(files.FROM_FILE, F.explode("reasons").alias("reason")).groupBy(files.FROM_FILE, "reason").agg(F.count(F.lit(1)).alias("n_rows"))
            counts = counts.select(F.lit(name).alias("name"), files.FROM_FILE, "reason", "n_rows")
            every = counts if every is None else every.unionByName(counts)
    return every if every is not None else spark.createDataFrame([], "name string, from_file string, reason string, n_rows bigint")


def by_name(rows: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema``, found by name and cast; an absent one is a typed null."""
    return conform(rows, StructType.fromDDL(schema))


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows in an explicit schema: absent columns become typed nulls, missing lists become empty ones."""

    def column(field):
        value = (F.col(f"`{field.name}`") if field.name in rows.columns else F.lit(None)).cast(field.dataType)
        if isinstance(field.dataType, ArrayType):
            value = F.coalesce(value, F.array().cast(field.dataType))
        return value.alias(field.name)

    return rows.select(*[column(field) for field in schema.fields])


def load_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The converted tables, also as temporary views."""
    tables = {name: files.parquet(spark, f"{folder}/{name}.parquet") for name in names or list(V.TABLE_FILES)}
    return registered(tables)


def registered(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def all_read(readers: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Every table, or one error that lists all missing files."""
    tables, missing = {}, []
    for name, read in readers.items():
        try:
            tables[name] = read()
        except FileNotFoundError as error:
            missing.append(str(error))
    if missing:
        raise FileNotFoundError("; ".join(missing))
    return tables


def referentials(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All reference tables of the profile cohort, with the code lists as one table ``code_sets``."""

    def names() -> DataFrame:
        return files.complete_rows(spark, f"{folder}/{V.NAME_FILE}", ";").withColumn("sexe", F.col("sexe").try_cast("int"))

    official = {name: lambda file=file, names=names: files.parquet(spark, f"{folder}/{file}", names) for name, (file, names) in V.REFERENCE_PARQUET.items()}
    return all_read(
        {
            **official,
            "icd_synonyms": lambda: files.complete_rows(spark, f"{folder}/{V.SYNONYM_FILE}", names=V.SYNONYM_NAMES),
            "icd_categ_weight": lambda: files.decimal_comma(spark, f"{folder}/{V.WEIGHT_FILE}", V.WEIGHT_NAMES, "weight"),
            "complications": lambda: files.complete_rows(spark, f"{folder}/{V.COMPLICATION_FILE}"),
            "exclusions": lambda: files.csv(spark, f"{folder}/{V.EXCLUSION_FILE}"),
            "names": names,
            "hospitals": lambda: files.one_column(spark, f"{folder}/{V.HOSPITAL_FILE}", "hospital"),
            "code_sets": lambda: files.code_lists(spark, folder, V.CODE_LIST_FILES),
        }
    )


def extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The newest profile, secondary-diagnosis and procedure extracts, renamed."""

    def newest(key: str) -> str:
        return files.latest_file(spark, folder, V.EXTRACT_PATTERNS[key], key)

    def counted(rows: DataFrame) -> DataFrame:
        casts = {name: F.col(name).try_cast(kind) for name, kind in (("nb", "bigint"), ("sexe", "int")) if name in rows.columns}
        return rows.withColumns(casts)

    def listed(key: str) -> DataFrame:
        return counted(files.csv(spark, newest(key), ";").withColumnsRenamed(V.SECONDARY_NAMES))

    return all_read(
        {
            "profiles": lambda: counted(files.parquet(spark, newest("profiles"), V.PROFILE_NAMES)),
            "secondary_icd": lambda: listed("secondary_icd"),
            "procedures": lambda: listed("procedures"),
        }
    )


def load_data(spark: SparkSession, extract_folder: str, reference_folder: str) -> dict[str, DataFrame]:
    """Every input of the profile cohort, also as temporary views. One error names all that is missing."""
    tables, missing = {}, []
    for read, folder in ((referentials, reference_folder), (extracts, extract_folder)):
        try:
            tables |= read(spark, folder)
        except FileNotFoundError as error:
            missing.append(str(error))
    if missing:
        raise FileNotFoundError("; ".join(missing))
    require_columns(tables, REQUIRED_COLUMNS)
    return registered(tables)


def require_columns(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> None:
    """One error that lists every missing table and column."""
    gaps = [f"table {name}" for name in required if name not in tables]
    for name, columns in required.items():
        if name in tables:
            gaps += [f"{name}.{c}" for c in columns if c not in tables[name].columns]
    if gaps:
        raise ValueError(f"missing inputs: {', '.join(gaps)}")
