"""Where derived tables are written: the shared folder the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

#: Codec of intermediates: counts, sketches and keyed rows take less room than under Parquet's default.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.gettempdir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own on every call; nothing is ever overwritten."""
    return f"{shared_folder(spark)}/casemill-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from Parquet in the shared folder: a finished intermediate that later
    queries share and that outlives lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.parquet(path)


def written_in_buckets(df: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """``written`` as a table in buckets by ``keys``, as many as the session has shuffle partitions: joins on exactly these
    columns read it without an exchange, however often. The table is named in the session's catalog and its files lie with the others."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, purpose)
    name = f"casemill_{re.sub('[^a-z0-9]', '_', path.rsplit('/', 1)[1])}"
    rows = df.repartition(buckets, *keys)  # the buckets' own hash: each task writes one file
    rows.write.format("parquet").option("path", path).option("compression", CODEC).bucketBy(buckets, *keys).saveAsTable(name)
    return spark.table(name)


def all_written(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``written`` for several independent frames, as concurrent jobs."""
    with ThreadPoolExecutor(max_workers=len(frames)) as jobs:
        return dict(zip(frames, jobs.map(lambda name: written(frames[name], name), frames)))
