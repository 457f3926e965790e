"""A sink whose batches are there whole or not at all.

A write is a batch with a name. Every task writes files of its own, which nobody reads yet; when all tasks have ended the
batch's list of files is put in place in one step, and with it the batch. A task that is repeated writes new files and only
those of the attempt that counts are listed; a write that fails removes its files (what a killed task leaves goes with the next commit of the batch); a batch whose name is there already adds
nothing. So a job may be repeated, as a whole or in parts, and each row stays once. One write at a time may use a name.

Executors and the driver reach the folder through Arrow's file systems (``stores``) and import this package.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from casemill.sources.stores import exists, parquet_bytes, put, store

NAME = "casemill_batches"
ROWS_PER_FILE = 1000


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: names of files with their rows."""

    files: list[tuple[str, int]]


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, batch: str, rows_per_file: int):
        self.folder, self.batch, self.rows_per_file = folder, batch, rows_per_file
        self.run = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = store(self.folder)
        attempt, held, rows, done = uuid.uuid4().hex[:12], [], 0, []

        def flush(table: pa.Table) -> None:
            name = f"{self.batch}-{self.run}-{attempt}-{len(done):06d}.parquet"
            put(files, f"{root}/data/{self.batch}/{name}", parquet_bytes(table))
            done.append((name, len(table)))

        for some in iterator:
            held.append(some)
            rows += len(some)
            if rows >= self.rows_per_file:
                table = pa.Table.from_batches(held)
                whole = rows - rows % self.rows_per_file
                for begin in range(0, whole, self.rows_per_file):
                    flush(table.slice(begin, self.rows_per_file))
                held, rows = table.slice(whole).to_batches(), rows - whole
        if rows:
            flush(pa.Table.from_batches(held))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = store(self.folder)
        listed = f"{root}/batches/{self.batch}.json"
        if exists(files, listed):
            return self.abort(messages)
        entries = [json.dumps({"batch": self.batch, "file": name, "rows": rows}) for message in messages if message for name, rows in message.files]
        put(files, listed, "\n".join(entries).encode())
        kept = {name for message in messages if message for name, _ in message.files}
        for left in files.get_file_info(fs.FileSelector(f"{root}/data/{self.batch}", allow_not_found=True)):
            if left.base_name not in kept:  # of attempts that did not end
                files.delete_file(left.path)
        return None

    def abort(self, messages: list[Written | None]) -> None:
        files, root = store(self.folder)
        for message in messages:
            for name, _ in message.files if message else []:
                files.delete_file(f"{root}/data/{self.batch}/{name}")


class Batches(DataSource):
    """``df.write.format(NAME).option("path", folder).option("batch", name)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("batches are only added")
        batch = self.options.get("batch", "")
        if not re.fullmatch("[A-Za-z0-9_.-]+", batch):
            raise ValueError("a batch needs a name of letters, digits, dots, dashes and underscores")
        return BatchWriter(self.options["path"], batch, int(self.options.get("rows", ROWS_PER_FILE)))


def write_batch(rows: DataFrame, folder: str, batch: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Add ``rows`` to ``folder`` as the batch of this name, in files of at most ``rows_per_file`` rows."""
    rows.sparkSession.dataSource.register(Batches)
    rows.write.format(NAME).mode("append").option("path", folder).option("batch", batch).option("rows", rows_per_file).save()


def read_batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all batches that are there, with ``batch``. An empty folder gives no rows."""
    files, root = store(folder)
    if not exists(files, f"{root}/batches"):
        return spark.createDataFrame([], f"{schema}, batch string")
    known = spark.read.schema("batch string, file string, rows long").json(f"{folder}/batches").where("file is not null")
    names = [f"{row['batch']}/{row['file']}" for row in known.select("batch", "file").collect()]  # a name per file, as Spark lists any folder
    if not names:
        return spark.createDataFrame([], f"{schema}, batch string")
    rows = spark.read.schema(schema).parquet(*[f"{folder}/data/{name}" for name in names])
    return rows.withColumn("batch", F.regexp_extract("_metadata.file_name", r"^(.*)-[0-9a-f]{12}-[0-9a-f]{12}-\d{6}[.]parquet$", 1))
