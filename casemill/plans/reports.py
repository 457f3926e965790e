"""Report generation with a caller's own writer, and the report files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from casemill.plans.prompts import with_messages
from casemill.sources.stores import exists, parquet_bytes, put, store

REPORT_SCHEMA = "generation_id string, scenario string, report string, model string, timestamp timestamp"


def generate_reports(
    stays: DataFrame,
    write_report: Callable[..., str],
    model: str,
    system_prompt: str | None = None,
    tasks: int | None = None,
    with_row: bool = False,
    done: DataFrame | None = None,
    journal: str | None = None,
    journal_rows: int = 1,
) -> DataFrame:
    """Call ``write_report(messages, model)`` for each stay, on the executors. ``with_row``: a third argument is the stay's
    row as a dict. ``tasks`` is the number of tasks that call at a time; without it, Spark's own partitions. Stays whose
    ``generation_id`` is in ``done`` are left out, so a run that broke off goes on with what is missing.

    ``journal``: a folder that every executor can reach. Reports are written there in files of ``journal_rows`` before the
    next call is made, and calls whose file is there are not made again: a repeated task, or a second run with the same
    number of tasks, reads what the first attempt got. A file goes by what its calls were asked, so it answers no other question."""
    if "generation_id" not in stays.columns:
        raise ValueError("the stays need a generation_id column: draw them before asking for reports")
    if done is not None:
        stays = stays.join(done.select("generation_id").distinct(), "generation_id", "left_anti")

    def called(batch: pd.DataFrame) -> pd.DataFrame:
        rows = batch.drop(columns=["system"]).to_dict("records") if with_row else [None] * len(batch)
        texts, times = [], []
        for system, user, row in zip(batch["system"], batch["scenario"], rows):
            messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
            texts.append(write_report(messages, model, row) if with_row else write_report(messages, model))
            times.append(time.time_ns() // 1000)
        return pd.DataFrame(
            {"generation_id": batch["generation_id"], "scenario": batch["scenario"], "report": texts, "model": model, "timestamp": pd.to_datetime(pd.Index(times, dtype="int64"), unit="us", utc=True)}
        )

    def journalled(batch: pd.DataFrame) -> pd.DataFrame:
        files, root = store(journal)
        asked_for = repr((model, batch[["generation_id", "system", "scenario"]].values.tolist()))
        path = f"{root}/{sha256(asked_for.encode()).hexdigest()}.parquet"
        if exists(files, path):
            with files.open_input_file(path) as file:
                return pq.read_table(file).to_pandas()
        made = called(batch)
        put(files, path, parquet_bytes(pa.Table.from_pandas(made, preserve_index=False)))
        return made

    def write_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if journal is None:
                yield called(batch)
            else:
                for begin in range(0, len(batch), journal_rows):
                    yield journalled(batch.iloc[begin : begin + journal_rows])

    asked = with_messages(stays, system_prompt).withColumn("system", F.col("messages")[0]["content"]).drop("messages")
    if not with_row:
        asked = asked.select("generation_id", "scenario", "system")
    if journal is not None:  # the same rows in the same tasks and files whatever happened before
        spark = stays.sparkSession
        tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        asked = asked.repartition(tasks, "generation_id").sortWithinPartitions("generation_id")
    elif tasks:
        asked = asked.repartition(tasks)
    return asked.mapInPandas(write_batches, REPORT_SCHEMA)


def write_reports(reports: DataFrame, folder: str, batch_size: int = 1000) -> None:
    """Append Parquet files of at most ``batch_size`` reports."""
    reports.write.mode("append").option("maxRecordsPerFile", batch_size).parquet(folder)
