"""Labelled rows for training, and the held-out part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(key: Column) -> Column:
    """One document in five by its key alone; labels of these are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``text``, ``label``) of at most ``most`` labelled documents outside the held-out part, chosen by key hash. Null
    labels, null keys and labels without a document are passed over; of several labels the lowest counts."""
    known = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label")).where("label IS NOT NULL AND key IS NOT NULL")
    known = known.where(~held_out(F.col("key"))).groupBy("key").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(most)  # the documented bound of the sample, and of this broadcast
    rows = documents.select(documents[key].alias("key"), documents[text].alias("text")).join(F.broadcast(chosen), "key")
    return rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("row")).select("key", "row.text", "row.label")
