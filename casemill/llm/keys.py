"""Joins of documents with a set of keys, broadcast only when its size allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Keys that are sent to every executor at most; more are joined by shuffling.
BROADCAST_KEYS = 500_000


def bounded(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """``keys``, to be broadcast if it has few rows. Give the number of rows if it is known; a written table counts fast."""
    count = keys.count() if rows is None else rows
    return F.broadcast(keys) if count <= BROADCAST_KEYS else keys


def without(documents: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose key is not in the column of the same name of ``keys``; null is a key like others."""
    gone = keys.select(F.col(key).alias("_gone_key")).distinct()
    return documents.join(bounded(gone), documents[key].eqNullSafe(gone["_gone_key"]), "left_anti")
