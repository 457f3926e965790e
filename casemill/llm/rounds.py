"""The best rows for each of many queries, compared in bundles and in rounds of growing size.

Rows are dealt to bundles and queries to groups, both of bounded size; one task holds one bundle and one group. The first
round takes a few thousand rows, each later one ``GROWTH`` times as many as all before it, and each begins with the score
that a query's last place had after the round before. So a round yields about ``GROWTH`` times the rows asked for, however
many bundles it has, and most pairs can be ruled out by a bound instead of being scored. Results of a round are written.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.llm.shipping import ship
from casemill.sources.scratch import written

#: Rows of the first round, and how many times all earlier rows a round has.
FIRST, GROWTH = 4096, 16
#: Rows in a bundle and queries in a group, at most and (bundles) at least, and bytes of either.
BUNDLE_ROWS, BUNDLE_LEAST, GROUP_ROWS, HELD_BYTES = 1 << 17, 2048, 4096, 32 << 20
#: Bundles that the rows are dealt to if they are few, so that small tables use all cores.
BUNDLES_WISHED = 48
#: Partitions of a round at most.
PARTITIONS_MOST = 20_000
BEST = "query long, slot int, score long, key long"


def round_of(place: Column) -> Column:
    """The round of the row at a place (from 0) of any order of all rows."""
    later = F.floor(F.log(F.greatest(place, F.lit(FIRST)) / F.lit(float(FIRST))) / math.log(GROWTH)) + 1
    return F.when(place < FIRST, F.lit(0)).otherwise(later).cast("int")


def dealt(rows: DataFrame, count: int) -> DataFrame:
    """Add ``spread``, a number of each row that equal rows do not share, and ``round`` by it; to be written, as both are drawn."""
    rows = rows.withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    place = F.pmod("spread", F.lit(1 << 30)) * F.lit(count / (1 << 30))
    return rows.withColumn("round", round_of(place))


def numbered(queries: DataFrame) -> DataFrame:
    """Add ``query``, a number of its own for each row, and write the rows."""
    return written(queries.withColumn("query", F.monotonically_increasing_id()), "queries")


def search(queries: DataFrame, candidates: DataFrame, scan, keep: int, width: int) -> DataFrame:
    """(``query``, ``slot``, ``score``, ``key``): the ``keep`` best candidates for each slot of each query, ties to the smaller key, null last.

    ``queries`` has ``query`` and what ``scan`` needs, ``candidates`` ``key``, ``round``, ``spread`` and the same; both are
    written tables. ``width``: bytes of a row, about. ``scan(queries, candidates)`` gets Arrow tables of a group and of a bundle and returns
    the best of them as rows of ``BEST``; ``floors`` of a query holds (slot, score) for slots that have ``keep`` rows so far: nothing below is asked for.
    """
    spark = candidates.sparkSession
    ship(spark)
    counts = {row["round"]: row["count"] for row in candidates.groupBy("round").count().collect()}  # a row per round
    asked = queries.count()
    groups = max(1, -(-asked // max(1, min(GROUP_ROWS, HELD_BYTES // (8 * width)))))
    most = max(1, min(BUNDLE_ROWS, HELD_BYTES // width))
    size = min(most, max(BUNDLE_LEAST, -(-sum(counts.values()) * groups // BUNDLES_WISHED)))
    queries = queries.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    best = spark.createDataFrame([], BEST)
    for number in sorted(counts) if asked else []:
        bundles = -(-counts[number] // size)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        parts = min(PARTITIONS_MOST, 2 * groups * bundles)
        last = best.groupBy("query", "slot").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= keep)
        floors = last.groupBy("query").agg(F.collect_list(F.struct("slot", "score")).alias("floors"))  # an entry per slot
        one = queries.join(floors, "query", "left").withColumn("bundle", every(bundles))
        other = candidates.where(F.col("round") == number).drop("round").withColumn("bundle", F.pmod(F.xxhash64("spread"), F.lit(bundles)).cast("int"))
        other = other.drop("spread").withColumn("group", every(groups))
        at = ["group", "bundle"]
        one, other = (side.repartition(parts, *at).groupBy(*at) for side in (one, other))
        found = one.cogroup(other).applyInArrow(scan, BEST)
        order = Window.partitionBy("query", "slot").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        found = best.unionByName(found).withColumn("place", F.row_number().over(order))
        best = written(found.where(F.col("place") <= keep).drop("place"), "best")
    return best


def ranked(best: DataFrame) -> DataFrame:
    """Add ``rank``, from 1, within each query and slot."""
    order = Window.partitionBy("query", "slot").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return best.withColumn("rank", F.row_number().over(order))


def top(query: np.ndarray, score: np.ndarray, key: np.ndarray, keep: int) -> np.ndarray:
    """Indexes of the ``keep`` best entries of each query, in order."""
    order = np.lexsort((key, -score, query))
    query = query[order]
    first = np.searchsorted(query, query)
    return order[np.arange(len(query)) - first < keep]


def floor_of(queries: pa.Table, slots: int = 1) -> np.ndarray:
    """The floors of each query and slot, the least possible score where there is none."""
    out = np.full((len(queries), slots), np.iinfo(np.int64).min)
    lists = queries["floors"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    entries = lists.flatten()
    if len(entries):
        owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        out[owner, entries.field("slot").to_numpy(zero_copy_only=False)] = entries.field("score").to_numpy(zero_copy_only=False)
    return out


def as_best(query: np.ndarray, slot: np.ndarray, score: np.ndarray, key: np.ndarray) -> pa.Table:
    return pa.table({"query": pa.array(query, pa.int64()), "slot": pa.array(slot, pa.int32()), "score": pa.array(score, pa.int64()), "key": pa.array(key, pa.int64())})
