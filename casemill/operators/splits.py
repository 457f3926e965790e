"""Draws with replacement of very many stays: the number of stays is split down a tree of masses.

Drawing n times by weight and counting the items is one multinomial draw, and a multinomial draw splits: first over the
parts of the items, then inside each part. Items are hashed to a tree of at most ``FANOUT`` children a node; a node deals
its count to its children, each an exact binomial of what is left. So the work grows with the items and not with n, no
position is looked up, and parts that nothing fell on are never opened. Stays arise beside their item.

A node's numbers come from its own generator, seeded by (seed, salt, node), and its children are taken in the order of
their names: the result is the same on every partitioning and after any lost executor. The depth follows from the number of
items alone, and a leaf holds ``FANOUT`` of them on average, whatever their masses: a hot item is one row until its stays
are made, and these are made in pieces of ``PIECE``.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casemill.functions.text import row_key
from casemill.functions.uniform import key_hash
from casemill.operators.draws import sum_duplicates
from casemill.sources.scratch import written

#: Children of a node, as hexadecimal digits, and the stays that one row is opened to.
DIGITS = 3
FANOUT = 16**DIGITS
PIECE = 1 << 16
#: Stays that a task makes.
TASK_STAYS = 1 << 21


def dealt(n: int, masses: list[int], draw: np.random.Generator) -> list[int]:
    """``n`` dealt to children by mass: each takes a binomial of what the ones before it left."""
    left, rest = n, sum(masses)
    counts = []
    for mass in masses:
        took = left if mass == rest else int(draw.binomial(left, mass / rest)) if left else 0
        counts.append(took)
        left, rest = left - took, rest - mass
    return counts


def _deal(seed: int, salt: str):
    """Children of one node (``node``, ``n``, ``first``, ``w`` and a name to order them by) with their own ``n`` and ``first``."""

    def deal(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows["child"]))
        name = f"{seed}|{salt}|{rows['node'][0].as_py()}"
        draw = np.random.Generator(np.random.PCG64(int.from_bytes(md5(name.encode()).digest(), "little")))
        counts = np.array(dealt(rows["n"][0].as_py(), rows["w"].to_pylist(), draw), np.int64)
        first = rows["first"].to_numpy() + np.cumsum(counts) - counts
        for column, values in (("n", counts), ("first", first)):
            rows = rows.set_column(rows.column_names.index(column), column, pa.array(values, pa.int64()))
        return rows.filter(pa.array(counts > 0))

    return deal


def _below(children: DataFrame, parents: DataFrame, seed: int, salt: str) -> DataFrame:
    """Deal the counts of ``parents`` (node, n, first) to ``children`` (node, child, w, …)."""
    met = children.join(parents, "node")
    return met.groupBy("node").applyInArrow(_deal(seed, salt), met.schema)


def split_counts(table: DataFrame, weight: str | None, identity: list[str], n: int, seed: int, salt: str = "profile") -> DataFrame:
    """The distinct rows of ``identity`` that ``n`` draws by weight fall on: ``n_drawn`` and ``first``, the number of draws
    on the rows before it. Rows without a positive weight are never drawn; nulls in ``identity`` are values like others.
    Without any row of positive weight, or with ``n`` of zero, there are none."""
    items = sum_duplicates(table, weight, identity).select(F.struct(*identity).alias("item"), row_key(*identity).alias("child"), "w")
    items = written(items.withColumn("hash", key_hash("child")), "split-items")
    levels, room = 0, FANOUT
    size = items.count()
    while size > room:
        levels, room = levels + 1, room * FANOUT
    # the lowest inner level takes only as many digits as its leaves need
    digits = [DIGITS * level for level in range(1, levels)]
    if levels:
        short, leaves = 1, size / (FANOUT * FANOUT ** (levels - 1))
        while 16**short < leaves and short < DIGITS:
            short += 1
        digits.append(DIGITS * (levels - 1) + short)
    parents = table.sparkSession.createDataFrame([("", int(n), 0)], StructType([StructField("node", items.schema["hash"].dataType), *[StructField(x, LongType()) for x in ("n", "first")]]))
    above = 0
    for upto in digits:
        masses = items.groupBy(F.substring("hash", 1, upto).alias("child")).agg(F.sum("w").alias("w"))
        children = masses.withColumn("node", F.substring("child", 1, above))
        parents = written(_below(children, parents, seed, salt).select(F.col("child").alias("node"), "n", "first"), "split-level")
        above = upto
    leaves = items.withColumn("node", F.substring("hash", 1, above)).drop("hash")
    return _below(leaves, parents, seed, salt).select("item.*", F.col("n").alias("n_drawn"), "first")


def stays_of(counts: DataFrame, n: int, id_col: str = "stay_id") -> DataFrame:
    """One row per draw of ``split_counts``, numbered from 0 without gaps; stays of one item have neighbouring numbers. Rows
    are opened in pieces, which are dealt to tasks before their stays are made."""
    spark = counts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_STAYS))
    piece = F.lit(PIECE).cast("bigint")
    last = F.call_function("div", F.col("n_drawn") - 1, piece)
    pieces = counts.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    begin = F.col("first") + F.col("_piece") * piece
    pieces = pieces.withColumns({"_begin": begin, "_end": F.least(begin + piece, F.col("first") + F.col("n_drawn")) - 1})
    stays = pieces.repartition(tasks, "_begin").withColumn(id_col, F.explode(F.sequence("_begin", "_end")))
    return stays.select(id_col, *[c for c in counts.columns if c not in ("n_drawn", "first", id_col)])


def draw_many(table: DataFrame, weight: str | None, identity: list[str], n: int, seed: int, salt: str = "profile", id_col: str = "stay_id") -> DataFrame:
    """``n`` weighted draws with replacement from a whole table, as stays with the drawn row's ``identity``."""
    return stays_of(written(split_counts(table, weight, identity, n, seed, salt), "split-counts"), n, id_col)
