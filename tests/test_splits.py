"""Draws by splitting counts: the law, and independence of partitioning."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from casemill.operators import splits
from casemill.operators.splits import dealt, draw_many, split_counts, stays_of
from tests.test_draws import close


def test_dealt_counts_follow_the_multinomial_law():
    draw = np.random.default_rng(1)
    rows = np.array([dealt(20, [1, 0, 3, 6], draw) for _ in range(4000)])
    assert (rows.sum(1) == 20).all() and not rows[:, 1].any()
    shares = np.array([0.1, 0, 0.3, 0.6])
    spread = np.outer(shares, -shares) * 20 + np.diag(shares) * 20
    assert np.abs(rows.mean(0) - 20 * shares).max() < 0.15
    assert np.abs(np.cov(rows.T) - spread).max() < 0.35
    assert dealt(0, [1, 2], draw) == [0, 0] and dealt(1 << 50, [5], draw) == [1 << 50]


def test_stays_follow_the_weights_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(splits, "FANOUT", 16)
    monkeypatch.setattr(splits, "DIGITS", 1)
    table = spark.range(600).select(F.col("id").alias("w"), (F.col("id") % 300).alias("node"))  # names of the plan's own columns
    weights = Counter()
    for i in range(600):
        weights[i % 300] += i
    n = 60_000
    rows = draw_many(table.withColumn("weight", F.col("w")).drop("w"), "weight", ["node"], n, 3).collect()
    assert sorted(r["stay_id"] for r in rows) == list(range(n))
    close(Counter(r["node"] for r in rows), {k: v / sum(weights.values()) for k, v in weights.items() if v}, n)


def test_the_partitioning_changes_nothing(spark):
    table = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 97 / 7).alias("p"))
    got = [sorted(map(tuple, split_counts(table.repartition(parts), "p", ["k"], 50_000, 5).collect())) for parts in (1, 13)]
    assert got[0] == got[1] and sum(r[1] for r in got[0]) == 50_000
    ends = 0
    for _, count, first in sorted(got[0], key=lambda r: r[2]):
        assert first == ends
        ends += count
    assert got[0] != sorted(map(tuple, split_counts(table, "p", ["k"], 50_000, 6).collect()))


def test_a_hot_item_is_opened_in_pieces_and_odd_rows_have_their_rule(spark, monkeypatch):
    monkeypatch.setattr(splits, "PIECE", 1000)
    table = spark.createDataFrame([("hot", 1 << 40, 2.0), (None, 9_007_199_254_740_993, 1.0), ("never", 1, 0.0), ("nan", 2, float("nan")), ("low", 3, -1.0)], "k string, code bigint, w0 double")
    counts = split_counts(table, "w0", ["k", "code"], 30_000, 1)
    rows = Counter((r["k"], r["code"]) for r in stays_of(counts, 30_000).collect())
    assert set(rows) == {("hot", 1 << 40), (None, 9_007_199_254_740_993)}
    close(Counter(k for k, _ in rows.elements()), {"hot": 2 / 3, None: 1 / 3}, 30_000)
    assert split_counts(table.where("w0 = 0"), "w0", ["k"], 10, 1).count() == 0
    assert split_counts(table, "w0", ["k"], 0, 1).count() == 0
