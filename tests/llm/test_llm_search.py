"""Ranked lexical search, exact top-k and hard negatives against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.llm import impact_search as I, negative_mining as N, rounds, segment_search as S
from casemill.llm.vectors import as_integers, as_longs

VECTORS = "vec_id long, embedding array<float>, label int, query long, score string, vector int, key int"


@pytest.fixture
def small_rounds(monkeypatch):
    """Several rounds, bundles and groups on small tables."""
    monkeypatch.setattr(rounds, "FIRST", 24)
    monkeypatch.setattr(I, "FIRST", 24)
    monkeypatch.setattr(rounds, "GROWTH", 3)
    monkeypatch.setattr(rounds, "BUNDLE_LEAST", 60)
    monkeypatch.setattr(rounds, "GROUP_ROWS", 20)


def whole(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def vector_rows(seed=3, n=400):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(19)], draw.randrange(4)) for i in range(n)]
    rows += [(1000 + i, rows[50][1], 1) for i in range(120)]  # a group of copies
    rows += [(50, rows[50][1], rows[50][2])] * 2  # a query that repeats
    rows += [(100, [0.5] * 19, 2), (150, [0.1] * 7, 1), (151, [0.2] * 7, 1), (152, [0.3] * 7, 0), (200, [], 1), (201, [], 1), (202, [], 2)]
    rows += [(250, None, 1), (251, [None] * 19, 1), (252, [float("nan")] * 19, 1), (253, [float("inf")] * 19, 1), (None, [0.5] * 19, 1)]
    rows += [(254, [0.3] * 19, None), (300, [3.0e4] + [0.0] * 18, 3), (-50, [0.0] * 19, 0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], VECTORS).repartition(5)


def brute_top(rows, step, k):
    use = [(i, whole(v)) for i, v, _ in rows if i is not None and usable(v)]
    out = []
    for query, q in sorted({(i, tuple(v)) for i, v in use if i % step == 0}):
        found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in use if i != query and len(v) == len(q))
        out += [(query, rank, i, -score) for rank, (score, i) in enumerate(found[:k], 1)]
    return sorted(out)


def test_top_k_is_that_of_all_pairs(spark, small_rounds):
    rows = vector_rows()
    got = S.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 50, 5)


def test_top_k_of_huge_components_and_of_few_rows(spark):
    rows = [(0, [1e8, 2.0, -3.0], 0), (1, [2e5, 1.0, 1.0], 0), (2, [2e5, 1.0, 2.0], 0), (3, [-1.0, 0.0, 0.0], 0)]
    assert sorted(map(tuple, S.top_k(frame(spark, rows), F.col("vec_id") == 0, 5).collect())) == [r for r in brute_top(rows, 50, 5) if r[0] == 0]
    rows = [(0, [3e30], 0), (1, [3e30], 0)]
    with pytest.raises(Exception, match="does not fit a long"):
        S.top_k(frame(spark, rows), F.col("vec_id") == 0, 5).collect()
    assert S.top_k(frame(spark, []), F.col("vec_id") == 0, 5).collect() == []


def test_no_level_of_statistics_rules_out_a_pair_that_counts():
    draw = np.random.Generator(np.random.PCG64(5))
    one, other = (np.floor(64 * draw.normal(0, 0.3, (n, 37)).cumsum(1)) for n in (30, 200))
    other[100:] = one[3] + draw.integers(-2, 3, (100, 37))
    mine, theirs = S.Indexed(one, np.arange(30)), S.Indexed(other, np.arange(200) + 1000)
    exact = one @ other.T
    floor = np.sort(exact, axis=1)[:, -5].astype(np.int64)
    alive = S.open_pairs(mine, theirs, floor)
    assert alive[exact >= floor[:, None]].all()
    assert alive.mean() < 0.7
    assert [len(x) for x in S.levels(64)] == [1, 4, 16]


def brute_negatives(rows, step, keep, low=80, high=100):
    use = [(i, whole(v), label) for i, v, label in rows if i is not None and label is not None and usable(v)]
    out = []
    for anchor, a, label in sorted({(i, tuple(v), label) for i, v, label in use if i % step == 0}):
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other) for i, v, other in use if i != anchor and len(v) == len(a))
        for positive, pid, _ in [x for x in scored if x[2] == label][:keep]:
            fit = [(s, i) for s, i, other in scored if other != label and low * -positive <= 100 * -s <= high * -positive]
            out += [(anchor, pid, rank, i, -positive, -s) for rank, (s, i) in enumerate(fit[:keep], 1)]
    return sorted(out)


def test_hard_negatives_are_those_of_all_pairs(spark, small_rounds):
    rows = vector_rows(4)
    got = N.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, 5, 40, 100)
    want = brute_negatives(rows, 50, 5, 40)
    assert len(want) > 100
    assert sorted(map(tuple, got.collect())) == want


def test_hard_negatives_of_an_empty_table(spark):
    assert N.mine(frame(spark, []), F.col("vec_id") % 50 == 0, 5, 5, 80, 100).collect() == []


@pytest.mark.parametrize("scale, kind", [(3, np.int32), (1 << 20, np.int64), (1 << 45, object), (1 << 70, object)])
def test_bit_planes_and_subset_sums_give_the_inner_product(scale, kind):
    draw = random.Random(scale)
    anchors, others = ([[float(draw.randrange(-scale, scale)) for _ in range(21)] for _ in range(n)] for n in (5, 40))
    others[0] = [float(-scale)] * 21
    planes = N.plane_count(min(map(min, others)), max(map(max, others)))
    packed, sums = N.packed_planes(np.array(others), planes), N.subset_sums(np.array(anchors), planes)
    assert packed.shape == (40, planes, 3) and sums.dtype == kind
    want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in anchors] for x in others]
    assert N.scores(packed, sums).tolist() == want
    assert as_integers(np.array(others)).tolist() == [[int(x) for x in row] for row in others]


def test_scores_beyond_longs_are_an_error():
    assert as_longs(np.array([2**63 - 1, -5], object)).tolist() == [2**63 - 1, -5]
    with pytest.raises(OverflowError):
        as_longs(np.array([2**63], object))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute_ranked(docs, items, k):
    counted = [(key, Counter(terms(text)), len(terms(text))) for key, text in docs if terms(text)]
    n_all, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, tf, _ in counted for t in tf)
    out = []
    for item, text in sorted(set(items), key=repr):
        found = []
        for key, tf, n in counted:
            m = 100 - 75 + (75 * n * n_all) // length
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if t in tf)
            if score > 0:
                found.append((-score, key is None, key or 0))
        out += [(item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def lexical_rows():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "été", "日本", "a1b", "x" * 70, "x" * 69 + "y"]
    docs = [(i, draw.choice([" ", ", ", "\n"]).join(draw.choice(vocabulary[: draw.choice([20, 306])]) for _ in range(draw.randrange(0, 60)))) for i in range(300)]
    docs += [(1000 + i, "W1 w2, w3 ÉA éa w299") for i in range(150)]  # a group of copies
    docs += [(5, docs[5][1]), (5, "w7 w8 w9"), (None, "w299 w298 w1"), (None, None), (7000, None), (7001, " ,;\x00"), (7002, " ".join(vocabulary) * 400)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 40)))) for i in range(40)]
    items += [(3, "w1 w2 w2 w2"), (3, "w1 w2 w2 w2"), (90, None), (91, ""), (92, "nowhere to be found"), (None, "w5 été 日本"), (93, "w1")]
    return docs, items


@pytest.mark.parametrize("sent", [I.SENT_TERMS, 0])
def test_ranked_documents_are_those_of_all_scores(spark, small_rounds, monkeypatch, sent):
    monkeypatch.setattr(I, "SENT_TERMS", sent)
    docs, items = lexical_rows()
    documents = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, term string, query int, spread int").repartition(4)
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, weight int")
    got = I.ranked_documents(documents, benchmark, 10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranked(docs, items, 10)


def test_ranked_documents_of_empty_tables(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert I.ranked_documents(documents, items, 10).collect() == []
    assert I.ranked_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.limit(0), 10).collect() == []


def test_bounds_of_a_bucket_keep_every_document_that_counts():
    draw = np.random.Generator(np.random.PCG64(2))
    owner, term = np.nonzero(draw.random((500, 40)) < 0.2)
    impact = draw.integers(1, 10**6, len(owner))
    weight = draw.integers(0, 9000, 40)
    root = np.sqrt(weight.astype(float))
    bucket = I.Postings(owner, term, impact, 500, 40)
    squares = np.bincount(owner, (impact * root[term]) ** 2, minlength=500)
    own = np.arange(0, 40, 3)
    score = bucket.exact(own, weight[own])
    heavy = own[np.argsort(-root[own])][:5]
    rest = float(np.sqrt(weight[np.setdiff1d(own, heavy)].sum()))
    floor = np.sort(score)[-10]
    kept = bucket.survivors(heavy, root[heavy], root, rest, squares, float(floor))
    assert set(np.flatnonzero(score >= floor)) <= set(kept) and len(kept) < 500
