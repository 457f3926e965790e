"""Ranked lexical search over impact vectors, in buckets of falling vector length (after LEMP).

A term of a document has an impact, a whole number from its occurrences and the document's length; an item gives each of its
terms a weight, and a score is the inner product of weights and impacts. With coordinates multiplied by the root of the
term's weight on both sides, the product of two vectors' lengths bounds their score (Cauchy-Schwarz).

Documents are dealt to rounds by the length of their vectors over all terms of the items, the longest first, and within a
round to bundles of bounded size (``rounds``). A task takes a group of items and a bundle, works the lengths out over the
group's terms and passes the documents in buckets, longest first. Once a bucket's longest vector times the item's length is under the item's
last place so far, this and all later buckets are skipped. Inside a bucket the item's heaviest coordinates are summed and the rest is bounded by
the lengths that remain; documents that could still reach the last place are scored again, whole and in whole numbers.

Null and empty texts have no terms and are never found, nor are documents without a term of the item. Rows that repeat an id are
documents of their own; equal scores go to the smaller id, null last. Items that repeat an id with the same text count
once, with another text they are ranked each for itself. Very long texts are one document like others. Empty tables give no rows.
Other columns are not read. Terms are told apart by 64-bit hashes (``words``). Ids are longs below 2**63 - 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casemill.llm.rounds import FIRST, GROWTH, as_best, floor_of, numbered, ranked, search, top
from casemill.llm.shipping import ship
from casemill.llm.words import SIGNS, Words, slices
from casemill.sources.scratch import written

#: Terms of the items that are sent to every executor at most, 8 bytes each; with more, documents' terms are joined with them.
SENT_TERMS = 1 << 20
#: Documents in a bucket, and the share of an item's squared length that its heaviest coordinates leave out.
BUCKET, REST = 2048, 0.25
_NONE = np.iinfo(np.int64).max


def term_counts(rows: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``key``, ``n`` (all terms with repeats), ``terms`` and ``counts`` of each text with a term; with ``known``, sorted
    hashes, only these terms are listed."""
    sent = None if known is None else rows.sparkSession.sparkContext.broadcast(known)  # SENT_TERMS at most

    def counted(batches):
        for batch in slices(batches):
            words = Words(batch["text"], fold=True, between=SIGNS)
            n = np.diff(words.bounds)
            term, owner = words.hashes(), words.owners()
            if sent is not None:
                at = np.minimum(np.searchsorted(sent.value, term), max(len(sent.value) - 1, 0))
                found = sent.value[at] == term if len(sent.value) else np.zeros(len(term), bool)
                term, owner = term[found], owner[found]
            order = np.lexsort((term, owner))
            term, owner = term[order], owner[order]
            new = np.ones(len(term), bool)
            new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(term)))
            bounds = pa.array(np.searchsorted(owner[first], np.arange(len(n) + 1)).astype(np.int32))
            terms = pa.ListArray.from_arrays(bounds, pa.array(term[first].view(np.int64)))
            counts = pa.ListArray.from_arrays(bounds, pa.array(count.astype(np.int64)))
            yield pa.record_batch({"key": batch["key"], "n": pa.array(n, pa.int64()), "terms": terms, "counts": counts}).filter(pa.array(n > 0))

    return rows.mapInArrow(counted, "key long, n long, terms array<long>, counts array<long>")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def impacts(documents: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (``key``, ``spread``, ``round``, ``terms``, ``impacts``) and the ``weight`` of each of ``terms`` that some document holds."""
    ship(documents.sparkSession)
    few = terms.count() <= SENT_TERMS
    known = np.sort(terms.toPandas()["term"].to_numpy(np.int64).view(np.uint64)) if few else None
    rows = written(term_counts(documents, known).withColumn("spread", F.xxhash64(F.monotonically_increasing_id())), "term-counts")
    whole = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    n_documents, length = whole["documents"], whole["length"] or 1
    if not few:
        each = rows.select("key", "spread", "n", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("key", "spread", "n", F.col("x.terms").alias("term"), F.col("x.counts").alias("count"))
        pairs = F.array_sort(F.collect_list(F.struct("term", "count")))  # at most the terms of the items
        own = each.join(terms, "term").groupBy("spread", "key", "n").agg(pairs.alias("pairs"))
        rows = written(own.select("key", "spread", "n", F.col("pairs.term").alias("terms"), F.col("pairs.count").alias("counts")), "item-terms")
    rows = rows.where(F.size("terms") > 0)
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_documents)) + 2) / (2 * F.col("df").cast("double") + 1)))
    weights = written(held.select("term", weight.cast("long").alias("weight")), "term-weights")

    norm = 100 - 75 + _div(75 * F.col("n") * F.lit(n_documents).cast("long"), F.lit(length).cast("long"))
    impact = F.transform("counts", lambda tf: _div(F.lit(1_000_000_000).cast("long") * tf, F.lit(1000).cast("long") * tf + 8 * F.col("m")))
    rows = rows.withColumn("m", norm.cast("long")).select("key", "spread", "terms", impact.alias("impacts"))
    rows = rows.withColumn("length", F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))))
    rows = written(rows, "impacts")
    shares, upto = [], FIRST
    while upto < n_documents:
        shares.append(1 - upto / n_documents)
        upto *= GROWTH
    cuts = rows.agg(F.percentile_approx("length", shares).alias("cuts")).first()["cuts"] or [] if shares else []
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.col("length") < cut, 1).otherwise(0)
    return rows.withColumn("round", number), weights


class Postings:
    """The documents of a bucket by term: which hold a term, and with what impact."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, terms: int):
        order = np.argsort(term, kind="stable")
        self.owner, self.impact = owner[order], impact[order]
        self.bounds = np.searchsorted(term[order], np.arange(terms + 1))
        self.documents = documents

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        some = slice(self.bounds[term], self.bounds[term + 1])
        return self.owner[some], self.impact[some]

    def survivors(self, heavy: np.ndarray, factor: np.ndarray, root: np.ndarray, rest: float, squares: np.ndarray, floor: float) -> np.ndarray:
        """Documents whose sum over the heavy coordinates and bound for the others reach ``floor``."""
        sums, left = np.zeros(self.documents), squares.copy()
        for term, by in zip(heavy, factor):
            owner, impact = self.of(term)
            value = impact * root[term]
            sums[owner] += by * value
            left[owner] -= value * value
        bound = sums + rest * np.sqrt(np.maximum(left, 0) + 1e-9 * squares)
        return np.flatnonzero(bound * (1 + 1e-9) + 1 >= floor)

    def exact(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.documents, np.int64)
        for term, weight in zip(terms, weights):
            owner, impact = self.of(term)
            out[owner] += weight * impact
        return out


def _scan(left: pa.Table, right: pa.Table, keep: int) -> pa.Table:
    numbers, floors = left["query"].to_numpy(), np.maximum(floor_of(left)[:, 0], 1)
    items = left.select(["terms", "weights", "counts"]).to_pylist()
    term_of = np.array([t for item in items for t in item["terms"]], np.int64)
    weight_of = np.array([w for item in items for w in item["weights"]], np.int64)
    known, first = np.unique(term_of, return_index=True)
    weight = weight_of[first]
    root = np.sqrt(weight.astype(np.float64))

    keys = right["key"].combine_chunks().fill_null(_NONE)
    keys = np.concatenate([k.to_numpy(zero_copy_only=False) for k in (keys.chunks if isinstance(keys, pa.ChunkedArray) else [keys])])
    flat = lambda name: np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy(zero_copy_only=False) for c in right[name].chunks]])
    sizes = np.concatenate([np.zeros(0, np.int64), *[c.value_lengths().to_numpy(zero_copy_only=False) for c in right["terms"].chunks]])
    term, impact, owner = flat("terms"), flat("impacts"), np.repeat(np.arange(len(keys)), sizes)
    at = np.minimum(np.searchsorted(known, term), max(len(known) - 1, 0))
    mine = known[at] == term if len(known) else np.zeros(len(term), bool)
    term, impact, owner = at[mine], impact[mine], owner[mine]
    squares = np.bincount(owner, (impact * root[term]) ** 2, minlength=len(keys))
    order = np.argsort(-squares, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    owner, squares, keys = place[owner], squares[order], keys[order]
    by_place = np.argsort(owner, kind="stable")
    owner, term, impact = owner[by_place], term[by_place], impact[by_place]

    plans = []
    for item in items:
        own, count = np.searchsorted(known, np.array(item["terms"], np.int64)), np.array(item["counts"], np.int64)
        factor = count * root[own]  # the item's coordinates
        heavy = np.argsort(-factor, kind="stable")
        mass = np.cumsum(factor[heavy] ** 2)
        enough = int(np.searchsorted(mass, (1 - REST) * mass[-1])) + 1 if len(mass) else 0
        rest = float(np.sqrt(max(mass[-1] - mass[enough - 1], 0))) if enough else 0.0
        length = float(np.sqrt(mass[-1])) if len(mass) else 0.0
        plans.append((own, count * weight[own], own[heavy[:enough]], factor[heavy[:enough]], rest, length))

    query, score, key = (np.zeros(0, np.int64) for _ in range(3))
    for begin in range(0, len(keys), BUCKET):
        end = min(begin + BUCKET, len(keys))
        longest = float(np.sqrt(squares[begin]))
        open_ = [k for k, plan in enumerate(plans) if longest * plan[5] * (1 + 1e-9) + 1 >= floors[k]]
        if not open_ or longest == 0:
            break
        some = slice(*np.searchsorted(owner, [begin, end]))
        bucket = Postings(owner[some] - begin, term[some], impact[some], end - begin, len(known))
        found = [(query, score, key)]
        for k in open_:
            own, weights, heavy, factor, rest, _ = plans[k]
            left_over = bucket.survivors(heavy, factor, root, rest, squares[begin:end], float(floors[k]))
            if len(left_over):
                exact = bucket.exact(own, weights)[left_over]
                good = exact >= floors[k]
                found.append((np.full(int(good.sum()), k), exact[good], keys[begin:end][left_over[good]]))
        query, score, key = (np.concatenate(column) for column in zip(*found))
        chosen = top(query, score, key, keep)
        query, score, key = query[chosen], score[chosen], key[chosen]
        full = np.flatnonzero(np.bincount(query, minlength=len(floors)) >= keep)
        floors[full] = np.maximum(floors[full], score[np.searchsorted(query, full, side="right") - 1])
    out = as_best(numbers[query], np.zeros(len(query)), score, key)
    return out.set_column(3, "key", pa.array(key, pa.int64(), mask=key == _NONE))


def ranked_documents(documents: DataFrame, items: DataFrame, k: int, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item``, ``rank``, ``key`` and ``score`` of the ``k`` best documents of each item."""
    ship(documents.sparkSession)
    asked = numbered(items.select(items[item].alias("item"), items[item_text].alias("text")).dropDuplicates())
    counted = term_counts(asked.select(F.col("query").alias("key"), "text"), None)
    entry = F.explode(F.arrays_zip("terms", "counts")).alias("x")
    wanted = written(counted.select(F.col("key").alias("query"), entry).select("query", F.col("x.terms").alias("term"), F.col("x.counts").alias("count")), "item-terms")
    rows, weights = impacts(documents.select(documents[key].cast("long").alias("key"), documents[text].alias("text")), wanted.select("term").distinct())
    vectors = wanted.join(weights, "term").where("weight > 0").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("term", "weight", "count"))).alias("x"))  # the terms of one item
    vectors = vectors.select("query", F.col("x.term").alias("terms"), F.col("x.weight").alias("weights"), F.col("x.count").alias("counts"))
    # an item's terms are few beside a document's; 8 KB is about 300 of them
    best = search(written(vectors, "item-vectors"), rows, lambda left, right: _scan(left, right, k), k, 8 << 10)
    return ranked(best).join(asked.select("query", "item"), "query").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
