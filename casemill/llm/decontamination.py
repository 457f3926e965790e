"""Test passages in documents, found by greedy string tiling.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower case. A seed is ``LEAST`` words in a
row that a document and a test item share; Spark joins the seeds of both. For every pair with enough seeds the longest
runs of words that both have, and that overlap no run taken before, are taken one after the other (running
Karp-Rabin: windows of both sides meet by hash, the window length falls to ``LEAST``). A document holds the item if the
runs, in whatever order, cover ``COVERAGE`` of the item's words.

Null and empty texts and items have no words and match nothing, as do items of fewer than ``LEAST`` words. Item or
document ids that are null are ids like others. Repeated rows of a document or an item give one pair, with the highest coverage.
Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from casemill.llm.keys import BROADCAST_KEYS, bounded, without
from casemill.llm.shipping import ship
from casemill.llm.words import SIGNS, Words, slices, windows
from casemill.sources.scratch import written

LEAST, COVERAGE = 5, 0.5
#: Longest window length that the search begins with.
FIRST = 32
#: Bits of the filter over the items' seeds, per seed and at most; it only saves work.
FILTER_BITS, FILTER_MOST = 64, 1 << 27
#: Places that a seed's documents are spread over where the seeds are too many to be sent, and items of a document in a row.
SALTS, ITEMS = 32, 64
#: Words of items that are sent to the executors with their documents' keys; more are joined by shuffling.
SENT_WORDS = 4_000_000


def tiles(item: list[int], text: list[int], least: int = LEAST, first: int = FIRST) -> list[tuple[int, int, int]]:
    """Non-overlapping runs (place in item, place in text, length) of equal words, the longest first. ``None`` in ``text``
    matches nothing."""
    free_item, free_text = [True] * len(item), [word is not None for word in text]
    found, size = [], max(min(first, len(item)), least)
    while size >= least:
        longest, matches = _scan(item, text, free_item, free_text, size)
        if longest > 2 * size:
            size = longest
            continue
        for length, at, to in sorted(m for m in matches if m[0] == longest):
            if all(free_item[at : at + length]) and all(free_text[to : to + length]):
                free_item[at : at + length] = free_text[to : to + length] = [False] * length
                found.append((at, to, length))
        if not matches:
            size = max(size // 2, least) if size > least else 0
    return found


def _hashes(words: list, free: list[bool], size: int):
    """(place, Karp-Rabin hash) of every free window."""
    prime, base = (1 << 61) - 1, 1_000_003
    top = pow(base, size - 1, prime)
    value = run = 0
    for at, word in enumerate(words):
        if not free[at]:
            value = run = 0
            continue
        if run == size:
            value = (value - words[at - size] * top) % prime
        else:
            run += 1
        value = (value * base + word) % prime
        if run == size:
            yield at - size + 1, value


def _scan(item, text, free_item, free_text, size) -> tuple[int, list[tuple[int, int, int]]]:
    """The longest match, and all matches of ``size`` words and more that cannot be extended."""
    places = defaultdict(list)
    for at, value in _hashes(item, free_item, size):
        places[value].append(at)
    longest, matches = 0, []
    if not places:
        return 0, []
    for to, value in _hashes(text, free_text, size):
        for at in places.get(value, ()):
            if at and to and free_item[at - 1] and free_text[to - 1] and item[at - 1] == text[to - 1]:
                continue  # part of a match that begins before
            length = 0
            while at + length < len(item) and to + length < len(text) and free_item[at + length] and free_text[to + length] and item[at + length] == text[to + length]:
                length += 1
            if length >= size:
                matches.append((length, at, to))
                longest = max(longest, length)
                if length > 2 * size:
                    return length, []
    return longest, matches


def _seeds(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with bounds, and hashes of all windows of full length with their texts."""
    words = Words(pc.utf8_lower(column.cast(pa.large_string())), between=SIGNS)
    hashes = words.hashes()
    seeds, ends = windows(hashes, words.bounds, LEAST)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    full = np.diff(words.bounds)[owner] >= LEAST
    return hashes, words.bounds, seeds[full], owner[full]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def item_seeds(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(``item_id``, ``item``: the words' hashes, ``seeds``: its distinct seeds with their ``places``, how often each is in it) of items with seeds, repeated items once."""
    kind = benchmark.schema[key].dataType.simpleString()

    def seeds(batches):
        for rows in slices(batches):
            hashes, bounds, found, owner = _seeds(rows["text"])
            each = [np.unique(found[owner == at], return_counts=True) for at in range(len(rows))]
            yield pa.record_batch(
                {
                    "item_id": rows["item_id"],
                    "item": pa.array([_signed(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.list_(pa.int64())),
                    "seeds": pa.array([[{"seed": s, "places": n} for s, n in zip(_signed(seed).tolist(), places.tolist())] for seed, places in each], pa.list_(pa.struct([("seed", pa.int64()), ("places", pa.int64())]))),
                }
            )

    rows = benchmark.select(benchmark[key].alias("item_id"), benchmark[text].alias("text"))
    return rows.mapInArrow(seeds, f"item_id {kind}, item array<long>, seeds array<struct<seed:long,places:long>>").where(F.size("seeds") > 0).distinct()


def seed_pairs(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(``key``, ``item_id``, ``item``) of pairs whose shared seeds could cover enough of the item. ``documents``: ``key``, ``text``."""
    seeds = items.select("item_id", F.inline("seeds"))
    n_seeds = seeds.count()
    bits = 1 << max(int(np.ceil(np.log2(max(min(n_seeds * FILTER_BITS, FILTER_MOST), 1 << 16)))), 16)
    slots = seeds.select(F.expr(f"shiftrightunsigned(seed, {64 - int(np.log2(bits))})").alias("slot")).distinct()
    chosen = np.zeros(bits, bool)
    chosen[slots.toPandas()["slot"].to_numpy(np.int64)] = True  # FILTER_MOST at most
    sent = documents.sparkSession.sparkContext.broadcast(np.packbits(chosen))
    shift = np.uint64(64 - int(np.log2(bits)))
    kind = documents.schema["key"].dataType.simpleString()

    def found(batches):
        filter_ = np.unpackbits(sent.value).view(bool)
        for rows in slices(batches):
            _, _, seeds, owner = _seeds(rows["text"])
            hit = filter_[(seeds >> shift).astype(np.int64)]
            seeds, owner = seeds[hit], owner[hit]
            order = np.lexsort((seeds, owner))
            seeds, owner = seeds[order], owner[order]
            once = np.ones(len(seeds), bool)
            once[1:] = (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch({"key": rows["key"].take(pa.array(owner[once])), "seed": pa.array(_signed(seeds[once]), pa.int64())})

    met = documents.select("key", "text").mapInArrow(found, f"key {kind}, seed long")
    if n_seeds <= BROADCAST_KEYS:
        shared = met.join(bounded(seeds, n_seeds), "seed")
    else:
        met = met.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
        shared = met.join(seeds.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["seed", "salt"])
    pairs = shared.groupBy("key", "item_id", "seed").agg(F.max("places").alias("places")).groupBy("key", "item_id").agg(F.sum("places").alias("shared"))  # a run of n words has n - LEAST + 1 seed places
    pairs = pairs.join(items.select(F.col("item_id").alias("_item_id"), "item"), F.col("item_id").eqNullSafe(F.col("_item_id"))).drop("_item_id")
    return pairs.where(LEAST * F.col("shared") >= coverage * F.size("item")).select("key", "item_id", "item")


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The pairs of documents and items they hold: key, ``item_id``, ``n_tiles``, ``covered``, ``item_words``, ``coverage``."""
    ship(documents.sparkSession)
    rows = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    items = written(item_seeds(benchmark, item_key, item_text), "test-seeds")
    pairs = written(seed_pairs(rows, items, coverage), "test-pairs")
    sizes = pairs.groupBy(F.col("key").alias("asked")).agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(sizes, F.col("key").eqNullSafe(F.col("asked"))).withColumn("block", F.pmod(F.xxhash64("item_id"), F.ceil(F.col("n") / ITEMS)))
    asked = dealt.groupBy("asked", "block").agg(F.collect_list(F.struct("item_id", "item")).alias("items"))  # about ITEMS of a document's items
    asked = written(asked.drop("block"), "test-asked")
    if (pairs.agg(F.sum(F.size("item"))).first()[0] or 0) <= SENT_WORDS:
        asked = bounded(asked)
    kind, item_kind = documents.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()

    def tiled(batches):
        for rows in slices(batches):
            hashes, bounds, _, _ = _seeds(rows["text"])
            out = []
            for at, (doc, items) in enumerate(zip(rows["key"].to_pylist(), rows["items"].to_pylist())):
                words = _signed(hashes[bounds[at] : bounds[at + 1]])
                for item in items:
                    found = tiles(item["item"], _near(words, item["item"]))
                    covered = sum(length for _, _, length in found)
                    out.append((doc, item["item_id"], len(found), covered, len(item["item"])))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.record_batch({"key": pa.array(columns[0], rows["key"].type), "item_id": pa.array(columns[1], rows["items"].type.value_type.field(0).type)} | {name: pa.array(column, pa.int64()) for name, column in zip(("n_tiles", "covered", "item_words"), columns[2:])})

    near = rows.join(asked, rows["key"].eqNullSafe(asked["asked"])).select("key", "text", "items")
    made = near.mapInArrow(tiled, f"key {kind}, item_id {item_kind}, n_tiles long, covered long, item_words long")
    best = made.groupBy("key", "item_id").agg(F.max(F.struct("covered", F.negate("n_tiles").alias("fewer"), "item_words")).alias("best"))
    best = best.select(F.col("key").alias(key), "item_id", F.negate("best.fewer").alias("n_tiles"), "best.covered", "best.item_words")
    return best.withColumn("coverage", F.col("covered") / F.col("item_words")).where(F.col("coverage") >= coverage)


def _near(words: np.ndarray, item: list[int]) -> list[int | None]:
    """The words that lie in windows whose words are all in the item; other stretches are one break each."""
    inside = np.isin(words, np.array(item, np.int64))
    runs = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    out: list[int | None] = []
    for begin, end in zip(runs[::2], runs[1::2]):
        if end - begin >= LEAST:
            out += words[begin:end].tolist()
            out.append(None)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item."""
    return without(documents, written(contaminated(documents, benchmark, coverage, key, text).select(key), "contaminated"), key)
