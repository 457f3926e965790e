"""Hard negatives of anchors, with every score from tables of subset sums (the method of four Russians).

Index. A candidate's components are written as bit planes in two's complement, each plane packed to one byte per eight
dimensions. For a group of eight dimensions an anchor has a table of 256 sums, one for each subset of its eight components;
the bytes of a plane look the sums of all groups up, and the planes are added from the highest down, doubling in between.
That is the full inner product in whole numbers, without a multiplication.

Positives of an anchor are its best other rows of the same label. For each positive the negatives are the best rows of other
labels whose score lies between ``low`` and ``high`` percent of the positive's. Both searches compare every anchor with
every row, in bundles and rounds (``rounds``); the second starts when the positives are known.

Equal scores go to the smaller id. A row that repeats an id is a candidate of its own, but rows of the anchor's id are no
candidates; an anchor that repeats with the same label and vector counts once. Vectors of different lengths are not
compared. Rows without id, label or vector, or with a null or non-finite component, take no part; an anchor without
positives, or a positive without negatives, gives no rows, nor does an empty table. Components may be as large as floats
are: a score that does not fit a long ends the query. Labels are whole numbers. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casemill.llm.rounds import as_best, dealt, floor_of, numbered, ranked, search, top
from casemill.llm.shipping import ship
from casemill.llm.vectors import as_integers, as_longs, matrices, whole_vectors
from casemill.sources.scratch import written

#: Anchors and candidates that are compared at once.
ANCHOR_TILE, TILE = 256, 1024
_SUBSETS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def plane_count(least: float, most: float) -> int:
    """Bits of two's complement that hold all whole numbers from ``least`` to ``most``."""
    return 1 + max(int(most).bit_length() if most > 0 else 0, (-int(least) - 1).bit_length() if least < 0 else 0)


def packed_planes(matrix: np.ndarray, planes: int) -> np.ndarray:
    """The bytes of each vector: plane by plane from the lowest, one byte per eight dimensions."""
    whole = as_integers(matrix)
    out = np.empty((len(matrix), planes, -(-matrix.shape[1] // 8)), np.uint8)
    for plane in range(planes):
        out[:, plane] = np.packbits(((whole >> plane) & 1).astype(bool), axis=1, bitorder="little")
    return out


def subset_sums(anchors: np.ndarray, planes: int) -> np.ndarray:
    """The sums of every subset of each eight components: (group of dimensions, subset, anchor). The numbers are as wide as
    the largest score needs."""
    whole = as_integers(anchors)
    groups = -(-whole.shape[1] // 8)
    whole = np.concatenate([whole, np.zeros((len(whole), groups * 8 - whole.shape[1]), whole.dtype)], axis=1)
    # every partial sum of the doubling is below this
    most = int(np.abs(whole).sum(1).max() if whole.size else 0) << planes
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
    whole = whole.astype(kind)
    subsets = _SUBSETS.astype(kind)
    return np.stack([subsets @ whole[:, 8 * g : 8 * g + 8].T for g in range(groups)]) if groups else np.zeros((0, 256, len(whole)), kind)


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products (candidate, anchor) of packed candidates with anchors' subset sums."""
    out = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    for plane in range(planes.shape[1] - 1, -1, -1):
        out += out
        for group in range(planes.shape[2]):
            found = sums[group][planes[:, plane, group]]
            if plane == planes.shape[1] - 1:
                out -= found
            else:
                out += found
    return out


class Packed:
    """Candidates of one length: keys, labels and packed planes."""

    def __init__(self, rows: pa.Table, at: np.ndarray, planes: int, size: int):
        data = rows["planes"].take(pa.array(at)).to_pylist() if len(at) else []
        self.planes = np.frombuffer(b"".join(data), np.uint8).reshape(len(at), planes, -(-size // 8))
        self.keys, self.labels = rows["key"].to_numpy()[at], rows["label"].to_numpy()[at]


def packed(rows: pa.Table, planes: int) -> dict[int, Packed]:
    size = rows["size"].to_numpy()
    return {int(s): Packed(rows, np.flatnonzero(size == s), planes, int(s)) for s in np.unique(size)}


class Best:
    """The best entries of (query, slot) pairs so far, and what a new entry must reach."""

    def __init__(self, floors: np.ndarray, keep: int):
        self.floors, self.keep, self.slots = floors.copy(), keep, floors.shape[1]
        self.place, self.score, self.key = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, place: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        """``place``: query * slots + slot."""
        place, score, key = np.append(self.place, place), np.append(self.score, score), np.append(self.key, key)
        chosen = top(place, score, key, self.keep)
        self.place, self.score, self.key = place[chosen], score[chosen], key[chosen]
        full = np.flatnonzero(np.bincount(self.place, minlength=self.floors.size) >= self.keep)
        last = np.searchsorted(self.place, full, side="right") - 1
        flat = self.floors.reshape(-1)
        flat[full] = np.maximum(flat[full], self.score[last])


def _positives(left: pa.Table, right: pa.Table, keep: int, planes: int) -> pa.Table:
    number, own_key, label = left["query"].to_numpy(), left["key"].to_numpy(), left["label"].to_numpy()
    best = Best(floor_of(left), keep)
    others = packed(right, planes)
    for size, (at, matrix) in matrices(left["vector"]).items():
        if size not in others:
            continue
        other = others[size]
        order = np.argsort(other.labels, kind="stable")
        sorted_labels = other.labels[order]
        for same in np.intersect1d(label[at], other.labels):
            theirs = order[np.searchsorted(sorted_labels, same) : np.searchsorted(sorted_labels, same, side="right")]
            mine = np.flatnonzero(label[at] == same)
            for begin in range(0, len(mine), ANCHOR_TILE):
                some = mine[begin : begin + ANCHOR_TILE]
                sums = subset_sums(matrix[some], planes)
                query = at[some]
                for start in range(0, len(theirs), TILE):
                    tile = theirs[start : start + TILE]
                    score = scores(other.planes[tile], sums)
                    good = (score >= best.floors[query, 0]) & (other.keys[tile][:, None] != own_key[query])
                    row, column = np.nonzero(good)
                    best.add(query[column], as_longs(score[row, column]), other.keys[tile[row]])
    return as_best(number[best.place], np.zeros(len(best.place)), best.score, best.key)


def _negatives(left: pa.Table, right: pa.Table, slots: int, keep: int, low: int, high: int, planes: int) -> pa.Table:
    number, label = left["query"].to_numpy(), left["label"].to_numpy()
    least, most = np.full((len(left), slots), 1, np.int64), np.zeros((len(left), slots), np.int64)  # an empty range
    for query, found in enumerate(left["positive_scores"].to_pylist()):
        for slot, score in enumerate(found):
            least[query, slot], most[query, slot] = -(-low * score // 100), high * score // 100
    best = Best(floor_of(left, slots), keep)
    others = packed(right, planes)
    for size, (at, matrix) in matrices(left["vector"]).items():
        if size not in others:
            continue
        other = others[size]
        for begin in range(0, len(at), ANCHOR_TILE):
            query = at[begin : begin + ANCHOR_TILE]
            sums = subset_sums(matrix[begin : begin + ANCHOR_TILE], planes)
            for start in range(0, len(other.keys), TILE):
                tile = slice(start, start + TILE)
                score = scores(other.planes[tile], sums)
                apart = other.labels[tile][:, None] != label[query]
                for slot in range(slots):
                    from_ = np.maximum(least[query, slot], best.floors[query, slot])
                    row, column = np.nonzero((score >= from_) & (score <= most[query, slot]) & apart)
                    if len(row):
                        best.add(query[column] * slots + slot, as_longs(score[row, column]), other.keys[tile][row])
    return as_best(number[best.place // slots], best.place % slots, best.score, best.key)


def mine(
    table: DataFrame, anchors: Column, positives: int, negatives: int, low: int, high: int, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` for the rows where ``anchors`` holds."""
    spark = table.sparkSession
    ship(spark)
    rows = whole_vectors(table, key, vector, scale, {"label": table[label].cast("long"), "asked": F.coalesce(anchors, F.lit(False))}).where("label IS NOT NULL")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size"), F.max(F.array_max("vector")).alias("most"), F.min(F.array_min("vector")).alias("least")).first()
    planes = plane_count(facts["least"] or 0, facts["most"] or 0)

    def indexed(batches):
        for batch in batches:
            data = np.empty(len(batch), object)
            size = np.zeros(len(batch), np.int32)
            for length, (at, matrix) in matrices(pa.chunked_array([batch["vector"]])).items():
                size[at] = length
                data[at] = [row.tobytes() for row in packed_planes(matrix, planes)]
            yield pa.record_batch({"key": batch["key"], "label": batch["label"], "spread": batch["spread"], "round": batch["round"], "size": pa.array(size), "planes": pa.array(data, pa.binary())})

    index = dealt(rows.select("key", "label", "vector"), facts["n"]).mapInArrow(indexed, "key long, label long, spread long, round int, size int, planes binary")
    index = written(index, "bit-planes")
    asked = numbered(rows.where("asked").select("key", "label", "vector").dropDuplicates())
    width = max(8 * (facts["size"] or 1), planes * (facts["size"] or 1) // 8) + 40

    found = ranked(search(asked, index, lambda left, right: _positives(left, right, positives, planes), positives, width))
    found = written(found.select("query", (F.col("rank") - 1).alias("slot"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda x: x["positive_score"])  # at most ``positives``
    sought = written(asked.join(found.groupBy("query").agg(listed.alias("positive_scores")), "query"), "anchors")
    best = ranked(search(sought, index, lambda left, right: _negatives(left, right, positives, negatives, low, high, planes), negatives, width))
    names = asked.select("query", F.col("key").alias("anchor_id"))
    best = best.select("query", "slot", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(found, ["query", "slot"]).join(names, "query").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
