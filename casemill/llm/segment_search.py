"""Exact top-k by inner product, with statistics of segments at several resolutions.

A vector is cut into 1, 4, 16, ... segments. From the means and deviations of each segment the distance of two vectors is
bounded from below: it is at least the root of the sum over segments of length * ((mean - mean')^2 + (deviation -
deviation')^2). With both lengths known that bounds the inner product, (|q|^2 + |x|^2 - distance^2) / 2, from above. Pairs
whose bound lies under the query's last place so far are dropped, level by level from coarse to fine; what survives is
scored exactly in whole numbers. Nothing is approximate: bounds have a margin for rounding, and ties are kept.

Every row but those of the query's own id is a candidate, in bundles (``rounds``). Vectors of different lengths are not compared; empty vectors score 0 with
one another. A row that repeats an id is a candidate of its own; a query that repeats with the same vector counts once, with
another vector it is ranked for itself. Equal scores go to the smaller id. Rows without id or vector, or with a null or
non-finite component, take no part; an empty table gives no rows. Components may be as large as floats are: where doubles
would not be exact, Python integers are used, and a score that does not fit a long ends the query. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casemill.llm.rounds import as_best, dealt, floor_of, numbered, ranked, search, top
from casemill.llm.vectors import EXACT, as_longs, exact_scores, matrices, whole_vectors
from casemill.sources.scratch import written

#: Queries and candidates that are compared at once.
QUERY_TILE, TILE = 512, 2048
#: Shortest segment, and into how many a segment is cut at the next level.
SHORTEST, SPLIT = 4, 4


def levels(length: int) -> list[np.ndarray]:
    """Where the segments of each level begin, coarse to fine."""
    out, parts = [], 1
    while parts == 1 or length // parts >= SHORTEST:
        out.append(np.unique(np.arange(parts) * length // parts))
        parts *= SPLIT
    return out if length else []


def statistics(matrix: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's length."""
    size = np.diff(np.append(starts, matrix.shape[1])).astype(np.float64)
    total = np.add.reduceat(matrix, starts, axis=1)
    squares = np.add.reduceat(matrix * matrix, starts, axis=1)
    return np.hstack([total / np.sqrt(size), np.sqrt(np.maximum(squares - total * total / size, 0))])


class Indexed:
    """Vectors of one length with their squared lengths and their statistics at every level."""

    def __init__(self, matrix: np.ndarray, keys: np.ndarray):
        self.matrix, self.keys = matrix, keys
        self.squares = (matrix * matrix).sum(1)
        self.stats = [statistics(matrix, starts) for starts in levels(matrix.shape[1])]

    def part(self, begin: int, end: int) -> Indexed:
        out = object.__new__(Indexed)
        out.matrix, out.keys, out.squares = self.matrix[begin:end], self.keys[begin:end], self.squares[begin:end]
        out.stats = [stats[begin:end] for stats in self.stats]
        return out


def open_pairs(queries: Indexed, others: Indexed, floor: np.ndarray) -> np.ndarray:
    """Pairs that no level's distance bound rules out."""
    alive = queries.keys[:, None] != others.keys[None, :]
    # what a squared distance may be at most for the score to reach the floor, with a margin for rounding
    both = queries.squares[:, None] + others.squares[None, :]
    reach = both - 2 * floor.astype(np.float64)[:, None] + 1 + 1e-9 * both
    for mine, theirs in zip(queries.stats, others.stats):
        rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            break
        some = np.ix_(rows, columns)
        distance = both[some] - 2 * (mine[rows] @ theirs[columns].T)
        alive[some] &= distance <= reach[some]
    return alive


def pair_scores(queries: Indexed, others: Indexed, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, exact score) of the open pairs; doubles hold these numbers exactly."""
    rows, columns = np.nonzero(alive)
    if 8 * len(rows) < alive.size:
        score = np.empty(len(rows), np.int64)
        for at in range(0, len(rows), 1 << 16):
            some = slice(at, at + (1 << 16))
            score[some] = np.einsum("ij,ij->i", queries.matrix[rows[some]], others.matrix[columns[some]])
        return rows, columns, score
    return rows, columns, (queries.matrix @ others.matrix.T)[alive].astype(np.int64)


def best_of(queries: Indexed, others: Indexed, floor: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, score, key): the best candidates of each query that reach its floor."""
    whole = np.zeros(0, np.int64)
    query, score, key = whole, whole, whole
    width = queries.matrix.shape[1]
    span = lambda x: float(np.abs(x).max()) if x.size else 0.0
    mine = span(queries.matrix)
    floor = floor.copy()
    for begin in range(0, len(others.keys), TILE):
        tile = others.part(begin, begin + TILE)
        if width * mine * max(mine, span(tile.matrix)) < EXACT > width * span(tile.matrix) ** 2:
            rows, columns, scores = pair_scores(queries, tile, open_pairs(queries, tile, floor))
        else:
            scores = exact_scores(queries.matrix, tile.matrix)
            rows, columns = np.nonzero(queries.keys[:, None] != tile.keys[None, :])
            scores = as_longs(scores[rows, columns])
        good = scores >= floor[rows]
        query, score, key = np.append(query, rows[good]), np.append(score, scores[good]), np.append(key, tile.keys[columns[good]])
        chosen = top(query, score, key, keep)
        query, score, key = query[chosen], score[chosen], key[chosen]
        full = np.flatnonzero(np.bincount(query, minlength=len(floor)) >= keep)
        last = np.searchsorted(query, full, side="right") - 1
        floor[full] = np.maximum(floor[full], score[last])
    return query, score, key


def top_k(table: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, the id under the name of ``key`` and ``score``: for each row where ``queries`` holds, its ``k`` best candidates."""
    rows = whole_vectors(table, key, vector, scale, {"asked": F.coalesce(queries, F.lit(False))})
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size")).first()
    rows = written(dealt(rows, facts["n"]), "vectors")
    asked = numbered(rows.where("asked").select("key", "vector").dropDuplicates())

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        number, floors = left["query"].to_numpy(), floor_of(left)[:, 0]
        mine, theirs = left["key"].to_numpy(), right["key"].to_numpy()
        found = [(np.zeros(0, np.int64),) * 3]
        others = {size: Indexed(matrix, theirs[at]) for size, (at, matrix) in matrices(right["vector"]).items()}
        for size, (at, matrix) in matrices(left["vector"]).items():
            if size not in others:
                continue
            own = Indexed(matrix, mine[at])
            for begin in range(0, len(at), QUERY_TILE):
                some = at[begin : begin + QUERY_TILE]
                query, score, found_key = best_of(own.part(begin, begin + QUERY_TILE), others[size], floors[some], k)
                found.append((number[some[query]], score, found_key))
        query, score, found_key = (np.concatenate(column) for column in zip(*found))
        return as_best(query, np.zeros(len(query), np.int32), score, found_key)

    best = ranked(search(asked, rows.drop("asked"), scan, k, 8 * (facts["size"] or 1) + 32))
    names = asked.select("query", F.col("key").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", F.col("key").alias(key), "score")
