"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words, without case and outer punctuation, and the runs of 4 and 5 letters inside them,
hashed to slots. The machine scores them with a weight per slot and the products of short vectors of every two slots, so
that two terms together can count for more than their sum. It learns from a bounded sample of labelled documents outside
the held-out part, on the slots that toxic texts hold more often by far; all other slots weigh nothing. Every document is scored on its whole text.

Null and empty texts have no terms and score as the bias alone; repeated rows score alike; documents without a key are
scored too. With no labelled rows, or labels of one class, every score is the smoothed share of toxic labels (a half
without any). Other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.llm.sampling import held_out, training_rows
from casemill.llm.shipping import ship
from casemill.llm.words import slices

SLOTS = 1 << 18
#: Most labelled documents that are learnt from, and most slots that get a weight.
SAMPLE, CHOSEN = 8000, 3000
FACTORS, EPOCHS, BATCH = 6, 30, 256
#: Step sizes and decay of bias, weights and vectors: single terms are learnt first, products where they add to them.
RATE = {"b": 0.02, "w": 0.05, "v": 0.01}
DECAY = {"w": 1e-5, "v": 5e-4}
KEPT_WORDS = 1_000_000
_LETTERS = re.compile(r"[^\W\d_]+")


def terms(word: str) -> set[int]:
    """Slots of one word."""
    found = set()
    for part in _LETTERS.findall(word.lower()):
        found.add(zlib.crc32(b"=" + part.encode()) % SLOTS)
        raw = part.encode()
        for size in (4, 5):
            for at in range(len(part) - size + 1):
                found.add(zlib.crc32(part[at : at + size].encode() if len(raw) != len(part) else raw[at : at + size]) % SLOTS)
    return found


def text_terms(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for word in set((text or "").split()):
        found |= terms(word)
    return np.fromiter(sorted(found), np.int32, len(found))


class Machine:
    """Bias, weights and vectors; ``place`` maps a slot to its row, slots without one have row 0, which is all zero."""

    def __init__(self, bias: float, slots: np.ndarray, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.slots = float(bias), slots
        self.weights = np.concatenate(([0], weights)).astype(np.float32)
        self.vectors = np.vstack((np.zeros((1, vectors.shape[1])), vectors)).astype(np.float32)
        self.row = {int(slot): at + 1 for at, slot in enumerate(slots)}
        self.rows_of: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"rows_of": {}}

    def score(self, text: str | None) -> float:
        kept, found = self.rows_of, set()
        for word in set((text or "").split()):
            rows = kept.get(word)
            if rows is None:
                if len(kept) >= KEPT_WORDS:
                    kept.clear()
                rows = kept[word] = tuple({self.row[t] for t in terms(word) if t in self.row})
            if rows:
                found.update(rows)
        if not found:
            return float(_sigmoid(self.bias))
        at = np.fromiter(sorted(found), np.int64, len(found))
        vectors = self.vectors[at].astype(np.float64)
        pairs = 0.5 * float((vectors.sum(0) ** 2 - (vectors**2).sum(0)).sum())
        return float(_sigmoid(self.bias + float(self.weights[at].astype(np.float64).sum()) + pairs))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(labels: np.ndarray, slots: list[np.ndarray], seed: int = 0) -> Machine:
    """Learn from the slots of each document of the sample."""
    positive = labels > 0
    share = (positive.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    empty = Machine(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    if not positive.any() or positive.all():
        return empty
    flat, owner = np.concatenate(slots), np.repeat(np.arange(len(slots), dtype=np.int32), [len(s) for s in slots])
    here = np.bincount(flat[positive[owner]], minlength=SLOTS).astype(float)
    there = np.bincount(flat[~positive[owner]], minlength=SLOTS).astype(float)
    n_here, n_there = positive.sum(), (~positive).sum()
    pooled = (here + there) / len(labels)
    spread = np.sqrt(pooled * (1 - pooled) * (1 / n_here + 1 / n_there)) + 1e-9
    apart = np.where(here + there >= 3, (here / n_here - there / n_there) / spread, 0)
    chosen = np.sort(np.argsort(-apart, kind="stable")[:CHOSEN])
    chosen = chosen[apart[chosen] > 3]
    if not len(chosen):
        return empty
    at = np.full(SLOTS, -1)
    at[chosen] = np.arange(len(chosen))
    own = at[flat] >= 0
    terms_in = np.zeros((len(slots), len(chosen)), np.float32)
    terms_in[owner[own], at[flat[own]]] = 1

    draw = np.random.default_rng(seed)
    value = {"b": np.array([bias]), "w": np.zeros(len(chosen)), "v": draw.normal(0, 0.03, (len(chosen), FACTORS))}
    first = {k: np.zeros_like(x) for k, x in value.items()}
    second = {k: np.zeros_like(x) for k, x in value.items()}
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            x = terms_in[rows]
            sums = x @ value["v"]
            raw = value["b"] + x @ value["w"] + 0.5 * (sums**2 - x @ value["v"] ** 2).sum(1)
            error = (_sigmoid(raw) - positive[rows]) / len(rows)
            weight = x.T @ error
            slope = {
                "b": np.array([error.sum()]),
                "w": weight + DECAY["w"] * value["w"],
                "v": x.T @ (error[:, None] * sums) - value["v"] * weight[:, None] + DECAY["v"] * value["v"],
            }
            step += 1
            for k, g in slope.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                value[k] = value[k] - RATE[k] * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(value["b"][0], chosen, value["w"], value["v"])


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Machine:
    """Terms are hashed on the executors; the slots of at most ``sample`` documents come to the driver."""
    ship(documents.sparkSession)

    def hashed(batches):
        for batch in batches:
            yield pa.record_batch({"key": batch["key"].cast(pa.string()), "label": batch["label"], "slots": pa.array([text_terms(t) for t in batch["text"].to_pylist()], pa.list_(pa.int32()))})

    rows = training_rows(documents, labels, label, sample, key, text).mapInArrow(hashed, "key string, label int, slots array<int>").toArrow().sort_by("key")
    slots = rows["slots"].combine_chunks()
    ends = slots.offsets.to_numpy()
    return fit(rows["label"].to_numpy(), np.split(slots.values.to_numpy(), ends[1:-1]) if len(rows) else [])


def scored(documents: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text", cut: float = 0.5) -> DataFrame:
    """One row per document: key, ``held_out``, ``score``, ``predicted``."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    sent = documents.sparkSession.sparkContext.broadcast(machine)  # CHOSEN rows of FACTORS + 1 numbers at most

    def score(batches):
        for rows in slices(batches):
            yield pa.record_batch({"key": rows["key"], "score": pa.array([sent.value.score(t) for t in rows["text"].to_pylist()], pa.float64())})

    found = documents.select(documents[key].alias("key"), documents[text].alias("text")).mapInArrow(score, f"key {kind}, score double")
    return found.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
