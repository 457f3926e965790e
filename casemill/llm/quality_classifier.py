"""Document quality by attention over passages.

A text is a bag of passages of 64 words. Each passage becomes a vector: means over its words of shares of character
kinds, how often each hashed word shape occurs, the share of distinct words. A layer encodes it, gated attention weighs
the passages, and the weighted mean is scored. Only document labels teach it, from a bounded sample outside the
held-out part: whole documents in the order of their keys' hashes, at most ``SAMPLE`` of them and as long as all their passages together
are at most ``SAMPLE_PASSAGES``. Gradients are written out below. Every document is scored on all its passages.

Null and empty texts are one passage of zeros. Very long texts are scored whole. Repeated rows score alike. With no labelled rows, or labels of one class,
every score is the smoothed share of good labels (a half without any). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casemill.llm.sampling import held_out, training_rows
from casemill.llm.shipping import ship
from casemill.llm.words import slices
from casemill.sources.scratch import written

PASSAGE, SHAPES = 64, 256
#: Most labelled documents that are learnt from, and passages of all of them, 532 bytes each on the driver.
SAMPLE, SAMPLE_PASSAGES = 3000, 150_000
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 24, 16, 8, 64, 0.005, 1e-4
#: Words, and their characters, whose features a worker keeps.
KEPT_WORDS, KEPT_CHARS = 250_000, 8 << 20
#: Text that is worked on at a time, and new words whose features are made at a time.
TEXT_BYTES, WORDS_AT_ONCE = 1 << 20, 16_384
_KINDS = 8
FEATURES = _KINDS + 2 + SHAPES
_RUNS = re.compile(r"(.)\1+", re.S)


def word_features(word: str) -> tuple[list[float], int]:
    """Shares of character kinds, and the slot of the word's shape: kinds of letters and digits, other signs as they are,
    runs as one."""
    size = len(word)
    letters = sum(map(str.isalpha, word))
    upper = sum(map(str.isupper, word))
    digits = sum(map(str.isdigit, word))
    last = word[-1]
    kinds = [min(size, 40) / 10, letters / size, upper / size, digits / size, (size - letters - digits) / size, float(last in ".!?"), float(size == 1), float(last in ",;:")]
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return kinds, zlib.crc32(_RUNS.sub(r"\1", shape).encode()) % SHAPES


class Passages:
    """Passage vectors of texts; the features of words met are kept."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.kinds, self.shape = np.zeros((0, _KINDS), np.float32), np.zeros(0, np.int32)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One row per passage of all texts, and how many each text has."""
        if len(self.index) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.forget()
        index = self.index
        split = [(t or "").split() for t in texts]
        new = list({w: None for ws in split for w in ws if w not in index})
        if new:
            kinds, shape = [self.kinds], [self.shape]
            for begin in range(0, len(new), WORDS_AT_ONCE):  # numbers of Python take ten times the place of the arrays
                found = [word_features(w) for w in new[begin : begin + WORDS_AT_ONCE]]
                kinds.append(np.array([k for k, _ in found], np.float32))
                shape.append(np.array([s for _, s in found], np.int32))
            for word in new:
                index[word] = len(index)
            self.chars += sum(map(len, new))
            self.kinds, self.shape = np.concatenate(kinds), np.concatenate(shape)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter((index[w] for ws in split for w in ws), np.int64, int(counts.sum()))
        passages = np.maximum(-(-counts // PASSAGE), 1)
        first = np.cumsum(passages) - passages
        inside = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        owner = np.repeat(first, counts) + inside // PASSAGE
        total = int(passages.sum())
        size = np.bincount(owner, minlength=total)
        out = np.zeros((total, FEATURES), np.float32)
        if len(words):
            some = np.flatnonzero(size)
            begin = (np.cumsum(size) - size)[some]
            scale = 1 / size[some][:, None]
            out[some, :_KINDS] = np.add.reduceat(self.kinds[words], begin, axis=0) * scale
            once = np.sort(owner << 32 | words)
            distinct = np.bincount(once[np.concatenate(([True], once[1:] != once[:-1]))] >> 32, minlength=total)
            out[some, _KINDS] = distinct[some] * scale[:, 0]
            out[:, _KINDS + 1] = size / PASSAGE
            out[some, _KINDS + 2 :] = np.bincount(owner * SHAPES + self.shape[words], minlength=total * SHAPES).reshape(total, SHAPES)[some] * scale
        return out, passages


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Attention:
    """Encoder, gated attention and output of one model."""

    def __init__(self, value: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray):
        self.value, self.mean, self.scale = value, mean, scale

    @staticmethod
    def constant(share: float) -> Attention:
        value = {"W": np.zeros((FEATURES, 1)), "b": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1)), "w": np.zeros(1), "c": np.zeros(1), "d": np.array([np.log(share / (1 - share))])}
        return Attention(value, np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32))

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.value
        x = (rows - self.mean) * self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        first = np.cumsum(counts) - counts
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        a /= np.repeat(np.add.reduceat(a, first), counts)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "first": first, "score": _sigmoid(z @ p["c"] + p["d"])}

    def slopes(self, rows: np.ndarray, counts: np.ndarray, good: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss."""
        p, f = self.value, self.forward(rows, counts)
        h, t, g, a = f["h"], f["t"], f["g"], f["a"]
        error = (f["score"] - good) / len(good)
        dz = np.repeat(error[:, None] * p["c"], counts, axis=0)
        da = (h * dz).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, f["first"]), counts))
        dgate = de[:, None] * p["w"]
        dt, dg = dgate * g * (1 - t**2), dgate * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ error, "d": np.array([error.sum()])}


def fit(labels: np.ndarray, bags: list[np.ndarray], seed: int = 0) -> Attention:
    """Learn from the passages of each document of the sample."""
    good = (labels > 0).astype(np.float64)
    if not len(good) or good.min() == good.max():
        return Attention.constant((good.sum() + 1) / (len(good) + 2))
    every = np.concatenate(bags).astype(np.float32)
    mean, spread = every.mean(0), every.std(0)
    draw = np.random.default_rng(seed)
    value = {
        "W": draw.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
        "b": np.zeros(HIDDEN),
        "V": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "U": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "w": draw.normal(0, GATE**-0.5, GATE),
        "c": draw.normal(0, HIDDEN**-0.5, HIDDEN),
        "d": np.array([np.log((good.sum() + 1) / (len(good) - good.sum() + 1))]),
    }
    model = Attention(value, mean, (1 / np.maximum(spread, 0.02)).astype(np.float32))
    first, second = ({k: np.zeros_like(x) for k, x in value.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(good))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            slope = model.slopes(np.concatenate([bags[i] for i in chosen]).astype(np.float32), np.array([len(bags[i]) for i in chosen]), good[chosen])
            step += 1
            for k, g in slope.items():
                g = g + (DECAY * value[k] if k in "WVU" else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                value[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


_passages = Passages()


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Attention:
    """Passages are made on the executors; those of at most ``sample`` documents, ``SAMPLE_PASSAGES`` in all, come to the driver."""
    ship(documents.sparkSession)

    def passages(batches):
        for rows in slices(batches, limit=TEXT_BYTES):
            made, counts = _passages.of(rows["text"].to_pylist())
            each = [x.astype(np.float16).tobytes() for x in np.split(made, np.cumsum(counts)[:-1])]
            yield pa.record_batch({"key": rows["key"].cast(pa.string()), "label": rows["label"], "size": pa.array(counts, pa.int64()), "bag": pa.array(each, pa.large_binary())})

    rows = training_rows(documents, labels, label, sample, key, text).mapInArrow(passages, "key string, label int, size long, bag binary")
    rows = written(rows, "training-passages")
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("key"), "key"))
    taken = rows.select("key", "size").withColumn("upto", upto).where(F.col("upto") <= SAMPLE_PASSAGES).select("key")  # of ``sample`` rows
    rows = rows.join(F.broadcast(taken), "key").toArrow().sort_by("key")
    bags = [np.frombuffer(b, np.float16).reshape(-1, FEATURES) for b in rows["bag"].to_pylist()]
    return fit(rows["label"].to_numpy(), bags)


def scored(documents: DataFrame, model: Attention, key: str = "doc_id", text: str = "text", cut: float = 0.3) -> DataFrame:
    """One row per document: key, ``held_out``, ``score``, ``predicted``."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    sent = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(batches):
        for rows in slices(batches, limit=TEXT_BYTES):
            made, counts = _passages.of(rows["text"].to_pylist())
            yield pa.record_batch({"key": rows["key"], "score": pa.array(sent.value.forward(made, counts)["score"].astype(np.float64), pa.float64())})

    found = documents.select(documents[key].alias("key"), documents[text].alias("text")).mapInArrow(score, f"key {kind}, score double")
    return found.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def kept(documents: DataFrame, model: Attention, text: str = "text", cut: float = 0.3) -> DataFrame:
    """The documents that score ``cut`` or more, with all their columns."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def keep(batches):
        for rows in slices(batches, text, limit=TEXT_BYTES):
            made, counts = _passages.of(rows[text].to_pylist())
            yield rows.filter(pa.array(sent.value.forward(made, counts)["score"] >= cut))

    return documents.mapInArrow(keep, documents.schema)
