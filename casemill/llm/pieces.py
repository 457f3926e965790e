"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch that a worker has not met are laid side by side. A suffix array over that text, built by
doubling, is searched for every piece at once; the ranges it gives are all occurrences of all pieces, the edges, which
are sorted by position. The words' symbols are then relaxed along the edges: the model files here hold merge priorities
and not word probabilities, so the best edge is the one of highest priority that joins two adjacent symbols, leftmost
first, until no edge joins any. That gives the ids of the library; the path of least total cost would not.

Null and empty texts have no ids; an id list that is null or empty decodes to the empty text. Ids are in the order of
the text, so ties and repeated rows need no rule. Extra columns are passed over.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casemill.llm.shipping import ship
from casemill.llm.words import slices

#: Words with ids that a worker keeps, and their bytes; beyond either it starts anew.
KEPT_WORDS, KEPT_BYTES = 500_000, 32 << 20
#: Bytes of text handled at once, and bytes of new words that are laid side by side: their edges take about a hundred times as much.
TEXT_BYTES, PART_BYTES = 2 << 20, 1 << 19
#: Longer words are relaxed with a heap, one by one, and not side by side.
SIDE_BY_SIDE = 48
#: The model's stand-in for a space, and a byte that no text has.
_SPACE = "▁"
_BREAK = 0xFF
_NONE = np.iinfo(np.int64).max
_LENGTH_BITS = 6


def _fields(data: bytes):
    """Numbers and contents of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value = number()
        else:
            size = {1: 8, 2: 0, 5: 4}[key & 7] or number()
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class Model:
    """Pieces, priorities and byte ids of a model file of the merging kind with byte fallback."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        trainer = dict(_fields(next(v for k, v in parts if k == 2)))
        normal = dict(_fields(next((v for k, v in parts if k == 3), b"")))
        if trainer.get(3) != 2 or normal.get(2) or normal.get(4, 1) or not normal.get(3, 1):
            raise ValueError("only merging models without normalisation, with a leading space, are read")
        self.pieces, scores, kinds = [], [], []
        for number, content in parts:
            if number == 1:
                fields = dict(_fields(content))
                self.pieces.append(fields[1])
                scores.append(float(np.frombuffer(fields.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(fields.get(3, 1))
        kinds = np.array(kinds)
        if not set(kinds) <= {1, 2, 3, 6}:
            raise ValueError("user-defined and unused pieces are not read")
        self.bytes = np.zeros(256, np.uint32)
        for at in np.flatnonzero(kinds == 6):
            self.bytes[int(self.pieces[at][1:-1], 16)] = at
        self.byte_of = {int(i): bytes([b]) for b, i in enumerate(self.bytes)}
        self.control = set(np.flatnonzero(kinds == 3).tolist())
        #: what each id is in a text
        self.spelled = [b" \xe2\x81\x87 " if i == 0 else self.byte_of.get(i) or p.replace(_SPACE.encode(), b" ") for i, p in enumerate(self.pieces)]
        self.normal = np.flatnonzero(kinds == 1)
        self.length = np.array([len(p) for p in self.pieces])
        #: 0 for the highest score; equal scores share a number
        self.priority = np.unique(-np.array(scores), return_inverse=True)[1].astype(np.int64)
        texts = [self.pieces[i].decode() for i in self.normal]
        if self.length[self.normal].max() >= 1 << _LENGTH_BITS or any(_SPACE in t.lstrip(_SPACE) for t in texts):
            raise ValueError("pieces must be short and begin with their spaces")
        line = "" if any("\n" in t for t in texts) else r"\n"
        self.words = re.compile(f"{_SPACE}*[^{_SPACE}{line}]+|{_SPACE}+" + (f"|{line}" if line else ""))
        blocks = -(-int(self.length[self.normal].max()) // 8)
        padded = np.zeros((2, len(self.normal), 8 * blocks), np.uint8)
        padded[1] = 0xFF
        for row, i in enumerate(self.normal):
            padded[:, row, : self.length[i]] = np.frombuffer(self.pieces[i], np.uint8)
        self.low, self.high = padded.view(">u8").astype(np.uint64)

    # ---- edges

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences of all pieces in a byte text: keys of position and length, sorted, and the pieces' ids."""
        blocks = self.low.shape[1]
        room = np.concatenate((text, np.full(8 * blocks + 8, _BREAK, np.uint8))).astype(np.uint64)
        word = np.zeros(len(text) + 8 * blocks, np.uint64)
        for k in range(8):
            word |= room[k : k + len(word)] << np.uint64(8 * (7 - k))
        order = suffix_array(word, len(text), 8 * blocks)
        low, high = np.zeros(len(self.normal), np.int64), np.full(len(self.normal), len(text), np.int64)
        for block in range(blocks):
            own = np.flatnonzero((self.length[self.normal] > 8 * block) & (low < high))
            if len(own):
                low[own], high[own] = (
                    _bisect(word, order, 8 * block, self.low[own, block], low[own], high[own], False),
                    _bisect(word, order, 8 * block, self.high[own, block], low[own], high[own], True),
                )
        count = np.maximum(high - low, 0)
        ends = np.cumsum(count)
        at = order[np.arange(ends[-1]) + np.repeat(low - ends + count, count)]
        ids = np.repeat(self.normal, count)
        keys = at << _LENGTH_BITS | self.length[ids]
        by_place = np.argsort(keys)
        return keys[by_place], ids[by_place]

    # ---- relaxation

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        raw = [w.encode() for w in words]
        text = np.frombuffer(b"\xff".join(raw) + b"\xff", np.uint8)
        keys, ids = self.edges(text)
        begin = (text & 0xC0) != 0x80
        begin &= text != _BREAK
        symbol = np.flatnonzero(begin)
        stop = np.flatnonzero(text == _BREAK)
        word_of = np.searchsorted(stop, symbol)
        first = np.searchsorted(word_of, np.arange(len(words)))
        size = np.diff(np.append(first, len(symbol)))
        end = np.append(symbol[1:], len(text))
        last = np.append(word_of[1:] != word_of[:-1], True)
        end[last] = stop[word_of[last]]

        def find(start: np.ndarray, upto: np.ndarray) -> np.ndarray:
            """The piece of a stretch, or -1."""
            span = upto - start
            wanted = start << _LENGTH_BITS | np.minimum(span, (1 << _LENGTH_BITS) - 1)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1) if len(keys) else np.zeros(len(start), int)
            hit = (keys[at] == wanted) & (span < 1 << _LENGTH_BITS) if len(keys) else np.zeros(len(start), bool)
            return np.where(hit, ids[at], -1) if len(keys) else np.full(len(start), -1)

        alive = np.ones(len(symbol), bool)
        for word in np.flatnonzero(size > SIDE_BY_SIDE):
            self._relax_long(slice(first[word], first[word] + size[word]), symbol, end, alive, keys, ids)
        self._relax(first[(size > 1) & (size <= SIDE_BY_SIDE)], size[(size > 1) & (size <= SIDE_BY_SIDE)], symbol, end, alive, find)

        start, upto, owner = symbol[alive], end[alive], word_of[alive]
        found = find(start, upto)
        count = np.where(found < 0, upto - start, 1)
        place = np.cumsum(count) - count
        out = np.repeat(found, count)
        spelled = out < 0
        out[spelled] = self.bytes[text[(np.arange(len(out)) - np.repeat(place, count) + np.repeat(start, count))[spelled]]]
        return out.astype(np.uint32), np.bincount(owner, weights=count, minlength=len(words)).astype(np.int64)

    def _relax(self, first, size, symbol, end, alive, find) -> None:
        """Words side by side: in each round every word takes its best edge."""
        if not len(first):
            return
        starts = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(starts - first, size)
        start, upto = symbol[at], end[at].copy()
        local = np.arange(len(at)) - np.repeat(starts, size)
        nxt, prv = np.arange(1, len(at) + 1), np.arange(-1, len(at) - 1)
        nxt[starts + size - 1] = -1
        prv[starts] = -1
        live = np.ones(len(at), bool)
        best = np.full(len(at), _NONE)

        def judge(left: np.ndarray) -> None:
            piece = find(start[left], upto[nxt[left]])
            best[left] = np.where(piece < 0, _NONE, self.priority[piece] << 8 | local[left])

        judge(np.flatnonzero(nxt >= 0))
        while True:
            top = np.minimum.reduceat(best, starts)
            words = top < _NONE
            if not words.any():
                break
            left = starts[words] + (top[words] & 255)
            right = nxt[left]
            upto[left], nxt[left] = upto[right], nxt[right]
            live[right], best[right], best[left] = False, _NONE, _NONE
            far = nxt[left]
            prv[far[far >= 0]] = left[far >= 0]
            near = prv[left]
            judge(np.concatenate((left[far >= 0], near[near >= 0])))
            if not words.all():
                starts, size = starts[words], size[words]
                keep = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - starts, size)
                end[at[live]], alive[at[~live]] = upto[live], False
                move = np.full(len(at) + 1, -1)
                move[keep] = np.arange(len(keep))
                at, start, upto, local, live, best = (x[keep] for x in (at, start, upto, local, live, best))
                nxt, prv = move[nxt[keep]], move[prv[keep]]
                starts = np.cumsum(size) - size
        end[at[live]], alive[at[~live]] = upto[live], False

    def _relax_long(self, own: slice, symbol, end, alive, keys, ids) -> None:
        """One long word: a heap of joins by priority and place, over the edges that lie in the word."""
        start, upto = symbol[own].tolist(), end[own].tolist()
        size = len(start)
        nxt, prv, live = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
        low, high = np.searchsorted(keys, (start[0] << _LENGTH_BITS, upto[-1] << _LENGTH_BITS)).tolist()
        edges, rank = memoryview(keys[low:high]), memoryview(self.priority[ids[low:high]])
        count, longest = high - low, (1 << _LENGTH_BITS) - 1
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            reach = upto[nxt[left]]
            span = reach - start[left]
            if span <= longest:
                edge = start[left] << _LENGTH_BITS | span
                at = bisect_left(edges, edge)
                if at < count and edges[at] == edge:
                    heapq.heappush(heap, (rank[at], left, reach))

        for left in range(size - 1):
            offer(left)
        while heap:
            _, left, reach = heapq.heappop(heap)
            right = nxt[left]
            if not live[left] or right >= size or upto[right] != reach:
                continue
            upto[left], live[right], nxt[left] = reach, False, nxt[right]
            if nxt[left] < size:
                prv[nxt[left]] = left
                offer(left)
            if prv[left] >= 0:
                offer(prv[left])
        end[own], alive[own] = upto, live

    # ---- decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of an id list; control ids are silent, and the space before the first piece is dropped. Bytes that are
        no text are replaced; a control id ends a run of byte ids."""
        ids = ids.tolist()
        if self.control.isdisjoint(ids):
            runs = [ids]
        else:
            runs = [[]]
            for i in ids:
                if i in self.control:
                    runs.append([])
                else:
                    runs[-1].append(i)
            runs = [run for run in runs if run]
        spelled = self.spelled
        text = "".join([b"".join([spelled[i] for i in run]).decode("utf-8", "replace") for run in runs])
        opening = next((run[0] for run in runs if run), 0)
        return text[1:] if opening and opening not in self.byte_of and text.startswith(" ") else text


def suffix_array(word: np.ndarray, size: int, reach: int) -> np.ndarray:
    """Positions 0 to ``size`` - 1 ordered by the ``reach`` bytes that follow, given the eight bytes at each position."""
    order = np.argsort(word)
    width = 8
    while True:
        sorted_ = word[order]
        rank = np.empty(len(word), np.uint64)
        rank[order] = np.cumsum(np.concatenate(([0], sorted_[1:] != sorted_[:-1])))
        if width >= reach or int(rank[order[-1]]) == len(word) - 1:
            break
        word = rank << np.uint64(32)
        word[: len(rank) - width] |= rank[width:]
        order = np.argsort(word)
        width *= 2
    return order[order < size]


def _bisect(word, order, shift, target, low, high, right) -> np.ndarray:
    """For each target the first place in its own range of ``order`` whose eight bytes are not below (``right``: above) it."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        value = word[order[np.minimum(middle, len(order) - 1)] + shift]
        below = (value <= target) if right else (value < target)
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)


def _parts(words: list[str]):
    """The words in lists of about ``PART_BYTES``, one word at least."""
    part, size = [], 0
    for word in words:
        part.append(word)
        size += len(word.encode())
        if size >= PART_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


class Encoder:
    """A model and the ids of the words met so far."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.size = 0
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        if len(self.index) > KEPT_WORDS or self.size > KEPT_BYTES:
            self.forget()
        find, index = self.model.words.findall, self.index
        split = [find(_SPACE + t.replace(" ", _SPACE)) if t else [] for t in texts]
        new = list({word: None for words in split for word in words if word not in index})
        for part in _parts(new):
            ids, sizes = self.model.encode_words(part)
            for word in part:
                index[word] = len(index)
                self.size += len(word)
            self.ids, self.ends = np.concatenate((self.ids, ids)), np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter((index[w] for ws in split for w in ws), np.int64, int(counts.sum()))
        size = np.diff(self.ends)[words]
        ends = np.concatenate(([0], np.cumsum(size)))
        out = self.ids[np.arange(ends[-1]) + np.repeat(self.ends[words] - ends[:-1], size)]
        return out, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encoded(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``ids``): the ids of each text, as an array of ints."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def encode(batches):
        for rows in slices(batches, limit=TEXT_BYTES):
            ids, counts = encoder(path).encode(rows["text"].to_pylist())
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.record_batch({"key": rows["key"], "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))})

    return documents.select(documents[key].alias("key"), documents[text].alias("text")).mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(frame: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ``text``): the text of each id list."""
    ship(frame.sparkSession)
    kind = frame.schema[key].dataType.simpleString()

    def decode(batches):
        model = encoder(path).model
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)) for x in batch["ids"].to_pylist()]
            yield pa.record_batch({"key": batch["key"], "text": pa.array(texts, pa.string())})

    return frame.select(frame[key].alias("key"), frame[ids].alias("ids")).mapInArrow(decode, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: key, ``n_pieces``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers),
    ``round_trip``: whether decoding gives the text back (null: empty), and with ``with_ids`` the ``ids``."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def digest(batches):
        for rows in slices(batches, limit=TEXT_BYTES):
            coder = encoder(path)
            texts = rows["text"].to_pylist()
            ids, counts = coder.encode(texts)
            ends = np.concatenate(([0], np.cumsum(counts)))
            each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
            columns = {
                "key": rows["key"],
                "n_pieces": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64()),
                "round_trip": pa.array([coder.model.decode(x) == (t or "") for x, t in zip(each, texts)], pa.bool_()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.record_batch(columns)

    schema = f"key {kind}, n_pieces long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    return documents.select(documents[key].alias("key"), documents[text].alias("text")).mapInArrow(digest, schema).withColumnRenamed("key", key)
