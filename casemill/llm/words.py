"""Words and word windows of many texts at once, as numpy arrays.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``, or outside another set that is asked for. Hashes have 64 bits and depend on the bytes alone,
so every task, run and machine gives the same. Words of one length up to eight bytes never share a hash; longer ones are
taken in eights through a bijection that spreads every bit, and words over ``LONG`` bytes through BLAKE2b, so words that
share a hash can only be found by chance, about one pair in 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once; a single longer text is still handled whole.
SLICE_BYTES = 8 << 20
#: Bytes of words that are hashed one by one.
LONG = 64
_draw = np.random.Generator(np.random.PCG64(20240229))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What a hash begins with for each length, and masks of the first bytes of eight.
_BEGIN = _draw.integers(0, 2**64, LONG + 1, dtype=np.uint64)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_PLACE = _draw.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte but letters and digits ends a word.
SIGNS = np.zeros(256, bool)
SIGNS[:128] = [not chr(b).isalnum() for b in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins (one more entry for the end); null counts as empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not len(batch):
            continue
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        edges = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(edges, [*edges[1:], len(batch)]):
            yield batch.slice(start, end - start)


class Words:
    """Where the words of a column of texts lie, and their hashes."""

    def __init__(self, column: pa.Array, fold: bool = False, between: np.ndarray = WHITE):
        self.data, self.offsets = text_buffer(column)
        self.fold = fold
        inside = ~between[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= first[1:] | ~inside[1:]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: words of text d: from bounds[d] to bounds[d + 1]
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """One number for each word; ``fold``: A-Z count as a-z."""
        data = _LOWER[self.data] if self.fold else self.data
        size = self.ends - self.starts
        padded = np.empty(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        padded[len(data) :] = 0
        eights = np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))
        out = mix(_BEGIN[np.minimum(size, LONG)] ^ (eights[self.starts] & _FIRST[np.minimum(size, 8)]))
        for done in range(8, min(LONG, int(size.max(initial=0))), 8):
            more = np.flatnonzero((size > done) & (size <= LONG))
            part = eights[self.starts[more] + done] & _FIRST[np.minimum(size[more] - done, 8)]
            out[more] = mix(out[more] ^ part)
        for at in np.flatnonzero(size > LONG):
            word = data[self.starts[at] : self.ends[at]]
            out[at] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return out

    def owners(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` adjacent words, and the bounds of each text's windows. A text with fewer words, but one
    at least, has a single window of all of them."""
    count = np.diff(bounds)
    total = np.maximum(count - width + 1, (count > 0).astype(count.dtype))
    ends = np.concatenate(([0], np.cumsum(total)))
    sums = np.zeros(len(hashes), np.uint64)
    for k in range(min(width, len(hashes))):
        sums[: len(hashes) - k] += hashes[k:] * _PLACE[k]
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - bounds[:-1], total)
    out = sums[at] + np.uint64(width)
    for text in np.flatnonzero((count > 0) & (count < width)):
        own = hashes[bounds[text] : bounds[text + 1]]
        out[ends[text]] = (own * _PLACE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), ends
