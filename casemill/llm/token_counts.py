"""Token counts by byte-pair merging, without emitting ids.

Adjacent symbols wait in a heap by the rank of their merge; the lowest, leftmost pair is merged and the linked list of
symbols closed over it, until no pair has a rank. The count of a word is its bytes less the merges. Counts are kept for
each distinct word in the worker, so a word is merged once.

Null and empty texts have no tokens. Repeated rows are each counted; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from casemill.llm.shipping import ship
from casemill.llm.words import slices

#: Words whose counts a worker keeps; beyond it starts anew, which costs time and changes no count.
KEPT_WORDS = 1_000_000
#: Fixed value: the pattern by which byte-level tokenizers split text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: As the tokenizer's engine defines white space; Python's adds four control characters.
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_OTHER = r"[^\t-\r \x85\xa0  -     　"
#: White space beyond ASCII joins runs that the split at ASCII white space would cut.
_WIDE = regex.compile(r"[\x85\xa0  -     　]")
#: No word of PATTERN crosses these units where white space is ASCII only.
_UNITS = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as it is, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Counted:
    """Counts of one byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex"):
            raise ValueError("only byte-level tokenizers without normaliser and prefix space are counted")
        ids = spec["model"]["vocab"]
        self.bytes = [ids[s] for s in byte_symbols()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(PATTERN.replace(r"[^\s", _OTHER).replace(r"(?!\S)", f"(?!{_OTHER}])").replace(r"\s", _SPACE))
        self.kept: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Symbols left when no adjacent pair has a merge."""
        symbols = [self.bytes[b] for b in word.encode()]
        size = left = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        find = self.merges.get
        heap = []
        for at in range(size - 1):
            if merge := find((symbols[at], symbols[at + 1])):
                heap.append((merge[0], at))
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            nxt = after[at]
            if nxt >= size or symbols[at] < 0:
                continue
            merge = find((symbols[at], symbols[nxt]))
            if not merge or merge[0] != rank:
                continue
            symbols[at], symbols[nxt] = merge[1], -1
            left -= 1
            after[at] = far = after[nxt]
            if far < size:
                before[far] = at
                if merge := find((symbols[at], symbols[far])):
                    heapq.heappush(heap, (merge[0], at))
            if (near := before[at]) >= 0:
                if merge := find((symbols[near], symbols[at])):
                    heapq.heappush(heap, (merge[0], near))
        return left

    def text(self, text: str) -> int:
        total, kept = 0, self.kept
        parts = [text]
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            total += len(parts) - 1
        for part in parts:
            units = self.words if not part.isascii() and _WIDE.search(part) else _UNITS
            for unit, times in Counter(units.findall(part)).items():
                count = kept.get(unit)
                if count is None:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    count = kept[unit] = sum(map(self.word, self.words.findall(unit)))
                total += count * times
        return total


_loaded: dict[str, Counted] = {}


def counted(path: str) -> Counted:
    if path not in _loaded:
        _loaded[path] = Counted(path)
    return _loaded[path]


def token_counts(documents: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_bytes``, ``n_tokens`` as the tokenizer file at ``path`` gives them, ``over_limit``."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def count(batches):
        counts = counted(path)
        for rows in slices(batches):
            texts = rows["text"].to_pylist()
            tokens = [counts.text(t) if t else 0 for t in texts]
            yield pa.record_batch(
                {"key": rows["key"], "n_bytes": pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array([n > limit for n in tokens], pa.bool_())}
            )

    found = documents.select(documents[key].alias("key"), documents[text].alias("text")).mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return found.withColumnRenamed("key", key)
