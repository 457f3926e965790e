"""Token files: ids ranked by corpus frequency, in byte-aligned variable length with the control bytes kept apart.

Format. A corpus is a folder with three Parquet tables, so any store that Spark reads holds it:

* ``ranks`` (``rank``, ``id``): the ids of the tokenizer that occur, the most frequent first; equal counts by id.
* ``segments``: one row per run of documents, with ``part`` and ``place`` (their order), ``first`` (ids of the same
  part before it), ``keys`` and ``lengths`` of its documents, ``control`` and ``data``. An id is stored as its rank in
  1 to 4 little-endian bytes in ``data``; ``control`` has the byte count less one of four ids in a byte, lowest bits first.
* ``parts`` (``part``, ``start``): ids in all parts before it.

Documents lie in ascending key order: parts by key, rows inside by key and text hash. A key with so many rows that it
spans parts is dealt over them by text hash. Null texts are empty: only the end id. Null keys come first. Repeated rows
are all written; other columns are not read. An empty table gives empty files.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from casemill.llm.shipping import ship
from casemill.llm.words import Words, slices, text_buffer
from casemill.sources.scratch import new_folder

#: Distinct words, or parts of words, whose ids a worker keeps; beyond it starts anew.
KEPT_UNITS = 1_500_000
#: Words for one call of the library, whose results take a few hundred times their size.
LIBRARY_WORDS = 4096
#: Bytes of text that are encoded at once.
TEXT_BYTES = 1 << 20
#: Ids in a segment, about; a longer document makes a longer segment.
SEGMENT_IDS = 1 << 18
#: Fixed value: the pattern of tokenizers that part letters, single digits and signs.
PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: ASCII letters, and ASCII signs but the apostrophe.
_LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True
#: Long binary values fill a writer's buffer fast; smaller row groups keep it small.
WRITING = {"compression": "zstd", "parquet.block.size": 16 << 20}


class Encoder:
    """Ids of texts by a tokenizer file that splits at white space; a distinct word goes to the library once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        #: whether the file lowers case and parts letters from signs by the pattern that this class knows
        self.parts_signs = "Lowercase" in str(spec["normalizer"]) and bool(steps) and steps[0].get("pattern") == {"Regex": PARTING}
        self.forget()

    def size(self, end: int) -> int:
        return max(self.library.get_vocab_size(), end + 1)

    def kind(self, end: int) -> np.dtype:
        return np.dtype("<u2" if self.size(end) <= 1 << 16 else "<u4")

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.ends = np.zeros(0, np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32), np.zeros(1, np.int32)

    def numbers(self, units: Words) -> np.ndarray:
        """For each unit its number among the units that are kept, told apart by 64-bit hashes."""
        if len(self.known) > KEPT_UNITS:
            self.forget()
        hashes, first, which = np.unique(units.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        new[at < len(self.known)] = self.known[at[at < len(self.known)]] != hashes[at < len(self.known)]
        if new.any():
            ids, lengths = array("I"), array("i")
            text, spans = units.data.tobytes(), list(zip(units.starts[first[new]].tolist(), units.ends[first[new]].tolist()))
            for begin in range(0, len(spans), LIBRARY_WORDS):
                some = [text[a:b].decode("utf-8", "replace") for a, b in spans[begin : begin + LIBRARY_WORDS]]
                for found in self.library.encode_batch_fast(some, add_special_tokens=False):
                    own = found.ids
                    ids.extend(own)
                    lengths.append(len(own))
            number = np.arange(len(self.known), len(self.known) + len(spans), dtype=np.int32)
            known = np.concatenate((self.known, hashes[new]))
            order = np.argsort(known, kind="stable")
            self.known, self.place = known[order], np.concatenate((self.place, number))[order]
            self.ids = np.concatenate((self.ids, np.frombuffer(ids, np.uint32).astype(self.ids.dtype)))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(np.frombuffer(lengths, np.int32), dtype=np.int32)))
            at = np.searchsorted(self.known, hashes)
        return self.place[at[which]]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and the number of ids of each."""
        units = Words(texts)
        if self.parts_signs:
            _part(units)
        number = self.numbers(units)
        first, size = self.ends[number], np.diff(self.ends)[number]
        ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)]
        bounds = ends[units.bounds]
        return np.insert(ids, bounds[1:], end), np.diff(bounds) + 1


def _part(words: Words) -> None:
    """Where a word is Latin letters and then signs, make two units of it, the letters in lower case."""
    data = words.data
    wide = np.zeros(len(data), bool)  # second bytes of letters from À to ÿ
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter = _LETTER[data] | wide
    letter[:-1] |= wide[1:]
    sign = _SIGN[data]
    turn = np.zeros(len(data), bool)
    turn[1:] = letter[1:] & sign[:-1]
    inside = lambda flags: np.add.reduceat(np.append(flags, False), np.ravel((words.starts, words.ends), "F"), dtype=np.int64)[::2] if len(words) else np.zeros(0, np.int64)
    letters, size = inside(letter), words.ends - words.starts
    simple = letter[words.starts] & (letters + inside(sign) == size) & (inside(turn) == 0)
    low = data.copy()
    own = np.zeros(len(data) + 1, np.int8)
    own[words.starts[simple]] += 1
    own[words.ends[simple]] -= 1
    own = np.cumsum(own[:-1], dtype=np.int8).astype(bool)
    low[own & (data >= 65) & (data <= 90)] += 32
    low[own & wide & (data <= 0x9E)] += 32
    two = simple & (letters < size)
    times = 1 + two
    starts, ends = np.repeat(words.starts, times), np.repeat(words.ends, times)
    first = np.cumsum(times) - times
    ends[first[two]] = starts[first[two] + 1] = (words.starts + letters)[two]
    words.bounds = np.concatenate((first, [len(starts)]))[words.bounds]
    words.data, words.starts, words.ends = low, starts, ends


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def pack(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit values of several documents, and where each document begins in both."""
    width = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    ends = np.concatenate(([0], np.cumsum(width)))
    data = np.empty(ends[-1], np.uint8)
    for byte in range(int(width.max(initial=1))):
        own = np.flatnonzero(width > byte) if byte else slice(None)
        data[ends[:-1][own] + byte] = (values[own] >> np.uint32(8 * byte)) & np.uint32(255)
    fours = -(-lengths // 4)
    first = np.cumsum(fours) - fours
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    codes = np.zeros(4 * int(fours.sum()), np.uint8)
    codes[np.arange(len(values)) + np.repeat(4 * first - bounds[:-1], lengths)] = width - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return control, np.concatenate((first, [len(control)])), data, ends[bounds]


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive stretches of a byte array as binary values."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data.tobytes())])


#: For each control byte: the byte counts of its four values.
_WIDTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, lengths: np.ndarray, controls: np.ndarray) -> np.ndarray:
    """The values of documents that were packed one by one, by table lookup of the byte counts and one gather for each
    byte. A document fills its last control byte with codes that have no data."""
    codes = _WIDTHS[np.frombuffer(control, np.uint8)]
    ends = np.cumsum(controls)
    spare = 4 * controls - lengths
    used = np.ones(4 * len(codes), bool)
    for k in range(3):
        full = spare > k
        used[4 * ends[full] - 1 - k] = False
    width = codes.ravel()[used]
    at = np.cumsum(width, dtype=np.int64) - width
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = padded[at].astype(np.uint32)
    for byte in range(1, int(width.max(initial=1))):
        values |= padded[at + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values & _MASKS[width]


def encoded(documents: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``deal``, ``ids``): the ids of every text with the end id, packed in two or four bytes each."""
    rows = documents.select(documents[key].cast("long").alias("key"), F.xxhash64(documents[text]).alias("deal"), documents[text].alias("text"))

    def encode(batches):
        coder = encoder(path)
        kind = coder.kind(end)
        for some in slices(batches, limit=TEXT_BYTES):
            ids, lengths = coder.encode(some["text"], end)
            ends = np.concatenate(([0], np.cumsum(lengths))) * kind.itemsize
            yield pa.record_batch({"key": some["key"], "deal": some["deal"], "ids": _binary(ids.astype(kind).view(np.uint8), ends)})

    return rows.mapInArrow(encode, "key long, deal long, ids binary")


def write_token_files(documents: DataFrame, path: str, folder: str, end: int = 1, parts: int | None = None, key: str = "doc_id", text: str = "text") -> None:
    """Write the tables of the format to ``folder``. ``parts``: by default as many as Spark's shuffle partitions."""
    spark = documents.sparkSession
    ship(spark)
    unranked = new_folder(spark, "token-ids")
    encoded(documents, path, end, key, text).write.options(**WRITING).parquet(unranked)
    rows = spark.read.parquet(unranked)
    kind = encoder(path).kind(end)

    def count(batches):
        total = np.zeros(encoder(path).size(end), np.int64)
        for batch in slices(batches, "ids", limit=TEXT_BYTES):
            total += np.bincount(text_buffer(batch["ids"])[0].view(kind), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(found, pa.int64()), "n": pa.array(total[found], pa.int64())})

    counted = rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()  # bounded by the vocabulary
    spark.createDataFrame([(rank, row.id) for rank, row in enumerate(counted)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max((row.id for row in counted), default=end) + 1, np.uint32)
    rank_of[[row.id for row in counted]] = np.arange(len(counted))

    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shares = [k / parts for k in range(1, parts)]
    edges = np.sort(np.array(rows.approxQuantile("key", shares, 0.1 / parts) if shares else [], np.float64).astype(np.int64))

    def packed(batches):
        for some in slices(batches, "ids", limit=TEXT_BYTES):
            known = some["key"].fill_null(np.iinfo(np.int64).min).to_numpy()
            low, high = np.searchsorted(edges, known, "left"), np.searchsorted(edges, known, "right")
            deal = some["deal"].to_numpy()
            ids, ends = text_buffer(some["ids"])
            lengths = np.diff(ends) // kind.itemsize
            control, control_at, data, data_at = pack(rank_of[ids.view(kind)], lengths)
            yield pa.record_batch(
                {
                    "part": pa.array(low + deal % (high - low + 1), pa.int32()),
                    "key": some["key"],
                    "deal": some["deal"],
                    "n": pa.array(lengths, pa.int64()),
                    "control": _binary(control, control_at),
                    "data": _binary(data, data_at),
                }
            )

    dealt = rows.mapInArrow(packed, "part int, key long, deal long, n long, control binary, data binary")
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "key", "deal")
    segments = dealt.mapInArrow(_segments, "part int, place int, first long, keys array<long>, lengths array<long>, controls array<int>, control binary, data binary")
    segments.write.options(**WRITING).parquet(f"{folder}/segments")
    totals = spark.read.parquet(f"{folder}/segments").groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")).orderBy("part").collect()  # a row per part
    starts = np.cumsum([0] + [row.n for row in totals])
    spark.createDataFrame([(row.part, int(start)) for row, start in zip(totals, starts)], "part int, start long").coalesce(1).write.parquet(f"{folder}/parts")


def _segments(batches):
    """Runs of sorted documents as rows of ``segments``."""
    state = {"part": None, "place": 0, "first": 0}
    held: list[tuple] = []

    def flush():
        lengths = [row[1] for row in held]
        made = pa.record_batch(
            {
                "part": pa.array([state["part"]], pa.int32()),
                "place": pa.array([state["place"]], pa.int32()),
                "first": pa.array([state["first"]], pa.int64()),
                "keys": pa.array([[row[0] for row in held]], pa.list_(pa.int64())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "controls": pa.array([[len(row[2]) for row in held]], pa.list_(pa.int32())),
                "control": pa.array([b"".join(row[2] for row in held)], pa.binary()),
                "data": pa.array([b"".join(row[3] for row in held)], pa.binary()),
            }
        )
        state["place"] += 1
        state["first"] += sum(lengths)
        held.clear()
        return made

    size = 0
    for batch in slices(batches, "data", limit=TEXT_BYTES):
        columns = [batch[name].to_pylist() for name in ("part", "key", "n", "control", "data")]
        for part, *row in zip(*columns):
            if held and (part != state["part"] or size >= SEGMENT_IDS):
                yield flush()
                size = 0
            if part != state["part"]:
                state.update(part=part, place=0, first=0)
            held.append(row)
            size += row[1]
    if held:
        yield flush()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(``key``, ``start``, ``ids``) of every document in the files: ``ids`` as little-endian unsigned 32-bit integers,
    ``start`` the ids of all documents before it."""
    return _read(spark, folder, "ids binary", lambda ids, bounds: {"ids": _binary(ids.view(np.uint8), 4 * bounds)})


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(``key``, ``start``, ``n_tokens``, ``ids_crc32``) of every document in the files."""

    def digest(ids, bounds):
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return {"n_tokens": pa.array(np.diff(bounds), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}

    return _read(spark, folder, "n_tokens long, ids_crc32 long", digest)


def _read(spark: SparkSession, folder: str, schema: str, columns) -> DataFrame:
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()["id"].to_numpy().astype("<u4")  # bounded by the vocabulary
    parts = {row.part: row.start for row in spark.read.parquet(f"{folder}/parts").collect()}  # a row per part

    def decode(batches):
        for batch in slices(batches, "data", limit=1):
            for row in batch.to_pylist():
                lengths, controls = np.array(row["lengths"], np.int64), np.array(row["controls"], np.int64)
                ids = ranks[unpack(row["control"], row["data"], lengths, controls)]
                bounds = np.concatenate(([0], np.cumsum(lengths)))
                yield pa.record_batch({"key": pa.array(row["keys"], pa.int64()), "start": pa.array(parts[row["part"]] + row["first"] + bounds[:-1], pa.int64())} | columns(ids, bounds))

    rows = spark.read.parquet(f"{folder}/segments").select("part", "first", "keys", "lengths", "controls", "control", "data")
    return rows.mapInArrow(decode, f"key long, start long, {schema}")


def token_files(documents: DataFrame, path: str, end: int = 1, folder: str | None = None) -> DataFrame:
    """Write the files of ``documents`` and read them back: per document ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "token-files")
    write_token_files(documents, path, folder, end)
    return file_digests(spark, folder).withColumnRenamed("key", "doc_id")
