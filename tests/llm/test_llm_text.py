"""Words, token counts, token files and pieces beside the libraries they must agree with."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from casemill.llm import pieces, token_counts, token_files
from casemill.llm.words import SIGNS, Words, slices, windows

ODD = [
    "", " ", "\n\n x \n", "a", "x<|endoftext|>y <|endoftext|>", "it's we'll I'd A'S", "\x1c\x1d a\x85b\xa0 c", "!!!\x1c!!! \x1f x", "　日本語 テスト梦", "𝒳𝒴 é ​́a",
    "\x00\x01", "١٢٣ ½ ²", "ab" * 3000, " " * 200, "=" * 400, "Éa*** ÀÉ×÷ ÿÿ¿ straße!! a_b foo_ 12a a1 ##a ßÞ. ǅ Σίσυφος ΣΑΣ", "<s>y </s> <0x0A>", "a   b      c▁▁d", "\t\tfoo\r\n", "éé" * 60, "x " * 20000,
]


@pytest.fixture(scope="module")
def documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(10**6 + i, t) for i, t in enumerate(ODD)] + [(10**6 + 3, "again"), (10**6 + 3, "again"), (5, None), (None, "no id")]
    extra = spark.createDataFrame(odd, "doc_id long, text string")
    return rows.unionByName(extra).selectExpr("*", "1 AS key", "'x' AS n", "2 AS ids")


def test_words_and_windows_follow_the_definition():
    texts = ["A b\tC\n\x0bd\x0c e\r f", None, "", "  ", "one", "É x", "a\xa0b c"]
    words = Words(pa.array(texts), fold=True)
    want = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(words.bounds).tolist() == [len(w) for w in want]
    names: dict[bytes, int] = {}
    for word, value in zip((w for ws in want for w in ws), words.hashes().tolist()):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)
    made, ends = windows(words.hashes(), words.bounds, 5)
    assert np.diff(ends).tolist() == [2, 0, 0, 0, 1, 1, 1] and len(set(made.tolist())) == len(made)
    assert len(Words(pa.array(["don't,x"]), between=SIGNS)) == 3
    assert windows(np.zeros(0, np.uint64), np.zeros(2, np.int64), 5)[1].tolist() == [0, 0]


def test_slices_keep_every_row():
    batch = pa.record_batch({"text": pa.array(["a" * 50, None, "", "b" * 500, "c"])})
    cut = list(slices([batch, batch.slice(0, 0)], limit=60))
    assert sum(map(len, cut)) == 5 and len(cut) > 1


def test_token_counts_are_the_library_s(documents):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(documents, path).collect()}
    for row in documents.collect():
        size = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        assert (row["doc_id"], len((row["text"] or "").encode()), size, size > 512) in found, row["text"]
    assert token_counts.token_counts(documents.limit(0), path).count() == 0


def test_packing_is_undone():
    draw = np.random.default_rng(0)
    values = draw.integers(0, 2**32, 5000, dtype=np.uint32) >> draw.integers(0, 32, 5000).astype(np.uint32)
    lengths = np.array([7, 0, 1, 4, 988, 4000])
    control, control_at, data, data_at = token_files.pack(values, lengths)
    assert data_at[-1] == len(data) and (np.diff(control_at) == -(-lengths // 4)).all()
    assert (token_files.unpack(control.tobytes(), data.tobytes(), lengths, np.diff(control_at)) == values).all()


def test_token_files_give_back_the_library_s_ids(spark, documents):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    out = token_files.token_files(documents, path).toPandas()
    want = []
    for row in documents.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        want.append((row["doc_id"] if row["doc_id"] is not None else -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    out["doc_id"] = out["doc_id"].fillna(-1)
    assert sorted(zip(out["doc_id"], out["n_tokens"], out["ids_crc32"])) == sorted(want)
    out = out.sort_values("start")
    assert (out["start"].to_numpy() == np.concatenate(([0], np.cumsum(out["n_tokens"])[:-1]))).all()
    assert out["doc_id"].is_monotonic_increasing
    assert token_files.token_files(documents.limit(0), path).count() == 0


def test_token_files_deal_one_key_over_parts(spark):
    rows = spark.createDataFrame([(7, f"text {i}") for i in range(300)] + [(1, "a"), (9, "z")], "doc_id long, text string")
    out = token_files.token_files(rows, P.path("word_bpe_49k.json")).toPandas().sort_values("start")
    assert len(out) == 302 and out["doc_id"].is_monotonic_increasing


def test_pieces_are_the_library_s(documents):
    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r["text"] for r in documents.collect()]
    coder = pieces.Encoder(path)
    for again in range(2):  # the second time from kept words
        ids, counts = coder.encode(texts)
        ends = np.concatenate(([0], np.cumsum(counts)))
        for text, a, b in zip(texts, ends[:-1], ends[1:]):
            assert ids[a:b].tolist() == library.encode(text or ""), text
    draw = np.random.default_rng(1)
    for _ in range(200):
        some = draw.integers(3, 32000, 9)
        assert coder.model.decode(some) == library.decode(some.tolist())


def test_pieces_decode_to_the_texts(documents):
    path = P.path("piece_bpe_32k.model")
    rows = pieces.digests(documents, path, with_ids=True)
    sign = documents.where("text LIKE '%▁%'").count()  # the model's sign for a space decodes to one
    assert rows.where("NOT round_trip").count() == sign == 1 and rows.count() == documents.count()
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(pieces.encoded(documents.where("doc_id < 50"), path), path).collect()}
    assert all(back[r["doc_id"]] == (r["text"] or "") for r in documents.where("doc_id < 50 AND doc_id <> 5").collect())
    assert pieces.digests(documents.limit(0), path).count() == 0


def test_suffix_array_orders_all_suffixes():
    text = np.frombuffer(b"banana\xffbandana\xff", np.uint8)
    room = np.concatenate((text, np.full(72, 255, np.uint8))).astype(np.uint64)
    word = np.zeros(len(text) + 64, np.uint64)
    for k in range(8):
        word |= room[k : k + len(word)] << np.uint64(8 * (7 - k))
    order = pieces.suffix_array(word, len(text), 64)
    suffixes = [bytes(room[i : i + 64].astype(np.uint8)) for i in order]
    assert suffixes == sorted(suffixes) and sorted(order.tolist()) == list(range(len(text)))


def mirrored_words(size):
    """A Thue-Morse word of two letters and its complement: the same hash under any polynomial modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return ["".join("ab"[bit ^ turn] for bit in bits) for turn in (0, 1)]


@pytest.mark.parametrize("size", [8, 16, 64, 72, 1024, 2048])
def test_words_of_the_same_make_have_hashes_of_their_own(size):
    found = Words(pa.array([" ".join(mirrored_words(size)), *mirrored_words(size)])).hashes()
    assert found[0] == found[2] and found[1] == found[3] and found[0] != found[1]


def test_hashes_depend_on_bytes_alone():
    draw = random.Random(4)
    words = sorted({"".join(draw.choice("aAbBéÉ0日") for _ in range(draw.randrange(1, 40))) for _ in range(3000)} | {"x" * n for n in range(1, 300)})
    together = Words(pa.array([" ".join(words)])).hashes()
    alone = Words(pa.array(words)).hashes()
    assert (together == alone).all() and len(set(alone.tolist())) == len(words)
    folded = Words(pa.array(words), fold=True).hashes()
    lower = Words(pa.array([w.translate({c: c + 32 for c in range(65, 91)}) for w in words])).hashes()
    assert (folded == lower).all()


def test_token_files_of_words_of_the_same_make(spark):


    path = P.path("word_bpe_49k.json")
    texts = [*mirrored_words(1024), "plain words"]
    library = Tokenizer.from_file(path)
    want = [zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 8):
        got = {r["doc_id"]: r["ids_crc32"] for r in token_files.token_files(rows.repartition(parts), path).collect()}
        assert [got[i] for i in range(3)] == want


def test_long_words_control_ids_and_small_caches_change_no_id(monkeypatch):
    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgéhijklmn漢ostrue😀\x01") for _ in range(n)) for n in (47, 48, 49, 700, 20_000)]
    monkeypatch.setattr(pieces, "KEPT_BYTES", 100)
    coder = pieces.Encoder(path)
    for word in [*words, "aa " * 40, *words]:
        ids, counts = coder.encode([word, None, word])
        assert ids[: counts[0]].tolist() == library.encode(word) == ids[counts[0] :].tolist()
        assert coder.model.decode(ids[: counts[0]]) == library.decode(library.encode(word))
    euro = [int(coder.model.bytes[b]) for b in "€".encode()]
    assert coder.model.decode(np.array(euro)) == "€" and coder.model.decode(np.array([1, *euro, 2])) == "€"
    assert "€" not in coder.model.decode(np.array([euro[0], 1, *euro[1:]]))
    assert coder.model.decode(np.array([0, 0])) == " ⁇  ⁇ " and coder.model.decode(np.zeros(0, int)) == ""
