"""Rules, classifiers and sampling."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.llm import quality_classifier as Q, quality_rules as R, toxicity as T
from casemill.llm.sampling import training_rows


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def brute_signals(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(lines), len(inside)


def test_signals_follow_their_definition(spark, sf):
    odd = ["", None, " ", "a", "a b c d e", "a b c d e a b c d e", " x \n x \n x\n\n\n y", "ééé #*&|<> ", "a " * 5000, "\x0b\x0c a\r\nb\tc", "a b a b", "\x1ca b"]
    texts = odd + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = {r["doc_id"]: tuple(r)[1:] for r in R.signals(rows_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute_signals(text), text


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 5, 50, 1000, 4000) for k in (0, 1, 3, 9, 19) if k <= n]
    frame = spark.createDataFrame(cases, "k long, n long").withColumn("p", R.binomial_tail(F.col("k"), F.col("n"), 0.005))
    for row in frame.collect():
        exact = sum(math.comb(row["n"], j) * 0.005**j * 0.995 ** (row["n"] - j) for j in range(row["k"] + 1))
        assert row["p"] == pytest.approx(exact if row["k"] <= 0.005 * row["n"] else 1.0, abs=1e-11)


def test_cutoffs_hold_the_risk_and_need_evidence(spark):
    good, bad = "plain words of a quiet text that goes on for a while and says a little more than ten words", "br*** ok** en$$ wo### rds$$ ev** er&& yw%% he## re** in&& th%% is## te** xt$$ no** w"
    texts = [f"{good} {i}" for i in range(6000)] + [f"{bad} {i}" for i in range(500)] + [f"{bad} good {i}" for i in range(2)]
    rows = rows_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 6000 or i >= 6500), 9) for i in range(6502)] + [(None, 1, 0), (3, None, 0), (99999, 1, 0)], "doc_id long, quality int, text int")
    out = R.judged(rows, labels)
    assert out.where("doc_id < 6000 AND NOT kept").count() == 0 and out.where("doc_id >= 6000 AND kept").count() == 0
    few = R.judged(rows, labels.where("doc_id % 100 = 0"))
    assert few.where("NOT kept").count() == 0  # too few labels to prove anything
    none = R.judged(rows, labels.limit(0))
    assert none.where("NOT kept AND NOT base_failed").count() == 0
    assert R.judged(rows.limit(0), labels).count() == 0


def test_kept_documents_have_their_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 AS words", "2 AS n_words", "'s' AS stratum", "3 AS _key")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = R.kept(docs, labels)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in R.judged(docs, labels).where("kept").collect()}
    kept = Q.kept(docs, Q.train(docs, labels))
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()


def test_training_rows_leave_the_held_out_part(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = training_rows(docs, labels, "quality", 30)
    keys = [r["key"] for r in rows.collect()]
    assert 0 < len(keys) == len(set(keys)) <= 30 and all(zlib.crc32(str(k).encode()) % 5 for k in keys)


def test_attention_gradient():
    draw = np.random.default_rng(1)
    counts, good = np.array([1, 3, 5, 2]), np.array([0.0, 1, 1, 0])
    bags = [draw.normal(size=(k, Q.FEATURES)) for k in counts]
    before, Q.EPOCHS = Q.EPOCHS, 0
    try:
        model = Q.fit(good, bags)
    finally:
        Q.EPOCHS = before
    model.mean, model.scale, rows = model.mean.astype(float), model.scale.astype(float), np.concatenate(bags)

    def loss():
        score = model.forward(rows, counts)["score"]
        return -(good * np.log(score) + (1 - good) * np.log(1 - score)).mean()

    for name, slope in model.slopes(rows, counts, good).items():
        at = tuple(draw.integers(0, n) for n in slope.shape)
        kept = model.value[name][at]
        model.value[name][at] = kept + 1e-5
        up = loss()
        model.value[name][at] = kept - 1e-5
        down = loss()
        model.value[name][at] = kept
        assert (up - down) / 2e-5 == pytest.approx(slope[at], abs=1e-6), name


def test_machine_learns_a_pair_that_single_terms_miss():
    """Two terms that are toxic together and harmless alone."""
    draw = np.random.default_rng(0)
    kinds = draw.integers(0, 4, 1200)
    texts = [" ".join(["filler"] + ["insult"] * (k in (1, 3)) + ["groupname"] * (k in (2, 3)) + [f"w{draw.integers(50)}"]) for k in kinds]
    model = T.fit((kinds == 3).astype(int), [T.text_terms(t) for t in texts])
    assert model.score("insult filler groupname") > 0.5 > max(model.score("filler insult"), model.score("filler groupname"))


def test_scores_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = T.scored(docs, T.train(docs, labels)).join(labels, "doc_id").where("held_out")
    assert toxic.where("predicted <> toxic").count() <= 0.1 * toxic.count()
    quality = Q.scored(docs, Q.train(docs, labels)).join(labels, "doc_id").where("held_out")
    assert quality.where("predicted <> quality").count() <= 0.05 * quality.count()


@pytest.mark.parametrize("module", [T, Q])
def test_odd_rows_are_scored(spark, module):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (2, "x " * 30000), (2, "x " * 30000)], "doc_id long, text string").selectExpr("*", "0.5 AS score", "1 AS key")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(2, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        rows = module.scored(docs, module.train(docs, labels)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    assert module.scored(docs.limit(0), module.train(docs.limit(0), none)).count() == 0


def test_repeated_labelled_rows_prove_nothing(spark):
    """One good text in thousands of labelled rows is one label; as many different texts are labels each."""
    words = " ".join(f"word{i}" for i in range(60))
    same = spark.range(4000).selectExpr("id AS doc_id", f"'{words}' AS text")
    apart = spark.range(4000).selectExpr("id AS doc_id", f"concat('{words} ', id) AS text")
    for docs, proven in ((same, False), (apart, True)):
        labels = docs.selectExpr("doc_id", "1 AS quality").unionByName(spark.range(4000, 4400).selectExpr("id AS doc_id", "0 AS quality"))
        bad = spark.range(4000, 4400).selectExpr("id AS doc_id", "concat(repeat('### $$$ %%% &&& ', 20), id, ' a b c d e f g h i j k l m n o p q r s t u v w x y z') AS text")
        rows = R.rule_signals(R.signals(docs.unionByName(bad), hashed=True))
        rows = rows.withColumn("n_repeat_words", F.lit(0))  # only the symbols tell them apart
        assert bool(R.cutoffs(rows, labels).where("rule = 'symbol_share'").count()) == proven


def test_long_words_count_whole_and_all_passages_teach(spark):
    assert Q.word_features("a" * 64 + "#" * 9 + "0")[1] != Q.word_features("a" * 64)[1]
    long_ = " ".join(f"w{i}" for i in range(40_000))
    docs = spark.createDataFrame([(i, long_ if i % 2 else "short # text") for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    seen = []
    fit = Q.fit
    try:
        Q.fit = lambda labels, bags, seed=0: seen.extend(bags) or fit(labels, bags, seed)
        Q.train(docs, labels)
        assert {len(b) for b in seen} == {1, 625}
        before, Q.SAMPLE_PASSAGES = Q.SAMPLE_PASSAGES, 2000
        seen.clear()
        Q.train(docs, labels)
        assert 0 < sum(map(len, seen)) <= 2000
    finally:
        Q.fit, Q.SAMPLE_PASSAGES = fit, before


def test_word_features_are_made_in_parts(monkeypatch):
    import numpy as np

    from casemill.llm import quality_classifier

    texts = ["One two, three! 44 five-six", None, "", "two Seven eight. nine TEN 11 one", "a " * 200 + "Zürich"]
    whole, counts = quality_classifier.Passages().of(texts)
    monkeypatch.setattr(quality_classifier, "WORDS_AT_ONCE", 3)
    made = []
    monkeypatch.setattr(quality_classifier.np, "array", lambda rows, *kind, real=np.array: made.append(len(rows)) or real(rows, *kind))
    parts, again = quality_classifier.Passages().of(texts)
    assert (whole == parts).all() and (counts == again).all()
    assert made and max(made) <= 3
