"""Quality rules whose cutoffs are chosen under a proven limit on false rejections.

Every rule rejects a document whose signal is above a cutoff. For each stratum, rule and cutoff of a fixed grid, the
labelled good documents that it would reject are counted. The cutoff may be used if the exact binomial probability of
so few rejections, were the true rate ``risk / rules`` or more, is at most ``doubt`` divided by the number of tests in
all strata (Bonferroni). Of the usable cutoffs the one with the most labelled bad documents caught, less three for every
good one lost, is taken, the highest of equals. So with probability 1 - ``doubt`` the rules together reject at most the share ``risk`` of the good documents of
every stratum that pass the base rules. The bound needs labels that are independent: rows with the same text are one labelled
document, good only if all of them are. A stratum with too few labels to prove anything gets no cutoff, and keeps its documents.

Strata are bands of length in words. Only DataFrame functions run. Null and empty texts have no words and fail the base
rules; very long texts are one row like others; labels that are null, or of documents that do not occur, are passed over; a document with several labels counts
with the lowest; repeated documents are each judged. An empty table gives no rows, and without labels only the base
rules decide. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casemill.sources.scratch import written

#: Signals and the cutoffs that are tried for each, low to high.
GRID = {
    "symbol_share": [0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2],
    "dup_line_share": [0.0, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7],
    "repeat_share": [0.0, 0.01, 0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18],
    "mean_word": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 40.0],
}
#: First word counts of the strata.
BANDS = [0, 50, 200, 800]
RISK, DOUBT = 0.02, 0.05
#: Bad documents that a cutoff must catch to make up for a good one lost.
LOSS_WEIGHT = 3
WHITE = " \t\n\x0b\x0c\r"
_SPACES = r"[ \t\n\x0B\f\r]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once for a row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words that lie in a run of ``width`` words found twice or more in the array, the first included. Sorts the runs'
    hashes with their places, so a long text costs n log n."""

    def places(runs: Column) -> Column:
        same = lambda run, other: run["h"] == F.get(runs, other)["h"]
        found = F.filter(runs, lambda run, at: F.coalesce(same(run, at - 1), F.lit(False)) | F.coalesce(same(run, at + 1), F.lit(False)))
        return F.sort_array(F.transform(found, lambda run: run["i"]))

    def covered(starts: Column) -> Column:
        step = F.transform(starts, lambda start, at: F.least(F.lit(width), F.coalesce(F.get(starts, at + 1) - start, F.lit(width))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, one: total + one)

    def runs(hashes: Column) -> Column:
        last = F.size(hashes) - width
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(at, lambda i: F.struct(F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]).alias("h"), i.alias("i"))))

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return let(hashes, lambda h: let(runs(h), lambda r: let(places(r), covered)))


def signals(documents: DataFrame, key: str = "doc_id", text: str = "text", hashed: bool = False) -> DataFrame:
    """One row per document: key, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_lines``, ``n_repeat_words``; with ``hashed`` also ``text_hash``."""
    rows = _signals(documents.select(documents[key].alias("_key"), documents[text].alias("text")), "_key").withColumnRenamed("_key", key)
    return rows if hashed else rows.drop("text_hash")


def _signals(rows: DataFrame, carried: str) -> DataFrame:
    """The signals of ``text`` beside one other column."""
    rows = rows.select(carried, F.coalesce("text", F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    rows = rows.select(carried, "text", words.alias("words"), lines.alias("lines"))
    long = lambda column, name: column.cast("long").alias(name)
    return rows.select(
        carried,
        long(F.size("words"), "n_words"),
        long(F.char_length(F.array_join("words", "")), "word_chars"),
        long(F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")), "n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        long(F.size("lines"), "n_lines"),
        long(repeated_words(F.col("words")), "n_repeat_words"),
        F.md5(F.col("text").cast("binary")).alias("text_hash"),
    )


def rule_signals(rows: DataFrame) -> DataFrame:
    """The shares that the rules look at, and the stratum."""
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    band = reduce(lambda found, first: F.when(F.col("n_words") >= first, first).otherwise(found), BANDS[1:], F.lit(BANDS[0]))
    return rows.withColumns(
        {
            "stratum": band,
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "mean_word": share("word_chars", "n_words"),
        }
    )


def base_failed(least_words: int = 10, most_repeated: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def log_gamma(x: Column) -> Column:
    """ln Γ(x) for x >= 1 by Stirling's series at x + 8, good to 1e-11."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    product = reduce(lambda a, b: a + b, [F.log(x + k) for k in range(8)])
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - product


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate); 1 where k is above the mean. Below the mean the terms fall away from k down, and
    are summed until they are far less than the rounding of the first."""
    n, k = n.cast("double"), k.cast("double")
    reach = F.least(k, F.ceil(12 * F.sqrt(n * rate * (1 - rate)) + 60)).cast("long")

    def term(i: Column) -> Column:
        j = k - i
        return F.exp(log_gamma(n + 1) - log_gamma(j + 1) - log_gamma(n - j + 1) + j * math.log(rate) + (n - j) * math.log1p(-rate))

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), reach), F.lit(0.0), lambda sum_, i: sum_ + term(i))
    return F.when(k > n * rate, F.lit(1.0)).otherwise(total)


def cutoffs(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """(``stratum``, ``rule``, ``cutoff``) of the rules in use: at most one row per stratum and rule. ``rows`` has the
    columns of ``rule_signals``, with ``text_hash``; without it each key is one labelled document. Documents that fail the base rules take no part."""
    known = labels.select(labels[key].alias(key), labels[label].alias("label")).where("label IS NOT NULL").groupBy(key).agg(F.min("label").alias("label"))
    tests = [(rule, cutoff) for rule, grid in GRID.items() for cutoff in grid]
    good = F.col("label") == 1
    each = rows.where(~base_failed()).join(known, key).groupBy("text_hash" if "text_hash" in rows.columns else key)
    told = [F.first(name).alias(name) for name in ("stratum", *GRID)]  # the same for the same text
    counted = (
        each.agg(F.min("label").alias("label"), *told)
        .groupBy("stratum")
        .agg(
            F.count_if(good).alias("n"),
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"),
                        F.lit(cutoff).alias("cutoff"),
                        F.count_if(good & (F.col(rule) > cutoff)).alias("lost"),
                        F.count_if(~good & (F.col(rule) > cutoff)).alias("caught"),
                    )
                    for rule, cutoff in tests
                ]
            ).alias("tests"),
        )
    )
    usable = counted.select("stratum", "n", F.inline("tests")).where(binomial_tail(F.col("lost"), F.col("n"), risk / len(GRID)) <= doubt / (len(tests) * len(BANDS)))
    return usable.withColumn("gain", F.col("caught") - LOSS_WEIGHT * F.col("lost")).where("gain > 0").groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))


def judged(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """One row per document: key, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, and the names of the rules it broke."""
    rows = rule_signals(written(signals(documents, key, text, hashed=True), "quality-signals"))
    rows = _broken(rows, cutoffs(rows, labels, key, label, risk, doubt))
    return rows.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & (F.size("broken") == 0)).alias("kept"), "broken"
    )


def _broken(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` with the names of the rules that each breaks."""
    wide = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))  # a row per stratum, an entry per rule
    rows = rows.join(F.broadcast(wide), "stratum", "left")
    broken = F.filter(F.array(*[F.when(F.col(rule) > F.col("cutoffs")[rule], F.lit(rule)) for rule in GRID]), lambda rule: rule.isNotNull())
    return rows.withColumn("broken", broken).drop("cutoffs")


def kept(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """The documents that no rule rejects, with all their columns. Their signals are worked out again rather than joined,
    so that no text is shuffled."""
    chosen = written(cutoffs(rule_signals(written(signals(documents, key, text, hashed=True), "quality-signals")), labels, key, label, risk, doubt), "quality-cutoffs")
    rows = _signals(documents.select(F.struct("*").alias("_row"), documents[text].alias("text")), "_row")
    rows = _broken(rule_signals(rows), chosen)
    return rows.where(~base_failed() & (F.size("broken") == 0)).select("_row.*")
