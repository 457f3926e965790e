"""Laws of the draws on small tables: frequencies, exclusion, levels, independence of partitioning."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from casemill.functions.text import list_text, row_key
from casemill.functions.uniform import position_below, uniform, uniform_int
from casemill.operators.conditional import draw_some
from casemill.operators.draws import draw_per_group, draw_with_replacement, stay_ids
from casemill.operators.positions import lay_out, pool_totals, skip_taken, slotted, span
from casemill.operators.secondary import _counted
from casemill.plans import profile_cohort, table_cohort

N = 6000


def close(observed: Counter, expected: dict, n: int) -> None:
    """Chi-squared of the counts stays below a bound that a right law passes with near certainty."""
    assert set(observed) <= set(expected)
    chi = sum((observed[k] - n * p) ** 2 / (n * p) for k, p in expected.items())
    freedom = len(expected) - 1
    assert chi < freedom + 5 * (2 * freedom) ** 0.5 + 5, (chi, freedom)


def test_uniform_stays_inside_and_is_even(spark):
    u = spark.range(N).select(uniform(1, "salt", "id").alias("u"), uniform_int(uniform(1, "n", "id"), 2, 5).alias("n"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < low < high < 1 and abs(mean - 0.5) < 0.02
    close(Counter(r["n"] for r in u.collect()), {n: 0.25 for n in (2, 3, 4, 5)}, N)


def test_weighted_draw_follows_weights_and_skips_zero(spark):
    table = spark.createDataFrame([("a", 1), ("b", 0), ("c", 3), ("d", None), ("a", 5)], "k string, w bigint")
    drawn = draw_with_replacement(table, "w", ["k"], stay_ids(spark, N), "stay_id", 3)
    counts = Counter(r["k"] for r in drawn.collect())
    close(counts, {"a": 0.6, "c": 0.3, "d": 0.1}, N)


def test_fractional_and_absent_weights(spark):
    table = spark.createDataFrame([("a", 0.25), ("b", 0.75), ("c", 1e-15)], "k string, w double")
    counts = Counter(r["k"] for r in draw_with_replacement(table, "w", ["k"], stay_ids(spark, N), "stay_id", 3).collect())
    close(Counter({k: v for k, v in counts.items() if k != "c"}), {"a": 0.25, "b": 0.75}, N)
    even = Counter(r["k"] for r in draw_with_replacement(table, "nb", ["k"], stay_ids(spark, N), "stay_id", 4).collect())
    close(even, {k: 1 / 3 for k in "abc"}, N)


def test_groups_keep_their_shares_beside_far_heavier_groups(spark):
    table = spark.createDataFrame([("x", "a", 1e-12), ("x", "b", 3e-12), ("x", "c", None), ("y", "a", 1e15), ("y", "b", 1e15), ("z", "a", -1.0)], "scale string, k string, w double")
    asked = stay_ids(spark, 3 * N).withColumn("scale", F.get(F.array(*map(F.lit, "xyz")), (F.col("stay_id") % 3).cast("int")))
    rows = draw_per_group(asked, "stay_id", table.where("w is not null"), "w", ["scale"], ["k"], 5).collect()
    close(Counter(r["k"] for r in rows if r["scale"] == "x"), {"a": 0.25, "b": 0.75}, N)
    close(Counter(r["k"] for r in rows if r["scale"] == "y"), {"a": 0.5, "b": 0.5}, N)
    assert all(r["k"] is None for r in rows if r["scale"] == "z") and len(rows) == 3 * N


@pytest.mark.parametrize("unit", [1e-12, 1e-3, 1e10])
def test_shares_hold_at_any_size_of_weight(spark, unit):
    table = spark.createDataFrame([("a", unit), ("b", 100 * unit), ("c", 300 * unit)], "k string, w double")
    counts = Counter(r["k"] for r in draw_with_replacement(table, "w", ["k"], stay_ids(spark, N), "stay_id", 5).collect())
    close(counts, {"a": 1 / 401, "b": 100 / 401, "c": 300 / 401}, N)


def test_masses_beyond_the_line_are_scaled(spark):
    table = spark.createDataFrame([("a", 2**62), ("b", 2**62), ("c", 2**61)], "k string, w bigint")
    counts = Counter(r["k"] for r in draw_with_replacement(table, "w", ["k"], stay_ids(spark, N), "stay_id", 6).collect())
    close(counts, {"a": 0.4, "b": 0.4, "c": 0.2}, N)
    odd = spark.createDataFrame([("a", 0.5), ("b", float("nan")), ("c", float("inf")), ("d", -1.0)], "k string, w double")
    assert {r["k"] for r in draw_with_replacement(odd, "w", ["k"], stay_ids(spark, 50), "stay_id", 6).collect()} == {"a"}


def test_positions_reach_all_of_a_long_line(spark):
    at = spark.range(N).select(position_below(F.lit(2**62).cast("bigint"), 1, "far", "id").alias("at")).collect()
    assert all(0 <= r["at"] < 2**62 for r in at) and len({r["at"] % 64 for r in at}) > 8
    for size in (1, 7, 1000, 2**40 + 3):
        found = spark.range(200).select(position_below(F.lit(size).cast("bigint"), 1, "s", "id").alias("at")).collect()
        for i, row in enumerate(found):
            digest = hashlib.md5(f"1|s|{i}".encode()).hexdigest()
            bits = (int(digest[:8], 16) >> 2) << 30 | int(digest[8:16], 16) >> 2
            assert row["at"] == bits * size >> 60


def test_fractional_row_weights_of_conditional_pools(spark):
    rows = spark.createDataFrame([("x", "A01", 0.4), ("x", "B01", 0.9), ("x", "C01", None)], "k string, code string, nb double")
    units = _counted(rows, ["k", "code"], "nb").collect()
    total = sum(r["unit"] * r["rows"] for r in units)
    assert {r["code"]: round(r["unit"] * r["rows"] / total, 6) for r in units} == {"A01": round(0.4 / 2.3, 6), "B01": round(0.9 / 2.3, 6), "C01": round(1 / 2.3, 6)}


def test_asking_beyond_what_was_prepared_raises(spark):
    with pytest.raises(ValueError, match="prepared for 2"):
        table_cohort.draw_prepared({"n_das": 2}, stay_ids(spark, 1), n_das=3)


def test_profiles_with_nulls_and_separators_stay_apart(spark):
    lists = [["A", "B"], ["A", None, "B"], ["A,B"], ["~"], [None], [], None, ["=A", "B"], ["A,", "B"], ["A", ",B"]]
    frame = spark.createDataFrame([(i, x, y) for i, x in enumerate(lists) for y in ("u", None, "~", "u|=v")], "i int, codes array<string>, other string")
    keys = [r["key"] for r in frame.select(row_key(list_text("codes"), "other").alias("key")).collect()]
    assert len(set(keys)) == len(keys)
    pair = spark.createDataFrame([("~", None), (None, "~"), ("a|=b", "c"), ("a", "b|=c")], "a string, b string")
    assert pair.select(row_key("a", "b")).distinct().count() == 4


def test_preset_lists_do_not_run_into_each_other(spark):
    profiles = spark.createDataFrame([("p", ["A", "B"]), ("q", ["A", None, "B"]), ("r", ["A,B"]), ("s", None)], "profile_key string, icd_secondary_code array<string>")
    members = spark.createDataFrame([], "code string, sets array<string>")
    labels = spark.createDataFrame([("A", "la"), ("B", "lb")], "code string, label string")
    found = {r["profile_key"]: r["preset"]["codes"] for r in profile_cohort.with_preset(profile_cohort.typed_profiles(profiles), "profile_key", members, labels).collect()}
    assert found == {"p": ["A", "B"], "q": ["A", "B"], "r": ["A,B"], "s": []}


def test_empty_table_raises_when_it_runs(spark):
    table = spark.createDataFrame([("a", 0)], "k string, w bigint")
    with pytest.raises(PySparkException, match="positive weight"):
        draw_with_replacement(table, "w", ["k"], stay_ids(spark, 5), "stay_id", 3).collect()


@pytest.mark.parametrize("nomenclature", [True, False])
def test_layout_is_a_gapless_line(spark, nomenclature):
    rows = [("p", chr(97 + i % 5) + str(i), (i * 7) % 4) for i in range(40)] + [("q", "z", 100), (None, "x", 1)]
    frame = spark.createDataFrame(rows, "pool string, code string, mass bigint")
    laid = lay_out(frame, ["pool"], ["code"], F.col("mass"), F.substring("code", 1, 1), nomenclature=nomenclature)
    got = sorted(laid.select("pool", "lo", "hi", "g_lo", "g_hi", "total", "n_groups", "step").collect())
    assert {r["pool"] for r in got} == {"p", "q"}
    for pool in ("p", "q"):
        spans = [r for r in got if r["pool"] == pool]
        mass = sum(m for p, _, m in rows if p == pool)
        assert spans[0]["lo"] == 0 and spans[-1]["hi"] == mass == spans[0]["total"]
        assert all(a["hi"] == b["lo"] for a, b in itertools.pairwise(spans))
        assert all(r["g_lo"] <= r["lo"] < r["hi"] <= r["g_hi"] for r in spans)
        assert spans[0]["n_groups"] == len({(r["g_lo"], r["g_hi"]) for r in spans})
    slots = slotted(laid).groupBy("pool").count().collect()
    assert all(r["count"] <= 2 * 64 + 40 for r in slots)


def test_skip_taken_leaves_spans_out(spark):
    taken = F.array(span(F.lit(5), F.lit(8)), span(F.lit(0), F.lit(2)))
    got = [r["at"] for r in spark.range(7).select(skip_taken(F.col("id"), taken).alias("at")).collect()]
    assert got == [2, 3, 4, 8, 9, 10, 11]


def pairs_without_replacement(weights: dict) -> dict:
    total = sum(weights.values())
    return {
        (a, b): weights[a] / total * weights[b] / (total - weights[a]) for a, b in itertools.permutations(weights, 2)
    }


def draw_pairs(spark, weights: dict, groups: bool) -> Counter:
    rows = spark.createDataFrame([("p", code, unit) for code, unit in weights.items()], "pool string, code string, unit bigint")
    laid = lay_out(rows, ["pool"], ["code", "unit"], F.col("unit"), F.substring("code", 1, 1), nomenclature=True)
    facts = pool_totals(laid, ["pool"]).select(F.struct("total", "step").alias("facts"))
    stays = stay_ids(spark, N).withColumn("facts", facts.scalar())
    drawn = draw_some(
        stays, "stay_id", laid, F.lit("p"), F.col("facts"), F.lit(2), 2, {"code": "code"}, "pick", 5, distinct_groups=groups
    )
    return Counter((r["pick_code_1"], r["pick_code_2"]) for r in drawn.collect())


def test_two_draws_without_replacement(spark):
    weights = {"a1": 1, "a2": 2, "b1": 3, "c1": 4}
    close(draw_pairs(spark, weights, groups=False), pairs_without_replacement(weights), N)


def test_second_draw_avoids_the_first_group(spark):
    weights = {"a1": 1, "a2": 2, "b1": 3, "c1": 4}
    expected = {}
    for a, b in itertools.permutations(weights, 2):
        if a[0] != b[0]:
            left = sum(w for c, w in weights.items() if c[0] != a[0])
            expected[a, b] = weights[a] / 10 * weights[b] / left
    close(draw_pairs(spark, weights, groups=True), expected, N)


DAS = [
    ("G1", "A", 1, "D100", "X10", 3),
    ("G1", "A", 1, "D100", "X11", 1),
    ("G1", "A", 2, "D100", "Y20", 2),
    ("G1", "B", 1, "D101", "Y21", 5),
    ("G1", "B", 1, "E200", "Z30", 4),
    ("G1", "B", 1, "E200", "X12", 9),
    ("G2", "B", 1, "E200", "W40", 9),
]


def table_inputs(spark) -> dict:
    frame = spark.createDataFrame
    return {
        "dp": frame([("A", 1, "G1", "D100", 2), ("B", 2, "G3", "F300", 1), ("B", 2, None, "F300", 90)], "AGE string, SEXE int, GHM5 string, DP string, P_DP bigint"),
        "das": frame(DAS, "GHM5 string, AGE string, SEXE int, DP string, DAS string, P_DAS bigint"),
        "ccam": frame([("G1C", "D1", "Q", 1)], "GHM5 string, DP string, CCAM string, P_CCAM bigint"),
        "dms": frame([("G1", 2.0, 3.0, 2.0)], "GHM5 string, DMS_P25 double, DMS_P50 double, DMS_P75 double"),
        "rghm": frame([("mco", "v2024", "racine", "G1", "Group one")], "champ string, version string, type_code string, code string, lib string"),
        "cim10": frame([("X10", "Ten", 1), ("X11", "Old", 0)], "code string, liblong string, en_cours int"),
        "ccam_ref": frame([("Q", "Act", 1)], "code string, liblong string, en_cours int"),
    }


def sequential_law(n: int) -> dict:
    """Exact law of the sequential draw for (G1, A, 1, D100), by enumeration."""
    pools = []
    for keep in (
        lambda r: r[:4] == ("G1", "A", 1, "D100"),
        lambda r: (r[0], r[2], r[3]) == ("G1", 1, "D100"),
        lambda r: (r[0], r[3]) == ("G1", "D100"),
        lambda r: r[0] == "G1" and r[3][:3] == "D10",
        lambda r: r[0] == "G1",
    ):
        pool = Counter()
        for row in filter(keep, DAS):
            pool[row[4]] += row[5]
        pools.append(pool)
    law = Counter()

    def go(drawn: tuple, p: float) -> None:
        if len(drawn) == n:
            law[drawn] += p
            return
        for pool in pools:
            left = {c: w for c, w in pool.items() if c[:2] not in {d[:2] for d in drawn}}
            if left:
                for code, w in left.items():
                    go((*drawn, code), p * w / sum(left.values()))
                return
        law[drawn] += p

    go((), 1.0)
    return law


def test_cascaded_diagnoses_follow_the_sequential_law(spark):
    from casemill.operators.associated import draw_associated

    prepared = table_cohort.prepare(table_inputs(spark), n_das=4)
    assert prepared["hot"].where("salts > 1").count() == 5  # a profile with two thirds of the mass: its pools are salted
    plans = prepared["profiles"].where("GHM5 = 'G1'").select("das_plans").scalar()
    stays = stay_ids(spark, 4 * N).withColumn("das_plans", plans)
    drawn = draw_associated(stays, "stay_id", prepared["das"], prepared["hot"], 4, 11).collect()
    by_size = Counter(len(r["DAS_CODE"]) for r in drawn)
    assert set(by_size) <= {0, 1, 2, 3}  # three categories in all: a fourth pick finds nothing
    for n in (1, 2):
        seen = Counter(tuple(r["DAS_CODE"]) for r in drawn if len(r["DAS_CODE"]) == n)
        close(seen, sequential_law(n), by_size[n])
    full = Counter(tuple(r["DAS_CODE"]) for r in drawn if len(r["DAS_CODE"]) == 3)
    close(full, sequential_law(3), by_size[3])


def test_stays_without_pools_and_labels(spark):
    rows = table_cohort.draw_stays(table_inputs(spark), stay_ids(spark, 300), seed=2).collect()
    lone = [r for r in rows if r["GHM5_CODE"] == "G3"]
    assert lone and all(r["DAS"] == [] and r["CCAM"] == [] and r["DMS"] == 1 and r["GHM5"] == "G3" for r in lone)
    known = [r for r in rows if r["GHM5_CODE"] == "G1"]
    assert {r["GHM5"] for r in known} == {"Group one"} and {r["DMS"] for r in known} <= {2, 3}
    shown = {c for r in known for c in r["DAS"]}
    assert "Ten (X10)" in shown and "X11" in shown


def test_no_category_twice_and_partition_invariance(spark, sf):
    from catalog import table_queries as tabled

    ids = tabled.stay_ids(spark, sf)
    prepared = tabled.prepared(spark, sf)
    one = table_cohort.draw_prepared(prepared, ids.repartition(1), seed=9)
    scattered = {k: v if isinstance(v, int) else v.repartition(13) for k, v in prepared.items()}
    many = table_cohort.draw_prepared(scattered, ids.repartition(8), seed=9)
    first, second = sorted(one.collect()), sorted(many.collect())
    assert first == second
    codes = tabled.associated(spark, sf).collect()
    for row in codes:
        cats = [c[:2] for c in row["das_codes"].split(",") if c]
        assert len(cats) == len(set(cats))


def test_draw_per_group_stays_in_its_group(spark):
    table = spark.createDataFrame([("x", "a", 0.1), ("x", "b", 0.3), ("y", "c", 5.0), (None, "d", 1.0)], "g string, k string, w double")
    asked = stay_ids(spark, N).withColumn("g", F.when(F.col("stay_id") % 3 == 0, "y").when(F.col("stay_id") % 3 == 1, "x"))
    drawn = draw_per_group(asked, "stay_id", table, "w", ["g"], ["k"], 3).collect()
    assert len(drawn) == N and {r["k"] for r in drawn if r["g"] == "y"} == {"c"} and {r["k"] for r in drawn if r["g"] is None} == {None}
    counts = Counter(r["k"] for r in drawn if r["g"] == "x")
    close(counts, {"a": 0.25, "b": 0.75}, sum(counts.values()))


def test_requests_give_what_single_draws_give(spark):
    from casemill.operators.positions import bucketed_slots, salted
    from casemill.operators.requests import answers, asked, request

    weights = {"a1": 1, "a2": 2, "b1": 3, "c1": 4}
    rows = spark.createDataFrame([(p, code, unit) for p in "pq" for code, unit in weights.items()], "pool string, code string, unit bigint")
    laid = lay_out(rows, ["pool"], ["code", "unit"], F.col("unit"), F.substring("code", 1, 1), nomenclature=True)
    hot = spark.createDataFrame([("p", 5)], "pool string, salts int")
    slots = bucketed_slots(laid, hot, "test-slots")
    facts = {r["pool"]: r for r in salted(pool_totals(laid, ["pool"]), hot).collect()}

    def struct(pool):
        found = facts[pool]
        return F.struct(F.lit(pool).alias("pool"), *[F.lit(found[n]).cast("bigint").alias(n) for n in ("total", "step", "salts")])

    stays = stay_ids(spark, 500).withColumns({"one": struct("p"), "other": struct("q")})
    wanted = (F.col("stay_id") % 4).cast("int")  # none, one, two, and one more than there are picks
    table = asked(stays, "stay_id", [request("pick", F.col("one"), wanted, by_group=True), request("also", F.col("other"), F.when(F.col("stay_id") % 3 == 0, 2))])
    got = {r["stay_id"]: {k: [x["code"] for x in v] for k, v in r["answers"].items()} for r in answers(table, "stay_id", slots, 2, ["code"], 5).collect()}
    for salt, pool, facts_of, want, groups in (("pick", "p", "one", wanted, True), ("also", "q", "other", F.when(F.col("stay_id") % 3 == 0, F.lit(2)), False)):
        single = draw_some(stays, "stay_id", laid, F.lit(pool), F.col(facts_of), want, 2, {"code": "code"}, salt, 5, distinct_groups=groups).collect()
        for row in single:
            items = [c for c in (row[f"{salt}_code_1"], row[f"{salt}_code_2"]) if c is not None]
            assert got.get(row["stay_id"], {}).get(salt, []) == items


def test_lookups_of_buckets_shuffle_no_positions(spark, sf):
    from catalog import profile_queries as cases, table_queries as tabled

    drawn = tabled.associated(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert drawn.count("SelectedBucketsCount") >= 3 and drawn.count("Exchange hashpartitioning") == drawn.count("SortMergeJoin")
    cohort = cases.cohort_rows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert cohort.count("SortMergeJoin") <= 4 and cohort.count("SelectedBucketsCount") == 2


def test_lattice_adds_up_from_the_nearest_finer_level(spark):
    from casemill.operators.conditional import masks_in_use, pool_lattice, pooled_rows

    rows = [(a, b, c, i, 1 + (a or 0)) for a in (1, 2, None) for b in "xy" for c in (7, 8) for i in ("k", "l")]
    frame = spark.createDataFrame(rows, "a int, b string, c int, item string, rows bigint")
    profiles = spark.createDataFrame([(1, "x", 7), (None, "x", 7), (None, None, 7), (None, None, None), (1, None, 7)], "a int, b string, c int")
    masks = masks_in_use(["a", "b", "c"], profiles)
    assert masks == [0, 1, 2, 3, 7]
    levels = {mask: level.count() for mask, level in pool_lattice(frame, ["a", "b", "c"], ["item"], masks).items()}
    assert levels == {0: 24, 1: 8, 2: 12, 3: 4, 7: 2}
    got = {(r["pool"], r["item"]): r["rows"] for r in pooled_rows(frame, F.array(F.lit("m")), ["a", "b", "c"], profiles, ["item"]).collect()}
    want = Counter()
    for a, b, c, item, n in rows:
        for mask in masks:
            key = ["*" if mask >> i & 1 else v for i, v in enumerate((a, b, c))]
            if None not in key:
                want["|".join(map(str, ["m", *key])), item] += n
    assert got == dict(want)


def test_scale_of_weights_is_read_without_a_shuffle(spark):
    from casemill.operators.positions import int_weight

    table = spark.createDataFrame([("a", 2**62), ("b", 3), ("c", None), ("d", -4)], "k string, w bigint").repartition(4)
    plan = table.select(int_weight(table, "w").alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan and plan.count("Exchange") == 1
    assert {r["k"]: r["m"] for r in table.select("k", int_weight(table, "w").alias("m")).collect()} == {"a": 2**60, "b": 1, "c": 0, "d": 0}
