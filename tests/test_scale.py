"""What is sent whole to the executors stays small, and large inputs are not dealt out once more."""

from __future__ import annotations

from pyspark.sql import functions as F

from casemill import standins
from casemill.functions.text import row_key
from casemill.operators import secondary
from casemill.operators.associated import attach_das_plans, das_positions
from casemill.operators.draws import keyed_positions, table_positions
from casemill.operators.procedures import attach_procedure_pools
from casemill.plans import profile_cohort, table_cohort
from casemill.sources.scratch import written, written_in_buckets
from catalog import operator_queries


def plan_of(frame, capsys) -> str:
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


def test_codes_are_sent_once_however_many_parts_have_them(spark):
    parts = spark.createDataFrame(
        [(40, "b", "g", "A010"), (1, "c", "g", "A010"), (7, None, "g", "B020"), (9, "d", "h", "A010")], "p_partkey long, p_name string, ghm5 string, code string"
    )
    das = spark.createDataFrame([("A010",), ("C991",), ("C991",), ("D007",), (None,)], "DAS string")
    few = standins.one_part_per_code(parts)
    assert few.count() == 2
    for extra in (parts, parts.unionByName(parts.limit(1).selectExpr("99L AS p_partkey", "'z' AS p_name", "ghm5", "CAST(NULL AS STRING) AS code"))):
        want, got = (spark.sql(standins.VIEWS["cim10"], part_codes=x, pmsi_das=das).collect() for x in (extra, standins.one_part_per_code(extra)))
        assert sorted(map(repr, got)) == sorted(map(repr, want)) != []


def test_lines_are_joined_by_sorting(spark, sf, capsys):
    plan = plan_of(standins.view_plan(spark, sf, "stay_lines"), capsys)
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_views_are_the_same_dealt_out_or_not(spark, sf, monkeypatch):
    for name in ("pmsi_dp", "case_procedures"):
        dealt = standins.view(spark, sf, name)
        with monkeypatch.context() as patch:
            patch.setattr(standins, "DEALT_ROWS", 0)
            plain = standins.view(spark, f"{sf}/.", name)
        assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty() and not plain.isEmpty()


def test_plans_and_pools_of_profiles_are_not_sent_whole(spark, capsys):
    dp = spark.createDataFrame([("[0-18[", 1, "01C01", "A010", 3), ("[18-40[", 2, "01C01", "B020", 5)], "AGE string, SEXE int, GHM5 string, DP string, P_DP long")
    das = spark.createDataFrame([("[0-18[", 1, "01C01", "A010", "E110", 3), ("[18-40[", 2, "01C01", "B020", "I100", 2)], "AGE string, SEXE int, GHM5 string, DP string, DAS string, P_DAS long")
    ccam = spark.createDataFrame([("01C01", "A010", "JQGA001", 2)], "GHM5 string, DP string, CCAM string, P_CCAM long")
    labels = spark.createDataFrame([("E110", "diabetes")], "code string, label string")
    profiles = written(table_positions(table_cohort.eligible_profiles(dp), table_cohort.ORDER).withColumn("profile_key", table_cohort.profile_key()), "few-profiles")
    planned = attach_das_plans(profiles, "profile_key", written(das_positions(das, labels), "few-positions"), 3)
    assert "Broadcast" not in plan_of(planned, capsys) and planned.where("das_plans is not null").count() == 2
    pooled = attach_procedure_pools(profiles, ccam, labels)
    lookups = [line for line in plan_of(pooled, capsys).splitlines() if "HashJoin" in line]
    assert all("CCAM" in line for line in lookups)  # labels of codes alone
    assert [r["ccam_pool"][0]["code"] for r in pooled.orderBy("DP").collect()] == ["JQGA001", "JQGA001"]


def test_pool_sizes_shuffle_each_row_once(spark, capsys):
    rows = spark.createDataFrame([("a", "E110", 3), ("a", "E110", 2), ("a", "E119", 1), ("a", "I100", 4), ("b", "I1", 5), ("b", "", 1)], "pool string, DAS string, w long")
    made = operator_queries.pool_sizes(rows)
    plan = plan_of(made, capsys).split("Initial Plan")[0]
    assert "Expand" not in plan and plan.count("Exchange") == 2
    assert sorted(map(tuple, made.collect())) == [("a", 10, 3, 2), ("b", 6, 2, 2)]


def test_key_texts_are_not_shuffled_and_give_the_same_places(spark, capsys):
    rows = spark.createDataFrame([("a", 1, 3), ("b", None, 5), (None, 2, 1), ("c", 7, 2)], "x string, y int, w long")
    key = row_key("x", "y")
    made = keyed_positions(rows, "key", key)
    same = table_positions(rows.withColumn("key", key), ["key"])
    assert sorted(map(repr, made.select(*same.columns).collect())) == sorted(map(repr, same.collect()))
    shuffled = [line for line in plan_of(made, capsys).splitlines() if "Exchange hashpartitioning(grp" in line]
    assert shuffled and "key" in made.columns
    assert sum("REPARTITION_BY_COL" in line for line in shuffled) == 2  # rows, and the totals of their groups, from rows dealt out before the key is there


def test_profiles_without_own_codes_are_not_shuffled_for_them(spark, capsys):
    rows = spark.createDataFrame([(["E110", "I10"], 1), ([], 2), (None, 3), (["X"], 4)], "icd_secondary_code array<string>, n int")
    members = spark.createDataFrame([("E110", ["cancer"])], "code string, sets array<string>")
    labels = spark.createDataFrame([("I10", "high pressure")], "code string, label string")
    made = profile_cohort.with_preset(rows, None, members, labels)
    got = {r["n"]: (r["preset"]["codes"], r["preset"]["lines"], r["preset"]["any_cancer"]) for r in made.collect()}
    assert got == {1: (["E110", "I10"], ["-  (E110)\n", "- high pressure (I10)\n"], True), 2: ([], [], False), 3: ([], [], False), 4: (["X"], ["-  (X)\n"], False)}
    bare = made.where(F.size("icd_secondary_code") == 0)
    assert "none|" not in plan_of(bare, capsys)


def test_pools_are_looked_up_for_what_profiles_ask_and_not_for_each_profile(spark):
    kind = "drg_parent_code string, icd_primary_code string, cage2 string, sexe int, case_management_type string, los int, w long, total long"
    same = ("28Z14", "C186", None, 1)
    rows = [(*same, "Z511", 1, 3, 20), (*same, "Z511", 2, 4, 20), (*same, "Z480", 1, 5, 20), (*same, None, 1, 6, 20), ("01C01", None, "[0-18[", 2, "DP", 1, 2, 20)]
    profiles = spark.createDataFrame(rows, kind)
    requests = secondary.pool_requests(profiles, F.col("icd_primary_code").startswith("C"))
    assert sorted((r["treated"], r["w"]) for r in requests.where("icd_primary_code = 'C186'").collect()) == [(False, 11), (True, 7)]
    requests = secondary.with_pool_keys(requests, F.col("primary_is_cancer"), F.col("treated"))
    asked = {r["pool"]: r["w"] for r in secondary.asked_pools(requests).groupBy("pool").agg(F.sum("w").alias("w")).collect()}
    assert asked["treatment|C18"] == 7 and asked["chronic|C186|*|1"] == 18 and asked["acute|01C01|[0-18[|2"] == 2
    totals = spark.createDataFrame([("treatment|C18", 9, 9, 2, 1, False), ("chronic|C186|*|1", 8, 8, 2, 1, True)], "pool string, total long, copies long, n_groups long, step long, some_cancer boolean")
    hot = spark.createDataFrame([("chronic|C186|*|1", 4)], "pool string, salts int")
    found = secondary.found_pools(requests, totals, hot)
    stays = profiles.withColumn("primary_is_cancer", F.col("icd_primary_code").startswith("C"))
    made = secondary.attach_pools(secondary.with_pool_keys(stays, F.col("primary_is_cancer"), secondary.is_treated()), found)
    got = {(r["w"], r["pools"] and r["pools"]["treatment"] and r["pools"]["treatment"]["total"], r["pools"] and (r["pools"]["chronic"]["total"], r["pools"]["chronic"]["salts"])) for r in made.collect()}
    assert got == {(3, 9, (8, 4)), (4, 9, (8, 4)), (5, None, (8, 4)), (6, None, (8, 4)), (2, None, None)}


def test_profiles_are_laid_out_without_their_pools(spark):
    def frame(kind: str, *rows: tuple):
        return spark.createDataFrame(list(rows), kind)

    data = {
        "profiles": frame("drg_parent_code string, icd_primary_code string, case_management_type string, cage string, sexe int, nb long", ("28Z14", "C186", "Z511", "[18-40[", 1, 2), ("01C01", "I10", "DP", "[18-40[", 2, 1)),
        "secondary_icd": frame("drg_parent_code string, icd_primary_code string, icd_secondary_code string, cage2 string, sexe int, nb long", ("28Z14", "C186", "E119", "[18-80[", 1, 1), ("28Z14", "C186", "E119", "[18-80[", 1, 1)),
        "procedures": frame("procedure string, drg_parent_code string, icd_primary_code string, cage2 string, sexe int, nb long", ("JQGA001", "28Z14", "C186", "[18-80[", 1, 1)),
        "icd_official": frame("icd_code string, icd_code_description string", ("C186", "colon"), ("DP", "main")),
        "procedure_official": frame("procedure string, procedure_description string", ("JQGA001", "act")),
        "drg_statistics": frame("drg_parent_code string, los_mean double, los_sd double", ("28Z14", 3.0, 1.0)),
        "drg_parents_groups": frame("drg_parent_code string, drg_parent_description string", ("28Z14", "group")),
        "specialty": frame("drg_parent_code string, specialty string, ratio double", ("28Z14", "A", 1.0), ("28Z14", "B", 2.0)),
        "names": frame("prenom string, nom string, sexe int", ("ANNE", "ROUX", 2), ("PAUL", "PETIT", 1)),
        "hospitals": frame("hospital string", ("H",)),
        "cancer_codes": frame("CIM10 string", ("C186",)),
        "chronic": frame("code string, chronic int, libelle string", ("E119", 2, "E119")),
        "cancer_treatment": frame("icd_parent_code string, primary_site string, histological_type string, TNM string, stage string, biomarkers string, treatment_recommandation string, chemotherapy_regimen string", ("C18", "s", "type", "T1N0M0", "I", None, "t", "c")),
        "code_sets": frame("set_name string, code string", ("icd_codes_overnight_study", "Z0480")),
    }
    ready = profile_cohort.prepare(data)
    assert not {"pools", "mdp_sets", "los_mean", "specialty", "icd_primary_description"} & set(ready["profile_slots"].columns)
    stays = profile_cohort.draw_prepared(ready, spark.range(40).withColumnRenamed("id", "stay_id"), seed=3)
    facts = ("drg_parent_description", "icd_primary_description", "case_management_type_description", "department", "los_mean", "histological_type", "text_procedure")
    got = {r["icd_primary_code"]: tuple(r[name] for name in facts) for r in stays.collect()}
    assert got == {"C186": ("group", "colon", "", "B", 3.0, "type", "act"), "I10": (None, "", "main", None, None, None, "")}


def test_intermediates_are_packed_closely(spark, sf):
    rows = spark.range(10).selectExpr("id", "id % 3 AS slot")
    for made in (written(rows, "packed"), written_in_buckets(rows, "packed-buckets", ["slot"]), standins.view(spark, f"{sf}/../{sf.rsplit('/', 1)[1]}", "pmsi_dp")):
        assert not made.isEmpty() and all(".zstd.parquet" in file for file in made.inputFiles())


def test_pools_that_no_plan_enters_are_not_laid_out(spark, monkeypatch):
    from random import Random

    from casemill.operators import associated

    rng = Random(5)
    any_of = lambda *values: values[min(int(rng.random() * (len(values) + 0.2)), len(values) - 1)]
    rows = [(any_of("G1", "G2", "G3"), any_of("a", "b", None), any_of(1, 2, None), any_of("D100", "D101", "D20", None), f"{any_of(*'XYZ')}{rng.randrange(2)}{rng.randrange(3)}", rng.randrange(3)) for _ in range(150)]
    rows += [("G4", "a", 1, "D100", f"{c}00", 1) for c in "XYZ"]  # three categories in the finest pool
    das = spark.createDataFrame(rows, "GHM5 string, AGE string, SEXE int, DP string, DAS string, P_DAS long")
    keys = {(g, a, s, d) for g in ("G1", "G2", "G4", "G9") for a in ("a", "b", None) for s in (1, None) for d in ("D100", "D101", "D209", "E1") if g != "G4" or (a, s, d) == ("a", 1, "D100")}
    profiles = spark.createDataFrame(sorted(keys, key=repr), "GHM5 string, AGE string, SEXE int, DP string").withColumn("profile_key", row_key("GHM5", "AGE", "SEXE", "DP"))
    labels = spark.createDataFrame([("X00", "x")], "code string, label string")

    def plans(positions) -> list:
        planned = attach_das_plans(profiles, "profile_key", written(positions, "some-positions"), 3).collect()
        return sorted(repr((r["profile_key"], [p and {**p.asDict(), "taken": sorted(p["taken"])} for p in r["das_plans"] or []])) for r in planned)

    whole = das_positions(das, labels)
    want, pools = plans(whole), {r["pool"] for r in whole.select("pool").distinct().collect()}
    for few in (associated.FEW_POOLS, 0):  # sent whole, or joined by sorting
        monkeypatch.setattr(associated, "FEW_POOLS", few)
        some = das_positions(das, labels, profiles=profiles.drop("profile_key"), n_das=3)
        assert plans(some) == want
        kept = {r["pool"] for r in some.select("pool").distinct().collect()}
        assert kept < pools and "1|G4|a|1|D100" in kept and not any(p[0] != "1" and ("G3" in p or "G4" in p) for p in kept)


def test_lookups_of_people_are_not_fused_into_one_method(spark):
    from casemill.operators import people

    names = spark.createDataFrame([("ANNE", "ROUX", 2), ("PAUL", "PETIT", 1)], "prenom string, nom string, sexe int")
    laid = written(people.people_positions(names, spark.createDataFrame([("H",)], "hospital string")), "few-people")
    stays = people.draw_people(spark.range(9).selectExpr("id AS stay_id", "CAST(id % 2 + 1 AS INT) AS sexe"), "stay_id", laid, 3)
    assert {(r["sexe"], r["first_name"]) for r in stays.collect()} == {(1, "Paul"), (2, "Anne")}
    run = stays._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [line.split("*(")[1].split(")")[0] for line in run.splitlines() if "HashJoin" in line]
    assert len(joins) == len(set(joins)) == 5


def test_the_finest_level_of_a_lattice_is_worked_out_once(spark, capsys):
    from casemill.operators.conditional import pool_lattice

    rows = spark.createDataFrame([(1, "x", "i", 2), (1, "y", "i", 3)], "a int, b string, item string, rows long").repartition(3)
    levels = pool_lattice(rows, ["a", "b"], ["item"], [0, 2, 3])
    assert all("RoundRobin" not in plan_of(level, capsys) for level in levels.values())
    assert [(r["a"], r["rows"]) for r in levels[2].collect()] == [(1, 5)]
