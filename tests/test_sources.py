from __future__ import annotations

import json
import os

import pytest

from casemill import fixed_values as V
from casemill.plans.reports import generate_reports, write_reports
from casemill.sources import files, registry

ROWS = {
    "dp": "AGE;SEXE;GHM5;DP;P_DP\n41;2;08C24;M170;0.0311\n58;1;08C24;M171;0.00004\n73;2;08C24;M170;0.21\n",
    "ccam": "GHM5;DP;CCAM;P_CCAM\n08C24;M170;NFKA007;0.83\n08C24;M171;NFKA007;0.6\n",
    "das": "GHM5;AGE;SEXE;DP;DAS;P_DAS\n08C24;41;2;M170;E660;0.07\n08C24;73;2;M170;E660;0.4\n08C24;58;1;M171;E660;0.002\n",
    "dms": "GHM5;DMS_P25;DMS_P50;DMS_P75\n08C24;4;5;7\n",
    "rghm": "champ;version;type_code;code;lib\nmco;v2024;racine;08C24;Prothèse de genou\n",
    "cim10": "code;liblong;en_cours\nM170;Gonarthrose bilatérale;1\nM171;Autre gonarthrose;1\n",
    "ccam_ref": "code;liblong;en_cours\nNFKA007;Pose de prothèse;1\n",
}


def write(path, text: str, encoding: str = "utf-8") -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def test_ingest_draw_and_text_from_one_row_files(spark, tmp_path):
    from casemill.operators.draws import stay_ids
    from casemill.plans.table_cohort import draw_stays, short_scenario

    for name, text in ROWS.items():
        write(tmp_path / V.TABLE_FILES[name], text, "latin-1")
    tables = registry.ingest(spark, str(tmp_path), str(tmp_path))
    assert {r["liblong"] for r in tables["cim10"].collect()} == {"Gonarthrose bilatérale", "Autre gonarthrose"}
    loaded = registry.load_tables(spark, str(tmp_path))
    rows = short_scenario(draw_stays(loaded, stay_ids(spark, 40), seed=1)).collect()
    assert len(rows) == 40 and {r["GHM5"] for r in rows} == {"Prothèse de genou"}
    assert {tuple(r["CCAM"]) for r in rows} == {("Pose de prothèse (NFKA007)",)}
    assert {tuple(r["DAS"]) for r in rows} == {(), ("E660",)}
    assert all(4 <= r["DMS"] <= 7 for r in rows)


def test_ingest_keeps_converted_tables(spark, tmp_path):
    write(tmp_path / V.TABLE_FILES["dms"], ROWS["dms"])
    registry.ingest(spark, str(tmp_path), str(tmp_path / "out"), ["dms"])
    write(tmp_path / V.TABLE_FILES["dms"], ROWS["dms"] + "X;1;1;1\n")
    assert registry.ingest(spark, str(tmp_path), str(tmp_path / "out"), ["dms"])["dms"].count() == 1


def test_ingest_writes_half_written_tables_again(spark, tmp_path):
    write(tmp_path / V.TABLE_FILES["dms"], ROWS["dms"] + "09C02;1;2;3\n")
    out = tmp_path / "out"
    registry.ingest(spark, str(tmp_path), str(out), ["dms"])["dms"].limit(1).write.mode("overwrite").parquet(str(out / "half"))
    broken = out / "broken" / "dms.parquet"
    spark.read.parquet(str(out / "half")).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert registry.ingest(spark, str(tmp_path), str(out / "broken"), ["dms"])["dms"].count() == 2


def test_missing_files_are_named_together(spark, tmp_path):
    write(tmp_path / V.TABLE_FILES["dms"], ROWS["dms"])
    with pytest.raises(FileNotFoundError, match="PMSI_DP.csv, ALL_CIM10.csv"):
        registry.ingest(spark, str(tmp_path), str(tmp_path / "out"), ["dp", "dms", "cim10"])
    with pytest.raises(FileNotFoundError, match="profiles.*secondary_icd.*procedures"):
        registry.extracts(spark, str(tmp_path / "empty"))


def test_all_missing_inputs_of_the_profile_cohort_are_in_one_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as raised:
        registry.load_data(spark, str(tmp_path / "extracts"), str(tmp_path / "reference"))
    told = str(raised.value)
    names = [V.NAME_FILE, V.SYNONYM_FILE, V.HOSPITAL_FILE, *[file for file, _ in V.REFERENCE_PARQUET.values()], "profiles", "procedures"]
    assert all(name in told for name in names)


def test_missing_columns_are_named_together(spark):
    with pytest.raises(ValueError, match="table procedures, profiles.cage, profiles.sexe"):
        registry.require_columns({"profiles": spark.range(1).toDF("drg")}, {"procedures": ["procedure"], "profiles": ["drg", "cage", "sexe"]})


def test_latest_file_pools_the_patterns(spark, tmp_path):
    for age, name in ((30, "scenarios_new"), (20, "scenarios_a.parquet"), (10, "other.parquet")):
        path = tmp_path / name
        write(path, "x")
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    newest = files.latest_file(spark, str(tmp_path), V.EXTRACT_PATTERNS["profiles"], "profiles")
    assert newest.endswith("/scenarios_new")


def test_small_formats(spark, tmp_path):
    write(tmp_path / "w.csv", "diag;ponderation\nA00;1,25\nB00;3\n")
    weights = files.decimal_comma(spark, str(tmp_path / "w.csv"), V.WEIGHT_NAMES, "weight")
    assert [tuple(r) for r in weights.collect()] == [("A00", 1.25), ("B00", 3.0)]
    write(tmp_path / "names.csv", "prenom;nom;sexe\nLEA;MARTIN;2\n;DUPONT;1\n")
    assert files.complete_rows(spark, str(tmp_path / "names.csv"), ";").count() == 1
    write(tmp_path / "chu", "Hôpital Nord\nHôpital Sud\n")
    assert [r["hospital"] for r in files.one_column(spark, str(tmp_path / "chu"), "hospital").collect()] == ["Hôpital Nord", "Hôpital Sud"]
    write(tmp_path / "d.txt", "A000  |0|O|0|Court|Choléra classique\n", "latin-1")
    row = files.dictionary(spark, str(tmp_path / "d.txt")).first()
    assert (row["icd_code"], row["icd_code_description"]) == ("A000", "Choléra classique")
    write(tmp_path / "l.csv", "code;description\nZ00;Examen\n")
    assert [tuple(r) for r in files.code_lists(spark, str(tmp_path), {"one": "l.csv"}).collect()] == [("one", "Z00")]


def test_rule_file_keeps_the_last_entry(spark, tmp_path):
    write(
        tmp_path / "rules.yml",
        "regles:\n  - id: D1\n    clinical_coding_scenario: >\n      Premier\n    classification_profile_criteria:\n      primary_diagnosis: '!= Z'\n"
        "  - id: D1\n    clinical_coding_scenario: Second\n    classification_profile_criteria:\n      primary_diagnosis: Z\n",
    )
    row = files.rule_file(spark, str(tmp_path / "rules.yml")).collect()
    assert [(r["id"], r["text"], r["criteria"]) for r in row] == [("D1", "Second", {"primary_diagnosis": "Z"})]


def test_rule_files_of_a_folder_count_in_the_order_of_their_names(spark, tmp_path):
    field = V.RULE_FIELDS
    for name, texts in (("b.yml", ["later"]), ("a.yml", ["first", "second"])):
        rules = [{field["id"]: "D1", field["text"]: text, field["criteria"]: {}} for text in texts]
        (tmp_path / name).write_text(json.dumps({field["list"]: rules}))
    assert [r["text"] for r in files.rule_file(spark, str(tmp_path)).collect()] == ["later"]


def test_templates(spark, tmp_path):
    write(tmp_path / "a.txt", "Une\nDeux\n")
    write(tmp_path / "b.md", "non")
    assert [tuple(r) for r in files.templates(spark, str(tmp_path)).collect()] == [("a.txt", "Une\nDeux\n")]


def test_reports(spark, tmp_path):
    stays = spark.range(25).selectExpr("concat('g', id) AS generation_id", "concat('texte ', id) AS scenario")
    made = generate_reports(stays, lambda messages, model: f"{model}:{messages[0]['content']}:{messages[1]['content']}", "m", "sys")
    write_reports(made, str(tmp_path / "r"), 10)
    write_reports(made, str(tmp_path / "r"), 10)
    back = spark.read.parquet(str(tmp_path / "r"))
    assert back.count() == 50 and back.where("report = concat('m:sys:', scenario)").count() == 50
    assert back.selectExpr("_metadata.file_path AS f").groupBy("f").count().where("count > 10").isEmpty()
    with pytest.raises(ValueError, match="generation_id"):
        generate_reports(stays.drop("generation_id"), lambda m, n: "", "m", "sys")


def test_reports_run_in_several_tasks_see_the_row_and_resume(spark, tmp_path):
    stays = spark.range(40).coalesce(1).selectExpr("concat('g', id) AS generation_id", "concat('texte ', id) AS scenario", "id * 2 AS double_id")

    def told(messages, model, row):
        from pyspark import TaskContext

        return f"{TaskContext.get().partitionId()} {row['double_id']} {row['generation_id']}"

    rows = generate_reports(stays, told, "m", "sys", tasks=4, with_row=True).collect()
    assert len({r["report"].split()[0] for r in rows}) == 4
    assert all(r["report"].split()[1:] == [str(2 * int(r["generation_id"][1:])), r["generation_id"]] for r in rows)
    assert len({r["timestamp"] for r in rows}) > 4
    first = generate_reports(stays.limit(15), told, "m", "sys", with_row=True)
    write_reports(first, str(tmp_path / "out"))
    done = spark.read.parquet(str(tmp_path / "out"))
    write_reports(generate_reports(stays, told, "m", "sys", with_row=True, done=done), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("generation_id").count().where("count <> 1").isEmpty()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


RETRIED = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from casemill.plans.reports import REPORT_SCHEMA, generate_reports
from casemill.sources.report_sink import read_batches, write_batch

folder = {folder!r}
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
stays = spark.range(40).selectExpr("concat('g', id) AS generation_id", "concat('s', id) AS scenario")

def once(messages, model):
    name = messages[1]["content"]
    if name in ("s7", "s23") and not os.path.exists(f"{{folder}}/fell-{{name}}"):
        open(f"{{folder}}/fell-{{name}}", "w").close()
        raise RuntimeError("the task ends here, once")
    with open(f"{{folder}}/calls", "a") as out:
        out.write(name + chr(10))
    return "r" + name

made = generate_reports(stays, once, "m", "sys", journal=f"{{folder}}/journal")
write_batch(made, f"{{folder}}/out", "first", 7)
rows = read_batches(spark, f"{{folder}}/out", REPORT_SCHEMA).collect()
calls = open(f"{{folder}}/calls").read().split()
assert sorted(calls) == sorted(f"s{{i}}" for i in range(40)), calls
assert sorted(r["generation_id"] for r in rows) == sorted(f"g{{i}}" for i in range(40))
assert all(r["report"] == "r" + r["scenario"] and r["batch"] == "first" for r in rows)
print("held")
"""


def test_tasks_that_fail_call_once_and_leave_each_row_once(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    script = RETRIED.format(repo=str(Path(__file__).resolve().parent.parent), folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "held" in done.stdout, done.stderr[-2000:]


def test_a_failed_batch_shows_nothing_and_a_second_write_adds_nothing(spark, tmp_path):
    from casemill.sources.report_sink import read_batches, write_batch

    folder, schema = str(tmp_path / "out"), "id long"
    assert read_batches(spark, folder, schema).collect() == []
    with pytest.raises(Exception):
        write_batch(spark.range(20).selectExpr("IF(id = 13, raise_error('no'), id) AS id"), folder, "a")
    assert read_batches(spark, folder, schema).collect() == []
    for batch in ("a", "b-1.x", "a"):
        write_batch(spark.range(25).repartition(2), folder, batch, 10)
    rows = read_batches(spark, folder, schema).collect()
    assert sorted((r["batch"], r["id"]) for r in rows) == [(b, i) for b in ("a", "b-1.x") for i in range(25)]
    assert len(list((tmp_path / "out" / "data").glob("*/*.parquet"))) == sum(1 for p in (tmp_path / "out" / "batches").iterdir() for _ in open(p) if p.suffix == ".json")
    write_batch(spark.range(0), folder, "empty")
    assert read_batches(spark, folder, schema).count() == 50
    with pytest.raises(Exception, match="a batch needs a name"):
        write_batch(spark.range(1), folder, "a/b")


def test_a_journal_answers_the_same_question_only(spark, tmp_path):
    stays = spark.range(6).selectExpr("concat('g', id) AS generation_id", "concat('s', id) AS scenario")
    write = lambda text: generate_reports(stays, lambda m, n, text=text: text, "m", "sys", tasks=2, journal=str(tmp_path), journal_rows=2)
    assert {r["report"] for r in write("one").collect()} == {"one"}
    assert {r["report"] for r in write("two").collect()} == {"one"}  # every call's file is there
    other = generate_reports(stays, lambda m, n: "three", "m", "other", tasks=2, journal=str(tmp_path), journal_rows=2)
    assert {r["report"] for r in other.collect()} == {"three"}


def test_ingest_with_rescue_keeps_broken_rows_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / V.TABLE_FILES["dms"]).write_text("GHM5;DMS_P25;DMS_P50;DMS_P75\nG1;1;2;3\nG2;x;2;y\nG3;1\nG4;1;;3\nG5;1;2;3;4\n", encoding="latin-1")
    kept = registry.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["dms"], rescue=True)["dms"]
    assert sorted(r["GHM5"] for r in kept.collect()) == ["G1", "G4"]
    counts = registry.broken_rows(spark, str(tmp_path / "out")).collect()
    assert sorted((r["name"], r["reason"], r["n_rows"]) for r in counts) == [("dms", "DMS_P25", 1), ("dms", "DMS_P75", 1), ("dms", "fields", 2)]
    assert all(r["from_file"].endswith(V.TABLE_FILES["dms"]) for r in counts)
    assert registry.broken_rows(spark, str(tmp_path / "in")).collect() == []


def test_schema_of_the_first_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n1,1.5,x,\n-2,3,7,\n3.5,4,5,\n")
    text = files.csv(spark, str(tmp_path / "t.csv"))
    assert files.inferred_schema(text, 2) == "`a` bigint, `b` double, `c` string, `d` string"
    assert files.inferred_schema(text) == "`a` double, `b` double, `c` string, `d` string"


def test_batches_ask_the_writer_once_per_stay(spark, tmp_path, monkeypatch):
    from catalog import source_queries

    calls = str(tmp_path / "calls")

    def counted(messages: list[dict], model: str) -> str:
        with open(calls, "a") as file:
            file.write("x")
        return messages[1]["content"]

    rows = spark.range(40).selectExpr("md5(CAST(id AS STRING)) AS generation_id", "CONCAT('s', id) AS scenario")
    monkeypatch.setattr(source_queries.tabled, "short_text", lambda *at: rows)
    monkeypatch.setattr(source_queries, "stub_writer", counted)
    got = source_queries.sink_batches(spark, "none").collect()
    assert {(r["generation_id"], r["report"]) for r in got} == {tuple(r) for r in rows.collect()} and len(got) == 40
    assert {r["batch"] for r in got} == {"low", "high"} and os.path.getsize(calls) == 40
