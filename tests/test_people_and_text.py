from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from casemill.functions.text import first_letter_upper
from casemill.functions.uniform import uniform
from casemill.operators.people import age_in_class, calendar_positions, draw_day
from casemill.operators.stay_length import triangular_days
from casemill.plans.prompts import long_scenario_text
from casemill.plans.table_cohort import short_scenario
from catalog import profile_queries as cases

N = 8000


def test_age_classes(spark):
    classes = F.array(*[F.lit(c) for c in ("[30-40[", " [80-[ ", "x", None, "")])
    rows = spark.range(400).withColumn("cage", F.explode(classes))
    got = rows.select("cage", age_in_class(F.col("cage"), uniform(1, "a", "id", "cage")).alias("age")).collect()
    ages = {}
    for row in got:
        ages.setdefault(row["cage"], set()).add(row["age"])
    assert ages["[30-40["] == set(range(30, 41)) and ages[" [80-[ "] == set(range(80, 91))
    assert ages["x"] == ages[None] == ages[""] == {None}


def test_days_are_even_over_months_and_keep_to_weekdays(spark):
    ids = spark.range(N).withColumnRenamed("id", "stay_id").withColumn("weekday", F.col("stay_id") % 2 == 0)
    calendar = calendar_positions(spark, [2024])
    rows = draw_day(ids, "stay_id", calendar, F.lit(2024), F.col("weekday"), "day", "entry", 3).collect()
    assert all(r["day"].weekday() < 5 for r in rows if r["weekday"])
    free = Counter(r["day"].month for r in rows if not r["weekday"])
    n = sum(free.values())
    assert sum((c - n / 12) ** 2 / (n / 12) for c in free.values()) < 40
    assert {r["day"].year for r in rows} == {2024} and any(r["day"] == dt.date(2024, 2, 29) for r in rows)


def test_dates_of_drawn_stays(spark, sf):
    rows = cases.cohort_rows(spark, sf).collect()
    for r in rows:
        assert r["date_entry"] <= r["date_discharge"]
        if r["admission_type"] == "Outpatient":
            assert r["date_entry"] == r["date_discharge"]
        elif r["admission_mode"] != "URGENCES":
            assert r["date_entry"].weekday() < 5
        born = (r["date_entry"] - r["date_of_birth"]).days
        assert 365 * r["age"] <= born <= 365 * (r["age"] + 1)
        assert 2023 <= r["date_entry"].year <= 2025
        assert len(r["first_name"]) > 3 and len(r["last_name"]) > 3


def test_triangular_days(spark):
    shape = F.struct(F.lit(2.0).alias("left"), F.lit(4.0).alias("mode"), F.lit(9.0).alias("right"))
    days = spark.range(N).select(triangular_days(uniform(1, "d", "id"), shape).alias("d")).agg(F.min("d"), F.max("d"), F.avg("d")).first()
    assert days[0] >= 2 and days[1] <= 9 and abs(days[2] - 5.0) < 0.1


def test_first_letter_only(spark):
    row = spark.range(1).select(first_letter_upper(F.lit("jEAN-marc DUPONT")).alias("a"), first_letter_upper(F.lit("")).alias("b")).first()
    assert (row["a"], row["b"]) == ("Jean-marc dupont", "")


def test_short_scenario(spark):
    row = ("[40-65[", 1, "Groupe", "06C01", "Diabète", "E119", ["Acte (Q1)", "Q2"], [], 4)
    frame = spark.createDataFrame([row], "AGE string, SEXE int, GHM5 string, GHM5_CODE string, DP string, DP_CODE string, CCAM array<string>, DAS array<string>, DMS int")
    assert short_scenario(frame).first()["scenario"] == (
        "Patient : 1, [40-65[.\nGHM : Groupe (06C01).\nDiagnostic principal : Diabète (E119).\n"
        "Actes CCAM : Acte (Q1), Q2.\nDiagnostics associés : Aucun.\nDurée de séjour : 4 jours."
    )


FULL = {
    "age": 50, "sexe": 1, "date_entry": dt.date(2024, 3, 5), "date_discharge": dt.date(2024, 3, 7), "date_of_birth": dt.date(1974, 1, 2),
    "last_name": "Martin", "first_name": "Paul", "primary_is_cancer": True, "icd_primary_description": "Sein", "icd_primary_code": "C509",
    "histological_type": "Carcinome", "score_TNM": None, "cancer_stage": "Stade I", "biomarkers": None, "admission_mode": "DOMICILE",
    "discharge_disposition": None, "case_management_type": "DP", "situa": "Situation", "text_secondary_icd_official": "- HTA (I10)\n",
    "drg_parent_code": "09C04", "procedure": "QEFA", "text_procedure": "Mastectomie PARTIELLE", "first_name_med": "Anne", "last_name_med": "Roux",
    "department": "CHIRURGIE", "hospital": "Hôpital Nord", "treatment_recommandation": "Chirurgie", "chemotherapy_regimen": None,
}
SCHEMA = ", ".join(
    f"{name} {'int' if name in ('age', 'sexe') else 'date' if name.startswith('date') else 'boolean' if name == 'primary_is_cancer' else 'string'}"
    for name in FULL
)


def prompt(spark, rule: str = "Règle", **changes) -> str:
    frame = spark.createDataFrame([tuple({**FULL, **changes}.values())], SCHEMA)
    return frame.select(long_scenario_text(F.lit(rule)).alias("t")).first()["t"]


def test_long_scenario_of_a_cancer_stay(spark):
    assert prompt(spark) == (
        "**SCÉNARIO DE DÉPART :**\n- Âge du patient : 50 ans\n- Sexe du patient : Masculin\n- Date d'entrée : 05/03/2024\n"
        "- Date de sortie : 07/03/2024\n- Date de naissance : 02/01/1974\n- Nom du patient : Martin\n- Prénom du patient : Paul\n"
        "- Localisation anatomique de la tumeur primaire : Sein (C509)\n- Type anatomopathologique de la tumeur primaire : Carcinome\n"
        "- Score TNM : Si la notion de score de TNM est pertinente avec le type histologique et la localisation anatomique, vous choisirez un score TNM\n"
        "- Stade tumoral : Stade I\n- Biomarqueurs tumoraux : Vous choisirez des biomarqueurs tumoraux cohérents avec la localisation anatomique et "
        "l'histologie de la tumeur\n- Mode d'entrée' : DOMICILE\n- Contexte de l'hospitalisation : Situation. Règle\n- Codage CIM10 :\n"
        "   * Diagnostic principal : Sein (C509)\n   * Diagnostic associés : \n- HTA (I10)\n\n* Acte CCAM :\nmastectomie partielle\n"
        "- Nom du médecin / signataire : Anne Roux\n- Service : CHIRURGIE\n- Hôpital : Hôpital Nord\n"
        "Ce cas clinique concerne un patient présentant un cancer\nVous choisirez un épisode de traitement sachant que les recommandations pour ce "
        "stade du cancer sont les suivantes :\n   - Schéma thérapeutique : Chirurgie\n"
        "Veillez à bien préciser le type histologique et la valeur des biomarqueurs si recherchés\n"
    )


def test_long_scenario_leaves_missing_fields_out(spark):
    text = prompt(
        spark, "", primary_is_cancer=False, age=None, sexe=2, case_management_type=None, drg_parent_code="09M04", first_name_med=None,
        department=None, hospital=None, admission_mode=None, date_of_birth=None,
    )
    assert text == (
        "**SCÉNARIO DE DÉPART :**\n- Sexe du patient : Féminin\n- Date d'entrée : 05/03/2024\n- Date de sortie : 07/03/2024\n"
        "- Nom du patient : Martin\n- Prénom du patient : Paul\n"
    )
