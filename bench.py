"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs are written once before the clock starts, as a user's files would lie there. ``*_prepare`` builds
the position tables from them, ``*_draw`` draws one stay per order and its text.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from casemill.operators.draws import stay_ids  # noqa: E402
from casemill.plans import prompts, table_cohort  # noqa: E402
from catalog import operator_queries as ops, profile_queries as cases, table_queries as tabled  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "20g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    at = (spark, SF_DIR)
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.time()
        work()
        seconds[name] = round(time.time() - start, 3)

    tabled.tables(*at), cases.data(*at)
    rules = cases.rules(*at)
    ids = tabled.stay_ids(*at)
    n = ids.count()

    timed("table_cohort_prepare", lambda: tabled.prepared(*at))
    timed("table_cohort_draw", lambda: run(table_cohort.short_scenario(tabled.cohort_rows(*at))))
    million = stay_ids(spark, 1_000_000)
    timed("table_cohort_draw_1m", lambda: run(table_cohort.short_scenario(table_cohort.draw_prepared(tabled.prepared(*at), million, seed=1))))
    timed("profile_cohort_prepare", lambda: cases.prepared(*at))
    timed("profile_cohort_draw", lambda: run(prompts.long_scenario(cases.cohort_rows(*at), rules)))
    for name in ("weighted_with_replacement", "procedures", "associated"):
        timed(name, lambda: run(getattr(tabled, name)(*at)))
    for name in ("treatment", "diagnoses", "care"):
        timed(name, lambda: run(getattr(cases, name)(*at)))
    for name in ("procedure_cascade", "diagnosis_cascade", "draw_conditional_weighted", "draw_synonym", "type_secondary_codes"):
        timed(name, lambda: run(getattr(ops, name)(*at)))

    found = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "seconds of cohort preparation, draws and operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else SF_DIR,
                "stays": n,
                "table_stays_per_sec": round(n / seconds["table_cohort_draw"]),
                "table_stays_per_sec_1m": round(1_000_000 / seconds["table_cohort_draw_1m"]),
                "profile_stays_per_sec": round(n / seconds["profile_cohort_draw"]),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
