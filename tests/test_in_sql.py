"""The SQL functions give what the column functions give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casemill.functions import in_sql
from casemill.functions.uniform import generation_id, position_below, uniform, uniform_int
from casemill.operators.people import age_in_class, day_between
from casemill.operators.stay_length import triangular_days


@pytest.fixture(scope="module")
def rows(spark):
    in_sql.register(spark)
    in_sql.register(spark)
    size = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in (0, 1, 7, 2**31 - 1, 2**31, 2**61 + 12345, None)]), (F.col("id") % 7 + 1).cast("int"))
    cage = F.element_at(F.array(*map(F.lit, ["[0-1[", "[30-40[", " [80-[", "[90-100]", "odd", None])), (F.col("id") % 6 + 1).cast("int"))
    shape = F.when(F.col("id") % 5 > 0, F.struct((F.col("id") % 5).cast("double").alias("left"), (F.col("id") % 5 + 2).cast("double").alias("mode"), (F.col("id") % 5 + 9).cast("double").alias("right")))
    frame = spark.range(3000).select("id", F.when(F.col("id") % 11 > 0, F.col("id").cast("string")).alias("k"), size.alias("size"), cage.alias("cage"), shape.alias("shape"))
    return frame.withColumns({"u": uniform(4, "u", "k"), "a": F.date_add(F.lit("2024-01-31").cast("date"), (F.col("id") % 9).cast("int"))})


@pytest.mark.parametrize(
    "column, sql",
    [
        (lambda: uniform(9, "x", "k"), "casemill_uniform(9, 'x', k)"),
        (lambda: uniform(9, "x", "k", "id"), "casemill_uniform(9, 'x', concat_ws('|', k, id))"),
        (lambda: position_below(F.col("size"), 9, "x", "k"), "casemill_position(size, 9, 'x', k)"),
        (lambda: uniform_int(F.col("u"), 3, 11), "casemill_whole(u, 3, 11)"),
        (lambda: age_in_class(F.col("cage"), F.col("u")), "casemill_age(cage, u)"),
        (lambda: day_between(F.col("a"), F.lit("2024-03-01").cast("date"), F.col("u")), "casemill_day(a, DATE '2024-03-01', u)"),
        (lambda: triangular_days(F.col("u"), F.col("shape")), "casemill_days(shape.left, shape.mode, shape.right, u)"),
        (lambda: generation_id(9, "k", "id"), "casemill_id(9, concat_ws('|', k, id))"),
    ],
)
def test_same_rows_and_types(rows, column, sql):
    both = rows.select(column().alias("column"), F.expr(sql).alias("sql"))
    assert both.schema["column"].dataType == both.schema["sql"].dataType
    assert both.where(~F.col("column").eqNullSafe(F.col("sql"))).count() == 0
    assert both.where("column is not null").count() > 1000


def test_bodies_run_in_generated_code(rows):
    plan = rows.select(F.expr("casemill_position(size, 9, 'x', k)"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "shiftright" in plan
