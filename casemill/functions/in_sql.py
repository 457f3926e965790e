"""The draw functions as SQL functions, for queries written in SQL.

``register(spark)`` defines them for the session, in temporary functions with bodies in SQL: Catalyst puts the bodies into
the plan, so they run inside generated code like the column functions they repeat, and give the same rows. Keys are texts;
several keys are one text with bars between them (``concat_ws('|', a, b)``), numbers are cast. A null key or seed is left out of
the hash as in ``functions.uniform``; a null size, bound, date or class gives null.

| Function | Like |
|---|---|
| ``casemill_uniform(seed, salt, key)`` | ``uniform`` |
| ``casemill_position(size, seed, salt, key)`` | ``position_below`` |
| ``casemill_whole(u, low, high)`` | ``uniform_int`` |
| ``casemill_age(class, u)`` | ``people.age_in_class`` |
| ``casemill_day(start, end, u)`` | ``people.day_between`` |
| ``casemill_days(left, mode, right, u)`` | ``stay_length.triangular_days`` |
| ``casemill_id(seed, key)`` | ``generation_id`` |
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from casemill.functions.uniform import GRID
from casemill.operators.people import CLOSED_CLASS, OLDEST, OPEN_CLASS

_HALF = 2**31 - 1


def _hash(salt: str, *, seed: str = "seed") -> str:
    return f"md5(concat_ws('|', concat({seed}, '|', {salt}), key))"


def _bits(digest: str, start: int, size: int) -> str:
    return f"CAST(conv(substring({digest}, {start}, {size}), 16, 10) AS BIGINT)"


def _position() -> str:
    """``position_below``: both halves of 60 hash bits times both halves of the size."""
    high, low = (f"shiftright({_bits(_hash('salt'), start, 8)}, 2)" for start in (1, 9))
    upper, lower = "shiftright(size, 31)", f"(size & {_HALF}L)"
    rest = f"{high} * {lower} + 2 * {low} * {upper} + shiftright({low} * {lower}, 30)"
    return f"CASE WHEN size > 0 THEN 2 * {high} * {upper} + shiftright({rest}, 30) END"


def _class(pattern: str, group: int) -> str:
    return f"TRY_CAST(regexp_extract(trim(class), r'{pattern}', {group}) AS BIGINT)"


def _age() -> str:
    closed = f"casemill_whole(u, {_class(CLOSED_CLASS, 1)}, {_class(CLOSED_CLASS, 2)})"
    return f"CAST(coalesce({closed}, casemill_whole(u, {_class(OPEN_CLASS, 1)}, {OLDEST}L)) AS INT)"


def _id() -> str:
    digest = _hash("'generation'")
    return "concat_ws('-', " + ", ".join(f"substring({digest}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


def _triangular() -> str:
    rising = "`left` + sqrt(u * (`right` - `left`) * (mode - `left`))"
    falling = "`right` - sqrt((1 - u) * (`right` - `left`) * (`right` - mode))"
    value = f"CASE WHEN u < (mode - `left`) / (`right` - `left`) THEN {rising} ELSE {falling} END"
    return f"CASE WHEN `left` IS NULL THEN 1 ELSE greatest(0, CAST(bround({value}, 0) AS INT)) END"


def definitions() -> dict[str, tuple[str, str, str]]:
    """Parameters, result and body of each function, in an order in which they can be defined."""
    return {
        "casemill_uniform": ("seed BIGINT, salt STRING, key STRING", "DOUBLE", f"({_bits(_hash('salt'), 1, 12)} + 0.5D) / {GRID:.0f}D"),
        "casemill_position": ("size BIGINT, seed BIGINT, salt STRING, key STRING", "BIGINT", _position()),
        "casemill_whole": ("u DOUBLE, low BIGINT, high BIGINT", "BIGINT", "CAST(floor(u * (high - low + 1)) + low AS BIGINT)"),
        "casemill_age": ("class STRING, u DOUBLE", "INT", _age()),
        "casemill_day": ("start DATE, `end` DATE, u DOUBLE", "DATE", "date_add(start, CAST(floor(u * (datediff(`end`, start) + 1)) AS INT))"),
        "casemill_days": ("`left` DOUBLE, mode DOUBLE, `right` DOUBLE, u DOUBLE", "INT", _triangular()),
        "casemill_id": ("seed BIGINT, key STRING", "STRING", _id()),
    }


def register(spark: SparkSession) -> None:
    """Define the functions for this session, anew if they are there."""
    for name, (parameters, result, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
