"""Ages, dates and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions.text import first_letter_upper
from casemill.functions.uniform import position_below, uniform, uniform_int
from casemill.operators.positions import find, lay_out, pool_totals, slotted

CLOSED_CLASS, OPEN_CLASS, OLDEST = r"^\[(\d+)-(\d+)\[", r"^\[(\d+)-\[", 90
MONTH_MASS = 377580  # divisible by 28, 29, 30 and 31


def age_in_class(cage: Column, u: Column) -> Column:
    """Uniform age of a class such as ``[30-40[`` (both ends included) or ``[80-[`` (up to 90)."""
    cage = F.trim(cage)
    low = F.regexp_extract(cage, CLOSED_CLASS, 1).try_cast("bigint")
    high = F.regexp_extract(cage, CLOSED_CLASS, 2).try_cast("bigint")
    open_low = F.regexp_extract(cage, OPEN_CLASS, 1).try_cast("bigint")
    return F.coalesce(uniform_int(u, low, high), uniform_int(u, open_low, F.lit(OLDEST).cast("bigint"))).cast("int")


def calendar_positions(spark: SparkSession, years: list[int]) -> DataFrame:
    """Days of each year, all of them and weekdays only; every month has the same mass, shared by its days.
    The weekday pool carries the law of drawing a month, then a day, until a weekday comes up."""
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    few = spark.range(1).select(F.explode(F.array(*[F.lit(y) for y in sorted(set(years))])).alias("year"))
    days = few.select("year", F.explode(F.sequence(first, last)).alias("day"))
    flags = F.when(F.weekday("day") < 5, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(F.lit("0")))
    pools = days.withColumn("flag", F.explode(flags)).select(F.concat_ws("|", "year", "flag").alias("pool"), "day")
    mass = F.call_function("div", F.lit(MONTH_MASS).cast("bigint"), F.dayofmonth(F.last_day("day")).cast("bigint"))
    return lay_out(pools, ["pool"], ["day"], mass, F.month("day"), nomenclature=True)


def facts_list(positions: DataFrame) -> Column:
    """(pool, total, step) of all pools as one scalar, for tables with a handful of pools."""
    totals = pool_totals(positions, ["pool"])
    return totals.agg(F.collect_list(F.struct("pool", "total", "step")).alias("facts")).select("facts").scalar()


def draw_one(
    stays: DataFrame, id_col: str, positions: DataFrame, pool: Column, facts: str, take: dict[str, str], salt: str, seed: int
) -> DataFrame:
    """One item of the named pool per stay; ``facts`` is a list column from ``facts_list``. Filtering a list is not fused with the
    joins: a chain of lookups in one generated method would be too long for the JVM to compile, and be interpreted."""
    slots = slotted(positions.select(*dict.fromkeys(["pool", "lo", "hi", "step", *take.values()])))
    stays = stays.withColumn("one_pool", pool)
    stays = stays.withColumn("one_facts", F.get(F.filter(facts, lambda x: x["pool"] == F.col("one_pool")), F.lit(0)))
    at = position_below(F.col("one_facts")["total"], seed, salt, id_col)
    out = find(stays, slots, {"pool": F.col("one_pool")}, at, F.col("one_facts")["step"], take, id_col)
    return out.drop("one_pool", "one_facts")


def draw_year(years: list[int], seed: int, id_col: str) -> Column:
    choices = F.array(*[F.lit(y) for y in sorted(years)])
    return F.get(choices, uniform_int(uniform(seed, "year", id_col), 0, len(years) - 1).cast("int"))


def draw_day(stays: DataFrame, id_col: str, calendar: DataFrame, year: Column, weekdays_only: Column, out: str, salt: str, seed: int) -> DataFrame:
    stays = stays.withColumn("calendar_facts", facts_list(calendar))
    pool = F.concat_ws("|", year, F.when(weekdays_only, "1").otherwise("0"))
    return draw_one(stays, id_col, calendar, pool, "calendar_facts", {out: "day"}, salt, seed).drop("calendar_facts")


def stay_dates(stays: DataFrame, id_col: str, calendar: DataFrame, years: list[int], drawn_days: Column, seed: int) -> DataFrame:
    """Add ``date_entry, date_discharge``. Outpatients leave on the day they come, any weekday; others come
    on a weekday unless through the emergency room, and stay ``los`` days or, without one, the drawn days."""
    outpatient = F.coalesce(F.col("admission_type") == "Outpatient", F.lit(False))
    emergency = F.coalesce(F.col("admission_mode") == "URGENCES", F.lit(False))
    days = F.when(outpatient, 0).otherwise(F.coalesce(F.col("los"), drawn_days)).cast("int")
    year = draw_year(years, seed, id_col)
    out = draw_day(stays, id_col, calendar, year, ~outpatient & ~emergency, "date_entry", "entry", seed)
    return out.withColumn("date_discharge", F.date_add("date_entry", days))


def day_between(start: Column, end: Column, u: Column) -> Column:
    """Uniform day in [start, end]."""
    return F.date_add(start, F.floor(u * (F.datediff(end, start) + 1)).cast("int"))


def birth_date(entry: Column, age: Column, u: Column) -> Column:
    years = F.coalesce(age, F.lit(0)).cast("int")
    return day_between(F.date_sub(entry, 365 * (years + 1)), F.date_sub(entry, 365 * years), u)


def people_positions(names: DataFrame, hospitals: DataFrame) -> DataFrame:
    """First names by sex and last names, both longer than three letters, and hospitals; each row weighs one."""
    first = names.where(F.length("prenom") > 3).select(
        F.concat(F.lit("first|"), F.col("sexe").cast("string")).alias("pool"), first_letter_upper("prenom").alias("name")
    )
    last = names.where(F.length("nom") > 3).select(F.lit("last").alias("pool"), first_letter_upper("nom").alias("name"))
    places = hospitals.select(F.lit("hospital").alias("pool"), F.col("hospital").alias("name")).dropna()
    return lay_out(first.unionByName(last).unionByName(places), ["pool"], ["name"], F.lit(1).cast("bigint"))


def draw_people(stays: DataFrame, id_col: str, people: DataFrame, seed: int) -> DataFrame:
    """Patient by the stay's sex, physician of either sex, hospital."""
    physician_sex = uniform_int(uniform(seed, "physician_sex", id_col), 1, 2).cast("string")
    stays = stays.withColumn("people_facts", facts_list(people))
    wanted = {
        "first_name": F.concat(F.lit("first|"), F.col("sexe").cast("string")),
        "last_name": F.lit("last"),
        "first_name_med": F.concat(F.lit("first|"), physician_sex),
        "last_name_med": F.lit("last"),
        "hospital": F.lit("hospital"),
    }
    for name, pool in wanted.items():
        stays = draw_one(stays, id_col, people, pool, "people_facts", {name: "name"}, name, seed)
    return stays.drop("people_facts")
