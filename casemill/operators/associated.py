"""Associated-diagnosis draws: five nested pools, each pick from the first pool that still has mass
once drawn codes and their categories are out.

The pools are nested, so the level of the j-th pick follows from category counts alone: it is the first
pool with at least j categories, and what an exhausted pool leaves taken in the next one is exactly its
own categories. Both are worked out per profile, before any stay is drawn; a pick is then one position
lookup per stay. Pools are never trimmed and no stay is joined to a whole pool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.text import display, parent_code
from casemill.functions.uniform import position_below, uniform, uniform_int
from casemill.operators.positions import (
    find,
    int_weight,
    lay_out,
    no_spans,
    pool_groups,
    pool_totals,
    salted,
    skip_taken,
    slotted,
    span,
    taken_length,
)
from casemill.sources.scratch import written

LEVELS = [
    ["GHM5", "AGE", "SEXE", "DP"],
    ["GHM5", "SEXE", "DP"],
    ["GHM5", "DP"],
    ["GHM5", "DP3"],
    ["GHM5"],
]
CATEGORY_LENGTH = 2
#: Keys of at most so many pools are sent to the executors, to find their rows; more are joined by sorting.
FEW_POOLS = 20_000


def pool_keys() -> Column:
    """The five pools a (GHM5, AGE, SEXE, DP) belongs to, each with the next coarser one. ``concat`` is
    null as soon as one part is null: such a pool matches nothing, as with equality."""
    names = [
        F.concat(F.lit(str(level)), *[p for c in key for p in (F.lit("|"), F.col(c).cast("string"))])
        for level, key in enumerate(LEVELS, start=1)
    ]
    pairs = [
        F.struct(F.lit(level).alias("level"), own.alias("pool"), wider.alias("wider"))
        for level, (own, wider) in enumerate(zip(names, [*names[1:], F.lit(None).cast("string")]), start=1)
    ]
    return F.array(*pairs)


def distinct_rows(das: DataFrame) -> DataFrame:
    """The weight of each distinct (GHM5, AGE, SEXE, DP, DAS)."""
    return (
        das.withColumn("w", int_weight(das, "P_DAS"))
        .where("w > 0 and DAS is not null")
        .groupBy("GHM5", "AGE", "SEXE", "DP", "DAS")
        .agg(F.sum("w").alias("w"))
        .withColumn("DP3", parent_code("DP"))
    )


def layered_rows(das: DataFrame) -> DataFrame:
    """Each distinct (GHM5, AGE, SEXE, DP, DAS) weight once per level it counts in."""
    return distinct_rows(das).select("DAS", "w", F.inline(pool_keys())).where("pool is not null")


def first_categories(base: DataFrame, n_das: int, category_length: int) -> list[DataFrame]:
    """For each level but the widest its keys with ``cats``: the pool's categories, of which ``n_das`` are enough. A level is
    gathered from the level before it, not from the rows again: a list that is full stays full, any other is complete."""
    parts = ["GHM5", "AGE", "SEXE", "DP", "DP3"]
    pairs = base.select(*parts, parent_code("DAS", category_length).alias("cat")).distinct()
    levels = [written(pairs.groupBy(*parts).agg(F.slice(F.collect_set("cat"), 1, n_das).alias("cats")), "first-categories")]
    for key in LEVELS[1:-1]:
        kept = key + ["DP3"] * ("DP" in key)
        cats = F.array_distinct(F.flatten(F.collect_list("cats")))
        levels.append(levels[-1].groupBy(*kept).agg(F.slice(cats, 1, n_das).alias("cats")))
    return levels


def entered_pools(base: DataFrame, profiles: DataFrame, n_das: int, category_length: int) -> list[DataFrame]:
    """For each level but the finest the keys of the pools that a plan of ``n_das`` picks may enter. A plan leaves a level
    only where the profile's pool there has fewer categories than picks, so few pools of wide levels are entered where
    the finest are rich; written, as they are read twice."""
    asked = profiles.withColumn("DP3", parent_code("DP"))
    entered = []
    for key, wider, found in zip(LEVELS, LEVELS[1:], first_categories(base, n_das, category_length)):
        known = found.select(*key, F.size("cats").alias("n_cats")).dropna(subset=key)
        kept = list(dict.fromkeys([*wider, *(["DP3"] if "DP" in wider else [])]))
        poor = asked.join(known.hint("merge"), key, "left").where(F.coalesce("n_cats", F.lit(0)) < n_das)
        asked = written(poor.select(*kept).distinct(), "entered-pools")
        entered.append(asked.select(*wider).dropna())
    return entered


def entered_rows(base: DataFrame, entered: list[DataFrame]) -> DataFrame:
    """``layered_rows`` of the distinct rows ``base`` with their number ``copies``, equal codes of a pool added up: all pools
    of the finest level, and of wider levels the pools in ``entered``. The keys of at most ``FEW_POOLS`` pools are sent whole."""

    def named(rows: DataFrame, level: int) -> DataFrame:
        pair = pool_keys()[level]
        return rows.select(pair["pool"].alias("pool"), pair["wider"].alias("wider"), "DAS", "w").where("pool is not null")

    wide = None
    for level, pools in enumerate(entered, start=1):
        few = pools.limit(FEW_POOLS + 1).count() <= FEW_POOLS
        met = base.join(F.broadcast(pools) if few else pools.hint("merge"), LEVELS[level], "left_semi")
        wide = named(met, level) if wide is None else wide.unionByName(named(met, level))
    wide = wide.groupBy("pool", "wider", "DAS").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("copies"))
    return named(base, 0).withColumn("copies", F.lit(1).cast("bigint")).unionByName(wide)


def das_positions(
    das: DataFrame, labels: DataFrame, category_length: int = CATEGORY_LENGTH, profiles: DataFrame | None = None, n_das: int = 0
) -> DataFrame:
    """Positions of every pool of every level, with the display text of each code. With ``profiles`` (GHM5, AGE, SEXE, DP) the
    pools that none of their plans of ``n_das`` picks can enter are left out."""
    if profiles is None:
        rows, copies, distinct = layered_rows(das), None, False
    else:
        base = written(distinct_rows(das), "das-rows")
        rows = entered_rows(base, entered_pools(base, profiles, n_das, category_length))
        copies, distinct = F.col("copies"), True
    positions = lay_out(
        rows,
        ["pool"],
        ["DAS"],
        F.col("w"),
        parent_code("DAS", category_length),
        copies,
        distinct=distinct,
        nomenclature=True,
        keep=("wider",),
    )
    active = labels.select(F.col("code").alias("DAS"), F.col("label").alias("das_label"))
    return positions.join(active, "DAS", "left").withColumn("shown", display("das_label", "DAS")).drop("das_label", "w")


def pool_facts(positions: DataFrame, n_das: int) -> DataFrame:
    """Per pool: mass, number of categories, and ``taken_in_wider``: the spans that its own categories
    occupy in the next pool. Only pools with fewer than ``n_das`` categories can be exhausted, so the
    list holds fewer than ``n_das`` spans."""
    groups = pool_groups(positions, ["pool"], "wider")
    wider = groups.select(
        F.col("pool").alias("wider"), "grp", F.col("g_lo").alias("wider_lo"), F.col("g_hi").alias("wider_hi")
    )
    taken = (
        groups.where((F.col("n_groups") < n_das) & F.col("wider").isNotNull())
        .select("pool", "wider", "grp")
        .join(wider.hint("merge"), ["wider", "grp"])
        .groupBy("pool")
        .agg(F.collect_list(span("wider_lo", "wider_hi")).alias("taken_in_wider"))
    )
    return pool_totals(positions, ["pool"]).drop("copies").join(taken.hint("merge"), "pool", "left")


def asked_pools(profiles: DataFrame) -> DataFrame:
    """pool, w, table_total: the pools of each profile of a laid-out table, with the profile's mass."""
    pools = profiles.withColumn("DP3", parent_code("DP")).select(F.inline(pool_keys()), "w", F.col("total").alias("table_total"))
    return pools.where("pool is not null")


def attach_das_plans(profiles: DataFrame, profile_key: str, positions: DataFrame, n_das: int, hot: DataFrame | None = None) -> DataFrame:
    """Add ``das_plans``: for pick 1..n_das the pool it comes from and the spans taken on entering it;
    picks beyond the last category of the widest pool are null."""
    facts = pool_facts(positions, n_das)
    facts = salted(facts, hot) if hot is not None else facts.withColumn("salts", F.lit(1))
    wanted = (
        profiles.withColumn("DP3", parent_code("DP"))
        .select(profile_key, F.inline(pool_keys()))
        .where("pool is not null")
        .drop("wider")
    )
    entry = F.struct("level", "pool", "total", "n_groups", "step", "salts", "taken_in_wider")
    levels = (
        wanted.join(facts.hint("merge"), "pool")
        .groupBy(profile_key)
        .agg(F.array_sort(F.collect_list(entry)).alias("levels"))
    )

    def plan(pick: int) -> Column:
        usable = F.get(F.filter("levels", lambda x: x["n_groups"] >= pick), F.lit(0))
        before = F.filter("levels", lambda x: x["n_groups"] < pick)
        entered = F.coalesce(F.get(before, F.size(before) - 1)["taken_in_wider"], no_spans())
        return F.struct(usable.alias("from"), entered.alias("taken"))

    plans = levels.select(profile_key, F.array(*[plan(j) for j in range(1, n_das + 1)]).alias("das_plans"))
    fields = ("level", "pool", "total", "step", "salts")
    slim = F.transform(
        "das_plans",
        lambda p: F.when(
            p["from"].isNotNull(), F.struct(*[p["from"][f].alias(f) for f in fields], p["taken"].alias("taken"))
        ),
    )
    return profiles.join(plans.withColumn("das_plans", slim).hint("merge"), profile_key, "left")


SLOT_COLUMNS = ["pool", "DAS", "shown", "lo", "hi", "g_lo", "g_hi", "step"]


def draw_associated(
    stays: DataFrame, id_col: str, positions: DataFrame, hot: DataFrame, n_das: int, seed: int, slots: DataFrame | None = None
) -> DataFrame:
    """Add ``DAS`` (displays) and ``DAS_CODE`` in draw order; ``das_plans`` is consumed. ``slots``: those of ``positions`` in
    buckets, which no pick shuffles; without them they are cut here, and shuffled by each pick."""
    slots = slotted(salted(positions.select(*SLOT_COLUMNS), hot)) if slots is None else slots
    out = stays.withColumn("das_wanted", uniform_int(uniform(seed, "das_count", id_col), 0, n_das))
    out = out.withColumn("das_plans", F.slice("das_plans", F.lit(1), F.col("das_wanted").cast("int")))  # the others are not shuffled
    for pick in range(1, n_das + 1):
        plan = F.get("das_plans", F.lit(pick - 1))
        taken = plan["taken"]
        if pick > 1:
            same_level = plan["level"] == F.get("das_plans", F.lit(pick - 2))["level"]
            grown = F.concat(F.col("das_taken"), F.array(span(f"das_lo_{pick - 1}", f"das_hi_{pick - 1}")))
            taken = F.when(same_level, grown).otherwise(taken)
        out = out.withColumn("das_taken", taken)
        left = plan["total"] - taken_length(F.col("das_taken"))
        short = F.when(F.col("das_wanted") >= pick, position_below(F.col("das_left"), seed, f"das_{pick}", id_col))
        out = out.withColumn("das_left", left).withColumn("das_at", short)
        out = find(
            out,
            slots,
            {"pool": plan["pool"]},
            skip_taken(F.col("das_at"), F.col("das_taken")),
            plan["step"],
            {
                f"das_code_{pick}": "DAS",
                f"das_shown_{pick}": "shown",
                f"das_lo_{pick}": "g_lo",
                f"das_hi_{pick}": "g_hi",
            },
            id_col,
            large=True,
            salts=plan["salts"],
        )
    picks = range(1, n_das + 1)

    def gathered(prefix: str) -> Column:
        return F.array_compact(F.array(*[F.col(f"{prefix}_{j}") for j in picks]))

    drop = [f"das_{part}_{j}" for part in ("code", "shown", "lo", "hi") for j in picks]
    return out.withColumns({"DAS": gathered("das_shown"), "DAS_CODE": gathered("das_code")}).drop(
        "das_plans", "das_wanted", "das_taken", "das_left", "das_at", *drop
    )
