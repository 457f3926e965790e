"""Connected components of a graph given as pairs, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemill.sources.scratch import written

ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``): the least node that is reachable, for every node of ``edges`` (``a``, ``b``: long).

    Every round a node takes the least label among its own and its neighbours', then the label of that label; labels
    fall along paths twice as far each time. The rounds' tables are written, so none depends on an executor."""
    both = written(edges.where("a != b").select("a", "b").unionByName(edges.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        lower = written(lower.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")), "labels")
        moved = lower.where("label < was").limit(1).count()
        labels = lower.select("node", "label")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")
