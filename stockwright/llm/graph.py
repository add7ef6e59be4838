"""Connected components of an edge table, by the smallest label."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import held


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id that stands in an edge (a, b); the component is the smallest id in it.

    Each round takes the smallest label among an id's neighbours and then the label of that label, so labels travel twice as
    far every round. Sums by key combine in the map tasks, and a round's labels are a written table.
    """
    both = held(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = held(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    for _ in range(max_rounds):
        seen = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        near = labels.join(seen, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        new = held(near.join(jump, "component", "left").select("id", "old", F.least("component", "further").alias("component")), "labels")
        if new.where("old <> component").isEmpty():
            return new.select("id", "component")
        labels = new.select("id", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
