"""Connected components of a link table, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.runtime import discard, materialize


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(id, component) of every id in links, component the smallest id reachable.

    Each round takes the smallest label of the neighbours (aggregated before the shuffle) and then jumps to the
    label's label, so chains of length d need about log2 d rounds. Rounds are written to the shared folder.
    Null ends are ignored; no links give an empty table. Raises if the rounds did not suffice.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = materialize(spark, ends.union(ends.select("y", "x")).distinct(), "edges")
    labels = materialize(spark, edges.groupBy(F.col("x").alias("id")).agg(F.least(F.min("y"), F.first("x")).alias("component")), "labels")
    for _ in range(rounds):
        near = edges.join(labels, F.col("y") == F.col("id")).groupBy("x").agg(F.min("component").alias("near"))
        best = labels.join(near, F.col("id") == F.col("x"), "left").select("id", "component", F.least("component", F.coalesce("near", "component")).alias("best"))
        up = labels.select(F.col("id").alias("up"), F.col("component").alias("above"))
        jumped = best.join(up, F.col("best") == F.col("up"), "left").select("id", F.least("best", F.coalesce("above", "best")).alias("component"), (F.least("best", F.coalesce("above", "best")) != F.col("component")).alias("moved"))
        after = materialize(spark, jumped, "labels")
        done = after.where("moved").isEmpty()
        discard(spark, labels)
        labels = after.select("id", "component")
        labels.shared_path = after.shared_path
        if done:
            discard(spark, edges)
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
