"""Connected components by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.operators.joins import hot_keys, keyed_join
from concordat.storage import drop, materialize


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component), where component is the smallest node reachable.

    Only nodes that occur in an edge between two different non-null nodes are
    returned; isolated nodes are their own component and left to the caller.
    Repeated edges and self-loops do no harm. Nodes may be of any orderable
    type. A hub's edges and the many nodes that carry its label are spread over
    all partitions. Each round is written to the shared folder, so recovery
    never replays earlier rounds, and what it read is deleted. Stops when no
    label changed; raises if that takes over ``max_rounds``.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    e = materialize(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    hubs = hot_keys(e, ["v"])
    labels = materialize(e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("l")), "cc-labels")
    for _ in range(max_rounds):
        # A node takes the least of its own label, its label's label and its neighbours' labels; the node that it pointed to learns that too.
        seen = keyed_join(e, labels.withColumnRenamed("u", "v"), ["v"], "u", hot=hubs).groupBy("u").agg(F.min("l").alias("n"))
        up = labels.select(F.col("u").alias("l"), F.col("l").alias("g"))
        near = keyed_join(labels, up, ["l"], "u").join(seen, "u").select("u", "l", F.least("l", "n", "g").alias("n"))
        hooks = near.where("n < l").select(F.col("l").alias("u"), "n").groupBy("u").agg(F.min("n").alias("k"))
        new = materialize(near.join(hooks, "u", "left").select("u", F.least("n", F.coalesce("k", "n")).alias("m"), "l"), "cc-round")
        changed = new.where("m < l").limit(1).count()
        drop(spark, labels)
        labels = new.select("u", F.col("m").alias("l"))
        if not changed:
            drop(spark, e)
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

