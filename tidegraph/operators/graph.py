"""Graph operators on edge and node tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node of its component, for edges (a, b): labels spread and jump.

    Each round a node takes the smallest label around it, then its label's label, until none changes;
    checkpoints cut the lineage, and only a flag comes to the driver."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = checkpointed(both)
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node")
    labels = checkpointed(labels)
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("low"))
        step = labels.join(around, labels["node"] == around["a"], "left").select("node", "root", F.least("root", "low").alias("next"))
        up = step.select(F.col("node").alias("__n"), F.col("next").alias("__r"))
        jumped = step.join(up, step["next"] == up["__n"], "left").select("node", "root", F.least("next", "__r").alias("next"))
        jumped = checkpointed(jumped)
        labels = jumped.select("node", F.col("next").alias("root"))
        if jumped.where(F.col("next") < F.col("root")).isEmpty():
            break
    return labels


def expand(edges: DataFrame, seeds: DataFrame, hops: int, cap: int | None, rank: list[Column]) -> DataFrame:
    """Nodes within ``hops`` of the seeds over undirected edges (a, b, ...), at most ``cap`` of them (None: all).

    Each hop takes every new neighbour by its best edge in ``rank``, and the best of them up to the cap."""
    rest = [c for c in edges.columns if c not in ("a", "b")]
    both = edges.select("a", "b", *rest).unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), *rest))
    found = seeds.select("node", F.lit(0).alias("depth"), F.lit(None).cast(dict(seeds.dtypes)["node"]).alias("parent"))
    frontier, room = found, None if cap is None else cap - seeds.count()
    for hop in range(1, hops + 1):
        if room is not None and room <= 0:
            break
        near = both.join(frontier.select(F.col("node").alias("a")), "a").join(found.select(F.col("node").alias("b")), "b", "left_anti")
        best = near.withColumn("__r", F.row_number().over(Window.partitionBy("b").orderBy(*rank, "a"))).where("__r = 1")
        best = best if room is None else best.orderBy(*rank, "a", "b").limit(room)
        frontier = checkpointed(best.select(F.col("b").alias("node"), F.lit(hop).alias("depth"), F.col("a").alias("parent")))
        room = None if room is None else room - frontier.count()
        found = found.unionByName(frontier)
    return found


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    a, b = nodes.select(F.col("node").alias("a")), nodes.select(F.col("node").alias("b"))
    return edges.join(a, "a", "left_semi").join(b, "b", "left_semi")


def node_metrics(edges: DataFrame, weight: str) -> DataFrame:
    """Degree, in- and out-degree and summed weight of every node."""
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("other"), F.lit(1).alias("o"), F.lit(0).alias("i"), weight)
    inn = edges.select(F.col("b").alias("node"), F.col("a").alias("other"), F.lit(0).alias("o"), F.lit(1).alias("i"), weight)
    return out.unionByName(inn).groupBy("node").agg(
        F.countDistinct("other").alias("degree"), F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum(weight).alias("weight"))
