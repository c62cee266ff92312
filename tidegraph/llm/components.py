"""Connected components by repeated contraction, for edge tables of any size and degree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegraph.llm.common import drop_scratch, materialise


def connected(edges: DataFrame) -> DataFrame:
    """node, root of every node of ``edges`` (a, b); the root is the component's smallest node.

    A round hangs every node below its smallest neighbour and replaces nodes by what they hang
    from; edges inside one node vanish, so a round at least halves the nodes that still have edges, and
    rounds go on until none has. Only pairs of nodes are shuffled, partly aggregated first, and nothing
    is collected but a flag. What a round wrote is deleted once the next has read it."""
    hung: list[DataFrame] = []
    left = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = materialise(left, "edges")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min("b").alias("low"))
        step = materialise(best.select(F.col("a").alias("node"), F.least("a", "low").alias("up")), "step")
        hung.append(step)
        first = left.join(step, left["a"] == step["node"]).select(F.col("up").alias("a"), "b")
        second = first.join(step, first["b"] == step["node"]).select("a", F.col("up").alias("b"))
        rest = second.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rest = materialise(rest, "edges")
        drop_scratch(left)
        left = rest
    if not hung:
        return edges.where(F.lit(False)).select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hung[-1].select("node", F.col("up").alias("root"))
    for step in reversed(hung[:-1]):
        above = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
        moved = step.join(above, step["up"] == above["__n"], "left").select("node", F.coalesce("__r", "up").alias("root"))
        roots = moved
    # a node hung below another in one round may hang further up in the next: settle until nothing moves
    roots = materialise(roots, "roots")
    for step in hung:
        drop_scratch(step)
    while True:
        above = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
        moved = roots.join(above, roots["root"] == above["__n"], "left").select(
            "node", F.least("root", F.coalesce("__r", "root")).alias("root"), (F.coalesce("__r", "root") != F.col("root")).alias("moved")
        )
        moved = materialise(moved, "roots")
        drop_scratch(roots)
        roots = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            break
    return roots
