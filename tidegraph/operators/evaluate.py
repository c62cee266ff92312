"""Scores, rates and resampling over prediction and label tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def precision_recall(df: DataFrame, gold: Column, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, precision, recall and F1, per group; 0 where nothing was predicted or expected."""
    counts = df.groupBy(*by).agg(
        F.count_if(gold & predicted).alias("tp"), F.count_if(~gold & predicted).alias("fp"), F.count_if(gold & ~predicted).alias("fn"))
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    both = counts.withColumn("precision", p).withColumn("recall", r)
    return both.withColumn("f1", F.when(F.col("tp") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0))


def multiset_overlap(gold: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Sizes of two multisets and of their intersection."""
    a = gold.groupBy(key).agg(F.count(F.lit(1)).alias("g"))
    b = predicted.groupBy(key).agg(F.count(F.lit(1)).alias("p"))
    both = a.join(b, key, "full")
    return both.agg(F.sum("g").alias("gold"), F.sum("p").alias("predicted"), F.sum(F.least(F.coalesce("g", F.lit(0)), F.coalesce("p", F.lit(0)))).alias("matched"))


def weighted_rate(df: DataFrame, stratum: str, weight: str, value: Column) -> DataFrame:
    """Strata means weighted by their sizes; null if a stratum has no value."""
    means = df.groupBy(stratum).agg(F.max(weight).alias("w"), F.avg(value).alias("m"), F.count(value).alias("n"))
    rate = F.when(F.min("n") > 0, F.sum(F.col("w") * F.col("m")) / F.sum("w"))
    return means.agg(rate.alias("rate"), F.count(F.lit(1)).alias("strata"))


def mcnemar(b: int, c: int) -> float:
    """Exact two-sided p of a paired comparison with b and c discordant cases."""
    from math import comb

    n = b + c
    return 1.0 if n == 0 else min(1.0, 2 * sum(comb(n, i) for i in range(min(b, c) + 1)) / 2**n)


def bootstrap(df: DataFrame, stratum: str, key: str, value: str, replicates: int, seed: int) -> DataFrame:
    """Means of stratified resamples: row weights per replicate are Poisson(1) counts from a hash,
    so that no row is collected and the result does not depend on partitions."""
    draws = df.select(stratum, key, value, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    u = F.pmod(F.xxhash64(key, "replicate", F.lit(seed)), F.lit(1_000_003)) / 1_000_003.0
    steps, total, term = [], 0.0, 0.36787944117144233
    for k in range(8):
        total += term
        steps.append(total)
        term /= k + 1
    weight = sum((F.when(u >= s, 1).otherwise(0) for s in steps), F.lit(0))
    sums = draws.withColumn("w", weight).groupBy("replicate", stratum).agg(F.sum(F.col("w") * F.col(value)).alias("x"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
    # a stratum that a replicate draws no row of does not count in it
    drawn = sums.where("w > 0")
    return drawn.groupBy("replicate").agg((F.sum(F.col("n") * F.col("x") / F.col("w")) / F.sum("n")).alias("rate"))


def issues(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row for each rule (code: severity, condition) that a record breaks."""
    found = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, (severity, hit) in rules.items()]))
    return df.select(key, F.explode(found).alias("x")).select(key, "x.code", "x.severity")
