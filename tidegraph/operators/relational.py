"""Joins, aggregates, windows, sorts and set operations over any table and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def joined_set(c: str | Column, separator: str = ";") -> Column:
    """Sorted distinct values as one string."""
    return F.array_join(F.array_sort(F.collect_set(c)), separator)


def edge_aggregate(df: DataFrame, keys: Sequence[str], seen: Column, tag: Column) -> DataFrame:
    """One row per edge: first and last seen, evidence count, joined tags."""
    return df.groupBy(*keys).agg(
        F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"), F.count(F.lit(1)).alias("evidence_count"), joined_set(tag).alias("tags")
    )


def shared_objects(edges: DataFrame, obj: str, subject: str, count: str, kind: str, least: int = 2, show: int = 12) -> DataFrame:
    """Objects that several subjects depend on, with summed evidence and the first subjects."""
    return (
        edges.groupBy(obj)
        .agg(
            F.countDistinct(subject).alias("subjects"),
            F.sum(count).alias("evidence"),
            F.countDistinct(kind).alias("kinds"),
            F.array_join(F.slice(F.array_sort(F.collect_set(subject)), 1, show), ";").alias("first_subjects"),
        )
        .where(F.col("subjects") >= least)
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, to: str = "rank") -> DataFrame:
    """The first n rows of every group. ``order`` should be total."""
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(to) <= n)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Aggregates before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in key]
    ordered = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    return df.groupBy(*key).agg(F.min(ordered).alias("__m")).select(*key, *[F.col(f"__m.{c}") for c in rest])


def average_rank(df: DataFrame, group: Sequence[str], value: str, to: str) -> DataFrame:
    """Percentile in which ties share their mean place; a single row has 1, a null value 0."""
    part, ties = Window.partitionBy(*group, F.col(value).isNull()), Window.partitionBy(*group, value)
    n = F.count(F.lit(1)).over(part)
    place = F.rank().over(part.orderBy(value)) - 1 + (F.count(F.lit(1)).over(ties) - 1) / 2
    return df.withColumn(to, F.when(F.col(value).isNull(), 0.0).when(n == 1, 1.0).otherwise(place / (n - 1)))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], print_: str) -> DataFrame:
    """Keys added, removed or changed between two snapshots with a fingerprint column."""
    a = before.select(*keys, F.col(print_).alias("old"))
    b = after.select(*keys, F.col(print_).alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return a.join(b, list(keys), "full").withColumn("change", change).where(F.col("change").isNotNull())


def upsert(base: DataFrame, patch: DataFrame, key: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """Rows of both, with ``rules`` giving each value from ``base_*`` and ``patch_*`` columns."""
    a = base.select(*key, *[F.col(c).alias(f"base_{c}") for c in base.columns if c not in key])
    b = patch.select(*key, *[F.col(c).alias(f"patch_{c}") for c in patch.columns if c not in key])
    return a.join(b, list(key), "full").select(*key, *[rule.alias(c) for c, rule in rules.items()])


def insert_missing(base: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    return base.unionByName(new.join(base.select(*key).distinct(), list(key), "left_anti"))


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page in a total order; ``has_more`` tells whether another follows."""
    rows = df.orderBy(*order).offset(offset).limit(limit + 1)
    number = F.row_number().over(Window.orderBy(*order))
    more = F.count(F.lit(1)).over(Window.partitionBy())
    return rows.withColumn("__n", number).withColumn("has_more", more > limit).where(F.col("__n") <= limit).drop("__n")


def search(columns: Sequence[str], text: str) -> Column:
    """Case-insensitive substring in any of the columns."""
    found = F.lit(False)
    for c in columns:
        found = found | F.contains(F.lower(F.col(c)), F.lit(text.lower()))
    return found


def ranked_lookup(df: DataFrame, ranks: Sequence[Column]) -> DataFrame:
    """Rows at the best rank that any row reaches, and how many there are: more than one is ambiguous."""
    rank = F.lit(None).cast("int")
    for i, hit in reversed(list(enumerate(ranks))):
        rank = F.when(hit, F.lit(i)).otherwise(rank)
    rows = df.withColumn("match_rank", rank).where(F.col("match_rank").isNotNull())
    best = rows.groupBy("match_rank").agg(F.count(F.lit(1)).alias("candidates"))
    least = rows.agg(F.min("match_rank").alias("match_rank"))
    return rows.join(F.broadcast(best.join(least, "match_rank")), "match_rank")  # one row


def pairs_in_blocks(df: DataFrame, key: str, id_: str, largest: int) -> DataFrame:
    """Candidate links of ids that share a blocking key: all pairs of a block up to the size, and in a larger
    one a link from its smallest id to every other, so that no member is lost and no block is squared.

    ``complete`` tells which. The larger blocks' rows meet only an aggregate."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(id_).alias("left_id")).where("__n > 1")
    rows = df.select(key, id_).join(sizes, key)
    small = rows.where(F.col("__n") <= largest).select(key, id_)
    other = small.select(F.col(key).alias("__k"), F.col(id_).alias("right_id"))
    pairs = small.join(other, (F.col(key) == F.col("__k")) & (F.col(id_) < F.col("right_id"))).select(F.col(id_).alias("left_id"), "right_id", key, F.lit(True).alias("complete"))
    stars = rows.where((F.col("__n") > largest) & (F.col(id_) != F.col("left_id"))).select("left_id", F.col(id_).alias("right_id"), key, F.lit(False).alias("complete"))
    return pairs.unionByName(stars)


def set_compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of keys in both and in one only."""
    a, b = (d.select(key).distinct().withColumn(f"in_{n}", F.lit(1)) for d, n in ((left, "left"), (right, "right")))
    both = a.join(b, key, "full")
    return both.agg(
        F.count_if(F.col("in_left").isNotNull() & F.col("in_right").isNotNull()).alias("matched"),
        F.count_if(F.col("in_right").isNull()).alias("left_only"),
        F.count_if(F.col("in_left").isNull()).alias("right_only"),
    )


def stratified_sample(df: DataFrame, strata: Sequence[str], key: str, seed: str, size: int) -> DataFrame:
    """Hash-ordered sample, at least one of each stratum, seats by largest remainder."""
    counts = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy()  # over strata, which are few
    share = counts.withColumn("exact", F.col("n") * size / F.sum("n").over(one)).withColumn("floor", F.greatest(F.floor("exact"), F.lit(1)))
    order = Window.orderBy(F.desc(F.col("exact") - F.floor("exact")), *strata)
    spare = F.greatest(F.lit(size) - F.sum("floor").over(one), F.lit(0))
    seats = share.withColumn("seats", F.col("floor") + F.when(F.row_number().over(order) <= spare, 1).otherwise(0)).select(*strata, "seats")
    digest = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*strata).orderBy(digest, key)))
    return ranked.join(F.broadcast(seats), list(strata)).where(F.col("__r") <= F.col("seats")).drop("seats", "__r")
