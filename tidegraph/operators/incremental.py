"""Batch forms of the incremental operators: queues, retries, health, seen sets, soft deletion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def claimable(df: DataFrame, status: Column, next_at: Column, now: Column, order: Sequence[Column], n: int) -> DataFrame:
    """The next n rows of a queue: waiting, or due for another attempt."""
    return df.where((status == "queued") | ((status == "retry") & (next_at <= now))).orderBy(*order).limit(n)


def next_attempt(attempts: Column, failed_at: Column, base_minutes: int = 5, most: int = 6) -> Column:
    """When to try again: the wait doubles with each attempt; null when there are no more."""
    wait = F.make_dt_interval(mins=(F.lit(base_minutes) * F.pow(F.lit(2), F.least(attempts, F.lit(most)) - 1)).cast("int"))
    return F.when(attempts < most, failed_at + wait)


def health(errors: Column, total: Column, age_minutes: Column, stale: int, ratio: float) -> Column:
    """Status of a source from its counts: missing, stale, failing, degraded or healthy."""
    return (
        F.when(total == 0, "missing").when(age_minutes > stale, "stale").when(errors / total > 2 * ratio, "failing")
        .when(errors / total > ratio, "degraded").otherwise("healthy")
    )


def unseen(events: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Events whose key is not in the seen set, each once: at-least-once input becomes once."""
    return events.join(seen.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def newest_state(state: DataFrame, arrived: DataFrame, key: str, at: str, most: int) -> DataFrame:
    """Seen set after a batch: first arrivals are kept, the oldest beyond ``most`` leave."""
    both = state.select(key, at).unionByName(arrived.select(key, at)).groupBy(key).agg(F.min(at).alias(at))
    return both.orderBy(F.desc(at), key).limit(most)


def soft_delete(base: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Base and current keys with ``is_active``: gone keys stay inactive, returning ones are active."""
    a = base.select(key).distinct().withColumn("__a", F.lit(True))
    b = current.select(key).distinct().withColumn("__b", F.lit(True))
    return a.join(b, key, "full").select(key, F.col("__b").isNotNull().alias("is_active"), F.col("__a").isNull().alias("is_new"))


def window_floor(ts: Column, hours: int) -> Column:
    """Start of the window of so many hours since the epoch."""
    seconds = F.unix_timestamp(ts.cast("timestamp"))
    return F.timestamp_seconds(seconds - seconds % (3600 * hours))


def apply_budget(df: DataFrame, day: str, order: Sequence[Column], limit: int) -> DataFrame:
    """Whether each request fits the budget of its day, in order."""
    from pyspark.sql.window import Window

    return df.withColumn("granted", F.row_number().over(Window.partitionBy(day).orderBy(*order)) <= limit)
