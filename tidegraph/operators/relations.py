"""Evidence rows to graded, canonical relations: gates, scores, flags and orientation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(rules: Sequence[tuple[str, Column]], kept: str = "kept") -> Column:
    """First rule that holds names the reason to drop the row; rows that none holds for are kept."""
    reason = F.lit(kept)
    for name, hit in reversed(list(rules)):
        reason = F.when(hit, name).otherwise(reason)
    return reason


def quality_score(confidence: Column, specificity: Column, bonuses: Sequence[tuple[Column, float]], digits: int = 3) -> Column:
    """0.55 confidence and 0.30 specificity, plus or minus signals, within 0 and 1."""
    total = 0.55 * confidence + 0.30 * specificity
    for hit, worth in bonuses:
        total = total + F.when(hit, worth).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), digits)


def flags(rules: dict[str, Column]) -> Column:
    """Sorted names of the rules that hold, joined by semicolons."""
    return F.concat_ws(";", *[F.when(rules[name], name) for name in sorted(rules)])


def orient(subject: Column, obj: Column, swap: Column) -> tuple[Column, Column]:
    """Source and target: endpoints change places where the relation's type says so."""
    return F.when(swap, obj).otherwise(subject), F.when(swap, subject).otherwise(obj)


def canonical_merge(df: DataFrame, keys: Sequence[str], confidence: Column, filing: Column, seen: Column, least: float) -> DataFrame:
    """One relationship per key: evidence, filings, dates, and whether several filings verify it."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("evidence"), F.countDistinct(filing).alias("filings"), F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"),
        ((F.countDistinct(filing) >= 2) & (F.min(confidence) >= least)).alias("verified"))


def alias_decision(candidates: Column, score: Column, accept: float, review: float) -> Column:
    return F.when((candidates == 1) & (score >= accept), "AUTO_ACCEPT").when(score >= review, "REVIEW").otherwise("KEEP_UNRESOLVED")
