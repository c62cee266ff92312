"""Inline-XBRL facts from a page's markup, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, f'(?i)\\b{name}="([^"]*)"', 1)


def contexts(html: Column) -> Column:
    """id, start, stop, instant and whether it has dimensions, of every context."""
    child = lambda x, name: F.regexp_extract(x, f"(?i)<[a-z]*:?{name}>\\s*([^<]*?)\\s*</", 1)
    made = lambda x: F.struct(
        attribute(x, "id").alias("id"), child(x, "startDate").alias("start"), child(x, "endDate").alias("stop"), child(x, "instant").alias("instant"),
        F.rlike(x, F.lit("(?i)<[a-z]*:?(?:segment|scenario|explicitMember|typedMember)")).alias("dimensions"))
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)(<[a-z]*:?context\b.*?</[a-z]*:?context>)"), F.lit(1)), made)


def value(text: Column, scale: Column, sign: Column) -> Column:
    """A fact's number: separators dropped, parentheses or a minus sign for negative, powers of ten applied; null if none."""
    raw = F.trim(text)
    bare = F.regexp_replace(raw, "[^0-9.+-]", "").try_cast("decimal(30,4)").cast("double")
    shifted = bare * F.pow(F.lit(10.0), F.coalesce(F.nullif(scale, F.lit("")).try_cast("int"), F.lit(0)))
    negative = (raw.startswith("(") & raw.endswith(")")) | (sign == "-")
    return F.when(negative, -F.abs(shifted)).otherwise(shifted)


def facts(html: Column) -> Column:
    """concept, context, unit, id and value of every numeric fact."""
    made = lambda x: F.struct(
        F.regexp_replace(attribute(x, "name"), "^.*:", "").alias("concept"), attribute(x, "contextRef").alias("context"), attribute(x, "unitRef").alias("unit"),
        attribute(x, "id").alias("id"), value(F.regexp_extract(x, "(?s)>([^<]*)<", 1), attribute(x, "scale"), attribute(x, "sign")).alias("value"))
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)(<ix:nonFraction\b[^>]*>[^<]*</ix:nonFraction>)"), F.lit(1)), made)


def score(period: Column, start: Column, stop: Column, instant: Column, unit: Column, target: Column) -> Column:
    """How well a fact without dimensions fits: its end near the target, its kind of period, its unit."""
    end = F.coalesce(F.nullif(stop, F.lit("")), instant).try_cast("date")
    off = F.abs(F.datediff(end, target))
    near = F.when(off <= 7, 8).when(off <= 45, 4).otherwise(0)
    days = F.datediff(stop.try_cast("date"), start.try_cast("date"))
    length = F.when(days.between(300, 430), 6).when(days.between(80, 100), 2).otherwise(0)
    kind = F.when((period == "instant") & (instant != ""), 5).when((period == "duration") & (start != "") & (stop != ""), length).otherwise(0)
    return F.lit(8) + F.coalesce(near, F.lit(0)) + kind + F.when(F.upper(unit).contains("USD"), 3).otherwise(0)
