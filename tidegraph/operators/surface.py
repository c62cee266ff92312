"""What a read surface asks of its tables: predicates from requests, masks, caps, merges and normal forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Legal forms at a name's end and what they stand for. Fixed values.
LEGAL_SUFFIXES = {
    "incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp", "company": "co", "co": "co", "limited": "ltd", "ltd": "ltd",
    "llc": "llc", "plc": "plc", "holdings": "holdings",
}
#: Markers of a corrected and of a shortened document, and the forms that a source uses for corrections. Fixed values.
AMENDED, SHORTENED = ("정정", "更正", "修订", "補足", "訂正"), ("摘要", "summary", "abstract")
AMENDED_FORMS = ("040", "070", "090", "130", "150", "170", "190")


def predicate(equal: Mapping[str, object], text: str | None = None, columns: Sequence[str] = ()) -> Column:
    """All given equalities, and the text somewhere in one of the columns; what is None asks for nothing."""
    parts = [F.col(c) == v for c, v in equal.items() if v is not None]
    if text:
        parts.append(reduce(lambda a, b: a | b, [F.ilike(F.col(c), F.lit(f"%{text}%")) for c in columns]))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def in_year(c: Column, year: int) -> Column:
    """The date lies in a year: as a range, which reaches the scan."""
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))


def watch(filters: Mapping[str, Sequence[object]]) -> Column:
    """Any of the lists holds its column's value; without lists, all rows."""
    parts = [F.col(c).isin(*v) for c, v in filters.items() if v]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(True)


def masked(df: DataFrame, hidden: Sequence[str]) -> DataFrame:
    return df.drop(*hidden)


def placeholder(c: Column, pattern: str, blocked: Sequence[str]) -> Column:
    """The value names nothing: it has the pattern of a placeholder or is on the list."""
    return F.rlike(F.lower(c), F.lit(pattern)) | F.lower(F.trim(c)).isin(*blocked)


def amended(source: Column, form: Column, title: Column) -> Column:
    form_, whole = F.lower(F.trim(form)), F.concat_ws(" ", form, title)
    marked = reduce(lambda a, b: a | b, [F.contains(whole, F.lit(m)) for m in AMENDED])
    return F.when(source == "sec_edgar", form_.endswith("/a")).when(source == "edinet", form_.isin(*AMENDED_FORMS)).otherwise(marked)


def shortened(title: Column) -> Column:
    flat = F.lower(F.regexp_replace(title, r"\s+", ""))
    return reduce(lambda a, b: a | b, [F.contains(flat, F.lit(m)) for m in SHORTENED])


def capped(df: DataFrame, group: Sequence[str], primary: Column, order: Sequence[Column], most: int) -> DataFrame:
    """Primary rows, and the first ``most`` others of each group."""
    place = F.row_number().over(Window.partitionBy(*group, "__p").orderBy(*order))
    return df.withColumn("__p", primary).withColumn("__r", place).where(F.col("__p") | (F.col("__r") <= most)).drop("__p", "__r")


def ordered_union(*lists: Column) -> Column:
    """Values of all lists once each, in the order in which they first come."""
    return F.array_distinct(F.concat(*lists))


def report_year(report: Column, title: Column, filed: Column, year: int) -> Column:
    """The report's year is the asked one; without it the title's first year, then the filing's year or the one before."""
    named = F.regexp_extract(title, r"(?:^|[^0-9])(20[0-9]{2})(?:[^0-9]|$)", 1)
    own = F.coalesce(F.year(report), F.nullif(named, F.lit("")).cast("int"))
    return F.when(own.isNotNull(), own == year).otherwise(F.year(filed).isin(year, year + 1))


def number(c: Column) -> Column:
    """First number of a text; parentheses around all of it mean negative, a percent sign hundredths."""
    flat = F.replace(F.lower(F.trim(c)), F.lit(","), F.lit(""))
    found = F.nullif(F.regexp_extract(flat, r"([-+]?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).cast("double")
    signed = F.when(flat.startswith("(") & flat.endswith(")"), -F.abs(found)).otherwise(found)
    return F.when(F.contains(flat, F.lit("%")), signed / 100).otherwise(signed)


def token_f1(a: Column, b: Column) -> Column:
    """F1 of two texts' words as multisets."""
    x, y = F.filter(F.split(a, " "), lambda w: w != ""), F.filter(F.split(b, " "), lambda w: w != "")
    times = lambda xs, w: F.size(F.filter(xs, lambda v: v == w))
    common = F.aggregate(F.array_distinct(x), F.lit(0), lambda s, w: s + F.least(times(x, w), times(y, w)))
    p, r = common / F.size(y), common / F.size(x)
    return F.when((F.size(x) == 0) | (F.size(y) == 0) | (common == 0), 0.0).otherwise(2 * p * r / (p + r))


def answers_agree(gold: Column, said: Column) -> Column:
    """Numbers within a thousandth or a hundred-thousandth of the gold one; other answers by their words."""
    g, s = number(gold), number(said)
    flat = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    close = F.abs(g - s) <= F.greatest(F.lit(0.001), F.abs(g) * 0.00001)
    words = (flat(gold) == flat(said)) | (token_f1(flat(gold), flat(said)) >= 0.72)
    return F.when(said.isNull(), False).when(g.isNotNull() & s.isNotNull(), close).otherwise(words)


def confidence_band(c: Column) -> Column:
    return F.when(c >= 0.95, "very_high").when(c >= 0.86, "high").when(c >= 0.72, "medium").when(c > 0, "low").otherwise("none")


def identity_issue(assets: Column, liabilities: Column, equity: Column) -> Column:
    """Severity where assets aren't liabilities and equity, within 5 %; null where they are or something is missing."""
    off = F.abs(assets - liabilities - equity) / F.abs(assets)
    return F.when(assets.isNull() | liabilities.isNull() | equity.isNull() | (assets == 0), None).when(off > 0.5, "error").when(off > 0.05, "warning")


def json_merged(base: Column, patch: Column) -> Column:
    """Flat JSON objects as one map; the patch's values win."""
    a, b = F.from_json(base, "map<string,string>"), F.from_json(patch, "map<string,string>")
    kept = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(b))))


def json_salvaged(c: Column) -> Column:
    """The complete flat objects in a text around which a fence, prose or a broken tail may stand."""
    return F.regexp_extract_all(c, F.lit(r"(\{[^{}]*\})"), F.lit(1))


def merge_tokens(c: Column) -> Column:
    """Words of a name for merging: a footnote's number at the end dropped, "and" for &."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), r"\(\s*[0-9]+\s*\)?\s*$", ""), r"\s+[0-9]+\s*$", "")
    flat = F.regexp_replace(F.replace(F.lower(bare), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(flat, " +", " "))


_FORMS = "|".join(LEGAL_SUFFIXES)


def suffixless(key: Column) -> Column:
    return F.regexp_replace(key, f"(?:(?:^| )(?:{_FORMS}))+$", "")


def suffix_signature(key: Column) -> Column:
    """Legal forms at the end in their short spelling."""
    tail = F.filter(F.split(F.trim(F.regexp_extract(key, f"((?:(?:^| )(?:{_FORMS}))+)$", 1)), " "), lambda w: w != "")
    short = F.create_map(*[F.lit(x) for pair in LEGAL_SUFFIXES.items() for x in pair])
    return F.array_join(F.transform(tail, lambda w: F.try_element_at(short, w)), " ")


def acronym_of(name: Column, short: Column) -> Column:
    """``short`` is the first letters of the name's words, three at least and without a blank."""
    first = F.array_join(F.transform(F.filter(F.split(name, " "), lambda w: w != ""), lambda w: F.substring(w, 1, 1)), "")
    return (F.length(short) >= 3) & ~F.contains(short, F.lit(" ")) & (first == short)


def may_merge(left: Column, right: Column) -> Column:
    """Two names may be one: equal as spelled, equal without legal forms that agree, or one the other's acronym."""
    a, b = merge_tokens(left), merge_tokens(right)
    x, y = suffixless(a), suffixless(b)
    same = (x == y) & (suffix_signature(a) == suffix_signature(b))
    return (a != "") & (b != "") & ((a == b) | ((x != "") & (y != "") & (same | acronym_of(x, y) | acronym_of(y, x))))


def normalised_object(c: Column, key: Column, generic: Sequence[str], aliases: Mapping[str, str], places: Sequence[str], classes: Mapping[str, str]) -> Column:
    """name, kind and specificity: a generic phrase, an alias, a place, an organisation, a class, or unknown."""
    made = lambda name, kind, sure: F.struct(name.alias("name"), F.lit(kind).alias("kind"), F.lit(sure).alias("specificity"))
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    out = made(c, "unknown", 0.4)
    for pattern, kind in reversed(list(classes.items())):
        out = F.when(F.rlike(key, F.lit(pattern)), made(c, kind, 0.5)).otherwise(out)
    named = F.rlike(c, F.lit(r"\b(?:Inc|Corp|Ltd|Limited|LLC|plc)\.?$"))
    return (
        F.when(key.isin(*generic), made(c, "generic", 0.1)).when(F.map_contains_key(table, key), made(F.try_element_at(table, key), "company", 1.0))
        .when(key.isin(*places), made(c, "geography", 0.7)).when(named, made(c, "organization", 0.8)).otherwise(out)
    )


def first_rule(rules: Sequence[tuple[Column, str]], other: str) -> Column:
    """Name of the first condition that holds."""
    out = F.lit(other)
    for hit, name in reversed(list(rules)):
        out = F.when(hit, name).otherwise(out)
    return out


def collisions(df: DataFrame, key: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """Keys whose rows disagree on who they are, with the number of identities."""
    return df.groupBy(*key).agg(F.countDistinct(F.struct(*identity)).alias("identities")).where("identities > 1")
