"""Collection campaigns and reviews: admission, eligibility, grounding, verdicts, proposals and what came of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Who publishes for itself, what hints at a filing, hosts that never serve a whole call.
FIRST_PARTY = ("issuer", "investor_relations", "regulator")
FILING_HINTS = ("10-k", "10-q", "8-k", "annual report", "sec filing", "edgar")
BLOCKED_HOSTS = ("seekingalpha.com", "gurufocus.com", "fool.com")
# Spoken quarters, events that are searched for, and what shows questions in a transcript.
ORDINALS = {"Q1": "first", "Q2": "second", "Q3": "third", "Q4": "fourth"}
EVENTS = (
    "earnings call transcript", "earnings call", "results webcast", "results conference call", "financial results briefing", "investor update",
    "results announcement webcast", "analyst conference",
)
QUESTIONS = ("question-and-answer", "questions and answers", "q&a", "question", "analyst")
PDF_QUESTIONS = ("question-and-answer", "questions and answers", "q&a", "question:", "analyst")
RETRYABLE = (408, 409, 425, 429)


def _any(c: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in parts])


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]*)", 1)), r"^www\.", "")


def admission(url: Column, permitted: Column, provider: Column, kind: Column) -> Column:
    """Why a source may be processed, or may not."""
    odd = ~F.rlike(url, F.lit("^https?://[^/]+"))
    return (
        F.when(odd, "invalid_source_url").when(~permitted, "local_processing_not_permitted").when(provider == "sec_exhibits", "sec_exhibit")
        .when(kind.isin(*FIRST_PARTY), "first_party_source").when(kind == "configured", "configured_provider").otherwise("unapproved_source_kind")
    )


def search_queries(company: Column, year: int, quarter: str) -> Column:
    """Searches for one call, most general first: every event once, then every spelling of the period, then both."""
    spoken, short = ORDINALS[quarter], str(year)[-2:]
    quarters = (quarter, quarter.lower(), f"{spoken} quarter", f"{spoken}-quarter", f"{spoken} quarterly")
    years = (str(year), f"FY{short}", f"FY {short}", f"fiscal {year}", f"fiscal year {year}")
    asked = [(quarters[0], years[0], e) for e in EVENTS] + [(q, y, EVENTS[0]) for q in quarters for y in years]
    asked += [(q, y, e) for e in EVENTS[1:] for q in quarters for y in years]
    return F.array(*[F.concat(F.lit('"'), company, F.lit(f'" "{q}" "{y}" "{e}"')) for q, y, e in dict.fromkeys(asked)])


def blocked(name: Column, hosts: Sequence[str] = BLOCKED_HOSTS) -> Column:
    return reduce(lambda a, b: a | b, [(name == h) | name.endswith("." + h) for h in hosts])


def eligible(target: Column, confidence: Column, kind: Column, url: Column, shown: Column) -> Column:
    """A candidate worth fetching: judged the right call, sure enough, on an open host, and no filing."""
    return target & (confidence >= 0.70) & (kind != "other") & ~blocked(host(url)) & ~_any(F.lower(shown), FILING_HINTS)


def names_call(title: Column, company: Column, year: Column, quarter: Column) -> Column:
    """The title names the company, the period and an earnings call."""
    low, q = F.lower(title), F.lower(quarter)
    ordinal = F.create_map(*[F.lit(x) for k, v in ORDINALS.items() for x in (k.lower(), v)])[q]
    period = (F.contains(low, F.concat(q, F.lit(" "))) | F.contains(low, F.concat(ordinal, F.lit(" quarter")))) & F.contains(low, year.cast("string"))
    call = F.rlike(low, F.lit(r"\b(?:earnings|results)(?:\s+conference)?\s+call\b|\b(?:earnings|results)\s+webcast\b"))
    return period & call & F.contains(low, F.lower(company))


def period_conflict(title: Column, url: Column, year: int, quarter: str) -> Column:
    """Another year, or another quarter beside the right year, is named."""
    whole = F.lower(F.concat_ws(" ", title, url))
    years = F.regexp_extract_all(whole, F.lit(r"\b(20[0-9]{2})\b"), F.lit(1))
    others = [q.lower() for q in ORDINALS if q != quarter]
    return F.when((F.size(years) > 0) & ~F.array_contains(years, F.lit(str(year))), True).when(~F.contains(whole, F.lit(str(year))), False).otherwise(_any(whole, others))


def renderings(day: Column) -> Column:
    """Spellings under which a date may stand in a text, lower case."""
    n = F.dayofmonth(day)
    ordinal = F.when((n % 100).between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    shown = [F.date_format(day, f) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy")]
    return F.transform(F.array(*shown, F.concat(F.date_format(day, "MMMM d"), ordinal, F.date_format(day, ", yyyy"))), lambda x: F.lower(x))


def grounded_date(day: Column, text: Column) -> Column:
    """The date where the text shows it in some spelling, else null."""
    flat = F.lower(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.exists(renderings(day), lambda x: F.contains(flat, x)), day)


def complete(full: Column, period: Column, kind: Column, confidence: Column, source: Column, content: Column, text: Column, closings: Sequence[str], floor: float = 0.80) -> Column:
    """Whether a transcript is whole, by what bounds its source: a page needs a closing, a video length, questions
    and a closing, a paper length and questions."""
    low = F.lower(text)
    exact = full & period & (kind == "earnings_call") & (confidence >= floor)
    bounded = period & kind.isin("earnings_call", "partial_call") & (confidence >= floor) & (F.length(text) >= 7000)
    closed = _any(low, closings)
    return (
        F.when(source == "web", exact & closed).when((source == "youtube") & (content == "youtube_video"), exact | (bounded & _any(low, QUESTIONS) & closed))
        .when((source == "pdf") & (content == "official_transcript"), exact | (bounded & _any(low, PDF_QUESTIONS))).otherwise(exact)
    )


def error_class(kind: Column, status: Column) -> Column:
    """category and whether to try again."""
    made = lambda name, again: F.struct((name if isinstance(name, Column) else F.lit(name)).alias("category"), (again if isinstance(again, Column) else F.lit(again)).alias("retryable"))
    return (
        F.when(kind == "http", made(F.concat(F.lit("http_"), status.cast("string")), status.isin(*RETRYABLE) | (status >= 500)))
        .when(kind.isin("timeout", "connection", "os"), made("transient_infrastructure", True)).when(kind.isin("value", "type"), made("invalid_content", False))
        .when(kind == "schema", made("permanent", False)).otherwise(made("unexpected", True))
    )


def mapped(c: Column, table: Mapping[str, str], other: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c), F.lit(other))


def scan_plan(unfinished: Column, current: int, due: Column) -> Column:
    """year and mode of an issuer's next scan: the current year when it is due or nothing is left, else the latest unfinished one."""
    made = lambda year, mode: F.struct(year.cast("int").alias("year"), F.lit(mode).alias("mode"))
    now = made(F.lit(current), "incremental")
    return F.when(unfinished.isNull() | ((unfinished != current) & due), now).otherwise(made(unfinished, "backfill"))


def exclusions(source: Column, target: Column, status: Column, family: Column, form: Column, families: Sequence[str], forms: Sequence[str], candidates: bool) -> Column:
    """Why a relationship takes no part in an expansion; null where it does."""
    blank = (F.trim(source) == "") | (F.trim(target) == "") | (source == target)
    out = F.when(blank, "missing_endpoint").when(status == "rejected", "rejected")
    if not candidates:
        out = out.when(status != "accepted", "candidate")
    return out.when(~family.isin(*families), "relationship_family").when(~form.isin(*forms), "filing_form")


def corrections(relationships: DataFrame, audits: DataFrame) -> DataFrame:
    """Candidates with their ends swapped for the relationships that an audit found reversed; never accepted by themselves."""
    asked = audits.where("direction = 'reverse'").select(F.col("relationship_id").alias("direction_correction_of"), "reason").distinct()
    rows = relationships.join(asked, F.col("relationship_id") == F.col("direction_correction_of"))
    print_ = F.concat_ws("|", F.lit("direction-correction"), "target", "source", "relation_type", "modality")
    return rows.select(
        F.concat(F.lit("rel:"), F.substring(F.sha2(print_, 256), 1, 16)).alias("relationship_id"), F.col("target").alias("source"), F.col("source").alias("target"), "relation_type", "modality",
        F.lit("needs_review").alias("review_status"), "direction_correction_of", F.concat_ws(": ", F.lit("Reverse-direction candidate"), "reason").alias("decision_reason"))


def evidence_table(rows: DataFrame, group: str, claim: Sequence[str], quality: Sequence[Column], most: int) -> DataFrame:
    """Per group, the best row of every claim and then the best others, ``most`` in all."""
    best = F.row_number().over(Window.partitionBy(group, *claim).orderBy(*quality)) == 1
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.when(F.col("__best"), 0).otherwise(1), *quality))
    return rows.withColumn("__best", best).withColumn("place", place).where(F.col("place") <= most).withColumn("leads", F.col("__best")).drop("__best")


def mcnemar_p(b: Column, c: Column) -> Column:
    """Exact two-sided p of b against c discordant pairs: the binomial tail, term by term in logarithms."""
    n, m = (b + c).cast("double"), F.least(b, c).cast("int")
    start = F.struct(F.lit(0.0).alias("sum"), (-n * F.log(F.lit(2.0))).alias("term"))
    step = lambda s, i: F.struct((s["sum"] + F.exp(s["term"])).alias("sum"), (s["term"] + F.log((n - i) / (i + 1))).alias("term"))
    tail = F.aggregate(F.sequence(F.lit(0), m), start, step)["sum"]
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail))


def gold_counts(predicted: DataFrame, expected: DataFrame, forbidden: DataFrame, key: Sequence[str]) -> DataFrame:
    """matched, false positives, false negatives, forbidden hits and expected ones found the other way round; key is (source, target, ...)."""
    p, e, f = (x.select(*key).distinct() for x in (predicted, expected, forbidden))
    a, b = key[0], key[1]
    turned = p.select(F.col(a).alias(b), F.col(b).alias(a), *key[2:]).select(*key)
    tag = lambda df, name: df.withColumn("what", F.lit(name)).select("what")
    missed = e.join(p, list(key), "left_anti")
    parts = [tag(e.join(p, list(key), "left_semi"), "tp"), tag(p.join(e, list(key), "left_anti"), "fp"), tag(missed, "fn"), tag(f.join(p, list(key), "left_semi"), "forbidden"), tag(missed.join(turned, list(key), "left_semi"), "reversed")]
    one = reduce(DataFrame.unionByName, parts).agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("tp", "fp", "fn", "forbidden", "reversed")])
    precision = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    recall = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return one.withColumns({"precision": F.round(precision, 6), "recall": F.round(recall, 6)})


#: Extractors by name; each takes passages and gives (passage_id, kind, value) rows.
EXTRACTORS: dict[str, object] = {}


def extractor(name: str):
    """Decorator that files an extractor under a name."""

    def file(build):
        if name in EXTRACTORS:
            raise ValueError(f"extractor {name} is registered twice")
        EXTRACTORS[name] = build
        return build

    return file


def extracted(passages: DataFrame, names: Sequence[str]) -> DataFrame:
    """What the named extractors find, in one table."""
    unknown = [n for n in names if n not in EXTRACTORS]
    if unknown:
        raise KeyError(f"no extractor {unknown}; there are {sorted(EXTRACTORS)}")
    return reduce(DataFrame.unionByName, [EXTRACTORS[n](passages).select("passage_id", F.lit(n).alias("extractor"), "kind", "value") for n in names])


@extractor("years")
def _years(passages: DataFrame) -> DataFrame:
    return passages.select("passage_id", F.lit("year").alias("kind"), F.explode(F.regexp_extract_all("text", F.lit(r"\b((?:19|20)[0-9]{2})\b"), F.lit(1))).alias("value"))


@extractor("legal_names")
def _legal_names(passages: DataFrame) -> DataFrame:
    from tidegraph.functions.lexicon import LEGAL_NAME

    return passages.select("passage_id", F.lit("organization").alias("kind"), F.explode(F.regexp_extract_all("text", F.lit(LEGAL_NAME), F.lit(1))).alias("value"))
