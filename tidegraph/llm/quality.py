"""Quality rules as learned decision lists, in DataFrame operations only.

:func:`statistics` computes the statistics of each text. :func:`learn` covers the labelled bad
documents one rule at a time: a rule grows threshold by threshold on two thirds of the labelled
rows, is pruned on the rest, and is kept while it is precise there. The list becomes one ordered
``CASE WHEN`` expression.

Defined cases: a null or empty text has no words, all statistics 0 and fails the base rule.
A null label is no label. Without labels the list is empty and the base rule alone decides.
Repeated rows are each judged; other columns pass through."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import SPACE, documents, materialise

#: Base thresholds, fixed by the contract.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Learning: candidate cuts per statistic, rules in the list, conditions in a rule, the share of
#: bad rows among those a rule covers, in both parts, and the rows it must cover to be kept.
CUTS, MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, MIN_COVER = 24, 8, 3, 0.9, 5
#: Statistics that rules may test; all are ratios, so they mean the same for every length.
FEATURES = (
    "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "mean_word_chars",
    "upper_ratio", "digit_ratio", "punctuation_ratio", "pipe_ratio", "words_per_line",
)
SYMBOLS = "#*$%&|<>"
_MADE = {
    *FEATURES, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_distinct", "n_chars_all", "n_upper",
    "n_digits", "n_punctuation", "n_pipes", "n_repeat_words", "base_failed", "rule", "kept",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= F.lit(self.cut) if self.at_least else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document with counts and ratios; ``keep`` names the columns to carry (all by default).

    Repeated three-word windows are found without comparing all pairs: window hashes are sorted
    with their positions, equal neighbours are the repeated ones, and the words they cover are
    added up in position order. Work grows as n log n with a text's length."""
    keep = df.columns if keep is None else keep
    body = F.coalesce(F.col(text), F.lit(""))
    edges = F.regexp_replace(body, rf"^{SPACE}+|{SPACE}+$", "")
    one = df.select(*keep, body.alias("__t"), edges.alias("__e"))
    two = one.select(
        *keep,
        "__t",
        F.when(F.col("__e") == "", F.array().cast("array<string>")).otherwise(F.split("__e", rf"{SPACE}+")).alias("__w"),
        F.filter(F.split("__t", "\n"), lambda x: F.length(F.regexp_replace(x, rf"{SPACE}+", "")) > 0).alias("__l"),
    )
    windows = F.when(
        F.size("__w") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("__w") - 3),
            lambda i: F.struct(
                F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("i")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    three = two.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", rf"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").alias("n_lines"),
        F.size(F.array_distinct("__w")).alias("n_distinct"),
        F.length("__t").alias("n_chars_all"),
        _count_of(F.col("__t"), r"\p{Lu}").alias("n_upper"),
        (F.length("__t") - F.length(F.translate("__t", "0123456789", ""))).alias("n_digits"),
        (F.length("__t") - F.length(F.translate("__t", "!?.,;:\"'()-", ""))).alias("n_punctuation"),
        (F.length("__t") - F.length(F.translate("__t", "|", ""))).alias("n_pipes"),
        F.array_sort(windows).alias("__s"),
    )
    repeated = F.filter(
        "__s",
        lambda x, k: (x["h"] == F.get("__s", k - 1)["h"]) | (x["h"] == F.get("__s", k + 1)["h"]),
    )
    four = three.select(*[c for c in three.columns if c != "__s"], F.array_sort(F.transform(repeated, lambda x: x["i"])).alias("__r"))
    gap = F.zip_with(
        F.slice("__r", 2, F.greatest(F.size("__r") - 1, F.lit(0))),
        F.slice("__r", 1, F.greatest(F.size("__r") - 1, F.lit(0))),
        lambda later, here: F.least(later - here, F.lit(3)),
    )
    covered = F.when(F.size("__r") > 0, F.aggregate(gap, F.lit(3), lambda total, x: total + x)).otherwise(F.lit(0))
    five = four.withColumn("n_repeat_words", covered.cast("long")).drop("__r")
    return five.select(
        "*",
        _ratio(F.col("n_symbols"), F.col("n_chars_all")).alias("symbol_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_ratio"),
        # the share of distinct words falls with length as a power of it: judged against that power
        _ratio(F.col("n_distinct").cast("double"), F.pow(F.col("n_words"), F.lit(0.9))).alias("distinct_ratio"),
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_upper"), F.col("n_chars_all")).alias("upper_ratio"),
        _ratio(F.col("n_digits"), F.col("n_chars_all")).alias("digit_ratio"),
        _ratio(F.col("n_punctuation"), F.col("n_chars_all")).alias("punctuation_ratio"),
        _ratio(F.col("n_pipes"), F.col("n_words")).alias("pipe_ratio"),
        _ratio(F.col("n_words"), F.col("n_lines")).alias("words_per_line"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _cuts(rows: DataFrame, features: tuple[str, ...]) -> dict[str, list[float]]:
    """Candidate thresholds: quantiles of the bad and of the good rows, over all labelled rows."""
    at = [i / CUTS for i in range(1, CUTS)]
    asked = [
        F.percentile_approx(F.when(F.col("__bad") == bad, F.col(f)), at, 10_000).alias(f"{f}_{bad}")
        for f in features
        for bad in (0, 1)
    ] + [end(F.when(F.col("__bad") == 0, F.col(f))).alias(f"{f}_{end.__name__}") for f in features for end in (F.min, F.max)]
    row = rows.agg(*asked).first()
    found = {}
    for f in features:
        # the ends of the good rows are points too, and cuts lie between points: a threshold next to
        # the good rows keeps half the gap to the nearest bad ones as a margin
        points = {x for bad in (0, 1) for x in (row[f"{f}_{bad}"] or [])}
        points |= {row[f"{f}_{end}"] for end in ("min", "max") if row[f"{f}_{end}"] is not None}
        ordered = sorted(points)
        found[f] = [(a + b) / 2 for a, b in zip(ordered, ordered[1:])]
    return found


def _bin(feature: str, points: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, points)), lambda cut: cut <= F.col(feature)))


def _tallies(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) rows by statistic and by the number of its cuts at or below the value.

    One aggregate for all statistics at once; its result has a row per statistic and cut."""
    binned = F.array(
        *[
            F.struct(
                F.lit(f).alias("f"),
                _bin(f, cuts[f]).alias("b"),
            )
            for f in cuts
            if cuts[f]
        ]
    )
    table = (
        rows.select("__bad", F.explode(binned).alias("x"))
        .groupBy("x.f", "x.b")
        .agg(F.sum("__bad").alias("bad"), F.sum(1 - F.col("__bad")).alias("good"))
    )
    return {(r["f"], r["b"]): (r["bad"], r["good"]) for r in table.collect()}


def _best(tallies: dict, cuts: dict[str, list[float]], bad: int, good: int) -> tuple[Condition | None, int, int]:
    """The condition with the largest information gain for the bad rows, and what it covers."""
    from math import log2

    prior, best = log2(bad / (bad + good)), (0.0, None, 0, 0)
    for f, points in sorted(cuts.items()):
        below = [0, 0]
        for b, cut in enumerate(points):
            for side in (0, 1):
                below[side] += tallies.get((f, b), (0, 0))[side]
            for at_least, p, n in ((False, *below), (True, bad - below[0], good - below[1])):
                if p >= MIN_COVER:
                    gain = p * (log2(p / (p + n)) - prior)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, at_least, float(cut)), p, n)
    return best[1:]


def learn(labelled: DataFrame, bad: Column, key: str = "doc_id", features: tuple[str, ...] = FEATURES) -> list[Rule]:
    """A decision list for ``bad`` rows by sequential covering over all labelled statistics."""
    rows = labelled.select(*features, bad.cast("int").alias("__bad"), (F.pmod(F.xxhash64(key), F.lit(3)) > 0).alias("__grow"))
    rows = materialise(rows.where(F.col("__bad").isNotNull()), "labelled")
    cuts, rules = _cuts(rows, features), []
    if not any(cuts.values()):
        return rules
    left = rows
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        covered = left.where("__grow")
        tally = _tallies(covered, cuts)
        first = next((f for f in cuts if cuts[f]), None)
        p = sum(v[0] for k, v in tally.items() if k[0] == first)
        n = sum(v[1] for k, v in tally.items() if k[0] == first)
        while len(rule) < MAX_CONDITIONS and p >= MIN_COVER and n > 0:
            condition, p, n = _best(tally, cuts, p, n)
            if condition is None:
                break
            rule += (condition,)
            if n and len(rule) < MAX_CONDITIONS:
                tally = _tallies(covered.where(_all(rule)), cuts)
        rule = _pruned(left, rule)
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_all(rule))
    return rules


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of the rule that does best on the held-back rows, or none if it isn't precise."""
    if not rule:
        return ()
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k])
        for part in (True, False):
            for side in (1, 0):
                sums.append(F.count_if(hit & (F.col("__grow") == part) & (F.col("__bad") == side)).alias(f"n{k}_{int(part)}_{side}"))
    row = rows.agg(*sums).first()
    best, kept = -1.0, ()
    for k in range(1, len(rule) + 1):
        (gp, gn), (p, n) = ([row[f"n{k}_{part}_{side}"] for side in (1, 0)] for part in (1, 0))
        if gp + p >= MIN_COVER and gp >= MIN_PRECISION * (gp + gn) and p >= MIN_PRECISION * (p + n) and p:
            worth = (p - n) / (p + n) + 1e-6 * p
            if worth > best:
                best, kept = worth, rule[:k]
    return kept


def verdict(rules: list[Rule]) -> Column:
    """Index of the first rule that fires, from 1; 0 if none does."""
    out = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules, start=1):
        out = out.when(_all(rule), F.lit(i))
    return out.otherwise(F.lit(0))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """Statistics, ``base_failed``, ``rule`` (0: none) and ``kept`` for each document; columns to
    ``keep`` that have one of these names are replaced.

    Texts are read once: their statistics are written to the shared folder, the rules are learned
    from the labelled rows of that table, and the verdicts are computed from it."""
    keep = [c for c in keep or [key] if c not in _MADE]
    stats = materialise(statistics(docs, text, keep), "statistics")
    labels = labels.where(F.col(key).isNotNull())
    known = labels.groupBy(F.col(key).alias("__k")).agg(F.min(quality).alias("__q")).where(F.col("__q").isNotNull())
    labelled = stats.join(known, F.col(key) == F.col("__k")).where(~base_failed())
    rules = learn(labelled, F.col("__q") == 0, key)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return judge(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
