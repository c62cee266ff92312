"""Personal data by weak supervision, in DataFrame operations only.

Patterns propose candidate spans. Those that pass the base rules are always reported. For the
others, four labelers (pattern, gazetteer, context, shape) vote for, against or not at all;
expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is
for each kind, and its posteriors train a naive Bayes classifier on the look of the span. A
candidate that the classifier accepts and that overlaps no base span is added.

Defined cases: a null text is empty and has no spans. Repeated rows give the same spans each.
Spans are in code points, end exclusive. Without candidates nothing is learned and nothing added.
Other columns pass through :func:`redact`."""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import documents, materialise

#: Kinds in the order of the contract; ``secret`` is added by the method alone.
KINDS = ("email", "ip", "card", "phone", "secret")
EM_ROUNDS, ACCEPT, BEFORE = 30, 0.5, 32
#: The contract's patterns, written so that no text makes them backtrack far: runs are possessive
#: and start at their first character. A card needs 14 digits, so shorter runs are not matched.
BASE_PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9]){13,}+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What else may be personal data: written-out addresses, numbers without a plus, quoted secrets.
EXTRA_PATTERNS = {
    0: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    3: r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    4: r"(?i)(?<![a-z])(?:token|secret|password|api[_-]?key|access[_-]?key)\x20?[=:]\x20?[\"'][a-z0-9+/=_-]{8,256}+[\"']",
}
#: Characters without which the pattern cannot match, if there are such: a quick test before the scan.
NEEDS = {"base": ("@", ".", "", "+"), 0: "at", 3: "", 4: ""}
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
#: Gazetteers: what endings, networks, issuers and country codes usually look like, by kind.
LISTED = (
    r"(?i)\.(?:com|org|net|edu|gov|io|info|de|fr|es|it|nl|uk|eu|us|ca|ch|at|test)$",
    r"^(?!0\.|127\.|255\.|2[4-5][0-9]\.)[0-9]",
    r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    r"^(?:\+(?:1|33|34|39|41|43|44|49|31|32)|\(?[2-9])",
    r"[\"'](?:[0-9a-fA-F]{16,}|[A-Za-z0-9+/_-]{20,}=*)[\"']$",
)
CUES = (
    r"(?i)mail|contact|write|schreib|correo|courriel",
    r"(?i)\bip\b|host|server|addr|login",
    r"(?i)card|visa|master|pay|konto|carte|tarjeta",
    r"(?i)call|phone|tel|fax|mobil|anruf|llam|appel",
    r"(?i)=|:|token|key|secret|password",
)


#: Prefix sums over matches are taken by blocks, so that a text with very many is not quadratic.
_RUN = 256
_SPAN = "struct<kind:int,start:int,end:int,text:string,before:string,after:string,base:boolean>"


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def worth(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, twice).otherwise(n)

    values = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(values, F.lit(0), _plus) % 10 == 0


def _base_holds(kind: int, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == 1:
        return F.rlike(match, F.lit(OCTETS))
    if kind == 2:
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == 3:
        return F.length(digits).between(10, 15)
    return F.lit(True)


def candidates(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``spans``: all candidates of each text, base ones marked; ``keep`` names the columns to carry."""
    keep = df.columns if keep is None else keep
    wanted = [(k, p, False, n) for k, (p, n) in enumerate(zip(BASE_PATTERNS, NEEDS["base"]))]
    wanted += [(k, p, True, NEEDS[k]) for k, p in EXTRA_PATTERNS.items()]
    body, none = F.col("__t"), F.array().cast("array<string>")
    hold = [c for c in keep if c != "__t"]
    one = df.select(*hold, F.coalesce(F.col(text), F.lit("")).alias("__t"))

    def found(pattern: str, needs: str) -> Column:
        hits = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        return F.when(F.contains(body, F.lit(needs)), hits).otherwise(none) if needs else hits

    two = one.select(*hold, "__t", *[found(p, n).alias(f"__m{i}") for i, (_, p, _, n) in enumerate(wanted)])
    lengths = [
        F.when(F.size(f"__m{i}") > 0, F.transform(F.split(body, p, -1), F.length)).alias(f"__p{i}")
        for i, (_, p, _, _) in enumerate(wanted)
    ]
    three = two.select("*", *lengths)
    steps = [
        F.zip_with(f"__m{i}", F.slice(f"__p{i}", F.lit(1), F.size(f"__m{i}")), lambda m, p: F.length(m) + p).alias(f"__n{i}")
        for i in range(len(wanted))
    ]
    four = three.select("*", *steps)
    sums = [
        F.when(
            F.size(f"__m{i}") > 0,
            _block_sums(f"__n{i}"),
        ).alias(f"__b{i}")
        for i in range(len(wanted))
    ]
    five = four.select("*", *sums)
    arrays = [
        F.when(F.size(f"__m{i}") > 0, _placed(i, k, extra)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        for i, (k, _, extra, _) in enumerate(wanted)
    ]
    return five.select(*hold, F.concat(*arrays).alias("spans"))


def _block_sums(name: str) -> Column:
    blocks = F.sequence(F.lit(0), F.floor((F.size(name) - 1) / _RUN).cast("int"))
    return F.transform(blocks, lambda b: F.aggregate(F.slice(name, b * _RUN + 1, F.lit(_RUN)), F.lit(0), _plus))


def _placed(i: int, kind: int, extra: bool) -> Column:
    def span(match: Column, j: Column) -> Column:
        block = F.floor(j / _RUN).cast("int")
        start = (
            F.aggregate(F.slice(f"__b{i}", F.lit(1), block), F.lit(0), _plus)
            + F.aggregate(F.slice(f"__n{i}", block * _RUN + 1, j % _RUN), F.lit(0), _plus)
            + F.get(f"__p{i}", j)
        )
        end = start + F.length(match)
        before = F.substring(F.col("__t"), F.greatest(start - BEFORE, F.lit(0)) + 1, F.least(start, F.lit(BEFORE)))
        base = F.lit(False) if extra else _base_holds(kind, match)
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), match.alias("text"), before.alias("before"),
            F.substring(F.col("__t"), end + 1, F.lit(1)).alias("after"), base.alias("base"),
        )

    return F.transform(f"__m{i}", span).cast(f"array<{_SPAN}>")


def _by_kind(kind: Column, patterns: tuple[str, ...], value: Column) -> Column:
    out = F.lit(False)
    for k, pattern in enumerate(patterns):
        out = F.when(kind == k, F.rlike(value, F.lit(pattern))).otherwise(out)
    return out


def votes(x: Column) -> Column:
    """The four labelers' votes on a candidate, as three-valued digits: 0 against, 1 none, 2 for.

    Pattern: the base rules hold, or the candidate is longer than they allow. Gazetteer: the kind's
    listed endings, issuers or codes. Context: a cue word shortly before. Shape: the span stands
    alone, not inside a longer word or number."""
    digits = F.length(F.regexp_replace(x["text"], "[^0-9]", ""))
    pattern = F.when(x["base"], 2).when((x["kind"] == 1) | ((x["kind"] == 2) & (digits > 19)), 0).otherwise(1)
    listed = F.when(_by_kind(x["kind"], LISTED, x["text"]), 2).otherwise(0)
    context = F.when(_by_kind(x["kind"], CUES, F.concat(x["before"], F.when(x["kind"] == 4, x["text"]).otherwise(F.lit("")))), 2).otherwise(1)
    inside = F.rlike(x["before"], F.lit(r"[\p{L}0-9]$")) | F.rlike(x["after"], F.lit(r"^[\p{L}0-9]"))
    shape = F.when(inside, 0).otherwise(2)
    return ((pattern * 3 + listed) * 3 + context) * 3 + shape


def look(x: Column) -> dict[str, Column]:
    """What the final classifier sees of a candidate: small integers."""
    size = F.length(x["text"])
    digits = F.length(F.regexp_replace(x["text"], "[^0-9]", ""))
    marks = F.length(F.regexp_replace(x["text"], r"[\p{L}0-9]", ""))
    return {
        "length": F.least(F.floor(size / 4), F.lit(15)).cast("int"),
        "digits": F.least(digits, F.lit(24)).cast("int"),
        "marks": F.least(marks, F.lit(8)).cast("int"),
        "listed": _by_kind(x["kind"], LISTED, x["text"]).cast("int"),
        "cue": _by_kind(x["kind"], CUES, x["before"]).cast("int"),
        "alone": (~F.rlike(x["before"], F.lit(r"[\p{L}0-9]$")) & ~F.rlike(x["after"], F.lit(r"^[\p{L}0-9]"))).cast("int"),
    }


def estimate(counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """Posterior of every (kind, vote pattern) by EM with a reliability for each labeler and kind."""
    out: dict[tuple[int, int], float] = {}
    for kind in {k for k, _ in counts}:
        rows = {v: n for (k, v), n in counts.items() if k == kind}
        digits = {v: [v // 27, v // 9 % 3, v // 3 % 3, v % 3] for v in rows}
        post = {v: min(0.95, max(0.05, 0.5 + sum(d - 1 for d in digits[v]) / 8)) for v in rows}
        for _ in range(EM_ROUNDS):
            total = sum(rows.values())
            yes = sum(rows[v] * post[v] for v in rows)
            prior = (yes + 1) / (total + 2)
            table = []
            for j in range(4):
                for_, against = [0.5] * 3, [0.5] * 3
                # a weak belief that votes are more often right than wrong keeps the classes from swapping
                for_[2] += 1
                against[0] += 1
                for v, n in rows.items():
                    for_[digits[v][j]] += n * post[v]
                    against[digits[v][j]] += n * (1 - post[v])
                table.append(([x / sum(for_) for x in for_], [x / sum(against) for x in against]))
            for v in rows:
                odds = log(prior / (1 - prior)) + sum(log(table[j][0][d] / table[j][1][d]) for j, d in enumerate(digits[v]))
                post[v] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
        out |= {(kind, v): p for v, p in post.items()}
    return out


Weights = dict[tuple[int, str, int], float]


def train(found: DataFrame) -> tuple[Weights, dict[tuple[int, int], float]]:
    """Labeler reliabilities, then the span classifier, from all candidates.

    Both see only counts: by kind and vote pattern (81 each), then by kind, look and posterior."""
    rows = found.select(F.explode("spans").alias("x"))
    pairs = rows.select(F.col("x.kind").alias("k"), votes(F.col("x")).alias("v"), *[c.alias(n) for n, c in look(F.col("x")).items()])
    names = list(look(F.col("x")))
    # one row for each kind, vote pattern, trait and trait value: at most 5 * 81 * (16+25+9+2+2+2)
    table = (
        pairs.select("k", "v", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("t"))
        .groupBy("k", "v", "t.f", "t.b")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts: dict[tuple[int, int], int] = {}
    for r in table:
        if r["f"] == names[0]:
            counts[r["k"], r["v"]] = counts.get((r["k"], r["v"]), 0) + r["n"]
    posterior = estimate(counts)
    sums: dict[tuple[int, str, int], list[float]] = {}
    totals: dict[int, list[float]] = {}
    for (k, v), n in counts.items():
        t = totals.setdefault(k, [1.0, 1.0])
        t[0] += n * posterior[k, v]
        t[1] += n * (1 - posterior[k, v])
    for r in table:
        s = sums.setdefault((r["k"], r["f"], r["b"]), [0.5, 0.5])
        p = posterior[r["k"], r["v"]]
        s[0] += r["n"] * p
        s[1] += r["n"] * (1 - p)
    weights: Weights = {(k, "prior", 0): log(t[0] / t[1]) for k, t in totals.items()}
    for (k, f, b), s in sums.items():
        t = totals[k]
        weights[k, f, b] = log((s[0] / (t[0] + 1)) / (s[1] / (t[1] + 1)))
    return weights, posterior


def accepted(x: Column, weights: Weights) -> Column:
    """Whether the classifier takes the candidate: its log odds, as one expression."""
    if not weights:
        return F.lit(False)
    score, traits = F.lit(0.0), look(x) | {"prior": F.lit(0)}
    for name, value in traits.items():
        cells = {k * 100 + b: w for (k, f, b), w in weights.items() if f == name}
        lookup = F.create_map(*[F.lit(y) for pair in sorted(cells.items()) for y in pair])
        score = score + F.coalesce(F.try_element_at(lookup, x["kind"] * 100 + value), F.lit(0.0))
    return score > log(ACCEPT / (1 - ACCEPT))


def decided(found: DataFrame, weights: Weights) -> DataFrame:
    """``spans`` reduced to base spans and accepted ones, in order of start, kind and end."""
    chosen = F.filter("spans", lambda x: x["base"] | accepted(x, weights))
    one = found.withColumn("spans", chosen).withColumn("__base", F.filter("spans", lambda x: x["base"]))
    free = F.filter(
        "spans",
        lambda x: x["base"] | ~F.exists("__base", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])),
    )
    order = F.array_sort(F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["base"].alias("base"))))
    return one.withColumn("spans", order).drop("__base")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def find(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``spans`` (start, kind, end, base) of every document; each text is scanned once."""
    found = materialise(candidates(df, text, keep), "candidates")
    return decided(found, train(found)[0])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets; a null text stays null."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    marked = find(df.select(row, F.col(text).alias("__text")), "__text", ["__row", "__text"])
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # where the text before this span has already been replaced up to
    done = F.transform("spans", lambda x, i: F.coalesce(F.array_max(F.transform(F.slice("spans", F.lit(1), i), lambda y: y["end"])), F.lit(0)))
    one = marked.withColumn("__done", done)
    parts = F.zip_with(
        "spans",
        "__done",
        lambda x, at: F.concat(
            F.substring(F.col("__text"), at + 1, F.greatest(x["start"] - at, F.lit(0))),
            F.when(x["end"] > at, F.get(names, x["kind"])).otherwise(F.lit("")),
        ),
    )
    last = F.array_max(F.transform("spans", lambda y: y["end"]))
    fresh = F.concat(F.array_join(parts, ""), F.substring(F.col("__text"), last + 1, F.length("__text")))
    clean = F.when(F.size("spans") > 0, fresh).otherwise(F.col("__text"))
    return one.select(*[clean.alias(c) if c == text else F.col(f"__row.`{c}`") for c in df.columns])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    base = found.withColumn("base", F.filter("spans", lambda x: x["base"]))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return base.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
