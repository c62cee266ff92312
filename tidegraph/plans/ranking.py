"""Retrieval beyond lexical scores, span alignment, legal pairs and tagged facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions import ixbrl as B
from tidegraph.functions import lexicon as X
from tidegraph.functions.text import tokens
from tidegraph.operators import extraction as E
from tidegraph.operators import relational as R
from tidegraph.operators import retrieval as V
from tidegraph.plans.registry import register
from tidegraph.plans.text import _BM25_SQL, _lexical
from tidegraph.session import table as t

_ASKED = ("What is the inventory turnover of {} in FY2019 and 2020?", "Compute working capital of {} for 2021", "How much revenue did {} report in FY 2018?", "Is {} a going concern?", "What was the capex of {} and its net income in 2017 and 2017?")
_ASKED_SQL = "asked AS (SELECT p_partkey AS query_id, CASE p_partkey % 5 " + " ".join(f"WHEN {i} THEN replace('{q}', '{{}}', p_brand)" for i, q in enumerate(_ASKED)) + " END AS text FROM part)"
_TOKENS_SQL = "regexp_extract_all(lower(text), '[a-z0-9]+')"
_DISTILLED_SQL = f"array_to_string(list_filter({_TOKENS_SQL}, lambda w: w NOT IN ({', '.join(repr(w) for w in X.QUESTION_STOPWORDS)})), ' ')"


def _asked(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_partkey") % 5
    text = F.lit(None).cast("string")
    for i, q in enumerate(_ASKED):
        before, after = q.split("{}")
        text = F.when(n == i, F.concat(F.lit(before), "p_brand", F.lit(after))).otherwise(text)
    return t(spark, d, "part").select(F.col("p_partkey").alias("query_id"), text.alias("text"))


@register("query_facets", f"""WITH {_ASKED_SQL}, y AS (SELECT *, regexp_extract_all(text, '(?i)\\b(?:FY\\s*)?((?:19|20)\\d{{2}})\\b', 1) AS l, {_DISTILLED_SQL} AS plain, lower(text) AS low FROM asked),
z AS (SELECT *, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS years FROM y),
p AS (SELECT *, flatten([{', '.join(f"CASE WHEN regexp_matches(low, '{p}') THEN {list(s)!r} ELSE [] END" for p, s in X.QUERY_FACETS)}]) AS phrases FROM z),
a AS (SELECT query_id, CASE WHEN len(phrases) > 0 THEN list_transform(phrases, lambda x: trim(x || ' ' || years)) ELSE [plain] END AS f FROM p), u AS (SELECT query_id, list_filter(f, lambda x, i: list_position(f, x) = i) AS f FROM a)
SELECT query_id, unnest(f) AS facet, (generate_subscripts(f, 1) - 1)::INTEGER AS place FROM u""")
def query_facets(spark: SparkSession, d: str) -> DataFrame:
    return _asked(spark, d).select("query_id", F.posexplode(V.facets(F.col("text"))).alias("place", "facet"))


@register("anchor_inclusion", f"""WITH {_BM25_SQL}, cov AS (SELECT query_id, chunk_id, count(*) AS c FROM tf JOIN q USING (term) GROUP BY 1, 2), anchors AS (SELECT query_id, arg_min(chunk_id, (-c, chunk_id)) AS chunk_id FROM cov GROUP BY 1),
u AS (SELECT coalesce(l.query_id, a.query_id) AS query_id, coalesce(l.chunk_id, a.chunk_id) AS chunk_id, l.rank, a.query_id IS NOT NULL AS required FROM (SELECT * FROM lex WHERE rank <= 6) l FULL JOIN anchors a ON a.query_id = l.query_id AND a.chunk_id = l.chunk_id)
SELECT query_id, chunk_id, required FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN required THEN 0 ELSE 1 END, rank NULLS LAST, chunk_id) AS place FROM u) WHERE place <= 6""")
def anchor_inclusion(spark: SparkSession, d: str) -> DataFrame:
    """The first six chunks of each query, among them the one that covers most of its terms."""
    chunks = t(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    terms = t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    cover = chunks.join(terms, "term").groupBy("query_id", "chunk_id").agg(F.count(F.lit(1)).alias("c"))
    anchors = cover.groupBy("query_id").agg(F.min_by("chunk_id", F.struct(-F.col("c"), "chunk_id")).alias("chunk_id"))
    return V.with_anchors(_lexical(spark, d).where("rank <= 6"), anchors, 6)


@register("hybrid_rerank", f"""WITH {_BM25_SQL}, v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), vn AS (SELECT vec_id, e, list_dot_product(e, e) AS d FROM v),
c AS (SELECT l.query_id, l.chunk_id, l.score, coalesce(list_dot_product(a.e, b.e) / (sqrt(a.d) * sqrt(b.d)), 0) AS cosine FROM (SELECT * FROM lex WHERE rank <= 20) l LEFT JOIN vn a ON a.vec_id = l.query_id LEFT JOIN vn b ON b.vec_id = l.chunk_id),
h AS (SELECT *, round(0.55::DOUBLE * (score / max(score) OVER (PARTITION BY query_id)) + 0.45::DOUBLE * greatest(0.0::DOUBLE, cosine), 6) AS hybrid FROM c)
SELECT query_id, chunk_id, place::INTEGER AS place, hybrid FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hybrid DESC, chunk_id) AS place FROM h) WHERE place <= 6""")
def hybrid_rerank(spark: SparkSession, d: str) -> DataFrame:
    """The twenty lexical candidates of each query by both scores; a chunk without a vector has cosine 0."""
    vectors = t(spark, d, "embeddings").select(F.col("vec_id"), "embedding")
    rows = _lexical(spark, d).where("rank <= 20").join(vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), "query_id", "left")
    rows = rows.join(vectors.select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("c")), "chunk_id", "left")
    cosine = F.coalesce(V.cosine(F.col("q"), F.col("c")), F.lit(0.0))
    best = V.rerank(rows, F.col("score"), cosine, 0.55).where("place <= 6")
    return best.select("query_id", "chunk_id", "place", "hybrid")


@register("idf_retrieval", f"""WITH w AS (SELECT doc_id AS chunk_id, list_distinct({_TOKENS_SQL}) AS w FROM documents), n AS (SELECT count(*) AS n FROM w), q AS (SELECT DISTINCT item_id AS query_id, unnest({_TOKENS_SQL}) AS term FROM benchmark),
e AS (SELECT chunk_id, len(w) AS size, unnest(w) AS term FROM w), df AS (SELECT term, count(*) AS df FROM e GROUP BY 1), s AS (SELECT query_id, chunk_id, round(sum(ln((n + 1) / (df + 1)) + 1) / sqrt(any_value(size)), 6) AS score FROM e JOIN df USING (term) JOIN q USING (term), n GROUP BY 1, 2)
SELECT query_id, chunk_id, rank::INTEGER AS rank, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s) WHERE rank <= 4""")
def idf_retrieval(spark: SparkSession, d: str) -> DataFrame:
    chunks = t(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    scores = V.idf_overlap(chunks, t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")).withColumn("score", F.round("score", 6))
    return V.ranked(scores, F.col("score")).where("rank <= 4").select("query_id", "chunk_id", "rank", "score")


@register("concept_ranking", r"""WITH l AS (SELECT DISTINCT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || w[2:]), '') || upper(p_type[1:1]) || lower(p_type[2:]) AS label FROM part),
w AS (SELECT label, list_distinct(list_transform(regexp_extract_all(label, '([A-Z]?[a-z]+|[A-Z]+|\d+)', 1), lambda x: lower(x))) AS w FROM l), e AS (SELECT label, len(w) AS n, unnest(w) AS word FROM w),
x AS (SELECT DISTINCT p_partkey AS text_id, unnest(regexp_extract_all(lower(p_name || ' ' || p_type || ' parts'), '[a-z0-9]+')) AS word FROM part), s AS (SELECT text_id, label, count(*) + count(*) / any_value(n) AS score FROM x JOIN e USING (word) GROUP BY 1, 2)
SELECT text_id, label, place::INTEGER AS place FROM (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY score DESC, label DESC) AS place FROM s) WHERE place <= 3""")
def concept_ranking(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part")
    word = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 100))
    label = F.concat(F.array_join(F.transform(F.split("p_name", " "), word), ""), F.upper(F.substring("p_type", 1, 1)), F.lower(F.substring("p_type", 2, 100)))
    texts = part.select(F.col("p_partkey").alias("text_id"), F.concat_ws(" ", "p_name", "p_type", F.lit("parts")).alias("text"))
    scores = V.concept_scores(texts, part.select(label.alias("label")).distinct())
    return R.top_per_group(scores, ["text_id"], [F.desc("score"), F.desc("label")], 3, "place").select("text_id", "label", "place")


@register("span_alignment", f"""WITH w AS (SELECT doc_id, {_TOKENS_SQL} AS w FROM documents), m AS (SELECT doc_id, w, w[3:4] AS mention, unnest([1, 2, 3]) AS ordinal FROM w),
o AS (SELECT *, list_filter(range(0, len(w) - 1), lambda i: len(mention) = 2 AND w[i + 1] = mention[1] AND w[i + 2] = mention[2]) AS places FROM m)
SELECT doc_id, ordinal, array_to_string(mention, ' ') AS mention, places[ordinal]::INTEGER AS start, (places[ordinal] + 2)::INTEGER AS stop FROM o WHERE places[ordinal] IS NOT NULL""")
def span_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Each document's third and fourth words, named three times: every mention gets the next unused place."""
    # exploded from an array of one, so that the words are not found again for every place
    rows = t(spark, d, "documents").select("doc_id", F.explode(F.array(tokens(F.col("text")))).alias("w"))
    rows = rows.select("doc_id", "w", F.explode(F.array(F.slice("w", 3, 2))).alias("mention")).where(F.size("mention") == 2)
    rows = rows.withColumn("places", V.occurrences(F.col("w"), F.col("mention"))).select("doc_id", "mention", "places", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("ordinal"))
    start = F.get("places", F.col("ordinal") - 1)
    return rows.select("doc_id", "ordinal", F.array_join("mention", " ").alias("mention"), start.alias("start"), (start + 2).alias("stop")).where("start IS NOT NULL")


@register("legal_pairs", """WITH e AS (SELECT DISTINCT l_orderkey AS unit_id, l_suppkey AS entity_id, l_returnflag AS type FROM lineitem), s(head_type, tail_type, relation) AS (VALUES ('A', 'R', 'acquires'), ('A', 'R', 'sells'), ('N', 'N', 'competes'), ('R', 'A', 'owned_by'))
SELECT h.unit_id, h.entity_id AS head_id, t.entity_id AS tail_id, string_agg(DISTINCT relation, ';' ORDER BY relation) AS allowed FROM e h JOIN e t ON h.unit_id = t.unit_id AND h.entity_id <> t.entity_id JOIN s ON h.type = head_type AND t.type = tail_type GROUP BY 1, 2, 3""")
def legal_pairs(spark: SparkSession, d: str) -> DataFrame:
    entities = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit_id"), F.col("l_suppkey").alias("entity_id"), F.col("l_returnflag").alias("type")).distinct()
    signatures = spark.createDataFrame([("A", "R", "acquires"), ("A", "R", "sells"), ("N", "N", "competes"), ("R", "A", "owned_by")], "head_type string, tail_type string, relation string")
    return V.legal_pairs(entities, signatures)


_PAGE = (
    '<xbrli:context id="a"><xbrli:startDate>{s}</xbrli:startDate><xbrli:endDate>{e}</xbrli:endDate></xbrli:context><xbrli:context id="q"><xbrli:startDate>{q}</xbrli:startDate><xbrli:endDate>{e}</xbrli:endDate></xbrli:context>'
    '<xbrli:context id="d"><xbrli:instant>{e}</xbrli:instant><xbrli:segment>x</xbrli:segment></xbrli:context><xbrli:context id="i"><xbrli:instant>{e}</xbrli:instant></xbrli:context>'
    '<ix:nonFraction name="us-gaap:Revenues" contextRef="q" unitRef="USD" id="f1" scale="3">{k}</ix:nonFraction><ix:nonFraction name="us-gaap:Revenues" contextRef="a" unitRef="USD" id="f2" scale="3">1,{k}</ix:nonFraction>'
    '<ix:nonFraction name="us-gaap:Assets" contextRef="d" unitRef="USD" id="f3">9</ix:nonFraction><ix:nonFraction name="us-gaap:Assets" contextRef="i" unitRef="USD" id="f4" sign="-">{k}</ix:nonFraction>'
    '<ix:nonFraction name="us-gaap:ProfitLoss" contextRef="a" unitRef="USD" id="f5">({k})</ix:nonFraction>'
)


@register("ixbrl_picks", """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS e, 100 + o_orderkey % 900 AS k FROM orders) SELECT o_orderkey, 'Revenues' AS concept, 'a' AS context, (1000 + k) * 1000.0::DOUBLE AS value, 25 AS score FROM o
UNION ALL SELECT o_orderkey, 'Assets', 'i', -k::DOUBLE, 24 FROM o UNION ALL SELECT o_orderkey, 'ProfitLoss', 'a', -k::DOUBLE, 25 FROM o""")
def ixbrl_picks(spark: SparkSession, d: str) -> DataFrame:
    """Of each concept on a page the fact that fits best: without dimensions, annual, near the year's end."""
    day = F.col("o_orderdate").cast("date")
    page = F.lit(_PAGE)
    for mark, shown in (("{s}", F.date_sub(day, 364)), ("{q}", F.date_sub(day, 90)), ("{e}", day), ("{k}", 100 + F.col("o_orderkey") % 900)):
        page = F.replace(page, F.lit(mark), shown.cast("string"))
    rows = t(spark, d, "orders").select("o_orderkey", day.alias("day"), page.alias("html")).select("o_orderkey", "day", B.contexts(F.col("html")).alias("c"), F.explode(B.facts(F.col("html"))).alias("f"))
    own = rows.withColumn("x", F.filter("c", lambda x: x["id"] == F.col("f.context"))[0]).where(~F.col("x.dimensions") & F.col("f.value").isNotNull())
    period = F.when(F.col("f.concept") == "Assets", "instant").otherwise("duration")
    scored = own.withColumn("score", B.score(period, F.col("x.start"), F.col("x.stop"), F.col("x.instant"), F.col("f.unit"), F.col("day")))
    best = scored.groupBy("o_orderkey", F.col("f.concept").alias("concept")).agg(F.max(F.struct("score", "f.context", "f.id", "f.value")).alias("m"))
    return best.select("o_orderkey", "concept", "m.context", "m.value", "m.score")


@register("ixbrl_facts", """WITH o AS (SELECT o_orderkey, 100 + o_orderkey % 900 AS k FROM orders) SELECT o_orderkey, 'f1' AS id, k * 1000.0::DOUBLE AS value, false AS dimensions FROM o UNION ALL SELECT o_orderkey, 'f2', (1000 + k) * 1000.0, false FROM o
UNION ALL SELECT o_orderkey, 'f3', 9.0, true FROM o UNION ALL SELECT o_orderkey, 'f4', -k, false FROM o UNION ALL SELECT o_orderkey, 'f5', -k, false FROM o""")
def ixbrl_facts(spark: SparkSession, d: str) -> DataFrame:
    """All numeric facts of a page with whether their context has dimensions."""
    day, page = F.col("o_orderdate").cast("date"), F.lit(_PAGE)
    for mark, shown in (("{s}", F.date_sub(day, 364)), ("{q}", F.date_sub(day, 90)), ("{e}", day), ("{k}", 100 + F.col("o_orderkey") % 900)):
        page = F.replace(page, F.lit(mark), shown.cast("string"))
    rows = t(spark, d, "orders").select("o_orderkey", page.alias("html")).select("o_orderkey", B.contexts(F.col("html")).alias("c"), F.explode(B.facts(F.col("html"))).alias("f"))
    return rows.select("o_orderkey", "f.id", "f.value", F.filter("c", lambda x: x["id"] == F.col("f.context"))[0]["dimensions"].alias("dimensions"))


@register("token_bigrams", f"""WITH w AS (SELECT doc_id, {_TOKENS_SQL} AS w FROM documents) SELECT doc_id, len(w)::INTEGER AS words, len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))::INTEGER AS bigrams FROM w""")
def token_bigrams(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select("doc_id", tokens(F.col("text")).alias("w"))
    pairs = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return rows.select("doc_id", F.size("w").alias("words"), F.size(F.array_distinct(pairs)).alias("bigrams"))


@register("alias_scan", f"""WITH x AS (SELECT doc_id, regexp_extract_all(text, '\\b(?:the|and|software|token|License)\\b', 0) AS m, regexp_split_to_array(text, '\\b(?:the|and|software|token|License)\\b') AS b FROM documents)
SELECT doc_id, s.text AS mention, count(*) AS n, min(s.start)::INTEGER AS first FROM (SELECT doc_id, unnest(list_transform(m, lambda w, i: {{'text': w, 'start': list_sum(list_transform(b[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0)}})) AS s FROM x) GROUP BY 1, 2""")
def alias_scan(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of a short alias list by document, with the place of the first."""
    spans = E.alias_spans(t(spark, d, "documents").select("doc_id", "text"), ("the", "and", "software", "token", "License"))
    return spans.groupBy("doc_id", "mention").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first"))
