"""Text functions, HTML, retrieval and vectors on the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.functions import text as X
from tidegraph.operators import retrieval as V
from tidegraph.operators.graph import components
from tidegraph.plans.registry import register
from tidegraph.session import materialised, spread
from tidegraph.session import table as t

#: Terms of the relevance score and their weights, a parameter of the operator.
TERMS = {"license": 2.0, "token": 1.5, "public": 1.0, "the": 0.25, "der": 0.25, "software": 1.5, "warranty": 2.0}
LEAST_RELEVANCE = 1.0


@register("keyword_relevance", f"""
WITH h AS (SELECT doc_id, {', '.join(f"regexp_matches(lower(text), '(^|[^a-z0-9]){w}([^a-z0-9]|$)') AS m_{w}" for w in TERMS)} FROM documents),
s AS (SELECT doc_id, round({' + '.join(f"CASE WHEN m_{w} THEN {v} ELSE 0 END" for w, v in TERMS.items())}, 3)::DOUBLE AS score,
concat_ws(';', {', '.join(f"CASE WHEN m_{w} THEN '{w}' END" for w in TERMS)}) AS terms FROM h)
SELECT doc_id, score, terms FROM s WHERE score >= {LEAST_RELEVANCE}""")
def keyword_relevance(spark: SparkSession, d: str) -> DataFrame:
    low = spread(t(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.lower("text").alias("low"))
    hits = low.select("doc_id", *[F.rlike("low", F.lit(f"(^|[^a-z0-9]){w}([^a-z0-9]|$)")).alias(f"m_{w}") for w in TERMS])
    score = sum((F.when(F.col(f"m_{w}"), v).otherwise(0.0) for w, v in TERMS.items()), F.lit(0.0))
    terms = F.concat_ws(";", *[F.when(F.col(f"m_{w}"), w) for w in TERMS])
    return hits.select("doc_id", F.round(score, 3).alias("score"), terms.alias("terms")).where(F.col("score") >= LEAST_RELEVANCE)


_KEY_SQL = """trim(regexp_replace(regexp_replace(trim(regexp_replace(' ' || trim(regexp_replace(replace(lower({c}), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) || ' ',
' (?:incorporated|inc|corporation|corp|company|co|limited|ltd|llc|plc|ag|sa|nv) ', ' ', 'g')), '^(?:the|a|an) ', ''), ' +', ' ', 'g'))"""


@register("object_key", f"""
SELECT 'part' AS kind, p_partkey AS id, {_KEY_SQL.format(c="p_name || ' & Co'")} AS key FROM part
UNION ALL SELECT 'supplier', s_suppkey, {_KEY_SQL.format(c="'The ' || s_name || ' Corp.'")} FROM supplier""")
def object_key(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), X.object_key(F.concat("p_name", F.lit(" & Co"))).alias("key"))
    b = t(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), X.object_key(F.concat(F.lit("The "), "s_name", F.lit(" Corp."))).alias("key"))
    return a.unionByName(b)


@register("stable_ids", "SELECT l_orderkey, l_linenumber, 'rel:' || sha256(concat_ws('|', l_orderkey, l_linenumber, l_returnflag))[1:16] AS id FROM lineitem")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    keys = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_returnflag")]
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.stable_id("rel:", 16, *keys).alias("id"))


@register("url_canonical", """
WITH u AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^(?:www\\.|m\\.)', '') AS host,
regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT list_contains(['utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid'], string_split(p, '=')[1]))) AS pairs FROM pages)
SELECT page_id, host || path || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END AS url FROM u""")
def url_canonical(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", X.url_canonical(F.col("url")).alias("url"))


@register("html_links", """SELECT page_id, position::INTEGER AS position, link FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS position
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", F.posexplode(X.html_links(F.col("html"))).alias("position", "link"))


def _strip(c: str) -> str:
    for tag in ("script", "style", "head", "header", "footer", "nav"):
        c = f"regexp_replace({c}, '(?is)<{tag}[ >].*?</{tag}>', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({c}, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


@register("html_text", f"SELECT page_id, {_strip('html')} AS text FROM pages")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", X.html_text(F.col("html")).alias("text"))


@register("paragraphs", """
WITH p AS (SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS place FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
SELECT doc_id, place::INTEGER AS place, length(text)::INTEGER AS size, (row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1)::INTEGER AS passage
FROM p WHERE length(text) >= 80""")
def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "text")).where(F.length("text") >= 80)
    passage = F.row_number().over(Window.partitionBy("doc_id").orderBy("place")) - 1
    return rows.select("doc_id", "place", F.length("text").alias("size"), passage.alias("passage"))


@register("lang_stats", """
SELECT lang, count(*) AS docs, sum(length(text))::BIGINT AS chars, sum(length(regexp_replace(text, '[^A-Za-z]', '', 'g')))::BIGINT AS ascii_letters,
sum(length(text) - length(replace(text, '|', '')))::BIGINT AS bars FROM documents GROUP BY 1""")
def lang_stats(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).alias("chars"),
        F.sum(F.length(F.regexp_replace("text", "[^A-Za-z]", ""))).alias("ascii_letters"),
        F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit("|"), F.lit("")))).alias("bars"))


@register("transcript_quality", """
SELECT conv_id, count(*) AS turns, count(DISTINCT role) AS roles, sum(length(text))::BIGINT AS chars,
count(*) - count(DISTINCT text) AS repeated, max(length(text))::INTEGER AS longest FROM conversations GROUP BY 1""")
def transcript_quality(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.countDistinct("role").alias("roles"), F.sum(F.length("text")).alias("chars"),
        (F.count(F.lit(1)) - F.countDistinct("text")).alias("repeated"), F.max(F.length("text")).alias("longest"))


@register("json_predicate", """
SELECT event_type, count(*) AS events, count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0) AS even,
max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS top FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1""")
def json_predicate(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).where("k IS NOT NULL")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("k") % 2 == 0).alias("even"), F.max("k").alias("top"))


_BM25_SQL = """
w AS (SELECT doc_id AS chunk_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w), q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark),
tf AS (SELECT chunk_id, len, term, count(*) AS tf FROM (SELECT chunk_id, len(w) AS len, unnest(w) AS term FROM w) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
s AS (SELECT query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean))), 6) AS score
FROM tf JOIN df USING (term) JOIN q USING (term), n GROUP BY 1, 2),
lex AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM s)"""


def _lexical(spark: SparkSession, d: str) -> DataFrame:
    chunks = spread(t(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text"))
    queries = t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    scores = V.bm25(chunks, queries).withColumn("score", F.round("score", 6))
    return V.ranked(scores, F.col("score"))


@register("bm25_search", f"WITH {_BM25_SQL} SELECT query_id, chunk_id, rank::INTEGER AS rank, round(score, 4) AS score FROM lex WHERE rank <= 5")
def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    return _lexical(spark, d).where("rank <= 5").select("query_id", "chunk_id", "rank", F.round("score", 4).alias("score"))


@register("rrf_fusion", f"""
WITH {_BM25_SQL}, cov AS (SELECT query_id, chunk_id, count(*) AS c FROM tf JOIN q USING (term) GROUP BY 1, 2),
b AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, chunk_id) AS rank FROM cov),
u AS (SELECT query_id, chunk_id, rank FROM lex WHERE rank <= 50 UNION ALL SELECT * FROM b WHERE rank <= 50),
f AS (SELECT query_id, chunk_id, round(sum(1.0 / (30 + rank)), 9)::DOUBLE AS fused FROM u GROUP BY 1, 2)
SELECT query_id, chunk_id, fused, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, chunk_id) AS rank FROM f) WHERE rank <= 5""")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    chunks = t(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.explode(F.array_distinct(X.tokens(F.col("text")))).alias("term"))
    terms = t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(F.array_distinct(X.tokens(F.col("text")))).alias("term"))
    cover = chunks.join(terms, "term").groupBy("query_id", "chunk_id").agg(F.count(F.lit(1)).alias("c"))
    lists = [x.where("rank <= 50").select("query_id", "chunk_id", "rank") for x in (_lexical(spark, d), V.ranked(cover, F.col("c")))]
    fused = V.reciprocal_rank_fusion(lists).withColumn("fused", F.round("fused", 9))
    return V.ranked(fused, F.col("fused")).where("rank <= 5").select("query_id", "chunk_id", "fused", "rank")


@register("hit_at_k", f"""
WITH {_BM25_SQL}, hit AS (SELECT query_id, min(rank) AS first FROM lex JOIN benchmark b ON query_id = item_id JOIN documents d ON d.doc_id = chunk_id
WHERE contains(d.text, b.text) GROUP BY 1)
SELECT count(*) AS queries, count(first) AS found, count(*) FILTER (WHERE first <= 1) AS at_1, count(*) FILTER (WHERE first <= 8) AS at_8 FROM benchmark LEFT JOIN hit ON query_id = item_id""")
def hit_at_k(spark: SparkSession, d: str) -> DataFrame:
    bench = t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("asked"))
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    hits = _lexical(spark, d).join(bench, "query_id").join(docs, "chunk_id").where(F.contains("text", "asked"))
    first = hits.groupBy("query_id").agg(F.min("rank").alias("first"))
    return bench.join(first, "query_id", "left").agg(
        F.count(F.lit(1)).alias("queries"), F.count("first").alias("found"), F.count_if(F.col("first") <= 1).alias("at_1"), F.count_if(F.col("first") <= 8).alias("at_8"))


_COSINE_SQL = """
v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id, list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) AS cosine
FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id JOIN v a ON a.vec_id = x.vec_id JOIN v b ON b.vec_id = y.vec_id)"""


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "embeddings").select("label", "vec_id", "embedding")


@register("vector_pairs", f"WITH {_COSINE_SQL} SELECT left_id, right_id, round(cosine, 6) AS cosine FROM p WHERE cosine >= 0.3")
def vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    return V.similar_pairs(_vectors(spark, d), "label", "vec_id", "embedding", 0.3).withColumn("cosine", F.round("cosine", 6))


@register("vector_clusters", f"""
WITH RECURSIVE {_COSINE_SQL}, e AS (SELECT left_id AS a, right_id AS b FROM p WHERE cosine >= 0.35 UNION SELECT right_id, left_id FROM p WHERE cosine >= 0.35),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a)
SELECT node, min(root) AS root FROM r GROUP BY 1""")
def vector_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Copies of a vector hang on the one with the smallest id, which alone is compared."""
    rows = _vectors(spark, d)
    heads = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("head"))
    near = V.similar_pairs(heads, "label", "head", "embedding", 0.35).select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    copies = rows.join(heads, ["label", "embedding"]).where((F.col("head") < F.col("vec_id")) & (V.cosine(F.col("embedding"), F.col("embedding")) >= 0.35))
    return components(materialised(near.unionByName(copies.select(F.col("head").alias("a"), F.col("vec_id").alias("b"))), "near"))


@register("lsh_candidates")
def lsh_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that share a band of hyperplane signs, with their exact cosine."""
    rows = t(spark, d, "embeddings").select("vec_id", "embedding")
    bands = rows.select("vec_id", F.explode(V.hyperplane_bands(F.col("embedding"), 64, 8, 10)).alias("band"))
    pairs = bands.join(bands.select("band", F.col("vec_id").alias("right_id")), "band").where(F.col("vec_id") < F.col("right_id")).select("vec_id", "right_id").distinct()
    a = rows.select("vec_id", F.col("embedding").alias("x"))
    b = rows.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("y"))
    return pairs.join(a, "vec_id").join(b, "right_id").select(F.col("vec_id").alias("left_id"), "right_id", F.round(V.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))


@register("contains_join", """
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(regexp_replace(lower(d.text), '[^a-z0-9]+', ' ', 'g'), regexp_replace(lower(b.text), '[^a-z0-9]+', ' ', 'g'))""")
def contains_join(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages inside documents, part of a word at either end included."""
    return V.containing(t(spark, d, "benchmark").select("item_id", "text"), spread(t(spark, d, "documents").select("doc_id", "text")), "item_id", "doc_id")
