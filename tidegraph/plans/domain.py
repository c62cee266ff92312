"""Queue, review, mining and passage queries on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.operators import extraction as E
from tidegraph.operators import passages as P
from tidegraph.operators import relational as R
from tidegraph.plans.registry import register
from tidegraph.plans.relational import EVIDENCE_SQL, evidence
from tidegraph.session import table as t

def _n():
    return F.count(F.lit(1))


@register("universe_filter", """
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey IN (1, 3, 5, 7, 9, 11) AND s_acctbal > 0 ORDER BY s_nationkey, s_suppkey LIMIT 20""")
def universe_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "supplier").where(F.col("s_nationkey").isin(1, 3, 5, 7, 9, 11) & (F.col("s_acctbal") > 0))
    return rows.select("s_suppkey", "s_name", "s_nationkey").orderBy("s_nationkey", "s_suppkey").limit(20)


@register("any_column_search", """
SELECT p_partkey FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type, CAST(p_size AS VARCHAR))), '12')""")
def any_column_search(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").where(F.contains(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))), F.lit("12"))).select("p_partkey")


@register("type_mapping", """
WITH m(mode, pattern, canonical, place) AS (VALUES ('exact', 'signup', 'registration', 1), ('prefix', 'pur', 'transaction', 2), ('contains', 'ick', 'interaction', 3), ('contains', 'i', 'other', 4)),
h AS (SELECT event_id, canonical, row_number() OVER (PARTITION BY event_id ORDER BY place) AS r FROM events JOIN m ON
(mode = 'exact' AND event_type = pattern) OR (mode = 'prefix' AND starts_with(event_type, pattern)) OR (mode = 'contains' AND contains(event_type, pattern)))
SELECT e.event_id, coalesce(canonical, 'unknown') AS canonical FROM events e LEFT JOIN h ON e.event_id = h.event_id AND r = 1""")
def type_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The mapping is a parameter of a few rows, so it becomes one expression instead of a join."""
    kind, out = F.col("event_type"), F.lit("unknown")
    rules = [(kind == "signup", "registration"), (F.startswith(kind, F.lit("pur")), "transaction"), (F.contains(kind, F.lit("ick")), "interaction"), (F.contains(kind, F.lit("i")), "other")]
    for hit, name in reversed(rules):
        out = F.when(hit, name).otherwise(out)
    return t(spark, d, "events").select("event_id", out.alias("canonical"))


@register("fallback_filter", """
WITH f AS (SELECT o_custkey, o_orderkey, o_orderpriority = '1-URGENT' AS hit FROM orders)
SELECT o_custkey, o_orderkey FROM (SELECT *, bool_or(hit) OVER (PARTITION BY o_custkey) AS hits FROM f) WHERE hit OR NOT hits""")
def fallback_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("hit"))
    return rows.withColumn("hits", F.bool_or("hit").over(Window.partitionBy("o_custkey"))).where("hit OR NOT hits").select("o_custkey", "o_orderkey")


@register("fallback_key_join", """
WITH a AS (SELECT p_partkey, p_brand, p_size, p_type FROM part), e AS (SELECT p_partkey AS k, p_partkey AS hit FROM part WHERE p_partkey % 3 = 0),
b AS (SELECT p_brand, p_size, min(p_partkey) AS hit FROM part WHERE p_size > 25 GROUP BY 1, 2), c AS (SELECT p_brand, min(p_partkey) AS hit FROM part GROUP BY 1)
SELECT a.p_partkey, coalesce(e.hit, b.hit, c.hit) AS match, CASE WHEN e.hit IS NOT NULL THEN 'id' WHEN b.hit IS NOT NULL THEN 'fingerprint' ELSE 'brand' END AS how
FROM a LEFT JOIN e ON e.k = a.p_partkey LEFT JOIN b ON b.p_brand = a.p_brand AND b.p_size = a.p_size LEFT JOIN c ON c.p_brand = a.p_brand""")
def fallback_key_join(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    e = part.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_partkey").alias("e"))
    b = part.where("p_size > 25").groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("b"))
    c = part.groupBy("p_brand").agg(F.min("p_partkey").alias("c"))
    rows = part.join(e, "p_partkey", "left").join(b, ["p_brand", "p_size"], "left").join(c, "p_brand", "left")
    how = F.when(F.col("e").isNotNull(), "id").when(F.col("b").isNotNull(), "fingerprint").otherwise("brand")
    return rows.select("p_partkey", F.coalesce("e", "b", "c").alias("match"), how.alias("how"))


@register("nearest_antecedent", """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), c AS (SELECT event_id AS click_id, user_id, ts FROM events WHERE event_type = 'click')
SELECT p.event_id, (SELECT max_by(click_id, (c.ts, click_id)) FROM c WHERE c.user_id = p.user_id AND c.ts <= p.ts) AS click_id FROM p""")
def nearest_antecedent(spark: SparkSession, d: str) -> DataFrame:
    """The last click before each purchase, by one window over both instead of a range join."""
    rows = t(spark, d, "events").where(F.col("event_type").isin("purchase", "click"))
    click = F.when(F.col("event_type") == "click", F.col("event_id"))
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == "click", 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("click_id", F.last(click, ignorenulls=True).over(w)).where("event_type = 'purchase'").select("event_id", "click_id")


@register("multi_map_join", """
SELECT DISTINCT l_orderkey, l_linenumber, kind FROM (SELECT l_orderkey, l_linenumber, o_orderstatus AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT l_orderkey, l_linenumber, 'legacy' FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7)""")
def multi_map_join(spark: SparkSession, d: str) -> DataFrame:
    line = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    a = line.join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", F.col("o_orderstatus").alias("kind"))
    b = line.join(t(spark, d, "part").where("p_size = 7"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", F.lit("legacy").alias("kind"))
    return a.unionByName(b).distinct()


@register("explode_join", """
WITH r AS (SELECT o_custkey, unnest(list_sort(list(o_orderkey))[1:3]) AS k FROM orders GROUP BY 1)
SELECT o_custkey, k AS o_orderkey, count(*) AS lines FROM r JOIN lineitem ON l_orderkey = k GROUP BY 1, 2""")
def explode_join(spark: SparkSession, d: str) -> DataFrame:
    ids = t(spark, d, "orders").groupBy("o_custkey").agg(F.slice(F.array_sort(F.collect_set("o_orderkey")), 1, 3).alias("ids"))
    rows = ids.select("o_custkey", F.explode("ids").alias("o_orderkey"))
    return rows.join(t(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "o_orderkey").agg(_n().alias("lines"))


@register("object_contexts", f"""
WITH c AS (SELECT object, subject, count(*) AS n FROM ({EVIDENCE_SQL}) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY object ORDER BY n DESC, subject) AS r FROM c)
SELECT object, sum(n)::BIGINT AS evidence, string_agg(subject, ';' ORDER BY r) FILTER (WHERE r <= 12) AS subjects FROM r GROUP BY 1""")
def object_contexts(spark: SparkSession, d: str) -> DataFrame:
    counts = evidence(spark, d).groupBy("object", "subject").agg(_n().alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "subject")))  # a subject is a nation
    return counts.groupBy("object").agg(F.sum("n").alias("evidence"), F.array_join(F.transform(F.slice(ranked, 1, 12), lambda x: x["subject"]), ";").alias("subjects"))


@register("resolution_records", f"""
SELECT object, count(*) AS evidence, count(DISTINCT o_orderkey) AS filings, count(DISTINCT l_returnflag) AS kinds, count(DISTINCT subject) AS issuers,
2 * count(*) + 3 * count(DISTINCT o_orderkey) + 2 * count(DISTINCT l_returnflag) + count(DISTINCT subject) AS priority FROM ({EVIDENCE_SQL}) GROUP BY 1""")
def resolution_records(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence(spark, d).groupBy("object").agg(
        _n().alias("evidence"), F.countDistinct("o_orderkey").alias("filings"), F.countDistinct("l_returnflag").alias("kinds"), F.countDistinct("subject").alias("issuers"))
    return rows.withColumn("priority", 2 * F.col("evidence") + 3 * F.col("filings") + 2 * F.col("kinds") + F.col("issuers"))


@register("language_summary", """
SELECT lang, CAST(GROUPING(lang) AS INTEGER) AS whole, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((), (lang))""")
def language_summary(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").rollup("lang").agg(F.grouping("lang").cast("int").alias("whole"), _n().alias("docs"), F.sum("n_chars").alias("chars"))


@register("success_at_k", """
WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events), f AS (SELECT user_id, min(r) FILTER (WHERE event_type = 'purchase') AS first FROM r GROUP BY 1)
SELECT count(*) AS users, count(*) FILTER (WHERE first <= 1) AS at_1, count(*) FILTER (WHERE first <= 3) AS at_3, count(*) FILTER (WHERE first <= 5) AS at_5 FROM f""")
def success_at_k(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = t(spark, d, "events").withColumn("r", place).groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "purchase", F.col("r"))).alias("first"))
    return rows.agg(_n().alias("users"), *[F.count_if(F.col("first") <= k).alias(f"at_{k}") for k in (1, 3, 5)])


_MINED_SQL = """features AS (SELECT doc_id, quality, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{2,}'))) AS feature FROM documents JOIN labels USING (doc_id)),
rules AS (SELECT feature, count(*) AS total, sum(1 - quality)::BIGINT AS support, sum(1 - quality) / count(*) AS precision FROM features GROUP BY 1 HAVING count(*) >= 20 AND sum(1 - quality) >= 5)"""


def _features(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select("doc_id", "text").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return rows.select("doc_id", "quality", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0)))).alias("feature"))


def _rules(features: DataFrame) -> DataFrame:
    rows = features.groupBy("feature").agg(_n().alias("total"), F.sum((1 - F.col("quality")).cast("long")).alias("support"))
    return rows.where("total >= 20 AND support >= 5").withColumn("precision", F.col("support") / F.col("total"))


@register("rule_mining", f"WITH {_MINED_SQL} SELECT feature, total, support, precision FROM rules")
def rule_mining(spark: SparkSession, d: str) -> DataFrame:
    return _rules(_features(spark, d)).select("feature", "total", "support", "precision")


@register("rule_prediction", f"""
WITH {_MINED_SQL}, r AS (SELECT doc_id, feature, precision, row_number() OVER (PARTITION BY doc_id ORDER BY precision DESC, support DESC, total, feature) AS r FROM features JOIN rules USING (feature))
SELECT doc_id, feature, precision FROM r WHERE r = 1""")
def rule_prediction(spark: SparkSession, d: str) -> DataFrame:
    features = _features(spark, d)
    rows = features.join(_rules(features), "feature").select("doc_id", "feature", "precision", "support", "total")
    return R.keep_first(rows, ["doc_id"], [-F.col("precision"), -F.col("support"), F.col("total"), F.col("feature")]).select("doc_id", "feature", "precision")


@register("job_grid", """
SELECT n_nationkey, q.year::INTEGER AS year, q.quarter::INTEGER AS quarter, row_number() OVER (PARTITION BY n_nationkey ORDER BY q.year DESC, q.quarter DESC)::INTEGER AS place
FROM nation, (SELECT DISTINCT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter FROM orders) q""")
def job_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every nation in every quarter: the grid is the result, and both sides are small dimensions."""
    periods = t(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).distinct()
    all_ = periods.agg(F.array_sort(F.collect_set(F.struct("year", "quarter"))).alias("p"))  # a few dozen quarters
    grid = t(spark, d, "nation").select("n_nationkey", F.lit(1).alias("one")).join(F.broadcast(all_.withColumn("one", F.lit(1))), "one")
    return grid.select("n_nationkey", F.posexplode(F.reverse("p")).alias("at", "x")).select("n_nationkey", "x.year", "x.quarter", (F.col("at") + 1).alias("place"))


@register("duplicate_lines", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), g AS (SELECT doc_id, line, count(*) AS n FROM l WHERE trim(line) <> '' GROUP BY 1, 2)
SELECT doc_id, sum(n)::BIGINT AS lines, sum(n - 1)::BIGINT AS repeated, sum((n - 1) * length(line))::BIGINT AS repeated_chars FROM g GROUP BY 1""")
def duplicate_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    rows = lines.groupBy("doc_id", "line").agg(_n().alias("n"))
    return rows.groupBy("doc_id").agg(F.sum("n").alias("lines"), F.sum(F.col("n") - 1).alias("repeated"), F.sum((F.col("n") - 1) * F.length("line")).alias("repeated_chars"))


@register("round_robin_sample", """
WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('x' || CAST(c_custkey AS VARCHAR))) AS r FROM customer)
SELECT c_custkey, c_mktsegment FROM r ORDER BY r, c_mktsegment LIMIT 23""")
def round_robin_sample(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.sha2(F.concat(F.lit("x"), F.col("c_custkey").cast("string")), 256)))
    return t(spark, d, "customer").select("c_custkey", "c_mktsegment", place.alias("r")).orderBy("r", "c_mktsegment").limit(23).drop("r")


@register("lookback_window", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY")
def lookback_window(spark: SparkSession, d: str) -> DataFrame:
    events = t(spark, d, "events")
    newest = events.agg((F.max("ts") - F.expr("INTERVAL 2 DAYS")).alias("since"))
    return events.join(F.broadcast(newest), F.col("ts") >= F.col("since")).select("event_id")  # one row


@register("expired_leases", """
WITH s AS (SELECT user_id, max(ts) AS beat, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT user_id, errors >= 10 AS exhausted FROM s WHERE beat < (SELECT max(ts) FROM events) - INTERVAL 12 HOUR""")
def expired_leases(spark: SparkSession, d: str) -> DataFrame:
    events = t(spark, d, "events")
    s = events.groupBy("user_id").agg(F.max("ts").alias("beat"), F.count_if(F.col("event_type") == "error").alias("errors"))
    now = events.agg((F.max("ts") - F.expr("INTERVAL 12 HOURS")).alias("limit"))
    return s.join(F.broadcast(now), F.col("beat") < F.col("limit")).select("user_id", (F.col("errors") >= 10).alias("exhausted"))  # one row


@register("number_parsing", """
SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2))::DOUBLE * CASE WHEN p_size % 2 = 0 THEN -1 ELSE 1 END AS value FROM part""")
def number_parsing(spark: SparkSession, d: str) -> DataFrame:
    from tidegraph.functions.text import parse_number

    shown = F.format_number(F.col("p_retailprice").cast("decimal(18,2)"), 2)
    text = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(F.concat(F.lit("$"), shown))
    return t(spark, d, "part").select("p_partkey", parse_number(text).cast("double").alias("value"))


@register("citation_check", """
WITH c AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[0-9]{4,}'))) AS id FROM documents), k AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders)
SELECT doc_id, count(*)::INTEGER AS cited, count(*) FILTER (WHERE k.id IS NULL)::INTEGER AS unknown FROM c LEFT JOIN k USING (id) GROUP BY 1""")
def citation_check(spark: SparkSession, d: str) -> DataFrame:
    """Numbers cited in documents that no order has: a left join on the exploded citations."""
    cited = t(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]{4,}"), F.lit(0)))).alias("id"))
    known = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lit(1).alias("hit")).distinct()
    rows = cited.join(known, "id", "left").groupBy("doc_id").agg(_n().cast("int").alias("cited"), F.count_if(F.col("hit").isNull()).cast("int").alias("unknown"))
    return rows


@register("name_candidates", """
WITH c AS (SELECT a.s_suppkey, b.s_suppkey AS other, levenshtein(a.s_name, b.s_name) AS distance FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey),
r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY distance, other) AS rank FROM c)
SELECT s_suppkey, other, distance::INTEGER AS distance, rank::INTEGER AS rank, CASE WHEN distance <= 1 THEN 'REVIEW' ELSE 'KEEP_UNRESOLVED' END AS decision FROM r WHERE rank <= 3""")
def name_candidates(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    b = a.select(F.col("s_suppkey").alias("other"), F.col("s_name").alias("name"), "s_nationkey")
    rows = a.join(b, "s_nationkey").where("s_suppkey <> other").withColumn("distance", F.levenshtein("s_name", "name"))
    top = R.top_per_group(rows, ["s_suppkey"], [F.col("distance"), F.col("other")], 3)
    return top.select("s_suppkey", "other", "distance", "rank", F.when(F.col("distance") <= 1, "REVIEW").otherwise("KEEP_UNRESOLVED").alias("decision"))


@register("packed_passages")
def packed_passages(spark: SparkSession, d: str) -> DataFrame:
    return P.passages(t(spark, d, "documents").select("doc_id", "text")).select("doc_id", "passage", F.length("body").alias("size"), F.sha2("body", 256).alias("digest"))


@register("overlapping_chunks", """
WITH RECURSIVE t AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
c AS (SELECT doc_id, 0 AS chunk, 0 AS b FROM t UNION ALL SELECT c.doc_id, chunk + 1, greatest(e - 240, b + 1) FROM c JOIN t USING (doc_id),
LATERAL (SELECT CASE WHEN b + 1800 >= n THEN n WHEN contains(substring(text, b + 901, 900), ' ') THEN b + 1800 - instr(reverse(substring(text, b + 901, 900)), ' ') ELSE b + 1800 END AS e) WHERE e < n),
x AS (SELECT doc_id, chunk, substring(text, b + 1, CASE WHEN b + 1800 >= n THEN n WHEN contains(substring(text, b + 901, 900), ' ') THEN b + 1800 - instr(reverse(substring(text, b + 901, 900)), ' ') ELSE b + 1800 END - b) AS body FROM c JOIN t USING (doc_id))
SELECT doc_id, chunk::INTEGER AS chunk, length(body)::INTEGER AS size, sha256(body) AS digest FROM x""")
def overlapping_chunks(spark: SparkSession, d: str) -> DataFrame:
    return P.chunks(t(spark, d, "documents").select("doc_id", "text")).select("doc_id", "chunk", F.length("body").alias("size"), F.sha2("body", 256).alias("digest"))


_ALIASES = ("GNU General Public License", "General Public License", "Apache License", "MIT License", "License", "token")


@register("alias_mentions", f"""
WITH x AS (SELECT doc_id, regexp_extract_all(text, '\\b(?:{'|'.join(_ALIASES)})\\b', 0) AS m, regexp_split_to_array(text, '\\b(?:{'|'.join(_ALIASES)})\\b') AS b FROM documents),
s AS (SELECT doc_id, unnest(list_transform(m, lambda w, i: {{'t': w, 'a': list_sum(list_transform(b[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0)}})) AS s FROM x)
SELECT doc_id, s.t AS mention, s.a::INTEGER AS start, (s.a + length(s.t))::INTEGER AS stop FROM s""")
def alias_mentions(spark: SparkSession, d: str) -> DataFrame:
    return E.alias_spans(t(spark, d, "documents").select("doc_id", "text"), _ALIASES)


@register("page_sections", """
WITH h AS (SELECT page_id, html, unnest(['head', 'body', 'footer']) AS section FROM pages), p AS (SELECT page_id, section, strpos(lower(html), '<' || section) - 1 AS start, length(html) AS n FROM h),
e AS (SELECT *, lead(start, 1, n) OVER (PARTITION BY page_id ORDER BY start) AS stop FROM p WHERE start >= 0) SELECT page_id, section, start::INTEGER AS start, (stop - start)::INTEGER AS size FROM e""")
def page_sections(spark: SparkSession, d: str) -> DataFrame:
    rows = P.sections(t(spark, d, "pages").select("page_id", "html"), {"head": r"(?i)<head", "body": r"(?i)<body", "footer": r"(?i)<footer"}, "html", most=None)
    return rows.select("page_id", "section", "start", F.length("body").alias("size"))
