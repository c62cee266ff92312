"""Graph, incremental, evaluation and relation-grading queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.operators import evaluate as E
from tidegraph.operators import graph as G
from tidegraph.operators import incremental as I
from tidegraph.operators import relations as L
from tidegraph.plans.registry import register
from tidegraph.plans.relational import EVIDENCE_SQL, evidence
from tidegraph.session import table as t

#: Nation flows are edges when at least so many lines run from a supplier's to a customer's nation.
FLOW = 20
_FLOW_SQL = f"""flows AS (SELECT s_nationkey AS a, c_nationkey AS b, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 40 AND s_nationkey <> c_nationkey GROUP BY 1, 2 HAVING count(*) >= {FLOW})"""


def flows(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").where("l_quantity >= 40").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.where("s_nationkey <> c_nationkey").groupBy(F.col("s_nationkey").alias("a"), F.col("c_nationkey").alias("b"))
    return rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FLOW)


@register("bfs_expand", f"""
WITH {_FLOW_SQL}, u AS (SELECT a, b, n FROM flows UNION ALL SELECT b, a, n FROM flows), d0 AS (SELECT 0 AS node),
c1 AS (SELECT b, a, n, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS r FROM u WHERE a = 0 AND b <> 0),
d1 AS (SELECT b AS node, a AS parent FROM c1 WHERE r = 1 ORDER BY n DESC, a, b LIMIT 7),
c2 AS (SELECT b, a, n, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS r FROM u WHERE a IN (SELECT node FROM d1) AND b <> 0 AND b NOT IN (SELECT node FROM d1)),
d2 AS (SELECT b AS node, a AS parent FROM c2 WHERE r = 1 ORDER BY n DESC, a, b LIMIT (7 - (SELECT count(*) FROM d1)))
SELECT node, 0 AS depth, CAST(NULL AS INTEGER) AS parent FROM d0 UNION ALL SELECT node, 1, parent FROM d1 UNION ALL SELECT node, 2, parent FROM d2""")
def bfs_expand(spark: SparkSession, d: str) -> DataFrame:
    seeds = spark.range(1).select(F.col("id").cast("int").alias("node"))
    return G.expand(flows(spark, d), seeds, 2, 8, [F.desc("n")])


@register("induced_subgraph", f"WITH {_FLOW_SQL} SELECT a, b, n FROM flows WHERE a IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 1) AND b IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 1)")
def induced_subgraph(spark: SparkSession, d: str) -> DataFrame:
    return G.induced(flows(spark, d), t(spark, d, "nation").where("n_regionkey <= 1").select(F.col("n_nationkey").alias("node"))).select("a", "b", "n")


@register("node_metrics", f"""
WITH {_FLOW_SQL}, e AS (SELECT a AS node, b AS other, 1 AS o, 0 AS i, n FROM flows UNION ALL SELECT b, a, 0, 1, n FROM flows)
SELECT node, count(DISTINCT other) AS degree, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, sum(n)::BIGINT AS weight FROM e GROUP BY 1""")
def node_metrics(spark: SparkSession, d: str) -> DataFrame:
    return G.node_metrics(flows(spark, d), "n")


@register("document_components", """
WITH RECURSIVE w AS (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents), k AS (SELECT doc_id, 'h' || array_to_string(w[1:4], ' ') AS b FROM w UNION ALL SELECT doc_id, 't' || array_to_string(w[-4:], ' ') FROM w),
h AS (SELECT b, min(doc_id) AS low FROM k GROUP BY 1 HAVING count(*) > 1), e AS (SELECT DISTINCT low AS a, doc_id AS b FROM k JOIN h USING (b)), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS root FROM u UNION SELECT u.b, r.root FROM r JOIN u ON r.node = u.a) SELECT node, min(root) AS root FROM r GROUP BY 1""")
def document_components(spark: SparkSession, d: str) -> DataFrame:
    """Documents that begin or end alike are linked, each to the first of its kind; links of both kinds chain."""
    w = t(spark, d, "documents").select("doc_id", F.split(F.lower("text"), " ").alias("w"))
    head, tail = F.slice("w", 1, 4), F.slice("w", F.greatest(F.size("w") - 3, F.lit(1)), F.lit(4))
    keys = F.array(F.concat(F.lit("h"), F.array_join(head, " ")), F.concat(F.lit("t"), F.array_join(tail, " ")))
    rows = w.select("doc_id", F.explode(keys).alias("b"))
    first = rows.groupBy("b").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return G.components(rows.join(first, "b").select("a", F.col("doc_id").alias("b")))


@register("due_queue", """
WITH s AS (SELECT user_id, count(*) AS attempts, max(ts) AS failed_at FROM events WHERE event_type = 'error' GROUP BY 1), n AS (SELECT max(ts) AS now FROM events),
q AS (SELECT user_id, attempts, CASE WHEN attempts < 6 THEN failed_at + to_minutes(CAST(5 * power(2, least(attempts, 6) - 1) AS INTEGER)) END AS next_at, now FROM s, n)
SELECT user_id, attempts, next_at IS NOT NULL AND next_at <= now AS due, next_at IS NULL AS exhausted FROM q""")
def due_queue(spark: SparkSession, d: str) -> DataFrame:
    events = t(spark, d, "events")
    now = events.agg(F.max("ts").alias("now"))
    s = events.where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("attempts"), F.max("ts").alias("failed_at"))
    rows = s.join(F.broadcast(now)).withColumn("next_at", I.next_attempt(F.col("attempts"), F.col("failed_at")))  # now is one row
    return rows.select("user_id", "attempts", (F.col("next_at").isNotNull() & (F.col("next_at") <= F.col("now"))).alias("due"), F.col("next_at").isNull().alias("exhausted"))


@register("source_health", """
WITH n AS (SELECT max(ts) AS now FROM events), s AS (SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS errors, max(ts) AS latest FROM events GROUP BY 1)
SELECT user_id, CASE WHEN total = 0 THEN 'missing' WHEN epoch(now) - epoch(latest) > 60 * 1440 THEN 'stale' WHEN errors / total > 0.4 THEN 'failing'
WHEN errors / total > 0.2 THEN 'degraded' ELSE 'healthy' END AS status FROM s, n""")
def source_health(spark: SparkSession, d: str) -> DataFrame:
    events = t(spark, d, "events")
    now = events.agg(F.max("ts").alias("now"))
    s = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("ts").alias("latest"))
    age = (F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / 60e6
    return s.join(F.broadcast(now)).select("user_id", I.health(F.col("errors"), F.col("total"), age, 1440, 0.2).alias("status"))


@register("window_counts", """
SELECT make_timestamp((epoch_us(ts) // 86400000000) * 86400000000)::DATE AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def window_counts(spark: SparkSession, d: str) -> DataFrame:
    day = I.window_floor(F.col("ts"), 24).cast("date")
    return t(spark, d, "events").groupBy(day.alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@register("event_dedup", """
SELECT DISTINCT user_id || ':' || event_type AS event_key FROM events WHERE ts >= TIMESTAMP '2024-01-03'
EXCEPT SELECT user_id || ':' || event_type FROM events WHERE ts < TIMESTAMP '2024-01-03'""")
def event_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = F.lit("2024-01-03").cast("timestamp_ntz")
    rows = t(spark, d, "events").select("ts", F.concat_ws(":", "user_id", "event_type").alias("event_key"))
    return I.unseen(rows.where(F.col("ts") >= cut).select("event_key"), rows.where(F.col("ts") < cut), "event_key")


@register("soft_delete", """
WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-04' AND event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-27' AND event_type = 'purchase')
SELECT coalesce(a.user_id, b.user_id) AS user_id, b.user_id IS NOT NULL AS is_active, a.user_id IS NULL AS is_new FROM a FULL JOIN b ON a.user_id = b.user_id""")
def soft_delete(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").where("event_type = 'purchase'")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return I.soft_delete(rows.where(F.col("ts") < at("2024-01-04")), rows.where(F.col("ts") >= at("2024-01-27")), "user_id")


@register("daily_budget", """
SELECT event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 100 AS granted FROM events""")
def daily_budget(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"))
    return I.apply_budget(rows, "day", [F.col("ts"), F.col("event_id")], 100).select("event_id", "granted")


_RATED = "SELECT lang, quality = 0 AS gold, length(text) - length(translate(text, '#*$%&|<>', '')) > 0 AS predicted FROM documents JOIN labels USING (doc_id)"


def _rated(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id")
    symbols = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    return rows.select("doc_id", "lang", (F.col("quality") == 0).alias("gold"), (symbols > 0).alias("predicted"))


@register("prf_by_language", f"""
WITH c AS (SELECT lang, count(*) FILTER (WHERE gold AND predicted) AS tp, count(*) FILTER (WHERE NOT gold AND predicted) AS fp, count(*) FILTER (WHERE gold AND NOT predicted) AS fn FROM ({_RATED}) GROUP BY 1)
SELECT lang, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM c""")
def prf_by_language(spark: SparkSession, d: str) -> DataFrame:
    return E.precision_recall(_rated(spark, d), F.col("gold"), F.col("predicted"), ["lang"])


@register("multiset_overlap", """
WITH g AS (SELECT l_suppkey k, count(*) n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), p AS (SELECT l_suppkey k, count(*) n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT sum(g.n)::BIGINT AS gold, sum(p.n)::BIGINT AS predicted, sum(least(coalesce(g.n, 0), coalesce(p.n, 0)))::BIGINT AS matched FROM g FULL JOIN p ON g.k = p.k""")
def multiset_overlap(spark: SparkSession, d: str) -> DataFrame:
    line = t(spark, d, "lineitem")
    return E.multiset_overlap(line.where("l_returnflag = 'A'"), line.where("l_returnflag = 'R'"), "l_suppkey")


@register("weighted_rate", f"""
WITH w AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), m AS (SELECT lang, avg(CASE WHEN gold THEN 1.0::DOUBLE ELSE 0.0 END) AS m FROM ({_RATED}) GROUP BY 1)
SELECT round(sum(n * m) / sum(n), 9) AS rate, count(*) AS strata FROM w JOIN m USING (lang)""")
def weighted_rate(spark: SparkSession, d: str) -> DataFrame:
    sizes = t(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rows = _rated(spark, d).join(F.broadcast(sizes), "lang")  # a row for each language
    return E.weighted_rate(rows, "lang", "n", F.when(F.col("gold"), 1.0).otherwise(0.0)).withColumn("rate", F.round("rate", 9))


@register("interpolated_percentile", "SELECT lang, quantile_cont(n_chars, 0.5) AS median, round(quantile_cont(n_chars, 0.9), 6) AS p90 FROM documents GROUP BY 1")
def interpolated_percentile(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").groupBy("lang").agg(F.percentile("n_chars", 0.5).alias("median"), F.round(F.percentile("n_chars", 0.9), 6).alias("p90"))


@register("bootstrap_rates")
def bootstrap_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = _rated(spark, d).select("doc_id", "lang", F.col("gold").cast("int").alias("x"))
    return E.bootstrap(rows, "lang", "doc_id", "x", 200, 7).agg(
        F.round(F.percentile("rate", 0.025), 6).alias("low"), F.round(F.percentile("rate", 0.975), 6).alias("high"), F.count(F.lit(1)).alias("replicates"))


@register("quality_issues", """
SELECT doc_id, 'short' AS code, 'warn' AS severity FROM documents WHERE n_chars < 200 UNION ALL SELECT doc_id, 'symbols', 'error' FROM documents WHERE contains(text, '###')
UNION ALL SELECT doc_id, 'secret', 'error' FROM documents WHERE contains(text, 'token = "')""")
def quality_issues(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return E.issues(t(spark, d, "documents"), "doc_id", {
        "short": ("warn", F.col("n_chars") < 200), "symbols": ("error", F.contains(text, F.lit("###"))), "secret": ("error", F.contains(text, F.lit('token = "')))})


@register("evidence_gate", f"""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN subject = 'UNITED STATES' THEN 'self_reference' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'contradiction'
WHEN o_orderpriority = '5-LOW' THEN 'weak' ELSE 'kept' END AS reason FROM ({EVIDENCE_SQL})) GROUP BY 1""")
def evidence_gate(spark: SparkSession, d: str) -> DataFrame:
    reason = L.gate([
        ("self_reference", F.col("subject") == "UNITED STATES"), ("contradiction", (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")),
        ("weak", F.col("o_orderpriority") == "5-LOW")])
    return evidence(spark, d).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("relation_scores", """
SELECT l_orderkey, l_linenumber, round(greatest(0.0, least(1.0, 0.55::DOUBLE * (1 - l_discount) + 0.30::DOUBLE * (l_quantity / 50) + CASE WHEN l_returnflag = 'N' THEN 0.1::DOUBLE ELSE 0.0 END
+ CASE WHEN l_linestatus = 'O' THEN -0.05::DOUBLE ELSE 0.0 END)), 9) AS score,
concat_ws(';', CASE WHEN l_tax >= 0.06 THEN 'costly' END, CASE WHEN l_quantity < 5 THEN 'small' END) AS flags,
CASE WHEN l_returnflag = 'R' THEN 'p' || l_partkey ELSE 's' || l_suppkey END AS source, CASE WHEN l_returnflag = 'R' THEN 's' || l_suppkey ELSE 'p' || l_partkey END AS target FROM lineitem""")
def relation_scores(spark: SparkSession, d: str) -> DataFrame:
    s, p = F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    score = L.quality_score(1 - F.col("l_discount"), F.col("l_quantity") / 50, [(F.col("l_returnflag") == "N", 0.1), (F.col("l_linestatus") == "O", -0.05)], 9)
    source, target = L.orient(s, p, F.col("l_returnflag") == "R")
    flags = L.flags({"costly": F.col("l_tax") >= 0.06, "small": F.col("l_quantity") < 5})
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", score.alias("score"), flags.alias("flags"), source.alias("source"), target.alias("target"))


@register("canonical_merge", f"""
SELECT subject, object, count(*) AS evidence, count(DISTINCT o_orderkey) AS filings, min(seen) AS first_seen, max(seen) AS last_seen,
count(DISTINCT o_orderkey) >= 2 AND min(length(o_orderpriority)) >= 5 AS verified FROM ({EVIDENCE_SQL}) GROUP BY 1, 2""")
def canonical_merge(spark: SparkSession, d: str) -> DataFrame:
    return L.canonical_merge(evidence(spark, d), ["subject", "object"], F.length("o_orderpriority"), F.col("o_orderkey"), F.col("seen"), 5)
