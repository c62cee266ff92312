"""Joins, aggregates, windows, sorts and set operations on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.operators import relational as R
from tidegraph.plans.registry import register
from tidegraph.session import table as t


def _money(c: str):
    return F.col(c).cast("decimal(18,2)")


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """Customer nation depends on supplier, by return flag and line status."""
    line = t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("seen"))
    orders = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("subject"))
    supplier = t(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("object"))
    rows = line.join(orders, line["l_orderkey"] == orders["o_orderkey"]).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(nation, "c_nationkey").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))


EVIDENCE_SQL = """
SELECT n_name AS subject, s_name AS object, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS seen, o_orderpriority, o_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey
"""


@register("edge_aggregate", f"""
SELECT subject, object, l_returnflag AS relation_type, l_linestatus AS modality, min(seen) AS first_seen, max(seen) AS last_seen,
count(*) AS evidence_count, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS tags
FROM ({EVIDENCE_SQL}) GROUP BY ALL""")
def edge_aggregate(spark: SparkSession, d: str) -> DataFrame:
    rows = evidence(spark, d).withColumnsRenamed({"l_returnflag": "relation_type", "l_linestatus": "modality"})
    return R.edge_aggregate(rows, ["subject", "object", "relation_type", "modality"], F.col("seen"), F.col("o_orderpriority"))


@register("bottlenecks", f"""
WITH e AS (SELECT subject, object, l_returnflag AS kind, count(*) AS n FROM ({EVIDENCE_SQL}) GROUP BY ALL)
SELECT object, count(DISTINCT subject) AS subjects, CAST(sum(n) AS BIGINT) AS evidence, count(DISTINCT kind) AS kinds,
array_to_string(list_sort(list(DISTINCT subject))[1:12], ';') AS first_subjects
FROM e GROUP BY object HAVING count(DISTINCT subject) >= 2""")
def bottlenecks(spark: SparkSession, d: str) -> DataFrame:
    edges = evidence(spark, d).groupBy("subject", "object", F.col("l_returnflag").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return R.shared_objects(edges, "object", "subject", "n", "kind")


@register("coverage_counts", """
WITH c AS (SELECT c_nationkey k, count(*) n, count(*) FILTER (WHERE c_acctbal < 0) AS debtors FROM customer GROUP BY 1),
s AS (SELECT s_nationkey k, count(*) n FROM supplier GROUP BY 1),
o AS (SELECT c_nationkey k, count(*) n, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'O') AS open
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name AS nation, coalesce(c.n, 0) AS customers, coalesce(debtors, 0) AS debtors, coalesce(s.n, 0) AS suppliers,
coalesce(o.n, 0) AS orders, coalesce(done, 0) AS done, coalesce(open, 0) AS open
FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN s ON s.k = n_nationkey LEFT JOIN o ON o.k = n_nationkey""")
def coverage_counts(spark: SparkSession, d: str) -> DataFrame:
    customer, supplier, orders, nation = (t(spark, d, x) for x in ("customer", "supplier", "orders", "nation"))
    c = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("debtors"))
    s = supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    o = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "O").alias("open"))
    rows = nation.join(c, nation["n_nationkey"] == c["c_nationkey"], "left").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").join(o, F.col("n_nationkey") == F.col("k"), "left")
    names = ["customers", "debtors", "suppliers", "orders", "done", "open"]
    return rows.select(F.col("n_name").alias("nation"), *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names])


@register("issuer_latest", """
SELECT c_custkey, c_name, count(o_orderkey) AS orders, max(CAST(o_orderdate AS DATE)) AS latest
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def issuer_latest(spark: SparkSession, d: str) -> DataFrame:
    orders = t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max(F.col("o_orderdate").cast("date")).alias("latest"))
    rows = t(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", "c_name", F.coalesce("orders", F.lit(0).cast("long")).alias("orders"), "latest")


@register("semi_exists", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_exists(spark: SparkSession, d: str) -> DataFrame:
    done = t(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return t(spark, d, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@register("anti_unseen", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_unseen(spark: SparkSession, d: str) -> DataFrame:
    done = t(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return t(spark, d, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@register("snapshot_diff", """
WITH a AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2),
b AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type, a.n AS old, b.n AS new,
CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type WHERE a.n IS DISTINCT FROM b.n""")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    events, cut = t(spark, d, "events"), F.lit("2024-01-16").cast("timestamp_ntz")
    sides = [events.where(p).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")) for p in (F.col("ts") < cut, F.col("ts") >= cut)]
    return R.snapshot_diff(*sides, ["user_id", "event_type"], "n")


@register("key_overlap", """
WITH a AS (SELECT DISTINCT l_suppkey k FROM lineitem WHERE month(l_shipdate) <= 6 AND l_quantity >= 45),
b AS (SELECT DISTINCT l_suppkey k FROM lineitem WHERE month(l_shipdate) > 6 AND l_quantity >= 45)
SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS matched, count(*) FILTER (WHERE b.k IS NULL) AS left_only,
count(*) FILTER (WHERE a.k IS NULL) AS right_only FROM a FULL JOIN b ON a.k = b.k""")
def key_overlap(spark: SparkSession, d: str) -> DataFrame:
    big = t(spark, d, "lineitem").where("l_quantity >= 45").select("l_suppkey", F.month("l_shipdate").alias("m"))
    return R.set_compare(big.where("m <= 6"), big.where("m > 6"), "l_suppkey")


@register("ranked_lookup", """
WITH r AS (SELECT c_custkey, c_name, CASE WHEN c_name = 'Customer#7' THEN 0 WHEN lower(c_name) LIKE 'customer#7%' THEN 1
WHEN contains(lower(c_name), '7') THEN 2 END AS match_rank FROM customer)
SELECT c_custkey, c_name, CAST(match_rank AS INTEGER) AS match_rank, count(*) OVER () AS candidates FROM r
WHERE match_rank = (SELECT min(match_rank) FROM r)""")
def ranked_lookup(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("c_name")
    rows = t(spark, d, "customer").select("c_custkey", "c_name")
    return R.ranked_lookup(rows, [name == "Customer#7", F.lower(name).like("customer#7%"), F.contains(F.lower(name), F.lit("7"))])


@register("topk_union", """
WITH u AS (SELECT c_nationkey AS nation, 'order' AS kind, o_orderkey AS id, o_orderdate AS day FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT s_nationkey, 'line', l_orderkey * 10 + l_linenumber, l_shipdate FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT nation, kind, id, CAST(day AS DATE) AS day, CAST(rank AS INTEGER) AS rank FROM
(SELECT *, row_number() OVER (PARTITION BY nation ORDER BY CAST(day AS DATE) DESC NULLS LAST, kind, id) AS rank FROM u) WHERE rank <= 3""")
def topk_union(spark: SparkSession, d: str) -> DataFrame:
    orders = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = t(spark, d, "lineitem").join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    a = orders.select(F.col("c_nationkey").alias("nation"), F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    b = lines.select(F.col("s_nationkey").alias("nation"), F.lit("line").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").cast("date").alias("day"))
    return R.top_per_group(a.unionByName(b), ["nation"], [F.desc_nulls_last("day"), F.col("kind"), F.col("id")], 3)


@register("avg_rank_percentile", """
SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal IS NULL THEN 0.0 WHEN count(*) OVER p = 1 THEN 1.0 ELSE
(rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) - 1 + (count(*) OVER (PARTITION BY s_nationkey, s_acctbal) - 1) / 2) / (count(*) OVER p - 1) END AS percentile
FROM supplier WINDOW p AS (PARTITION BY s_nationkey)""")
def avg_rank_percentile(spark: SparkSession, d: str) -> DataFrame:
    return R.average_rank(t(spark, d, "supplier"), ["s_nationkey"], "s_acctbal", "percentile").select("s_suppkey", "s_nationkey", "percentile")


@register("balanced_topn", """
SELECT o_custkey, o_orderpriority, o_orderkey, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
(PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 2""")
def balanced_topn(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    return R.top_per_group(rows, ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.col("o_orderkey")], 2).drop("o_orderdate")


@register("keep_first", """
SELECT sha256(regexp_replace(text, '[ \\t\\r\\n]+', '', 'g')) AS print, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select(F.sha2(F.regexp_replace("text", r"[ \t\r\n]+", ""), 256).alias("print"), "doc_id")
    return R.keep_first(rows, ["print"], [F.col("doc_id")])


@register("keep_best", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def keep_best(spark: SparkSession, d: str) -> DataFrame:
    return R.keep_first(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")])


@register("paged_search", """
WITH m AS (SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'a') OR contains(lower(p_type), 'steel')),
p AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_partkey) AS r, count(*) OVER () AS n FROM m)
SELECT p_partkey, p_name, p_brand, n > 100 AS has_more FROM p WHERE r > 50 AND r <= 100""")
def paged_search(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "part").where(R.search(["p_name"], "a") | R.search(["p_type"], "steel")).select("p_partkey", "p_name", "p_brand")
    return R.page(rows, [F.col("p_brand"), F.col("p_partkey")], 50, 50)


@register("stratified_sample", """
WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2),
s AS (SELECT *, n * 200 / sum(n) OVER () AS exact FROM c), f AS (SELECT *, greatest(floor(exact), 1) AS base FROM s),
z AS (SELECT c_mktsegment, c_nationkey, base + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, c_mktsegment, c_nationkey)
<= greatest(200 - sum(base) OVER (), 0) THEN 1 ELSE 0 END AS seats FROM f),
r AS (SELECT c_custkey, c_mktsegment, c_nationkey, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY sha256('seed-1' || CAST(c_custkey AS VARCHAR)), c_custkey) AS r FROM customer)
SELECT c_custkey, c_mktsegment, c_nationkey FROM r JOIN z USING (c_mktsegment, c_nationkey) WHERE r <= seats""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return R.stratified_sample(rows, ["c_mktsegment", "c_nationkey"], "c_custkey", "seed-1", 200)


@register("review_sample", """
WITH j AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY n_chars DESC, doc_id) AS r FROM documents JOIN labels USING (doc_id))
SELECT doc_id, toxic FROM j WHERE r <= 25""")
def review_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels").select("doc_id", "toxic"), "doc_id")
    return R.top_per_group(rows, ["toxic"], [F.desc("n_chars"), F.col("doc_id")], 25).select("doc_id", "toxic")


@register("reconcile_sets", """
WITH a AS (SELECT DISTINCT o_orderkey k FROM orders WHERE o_totalprice > 100000), b AS (SELECT DISTINCT l_orderkey k FROM lineitem WHERE l_quantity > 30)
SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS matched, count(*) FILTER (WHERE b.k IS NULL) AS left_only,
count(*) FILTER (WHERE a.k IS NULL) AS right_only FROM a FULL JOIN b ON a.k = b.k""")
def reconcile_sets(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("k"))
    return R.set_compare(a, t(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("k")), "k")


@register("upsert_supplier", """
WITH p AS (SELECT s_suppkey + 50 AS s_suppkey, s_name || '!' AS s_name, CAST(s_nationkey + 1 AS INTEGER) AS s_nationkey FROM supplier)
SELECT coalesce(b.s_suppkey, p.s_suppkey) AS s_suppkey, coalesce(p.s_name, b.s_name) AS s_name,
CAST(coalesce(least(b.s_nationkey, p.s_nationkey), b.s_nationkey, p.s_nationkey) AS INTEGER) AS s_nationkey,
CASE WHEN b.s_suppkey IS NULL THEN 'new' WHEN p.s_suppkey IS NULL THEN 'kept' ELSE 'merged' END AS status
FROM supplier b FULL JOIN p ON b.s_suppkey = p.s_suppkey""")
def upsert_supplier(spark: SparkSession, d: str) -> DataFrame:
    base = t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    patch = base.select((F.col("s_suppkey") + 50).alias("s_suppkey"), F.concat("s_name", F.lit("!")).alias("s_name"), (F.col("s_nationkey") + 1).alias("s_nationkey"))
    status = F.when(F.col("base_s_name").isNull(), "new").when(F.col("patch_s_name").isNull(), "kept").otherwise("merged")
    return R.upsert(base, patch, ["s_suppkey"], {"s_name": F.coalesce("patch_s_name", "base_s_name"), "s_nationkey": F.least("base_s_nationkey", "patch_s_nationkey"), "status": status})


@register("insert_missing", """
SELECT o_custkey AS k, 'base' AS origin FROM orders GROUP BY 1 UNION ALL
SELECT c_custkey, 'new' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def insert_missing(spark: SparkSession, d: str) -> DataFrame:
    base = t(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit("base").alias("origin")).distinct()
    return R.insert_missing(base, t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("new").alias("origin")), ["k"])


@register("blocking_pairs", """
WITH w AS (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents), k AS (SELECT doc_id, 'head:' || array_to_string(w[1:8], ' ') AS block FROM w UNION ALL SELECT doc_id, 'tail:' || array_to_string(w[-8:], ' ') FROM w),
s AS (SELECT block, count(*) AS n, min(doc_id) AS low FROM k GROUP BY 1 HAVING count(*) > 1)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, block, true AS complete FROM k a JOIN k b USING (block) JOIN s USING (block) WHERE a.doc_id < b.doc_id AND n <= 256
UNION ALL SELECT low, doc_id, block, false FROM k JOIN s USING (block) WHERE n > 256 AND doc_id <> low""")
def blocking_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Documents that begin or end alike."""
    w = t(spark, d, "documents").select("doc_id", F.split(F.lower("text"), " ").alias("w"))
    head, tail = F.slice("w", 1, 8), F.slice("w", F.greatest(F.size("w") - 7, F.lit(1)), F.lit(8))
    keys = F.array(F.concat(F.lit("head:"), F.array_join(head, " ")), F.concat(F.lit("tail:"), F.array_join(tail, " ")))
    return R.pairs_in_blocks(w.select("doc_id", F.explode(keys).alias("block")), "block", "doc_id", 256)


@register("mix_counts", "SELECT l_returnflag AS relation, l_linestatus AS modality, count(*) AS n FROM lineitem GROUP BY 1, 2")
def mix_counts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("relation"), F.col("l_linestatus").alias("modality")).agg(F.count(F.lit(1)).alias("n"))


@register("heatmap", f"""
SELECT subject, count(*) FILTER (WHERE l_returnflag = 'A') AS A, count(*) FILTER (WHERE l_returnflag = 'N') AS N,
count(*) FILTER (WHERE l_returnflag = 'R') AS R FROM ({EVIDENCE_SQL}) GROUP BY 1""")
def heatmap(spark: SparkSession, d: str) -> DataFrame:
    return evidence(spark, d).groupBy("subject").pivot("l_returnflag", ["A", "N", "R"]).count().fillna(0)


@register("context_rollup", f"""
SELECT subject, count(*) AS evidence, count(DISTINCT object) AS objects, count(DISTINCT o_orderkey) AS filings,
string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS kinds, max(seen) AS latest,
CASE WHEN count(*) >= 2000 THEN 'deep' WHEN count(*) > 0 THEN 'covered' ELSE 'missing' END AS status FROM ({EVIDENCE_SQL}) GROUP BY 1""")
def context_rollup(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return evidence(spark, d).groupBy("subject").agg(
        n.alias("evidence"), F.countDistinct("object").alias("objects"), F.countDistinct("o_orderkey").alias("filings"),
        R.joined_set("l_returnflag").alias("kinds"), F.max("seen").alias("latest"),
        F.when(n >= 2000, "deep").when(n > 0, "covered").otherwise("missing").alias("status"))


@register("mode_pick", """
SELECT l_suppkey, l_returnflag AS flag, n FROM (SELECT l_suppkey, l_returnflag, count(*) AS n,
row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1""")
def mode_pick(spark: SparkSession, d: str) -> DataFrame:
    counts = t(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    return R.keep_first(counts, ["l_suppkey"], [-F.col("n"), F.col("flag")])


@register("direction_conflict", f"""
WITH e AS (SELECT cn.n_name AS a, sn.n_name AS b, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey)
SELECT month, least(a, b) AS low, greatest(a, b) AS high, count(*) AS n FROM e WHERE a <> b GROUP BY 1, 2, 3 HAVING count(DISTINCT a) > 1""")
def direction_conflict(spark: SparkSession, d: str) -> DataFrame:
    nation = t(spark, d, "nation").select("n_nationkey", "n_name")
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    a = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("a"))
    b = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("b"))
    rows = rows.join(a, "c_nationkey").join(b, "s_nationkey").where("a <> b")
    keys = [F.trunc("o_orderdate", "month").alias("month"), F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("ways")).where("ways > 1").drop("ways")


@register("cross_filing_verify", """
WITH g AS (SELECT l_suppkey, c_nationkey, count(DISTINCT l_orderkey) AS filings, min(l_discount) AS least, bool_or(l_returnflag = 'R' AND l_tax >= 0.08) AS blocked
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT l_suppkey, c_nationkey, filings, filings >= 2 AND least >= 0.01 AND NOT blocked AS verified FROM g""")
def cross_filing_verify(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = rows.groupBy("l_suppkey", "c_nationkey").agg(
        F.countDistinct("l_orderkey").alias("filings"), F.min("l_discount").alias("least"),
        F.bool_or((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.08)).alias("blocked"))
    return g.select("l_suppkey", "c_nationkey", "filings", ((F.col("filings") >= 2) & (F.col("least") >= 0.01) & ~F.col("blocked")).alias("verified"))


@register("parentage", "SELECT n_nationkey, n_name, r_name AS parent FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def parentage(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", F.col("r_name").alias("parent"))


@register("tier_assign", """
WITH l AS (SELECT c_custkey, c_nationkey, c_acctbal, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey),
p AS (SELECT *, CASE WHEN count(*) OVER g = 1 THEN 1.0 ELSE (rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) - 1 + (count(*) OVER (PARTITION BY c_nationkey, c_acctbal) - 1) / 2) / (count(*) OVER g - 1) END AS cap,
CASE WHEN count(*) OVER g = 1 THEN 1.0 ELSE (rank() OVER (PARTITION BY c_nationkey ORDER BY n) - 1 + (count(*) OVER (PARTITION BY c_nationkey, n) - 1) / 2) / (count(*) OVER g - 1) END AS liquidity
FROM l WINDOW g AS (PARTITION BY c_nationkey))
SELECT c_custkey, CASE WHEN 0.6 * cap + 0.4 * liquidity >= 0.8 THEN 1 WHEN 0.6 * cap + 0.4 * liquidity >= 0.5 THEN 2 ELSE 3 END AS tier,
round(0.6 * cap + 0.4 * liquidity, 6) AS score FROM p""")
def tier_assign(spark: SparkSession, d: str) -> DataFrame:
    orders = t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    rows = t(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = R.average_rank(R.average_rank(rows, ["c_nationkey"], "c_acctbal", "cap"), ["c_nationkey"], "n", "liquidity")
    score = 0.6 * F.col("cap") + 0.4 * F.col("liquidity")
    return rows.select("c_custkey", F.when(score >= 0.8, 1).when(score >= 0.5, 2).otherwise(3).alias("tier"), F.round(score, 6).alias("score"))


@register("running_success", """
SELECT user_id, event_id, event_type = 'purchase' AS hit, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS so_far FROM events""")
def running_success(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.col("event_type") == "purchase"
    return t(spark, d, "events").select("user_id", "event_id", hit.alias("hit"), F.sum(F.when(hit, 1).otherwise(0)).over(w).alias("so_far"))


@register("status_pivot", """
SELECT year(o_orderdate)::INTEGER AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
count(*) FILTER (WHERE o_orderstatus = 'P') AS P, count(*) AS total FROM orders GROUP BY 1""")
def status_pivot(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(s) for s in "FOP"], F.count(F.lit(1)).alias("total"))


@register("scalar_totals", """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS suppliers,
(SELECT count(*) FROM events WHERE event_type = 'error') AS errors, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS latest""")
def scalar_totals(spark: SparkSession, d: str) -> DataFrame:
    for name in ("orders", "lineitem", "events"):
        t(spark, d, name).createOrReplaceTempView(f"tidegraph_{name}")
    return spark.sql("""SELECT (SELECT count(*) FROM tidegraph_orders) AS orders, (SELECT count(DISTINCT l_suppkey) FROM tidegraph_lineitem) AS suppliers,
        (SELECT count(*) FROM tidegraph_events WHERE event_type = 'error') AS errors, (SELECT max(CAST(o_orderdate AS DATE)) FROM tidegraph_orders) AS latest""")


@register("assertions", """
SELECT 'orders_key' AS check_name, count(*) AS violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(DISTINCT (o_custkey, o_orderstatus)) > 1)
UNION ALL SELECT 'discount_range', count(*) FROM lineitem WHERE NOT (l_discount BETWEEN 0 AND 0.09)
UNION ALL SELECT 'status_known', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'orphan_lines', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def assertions(spark: SparkSession, d: str) -> DataFrame:
    orders, line = t(spark, d, "orders"), t(spark, d, "lineitem")
    n = F.count(F.lit(1)).alias("violations")
    parts = {
        "orders_key": orders.groupBy("o_orderkey").agg(F.countDistinct(F.struct("o_custkey", "o_orderstatus")).alias("k")).where("k > 1"),
        "discount_range": line.where("NOT (l_discount BETWEEN 0 AND 0.09)"),
        "status_known": orders.where("o_orderstatus NOT IN ('F', 'O')"),
        "orphan_lines": line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
    }
    out = None
    for name, rows in parts.items():
        one = rows.agg(n).select(F.lit(name).alias("check_name"), "violations")
        out = one if out is None else out.unionByName(one)
    return out
