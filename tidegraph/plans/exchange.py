"""Sources and sinks, each written to the shared folder and read back; tables in pages; bundles; briefs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions import text as X
from tidegraph.operators import evaluate as V
from tidegraph.plans.disclosures import RELATIONS_SQL, relations
from tidegraph.plans.operations import _RATED, _rated
from tidegraph.plans.registry import register
from tidegraph.session import scratch
from tidegraph.session import table as t
from tidegraph.sources import readers, sinks


@register("csv_universe", "SELECT upper(trim(c_name)) AS ticker, c_name AS company_name, c_mktsegment AS role, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE 3 END::INTEGER AS priority, NULL::VARCHAR AS notes FROM customer")
def csv_universe(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "universe")
    priority = F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string")).when(F.col("c_custkey") % 3 == 1, "high")
    rows = t(spark, d, "customer").select(F.concat(F.lit(" "), F.lower("c_name")).alias("ticker"), F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("role"), priority.alias("priority"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return readers.universe_csv(spark, path)


@register("jsonl_documents", "SELECT doc_id, lang, n_chars, sha256(text) AS digest FROM documents")
def jsonl_documents(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    sinks.sorted_json(t(spark, d, "documents"), path)
    return readers.jsonl(spark, path, "doc_id bigint, lang string, n_chars bigint, text string").select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("digest"))


@register("union_csv_rows", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, NULL::VARCHAR AS r_name FROM nation UNION ALL SELECT NULL, NULL, r_name FROM region")
def union_csv_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "union")
    sinks.union_csv([t(spark, d, "nation").select("n_nationkey", "n_name"), t(spark, d, "region").select("r_name")], path)
    return spark.read.csv(path, header=True).select("n_nationkey", "n_name", "r_name")


@register("json_document_rows", "SELECT n_nationkey, n_name FROM nation")
def json_document_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "document")
    sinks.json_document(t(spark, d, "nation").select("n_nationkey", "n_name"), path)
    return spark.read.option("multiLine", True).schema("n_nationkey int, n_name string").json(path)


@register("run_partitions", "SELECT o_orderkey, 'b' AS run_id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'a' FROM orders WHERE o_orderstatus = 'O'")
def run_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Two runs, the first written again: its rows are replaced and the other's stay."""
    path, orders = scratch(spark, "runs"), t(spark, d, "orders")
    for status, run in (("P", "a"), ("F", "b"), ("O", "a")):
        sinks.run_table(orders.where(F.col("o_orderstatus") == status).select("o_orderkey"), path, run)
    return spark.read.schema("o_orderkey bigint, run_id string").parquet(path)


@register("event_log", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def event_log(spark: SparkSession, d: str) -> DataFrame:
    path, events = scratch(spark, "log"), t(spark, d, "events").select("event_id", "event_type")
    for kind in ("click", "view"):
        sinks.append_events(events.where(F.col("event_type") == kind), path)
    return readers.jsonl(spark, path, "event_id bigint, event_type string")


@register("latest_run", "SELECT user_id AS run_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    log = t(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("created_at"), "event_id")
    return sinks.latest(log).select("run_id", "event_id")


@register("published_table", "SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def published_table(spark: SparkSession, d: str) -> DataFrame:
    path, part = scratch(spark, "published"), t(spark, d, "part").select("p_partkey", "p_name", "p_size")
    for size in (0, 25):
        sinks.publish(part.where(F.col("p_size") > size).drop("p_size"), path)
    return spark.read.schema("p_partkey bigint, p_name string").parquet(path)


@register("xml_instruments", "SELECT p_partkey AS Id, p_name AS FullNm FROM part")
def xml_instruments(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "xml")
    record = F.concat(F.lit("<FinInstrm><Id>"), F.col("p_partkey").cast("string"), F.lit("</Id><FullNm>"), "p_name", F.lit("</FullNm></FinInstrm>"))
    t(spark, d, "part").select(record).write.text(path)
    return readers.xml_records(spark, path, "FinInstrm", "Id bigint, FullNm string")


@register("index_scan", "SELECT CAST(o_custkey AS VARCHAR) AS cik, 'form ' || o_orderstatus AS form, CAST(o_orderdate AS DATE) AS filing_date, 'a-' || o_orderkey AS accession FROM orders")
def index_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "index")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    line = F.concat_ws("|", F.col("o_custkey").cast("string"), F.lit("ACME"), F.concat(F.lit("form "), "o_orderstatus"), date, F.concat(F.lit("edgar/data/a-"), F.col("o_orderkey").cast("string"), F.lit(".txt")))
    t(spark, d, "orders").select(F.explode(F.array(F.lit("CIK|Company Name|Form Type|Date Filed|Filename"), line))).write.text(path)
    return readers.pipe_index(spark, path).select("cik", "form", "filing_date", "accession")


@register("columnar_rows", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def columnar_rows(spark: SparkSession, d: str) -> DataFrame:
    """Parallel arrays by order, an order has few lines, back to rows."""
    rows = F.collect_list(F.struct("l_orderkey", "l_partkey", "l_suppkey"))
    made = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(rows.alias("r"))
    names = ["l_orderkey", "l_partkey", "l_suppkey"]
    return readers.columnar_json(made.select(*[F.col(f"r.{n}").alias(n) for n in names]), names)


@register("sniffed_table", "SELECT s_name AS \"Company Name\", CAST(s_suppkey AS VARCHAR) AS \"Symbol\" FROM supplier")
def sniffed_table(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "sniffed")
    line = F.concat_ws(";", F.lit("x"), "s_name", F.col("s_suppkey").cast("string"))
    files = t(spark, d, "supplier").coalesce(1).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))  # a small file
    files.select(F.concat(F.lit("A note\n\nNo;Company Name;Symbol\n"), "body")).write.text(path)
    return readers.sniffed(spark, f"{path}/part-*", ["Company Name", "Symbol"]).select("Company Name", "Symbol")


@register("html_table_rows", """SELECT o_orderkey, 'Order ' || o_orderkey || ' | ' || o_orderpriority || ' | total ' || o_orderstatus AS row FROM orders WHERE length('Order ' || o_orderkey || ' | ' || o_orderpriority || ' | total ' || o_orderstatus) >= 20""")
def html_table_rows(spark: SparkSession, d: str) -> DataFrame:
    cell = lambda *c: F.concat(F.lit("<td class='x'> "), *c, F.lit("</td>"))
    page = F.concat(
        F.lit("<table><tr><th>one heading only</th></tr><tr>"), cell(F.lit("Order <b>"), F.col("o_orderkey").cast("string"), F.lit("</b>")), cell("o_orderpriority"), cell(F.lit("total\n "), "o_orderstatus"),
        F.lit("</tr><tr><td>a</td><td>b</td></tr></table>"))
    return t(spark, d, "orders").select("o_orderkey", F.explode(X.table_rows(page)).alias("row"))


@register("paged_text", "SELECT doc_id, unnest([0, 1, 2]) AS page, unnest([length(text), 0, length(lang)])::INTEGER AS size FROM documents")
def paged_text(spark: SparkSession, d: str) -> DataFrame:
    """Form-feed separated pages; a blank one stays."""
    text = F.concat("text", F.lit("\f\f"), "lang")
    return t(spark, d, "documents").select("doc_id", F.posexplode(readers.pages_of(text)).alias("page", "x")).select("doc_id", "page", F.length("x").alias("size"))


@register("bundle_verification", """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 10 = 1 THEN 'unlisted' WHEN doc_id % 10 = 2 THEN 'changed' ELSE 'ok' END AS state FROM documents""")
def bundle_verification(spark: SparkSession, d: str) -> DataFrame:
    rows, n = t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content")), F.col("doc_id") % 10
    manifest = rows.where(n != 1).select("doc_id", F.octet_length("content").alias("size"), F.sha2("content", 256).alias("sha256"))
    files = rows.where(n != 0).select("doc_id", F.when(n == 2, F.concat("content", F.lit(b"!"))).otherwise(F.col("content")).alias("content"))
    return sinks.verified_bundle(manifest, files, "doc_id", "content")


@register("storage_tier", "SELECT doc_id, sha256(text) AS sha256, strlen(text)::INTEGER AS size, 'zstd' AS codec FROM documents WHERE strlen(text) >= 4096 UNION ALL SELECT doc_id, sha256(text), strlen(text)::INTEGER, 'plain' FROM documents WHERE strlen(text) < 4096")
def storage_tier(spark: SparkSession, d: str) -> DataFrame:
    made = sinks.tiered(t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content")), least=4096)
    return made.select("doc_id", "sha256", "size", "codec")


@register("brief_markdown", f"""WITH {RELATIONS_SQL}, g AS (SELECT subject, relation_type, count(*) AS n FROM relations GROUP BY 1, 2) SELECT subject, '# ' || subject || chr(10) || string_agg('- ' || relation_type || ': ' || n, chr(10) ORDER BY n DESC, relation_type) AS brief FROM g GROUP BY 1""")
def brief_markdown(spark: SparkSession, d: str) -> DataFrame:
    """One page a company: its kinds of relations by evidence, of which there are at most as many as rules."""
    n = relations(spark, d).groupBy("subject", "relation_type").agg(F.count(F.lit(1)).alias("n"))
    lines = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "relation_type")))
    shown = F.transform(lines, lambda x: F.concat(F.lit("- "), x["relation_type"], F.lit(": "), (-x["m"]).cast("string")))
    return n.groupBy("subject").agg(shown.alias("l")).select("subject", F.concat(F.lit("# "), "subject", F.lit("\n"), F.array_join("l", "\n")).alias("brief"))


@register("foreign_filings", """SELECT event_id, CAST(ts AS DATE) AS filed, 'tw:' || sha256(concat_ws('|', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d'), event_type))[1:16] AS filing_id FROM events""")
def foreign_filings(spark: SparkSession, d: str) -> DataFrame:
    """Events with a date of the Republic of China as filings under a content hash."""
    rows = t(spark, d, "events").withColumn("told", F.concat((F.year("ts") - 1911).cast("string"), F.date_format("ts", "/MM/dd")))
    filed = X.roc_date(F.col("told"))
    return rows.select("event_id", filed.alias("filed"), X.stable_id("tw:", 16, F.col("user_id"), filed, F.col("event_type")).alias("filing_id"))


@register("span_exclusion", """WITH s AS (SELECT DISTINCT l_orderkey, CAST(l_quantity AS INTEGER) AS a, CAST(l_quantity AS INTEGER) + l_linenumber AS b, l_returnflag FROM lineitem)
SELECT l_orderkey, a, b FROM s x WHERE l_returnflag = 'N' AND NOT EXISTS (SELECT 1 FROM s y WHERE y.l_orderkey = x.l_orderkey AND y.l_returnflag = 'A' AND x.a < y.b AND y.a < x.b)""")
def span_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """New spans that lie over none of the occupied ones of their unit."""
    s = t(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("int").alias("a"), (F.col("l_quantity").cast("int") + F.col("l_linenumber")).alias("b"), "l_returnflag").distinct()
    held = s.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("k"), F.col("a").alias("c"), F.col("b").alias("e"))
    return s.where("l_returnflag = 'N'").join(held, (F.col("l_orderkey") == F.col("k")) & (F.col("a") < F.col("e")) & (F.col("c") < F.col("b")), "left_anti").select("l_orderkey", "a", "b")


@register("micro_macro", f"""WITH c AS (SELECT lang, count(*) FILTER (WHERE gold AND predicted) AS tp, count(*) FILTER (WHERE NOT gold AND predicted) AS fp, count(*) FILTER (WHERE gold AND NOT predicted) AS fn FROM ({_RATED}) GROUP BY 1),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f FROM c)
SELECT round(sum(tp) / (sum(tp) + sum(fp)), 9) AS micro_precision, round(sum(tp) / (sum(tp) + sum(fn)), 9) AS micro_recall, round(avg(p), 9) AS macro_precision, round(avg(r), 9) AS macro_recall, round(avg(f), 9) AS macro_f1 FROM p""")
def micro_macro(spark: SparkSession, d: str) -> DataFrame:
    each = V.precision_recall(_rated(spark, d), F.col("gold"), F.col("predicted"), ["lang"])
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    shown = {"micro_precision": tp / (tp + fp), "micro_recall": tp / (tp + fn), "macro_precision": F.avg("precision"), "macro_recall": F.avg("recall"), "macro_f1": F.avg("f1")}
    return each.agg(*[F.round(c, 9).alias(n) for n, c in shown.items()])


@register("normalized_text", """SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(html, chr(160), ' '), '[ \\t\\r\\f]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) AS text FROM pages""")
def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", X.normalize_text(F.col("html")).alias("text"))


@register("ngram_rules", """WITH w AS (SELECT doc_id, quality, regexp_extract_all(lower(text), '[a-z]{2,}') AS w FROM documents JOIN labels USING (doc_id)),
f AS (SELECT doc_id, quality, unnest(list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))) AS feature FROM w) SELECT feature, count(*) AS total, sum(1 - quality)::BIGINT AS support, sum(1 - quality) / count(*) AS precision FROM f GROUP BY 1 HAVING count(*) >= 20 AND sum(1 - quality) >= 5""")
def ngram_rules(spark: SparkSession, d: str) -> DataFrame:
    """Words and pairs of words with their support and precision."""
    rows = t(spark, d, "documents").select("doc_id", "text").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    words = rows.select("doc_id", "quality", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0)).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("w", F.lit(1), n), F.slice("w", F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    each = words.select("doc_id", "quality", F.explode(F.array_distinct(F.concat("w", pairs))).alias("feature"))
    found = each.groupBy("feature").agg(F.count(F.lit(1)).alias("total"), F.sum((1 - F.col("quality")).cast("long")).alias("support"))
    return found.where("total >= 20 AND support >= 5").withColumn("precision", F.col("support") / F.col("total"))


@register("cascading_first", """SELECT user_id, min(event_id) AS first_event, arg_min(event_type, (ts, event_id)) FILTER (WHERE event_type <> 'error') AS first_good FROM events GROUP BY 1""")
def cascading_first(spark: SparkSession, d: str) -> DataFrame:
    """First value of each group, and first that isn't empty, without a sort of the group."""
    good = F.when(F.col("event_type") != "error", F.struct("ts", "event_id", "event_type"))
    return t(spark, d, "events").groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.min(good)["event_type"].alias("first_good"))
