"""Campaign, review, graph-eligibility, validation and evaluation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.functions import lexicon as X
from tidegraph.functions.text import object_key
from tidegraph.operators import campaign as C
from tidegraph.operators import graph as G
from tidegraph.operators import surface as S
from tidegraph.plans.disclosures import PASSAGES_SQL, RELATIONS_SQL, passages, relations
from tidegraph.plans.operations import _FLOW_SQL, flows
from tidegraph.plans.registry import register
from tidegraph.plans.surface import FILINGS_SQL, filings
from tidegraph.plans.text import _KEY_SQL
from tidegraph.session import materialised
from tidegraph.session import table as t


def _n():
    return F.count(F.lit(1))


def _any_sql(c: str, parts) -> str:
    return "(" + " OR ".join(f"contains({c}, '{p}')" for p in parts) + ")"


@register("source_admission", """WITH s AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'ftp://x/' ELSE url END AS url, page_id % 5 > 0 AS permitted, CASE WHEN page_id % 7 = 0 THEN 'sec_exhibits' ELSE 'web' END AS provider,
['issuer', 'configured', 'news', 'regulator'][page_id % 4 + 1] AS kind FROM pages)
SELECT page_id, CASE WHEN NOT regexp_matches(url, '^https?://[^/]+') THEN 'invalid_source_url' WHEN NOT permitted THEN 'local_processing_not_permitted' WHEN provider = 'sec_exhibits' THEN 'sec_exhibit'
WHEN kind IN ('issuer', 'regulator') THEN 'first_party_source' WHEN kind = 'configured' THEN 'configured_provider' ELSE 'unapproved_source_kind' END AS reason FROM s""")
def source_admission(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("page_id")
    url = F.when(n % 11 == 0, "ftp://x/").otherwise(F.col("url"))
    kind = F.element_at(F.array(*map(F.lit, ("issuer", "configured", "news", "regulator"))), (n % 4 + 1).cast("int"))
    return t(spark, d, "pages").select("page_id", C.admission(url, n % 5 > 0, F.when(n % 7 == 0, "sec_exhibits").otherwise("web"), kind).alias("reason"))


@register("query_variants", f"""WITH q(i, q) AS (VALUES (0, 'Q2'), (1, 'q2'), (2, 'second quarter'), (3, 'second-quarter'), (4, 'second quarterly')), y(j, y) AS (VALUES (0, '2000'), (1, 'FY00'), (2, 'FY 00'), (3, 'fiscal 2000'), (4, 'fiscal year 2000')),
e(k, e) AS (VALUES {', '.join(f"({k}, '{e}')" for k, e in enumerate(C.EVENTS))}), a AS (SELECT *, CASE WHEN i = 0 AND j = 0 THEN 0 WHEN k = 0 THEN 1 ELSE 2 END AS stage FROM q, y, e)
SELECT n_name AS company, '"' || n_name || '" "' || q || '" "' || y || '" "' || e || '"' AS query, (row_number() OVER (PARTITION BY n_nationkey ORDER BY stage, k, i, j) - 1)::INTEGER AS place FROM nation, a""")
def query_variants(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select(F.col("n_name").alias("company"), F.posexplode(C.search_queries(F.col("n_name"), 2000, "Q2")).alias("place", "query"))


_CANDIDATES_SQL = """candidates AS (SELECT o_orderkey AS id, n_name AS company, CASE o_orderkey % 6 WHEN 0 THEN 'https://www.fool.com/' WHEN 1 THEN 'https://youtube.com/' WHEN 2 THEN 'https://ir.fool.com/' ELSE 'https://example.com/' END || o_orderkey AS url,
CASE WHEN o_orderkey % 7 < 5 THEN n_name || ' Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) || CASE o_orderkey % 4 WHEN 0 THEN ' 10-K' WHEN 1 THEN ' earnings conference call' ELSE ' results webcast' END ELSE 'other page' END AS title,
o_orderkey % 3 > 0 AS target, (o_orderkey % 10) / 10 AS confidence, CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE 'official_webcast' END AS kind, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """An order as a search result."""
    nation = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("company"))
    rows = t(spark, d, "orders").join(t(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(nation, "c_nationkey")
    n, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    site = F.when(n % 6 == 0, "https://www.fool.com/").when(n % 6 == 1, "https://youtube.com/").when(n % 6 == 2, "https://ir.fool.com/").otherwise("https://example.com/")
    end = F.when(n % 4 == 0, " 10-K").when(n % 4 == 1, " earnings conference call").otherwise(" results webcast")
    title = F.concat("company", F.lit(" Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string"), end)
    return rows.select(
        n.alias("id"), "company", F.concat(site, n.cast("string")).alias("url"), F.when(n % 7 < 5, title).otherwise("other page").alias("title"), (n % 3 > 0).alias("target"),
        ((n % 10) / 10).alias("confidence"), F.when(n % 5 == 0, "other").otherwise("official_webcast").alias("kind"), day.alias("day"))


@register("candidate_eligibility", f"""WITH {_CANDIDATES_SQL}, h AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)), '^www\\.', '') AS host FROM candidates)
SELECT id FROM h WHERE target AND confidence >= 0.70 AND kind <> 'other' AND NOT (host IN {C.BLOCKED_HOSTS} OR host LIKE '%.fool.com') AND NOT {_any_sql("lower(title || ' ' || url)", C.FILING_HINTS)}""")
def candidate_eligibility(spark: SparkSession, d: str) -> DataFrame:
    fit = C.eligible(F.col("target"), F.col("confidence"), F.col("kind"), F.col("url"), F.concat_ws(" ", "title", "url"))
    return _candidates(spark, d).where(fit).select("id")


@register("deterministic_override", f"""WITH {_CANDIDATES_SQL} SELECT id, CASE WHEN contains(url, 'youtube.com') AND id % 7 < 5 AND id % 4 > 0 THEN greatest(0.95, confidence) ELSE confidence END::DOUBLE AS confidence FROM candidates""")
def deterministic_override(spark: SparkSession, d: str) -> DataFrame:
    """A video whose title names company, period and call is sure, whatever it was judged."""
    named = C.names_call(F.col("title"), F.col("company"), F.year("day"), F.concat(F.lit("Q"), F.quarter("day").cast("string")))
    sure = F.when((C.host(F.col("url")) == "youtube.com") & named, F.greatest(F.lit(0.95), "confidence")).otherwise(F.col("confidence"))
    return _candidates(spark, d).select("id", sure.alias("confidence"))


@register("period_conflict", f"""WITH {_CANDIDATES_SQL}, w AS (SELECT id, lower(title || ' ' || url) AS w FROM candidates), y AS (SELECT *, regexp_extract_all(w, '\\b(20[0-9]{{2}})\\b', 1) AS years FROM w)
SELECT id, CASE WHEN len(years) > 0 AND NOT list_contains(years, '2000') THEN true WHEN NOT contains(w, '2000') THEN false ELSE contains(w, 'q1') OR contains(w, 'q2') OR contains(w, 'q4') END AS conflict FROM y""")
def period_conflict(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("id", C.period_conflict(F.col("title"), F.col("url"), 2000, "Q3").alias("conflict"))


@register("date_grounding", f"""WITH {_CANDIDATES_SQL} SELECT id, CASE WHEN id % 8 < 7 THEN day END AS grounded FROM candidates""")
def date_grounding(spark: SparkSession, d: str) -> DataFrame:
    """A date that a text shows in one of seven spellings, or only in part."""
    day, n = F.col("day"), F.col("id") % 8
    forms = ("yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "MMMM d,  yyyy", "MMM d, yyyy", "d MMMM yyyy", "MM/dd/yyyy")
    shown = reduce(lambda out, i: F.when(n == i, F.date_format(day, forms[i])).otherwise(out), range(len(forms)), F.date_format(day, "MMMM 'of' yyyy"))
    return _candidates(spark, d).select("id", C.grounded_date(day, F.concat(F.lit("Held on "), shown, F.lit("."))).alias("grounded"))


_CLOSINGS = ("this concludes", "you may now disconnect")
_VERDICT_SQL = """v AS (SELECT doc_id, doc_id % 2 = 0 AS full_call, doc_id % 5 > 0 AS period, CASE WHEN doc_id % 3 = 0 THEN 'partial_call' ELSE 'earnings_call' END AS kind, 0.7 + (doc_id % 4) * 0.1 AS confidence,
['web', 'youtube', 'pdf', 'api'][doc_id % 4 + 1] AS source, ['page', 'youtube_video', 'official_transcript', 'page'][doc_id % 4 + 1] AS content,
lower(text || CASE WHEN doc_id % 3 < 2 THEN ' Question-and-answer. ' ELSE '' END || CASE WHEN doc_id % 7 < 4 THEN 'This concludes the call.' ELSE '' END) AS low FROM documents)"""


@register("completeness_verdict", f"""WITH {_VERDICT_SQL}, b AS (SELECT *, full_call AND period AND kind = 'earnings_call' AND confidence >= 0.8 AS exact, period AND confidence >= 0.8 AND length(low) >= 7000 AS bounded, {_any_sql('low', _CLOSINGS)} AS closed FROM v)
SELECT doc_id, CASE source WHEN 'web' THEN exact AND closed WHEN 'youtube' THEN exact OR (bounded AND closed AND {_any_sql('low', C.QUESTIONS)}) WHEN 'pdf' THEN exact OR (bounded AND {_any_sql('low', C.PDF_QUESTIONS)}) ELSE exact END AS complete FROM b""")
def completeness_verdict(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    pick = lambda *values: F.element_at(F.array(*map(F.lit, values)), (n % 4 + 1).cast("int"))
    text = F.concat("text", F.when(n % 3 < 2, " Question-and-answer. ").otherwise(""), F.when(n % 7 < 4, "This concludes the call.").otherwise(""))
    sure = F.lit(0.7).cast("decimal(3,1)") + ((n % 4) * F.lit(0.1).cast("decimal(3,1)"))
    kind = F.when(n % 3 == 0, "partial_call").otherwise("earnings_call")
    verdict = C.complete(n % 2 == 0, n % 5 > 0, kind, sure.cast("double"), pick("web", "youtube", "pdf", "api"), pick("page", "youtube_video", "official_transcript", "page"), text, _CLOSINGS)
    return t(spark, d, "documents").select("doc_id", verdict.alias("complete"))


@register("ranked_promotion", """WITH done AS (SELECT c_custkey FROM customer WHERE c_acctbal > 5000), r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) AS r
FROM orders LEFT JOIN done ON o_custkey = c_custkey WHERE c_custkey IS NULL) SELECT o_custkey, o_orderkey FROM r WHERE r = 1""")
def ranked_promotion(spark: SparkSession, d: str) -> DataFrame:
    """The best candidate of each customer that has none yet."""
    done = t(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    open_ = t(spark, d, "orders").join(done, "o_custkey", "left_anti")
    best = open_.groupBy("o_custkey").agg(F.min(F.struct(rank.alias("r"), (-F.col("o_totalprice")).alias("p"), "o_orderkey")).alias("m"))
    return best.select("o_custkey", "m.o_orderkey")


@register("stage_machine", """WITH s AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'search' WHEN 'view' THEN 'judge' WHEN 'click' THEN 'trial' WHEN 'purchase' THEN 'published' ELSE 'failed' END AS stage FROM events)
SELECT user_id, arg_max(stage, (ts, event_id)) AS stage, count(*) FILTER (WHERE stage = 'failed') AS failures, count(*) AS attempts, min(ts) FILTER (WHERE stage = 'published') IS NOT NULL AS ever_published FROM s GROUP BY 1""")
def stage_machine(spark: SparkSession, d: str) -> DataFrame:
    """A job's present stage and what its log says, from events alone."""
    stage = C.mapped(F.col("event_type"), {"signup": "search", "view": "judge", "click": "trial", "purchase": "published"}, "failed")
    rows = t(spark, d, "events").withColumn("stage", stage)
    return rows.groupBy("user_id").agg(
        F.max_by("stage", F.struct("ts", "event_id")).alias("stage"), F.count_if(F.col("stage") == "failed").alias("failures"), _n().alias("attempts"), (F.count_if(F.col("stage") == "published") > 0).alias("ever_published"))


@register("error_classes", """WITH e AS (SELECT event_id, ['http', 'timeout', 'value', 'schema', 'odd'][event_id % 5 + 1] AS kind, [200, 404, 408, 429, 500, 503][event_id % 6 + 1] AS status FROM events)
SELECT CASE kind WHEN 'http' THEN 'http_' || status WHEN 'timeout' THEN 'transient_infrastructure' WHEN 'value' THEN 'invalid_content' WHEN 'schema' THEN 'permanent' ELSE 'unexpected' END AS category,
CASE kind WHEN 'http' THEN status IN (408, 409, 425, 429) OR status >= 500 WHEN 'timeout' THEN true WHEN 'odd' THEN true ELSE false END AS retryable, count(*) AS n FROM e GROUP BY 1, 2""")
def error_classes(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % k + 1).cast("int"))
    made = C.error_class(pick(("http", "timeout", "value", "schema", "odd"), 5), pick((200, 404, 408, 429, 500, 503), 6))
    return t(spark, d, "events").select(made.alias("e")).groupBy("e.category", "e.retryable").agg(_n().alias("n"))


@register("sector_codes", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'BLD' WHEN 'MACHINERY' THEN 'MCH' WHEN 'AUTOMOBILE' THEN 'AUT' ELSE 'UNK' END AS sector, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state FROM customer""")
def sector_codes(spark: SparkSession, d: str) -> DataFrame:
    sector = C.mapped(F.col("c_mktsegment"), {"BUILDING": "BLD", "MACHINERY": "MCH", "AUTOMOBILE": "AUT"}, "UNK")
    return t(spark, d, "customer").select("c_custkey", sector.alias("sector"), F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("state"))


@register("campaign_statistics", """SELECT c_mktsegment AS sector, year(o_orderdate) AS year, count(*) AS jobs, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(DISTINCT o_custkey) AS companies FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, year(o_orderdate))""")
def campaign_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("sector"), F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus", "o_custkey")
    return rows.rollup("sector", "year").agg(_n().alias("jobs"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.countDistinct("o_custkey").alias("companies"))


@register("scan_schedule", """WITH s AS (SELECT c_custkey, max(year(o_orderdate)) FILTER (WHERE o_orderstatus <> 'F') AS unfinished, max(CAST(o_orderdate AS DATE)) FILTER (WHERE year(o_orderdate) = 2001) AS seen FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, CASE WHEN unfinished IS NULL OR (unfinished <> 2001 AND coalesce(seen < DATE '2001-06-01', true)) THEN 2001 ELSE unfinished END::INTEGER AS year, CASE WHEN unfinished IS NULL OR (unfinished <> 2001 AND coalesce(seen < DATE '2001-06-01', true)) THEN 'incremental' ELSE 'backfill' END AS mode FROM s""")
def scan_schedule(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"), F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    state = rows.groupBy("c_custkey").agg(F.max(F.when(F.col("o_orderstatus") != "F", F.col("y"))).alias("unfinished"), F.max(F.when(F.col("y") == 2001, F.col("day"))).alias("seen"))
    due = F.coalesce(F.col("seen") < F.lit("2001-06-01").cast("date"), F.lit(True))
    all_ = t(spark, d, "customer").select("c_custkey").join(state, "c_custkey", "left")
    return all_.select("c_custkey", C.scan_plan(F.col("unfinished"), 2001, due).alias("p")).select("c_custkey", "p.*")


@register("delta_events", """WITH d AS (SELECT event_id, ['NewRcrd', 'ModfdRcrd', 'TermntdRcrd', 'CancRcrd'][event_id % 4 + 1] AS tag, user_id FROM events)
SELECT CASE tag WHEN 'NewRcrd' THEN 'new' WHEN 'ModfdRcrd' THEN 'modified' WHEN 'TermntdRcrd' THEN 'terminated' ELSE 'cancelled' END AS action, count(*) AS events, count(DISTINCT user_id) AS instruments FROM d GROUP BY 1""")
def delta_events(spark: SparkSession, d: str) -> DataFrame:
    tag = F.element_at(F.array(*map(F.lit, ("NewRcrd", "ModfdRcrd", "TermntdRcrd", "CancRcrd"))), (F.col("event_id") % 4 + 1).cast("int"))
    action = C.mapped(tag, {"NewRcrd": "new", "ModfdRcrd": "modified", "TermntdRcrd": "terminated"}, "cancelled")
    return t(spark, d, "events").groupBy(action.alias("action")).agg(_n().alias("events"), F.countDistinct("user_id").alias("instruments"))


@register("event_normalisation", """SELECT event_id, 'src:' || sha256(concat_ws('|', CAST(event_id AS VARCHAR), event_type))[1:20] AS key, coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END, json_extract_string(props, '$.k')) AS title,
array_to_string(list_filter(['http://a/' || event_id, CASE WHEN event_id % 2 = 0 THEN 'http://b/' || event_id END], lambda x: x IS NOT NULL), ';') AS urls FROM events""")
def event_normalisation(spark: SparkSession, d: str) -> DataFrame:
    """One spelling of each field from its aliases, the urls of all of them, and a stable key."""
    n = F.col("event_id").cast("string")
    own = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    urls = F.array_compact(S.ordered_union(F.array(F.concat(F.lit("http://a/"), n)), F.array(F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("http://b/"), n)))))
    key = F.concat(F.lit("src:"), F.substring(F.sha2(F.concat_ws("|", n, "event_type"), 256), 1, 20))
    return t(spark, d, "events").select("event_id", key.alias("key"), F.coalesce(own, F.get_json_object("props", "$.k")).alias("title"), F.array_join(urls, ";").alias("urls"))


_TIES_SQL = """ties AS (SELECT 'r' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS relationship_id, CASE WHEN l_suppkey % 19 = 0 THEN '' ELSE 'S' || l_suppkey END AS source, 'P' || (l_partkey % 50) AS target,
CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'rejected' ELSE 'unreviewed' END AS status, CASE WHEN l_linestatus = 'F' THEN 'supply_chain' ELSE 'strategic' END AS family, CASE WHEN l_linenumber <= 4 THEN '10-K' ELSE '8-K' END AS form FROM lineitem)"""


def _ties(spark: SparkSession, d: str) -> DataFrame:
    """A line item as a relationship under review."""
    ids = F.concat(F.lit("r"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return t(spark, d, "lineitem").select(
        ids.alias("relationship_id"), F.when(F.col("l_suppkey") % 19 == 0, "").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("source"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("target"), C.mapped(F.col("l_returnflag"), {"A": "accepted", "R": "rejected"}, "unreviewed").alias("status"),
        F.when(F.col("l_linestatus") == "F", "supply_chain").otherwise("strategic").alias("family"), F.when(F.col("l_linenumber") <= 4, "10-K").otherwise("8-K").alias("form"))


@register("expansion_eligibility", f"""WITH {_TIES_SQL} SELECT coalesce(CASE WHEN source = '' THEN 'missing_endpoint' WHEN status = 'rejected' THEN 'rejected' WHEN status <> 'accepted' THEN 'candidate' WHEN family <> 'supply_chain' THEN 'relationship_family' WHEN form <> '10-K' THEN 'filing_form' END, 'eligible') AS reason, count(*) AS n FROM ties GROUP BY 1""")
def expansion_eligibility(spark: SparkSession, d: str) -> DataFrame:
    why = C.exclusions(F.col("source"), F.col("target"), F.col("status"), F.col("family"), F.col("form"), ("supply_chain",), ("10-K",), candidates=False)
    return _ties(spark, d).groupBy(F.coalesce(why, F.lit("eligible")).alias("reason")).agg(_n().alias("n"))


@register("seed_resolution", """WITH asked(place, value) AS (VALUES (0, 'Supplier#000000003'), (1, '7'), (2, 'nobody'), (3, 'supplier 000000005')), k AS (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS ticker, regexp_replace(lower(s_name), '[^a-z0-9]+', '', 'g') AS name FROM supplier)
SELECT place, value, coalesce(a.s_suppkey, b.s_suppkey) AS entity, CASE WHEN a.s_suppkey IS NOT NULL THEN 'ticker' WHEN b.s_suppkey IS NOT NULL THEN 'name' ELSE 'unresolved' END AS how FROM asked LEFT JOIN k a ON a.ticker = value LEFT JOIN k b ON b.name = regexp_replace(lower(value), '[^a-z0-9]+', '', 'g')""")
def seed_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Asked seeds by ticker, then by name; the seeds are a parameter of a few rows."""
    asked = spark.createDataFrame([(0, "Supplier#000000003"), (1, "7"), (2, "nobody"), (3, "supplier 000000005")], "place int, value string")
    flat = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    own = t(spark, d, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_suppkey").cast("string").alias("ticker"), flat("s_name").alias("name"))
    small = F.broadcast(asked)
    a = own.join(small, F.col("ticker") == F.col("value")).select("place", F.col("entity").alias("a"))
    b = own.join(small, F.col("name") == flat("value")).select("place", F.col("entity").alias("b"))
    found = asked.join(a, "place", "left").join(b, "place", "left")
    how = F.when(F.col("a").isNotNull(), "ticker").when(F.col("b").isNotNull(), "name").otherwise("unresolved")
    return found.select("place", "value", F.coalesce("a", "b").alias("entity"), how.alias("how"))


@register("industry_groups", f"""WITH r AS (SELECT p_partkey, lower(p_name || ' ' || p_type || ['power', 'chip', 'cloud', 'software', ''][p_partkey % 5 + 1]) AS role FROM part)
SELECT p_partkey, CASE {' '.join(f"WHEN regexp_matches(role, '{p}') THEN '{g}'" for p, g in X.INDUSTRY_GROUPS)} ELSE 'External / unclassified' END AS industry FROM r""")
def industry_groups(spark: SparkSession, d: str) -> DataFrame:
    extra = F.element_at(F.array(*map(F.lit, ("power", "chip", "cloud", "software", ""))), (F.col("p_partkey") % 5 + 1).cast("int"))
    role = F.lower(F.concat("p_name", F.lit(" "), "p_type", extra))
    return t(spark, d, "part").select("p_partkey", S.first_rule([(F.rlike(role, F.lit(p)), g) for p, g in X.INDUSTRY_GROUPS], "External / unclassified").alias("industry"))


@register("network_projection", f"""WITH {_TIES_SQL} SELECT relationship_id, target AS subject, source AS object, CASE status WHEN 'accepted' THEN 'confirmed' WHEN 'rejected' THEN 'rejected' ELSE 'candidate' END AS confirmation FROM ties WHERE source <> '' AND target <> ''""")
def network_projection(spark: SparkSession, d: str) -> DataFrame:
    shown = C.mapped(F.col("status"), {"accepted": "confirmed", "rejected": "rejected"}, "candidate")
    return _ties(spark, d).where("source <> '' AND target <> ''").select("relationship_id", F.col("target").alias("subject"), F.col("source").alias("object"), shown.alias("confirmation"))


@register("ego_graph", f"""WITH {_FLOW_SQL}, u AS (SELECT a, b FROM flows UNION SELECT b, a FROM flows), d0 AS (SELECT unnest([1, 4]) AS node), d1 AS (SELECT DISTINCT b AS node FROM u JOIN d0 ON a = node WHERE b NOT IN (SELECT node FROM d0)),
d2 AS (SELECT DISTINCT b AS node FROM u JOIN d1 ON a = node WHERE b NOT IN (SELECT node FROM d0 UNION SELECT node FROM d1)) SELECT node::INTEGER AS node, 0 AS depth FROM d0 UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2""")
def ego_graph(spark: SparkSession, d: str) -> DataFrame:
    """All nodes within two steps of two seeds."""
    seeds = spark.createDataFrame([(1,), (4,)], "node int")
    return G.expand(flows(spark, d), seeds, 2, None, [F.desc("n")]).select("node", "depth")


@register("ontology_errors", """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ['supplies_to', 'partners_with', 'unheard_of'][l_linenumber % 3 + 1] AS kind, ['supply_chain', 'strategic'][l_partkey % 2 + 1] AS family, ['direction', 'odd_flag'][l_suppkey % 2 + 1] AS flag FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN kind = 'unheard_of' THEN 'unknown_canonical_relationship_type' ELSE concat_ws(';', CASE WHEN (kind = 'supplies_to') <> (family = 'supply_chain') THEN 'relationship_family_violates_ontology' END, CASE WHEN flag = 'odd_flag' THEN 'unknown_risk_flag' END) END AS errors FROM r""")
def ontology_errors(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (F.col(c) % len(values) + 1).cast("int"))
    kind, family, flag = pick(("supplies_to", "partners_with", "unheard_of"), "l_linenumber"), pick(("supply_chain", "strategic"), "l_partkey"), pick(("direction", "odd_flag"), "l_suppkey")
    families = {name: fam for name, fam, _ in X.CANONICAL_TYPES.values()}
    expected = F.try_element_at(F.create_map(*[F.lit(x) for pair in families.items() for x in pair]), kind)
    wrong = F.concat_ws(";", F.when(expected != family, "relationship_family_violates_ontology"), F.when(~flag.isin("direction", "competitor"), "unknown_risk_flag"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(expected.isNull(), "unknown_canonical_relationship_type").otherwise(wrong).alias("errors"))


@register("key_collisions", "SELECT p_name, p_brand, count(DISTINCT (p_type, p_size)) AS identities FROM part GROUP BY 1, 2 HAVING count(DISTINCT (p_type, p_size)) > 1")
def key_collisions(spark: SparkSession, d: str) -> DataFrame:
    return S.collisions(t(spark, d, "part"), ["p_name", "p_brand"], ["p_type", "p_size"])


@register("extractor_registry", f"""WITH {PASSAGES_SQL}, a AS (SELECT passage_id, 'years' AS extractor, 'year' AS kind, unnest(regexp_extract_all(text, '\\b((?:19|20)[0-9]{{2}})\\b', 1)) AS value FROM passages
UNION ALL SELECT passage_id, 'legal_names', 'organization', unnest(regexp_extract_all(text, '{X.LEGAL_NAME}', 1)) FROM passages) SELECT passage_id, extractor, kind, value FROM a""")
def extractor_registry(spark: SparkSession, d: str) -> DataFrame:
    return C.extracted(passages(spark, d), ["years", "legal_names"])


@register("direction_corrections", f"""WITH {_TIES_SQL}, d AS (SELECT DISTINCT * FROM ties) SELECT 'rel:' || sha256(concat_ws('|', 'direction-correction', target, source, family, form))[1:16] AS relationship_id, target AS source, source AS target, family AS relation_type, form AS modality, 'needs_review' AS review_status,
relationship_id AS direction_correction_of, 'Reverse-direction candidate: ' || status AS decision_reason FROM d WHERE status = 'rejected' AND source <> ''""")
def direction_corrections(spark: SparkSession, d: str) -> DataFrame:
    ties = _ties(spark, d).distinct().withColumnsRenamed({"family": "relation_type", "form": "modality"})
    audits = ties.where("source <> ''").select("relationship_id", F.when(F.col("status") == "rejected", "reverse").otherwise("agrees").alias("direction"), F.col("status").alias("reason"))
    return C.corrections(ties, audits)


@register("audit_decisions", f"""WITH {_TIES_SQL}, d AS (SELECT DISTINCT * FROM ties) SELECT family, CASE WHEN status = 'accepted' AND form = '10-K' THEN 'accept_verified' WHEN status = 'rejected' THEN 'reject' WHEN form = '8-K' THEN 'second_opinion' ELSE 'review' END AS decision, count(*) AS n FROM d GROUP BY 1, 2""")
def audit_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts applied: verified relationships are accepted without asking, the others by what the audit said."""
    status, form = F.col("status"), F.col("form")
    decision = S.first_rule([((status == "accepted") & (form == "10-K"), "accept_verified"), (status == "rejected", "reject"), (form == "8-K", "second_opinion")], "review")
    return _ties(spark, d).distinct().groupBy("family", decision.alias("decision")).agg(_n().alias("n"))


_NEGATIVE, _CONCERN = r"\b(?:not supported|does not|no evidence|contradict)", r"\b(?:however|missing|unclear|contradict|gap)"


@register("challenge_consistency", f"""WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'supported' ELSE 'concern' END AS verdict, lower(['The filing states it.', 'The text does not say so.', 'However, the direction is unclear.', 'No evidence was given.'][o_orderkey % 4 + 1] || o_orderstatus) AS said FROM orders)
SELECT o_orderkey, CASE WHEN verdict = 'supported' AND regexp_matches(said, '{_NEGATIVE}') THEN 'supported_verdict_has_negative_conclusion' WHEN verdict = 'concern' AND NOT regexp_matches(said, '{_CONCERN}') THEN 'concern_verdict_lacks_contradiction_or_gap' ELSE '' END AS reason FROM c""")
def challenge_consistency(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("o_orderkey")
    said = F.element_at(F.array(*map(F.lit, ("The filing states it.", "The text does not say so.", "However, the direction is unclear.", "No evidence was given."))), (n % 4 + 1).cast("int"))
    low, fine = F.lower(F.concat(said, "o_orderstatus")), n % 2 == 0
    reason = S.first_rule([(fine & F.rlike(low, F.lit(_NEGATIVE)), "supported_verdict_has_negative_conclusion"), (~fine & ~F.rlike(low, F.lit(_CONCERN)), "concern_verdict_lacks_contradiction_or_gap")], "")
    return t(spark, d, "orders").select("o_orderkey", reason.alias("reason"))


@register("reextraction_preview", f"""WITH {RELATIONS_SQL}, now AS (SELECT DISTINCT subject, object, relation_type FROM relations WHERE confidence >= 0.7), new AS (SELECT DISTINCT subject, object, relation_type FROM relations WHERE modality <> 'forward_looking')
SELECT coalesce(now.relation_type, new.relation_type) AS relation_type, count(*) FILTER (WHERE now.subject IS NOT NULL AND new.subject IS NOT NULL) AS both, count(*) FILTER (WHERE new.subject IS NULL) AS now_only, count(*) FILTER (WHERE now.subject IS NULL) AS preview_only
FROM now FULL JOIN new ON now.subject = new.subject AND now.object = new.object AND now.relation_type = new.relation_type GROUP BY 1""")
def reextraction_preview(spark: SparkSession, d: str) -> DataFrame:
    key = ["subject", "object", "relation_type"]
    rows = relations(spark, d)
    a = rows.where("confidence >= 0.7").select(*key).distinct().withColumn("a", F.lit(1))
    b = rows.where("modality <> 'forward_looking'").select(*key).distinct().withColumn("b", F.lit(1))
    a_, b_ = F.col("a").isNotNull(), F.col("b").isNotNull()
    return a.join(b, key, "full").groupBy("relation_type").agg(F.count_if(a_ & b_).alias("both"), F.count_if(~b_).alias("now_only"), F.count_if(~a_).alias("preview_only"))


@register("candidate_attach", f"""WITH m AS (SELECT p_partkey, {_KEY_SQL.format(c="p_name")} AS key FROM part), g AS (SELECT {_KEY_SQL.format(c="p_name || ' Inc'")} AS key, min(p_partkey) AS entity FROM part WHERE p_size > 40 GROUP BY 1), a AS (SELECT {_KEY_SQL.format(c="p_name")} AS key, count(DISTINCT p_brand) AS aliases FROM part WHERE p_size < 10 GROUP BY 1)
SELECT p_partkey, concat_ws(';', CASE WHEN entity IS NOT NULL THEN 'current_canonical_graph:' || entity END, CASE WHEN aliases IS NOT NULL THEN 'confirmed_alias_history:' || aliases END) AS candidates FROM m LEFT JOIN g USING (key) LEFT JOIN a USING (key)""")
def candidate_attach(spark: SparkSession, d: str) -> DataFrame:
    """Candidates from the graph and from accepted aliases, by exact key, with where they come from."""
    part = t(spark, d, "part")
    own = part.select("p_partkey", object_key(F.col("p_name")).alias("key"))
    graph = part.where("p_size > 40").groupBy(object_key(F.concat("p_name", F.lit(" Inc"))).alias("key")).agg(F.min("p_partkey").alias("entity"))
    alias = part.where("p_size < 10").groupBy(object_key(F.col("p_name")).alias("key")).agg(F.countDistinct("p_brand").alias("aliases"))
    named = lambda source, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(source + ":"), F.col(c).cast("string")))
    rows = own.join(graph, "key", "left").join(alias, "key", "left")
    return rows.select("p_partkey", F.concat_ws(";", named("current_canonical_graph", "entity"), named("confirmed_alias_history", "aliases")).alias("candidates"))


@register("curated_validation", """WITH c AS (SELECT p_brand AS ticker, p_name AS company, p_size % 4 AS tier FROM part), d AS (SELECT ticker FROM c GROUP BY 1 HAVING count(*) > 1)
SELECT 'duplicate_ticker' AS problem, count(*) AS n FROM d UNION ALL SELECT 'unsupported_tier', count(*) FROM c WHERE tier NOT IN (1, 2) UNION ALL SELECT 'incomplete', count(*) FROM c WHERE ticker = '' OR company = ''""")
def curated_validation(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "part").select(F.col("p_brand").alias("ticker"), F.col("p_name").alias("company"), (F.col("p_size") % 4).alias("tier"))
    twice = rows.groupBy("ticker").agg(_n().alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_ticker"))
    rest = rows.agg(F.count_if(~F.col("tier").isin(1, 2)).alias("unsupported_tier"), F.count_if((F.col("ticker") == "") | (F.col("company") == "")).alias("incomplete"))
    return twice.unpivot([], ["duplicate_ticker"], "problem", "n").unionByName(rest.unpivot([], ["unsupported_tier", "incomplete"], "problem", "n"))


_MILLI = "floor({c} * 1000 + 0.5) / 1000"


@register("brief_claims", f"""WITH {RELATIONS_SQL}, m AS (SELECT subject, relation_type, object, modality, count(*) AS n FROM relations GROUP BY ALL), k AS (SELECT subject, relation_type, object, string_agg(modality, '; ' ORDER BY n DESC, modality) AS mix FROM m GROUP BY ALL),
g AS (SELECT subject, relation_type, object, count(*) AS evidence, sum(CAST(confidence AS DECIMAL(5,3)))::DOUBLE / count(*) AS mean, array_to_string(list_sort(list(DISTINCT accession))[1:8], '; ') AS accessions, array_to_string(list(passage_id ORDER BY confidence DESC, passage_id)[1:3], '; ') AS best FROM relations GROUP BY ALL)
SELECT subject, relation_type, object, evidence, {_MILLI.format(c='mean')} AS confidence, mix, accessions, best FROM g JOIN k USING (subject, relation_type, object)""")
def brief_claims(spark: SparkSession, d: str) -> DataFrame:
    """One claim for each type and object of a company, with its three best passages and first eight filings.

    Lists are cut after a partial sort by window, so no group's evidence is gathered whole."""
    key = ["subject", "relation_type", "object"]
    rows = materialised(relations(spark, d).select(*key, "modality", "confidence", "accession", "passage_id"), "claims")
    total = rows.groupBy(*key).agg(_n().alias("evidence"), (F.sum(F.col("confidence").cast("decimal(5,3)")).cast("double") / _n()).alias("mean"))
    mix = rows.groupBy(*key, "modality").agg(_n().alias("n")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "modality"))).alias("l"))
    first = lambda df, order, n, value: df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("__r") <= n).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("__r", value))).alias(value))
    filings_ = first(rows.select(*key, "accession").distinct(), [F.col("accession")], 8, "accession")
    best = first(rows, [F.desc("confidence"), F.col("passage_id")], 3, "passage_id")
    shown = lambda c, field: F.array_join(F.transform(c, lambda x: x[field].cast("string")), "; ")
    out = total.join(mix, key).join(filings_, key).join(best, key)
    return out.select(
        *key, "evidence", (F.floor(F.col("mean") * 1000 + 0.5) / 1000).alias("confidence"), shown("l", "modality").alias("mix"), shown("accession", "accession").alias("accessions"), shown("passage_id", "passage_id").alias("best"))


@register("evidence_rows", f"""WITH {RELATIONS_SQL}, q AS (SELECT *, CASE WHEN contains(lower(clause), lower(object)) THEN 2.0 ELSE 0.0 END + CASE WHEN modality = 'current_fact' THEN 0.5 ELSE 0.0 END AS quality FROM relations),
b AS (SELECT *, row_number() OVER (PARTITION BY subject, relation_type, object ORDER BY quality DESC, confidence DESC, passage_id) = 1 AS leads FROM q),
p AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY CASE WHEN leads THEN 0 ELSE 1 END, quality DESC, confidence DESC, passage_id, relation_type, object) AS place FROM b) SELECT subject, relation_type, object, passage_id, leads, place::INTEGER AS place FROM p WHERE place <= 12""")
def evidence_rows(spark: SparkSession, d: str) -> DataFrame:
    quality = F.when(F.contains(F.lower("evidence"), F.lower("object")), 2.0).otherwise(0.0) + F.when(F.col("modality") == "current_fact", 0.5).otherwise(0.0)
    rows = relations(spark, d).withColumn("quality", quality)
    order = [F.desc("quality"), F.desc("confidence"), F.col("passage_id"), F.col("relation_type"), F.col("object")]
    return C.evidence_table(rows, "subject", ["relation_type", "object"], order, 12).select("subject", "relation_type", "object", "passage_id", "leads", "place")


@register("review_queue", f"""WITH {RELATIONS_SQL}, g AS (SELECT subject, object, relation_type, count(*) AS evidence, count(DISTINCT accession) AS filings, max(CASE WHEN modality = 'current_fact' THEN 1 ELSE 0 END) AS current FROM relations GROUP BY 1, 2, 3)
SELECT subject, object, relation_type, 3 * evidence + 4 * filings + CASE WHEN relation_type IN ('supplier_dependency', 'foundry_dependency') THEN 8 ELSE 0 END + 3 * current AS priority FROM g ORDER BY priority DESC, subject, object, relation_type LIMIT 25""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 relationships to review: a report."""
    rows = relations(spark, d).groupBy("subject", "object", "relation_type").agg(_n().alias("evidence"), F.countDistinct("accession").alias("filings"), F.max(F.when(F.col("modality") == "current_fact", 1).otherwise(0)).alias("current"))
    supply = F.when(F.col("relation_type").isin("supplier_dependency", "foundry_dependency"), 8).otherwise(0)
    rows = rows.select("subject", "object", "relation_type", (3 * F.col("evidence") + 4 * F.col("filings") + supply + 3 * F.col("current")).alias("priority"))
    return rows.orderBy(F.desc("priority"), "subject", "object", "relation_type").limit(25)


@register("gold_evaluation", """WITH p AS (SELECT DISTINCT 'S' || l_suppkey AS source, 'P' || (l_partkey % 50) AS target, l_returnflag AS kind FROM lineitem WHERE l_quantity > 10), e AS (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 'P' || (l_partkey % 50) ELSE 'S' || l_suppkey END AS source, CASE WHEN l_linenumber = 1 THEN 'S' || l_suppkey ELSE 'P' || (l_partkey % 50) END AS target, l_returnflag AS kind FROM lineitem WHERE l_quantity <= 30),
f AS (SELECT DISTINCT 'S' || l_suppkey AS source, 'P' || (l_partkey % 50) AS target, l_returnflag AS kind FROM lineitem WHERE l_discount >= 0.09), c AS (SELECT (SELECT count(*) FROM (SELECT * FROM e INTERSECT SELECT * FROM p)) AS tp, (SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM e)) AS fp, (SELECT count(*) FROM (SELECT * FROM e EXCEPT SELECT * FROM p)) AS fn,
(SELECT count(*) FROM (SELECT * FROM f INTERSECT SELECT * FROM p)) AS forbidden, (SELECT count(*) FROM (SELECT source, target, kind FROM (SELECT * FROM e EXCEPT SELECT * FROM p) INTERSECT SELECT target, source, kind FROM p)) AS reversed)
SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM c""")
def gold_evaluation(spark: SparkSession, d: str) -> DataFrame:
    s, p = F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string"))
    line, turned = t(spark, d, "lineitem"), F.col("l_linenumber") == 1
    plain = [s.alias("source"), p.alias("target"), F.col("l_returnflag").alias("kind")]
    expected = line.where("l_quantity <= 30").select(F.when(turned, p).otherwise(s).alias("source"), F.when(turned, s).otherwise(p).alias("target"), F.col("l_returnflag").alias("kind"))
    return C.gold_counts(line.where("l_quantity > 10").select(*plain), expected, line.where("l_discount >= 0.09").select(*plain), ["source", "target", "kind"])


@register("mcnemar_test", """WITH a AS (SELECT l_suppkey AS k, count(*) FILTER (WHERE l_discount > 0.05 AND l_tax <= 0.04) AS b, count(*) FILTER (WHERE l_discount <= 0.05 AND l_tax > 0.04) AS c FROM lineitem GROUP BY 1)
SELECT k, b, c, round(CASE WHEN b + c = 0 THEN 1 ELSE least(1.0, 2 * list_sum(list_transform(range(0, least(b, c) + 1), lambda i: exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))))) END, 6) AS p FROM a""")
def mcnemar_test(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(
        F.count_if((F.col("l_discount") > 0.05) & (F.col("l_tax") <= 0.04)).alias("b"), F.count_if((F.col("l_discount") <= 0.05) & (F.col("l_tax") > 0.04)).alias("c"))
    return rows.withColumn("p", F.round(C.mcnemar_p(F.col("b"), F.col("c")), 6))


@register("coverage_rates", """SELECT l_returnflag AS field, count(DISTINCT o_custkey) AS companies, count(*) AS facts, round(avg(CASE WHEN l_quantity > 5 THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS valid_rate FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def coverage_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(F.col("l_returnflag").alias("field")).agg(F.countDistinct("o_custkey").alias("companies"), _n().alias("facts"), F.round(F.avg((F.col("l_quantity") > 5).cast("double")), 6).alias("valid_rate"))


@register("issue_counts", """WITH i AS (SELECT doc_id, 'short' AS code, 'warn' AS severity FROM documents WHERE n_chars < 200 UNION ALL SELECT doc_id, 'symbols', 'error' FROM documents WHERE contains(text, '###') UNION ALL SELECT doc_id, 'secret', 'error' FROM documents WHERE contains(text, 'token = "'))
SELECT code, severity, count(*) AS issues, count(DISTINCT source) AS sources FROM i JOIN documents USING (doc_id) GROUP BY 1, 2""")
def issue_counts(spark: SparkSession, d: str) -> DataFrame:
    from tidegraph.plans.operations import quality_issues

    found = quality_issues(spark, d).join(t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return found.groupBy("code", "severity").agg(_n().alias("issues"), F.countDistinct("source").alias("sources"))


@register("weighted_counts", "SELECT o_orderpriority AS key, sum(coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 5 END, 1))::BIGINT AS weight FROM orders GROUP BY 1")
def weighted_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 5)
    return t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("key")).agg(F.sum(F.coalesce(n, F.lit(1))).alias("weight"))


@register("run_summary", f"""WITH {FILINGS_SQL} SELECT (SELECT count(*) FROM filings) AS filings, (SELECT count(DISTINCT issuer_id) FROM filings) AS issuers, (SELECT count(*) FROM filings WHERE form = '10-K/A') AS amendments, (SELECT count(*) FROM lineitem) AS passages, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS objects,
(SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM documents WHERE text = '') AS empty_documents, (SELECT min(filed) FROM filings) AS first_filed, (SELECT max(filed) FROM filings) AS last_filed""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    a = filings(spark, d).agg(_n().alias("filings"), F.countDistinct("issuer_id").alias("issuers"), F.count_if(F.col("form") == "10-K/A").alias("amendments"), F.min("filed").alias("first_filed"), F.max("filed").alias("last_filed"))
    b = t(spark, d, "lineitem").agg(_n().alias("passages"), F.countDistinct("l_suppkey").alias("objects"))
    c = t(spark, d, "documents").agg(_n().alias("documents"), F.count_if(F.col("text") == "").alias("empty_documents"))
    return a.join(F.broadcast(b)).join(F.broadcast(c))  # one row each


@register("universe_summary", "SELECT c_mktsegment AS role, c_nationkey % 3 AS priority, count(*) AS companies FROM customer GROUP BY 1, 2")
def universe_summary(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("role"), (F.col("c_nationkey") % 3).alias("priority")).agg(_n().alias("companies"))


@register("request_plan", "SELECT count(*) AS companies, 1 + count(*) + count(*) * 4 * 3 AS requests FROM customer")
def request_plan(spark: SparkSession, d: str) -> DataFrame:
    """One index, one page a company, and up to four documents of three forms."""
    return t(spark, d, "customer").agg(_n().alias("companies")).select("companies", (1 + F.col("companies") + F.col("companies") * 4 * 3).alias("requests"))


@register("audit_summary", f"WITH {_TIES_SQL} SELECT status, family, count(*) AS decisions FROM ties GROUP BY 1, 2")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return _ties(spark, d).groupBy("status", "family").agg(_n().alias("decisions"))
