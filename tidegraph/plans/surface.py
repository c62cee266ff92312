"""Read-surface queries: predicates, sorts, set and record merges, names, numbers and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.functions import text as X
from tidegraph.operators import extraction as E
from tidegraph.operators import passages as P
from tidegraph.operators import surface as S
from tidegraph.plans.disclosures import RELATIONS_SQL, relations
from tidegraph.plans.registry import register
from tidegraph.plans.text import _KEY_SQL
from tidegraph.session import table as t

FILINGS_SQL = """filings AS (SELECT o_orderkey AS filing_id, o_custkey AS issuer_id, ['sec_edgar', 'edinet', 'cninfo'][o_custkey % 3 + 1] AS source,
CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-Q' WHEN '3-MEDIUM' THEN '130' WHEN '4-NOT SPECIFIED' THEN '10-K/A' ELSE '20-F' END AS form, CAST(o_orderdate AS DATE) AS filed, o_orderstatus AS status,
CASE o_orderkey % 5 WHEN 0 THEN 'Annual Report 2000' WHEN 1 THEN '年度报告 2001 修订' WHEN 2 THEN 'Summary of results' WHEN 3 THEN '有価証券報告書 訂正' ELSE 'Report' END AS title, o_totalprice AS amount FROM orders)"""


def filings(spark: SparkSession, d: str) -> DataFrame:
    """An order as a filing: filing_id, issuer_id, source, form, filed, status, title, amount."""
    forms = {"1-URGENT": "10-K", "2-HIGH": "10-Q", "3-MEDIUM": "130", "4-NOT SPECIFIED": "10-K/A"}
    titles = ("Annual Report 2000", "年度报告 2001 修订", "Summary of results", "有価証券報告書 訂正", "Report")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    return t(spark, d, "orders").select(
        F.col("o_orderkey").alias("filing_id"), F.col("o_custkey").alias("issuer_id"), pick(("sec_edgar", "edinet", "cninfo"), F.col("o_custkey") % 3).alias("source"),
        S.first_rule([(F.col("o_orderpriority") == k, v) for k, v in forms.items()], "20-F").alias("form"), F.col("o_orderdate").cast("date").alias("filed"),
        F.col("o_orderstatus").alias("status"), pick(titles, F.col("o_orderkey") % 5).alias("title"), F.col("o_totalprice").alias("amount"))


@register("form_date_filter", f"WITH {FILINGS_SQL} SELECT filing_id, form, filed FROM filings WHERE form IN ('10-K', '20-F') AND filed BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' ORDER BY filed DESC, filing_id DESC LIMIT 25")
def form_date_filter(spark: SparkSession, d: str) -> DataFrame:
    """The latest 25 filings of some forms in a span of dates: stopping early is the feature."""
    rows = filings(spark, d).where(F.col("form").isin("10-K", "20-F") & F.col("filed").between(F.lit("1997-01-01").cast("date"), F.lit("1998-12-31").cast("date")))
    return rows.select("filing_id", "form", "filed").orderBy(F.desc("filed"), F.desc("filing_id")).limit(25)


@register("predicate_builder", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND (c_name ILIKE '%CUSTOMER#00%7%' OR c_mktsegment ILIKE '%CUSTOMER#00%7%')")
def predicate_builder(spark: SparkSession, d: str) -> DataFrame:
    asked = S.predicate({"c_mktsegment": "BUILDING", "c_nationkey": None}, "CUSTOMER#00%7", ["c_name", "c_mktsegment"])
    return t(spark, d, "customer").where(asked).select("c_custkey")


@register("year_predicate", f"WITH {FILINGS_SQL} SELECT form, count(*) AS n FROM filings WHERE year(filed) = 1998 GROUP BY 1")
def year_predicate(spark: SparkSession, d: str) -> DataFrame:
    return filings(spark, d).where(S.in_year(F.col("filed"), 1998)).groupBy("form").agg(F.count(F.lit(1)).alias("n"))


@register("array_membership", f"WITH {FILINGS_SQL} SELECT filing_id, status FROM filings WHERE status = ANY(['F', 'P']) AND list_contains([1, 2, 3, 5, 8, 13, 21, 34], issuer_id)")
def array_membership(spark: SparkSession, d: str) -> DataFrame:
    ids = F.array(*[F.lit(i).cast("long") for i in (1, 2, 3, 5, 8, 13, 21, 34)])
    return filings(spark, d).where(F.col("status").isin("F", "P") & F.array_contains(ids, F.col("issuer_id"))).select("filing_id", "status")


@register("masked_projection", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def masked_projection(spark: SparkSession, d: str) -> DataFrame:
    return S.masked(t(spark, d, "customer"), ["c_acctbal", "c_name", "local_path"])


@register("watchlist_filter", f"WITH {FILINGS_SQL} SELECT filing_id FROM filings WHERE issuer_id IN (3, 7, 11) OR form IN ('10-K/A') OR source IN ('edinet')")
def watchlist_filter(spark: SparkSession, d: str) -> DataFrame:
    return filings(spark, d).where(S.watch({"issuer_id": (3, 7, 11), "form": ("10-K/A",), "source": ("edinet",), "status": ()})).select("filing_id")


@register("placeholder_names", "SELECT p_partkey, regexp_matches(lower(p_name), '^(?:small|hot) ') OR lower(trim(p_name)) IN ('red widget', 'blue gear') AS placeholder FROM part")
def placeholder_names(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", S.placeholder(F.col("p_name"), "^(?:small|hot) ", ("red widget", "blue gear")).alias("placeholder"))


_AMENDED_SQL = f"""CASE source WHEN 'sec_edgar' THEN lower(trim(form)) LIKE '%/a' WHEN 'edinet' THEN lower(trim(form)) IN {S.AMENDED_FORMS}
ELSE {' OR '.join(f"contains(concat_ws(' ', form, title), '{m}')" for m in S.AMENDED)} END"""
_SHORTENED_SQL = "(" + " OR ".join(f"contains(lower(regexp_replace(title, '\\s+', '', 'g')), '{m}')" for m in S.SHORTENED) + ")"


@register("amendment_flags", f"WITH {FILINGS_SQL} SELECT filing_id, {_AMENDED_SQL} AS amended, {_SHORTENED_SQL} AS shortened FROM filings")
def amendment_flags(spark: SparkSession, d: str) -> DataFrame:
    source, form, title = F.col("source"), F.col("form"), F.col("title")
    return filings(spark, d).select("filing_id", S.amended(source, form, title).alias("amended"), S.shortened(title).alias("shortened"))


_YEAR_SQL = """CASE WHEN coalesce(year(report), CAST(nullif(regexp_extract(title, '(?:^|[^0-9])(20[0-9]{2})(?:[^0-9]|$)', 1), '') AS INTEGER)) IS NOT NULL
THEN coalesce(year(report), CAST(nullif(regexp_extract(title, '(?:^|[^0-9])(20[0-9]{2})(?:[^0-9]|$)', 1), '') AS INTEGER)) = 2000 ELSE year(filed) IN (2000, 2001) END"""


@register("year_basis", f"WITH {FILINGS_SQL}, r AS (SELECT *, CASE WHEN filing_id % 7 = 0 THEN filed - INTERVAL 60 DAY END AS report FROM filings) SELECT filing_id, {_YEAR_SQL} AS matches FROM r")
def year_basis(spark: SparkSession, d: str) -> DataFrame:
    report = F.when(F.col("filing_id") % 7 == 0, F.date_sub("filed", 60))
    return filings(spark, d).select("filing_id", S.report_year(report, F.col("title"), F.col("filed"), 2000).alias("matches"))


@register("local_resolve", f"""WITH {FILINGS_SQL}, r AS (SELECT *, CASE WHEN filing_id % 7 = 0 THEN filed - INTERVAL 60 DAY END AS report FROM filings)
SELECT issuer_id, filing_id, form FROM (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY filed DESC, filing_id DESC) AS n FROM r WHERE form IN ('10-K', '20-F', '130', '10-K/A') AND NOT {_SHORTENED_SQL} AND NOT ({_AMENDED_SQL}) AND {_YEAR_SQL}) WHERE n = 1""")
def local_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Each issuer's annual document for a year: no summary, no amendment, the latest."""
    source, form, title = F.col("source"), F.col("form"), F.col("title")
    year = S.report_year(F.when(F.col("filing_id") % 7 == 0, F.date_sub("filed", 60)), title, F.col("filed"), 2000)
    rows = filings(spark, d).where(form.isin("10-K", "20-F", "130", "10-K/A") & ~S.shortened(title) & ~S.amended(source, form, title) & year)
    return E.latest(rows, ["issuer_id"], [F.desc("filed"), F.desc("filing_id")]).select("issuer_id", "filing_id", "form")


@register("latest_annual", f"""WITH {FILINGS_SQL}, a AS (SELECT *, CASE WHEN year(filed) = 1999 THEN 0 WHEN filed BETWEEN DATE '1999-10-01' AND DATE '2000-04-30' THEN 1 END AS basis FROM filings WHERE form = '10-K')
SELECT issuer_id, filing_id, CASE basis WHEN 0 THEN 'report_date_in_calendar_year' ELSE 'q4_to_next_q1_filing_date_fallback' END AS basis FROM (SELECT *, row_number() OVER (PARTITION BY issuer_id ORDER BY basis, filed DESC, filing_id DESC) AS n FROM a WHERE basis IS NOT NULL) WHERE n = 1""")
def latest_annual(spark: SparkSession, d: str) -> DataFrame:
    day = lambda x: F.lit(x).cast("date")
    basis = F.when(S.in_year(F.col("filed"), 1999), 0).when(F.col("filed").between(day("1999-10-01"), day("2000-04-30")), 1)
    rows = filings(spark, d).where("form = '10-K'").withColumn("basis", basis).where("basis IS NOT NULL")
    best = E.latest(rows, ["issuer_id"], [F.col("basis"), F.desc("filed"), F.desc("filing_id")])
    return best.select("issuer_id", "filing_id", F.when(F.col("basis") == 0, "report_date_in_calendar_year").otherwise("q4_to_next_q1_filing_date_fallback").alias("basis"))


_TYPE_RULES = (("10-K", "annual_report"), ("20-F", "annual_report"), ("130", "annual_report"), ("10-Q", "quarterly_report"))


@register("document_types", f"""WITH {FILINGS_SQL} SELECT filing_id, CASE WHEN form LIKE '%/A' THEN 'amendment' WHEN contains(title, '有価証券報告書') THEN 'annual_securities_report' WHEN contains(title, '年度报告') THEN 'annual_report_cn'
WHEN starts_with(form, '10-') THEN 'periodic' ELSE 'other' END AS native, CASE {' '.join(f"WHEN starts_with(form, '{a}') THEN '{b}'" for a, b in _TYPE_RULES)} ELSE 'other' END AS canonical FROM filings""")
def document_types(spark: SparkSession, d: str) -> DataFrame:
    form, title = F.col("form"), F.col("title")
    native = S.first_rule([(form.endswith("/A"), "amendment"), (F.contains(title, F.lit("有価証券報告書")), "annual_securities_report"), (F.contains(title, F.lit("年度报告")), "annual_report_cn"), (form.startswith("10-"), "periodic")], "other")
    return filings(spark, d).select("filing_id", native.alias("native"), S.first_rule([(form.startswith(a), b) for a, b in _TYPE_RULES], "other").alias("canonical"))


@register("exhibit_cap", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber = 1 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) WHERE l_linenumber = 1 OR r <= 3""")
def exhibit_cap(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    return S.capped(t(spark, d, "lineitem"), ["l_orderkey"], F.col("l_linenumber") == 1, order, 3).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("case_ranked_sort", f"WITH {FILINGS_SQL} SELECT filing_id, status FROM filings ORDER BY CASE status WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, amount DESC NULLS LAST, filing_id LIMIT 30")
def case_ranked_sort(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("status") == "P", 0).when(F.col("status") == "O", 1).otherwise(2)
    return filings(spark, d).orderBy(rank, F.desc_nulls_last("amount"), "filing_id").limit(30).select("filing_id", "status")


@register("safe_cast_sort", f"""WITH {FILINGS_SQL}, m AS (SELECT filing_id, CASE filing_id % 3 WHEN 0 THEN '{{"d":"' || strftime(filed, '%Y-%m-%d') || '"}}' WHEN 1 THEN '{{"d":"soon"}}' ELSE '{{}}' END AS j FROM filings)
SELECT filing_id, coalesce(TRY_CAST(json_extract_string(j, '$.d') AS DATE), DATE '1900-01-01') AS key FROM m ORDER BY key DESC, filing_id LIMIT 40""")
def safe_cast_sort(spark: SparkSession, d: str) -> DataFrame:
    dated = F.concat(F.lit('{"d":"'), F.date_format("filed", "yyyy-MM-dd"), F.lit('"}'))
    meta = F.when(F.col("filing_id") % 3 == 0, dated).when(F.col("filing_id") % 3 == 1, '{"d":"soon"}').otherwise("{}")
    found = F.get_json_object(meta, "$.d")
    safe = F.when(F.rlike(found, F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")), F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date"))
    rows = filings(spark, d).select("filing_id", F.coalesce(safe, F.lit("1900-01-01").cast("date")).alias("key"))
    return rows.orderBy(F.desc("key"), "filing_id").limit(40)


@register("company_sort", """WITH c AS (SELECT c_name AS company, CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey % 9 AS VARCHAR) WHEN 1 THEN 'high' END AS priority, count(o_orderkey) AS evidence FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT company, coalesce(TRY_CAST(priority AS INTEGER), 999) AS priority, evidence FROM c ORDER BY 2, evidence DESC, company LIMIT 50""")
def company_sort(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("evidence"))
    given = F.when(F.col("c_custkey") % 4 == 0, (F.col("c_custkey") % 9).cast("string")).when(F.col("c_custkey") % 4 == 1, "high")
    rows = t(spark, d, "customer").join(n, "c_custkey", "left").select(F.col("c_name").alias("company"), F.coalesce(given.try_cast("int"), F.lit(999)).alias("priority"), F.coalesce("evidence", F.lit(0)).alias("evidence"))
    return rows.orderBy("priority", F.desc("evidence"), "company").limit(50)


@register("seeded_sample", "SELECT doc_id FROM documents ORDER BY sha256('1969:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 25")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id").orderBy(F.sha2(F.concat(F.lit("1969:"), F.col("doc_id").cast("string")), 256), "doc_id").limit(25)


_LISTS_SQL = """lists AS (SELECT l_orderkey, list(l_suppkey % 7 ORDER BY l_linenumber, l_partkey, l_suppkey) AS a, list(l_partkey % 7 ORDER BY l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem GROUP BY 1)"""


def _lists(spark: SparkSession, d: str) -> DataFrame:
    """Two lists by order; an order has a few lines."""
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    made = t(spark, d, "lineitem").groupBy("l_orderkey").agg(rows.alias("r"))
    return made.select("l_orderkey", F.transform("r", lambda x: x["l_suppkey"] % 7).alias("a"), F.transform("r", lambda x: x["l_partkey"] % 7).alias("b"))


@register("ordered_union", f"WITH {_LISTS_SQL}, c AS (SELECT l_orderkey, list_concat(a, b) AS l FROM lists) SELECT l_orderkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ';') AS merged FROM c")
def ordered_union(spark: SparkSession, d: str) -> DataFrame:
    return _lists(spark, d).select("l_orderkey", F.array_join(S.ordered_union(F.col("a"), F.col("b")).cast("array<string>"), ";").alias("merged"))


@register("set_union", f"WITH {_LISTS_SQL} SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(a, b))), ';') AS merged, array_to_string(list_sort(list_distinct(list_intersect(a, b))), ';') AS shared FROM lists")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    shown = lambda c: F.array_join(F.array_sort(c).cast("array<string>"), ";")
    return _lists(spark, d).select("l_orderkey", shown(F.array_union("a", "b")).alias("merged"), shown(F.array_intersect("a", "b")).alias("shared"))


@register("exact_agreement", """SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_discount >= 0.03 INTERSECT SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_tax <= 0.05""")
def exact_agreement(spark: SparkSession, d: str) -> DataFrame:
    key, line = ["l_orderkey", "l_linenumber", "l_returnflag"], t(spark, d, "lineitem")
    return line.where("l_discount >= 0.03").select(*key).intersect(line.where("l_tax <= 0.05").select(*key))


@register("history_merge", """WITH u AS (SELECT event_id, event_type, 0 AS age FROM events WHERE ts >= TIMESTAMP '2024-01-10' UNION ALL SELECT event_id, 'old-' || event_type, 1 FROM events WHERE ts < TIMESTAMP '2024-01-20')
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY age) AS r FROM u) WHERE r = 1""")
def history_merge(spark: SparkSession, d: str) -> DataFrame:
    """Old and new history by event; the new one's record stands."""
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    events = t(spark, d, "events")
    new = events.where(F.col("ts") >= at("2024-01-10")).select("event_id", "event_type", F.lit(0).alias("age"))
    old = events.where(F.col("ts") < at("2024-01-20")).select("event_id", F.concat(F.lit("old-"), "event_type").alias("event_type"), F.lit(1).alias("age"))
    return new.unionByName(old).groupBy("event_id").agg(F.min_by("event_type", "age").alias("event_type"))


@register("answer_tolerance", """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 3 WHEN 0 THEN CAST(l_extendedprice AS VARCHAR) WHEN 1 THEN 'about ' || CAST(l_quantity AS VARCHAR) || '%' ELSE 'the red widget of ' || l_returnflag END AS gold,
CASE l_linenumber % 3 WHEN 0 THEN CAST(l_extendedprice + CASE WHEN l_suppkey % 2 = 0 THEN 0.0 ELSE 5.0 END AS VARCHAR) WHEN 1 THEN CAST(l_quantity / 100 AS VARCHAR) ELSE 'a red widget of ' || l_linestatus END AS said FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 3 WHEN 0 THEN abs(CAST(gold AS DOUBLE) - CAST(said AS DOUBLE)) <= greatest(0.001, abs(CAST(gold AS DOUBLE)) * 0.00001) WHEN 1 THEN true
ELSE len(list_intersect(string_split(lower(gold), ' '), string_split(lower(said), ' '))) >= 4 END AS agrees FROM a""")
def answer_tolerance(spark: SparkSession, d: str) -> DataFrame:
    kind, flag = F.col("l_linenumber") % 3, F.col("l_suppkey") % 2 == 0
    gold = F.when(kind == 0, F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).when(kind == 1, F.concat(F.lit("about "), F.col("l_quantity").cast("string"), F.lit("%"))).otherwise(F.concat(F.lit("the red widget of "), "l_returnflag"))
    near = (F.col("l_extendedprice") + F.when(flag, 0.0).otherwise(5.0)).cast("decimal(18,2)").cast("string")
    said = F.when(kind == 0, near).when(kind == 1, (F.col("l_quantity") / 100).cast("string")).otherwise(F.concat(F.lit("a red widget of "), "l_linestatus"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.answers_agree(gold, said).alias("agrees"))


@register("confidence_bands", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN 1 - l_discount >= 0.95 THEN 'very_high' WHEN 1 - l_discount * 2 >= 0.86 THEN 'high' ELSE 'medium' END AS band FROM lineitem")
def confidence_bands(spark: SparkSession, d: str) -> DataFrame:
    sure = F.when(1 - F.col("l_discount") >= 0.95, 1 - F.col("l_discount")).otherwise(F.least(F.greatest(1 - F.col("l_discount") * 2, F.lit(0.72)), F.lit(0.94)))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.confidence_band(sure).alias("band"))


@register("accounting_identity", """WITH f AS (SELECT l_orderkey, sum(CASE WHEN l_linenumber <= 3 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)::DOUBLE AS assets, sum(CASE WHEN l_linenumber IN (2, 3, 5) THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)::DOUBLE AS liabilities,
sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)::DOUBLE AS equity FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN abs(assets - liabilities - equity) / abs(assets) > 0.5 THEN 'error' ELSE 'warning' END AS severity FROM f WHERE assets <> 0 AND abs(assets - liabilities - equity) / abs(assets) > 0.05""")
def accounting_identity(spark: SparkSession, d: str) -> DataFrame:
    """Facts pivoted by filing, and whether they add up."""
    cents = F.col("l_extendedprice").cast("decimal(18,2)")
    part = lambda hit, name: F.sum(F.when(hit, cents)).cast("double").alias(name)
    line = F.col("l_linenumber")
    facts = t(spark, d, "lineitem").groupBy("l_orderkey").agg(part(line <= 3, "assets"), part(line.isin(2, 3, 5), "liabilities"), part(line == 1, "equity"))
    return facts.select("l_orderkey", S.identity_issue(F.col("assets"), F.col("liabilities"), F.col("equity")).alias("severity")).where("severity IS NOT NULL")


@register("json_merge", """WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events)
SELECT event_id, 'from=' || event_type || ';k=' || CASE WHEN event_id % 2 = 0 THEN 'patched' ELSE k END AS merged FROM e""")
def json_merge(spark: SparkSession, d: str) -> DataFrame:
    own = F.concat(F.lit('{"from":"'), "event_type", F.lit('"'))
    patch = F.when(F.col("event_id") % 2 == 0, F.concat(own, F.lit(',"k":"patched"}'))).otherwise(F.concat(own, F.lit("}")))
    merged = F.map_entries(S.json_merged(F.col("props"), patch))
    return t(spark, d, "events").select("event_id", F.array_join(F.transform(merged, lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";").alias("merged"))


@register("json_salvage", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS objects, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    """Objects recovered from an answer with a fence around it and, in a third of them, a broken second object."""
    second = F.when(F.col("event_id") % 3 == 0, '{"k": 1, "x": ').otherwise('{"k": 1}')
    answer = F.concat(F.lit("Here you are:\n```json\n["), "props", F.lit(", "), second, F.lit("\n```"))
    found = S.json_salvaged(answer)
    return t(spark, d, "events").select("event_id", F.size(found).alias("objects"), F.get_json_object(found[0], "$.k").cast("long").alias("k"))


@register("payload_normalisation", """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag ELSE 'other' END AS kind, greatest(0.0, least(1.0, l_quantity / 40))::DOUBLE AS confidence, (l_returnflag || ' ' || p_name)[1:9] AS note FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, kind, confidence, note, count(*) AS repeats FROM p GROUP BY ALL""")
def payload_normalisation(spark: SparkSession, d: str) -> DataFrame:
    """Answers as JSON: kinds outside the list, confidence outside 0 to 1 and long notes are set right, repeats counted once."""
    rows = t(spark, d, "lineitem").join(t(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    raw = F.to_json(F.struct(F.col("l_returnflag").alias("kind"), (F.col("l_quantity") / 40).alias("confidence"), F.concat_ws(" ", "l_returnflag", "p_name").alias("note")))
    p = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.from_json(raw, "kind string, confidence double, note string").alias("p"))
    kind = F.when(F.col("p.kind").isin("A", "R"), F.col("p.kind")).otherwise("other")
    clean = p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), "p.confidence")).alias("confidence"), F.substring("p.note", 1, 9).alias("note"))
    return clean.groupBy(*clean.columns).agg(F.count(F.lit(1)).alias("repeats"))


_FORMS_SQL = "|".join(S.LEGAL_SUFFIXES)


def _merge_key(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(lower(regexp_replace(regexp_replace(trim({c}), '\(\s*[0-9]+\s*\)?\s*$', ''), '\s+[0-9]+\s*$', '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), ' +', ' ', 'g'))"


def _short(c: str) -> str:
    pairs = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in S.LEGAL_SUFFIXES.items())
    return f"array_to_string(list_transform(list_filter(string_split(trim(regexp_extract({c}, '((?:(?:^| )(?:{_FORMS_SQL}))+)$', 1)), ' '), lambda w: w <> ''), lambda w: CASE w {pairs} END), ' ')"


def _initials(c: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split({c}, ' '), lambda w: w <> ''), lambda w: w[1:1]), '')"


_PAIR_SQL = """pairs AS (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' Corporation' WHEN 2 THEN ' & Sons Ltd' ELSE ' works (3' END AS a,
CASE p_partkey % 6 WHEN 0 THEN upper(p_name) || ' Incorporated' WHEN 1 THEN p_name || ' Corp' WHEN 2 THEN p_name || ' and Sons Limited' WHEN 3 THEN array_to_string(list_transform(string_split(p_name || ' works', ' '), lambda w: w[1:1]), '') WHEN 4 THEN p_name ELSE 'other ' || p_name END AS b FROM part)"""


@register("merge_gate", f"""WITH {_PAIR_SQL}, k AS (SELECT p_partkey, {_merge_key('a')} AS a, {_merge_key('b')} AS b FROM pairs),
s AS (SELECT *, regexp_replace(a, '(?:(?:^| )(?:{_FORMS_SQL}))+$', '') AS x, regexp_replace(b, '(?:(?:^| )(?:{_FORMS_SQL}))+$', '') AS y FROM k)
SELECT p_partkey, a <> '' AND b <> '' AND (a = b OR (x <> '' AND y <> '' AND ((x = y AND {_short('a')} = {_short('b')}) OR (length(y) >= 3 AND NOT contains(y, ' ') AND {_initials('x')} = y) OR (length(x) >= 3 AND NOT contains(x, ' ') AND {_initials('y')} = x)))) AS merges FROM s""")
def merge_gate(spark: SparkSession, d: str) -> DataFrame:
    name, n = F.col("p_name"), F.col("p_partkey")
    a = F.concat(name, F.when(n % 4 == 0, " Inc.").when(n % 4 == 1, " Corporation").when(n % 4 == 2, " & Sons Ltd").otherwise(" works (3"))
    first = F.array_join(F.transform(F.split(F.concat(name, F.lit(" works")), " "), lambda w: F.substring(w, 1, 1)), "")
    b = (
        F.when(n % 6 == 0, F.concat(F.upper(name), F.lit(" Incorporated"))).when(n % 6 == 1, F.concat(name, F.lit(" Corp"))).when(n % 6 == 2, F.concat(name, F.lit(" and Sons Limited")))
        .when(n % 6 == 3, first).when(n % 6 == 4, name).otherwise(F.concat(F.lit("other "), name))
    )
    return t(spark, d, "part").select("p_partkey", S.may_merge(a, b).alias("merges"))


_GENERIC, _PLACES, _ALIASES, _CLASSES = ("suppliers", "customers", "red widget"), ("taiwan", "china", "small ring"), {"blue gear": "Blue Gear Works"}, {"gear|ring": "component", "widget": "product"}


@register("object_cascade", f"""WITH n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ' Inc.' ELSE p_name END AS c, {_KEY_SQL.format(c="p_name")} AS key FROM part)
SELECT p_partkey, CASE WHEN key = 'blue gear' THEN 'Blue Gear Works' ELSE c END AS name, CASE WHEN key IN {_GENERIC} THEN 'generic' WHEN key = 'blue gear' THEN 'company' WHEN key IN {_PLACES} THEN 'geography'
WHEN c LIKE '%Inc.' THEN 'organization' WHEN regexp_matches(key, 'gear|ring') THEN 'component' WHEN regexp_matches(key, 'widget') THEN 'product' ELSE 'unknown' END AS kind,
CASE WHEN key IN {_GENERIC} THEN 0.1 WHEN key = 'blue gear' THEN 1.0 WHEN key IN {_PLACES} THEN 0.7 WHEN c LIKE '%Inc.' THEN 0.8 WHEN regexp_matches(key, 'gear|ring|widget') THEN 0.5 ELSE 0.4 END::DOUBLE AS specificity FROM n""")
def object_cascade(spark: SparkSession, d: str) -> DataFrame:
    c = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" Inc."))).otherwise(F.col("p_name"))
    made = S.normalised_object(c, X.object_key(F.col("p_name")), _GENERIC, _ALIASES, _PLACES, _CLASSES)
    return t(spark, d, "part").select("p_partkey", made.alias("o")).select("p_partkey", "o.*")


@register("expression_values", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity + 2) * 3 - l_linenumber / 4 AS value FROM lineitem")
def expression_values(spark: SparkSession, d: str) -> DataFrame:
    """Arithmetic in text, evaluated without running it as code."""
    told = F.concat(F.lit("("), F.col("l_quantity").cast("string"), F.lit("+2)*3-"), F.col("l_linenumber").cast("string"), F.lit("/4"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", P.evaluated(told).alias("value"))


@register("date_parsing", f"""WITH {FILINGS_SQL} SELECT filing_id, filed AS parsed FROM filings WHERE filing_id % 5 < 4 UNION ALL SELECT filing_id, NULL FROM filings WHERE filing_id % 5 = 4""")
def date_parsing(spark: SparkSession, d: str) -> DataFrame:
    """Dates in four spellings, the third with the years of the Republic of China, and one that is none."""
    kind, filed = F.col("filing_id") % 5, F.col("filed")
    roc = F.concat((F.year(filed) - 1911).cast("string"), F.date_format(filed, "/MM/dd"))
    told = F.when(kind == 0, F.date_format(filed, "yyyy-MM-dd")).when(kind == 1, F.date_format(filed, "yyyyMMdd")).when(kind == 2, roc).when(kind == 3, F.date_format(filed, "dd.MM.yyyy")).otherwise("soon")
    return filings(spark, d).select("filing_id", F.coalesce(X.roc_date(told), X.parse_date(told)).alias("parsed"))


@register("script_ratio", """SELECT page_id, round(CASE WHEN length(regexp_replace(html, '[^\\p{L}]', '', 'g')) > 0 THEN length(regexp_replace(html, '[^A-Za-z]', '', 'g')) / length(regexp_replace(html, '[^\\p{L}]', '', 'g')) ELSE 0 END, 9) AS latin,
regexp_matches(html, '[\\x{AC00}-\\x{D7A3}]') AS hangul, regexp_matches(html, '[\\x{3040}-\\x{30FF}]') AS kana FROM pages""")
def script_ratio(spark: SparkSession, d: str) -> DataFrame:
    html = F.col("html")
    return t(spark, d, "pages").select("page_id", F.round(X.script_share(html, "A-Za-z"), 9).alias("latin"), F.rlike(html, F.lit("[\\x{AC00}-\\x{D7A3}]")).alias("hangul"), F.rlike(html, F.lit("[\\x{3040}-\\x{30FF}]")).alias("kana"))


@register("slug_excerpt", """SELECT item_id, trim(regexp_replace(lower(text[1:40]), '[^a-z0-9]+', '-', 'g'), '-') AS slug, CASE WHEN instr(text, ' the ') > 20 THEN '...' ELSE '' END || CASE WHEN instr(text, ' the ') > 0 THEN text[greatest(instr(text, ' the ') - 20, 1):greatest(instr(text, ' the ') - 20, 1) + 44] ELSE text[1:45] END ||
CASE WHEN greatest(instr(text, ' the ') - 20, 1) + 45 <= length(text) THEN '...' ELSE '' END AS excerpt FROM benchmark WHERE instr(text, ' the ') <> 21""")
def slug_excerpt(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "benchmark").where(F.instr("text", " the ") != 21)
    return rows.select("item_id", X.slug(F.substring("text", 1, 40)).alias("slug"), X.excerpt(F.col("text"), F.lit(" the "), 20).alias("excerpt"))


@register("network_ready", f"""WITH {RELATIONS_SQL} SELECT passage_id, relation_type, object FROM relations WHERE regexp_matches(object, '\\b(?:Inc|Corp|Ltd|Limited)\\.?$') AND NOT regexp_matches(lower(object), '^(?:we|if) ')""")
def network_ready(spark: SparkSession, d: str) -> DataFrame:
    """Records whose object is a named organisation, and no placeholder."""
    named = F.rlike("object", F.lit(r"\b(?:Inc|Corp|Ltd|Limited)\.?$")) & ~S.placeholder(F.col("object"), "^(?:we|if) ", ("the company",))
    return relations(spark, d).where(named).select("passage_id", "relation_type", "object")


@register("display_predicates", f"""WITH {RELATIONS_SQL}, c AS (SELECT passage_id, relation_type, object, instr(clause, object) AS p, lower(clause[greatest(instr(clause, object) - 60, 1):greatest(instr(clause, object) - 60, 1) + length(object) + 119]) AS near FROM relations)
SELECT passage_id, relation_type, object, p > 0 AS mentioned, regexp_matches(near, 'competitors? (?:include|such as)') AND NOT regexp_matches(near, '\\b(?:rely|depend|purchase|supply)') AS competition, regexp_matches(near, '\\b(?:may|could|if we|if our)\\b') AS hypothetical FROM c""")
def display_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Cues around the object within its clause: is it named there, as a competitor, in a hypothesis."""
    own, at = relations(spark, d), F.instr("evidence", F.col("object"))
    near = F.lower(F.substring(F.col("evidence"), F.greatest(at - 60, F.lit(1)), F.length("object") + 120))
    competes = F.rlike(near, F.lit("competitors? (?:include|such as)")) & ~F.rlike(near, F.lit(r"\b(?:rely|depend|purchase|supply)"))
    return own.select("passage_id", "relation_type", "object", (at > 0).alias("mentioned"), competes.alias("competition"), F.rlike(near, F.lit(r"\b(?:may|could|if we|if our)\b")).alias("hypothetical"))
