"""Operators, functions, sources and streams on small rows."""

import zipfile

from pyspark.sql import functions as F

from tidegraph.functions import text as X
from tidegraph.operators import evaluate, graph, incremental, relational, relations, retrieval
from tidegraph.sources import readers, sinks
from tidegraph.streaming import events as S


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "x string").select(function(F.col("x"))).first()[0]


def test_object_key_joins_spellings(spark):
    keys = {one(spark, s, X.object_key) for s in ("The Foo & Bar, Inc.", "FOO AND BAR Corp", "foo and bar")}
    assert keys == {"foo and bar"}


def test_numbers_and_dates(spark):
    assert float(one(spark, "(1,234.5)", X.parse_number)) == -1234.5
    assert one(spark, "n/a", X.parse_number) is None
    assert str(one(spark, "2024/02/03", X.parse_date)) == "2024-02-03"
    assert one(spark, "soon", X.parse_date) is None


def test_normalised_text_keeps_two_line_feeds(spark):
    assert one(spark, " a b \n\n\n\n c ", X.normalize_text) == "a b\n\nc"
    assert one(spark, "Taiwan Semiconductor", X.initials) == "ts"


def test_edge_counts_and_bottlenecks(spark):
    rows = spark.createDataFrame([("A", "T", "f", "d1", "x"), ("A", "T", "f", "d2", "y"), ("B", "T", "f", "d1", "x")], "s string, o string, k string, day string, tag string")
    edges = relational.edge_aggregate(rows, ["s", "o", "k"], F.col("day"), F.col("tag"))
    assert {(r["s"], r["evidence_count"], r["first_seen"], r["tags"]) for r in edges.collect()} == {("A", 2, "d1", "x;y"), ("B", 1, "d1", "x")}
    shared = relational.shared_objects(edges, "o", "s", "evidence_count", "k").first()
    assert (shared["subjects"], shared["evidence"], shared["first_subjects"]) == (2, 3, "A;B")


def test_average_rank_shares_ties(spark):
    rows = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 2.0), ("h", 5.0), ("h", None)], "g string, v double")
    got = sorted((r["g"], r["v"] or -1, r["p"]) for r in relational.average_rank(rows, ["g"], "v", "p").collect())
    assert got == [("g", 1.0, 0.0), ("g", 2.0, 0.75), ("g", 2.0, 0.75), ("h", -1, 0.0), ("h", 5.0, 1.0)]


def test_components_and_expansion(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (9, 9)], "a int, b int")
    assert {(r["node"], r["root"]) for r in graph.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (9, 9)}
    near = graph.expand(edges, spark.createDataFrame([(1,)], "node int"), 2, 10, [F.col("a")])
    assert {(r["node"], r["depth"]) for r in near.collect()} == {(1, 0), (2, 1), (3, 2)}


def test_gate_takes_the_first_reason(spark):
    row = spark.createDataFrame([(1, 5)], "a int, b int")
    assert row.select(relations.gate([("first", F.col("a") == 1), ("second", F.col("b") == 5)])).first()[0] == "first"
    assert row.select(relations.flags({"z": F.col("a") == 1, "m": F.col("b") == 5})).first()[0] == "m;z"


def test_fusion_and_mcnemar(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id int, chunk_id int, rank int")
    fused = {r["chunk_id"]: r["fused"] for r in retrieval.reciprocal_rank_fusion([a, a], 30).collect()}
    assert abs(fused[10] - 2 / 31) < 1e-12
    assert evaluate.mcnemar(0, 0) == 1.0 and abs(evaluate.mcnemar(1, 9) - 22 / 1024) < 1e-12


def test_seen_set_keeps_the_newest(spark):
    state = spark.createDataFrame([("a", 1), ("b", 2)], "k string, at int")
    new = spark.createDataFrame([("b", 3), ("c", 4), ("c", 4)], "k string, at int")
    assert [r["k"] for r in incremental.unseen(new, state, "k").collect()] == ["c"]
    assert {(r["k"], r["at"]) for r in incremental.newest_state(state, new, "k", "at", 2).collect()} == {("c", 4), ("b", 2)}


def test_readers(spark, tmp_path):
    (tmp_path / "u.csv").write_text("ticker,company_name,priority\n nvda ,N,1\namd,A,\n")
    rows = {(r["ticker"], r["priority"]) for r in readers.universe_csv(spark, str(tmp_path / "u.csv")).collect()}
    assert rows == {("NVDA", 1), ("AMD", 3)}
    (tmp_path / "s.csv").write_bytes("note\n\nCompany Name;Symbol\nÜber;UB\n".encode("gb18030"))
    assert [(r["Company Name"], r["Symbol"]) for r in readers.sniffed(spark, str(tmp_path / "s.csv"), ["Company Name", "Symbol"]).collect()] == [("Über", "UB")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "Entity.LegalName,LEI\nAcme,123\n")
    assert readers.zipped_csv(spark, str(tmp_path / "z.zip"), ["LegalName", "LEI"]).first()["LegalName"] == "Acme"
    (tmp_path / "m.idx").write_text("Header\n----\n320193|APPLE|10-K|2024-11-01|edgar/data/0000320193-24-000123.txt\n")
    assert readers.pipe_index(spark, str(tmp_path / "m.idx")).first()["accession"] == "0000320193-24-000123"
    (tmp_path / "a.eml").write_text("Subject: New filing\nFrom: x@y.z\n\nSee https://h.example/f1 now\n")
    assert readers.mail_alerts(spark, str(tmp_path / "a.eml")).first()["url"] == "https://h.example/f1"
    (tmp_path / "f.xml").write_text("<r><F><Id>1</Id></F><F><Id>2</Id></F></r>")
    assert readers.xml_records(spark, str(tmp_path / "f.xml"), "F", "Id int").count() == 2
    arrays = spark.createDataFrame([([1, 2], ["a", "b"])], "x array<int>, y array<string>")
    assert [tuple(r) for r in readers.columnar_json(arrays, ["x", "y"]).collect()] == [(1, "a"), (2, "b")]


def test_sinks(spark, tmp_path):
    a, b = spark.createDataFrame([(1,)], "z int"), spark.createDataFrame([(2,)], "a int")
    sinks.union_csv([a, b], f"{tmp_path}/c")
    assert spark.read.csv(f"{tmp_path}/c", header=True).columns == ["a", "z"]
    sinks.run_table(a, f"{tmp_path}/t", "r1")
    sinks.run_table(a, f"{tmp_path}/t", "r2")
    sinks.run_table(spark.createDataFrame([(7,)], "z int"), f"{tmp_path}/t", "r1")
    assert {(r["z"], r["run_id"]) for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {(7, "r1"), (1, "r2")}
    log = spark.createDataFrame([("r", 1, "old"), ("r", 2, "new")], "run_id string, created_at int, note string")
    assert sinks.latest(log).first()["note"] == "new"


def test_monitor_emits_each_event_once(spark, tmp_path):
    schema = "event_id int, at int"
    spark.createDataFrame([(1, 1), (2, 2), (2, 2)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    source = S.event_stream(spark, f"{tmp_path}/in", schema)
    args = (f"{tmp_path}/state", f"{tmp_path}/out", "event_id", "at", 100, f"{tmp_path}/cp")
    S.monitor(source, *args).awaitTermination()
    spark.createDataFrame([(2, 3), (3, 4)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    S.monitor(source, *args).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_windows_and_changes(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows.write.parquet(f"{tmp_path}/in")
    stream = S.windowed_counts(S.event_stream(spark, f"{tmp_path}/in", rows.schema), "ts", "1 day", "1 day", "event_type")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.sql("SELECT sum(n) FROM windows").first()[0] == rows.count()
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert {(r["k"], r["change"]) for r in S.changes(a, b, ["k"]).collect()} == {(1, "removed"), (2, "changed"), (3, "added")}
