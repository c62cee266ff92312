"""Just past sizes at which results might be cut, and cases that the tables don't hold."""

import pytest
from pyspark.sql import functions as F

from tidegraph.functions import text as X
from tidegraph.operators import campaign, extraction, graph, passages, relational, retrieval, surface
from tidegraph.sources import readers, sinks


def test_blocks_over_the_size_lose_no_member(spark):
    rows = spark.createDataFrame([(i, "same") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(4)], "id int, block string")
    found = relational.pairs_in_blocks(rows, "block", "id", 256).collect()
    star = {(r["left_id"], r["right_id"]) for r in found if not r["complete"]}
    assert star == {(0, i) for i in range(1, 300)}
    assert {(r["left_id"], r["right_id"]) for r in found if r["complete"]} == {(1000, 1001), (1002, 1003)}


def test_short_passages_are_found_inside_documents(spark):
    asked = ["quick brown fox", "the quick brown fox tod", "fox", "wn fo", "ox", "x", "the lazy dog sleeps in the sun", "absent words here"]
    bench = spark.createDataFrame(list(enumerate(asked)), "item_id int, text string")
    docs = spark.createDataFrame([(1, "See: the QUICK brown-fox today"), (2, "the lazy dog sleeps, in the sun"), (3, ""), (4, "a boxer")], "doc_id int, text string")
    found = {tuple(r) for r in retrieval.containing(bench, docs, "item_id", "doc_id").select("item_id", "doc_id").collect()}
    assert found == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (4, 4), (5, 1), (5, 4), (6, 2)}


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(700)], "a int, b int")
    assert {r["root"] for r in graph.components(edges).collect()} == {0}


def test_expansion_without_a_cap_takes_every_neighbour(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 500)], "a int, b int")
    assert graph.expand(edges, spark.createDataFrame([(0,)], "node int"), 1, None, [F.col("a")]).count() == 500


def test_a_long_section_is_whole_on_request(spark):
    df = spark.createDataFrame([("Item 1 " + "x" * 200_000,)], "text string")
    sizes = [passages.sections(df, {"one": "Item 1"}, most=m).select(F.length("body")).first()[0] for m in (None, passages.SECTION)]
    assert sizes == [200_007, 180_000]


def test_blank_lines_part_paragraphs():
    text = "a" * 50 + "\n" + "b" * 50 + "\n \n" + "c" * 90
    assert [len(b) for _, b in passages.packed_passages(text)] == [101, 90]


@pytest.mark.parametrize("text,names", [("A Corp., B Inc. and C to supply parts", ["A Corp", "B Inc", "C"]), ("X for testing of chips", ["X"]), ("", [])])
def test_counterparty_lists(spark, text, names):
    assert spark.createDataFrame([(text,)], "x string").select(extraction.counterparties(F.col("x"))).first()[0] == names


def test_triggers_bind_to_their_own_clause(spark):
    text = "We rely on Foo Corp. for wafer fabrication. Competitors include Bar Inc.; power is bought from Baz Ltd."
    df = spark.createDataFrame([("p", "Me", "business", text), ("q", "Me", "exhibit_21", "Foo Corp. is a subsidiary"), ("r", "Me", "business", None)], "passage_id string, company string, section string, text string")
    found = {(r["passage_id"], r["relation_type"], r["object"]) for r in extraction.extract_relations(df).collect()}
    assert ("p", "foundry_dependency", "Foo Corp") in found and ("p", "power_or_utility_dependency", "Baz Ltd") in found
    assert not any(o == "Bar Inc" for _, _, o in found) and ("q", "subsidiary_or_control", "Foo Corp") in found


def test_spans_of_matches(spark):
    row = spark.createDataFrame([("our hour, our",)], "x string").select(extraction.match_spans(F.col("x"), r"\bour\b")).first()[0]
    assert [(s["text"], s["start"], s["end"]) for s in row] == [("our", 0, 3), ("our", 10, 13)]


def test_aliases_are_found_longest_first(spark):
    df = spark.createDataFrame([(1, "Arm makes armour; Arm Holdings too"), (2, None)], "id int, text string")
    rows = [(r["mention"], r["start"], r["stop"]) for r in extraction.alias_spans(df, ["Arm", "Arm Holdings", "our"]).collect()]
    assert rows == [("Arm", 0, 3), ("Arm Holdings", 18, 30)]


def test_a_filing_that_contradicts_itself_is_flagged(spark):
    rows = [("1", "f", "A", "B", "supplier_dependency", "m", "x"), ("2", "f", "A", "B", "supplier_dependency", "m", " X "), ("3", "f", "A", "B", "customer_dependency", "m", "y"), ("4", "g", "A", "B", "customer_dependency", "m", "y")]
    df = spark.createDataFrame(rows, "record_id string, accession string, subject string, object string, relation_type string, modality string, quote string")
    found = {r["record_id"]: (r["repeats"], r["conflict"]) for r in extraction.reconcile(df).collect()}
    assert found == {"1": (2, True), "3": (1, True), "4": (1, False)}


def test_names_that_may_merge(spark):
    pairs = [("Foo Inc.", "FOO Incorporated", True), ("Foo Inc.", "Foo Ltd", False), ("Alpha Beta Gamma Corp", "ABG", True), ("Foo (2", "foo", True), ("", "x", False)]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string").select(surface.may_merge(F.col("a"), F.col("b")).alias("m"))
    assert [r["m"] for r in df.collect()] == [p[2] for p in pairs]


def test_extractors_are_found_by_name(spark):
    df = spark.createDataFrame([("p", "Foo Corp. in 1999 and 2001")], "passage_id string, text string")
    assert {(r["kind"], r["value"]) for r in campaign.extracted(df, ["years", "legal_names"]).collect()} == {("year", "1999"), ("year", "2001"), ("organization", "Foo Corp")}
    with pytest.raises(KeyError):
        campaign.extracted(df, ["nothing"])
    with pytest.raises(ValueError):
        campaign.extractor("years")(lambda p: p)


def test_sniffed_json_and_html(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"Symbol": "A", "Company Name": "Alpha"}, {"Symbol": "B"}]')
    (tmp_path / "b.html").write_text("<table><tr><td>x</td></tr></table><table><tr><th>Company Name</th><th>Symbol</th></tr><tr><td>Ce</td><td>C</td></tr></table>")
    rows = {(r["Company Name"], r["Symbol"]) for r in readers.sniffed(spark, str(tmp_path), ["Company Name", "Symbol"]).collect()}
    assert rows == {("Alpha", "A"), ("", "B"), ("Ce", "C")}


def test_tables_and_documents(spark, tmp_path):
    html = "<table><tr><td>only one</td></tr><tr><td>Revenue of the year</td><td><b>12</b></td></tr></table>"
    assert spark.createDataFrame([(html,)], "x string").select(X.table_rows(F.col("x"))).first()[0] == ["Revenue of the year | 12"]
    small = spark.createDataFrame([(2,), (1,)], "z int")
    sinks.json_document(small, f"{tmp_path}/d")
    assert sorted(r["z"] for r in spark.read.option("multiLine", True).json(f"{tmp_path}/d").collect()) == [1, 2]
    with pytest.raises(ValueError):
        sinks.json_document(small, f"{tmp_path}/e", most=1)


def test_contents_are_compressed_where_it_is_worth_it(spark):
    import os

    rows = [(1, b"a" * 5000), (2, os.urandom(5000)), (3, b"a"), (4, None)]
    made = {r["id"]: r for r in sinks.tiered(spark.createDataFrame(rows, "id int, content binary"), least=100).collect()}
    assert [made[i]["codec"] for i in (1, 2, 3, 4)] == ["zstd", "plain", "plain", "plain"]
    assert len(made[1]["content"]) < 5000 and made[1]["size"] == 5000 and bytes(made[2]["content"]) == rows[1][1]


def phrases(pattern):
    """Strings that a trigger pattern matches: every alternative, each optional part there and not."""
    import re._parser as parser

    def made(items):
        out = [""]
        for kind, value in items:
            name = str(kind)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "IN":
                more = [chr(v) for k, v in value if str(k) == "LITERAL"]
            elif name == "SUBPATTERN":
                more = made(value[-1])
            elif name == "BRANCH":
                more = [x for branch in value[1] for x in made(branch)]
            elif name == "MAX_REPEAT":
                more = [x * n for x in made(value[2]) for n in (value[0], value[0] + 1)]
            elif name == "ANY":
                more = ["x"]
            else:
                assert name == "AT"
                more = [""]
            out = [a + b for a in out for b in more]
        return out

    return made(parser.parse(pattern))


def test_every_trigger_holds_a_piece_that_it_is_tried_for():
    for kind, pattern, _, _ in extraction.X.RELATION_PATTERNS:
        assert [p for p in phrases(pattern) if not any(x in p.lower() for x in extraction.PIECES[kind])] == []


def test_records_of_a_passage_are_told_apart_inside_its_row(spark):
    text = "We purchase parts from Acme Corp. and ACME CORP. Inc. now; vendors like Acme Corp. and Beta Ltd. supply us; cloud hosting by Beta Ltd. stays"
    rows = [("p1", "Us", "business", text, 7), ("p2", "Us", "exhibit_21_list", "Acme Corp. is a subsidiary; Acme Corp. is wholly owned", 8), ("p3", "Us", "business", None, 9)]
    df = spark.createDataFrame(rows, "passage_id string, company string, section string, text string, accession int")
    found = extraction.extract_relations(df, keep=["accession"], unique=True)
    names = found.columns
    inside = sorted(tuple(r[n] for n in names) for r in found.collect())
    assert inside == sorted(tuple(r[n] for n in names) for r in extraction.extract_relations(df, keep=["accession"]).collect())
    assert len({(r[0], r[1], r[names.index("object")].lower()) for r in inside}) == len(inside) >= 4
    assert {r[names.index("accession")] for r in inside} == {7, 8}


@pytest.mark.parametrize("name,scans", [("mention_grounding", 1), ("relation_reconcile", 1), ("record_merge", 0), ("brief_claims", 0)])
def test_passages_are_read_once(spark, sf_dir, name, scans):
    from tidegraph.plans import registry

    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_suppkey#") > 0 if scans else "l_suppkey" not in plan
    assert plan.count("l_extendedprice") == scans


@pytest.mark.parametrize("size", [2048, 7])
def test_vectors_are_compared_block_by_block(spark, tmp_path, monkeypatch, size):
    import random

    from tidegraph.plans import registry

    monkeypatch.setattr(retrieval, "VECTORS", size)
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)], i % 2) for i in range(60)]
    rows += [(100 + i, rows[4][1], 0) for i in range(4)] + [(200, [0.0] * 8, 0), (201, [0.0] * 8, 0), (202, None, 0), (203, [None] + [1.0] * 7, 0), (204, [1.0, 2.0], 0), (205, rows[1][1], None)]
    rows += [(206, [float("nan")] + [1.0] * 7, 1), (207, [1e-30] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    other = df.select("label", F.col("vec_id").alias("right_id"), F.col("embedding").alias("other"))
    plain = df.join(other, "label").where("vec_id < right_id").withColumn("cosine", retrieval.cosine(F.col("embedding"), F.col("other")))
    expected = {(x["vec_id"], x["right_id"], str(round(x["cosine"], 6))) for x in plain.where("cosine >= 0.3").collect()}
    query = registry.queries()["vector_pairs"](spark, str(tmp_path))
    assert {(x["left_id"], x["right_id"], str(x["cosine"])) for x in query.collect()} == expected
    assert "Join" not in query._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]
    edges = plain.where("cosine >= 0.35").select(F.col("vec_id").alias("a"), F.col("right_id").alias("b"))
    roots = lambda x: {(row["node"], row["root"]) for row in x.collect()}
    assert roots(registry.queries()["vector_clusters"](spark, str(tmp_path))) == roots(graph.components(edges))
