"""Steps of a text that need its order, against their definitions."""

from pyspark.sql import functions as F

from tidegraph.operators import extraction
from tidegraph.operators import passages as P
from tidegraph.plans import domain
from tidegraph.session import table


def test_passages_are_packed_between_sentences():
    text = "One two three. " * 10 + "\n\nshort\n\n" + "x" * 300
    found = P.packed_passages(text, 80, 60)
    assert [n for n, _ in found] == list(range(len(found)))
    assert all(len(b) <= 60 or " " not in b for _, b in found) and "short" not in "".join(b for _, b in found)
    assert " ".join(b for _, b in found[:-1]) == ("One two three. " * 10).strip()


def test_chunks_cover_the_text_and_overlap():
    text = " ".join(f"w{i}" for i in range(900))
    found = P.overlapping(text, 400, 80)
    assert found[0][1] == text[: len(found[0][1])] and text.endswith(found[-1][1])
    at = 0
    for _, body in found:
        place = text.index(body)
        assert place <= at
        at = place + len(body)
    assert at == len(text) and P.overlapping("") == []


def test_sections_begin_after_the_contents(spark):
    rows = spark.createDataFrame([(1, "Item 1 Item 2 ... Item 1 first body Item 2 second body"), (2, None)], "k int, text string")
    found = {(r["section"], r["start"]) for r in P.sections(rows, {"one": "Item 1", "two": "Item 2"}, skip=15).collect()}
    assert found == {("one", 18), ("two", 36)}


def test_mentions_are_longest_first_and_word_bounded(spark):
    rows = spark.createDataFrame([("harmful arm and TSMC Arizona, TSMC",)], "text string")
    found = [(r["mention"], r["start"]) for r in extraction.alias_spans(rows, ["arm", "TSMC", "TSMC Arizona"]).collect()]
    assert found == [("arm", 8), ("TSMC Arizona", 16), ("TSMC", 30)]


def test_greedy_spans_and_expressions(spark):
    assert P.greedy_spans([(0, 5), (3, 8), (5, 9), (8, 12)]) == [0, 2]
    assert P.evaluate("2 + 3 * (4 - 1)^2") == 29.0 and P.evaluate("__import__('os')") is None and P.evaluate("1/0") is None
    row = spark.createDataFrame([("1+1", "abcd", "abce")], "e string, a string, b string")
    value, ratio = row.select(P.evaluated(F.col("e")), P.sequence_ratio(F.col("a"), F.col("b"))).first()
    assert value == 2.0 and ratio == 0.75


def test_passage_queries_equal_a_plain_loop(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    found = {(r["doc_id"], r["passage"], r["size"]) for r in domain.packed_passages(spark, sf_dir).collect()}
    assert found == {(d, n, len(b)) for d, t in texts.items() for n, b in P.packed_passages(t)}
    found = {(r["doc_id"], r["chunk"], r["size"]) for r in domain.overlapping_chunks(spark, sf_dir).collect()}
    assert found == {(d, n, len(b)) for d, t in texts.items() for n, b in P.overlapping(t)}
