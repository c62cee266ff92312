"""The pipeline against a plain version of its contracts, stage by stage."""

import random

import corpus_pipeline
from tidegraph.llm import jaccard_join, language_id, quality


def test_stages_keep_columns_and_take_effect(spark, folder, docs):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    names = table.columns
    kept = corpus_pipeline.quality_rules(spark, table, folder)
    assert kept.columns == names
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(table, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == sorted((d or -1) for d, k in judged.items() if k)
    spoken = corpus_pipeline.language(spark, kept, folder)
    assert spoken.columns == names and {r["lang"] for r in spoken.collect()} <= {"en", "de"}
    single = corpus_pipeline.near_duplicates(spark, spoken, folder)
    ids = [r["doc_id"] for r in single.collect()]
    assert single.columns == names and len(ids) == len(set(ids))
    assert 100 in ids and not {101, 102, 103, 104, 110, 111} & set(ids)
    clean = corpus_pipeline.personal_data(spark, single, folder)
    assert clean.columns == names
    assert all("@c.example" not in r["text"] for r in clean.collect())
    packed = corpus_pipeline.pack(spark, clean, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(ids)


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    by_hand = sorted((r["doc_id"] or -1, r["start"], r["length"], r["ids_crc32"]) for r in docs.collect())
    assert sorted((r["doc_id"] or -1, r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()) == by_hand


def test_undetermined_language_is_rejected(spark):
    rows = spark.createDataFrame([(1, "12 34", None), (2, None, None)], "doc_id long, text string, lang string")
    assert corpus_pipeline.language(spark, rows, "").collect() == []
    assert language_id.UNDETERMINED == "und" and jaccard_join.runs_for() >= 10


def test_a_text_that_no_sample_explains_is_rejected(spark, rows):
    r = random.Random(4)
    finnish = "kaikki ihmiset syntyvät vapaina tasavertaisina arvoltaan oikeuksiltaan heille järki omatunto heidän toimittava toisiaan kohtaan hengessä".split()
    letters = "abcdefghijklmnopqrstuvwxyz"
    strange = [
        " ".join(r.choice(finnish) for _ in range(300)),
        " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(300)),
        "".join(r.choice(letters) for _ in range(3000)),
    ]
    # the last eight are clean, and no sample holds them
    clean = [(d, text, lang if d < 32 else None) for d, text, lang in rows[:40]]
    table = [*clean, *((1000 + i, text, None) for i, text in enumerate(strange)), (2000, "the water", None)]
    found = corpus_pipeline.language(spark, spark.createDataFrame(table, "doc_id long, text string, lang string"), "")
    assert sorted(x["doc_id"] for x in found.collect()) == [*range(40), 2000]
