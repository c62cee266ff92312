import random

import pytest

WORDS = {"en": "the of and then house water light that with from".split(), "de": "der die und nicht haus wasser licht das mit von".split()}


def prose(lang, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS[lang]) + r.choice(["", "", "er", "ing", "ung"]) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def rows():
    """Null, empty, blank, one-word, long and repeated texts, near copies, ties, junk and personal data."""
    made = [(i, prose("en" if i % 2 else "de", 60 + i, i), "en" if i % 2 else "de") for i in range(40)]
    base = prose("en", 200, 99)
    made += [(100 + i, base, "en") for i in range(5)]
    made += [(110, base.replace(".", " added."), "en"), (111, base + " tail", None)]
    made += [(200, None, "en"), (201, "", "de"), (202, " \n\t ", None), (203, "word", "en"), (204, "12 34 !!", None)]
    made += [(205, prose("en", 30_000, 5), "en"), (206, "x" * 50_000, None), (207, "é😀 中文  x", "en")]
    made += [(300, "mail a.b@c.example.com or +1 (555) 123-4567, 10.0.0.1, card 4111 1111 1111 1111 " + prose("en", 60, 7), "en")]
    made += [(302, "hello <|endoftext|> world, <|startoftext|>!", None)]
    made += [(301, "### *** " * 100, "en"), (301, "### *** " * 100, "en"), (None, prose("de", 70, 8), "de")]
    return made


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names clash with those that operators make."""
    table = [(*r, "s", 1, "a", "b", 2.0, True) for r in rows]
    return spark.createDataFrame(
        table, "doc_id long, text string, lang string, source string, n_chars long, spans string, ids string, score double, kept boolean"
    )


@pytest.fixture(scope="session")
def folder(tmp_path_factory, docs, spark):
    path = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(40)] + [(301, 0, 0), (None, 1, None), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty_folder(tmp_path_factory, docs, spark):
    path = tmp_path_factory.mktemp("empty")
    docs.where("false").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return str(path)
