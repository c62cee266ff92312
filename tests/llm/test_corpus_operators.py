"""Each operator against a plain version in Python, on rows that hold every awkward case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidegraph.llm import bpe, jaccard_join, language_id, language_model, packing, pii, quality, registry, sharding, token_store, topk


def fold(doc, n):
    return 0 if doc is None else zlib.crc32(str(doc).encode()) % n


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_language_is_learned_and_undetermined_is_marked(spark, folder, rows):
    found = language_id.op1_language_id(spark, folder).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert all(by[d]["held_out"] == (fold(d, 4) == 2) for d, _, _ in rows)
    for doc, text, lang in rows:
        r = by[doc]
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif lang and len(words(text)) >= 50 and doc != 301:
            assert r["lang_pred"] == lang


def test_phrases_match_a_plain_parse():
    model = language_id.build_model({"a": ["abcabcabd xyz"], "b": ["zzz yyy"]})
    sample = {"a": "abcabcabd xyz", "b": "zzz yyy"}

    def parse(text, source):
        n = at = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in source:
                size += 1
            at, n = at + size, n + 1
        return n

    for text in ("abcab", "xyz abd", "zzzz", "q", "abdabd zzz yyy"):
        counts, _ = language_id.count_phrases(model, [text])
        assert counts[0].tolist() == [parse(text, sample[k]) for k in model.languages]


def test_eight_languages_in_five_scripts_are_told_apart_held_out(spark):
    import random

    scripts = {"en": (97, 26), "de": (97, 26), "fr": (97, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "zh": (0x4E00, 3000), "ja": (0x3041, 80), "ko": (0xAC00, 2000)}
    table = []
    for n, (lang, (first, size)) in enumerate(scripts.items()):
        r = random.Random(n)
        vocabulary = ["".join(chr(first + r.randrange(size)) for _ in range(r.randint(1, 5))) for _ in range(400)]
        table += [(1000 * n + i, " ".join(r.choice(vocabulary) for _ in range(120)), lang) for i in range(160)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string")
    train = language_id.fold("doc_id", 4) != 2
    found = language_id.predict(df.where(~train), language_id.fit(df.where(train))).collect()
    right, total = Counter(r["lang"] for r in found if r["lang"] == r["lang_pred"]), Counter(r["lang"] for r in found)
    assert set(total) == set(scripts) and all(right[k] >= 0.95 * total[k] for k in total)


def test_bpe_equals_the_library_and_round_trips(spark, folder, rows):
    import base64

    with open(bpe.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = Counter(tuple(r) for r in bpe.op2_bpe_round_trip(spark, folder).collect())
    expected = Counter()
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        expected[(doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert found == expected


def test_perfect_hash_has_no_collisions():
    keys = [str(i).encode() for i in range(3000)]
    h = bpe.MinimalPerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(3000))


def shingle_set(text):
    parts = (text or "").lower().split()
    n = min(5, len(parts))
    return frozenset(tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)) if parts else frozenset()


def brute_join(rows):
    items = [(d, shingle_set(t)) for d, t, _ in rows]
    links, parent = [0] * len(items), list(range(len(items)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(items):
        for j in range(i):
            b, z = items[j]
            if a is not None and b is not None and s and z and len(s & z) >= 0.8 * len(s | z):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return Counter((d, low.get(root(i)), links[i]) for i, (d, _) in enumerate(items))


def test_join_finds_every_link(spark, folder, rows):
    found = jaccard_join.op3_jaccard_join(spark, folder).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == brute_join(rows)


def test_large_clusters_are_compared_by_blocks(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 1)
    found = jaccard_join.op3_jaccard_join(spark, folder).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == brute_join(rows)


def passage_rows():
    """Unlike texts around one long passage, near copies of one of them, and pairs just over and under the threshold."""
    import random

    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    made = [(i, f"{passage} " + " ".join(word() for _ in range(50)), None) for i in range(120)]
    for i in range(40):
        parts = made[i % 3][1].split()
        parts[r.randrange(len(parts))] = word()
        made.append((200 + i, " ".join(parts), None))
    return made


@pytest.mark.parametrize("setting", [{}, {"LEAF": 4}, {"LEAF": 4, "SKETCHES": 8}, {"LEAF": 1, "BRANCHINGS": 1, "SKETCHES": 16}])
def test_join_finds_links_among_texts_with_a_common_passage(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(jaccard_join, name, value)
        if name in ("LEAF", "BRANCHINGS"):
            plain = jaccard_join.leaves.__defaults__
            monkeypatch.setattr(jaccard_join.leaves, "__defaults__", tuple(value if d == {"LEAF": 64, "BRANCHINGS": 2}[name] else d for d in plain))
    rows = passage_rows()
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == brute_join(rows)


def test_a_bucket_within_half_a_block_is_not_branched(spark):
    import random

    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(120))
    texts = [(i, f"{passage} " + " ".join(word() for _ in range(35))) for i in range(300)]
    made = jaccard_join.profiles(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", 10)
    met, tables = jaccard_join.leaves(made.select("set_key", "sketch", "keys"), 10, 0.66)
    # the runs send a set to ten leaves at most; branches would multiply them
    assert len(tables) == jaccard_join.DEPTH and met.count() <= 10 * 300 and met.where("blocks > 1").isEmpty()


def test_deduplicate_keeps_one_of_each_class(spark, docs, rows):
    kept = [r["doc_id"] for r in jaccard_join.deduplicate(docs).collect()]
    classes = brute_join(rows)
    assert sorted(k for k in kept if k is not None) == sorted({c for _, c, _ in classes if c is not None})
    assert kept.count(None) == 1


def test_shards_differ_by_one_at_most_and_keep_copies_together(spark, folder, rows):
    found = sharding.op4_sharding(spark, folder).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows
    )
    counts = Counter(r["shard"] for r in found)
    assert set(counts) <= set(range(8)) and max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    assert len({r["shard"] for r in found if r["doc_id"] is not None and 100 <= r["doc_id"] < 105}) == 1


@pytest.mark.parametrize("singles", [0, 500])
def test_a_text_over_the_quota_leaves_smaller_groups_whole(spark, singles):
    texts = ["hot"] * 1000 + [f"group {i // 5}" for i in range(2000 - singles)] + [f"single {i}" for i in range(singles)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shards = {}
    for r in sharding.assign(df).collect():
        shards.setdefault(texts[r["doc_id"]], Counter())[r["shard"]] += 1
    loads = sum(shards.values(), Counter())
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) <= 1
    links = sharding.cut(sharding.assign(df)).first()
    assert links["links"] == sum(sum(c.values()) - 1 for c in shards.values()) and links["kept"] == sum(max(c.values()) - 1 for c in shards.values())
    torn = sum(len(c) > 1 for t, c in shards.items() if t.startswith("group"))
    # without singles every shard is full to the last row, and its last group may have to be cut
    assert torn <= (0 if singles else 8)


def test_propagation_decides_what_stays_together(spark):
    df = spark.createDataFrame([(i, f"group {i // 4}" if i < 400 else f"single {i}") for i in range(800)], "doc_id long, text string")
    before, after = (sharding.cut(sharding.assign(df, rounds=n)).first() for n in (0, sharding.ROUNDS))
    assert before["links"] == after["links"] == 300
    assert before["kept"] < 200 and after["kept"] == 300


def test_token_store_describes_documents_from_its_files(spark, folder, docs, rows, tmp_path):
    library = Tokenizer.from_file(token_store.TOKENIZER)
    coded = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in rows]
    found = token_store.op5_token_store(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in coded), key=lambda d: -1 if d is None else d)
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter((d, len(i), crc(i)) for d, i in coded)
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs, path)
    assert token_store.verify(spark, path)
    whole = Counter((r["doc_id"], tuple(r["ids"])) for r in token_store.read_documents(spark, path).collect())
    assert whole == Counter((d, tuple(i)) for d, i in coded)
    chunks = [bytes(r["digest"]) for r in token_store.read_chunks(spark, path).collect()]
    assert len(chunks) == len(set(chunks))


def test_verify_notices_a_changed_recipe(spark, docs, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs.limit(5), path)
    recipes = spark.read.parquet(f"{path}/recipes").selectExpr("part", "doc_id", "n_tokens + 1 AS n_tokens", "digests", "local_start", "link")
    changed = recipes.collect()
    spark.createDataFrame(changed, recipes.schema).write.mode("overwrite").parquet(f"{path}/recipes")
    assert not token_store.verify(spark, path)


def test_reading_notices_a_changed_chunk(spark, docs, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(docs.where("doc_id < 3"), path)
    body = spark.read.parquet(f"{path}/body")
    rows = [(r["digest"], None if r["body"] is None else bytes(r["body"][:-1]) + b"x", r["doc_id"], r["n_tokens"], r["kind"]) for r in body.collect()]
    spark.createDataFrame(rows, "digest binary, body binary, doc_id long, n_tokens long, kind int").write.mode("overwrite").partitionBy("kind").parquet(f"{path}/body")
    with pytest.raises(Exception, match="is not what was stored"):
        token_store.read_digests(spark, path).collect()


def test_full_pieces_fill_sequences_of_their_own(spark):
    found = packing.pack(spark.createDataFrame([(i, 50 if i % 3 else 20) for i in range(30)], "doc_id long, length long"), 2, 50).collect()
    assert len(found) == 30 and len({(r["sequence_id"], r["offset"]) for r in found}) == 30
    assert len({r["sequence_id"] for r in found if r["length"] == 50}) == 20
    assert all(r["sequence_id"] >= packing.FULL for r in found if r["length"] == 50)


@pytest.mark.parametrize("n,k,copies", [(300, 10, 1), (500, 10, 200), (7, 10, 3)])
def test_top_k_is_exact(spark, n, k, copies):
    r = np.random.default_rng(n)
    vectors = r.normal(size=(n, 8)).astype(np.float32)
    vectors[:copies] = vectors[0]
    table = [(i, v.tolist()) for i, v in enumerate(vectors)]
    extra = [(1000, None), (1100, [float("nan")] * 8), (1200, [1.0, None] + [0.0] * 6), (1300, [float("inf")] * 8), (1400, [1.0, 2.0])]
    df = topk.quantised(spark.createDataFrame(table + extra, "vec_id long, embedding array<float>"))
    found = topk.top_k(df, df.where("vec_id % 100 = 0"), k, shard=64).collect()
    whole = np.floor(1024 * vectors.astype(float)).astype(np.int64)
    expected = set()
    for q in range(0, n, 100):
        best = sorted((-int(whole[i] @ whole[q]), i) for i in range(n) if i != q)[:k]
        expected |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(x) for x in found} == expected


@pytest.mark.parametrize("top", [30, 40, 60, 900])
def test_top_k_is_exact_beyond_doubles(spark, top):
    r = np.random.default_rng(top)
    table = [(i, [float(x) * 2.0 ** int(e) for x, e in zip(r.normal(size=6), r.integers(-5, top, 6))]) for i in range(200)]
    table += [(200, [1.0] + [0.0] * 5), (201, [3e6] + [0.0] * 5), (202, [4e6] + [0.0] * 5), (203, [0.0] * 6), (150, [2.0**top] * 6)]
    df = spark.createDataFrame([(*t, 1, 2.0, "x") for t in table], "vec_id long, embedding array<double>, rank int, score double, v string")
    q = topk.quantised(df)
    found = {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in topk.top_k(q, q.where("vec_id % 50 = 0"), 10, shard=32).collect()}
    whole = [(i, [math.floor(x * 1024) if abs(x) < 2.0**52 else int(x) * 1024 for x in v]) for i, v in table]
    expected = set()
    for own, query in whole:
        if own % 50 == 0 and own != 150:
            best = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in whole if i != own)[:10]
            expected |= {(own, rank, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for rank, (s, i) in enumerate(best, 1)}
    assert {x for x in found if x[0] != 150} == expected
    assert {(x[0], x[1]) for x in found} >= {(150, 1)}


def luhn(digits):
    return sum(n if i % 2 == 0 else 2 * n - 9 * (n > 4) for i, n in enumerate(map(int, digits[::-1]))) % 10 == 0


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {
                "email": True, "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }
            if holds[name]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data_equals_the_base_rules(spark, folder, rows, tmp_path):
    import random

    r = random.Random(3)
    parts = ["a", "b.c", "@", "1", "255", "256", ".", "-", " ", "+", "(", "4111 1111 1111 1111", "+1 (017) 555-7713", "é😀", "x@y.zz", "1.2.3.4", "\n"]
    fuzz = [(1000 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 25))), None) for i in range(400)]
    fuzz += [(2001, "1" * 20_000, None), (2002, "a@b" + ".c" * 9000, None), (2003, "x@y.zz " * 700, None)]
    spark.createDataFrame(fuzz, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for source, table in ((folder, rows), (str(tmp_path), fuzz)):
        found = Counter((x["doc_id"], x["n_email"], x["n_ip"], x["n_card"], x["n_phone"], x["base_sha256"]) for x in pii.op7_pii(spark, source).collect())
        expected = Counter()
        for doc, text, _ in table:
            spans = base_spans(text)
            listed = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
            expected[(doc, *[sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(listed.encode()).hexdigest())] += 1
        assert found == expected


def test_redaction_leaves_clean_text_and_other_columns_alone(spark, docs, rows):
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    by = {r["doc_id"]: r for r in clean.collect()}
    assert by[300]["text"].startswith("mail [EMAIL] or [PHONE], [IP], card [CARD] ")
    assert all(by[d]["text"] == t for d, t, _ in rows if d != 300)
    assert by[300]["spans"] == "a"


@pytest.mark.parametrize("number", ["212.555.0187", "(212) 555.0187", "212 555.0187", "212-555-0187"])
def test_a_number_without_a_hyphen_is_a_candidate_and_redacted(spark, number):
    df = spark.createDataFrame([(i, f"Please call {number} now", "en") for i in range(20)], "doc_id long, text string, lang string")
    spans = pii.candidates(df).first()["spans"]
    assert [(x["kind"], x["text"]) for x in spans] == [(3, number)]
    assert {r["text"] for r in pii.redact(df).collect()} == {"Please call [PHONE] now"}


def test_estimation_separates_reliable_votes():
    good, bad = (2 * 3 + 2) * 9 + 2 * 3 + 2, (0 * 3 + 0) * 9 + 1 * 3 + 0
    posterior = pii.estimate({(0, good): 500, (0, bad): 300})
    assert posterior[0, good] > 0.95 and posterior[0, bad] < 0.05


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_decreasing_equals_a_plain_one(seed):
    import random

    r = random.Random(seed)
    sizes = [r.randint(1, 50) for _ in range(200)]
    bins, offsets = packing.first_fit_decreasing(sizes, 50)
    free, expected = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if b == len(free):
            free.append(50)
        expected[i] = b
        free[b] -= sizes[i]
    assert bins == expected and len(set(zip(bins, offsets))) == len(sizes)


def test_packing_places_every_id_once(spark, folder, rows):
    library = Tokenizer.from_file(packing.TOKENIZER)
    found = packing.op8_packing(spark, folder).collect()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    for doc, text, _ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        pieces = sorted(by[doc], key=lambda r: r["start"])[:: 2 if doc == 301 else 1]
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces[:-1])]).tolist()
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids) for p in pieces)
    sequences = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 2048


def test_quality_statistics_equal_a_plain_count(spark, folder, rows):
    found = Counter(tuple(r)[:7] for r in quality.op9_quality_rules(spark, folder).collect())
    expected = Counter()
    for doc, text, _ in rows:
        w, t = words(text), text or ""
        lines = [x for x in t.split("\n") if words(x)]
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected[(doc, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)] += 1
    assert found == expected


def test_a_rule_is_learned_from_the_labels(spark):
    rows = [(i, float(i % 10), 1.0 if i % 10 < 7 else 0.0) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, a double, quality double")
    from pyspark.sql import functions as F

    rules = quality.learn(table, F.col("quality") == 0, features=("a",))
    assert len(rules) == 1 and rules[0][0].at_least and 6 < rules[0][0].cut <= 7


def test_language_model_beats_the_base_and_counts_exactly(spark, folder, rows):
    lower = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] + [None]
    counts = Counter()
    for doc, text, _ in rows:
        if fold(doc, 7) != 2:
            counts.update(lower(text))
    n, v = sum(counts.values()), len(counts)
    found = language_model.op10_lm_scoring(spark, folder).collect()
    assert len(found) == len(rows)
    texts = {d: t for d, t, _ in rows}
    for r in found:
        tokens = lower(texts[r["doc_id"]])
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] <= 0
        assert r["held_out"] == (fold(r["doc_id"], 7) == 2)
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_seating_keeps_its_customers():
    r = np.random.default_rng(1)
    owner, where = np.repeat(np.arange(50), 2), np.tile([0, 1], 50)
    counts = r.integers(0, 30, 100)
    totals = language_model.Totals(
        np.bincount(where, weights=counts, minlength=128).astype(int), np.bincount(where, weights=counts > 0, minlength=128).astype(int), int(counts.sum()), 50
    )
    seating = language_model.Seating(owner, where, counts, 50, totals, 3)
    for _ in range(20):
        seating.sweep()
        seating.seat_parent()
        assert (np.bincount(seating.of, weights=seating.size, minlength=100) == counts).all() and (seating.size > 0).all()
    assert seating.per_pair().max() > 1 and (seating.per_pair()[counts > 0] >= 1).all()
    assert 0.5 < seating.parent().sum() < 1.01


def plain_gibbs(counts, types, passes, seed):
    """Mean tables by (context, word) of a sampler that moves one customer at a time, table by table."""
    import random

    r, lm = random.Random(seed), language_model
    seats, root = {k: [] for k in counts}, {w: [] for _, w in counts}
    held = lambda c: sum(len(t) for (x, _), t in seats.items() if x == c)

    def root_word(w):
        n, t = sum(sum(x) for x in root.values()), sum(map(len, root.values()))
        return (sum(root[w]) - lm.ROOT_DISCOUNT * len(root[w]) + (lm.ROOT_STRENGTH + lm.ROOT_DISCOUNT * t) / (types + 1)) / (lm.ROOT_STRENGTH + n)

    def root_add(w):
        t = sum(map(len, root.values()))
        weights = [x - lm.ROOT_DISCOUNT for x in root[w]] + [(lm.ROOT_STRENGTH + lm.ROOT_DISCOUNT * t) / (types + 1)]
        k = r.choices(range(len(weights)), weights)[0]
        root[w][k:k + 1] = [root[w][k] + 1] if k < len(root[w]) else [1]

    def root_remove(w):
        k = r.choices(range(len(root[w])), root[w])[0]
        root[w][k:k + 1] = [root[w][k] - 1] if root[w][k] > 1 else []

    def add(key):
        c, w = key
        weights = [x - lm.DISCOUNT for x in seats[key]] + [(lm.STRENGTH + lm.DISCOUNT * held(c)) * root_word(w)]
        k = r.choices(range(len(weights)), weights)[0]
        if k == len(seats[key]):
            root_add(w)
            seats[key].append(1)
        else:
            seats[key][k] += 1

    for key, n in counts.items():
        for _ in range(n):
            add(key)
    total = Counter()
    for turn in range(passes):
        for key, n in counts.items():
            for _ in range(n):
                k = r.choices(range(len(seats[key])), seats[key])[0]
                seats[key][k] -= 1
                if not seats[key][k]:
                    del seats[key][k]
                    root_remove(key[1])
                add(key)
        if turn >= passes // 4:
            total.update({k: len(t) for k, t in seats.items()})
    return {k: n / (passes - passes // 4) for k, n in total.items()}


def test_seating_agrees_with_a_plain_sampler():
    r, words, contexts = np.random.default_rng(5), 12, 6
    counts = {(c, w): int(n) for c in range(contexts) for w in range(words) if (n := r.geometric(0.12) * (r.random() < 0.7))}
    plain = plain_gibbs(counts, words, 1200, 3)
    keys = sorted((w, c) for c, w in counts)
    owner, where = np.array([k[0] for k in keys]), np.array([k[1] for k in keys])
    held = np.array([counts[c, w] for w, c in keys])
    totals = language_model.Totals(
        np.bincount(where, weights=held, minlength=contexts).astype(int), np.bincount(where, minlength=contexts), int(held.sum()), words
    )
    seating, found = language_model.Seating(owner, where, held, words, totals, 7), np.zeros(len(keys))
    for turn in range(2100):
        seating.sweep()
        seating.seat_parent()
        if turn >= 100:
            found += seating.per_pair() / 2000
    expected = np.array([plain[c, w] for w, c in keys])
    assert abs(found.sum() - expected.sum()) < 0.06 * expected.sum()
    assert abs(found - expected).mean() < 0.08 * expected.mean() and abs(found - expected).max() < 0.15 * expected.max()


def test_contexts_are_whole_words(spark):
    texts = ["a the cat . " * 6, "a she dog . " * 6] * 30 + ["a the cat .", "a she cat ."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: x["score"] for x in language_model.score(df, language_model.F.col("doc_id") < 60).where("doc_id >= 60").collect()}
    assert found[60] > found[61] + 1


def test_contexts_whose_hashes_agree_in_low_bits_stay_apart(spark):
    import xxhash

    seen = {}
    for i in range(1_000_000):
        low = xxhash.xxh3_64_intdigest(b"w%d" % i) & ((1 << 20) - 1)
        if low in seen:
            break
        seen[low] = i
    one, two = f"w{seen[low]}", f"w{i}"
    texts = [f"{one} cat . {two} dog . " * 6] * 60 + [f"{one} cat .", f"{one} dog ."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: x["score"] for x in language_model.score(df, language_model.F.col("doc_id") < 60).where("doc_id >= 60").collect()}
    assert found[60] > found[61] + 1


def dealt(rows, task):
    """The rows that a task makes of (to, other, blob), in the order that Spark deals them in."""
    import pyarrow as pa

    rows = [r for r in rows if r["blob"]]
    batch = pa.table({k: [r[k] for r in sorted(rows, key=lambda r: (r["to"], r["other"]))] for k in ("to", "other", "blob")})
    return [r for b in task(iter(batch.to_batches())) for r in b.to_pylist()]


def test_ranges_and_chunks_are_told_all_tables_of_their_contexts(monkeypatch):
    import pyarrow as pa

    lm, r, ranges = language_model, random.Random(4), 20
    monkeypatch.setattr(lm, "CHUNK_DOCS", 40)
    texts = [" ".join(f"w{int(r.paretovariate(0.7)) % 300}" for _ in range(r.randint(0, 60))) for _ in range(240)]
    followers, count = {}, Counter()
    for doc, text in enumerate(texts):
        code = lm.tokens(text)
        for before, word in zip([lm.END, *code], code):
            followers.setdefault(before, set())
            if doc % 5:
                followers[before].add(word)
                count[before] += 1
    batch = pa.table({"doc_id": range(240), "text": texts, "train": [d % 5 > 0 for d in range(240)]})
    made = [x for b in lm._count(ranges)(iter(batch.to_batches())) for x in b.to_pylist()]
    of = lambda rows, *kinds: [x for x in rows if x["kind"] in kinds]
    merged = dealt(of(made, "pairs"), lm._merge(ranges))
    met = dealt(of(merged, "sent", "asked"), lm._meet)
    heads = {(x["to"], x["other"]): lm._unpack(x["blob"])["heads"].tolist() for x in of(merged, "sent")}
    again = dealt(of(met, "index") + of(merged, "sent"), lm._exchange(False))
    assert len({to for to, _ in heads}) > 1 and len({part for _, part in heads}) > 10
    for told in (of(met, "told"), of(again, "told")):
        assert len(told) == len(heads)
        for x in told:
            found, codes = lm._unpack(x["blob"]), heads[x["other"], x["to"]]
            assert found["tables"].tolist() == [len(followers[c]) for c in codes]
            assert found["customers"].tolist() == [count[c] for c in codes]
    backs, docs = dealt(of(met, "index") + of(merged, "sent"), lm._exchange(True)), of(made, "docs")
    assert len(docs) == 6
    for x in docs:
        blobs = sorted((y["other"], y["blob"]) for y in of(backs, "backs") if y["to"] == x["to"])
        ids = lm._unpack(x["blob"])["ids"]
        codes = sorted({c for d in ids for c in lm.tokens(texts[d])})
        assert np.concatenate([lm._unpack(b)["tables"] for _, b in blobs]).tolist() == [len(followers[c]) for c in codes]


def test_many_ranges_score_like_one(spark, monkeypatch):
    r = random.Random(4)
    texts = [" ".join(f"w{int(r.paretovariate(0.7)) % 300}" for _ in range(r.randint(0, 60))) for _ in range(240)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored = lambda: {x["doc_id"]: x for x in language_model.score(df, language_model.F.col("doc_id") % 5 > 0).collect()}
    one = scored()
    monkeypatch.setattr(language_model, "RANGE_DOCS", 6)
    many = scored()
    assert len(one) == len(many) == 240
    for d, x in one.items():
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (many[d]["n_tokens"], many[d]["n_known"], many[d]["train_tokens"])
    off = [abs(x["score"] - many[d]["score"]) / x["n_tokens"] for d, x in one.items()]
    assert np.mean(off) < 0.03
    assert abs(sum(x["score"] for x in one.values()) / sum(x["score"] for x in many.values()) - 1) < 0.01


def test_pairs_and_shuffles_leave_the_disk_as_they_are_read(spark, monkeypatch, tmp_path):
    import time
    from pathlib import Path

    lm, r, made, seen, left, setting = language_model, random.Random(4), [], [], [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    texts = [" ".join(f"w{int(r.paretovariate(0.7)) % 3000}" for _ in range(r.randint(0, 200))) for _ in range(240)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {f for d in folders for f in Path(d).glob("*/shuffle_*.data")}
    size = lambda files: sum(f.stat().st_size for f in files if f.exists())
    kept = lambda kind: size(tmp_path.glob(f"*/kind={kind}*/*.parquet"))
    before, delete, was = shuffles(), lm.delete, spark.conf.get(setting, None)

    def path(_, name):
        made.append(name)
        return f"file://{tmp_path}/{name}-{len(made)}"

    def noted(session, path):
        if "kind=pairs" in path:
            seen.append((kept("pairs"), kept("core")))
        most, until = seen[0][0] / 10, time.time() + 10
        while all(left) and size(shuffles() - before) > most and time.time() < until:
            time.sleep(0.1)
        left.append(size(shuffles() - before) <= most)
        delete(session, path)

    monkeypatch.setattr(lm, "RANGE_DOCS", 6)
    monkeypatch.setattr(lm, "scratch_path", path)
    monkeypatch.setattr(lm, "delete", noted)
    assert lm.score(df, lm.F.col("doc_id") % 5 > 0).count() == 240
    pairs, cores = (max(x) for x in zip(*seen))
    assert pairs and cores and kept("pairs") == 0
    assert all(p / pairs + c / cores < 1.6 for p, c in seen)  # never all pairs beside all that is made of them
    assert len(left) > 5 and all(left)
    assert spark.conf.get(setting, None) == was


def expected_tables(count, others, served, root):
    """Mean tables by the recursion over all seatings of ``count`` customers."""
    lm = language_model
    j, ways = np.arange(count + 1), np.full(count + 1, -np.inf)
    ways[1] = 0.0
    for c in range(1, count):
        room = np.log(np.maximum(c - lm.DISCOUNT * j, 1e-300))
        ways = np.logaddexp(np.concatenate([[-np.inf], ways[:-1]]), np.where(j <= c, room + ways, -np.inf))
    step = np.log((lm.STRENGTH + lm.DISCOUNT * (others + j)) * (served + j) / (root + j))
    ways[1:] += np.concatenate([[0.0], np.cumsum(step[1:-1])])
    p = np.exp(ways - ways.max())
    return float((p * j).sum() / p.sum())


@pytest.mark.parametrize("count,others,served,root", [(2, 50, 3, 100), (90, 500, 40, 900), (256, 30, 1, 60), (257, 30, 1, 60), (6000, 900, 80, 2000), (6000, 2, 0.01, 5000), (9000, 40_000, 3000, 9000)])
def test_all_customers_of_a_pair_are_seated_again(count, others, served, root):
    n, random = 400, np.random.default_rng(count)
    whole = lambda x: np.full(n, x)
    t = whole(1)
    drawn = []
    for turn in range(14):
        t = language_model.draw_tables(random, whole(count), t, whole(float(others)), whole(float(served)), whole(float(root)), 12 if turn == 0 else 1)
        if turn >= 8:
            drawn.append(t)
    expected, spread = expected_tables(count, others, served, root), np.std(drawn)
    assert abs(np.mean(drawn) - expected) < 4 * spread / math.sqrt(n) + 0.005 * expected


def test_a_frequent_pair_gets_as_many_tables_as_its_count_asks_for():
    counts = np.array([1_000_000, 200_000, *[3] * 98])
    owner, where = np.arange(100), np.zeros(100, dtype=np.int64)
    customers, tables = np.zeros(128, dtype=np.int64), np.zeros(128, dtype=np.int64)
    customers[0], tables[0] = counts.sum(), 100
    seating = language_model.Seating(owner, where, counts, 100, language_model.Totals(customers, tables, int(counts.sum()), 100), 3)
    for _ in range(language_model.PASSES):
        seating.sweep()
        seating.seat_parent()
    found = seating.per_pair()
    assert found[0] > 1000 and found[1] > 300 and (found <= counts).all()


@pytest.mark.parametrize("name", [n for n in registry.queries()])
def test_empty_tables_give_no_rows(spark, empty_folder, name):
    assert registry.queries()[name](spark, empty_folder).collect() == []
