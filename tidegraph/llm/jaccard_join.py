"""N-gram Jaccard self-join by chosen paths.

Documents become sets of hashed five-word shingles; equal sets are one row from then on. A set is
embedded as a MinHash signature whose coordinates are tokens shared by similar sets with a
probability equal to their Jaccard similarity. In each run a set follows one path: at every node
the run's seed and the path so far choose a coordinate, and sets with equal values go on together.
A bucket that is small is a leaf; a larger one is split again. A bucket that is left after DEPTH levels
is a leaf if its brute force costs less than branches would, up to half a block of sketches. A larger
one branches: several sampled coordinates lead on from it, DEPTH levels more, and again, so
that sets which only share a passage part; their number and that of the runs follow from the target
recall for a pair at the threshold that always goes to the last level. A bucket whose sets mostly
resemble one of them isn't split, since no coordinate would part it.

Leaves are searched by brute force on sketches of the signatures, a large one block by block over
many tasks, which gives clusters of possible neighbours. Then the whole shingle sets of each cluster
are compared exactly, so every link that is reported or counted is a true one, whatever the paths and
sketches say. A cluster too large for one task is compared block by block; since links are counted
exactly, a group of n different near copies costs in the order of n squared comparisons.

Defined cases: words are lower-cased runs of non-blank characters. A text of one to four words is
one shingle; a null or blank text has no shingles and no links. A text of any length is one set; it
must fit a worker. A pair exactly at the threshold is linked. A document's class is the smallest id of
its connected component, its own without links; rows with one id (ties) are told apart by their sets.
Links count other documents, copies included; repeated rows are copies of each other. A row with a
null id takes no part and has a null class. Other columns, whatever their names, pass through
:func:`deduplicate` and are not carried by :func:`join`."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import documents, drop_scratch, materialise
from tidegraph.llm.components import connected

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Signature coordinates, levels of splitting before a bucket branches, rows in a leaf, sets in a block
#: of exact comparison.
COORDINATES, DEPTH, LEAF, BLOCK = 128, 3, 64, 512
#: Times that a bucket may branch, sketches of a large leaf in a block, tasks that a large bucket's rows
#: are spread over while they are counted.
BRANCHINGS, SKETCHES, SALTS = 2, 4096, 64
#: Sketches may underestimate: clusters are built on pairs this far below the threshold, in
#: standard deviations of the estimate.
SLACK = 4.0
_MEMO = 300_000
_SEEDS = np.random.default_rng(20_18)
_MULTIPLY = _SEEDS.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEEDS.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.arange(1, WORDS + 1, dtype=np.uint64) * _PRIME


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with this probability, if every path goes to the end."""
    return ceil(log(1 - recall) / log(1 - threshold**depth))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_hashes: dict[bytes, int] = {}


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    if len(_hashes) > _MEMO:
        _hashes.clear()
    parts = text.lower().encode("utf-8", "surrogatepass").split()
    for part in set(parts).difference(_hashes):
        _hashes[part] = xxhash.xxh3_64_intdigest(part)
    h = np.fromiter(map(_hashes.__getitem__, parts), dtype=np.uint64, count=len(parts))
    if not len(h):
        return h
    width = min(words, len(h))
    total = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for k in range(width):
        total = _mix(total + h[k : len(h) - width + 1 + k] + _PLACE[k % WORDS])
    return np.unique(total)


def signature(items: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    low = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(items), 4096):
        part = items[at : at + 4096, None] * _MULTIPLY + _ADD
        np.minimum(low, (part >> np.uint64(32)).astype(np.uint32).min(axis=0), out=low)
    return low


def paths(signatures: np.ndarray, runs: int, depth: int = DEPTH) -> np.ndarray:
    """Keys of the path's nodes, by set, run and level; every level extends the one above it."""
    n = len(signatures)
    out = np.zeros((n, runs, depth), dtype=np.uint64)
    key = np.broadcast_to(_mix(np.arange(1, runs + 1, dtype=np.uint64) * _PRIME), (n, runs)).copy()
    for level in range(depth):
        chosen = (key >> np.uint64(17)) % np.uint64(COORDINATES)
        value = np.take_along_axis(signatures, chosen.astype(np.int64), axis=1).astype(np.uint64)
        key = _mix(key * _PRIME + value + np.uint64(level + 1))
        out[:, :, level] = key
    return out


def profiles(df: DataFrame, key: str, text: str, runs: int) -> DataFrame:
    """key, set_key (null without shingles), sketch and path keys of every document."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = [shingles(t) for t in batch.column(1).to_pylist()]
                names = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                signed = np.zeros((len(sets), COORDINATES), dtype=np.uint32)
                for i, s in enumerate(sets):
                    if len(s):
                        signed[i] = signature(s)
                keys = paths(signed, runs).reshape(len(sets), -1).astype(np.int64)
                sketch = [x.tobytes() for x in (signed & np.uint32(0xFF)).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(names, pa.binary()),
                        pa.array(sketch, pa.binary()),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "set_key", "sketch", "keys"],
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, set_key binary, sketch binary, keys array<bigint>")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("set_key"), F.lit(SALTS)).cast("int"))


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` (key, set_key, ...) of buckets with two sets or more, with their ``size``; no bucket's rows meet in one task."""
    rows = _salted(rows)
    parts = rows.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("key").agg(F.sum("n").alias("size"), F.collect_list("salt").alias("salts")).where("size > 1")
    return rows.join(sizes.select("key", "size", F.explode("salts").alias("salt")), ["key", "salt"]).drop("salt")


def _agreement(a: str, b: str) -> Column:
    """Places on which two sketches agree."""
    equal = lambda i: F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1))
    return F.size(F.filter(F.sequence(F.lit(1), F.lit(COORDINATES)), equal))


def _tight(rows: DataFrame, need: int) -> DataFrame:
    """``rows`` (key, set_key, sketch, ...) of large buckets, with whether at least half of a bucket's sets resemble its first one."""
    rows = _salted(rows)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")  # a large bucket has no fewer rows
    first = rows.groupBy("key").agg(F.min_by("sketch", "set_key").alias("lead"))
    near = rows.join(first.select("key", "lead", salts), ["key", "salt"]).select("key", (_agreement("sketch", "lead") >= need).alias("near"))
    share = near.groupBy("key").agg((F.avg(F.col("near").cast("int")) >= 0.5).alias("tight"))
    return rows.join(share.select("key", "tight", salts), ["key", "salt"]).drop("salt")


def leaves(sets: DataFrame, runs: int, least: float, leaf: int = LEAF, depth: int = DEPTH, branchings: int = BRANCHINGS) -> tuple[DataFrame, list[DataFrame]]:
    """(key, blocks, set_key, sketch) of every leaf bucket with at least two sets, and the tables behind them.

    A level counts its buckets; those with one set end, those up to ``leaf`` are leaves, and only the
    members of larger ones go one level down. Buckets over half a block after ``depth`` levels branch
    ``runs`` times, unless they are tight; what is large after all branchings is a leaf of several blocks."""
    one = F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.slice("keys", r * depth + 1, F.lit(depth))
    )
    sketches = sets.select("set_key", "sketch")
    left = sets.select("set_key", F.explode(one).alias("path"))
    out: list[DataFrame] = []
    made: list[DataFrame] = []
    for level in range(depth):
        met = materialise(_counted(left.withColumn("key", F.get("path", F.lit(level)))), "level")
        made.append(met)
        out.append(met.where(F.col("size") <= leaf).select("key", F.lit(1).alias("blocks"), "set_key"))
        large = met.where(F.col("size") > leaf)
        left = large.select("set_key", "path")
    out = [rows.join(sketches, "set_key").select("key", "blocks", "set_key", "sketch") for rows in out]

    blocks = F.ceil(F.col("size") / SKETCHES).cast("int").alias("blocks")
    large = large.select("key", "set_key", "size").join(sketches, "set_key")
    for _ in range(branchings):
        # a branch sends a set on as many times as there are runs: brute force within half a block costs less
        out.append(large.where(F.col("size") <= SKETCHES // 2).select("key", F.lit(1).alias("blocks"), "set_key", "sketch"))
        large = large.where(F.col("size") > SKETCHES // 2)
        if large.isEmpty():
            break
        judged = materialise(_tight(large, ceil(least * COORDINATES)), "judged")
        made.append(judged)
        out.append(judged.where("tight").select("key", blocks, "set_key", "sketch"))
        branch = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("branch")
        below = judged.where("NOT tight").select(F.col("key").alias("above"), "set_key", "sketch", branch)
        below = below.select(F.xxhash64("above", "branch").alias("key"), "set_key", "sketch")
        for _ in range(depth):
            chosen = F.pmod("key", F.lit(COORDINATES)).cast("int") + 1
            value = F.substring(F.col("sketch"), chosen, F.lit(1))
            met = materialise(_counted(below.select(F.xxhash64("key", value).alias("key"), "set_key", "sketch")), "level")
            made.append(met)
            out.append(met.where(F.col("size") <= leaf).select("key", F.lit(1).alias("blocks"), "set_key", "sketch"))
            large = met.where(F.col("size") > leaf).select("key", "set_key", "size", "sketch")
            below = large.select("key", "set_key", "sketch")
    out.append(large.select("key", blocks, "set_key", "sketch"))
    return reduce(DataFrame.unionByName, out), made


def _segments(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal first ``keys`` columns, which the input has side by side."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _reach(sketches: np.ndarray, least: float) -> np.ndarray:
    """Component of each row when rows whose sketches agree on enough places are linked.

    Each row is compared only with rows that no component has reached yet, so a bucket of near
    copies takes about as many comparisons as it has rows."""
    n, group = len(sketches), np.full(len(sketches), -1)
    waiting = np.arange(n)
    need = ceil(least * sketches.shape[1])
    while len(waiting):
        first, waiting = waiting[0], waiting[1:]
        group[first] = first
        frontier = [first]
        while frontier and len(waiting):
            near = (sketches[waiting] == sketches[frontier.pop()]).sum(axis=1) >= need
            new, waiting = waiting[near], waiting[~near]
            group[new] = first
            frontier.extend(new.tolist())
    return group


def _possible(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for rows in _segments(batches, 3):
            if len(rows) > 1:
                sketches = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
                for i, root in enumerate(_reach(sketches, least)):
                    if i != root:
                        a.append(rows[root][3])
                        b.append(rows[i][3])
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by matrix products over shared items."""
    items = np.concatenate([*left, *right])
    names, codes, counts = np.unique(items, return_inverse=True, return_counts=True)
    slot = np.full(len(names), -1)
    shared = np.flatnonzero(counts > 1)  # an item of one set alone meets nothing
    slot[shared] = np.arange(len(shared))
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    column = slot[codes]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    width = max(64, min(8192, 16_000_000 // max(1, len(left) + len(right))))
    for at in range(0, len(shared), width):
        a, b = np.searchsorted(column, (at, at + width))
        block = np.zeros((len(left) + len(right), width), dtype=np.float32)
        block[row[a:b], column[a:b] - at] = 1
        total += block[: len(left)] @ block[len(left) :].T
    return total


def _roots(near: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a symmetric boolean matrix."""
    group = np.full(len(near), -1)
    for first in range(len(near)):
        if group[first] < 0:
            group[first] = first
            frontier = [first]
            while frontier:
                new = np.flatnonzero(near[frontier.pop()] & (group < 0))
                group[new] = first
                frontier.extend(new.tolist())
    return group


def _exact(threshold: float):
    """Links and local components of the sets that meet in one comparison (cluster, i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _segments(batches, 3):
            _, i, j = rows[0][:3]
            unique = {r[3]: r for r in rows}  # a set that several rows brought is one set
            rows = [unique[k] for k in sorted(unique)]
            sets = [np.frombuffer(r[6], dtype=np.uint64) for r in rows]
            size = np.array([len(s) for s in sets], dtype=np.float64)
            copies = np.array([r[5] for r in rows], dtype=np.int64)
            side = np.array([r[4] for r in rows])
            a = np.flatnonzero(side == i)
            b = np.flatnonzero(side == j)
            near = np.zeros((len(rows), len(rows)), dtype=bool)
            if len(a) and len(b):
                met = intersections([sets[x] for x in a], [sets[x] for x in b]).astype(np.float64)
                linked = met >= threshold * (size[a][:, None] + size[b][None, :] - met) - 1e-9
                near[np.ix_(a, b)] = linked
                near |= near.T
            np.fill_diagonal(near, False)
            roots = _roots(near)
            links = near.astype(np.int64) @ copies
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[3] for r in rows], pa.binary()),
                    pa.array([rows[x][3] for x in roots], pa.binary()),
                    pa.array(links, pa.int64()),
                ],
                names=["set_key", "root", "links"],
            )

    return run


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by its shingle set; rows whose text isn't the wanted set's go."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            sets = [shingles(t).tobytes() for t in batch.column(4).to_pylist()]
            keep = [blake2b(s, digest_size=16).digest() == k for s, k in zip(sets, batch.column(1).to_pylist())]
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sets, pa.binary())], names=["cluster", "set_key", "copies", "blocks", "items"])
            yield out.filter(pa.array(keep))


def join(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``key``, class_id, n_links, n_copies of every document."""
    spark = df.sparkSession
    runs = runs_for(recall, threshold)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = materialise(profiles(df, key, text, runs), "profiles")
    named = made.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    # equal sets have equal sketches and keys; the smallest id stands for them
    sets = named.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("sketch").alias("sketch"), F.min("keys").alias("keys")
    )
    sets = materialise(sets, "sets")

    least = threshold - SLACK * (threshold * (1 - threshold) / COORDINATES) ** 0.5
    # any two blocks of a large leaf meet in a task
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    met, levels = leaves(sets, runs, least)
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.where("blocks = 1 OR own <> other").select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set_key", "sketch")
    dealt = met.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    clusters = materialise(connected(dealt.mapInArrow(_possible(least), "a binary, b binary")), "clusters")
    for table in levels:
        drop_scratch(table)

    sizes = clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    member = clusters.join(sizes, "root").select(F.col("root").alias("cluster"), F.col("node").alias("set_key"), "blocks")
    member = member.join(sets.select("set_key", "rep", "copies"), "set_key")
    texts = df.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    read = member.join(texts, "rep").select("cluster", "set_key", "copies", "blocks", "text")
    whole = read.mapInArrow(_with_sets, "cluster binary, set_key binary, copies bigint, blocks int, items binary")
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    spread = whole.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = spread.select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set_key", "block", "copies", "items"
    )
    compared = pairs.repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(
        _exact(threshold), "set_key binary, root binary, links bigint"
    )
    compared = materialise(compared, "compared")
    links = compared.groupBy("set_key").agg(F.sum("links").alias("links"))
    classes = connected(compared.select(F.col("root").alias("a"), F.col("set_key").alias("b")))

    known = sets.select("set_key", "rep", "copies").join(links, "set_key", "left")
    known = known.join(classes.select(F.col("node").alias("set_key"), "root"), "set_key", "left")
    known = known.withColumn("root", F.coalesce("root", "set_key"))
    least_id = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(least_id, "root").select("set_key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    found = made.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(known, "set_key", "left")
    return found.select(
        F.col("doc_id").alias(key),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each class: the one with the smallest id. Null ids stay."""
    heads = join(df, key, text).where(F.col(key) == F.col("class_id")).select(F.col("class_id").alias("__head")).distinct()
    heads = materialise(heads, "heads")
    named = df.where(F.col(key).isNotNull()).join(heads, F.col(key) == F.col("__head"), "left_semi")
    return named.dropDuplicates([key]).unionByName(df.where(F.col(key).isNull()))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir).select("doc_id", "text"))
