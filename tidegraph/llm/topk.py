"""Exact top-k by inner product with KD-trees per shard.

Vectors are dealt evenly into shards of bounded size. Each shard becomes a KD-tree: median splits
on the widest dimension, tight bounding boxes, leaves of a few dozen vectors. A query walks a tree
best first by the box's upper bound on the inner product and stops when no box can reach its k-th
score. Queries go in blocks: each block first searches one shard, and takes the k-th score found
there along to all other shards, where most boxes are then out of reach.

Scores are exact whatever the components: where doubles can't hold every sum, boxes are bounded with
room for the rounding and vectors are scored in whole numbers.

Defined cases: null vectors, and vectors with null or non-finite components, take no part. Vectors
of another length than the query's are no candidates. Equal scores go to the smaller id. "The query's
own row" is read as every row with the query's id: repeated ids are candidates of their own for other
queries and never for each other, and rows that repeat a query's id and vector ask once. With fewer
candidates than k all are returned; an empty table gives no rows. A score beyond 64 bits is ranked by
its exact value and reported as the nearest 64-bit one. Other columns, whatever their names, are not
carried."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.llm.common import materialise

K, SCALE, EVERY = 10, 1024, 100
#: Vectors in a shard, vectors in a leaf, queries in a block.
SHARD, LEAF, BLOCK = 4096, 32, 256
_EXACT = float(1 << 53)


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of every component, for the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = ~F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x * scale) == float("inf")), F.lit(True)))
    # a double of 2 to the 52nd or more is whole already
    floor = F.transform(v, lambda x: F.when(F.abs(x * scale) < float(1 << 52), F.floor(x * scale).cast("double")).otherwise(x * scale))
    return df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(fine).select(
        F.col(key).cast("long").alias("vec_id"), floor.alias("v")
    )


class KDTree:
    """One shard of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # by id first: with equal vectors the smaller ids then lie in the earlier leaves
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.low, self.high, self.least_id = [], [], []
        self.children: list[tuple[int, int] | None] = []
        self.span: list[tuple[int, int] | None] = []
        rows: list[np.ndarray] = []
        filled = 0

        def grow(part: np.ndarray) -> int:
            nonlocal filled
            node, points = len(self.low), vectors[part]
            low, high = points.min(axis=0), points.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.least_id.append(int(ids[part].min()))
            self.children.append(None)
            self.span.append(None)
            if len(part) <= LEAF:
                rows.append(part)
                self.span[node] = (filled, filled + len(part))
                filled += len(part)
            else:
                axis = int((high - low).argmax())
                by = part[np.argsort(points[:, axis], kind="stable")]
                half = len(by) // 2
                self.children[node] = (grow(by[:half]), grow(by[half:]))
            return node

        grow(np.arange(len(ids)))
        packed = np.concatenate(rows)
        self.ids, self.vectors = ids[packed], vectors[packed]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, queries: np.ndarray, exact: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of each query with any vector of each node's box."""
        with np.errstate(over="ignore", invalid="ignore"):
            found = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
            if not exact.all():  # room for the rounding of every product and sum
                size = np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T
                found = np.where(exact[:, None], found, found + size * (4.0 * queries.shape[1] * 2.0**-52))
        return np.nan_to_num(found, nan=np.inf, posinf=np.inf, neginf=-np.finfo(float).max)

    def scores(self, a: int, b: int, query: np.ndarray, exact: bool) -> list:
        """Exact inner products of the query with some vectors, as doubles where these hold them."""
        if exact:
            return self.vectors[a:b] @ query
        whole = [(i, int(x)) for i, x in enumerate(query.tolist()) if x]
        return [sum(x * int(v[i]) for i, x in whole) for v in self.vectors[a:b].tolist()]

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, best: list[tuple], exact: bool = True) -> int:
        """Improve ``best``, a heap of (score, -id, mark) with the k-th on top; marks of vectors found
        here are above 0. Returns the number of leaves visited."""
        bound = bound.tolist()  # Python's own numbers compare exactly with whole numbers of any size
        queue, visited = [(-bound[0], self.least_id[0], 0)], 0
        while queue:
            reach, least, node = heapq.heappop(queue)
            if len(best) >= k and (-reach, -least) <= best[0][:2]:
                if -reach < best[0][0]:
                    break
                continue
            pair = self.children[node]
            if pair is not None:
                for child in pair:
                    if len(best) < k or (bound[child], -self.least_id[child]) > best[0][:2]:
                        heapq.heappush(queue, (-bound[child], self.least_id[child], child))
                continue
            visited += 1
            a, b = self.span[node]
            scores = self.scores(a, b, query, exact)
            for i in np.flatnonzero(scores >= max(-_EXACT, min(_EXACT, best[0][0]))) if exact and len(best) >= k else range(b - a):
                entry = (int(scores[i]), -int(self.ids[a + i]), a + int(i) + 1)
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry[:2] > best[0][:2]:
                    heapq.heapreplace(best, entry)
        return visited


def _exact(tree: KDTree, queries: np.ndarray) -> np.ndarray:
    """Of each query, whether doubles hold every sum exactly."""
    top = max(float(np.abs(tree.low).max(initial=0)), float(np.abs(tree.high).max(initial=0)))
    with np.errstate(over="ignore"):
        return top * np.abs(queries).max(axis=1, initial=0) * queries.shape[1] < _EXACT


def search_block(tree: KDTree, ids: np.ndarray, queries: np.ndarray, floors: list[list[tuple[int, int]]], k: int) -> list[list[tuple]]:
    """New candidates of each query in one tree; ``floors`` are the candidates that it brings along."""
    if queries.shape[1] != tree.vectors.shape[1]:
        return [[] for _ in ids]
    exact, out = _exact(tree, queries), []
    bounds = tree.bounds(queries, exact)
    for own, query, bound, known, holds in zip(ids, queries, bounds, floors, exact):
        best = [(*f, 0) for f in known]
        heapq.heapify(best)
        tree.search(query, int(own), bound, k, best, bool(holds))
        out.append([b[:2] for b in best if b[2]])
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pickled tree for each length of vector in this partition (a shard)."""
    ids, vectors = [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        lists = batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        vectors += [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    by: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by.setdefault(len(v), []).append(i)
    trees = [KDTree(np.array([ids[i] for i in rows]), np.array([vectors[i] for i in rows])) for n, rows in sorted(by.items()) if n]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(t) for t in trees], pa.binary())], names=["tree"])


def _searcher(k: int):
    """Rows (shard, tree, asked, known) by shard, its trees before the blocks: a tree is read once a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trees = None, []
        for batch in batches:
            query, form, vec, score = [], [], [], []
            for at, blob, asked, known in zip(*(batch.column(i) for i in range(4))):
                if at.as_py() != shard:
                    shard, trees = at.as_py(), []
                if blob.is_valid:
                    trees.append(pickle.loads(blob.as_py()))
                    continue
                asked = asked.as_py()
                ids, queries = np.array([q["query_id"] for q in asked]), np.array([q["v"] for q in asked])
                floors = [[(int(x["score"]), -x["vec_id"]) for x in f or []] for f in known.as_py()]
                for tree in trees:
                    for q, found in zip(asked, search_block(tree, ids, queries, floors, k)):
                        query += [q["query_id"]] * len(found)
                        form += [q["form"]] * len(found)
                        vec += [-f[1] for f in found]
                        score += [str(f[0]) for f in found]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip((query, form, vec, score), types)], names=["query_id", "form", "vec_id", "score"]
            )

    return run


#: ``form`` tells apart queries of one id with different vectors.
#: Scores are decimal texts on their way, since they may have any number of digits.
_FOUND = "query_id long, form long, vec_id long, score string"


def _blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """Queries in blocks of bounded size and one vector length, with the candidates they know."""
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "form"), F.lit(blocks)))
    rows = dealt.groupBy("block", F.size("v").alias("n")).agg(
        F.sort_array(F.collect_list(F.struct(F.struct("query_id", "form", "v").alias("q"), "known"))).alias("rows")
    )
    return rows.select("block", F.col("rows.q").alias("asked"), F.col("rows.known").alias("known"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; both inputs are (vec_id, v) as from :func:`quantised`."""
    vectors = materialise(vectors, "vectors")
    shards = max(1, -(-vectors.count() // shard))
    trees = materialise(vectors.repartition(shards).mapInArrow(_build, "tree binary").select(F.spark_partition_id().alias("shard"), "tree"), "trees")
    asked = materialise(queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("form"), "v").dropDuplicates(["query_id", "form"]), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nothing = F.array().cast("array<struct<vec_id:bigint,score:string>>")

    def searched(dealt: DataFrame) -> DataFrame:
        """Blocks (shard, asked, known) meet their shard's trees, which are sent and read once."""
        kinds = dealt.select("asked", "known").schema
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
        rows = trees.select("shard", "tree", *blank).unionByName(dealt.select("shard", F.lit(None).cast("binary").alias("tree"), "asked", "known"))
        rows = rows.repartition(parts, "shard").sortWithinPartitions("shard", F.col("tree").isNull())
        return rows.mapInArrow(_searcher(k), _FOUND)

    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    first = _blocks(asked.withColumn("known", nothing), blocks).withColumn("shard", home)
    seeds = materialise(searched(first), "seeds")

    bounds = seeds.groupBy("query_id", "form").agg(F.collect_list(F.struct("vec_id", "score")).alias("known"))
    rest = _blocks(asked.join(bounds, ["query_id", "form"], "left"), blocks)
    others = rest.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).where(F.col("shard") != home)
    found = seeds.unionByName(searched(others))
    # the exact order of numbers of any length: sign, digits, digits themselves; 64 bits suffice for most
    short, size = F.expr("try_cast(score AS bigint)"), F.length(F.ltrim(F.col("score"), F.lit("-")))
    high = F.when(F.col("score").startswith("-"), -size).otherwise(size)
    low = F.when(F.col("score").startswith("-"), F.translate("score", "0123456789", "9876543210")).otherwise(F.col("score"))
    order = Window.partitionBy("query_id", "form").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    ranked = found.withColumns({"high": high, "low": low}).withColumn("rank", F.row_number().over(order))
    limit = F.when(F.col("score").startswith("-"), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.coalesce(short, limit).alias("score"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
