"""A content-addressed store of token ids.

Each document's id stream is cut where a rolling hash of the last ids says so. A chunk is stored
once under the digest of its ids; a document is a recipe, the list of its chunks' digests. Recipes
lie in ascending order of id in parts, each row linked to the one before by a hash, and the
manifest joins the parts' last links to a Merkle root. :func:`verified` recomputes links and root,
and :func:`read_digests` every chunk's digest, so what the query returns is what was written.

Layout below the store's path, all Parquet: ``body/kind=1`` chunks (digest, ids as little-endian
integers), ``recipes`` (part, doc_id, n_tokens, digests, local start, link), ``manifest`` (part,
first start, documents, tokens, leaf, and the root).

Defined cases: a null or empty text is the end id alone. Repeated rows have a recipe each, in an
order fixed by their content, and share chunks; rows with equal ids (ties) lie in the order of their
recipes. A null id sorts first. A text of any length is one recipe; it is encoded and cut in one task,
so one row must fit a worker. A special token's string in a text becomes that token, as the library
has it. An empty table makes an empty store. Other columns, whatever their names, are not stored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import documents, scratch_path
from tidegraph.llm.tokenization import PieceTokenizer, portions

TOKENIZER, END = public_tokenizers.path("byte_bpe_50k.json"), 2
#: Ids in the rolling window, and in the smallest, the mean (beyond the smallest) and largest chunk.
WINDOW, SMALLEST, MEAN, LARGEST = 16, 128, 512, 2048
DIGEST = 20
#: Chunks that a task remembers having emitted; those it forgets are made one again by the exchange.
_SEEN = 500_000
_GEAR = np.uint64(0x9E3779B97F4A7C15)


def rolling_hash(ids: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW ids that end at each place, by doubling; vectorised."""
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) + np.uint64(1)) * _GEAR
        h ^= h >> np.uint64(29)
        step, power = 1, np.uint64(0xD6E8FEB86659FD93)
        while step < WINDOW:
            shifted = np.zeros_like(h)
            shifted[step:] = h[:-step] if step < len(h) else 0
            h = h + shifted * power
            power = power * power
            step *= 2
        return h ^ (h >> np.uint64(32))


def cut_points(hits: np.ndarray, length: int) -> list[int]:
    """Ends of the chunks of a stream; ``hits`` are the ascending places after which a cut may fall."""
    ends, begin, at, places = [], 0, 0, hits.tolist()
    while length - begin > SMALLEST:
        while at < len(places) and places[at] - begin < SMALLEST:
            at += 1
        stop = min(begin + LARGEST, length)
        if at < len(places) and places[at] < stop:
            stop = places[at]
        ends.append(stop)
        begin = stop
    if begin < length or not ends:
        ends.append(length)
    return ends


def chunk_ends(streams: list[np.ndarray]) -> list[list[int]]:
    """Ends of the content-defined chunks of each id stream.

    One hash over all streams together: a window that reaches back into the stream before ends less
    than WINDOW ids into its own, and no cut falls within SMALLEST ids of a stream's beginning."""
    sizes = np.array([len(s) for s in streams])
    stop = np.cumsum(sizes)
    hits = np.flatnonzero(rolling_hash(np.concatenate(streams)) % np.uint64(MEAN) == 0) + 1
    first, last = np.searchsorted(hits, stop - sizes, side="right"), np.searchsorted(hits, stop, side="right")
    return [cut_points(hits[a:b] - begin, n) for a, b, begin, n in zip(first, last, (stop - sizes).tolist(), sizes.tolist())]


def digest(ids: np.ndarray) -> bytes:
    return blake2b(ids.astype("<u4").tobytes(), digest_size=DIGEST).digest()


def _widths(ids: np.ndarray) -> tuple[bytes, int]:
    """A stored chunk's first byte, and the bytes an id takes: two where they suffice for the document."""
    return (b"\x02", 2) if not len(ids) or ids.max() < 65536 else (b"\x04", 4)


def unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, dtype=f"<u{body[0]}", offset=1).astype(np.uint32)


def _encode(df: DataFrame, key: str, text: str, tokenizer: str, end: int) -> DataFrame:
    """Recipes (kind 0) and chunks (kind 1). A task emits a chunk's body once, so that a passage
    that is everywhere is shuffled once a task, not once a document."""
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["kind", "digest", "body", "doc_id", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = PieceTokenizer.at(tokenizer), set()
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for part in portions(texts):
                kind, digests, bodies, docs, sizes = [], [], [], [], []
                keys = whole.column(0)[part].to_pylist()
                streams = codec.encode(texts[part], end)
                if len(seen) > _SEEN:
                    seen.clear()
                for i, (ids, ends) in enumerate(zip(streams, chunk_ends(streams))):
                    whole_ids, (mark, wide) = ids.astype("<u4").tobytes(), _widths(ids)
                    short, recipe, begin = ids.astype(f"<u{wide}").tobytes(), [], 0
                    for stop in ends:
                        name = blake2b(whole_ids[4 * begin : 4 * stop], digest_size=DIGEST).digest()
                        recipe.append(name)
                        if name not in seen:
                            seen.add(name)
                            kind.append(1)
                            digests.append(name)
                            bodies.append(mark + short[wide * begin : wide * stop])
                            docs.append(None)
                            sizes.append(stop - begin)
                        begin = stop
                    kind.append(0)
                    digests.append(b"".join(recipe))
                    bodies.append(None)
                    docs.append(keys[i])
                    sizes.append(len(ids))
                types = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip((kind, digests, bodies, docs, sizes), types)], names=names
                )

    return rows.mapInArrow(run, "kind int, digest binary, body binary, doc_id long, n_tokens long")


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted chunks with one digest, the first; recipes all stay."""
    last = None
    for batch in batches:
        kinds, names, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for kind, name in zip(kinds, names):
            keep.append(kind == 0 or name != last)
            if kind:
                last = name
        yield batch.filter(pa.array(keep))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running start and hash chain of one part's recipes, in their order."""
    start, link = 0, b""
    for batch in batches:
        starts, links = [], []
        for doc, size, recipe in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            starts.append(start)
            start += size
            link = sha256(link + repr((doc, size)).encode() + recipe).digest()
            links.append(link)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(starts, pa.int64()), pa.array(links, pa.binary())],
            names=["part", "doc_id", "n_tokens", "digests", "local_start", "link"],
        )


def merkle_root(leaves: list[bytes]) -> bytes:
    level = leaves or [b""]
    while len(level) > 1:
        level = [sha256(b"".join(level[i : i + 2])).digest() for i in range(0, len(level), 2)]
    return sha256(level[0]).digest()


def write_store(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END) -> bytes:
    """Write the store below ``path`` and return its Merkle root."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _encode(df, key, text, tokenizer, end)
    deal = F.when(F.col("kind") == 1, F.xxhash64("digest")).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    dealt = rows.withColumn("__deal", deal).repartition(parts, "__deal").drop("__deal").sortWithinPartitions("kind", "digest")
    unique = dealt.mapInArrow(_once, dealt.schema)
    unique.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/body")

    body = spark.read.schema("digest binary, body binary, doc_id long, n_tokens long, kind int").parquet(f"{path}/body")
    recipes = body.where("kind = 0").select("doc_id", "n_tokens", F.col("digest").alias("digests"))
    ordered = recipes.repartitionByRange(parts, "doc_id", "digests").sortWithinPartitions("doc_id", "digests")
    linked = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "n_tokens", "digests").mapInArrow(_linked, _RECIPES)
    linked.write.option("compression", "zstd").parquet(f"{path}/recipes")

    table = spark.read.schema(linked.schema).parquet(f"{path}/recipes")
    sums = table.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.max_by("link", "local_start").alias("leaf")
    )
    start, manifest, leaves = 0, [], []
    for row in sorted(sums.collect(), key=lambda r: r["part"]):  # a row for each part, not for each document
        leaves.append(bytes(row["leaf"]))
        manifest.append((row["part"], start, row["n"], row["tokens"], leaves[-1]))
        start += row["tokens"]
    root = merkle_root(leaves)
    fields = "part int, first_start long, n_docs long, n_tokens long, leaf binary, root binary"
    spark.createDataFrame([(*m, root) for m in manifest], fields).coalesce(1).write.parquet(f"{path}/manifest")
    return root


_RECIPES = "part int, doc_id long, n_tokens long, digests binary, local_start long, link binary"


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, digests (array) of every document, from the files."""
    recipes = spark.read.schema(_RECIPES).parquet(f"{path}/recipes")
    manifest = spark.read.schema("part int, first_start long").parquet(f"{path}/manifest")
    count = (F.octet_length("digests") / DIGEST).cast("int")
    names = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("digests"), i * DIGEST + 1, F.lit(DIGEST)))
    # the manifest has a row for each part
    return recipes.join(F.broadcast(manifest), "part").select(
        "doc_id", (F.col("first_start") + F.col("local_start")).alias("start"), "n_tokens", names.alias("digests")
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """digest, body of every chunk, from the files."""
    return spark.read.schema("digest binary, body binary, kind int").parquet(f"{path}/body").where("kind = 1").select("digest", "body")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every document, put together from its chunks."""
    refs = read_recipes(spark, path).select("doc_id", "start", F.posexplode("digests").alias("pos", "digest"))
    lists = refs.join(read_chunks(spark, path), "digest").groupBy("doc_id", "start").agg(
        F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([unpacked(p["body"]) for p in parts]) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([i.tolist() for i in ids], pa.list_(pa.int64()))],
                names=["doc_id", "start", "ids"],
            )

    return lists.mapInArrow(run, "doc_id long, start long, ids array<long>")


def verified(spark: SparkSession, path: str) -> bool:
    """Whether each part's links and the root follow from the recipes in the files."""
    table = spark.read.schema(_RECIPES).parquet(f"{path}/recipes")
    again = (
        table.repartition("part")
        .sortWithinPartitions("part", "local_start")
        .select("part", "doc_id", "n_tokens", "digests", "link")
        .mapInArrow(_relinked, "part int, wrong long, leaf binary")
    )
    leaves = again.groupBy("part").agg(F.sum("wrong").alias("wrong"), F.max("leaf").alias("leaf")).orderBy("part").collect()
    manifest = spark.read.schema("part int, leaf binary, root binary").parquet(f"{path}/manifest").orderBy("part").collect()
    same = [bytes(r["leaf"]) for r in leaves] == [bytes(m["leaf"]) for m in manifest]
    return same and not any(r["wrong"] for r in leaves) and all(
        bytes(m["root"]) == merkle_root([bytes(x["leaf"]) for x in manifest]) for m in manifest
    )


def verify(spark: SparkSession, path: str) -> bool:
    """Recompute each part's links, the root, and each chunk's digest from the files."""

    def bad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong = [n != digest(unpacked(b)) for n, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([sum(wrong)], pa.int64())], names=["bad"])

    return not read_chunks(spark, path).mapInArrow(bad, "bad long").agg(F.sum("bad")).first()[0] and verified(spark, path)


def _relinked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, link, wrong, out = None, b"", 0, []
    for batch in batches:
        for p, doc, size, recipe, said in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                if part is not None:
                    out.append((part, wrong, link))
                part, link, wrong = p, b"", 0
            link = sha256(link + repr((doc, size)).encode() + recipe).digest()
            wrong += link != said
    if part is not None:
        out.append((part, wrong, link))
    columns = list(zip(*out)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], names=["part", "wrong", "leaf"]
    )


_POLYNOMIAL = np.uint32(0xEDB88320)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two reflected polynomials modulo the crc's, element by element."""
    total, b = np.zeros_like(a), b.copy()
    for bit in range(31, -1, -1):
        total ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), (b >> np.uint32(1)) ^ _POLYNOMIAL, b >> np.uint32(1))
    return total


def moved_crc(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """crc32 values moved on by so many bytes. The crc of a joined string is the exclusive or of its
    parts' crcs, each moved on by the bytes that follow the part."""
    out, power = crc.astype(np.uint32), np.array([1 << 23], dtype=np.uint32)  # x to the 8th
    left = by.astype(np.int64)
    while left.any():
        odd = (left & 1) == 1
        if odd.any():
            out[odd] = _times(np.broadcast_to(power, int(odd.sum())), out[odd])
        power = _times(power, power)
        left >>= 1
    return out


def _chunk_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, crcs = [], []
        for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = unpacked(body).astype("<u4").tobytes()
            if blake2b(ids, digest_size=DIGEST).digest() != name:
                raise ValueError(f"chunk {name.hex()} is not what was stored")
            sizes.append(len(ids) // 4)
            crcs.append(zlib.crc32(ids))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], names=["digest", "n", "crc"]
        )


def _document_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        offsets = np.asarray(lists.offsets)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        n = flat.field(1).to_numpy(zero_copy_only=False)
        crc = flat.field(2).to_numpy(zero_copy_only=False)
        first = (offsets[:-1] - offsets[0]).astype(np.int64)
        if len(first):
            total = np.add.reduceat(n, first)
            upto = np.cumsum(n) - np.repeat(np.cumsum(total) - total, np.diff(offsets))
            after = np.repeat(total, np.diff(offsets)) - upto
            value = np.bitwise_xor.reduceat(moved_crc(crc, 4 * after), first)
        else:
            total, value = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(total), pa.array(value.astype(np.int64))],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the stored chunks and recipes.

    Chunk bodies are read and verified once and not shuffled: a document's crc follows from its chunks'
    crcs. References to a chunk of very many documents are few bytes each; adaptive execution splits
    them over tasks where they are many."""
    chunks = read_chunks(spark, path).mapInArrow(_chunk_crcs, "digest binary, n long, crc long")
    refs = read_recipes(spark, path).select("doc_id", "start", F.posexplode("digests").alias("pos", "digest"))
    lists = refs.join(chunks, "digest").groupBy("doc_id", "start").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "crc"))).alias("parts"))
    return lists.mapInArrow(_document_crcs, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store every document's ids, then describe each document from the verified files."""
    path = scratch_path(spark, "token-store")
    write_store(documents(spark, sf_dir).select("doc_id", "text"), path)
    if not verified(spark, path):
        raise ValueError("the store's recipes are not what was written")
    return read_digests(spark, path)
