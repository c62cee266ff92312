"""Sinks: union-header CSV, JSON documents, run tables, append-only events, a latest pointer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_csv(frames: Sequence[DataFrame], path: str) -> None:
    """Rows of several tables under the sorted union of their columns."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    out.select(*sorted(out.columns)).write.mode("overwrite").option("header", True).csv(path)


def sorted_json(df: DataFrame, path: str) -> None:
    """JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def run_table(df: DataFrame, path: str, run_id: str) -> None:
    """Replace the rows of one run; other runs' partitions stay."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy("run_id").parquet(path)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def latest(registry: DataFrame, key: str = "run_id", at: str = "created_at") -> DataFrame:
    """The newest entry of each key."""
    rest = [c for c in registry.columns if c != key]
    newest = registry.groupBy(key).agg(F.max(F.struct(at, *[c for c in rest if c != at])).alias("m"))
    return newest.select(key, *[F.col(f"m.{c}") for c in rest])


#: Contents from this size on are compressed if that leaves at most this share of them. Fixed values.
TIER_BYTES, TIER_SHARE = 256 * 1024, 0.9


def json_document(df: DataFrame, path: str, most: int = 100_000) -> None:
    """A small table as one JSON array, keys sorted; a table over ``most`` rows is refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows are no single document; write JSON lines")
    columns = sorted(df.columns)
    whole = df.coalesce(1).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns))), {"pretty": "true"}).alias("value"))
    whole.write.mode("overwrite").text(path)


def publish(df: DataFrame, path: str) -> None:
    """Write beside the place and rename: a reader sees the old files or all of the new ones."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.partial")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(f"{path}.partial"), hadoop.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{path}.partial can't be renamed")


def tiered(df: DataFrame, content: str = "content", least: int = TIER_BYTES, share: float = TIER_SHARE) -> DataFrame:
    """``df`` with its content compressed where that is worth it, its codec, size and digest; every compressed
    content is unpacked again before it replaces the plain one."""
    names = [c for c in df.columns if c != content]
    rows = df.select(*names, F.col(content).cast("binary").alias(content))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            held, codecs = [], []
            for plain in batch.column(batch.schema.get_field_index(content)).to_pylist():
                small = pack.compress(plain) if plain is not None and len(plain) >= least else None
                worth = small is not None and len(small) <= share * len(plain) and unpack.decompress(small) == plain
                held.append(small if worth else plain)
                codecs.append("zstd" if worth else "plain")
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(held, pa.binary()), pa.array(codecs, pa.string())], names=[*names, content, "codec"])

    schema = rows.select("*", F.lit("").alias("codec")).schema
    digests = rows.select(*names, content).withColumns({"sha256": F.sha2(content, 256), "size": F.octet_length(content)})
    return digests.mapInArrow(_with_digests(run, names, content), schema.add("sha256", "string").add("size", "integer"))


def _with_digests(run, names: Sequence[str], content: str):
    """The rows of ``run`` with the digest and size columns of its input."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.select([*names, content])
            for made in run(iter([own])):
                extra = [batch.column(batch.schema.get_field_index(n)) for n in ("sha256", "size")]
                yield pa.RecordBatch.from_arrays([*made.columns, *extra], names=[*made.schema.names, "sha256", "size"])

    return both


def verified_bundle(manifest: DataFrame, files: DataFrame, key: str, content: str) -> DataFrame:
    """Each member's state against the manifest's size and sha-256: ok, changed, missing or unlisted."""
    found = files.select(key, F.octet_length(content).alias("__size"), F.sha2(content, 256).alias("__sha"))
    both = manifest.select(key, "size", "sha256").join(found, key, "full")
    same = (F.col("size") == F.col("__size")) & (F.col("sha256") == F.col("__sha"))
    state = F.when(F.col("__sha").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(same, "ok").otherwise("changed")
    return both.select(key, state.alias("state"))
