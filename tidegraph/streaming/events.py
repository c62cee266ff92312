"""Event streams: deduplicated monitors, snapshot changes and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegraph.operators.incremental import newest_state, unseen
from tidegraph.operators.relational import snapshot_diff


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 8) -> DataFrame:
    """Files as an event stream; the number of files a batch bounds its rate."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deduplicated(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each key once while it can still be late: state is bounded by the watermark."""
    stamped = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return stamped.dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, late: str, size: str, *by: str) -> DataFrame:
    """Tumbling counts. An extension: the batch operators have no event-time windows."""
    stamped = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return stamped.groupBy(F.window(at, size), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def monitor(events: DataFrame, state_path: str, sink_path: str, key: str, at: str, most: int, checkpoint: str, prime: bool = False) -> StreamingQuery:
    """Emit events that the seen set does not know, then replace the seen set, batch by batch.

    The sink is written before the state: after a failure a batch may be emitted again, never lost.
    With ``prime`` a batch only fills the seen set. The set keeps the newest ``most`` keys."""
    spark = events.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state_path}/{number - 1}")
        known = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
        state = spark.read.parquet(f"{state_path}/{number - 1}") if known else batch.select(key, at).limit(0)
        fresh = unseen(batch, state, key)
        if not prime:
            fresh.write.mode("overwrite").parquet(f"{sink_path}/batch={number}")
        newest_state(state, batch, key, at, most).write.mode("overwrite").parquet(f"{state_path}/{number}")

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Added, removed and changed keys of two snapshots, by a fingerprint of their other columns."""
    rest = sorted(c for c in before.columns if c not in keys)
    print_ = F.sha2(F.to_json(F.struct(*rest)), 256).alias("print")
    return snapshot_diff(before.select(*keys, print_), after.select(*keys, print_), keys, "print")
