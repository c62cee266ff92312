"""Helpers that the corpus operators share: reading, shared scratch tables, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ASCII white space, the word separator of every contract here.
SPACE = r"[\x20\x09-\x0D]"
_UNSET = "/tmp/checkpoints"  # what recent Spark reports when nobody has set the folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without the setting gets a temporary folder."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named and (named != _UNSET or not sc.master.startswith("local")):
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(sc, "_tidegraph_scratch", None):
        sc._tidegraph_scratch = "file://" + tempfile.mkdtemp(prefix="tidegraph-")
    return sc._tidegraph_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever it is; one that isn't there is no error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files behind a table that :func:`materialise` made and nobody reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def fold(key: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, reduced: the fold that the contracts fix. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus), F.lit(0))


def row_numbers(df: DataFrame, group: list[str], spread: Column, order: list[Column], cells: int, to: str) -> DataFrame:
    """``to``: 0, 1, ... within each group, without gaps, and without one task per group.

    Rows are dealt into ``cells`` cells by ``spread``. Cell sizes are counted first, a window over
    these counts gives each cell its offset, and rows are numbered only within their cell. With
    cells near the square root of the rows, no window holds more than about that many rows,
    however large a group is. Order is by cell, then by ``order``."""
    cell = f"__cell_{to}"
    df = df.withColumn(cell, F.pmod(spread, F.lit(cells)).cast("int"))
    sizes = df.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col(cell).alias("__c"),
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)] + [F.col(cell) == F.col("__c")]
    joined = df.join(offsets, same, "left")
    within = F.row_number().over(Window.partitionBy(*group, cell).orderBy(*order))
    drop = [f"__g{i}" for i in range(len(group))] + ["__c", "__before", cell]
    return joined.withColumn(to, F.col("__before") + within - 1).drop(*drop)
