"""Session construction shared by the tests, the benchmark and the examples."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session pinned to UTC with adaptive execution on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidegraph")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the star-schema or corpus tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; only a local session without
    that setting gets a temporary one."""
    sc = spark.sparkContext
    defined = sc._jsc.sc().getCheckpointDir()
    named = sc.getConf().get("spark.checkpoint.dir") or (defined.get() if defined.isDefined() else None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(sc, "_tidegraph_shared", None):
        sc._tidegraph_shared = "file://" + tempfile.mkdtemp(prefix="tidegraph-")
    return sc._tidegraph_shared


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what several branches read is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the shared folder: lineage is cut and lost executors lose nothing."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input came in fewer splits, for work that outweighs one shuffle of
    the rows. An input with as many splits as cores, which is any large one, passes unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
