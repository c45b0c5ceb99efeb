"""Spark session helpers.

The library never creates its own cluster-side scratch space: lineage cuts are
Parquet tables in the folder the cluster names in ``spark.checkpoint.dir``.
Only a local-mode session (tests, the bench) with no such setting gets a fresh
folder under the system temp directory.

A cut is a written table and not ``DataFrame.checkpoint``: a checkpointed frame
keeps the size estimate of the plan that made it, and estimates of joins
multiply, so that in a loop their digits grow with every round until planning
takes longer than the work. A table that is read back has the size of its files.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "alpina",
                  shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A session tuned for the library: AQE with skew-join splitting on, UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.driver.memory", driver_memory)
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    ``spark.checkpoint.dir`` (or a folder already set on the context) wins.
    When none is set, a local-mode session gets a new temp folder; a cluster
    session must name a shared folder, so we refuse to guess one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for lineage cuts")
    path = tempfile.mkdtemp(prefix="alpina-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name in the shared folder of ``spark.checkpoint.dir`` (all executors see it)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def store(df: DataFrame, tag: str, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage; the files are columnar and their size is known, so
    Spark's own broadcast threshold can judge it.
    """
    path = path or shared_path(df.sparkSession, tag)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a written table, read back."""
    return store(df, "cut")


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table of ``shared_path`` that no later plan reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
