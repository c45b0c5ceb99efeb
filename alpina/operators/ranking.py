"""Distributed dense numbering (W1, W2, C2 local ids).

A window without ``partitionBy`` (or one per year, when a year may hold a third
of the rows) runs in a single task. Instead rows are range-partitioned on the
order key, numbered inside each partition, and shifted by the running count of
the earlier partitions - a table with one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_rank(df: DataFrame, order_cols: list[str], out: str = "rank0",
                num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``ORDER BY order_cols`` (keys must be unique)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    r = cut_lineage(r)  # ids are position-based: freeze them before reuse
    per_part = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded table, fine for a single-task window and a broadcast
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (r.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
              .withColumn(out, F.col("_off") + (F.col("_mid") - F.col("_m0")))
              .drop("_pid", "_mid", "_off", "_m0"))


def rank_within(df: DataFrame, group_col: str, order_cols: list[str], out: str = "rank0") -> tuple[DataFrame, DataFrame]:
    """0-based rank inside ``group_col`` plus the per-group ``(group, _start, _count)`` table.

    The group table has one row per group value (e.g. per year); its size is not
    bounded here, so Spark's threshold decides whether it is broadcast.
    """
    g = global_rank(df, [group_col] + order_cols, out="_g")
    starts = g.groupBy(group_col).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_count"))
    ranked = g.join(starts.select(group_col, "_start"), group_col) \
              .withColumn(out, F.col("_g") - F.col("_start")).drop("_g", "_start")
    return ranked, starts
