"""Connected components of an edge DataFrame.

1. Node ids of any orderable type get flat ``long`` ids in the same order (a
   range partition and ``monotonically_increasing_id``), so that rounds compare
   and shuffle eight bytes.
2. Contraction inside each partition: edges are range-partitioned by their
   source and every task replaces each chunk of at most ``CHUNK`` edges by a
   spanning forest of stars (numpy, memory bounded by the chunk). Where ids
   follow the data's locality, most of the graph is gone after this pass.
3. Alternating large-star and small-star rounds (Kiveris et al., 2014) over the
   stars: two aggregations and two joins on a node id. Hubs are handled by
   partial aggregation and AQE's skew-join splitting, not by collecting a
   neighbourhood into one task. Each round's edges are written as a table and
   the former round's are deleted; the row count and hash that tell whether the
   round changed anything are observed while writing, so a round is one job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, remove_table, shared_path, store

#: edges contracted together in one task
CHUNK = 500_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, root)`` of every node that is not its component's smallest node."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[:len(u)], codes[len(u):]
    parent = np.arange(len(nodes))
    while True:
        pa, pb = parent[a], parent[b]
        open_ = pa != pb
        if not open_.any():
            break
        a, b, pa, pb = a[open_], b[open_], pa[open_], pb[open_]
        # each larger root hangs on the smallest root seen next to it: no cycles
        np.minimum.at(parent, np.maximum(pa, pb), np.minimum(pa, pb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """``(hi, lo)`` stars with the same components as ``edges (src, dst)``, both of type long."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def stars(us, vs):
            hi, lo = forest(np.concatenate(us), np.concatenate(vs))
            return pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=["hi", "lo"])

        us, vs, size = [], [], 0
        for batch in batches:
            us.append(batch.column(0).to_numpy(zero_copy_only=False))
            vs.append(batch.column(1).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= CHUNK:
                yield stars(us, vs)
                us, vs, size = [], [], 0
        if size:
            yield stars(us, vs)

    return edges.repartitionByRange("src").mapInArrow(run, "hi long, lo long")


def _round(E: DataFrame) -> DataFrame:
    """Large star, then small star; edges are ``(hi, lo)`` with ``hi > lo``."""
    both = E.unionByName(E.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("n")).select("at", F.least("at", "n").alias("m"))
    large = E.join(least, F.col("lo") == F.col("at")).select("hi", F.col("m").alias("lo"))
    low = large.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("m"))
    small = (large.join(low, F.col("hi") == F.col("at")).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                  .unionByName(low.select(F.col("at").alias("hi"), F.col("m").alias("lo"))))
    return small.distinct()


def long_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` of the nodes of ``edges (src, dst)`` (type long) that are not their component's smallest."""
    spark = edges.sparkSession

    def kept(stars: DataFrame) -> tuple[DataFrame, str, dict]:
        seen, path = Observation(), shared_path(spark, "stars")
        stars = stars.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("h1"),
                              F.bit_xor(F.xxhash64("lo", "hi")).alias("h2"))
        return store(stars, "stars", path=path), path, seen.get

    E, path, last = kept(contracted(edges.select("src", "dst").where("src <> dst")))
    for _ in range(max_rounds):
        new, at, now = kept(_round(E)) if last.get("n") else (E, path, last)
        if at != path:
            remove_table(spark, path)
        if now == last:
            return new.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        E, path, last = new, at, now
    raise RuntimeError("connected components did not converge")


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node",
                         src: str = "src", dst: str = "dst", max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` with ``root`` = smallest node id of the component.

    ``nodes`` lists every node (isolated ones included); ``edges`` are
    undirected ``(src, dst)`` pairs. Node ids may be of any orderable type.
    """
    nodes = nodes.select(F.col(node).alias("node")).distinct()
    edges = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    if isinstance(edges.schema["src"].dataType, T.LongType):
        roots = long_components(edges, max_rounds)
        return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    ids = cut_lineage(nodes.repartitionByRange("node").sortWithinPartitions("node")
                           .withColumn("id", F.monotonically_increasing_id()))
    flat = (edges.join(ids.select(F.col("node").alias("src"), F.col("id").alias("s")), "src")
                 .join(ids.select(F.col("node").alias("dst"), F.col("id").alias("d")), "dst")
                 .select(F.col("s").alias("src"), F.col("d").alias("dst")))
    roots = long_components(flat, max_rounds)
    named = roots.join(ids.select(F.col("node").alias("root_node"), F.col("id").alias("root")), "root") \
                 .select(F.col("node").alias("id"), "root_node")
    return ids.join(named, "id", "left").select("node", F.coalesce("root_node", "node").alias("root"))
