"""Exact DBSCAN per partition (year) as DataFrame joins.

Contract (the classic scan-order algorithm, made declarative):
  * neighbourhood: Euclidean distance ``<= eps``, the point itself included;
  * core: neighbourhood size ``>= min_samples`` (duplicates count);
  * clusters are the connected components of core points; within a partition
    they are numbered by ascending smallest order key of their core points;
  * a border point joins the lowest-numbered cluster among its core neighbours;
  * everything else, and rows with a null partition or a null or huge
    coordinate, is -1. Keys only order the clusters: they may repeat or be
    null (null first), and ties are broken by the coordinates.

Plan:
  1. collapse exact duplicates to weighted positions (a location holding a
     third of all rows becomes one row);
  2. fine cells of side eps/sqrt(d): every position in a cell holding
     ``>= min_samples`` rows is core without counting;
  3. the remaining (sparse-cell) positions sum the weight of the cells within
     eps, down the levels of :mod:`box_pairs`, without making the pairs;
  4. core positions of one fine cell are mutually within eps, so the cell is a
     single graph node with a flat id in spatial order; core sub-cells whose
     farthest corners are within eps connect their cells without a point test;
  5. what is then still in different components is compared box by box, and
     point by point only on the facing rims (:func:`box_pairs.near_groups`);
  6. border points take the smallest cluster of the core cells within eps, by
     the same levels;
  7. cluster numbers come from a distributed rank of ``(part, root)`` and a
     running offset over partitions - no single-task window.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .box_pairs import near_aggregate, near_groups
from .components import connected_components, long_components
from .ranking import rank_within

FINE_SLACK = 1.0 - 1e-9


SUB_PER_FINE = 3
#: fine cells per side of the blocks in whose order graph nodes are numbered
BLOCK_CELLS = 64
#: cell numbers stay exact below this; coordinates beyond it are not clustered
MAX_CELL = float(2 ** 52)


def _sub_side(eps: float, d: int) -> float:
    return float(eps) / math.sqrt(d) * FINE_SLACK / SUB_PER_FINE


def _valid(part: str, dims: list[str], eps: float):
    ok = F.col(part).isNotNull()
    for d in dims:
        ok = ok & F.col(d).isNotNull() & ~F.isnan(d) & (F.abs(F.col(d)) < F.lit(MAX_CELL * _sub_side(eps, len(dims))))
    return ok


def _auto_offsets(d: int) -> list[tuple[int, ...]]:
    """Sub-cell offsets whose farthest corners are within eps (side = eps / (K sqrt d)), one of each opposite two."""
    lim = SUB_PER_FINE * SUB_PER_FINE * d
    rng = range(-SUB_PER_FINE - 1, SUB_PER_FINE + 2)
    return [o for o in itertools.product(rng, repeat=d)
            if o > (0,) * d and sum((abs(v) + 1) ** 2 for v in o) <= lim]


def _offset_join(a: DataFrame, b: DataFrame, offsets, part: str, cells: list[str]) -> DataFrame:
    """Rows of ``a`` paired with rows of ``b`` whose cell is ``a``'s cell plus one of ``offsets``."""
    k = len(cells)
    stencil = F.array(*[F.struct(*[(F.col(cells[i]) + F.lit(o[i])).alias(f"t{i}") for i in range(k)])
                        for o in offsets])
    A = a.select(*[F.col(c).alias("a_" + c) for c in a.columns], F.explode(stencil).alias("_o")) \
         .select("*", *[F.col(f"_o.t{i}").alias(f"_t{i}") for i in range(k)]).drop("_o")
    B = b.select(*[F.col(c).alias("b_" + c) for c in b.columns])
    cond = [F.col("a_" + part) == F.col("b_" + part)] + [F.col(f"_t{i}") == F.col("b_" + cells[i]) for i in range(k)]
    return A.join(B, cond).drop(*[f"_t{i}" for i in range(k)])


def _auto_edges(core: DataFrame, part: str, fnames: list[str], snames: list[str]) -> DataFrame:
    """``src, dst``: cells with two core sub-cells, one of each, whose farthest corners are within eps; a pair once.

    A cell is one row with its occupied sub-cells as bits. It is sent to the cells around it together with the
    bits that one of its sub-cells reaches there, so an edge is a common bit.
    """
    d = len(fnames)
    if SUB_PER_FINE ** d > 62:
        # more sub-cells than bits: sub-cell by sub-cell
        csub = core.select(part, *snames, "cid").distinct()
        auto = _offset_join(csub, csub, _auto_offsets(d), part, snames).where("a_cid <> b_cid")
        return auto.select(F.col("a_cid").alias("src"), F.col("b_cid").alias("dst")).distinct()
    at = F.lit(0).cast("int")
    for i in reversed(range(d)):
        at = at * SUB_PER_FINE + (F.col(snames[i]) - F.col(fnames[i]) * SUB_PER_FINE).cast("int")
    cells = core.groupBy(part, *fnames, "cid").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at)).alias("bits"))
    places = [p[::-1] for p in itertools.product(range(SUB_PER_FINE), repeat=d)]
    lim = SUB_PER_FINE * SUB_PER_FINE * d
    sent = []
    for o in itertools.product(range(-2, 3), repeat=d):
        if o <= (0,) * d:
            continue
        want = F.lit(0).cast("long")
        for i, p in enumerate(places):
            reach = sum(1 << j for j, q in enumerate(places)
                        if sum((abs(SUB_PER_FINE * o[x] + q[x] - p[x]) + 1) ** 2 for x in range(d)) <= lim)
            if reach:
                want = want.bitwiseOR(F.when(F.col("bits").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(reach).cast("long")).otherwise(F.lit(0).cast("long")))
        sent.append(F.struct(want.alias("want"), *[(F.col(f) + F.lit(o[x])).alias(f) for x, f in enumerate(fnames)]))
    a = (cells.select(part, F.col("cid").alias("src"), F.explode(F.array(*sent)).alias("to"))
              .select(part, "src", "to.*").where("want <> 0"))
    b = cells.withColumnRenamed("cid", "dst")
    return a.join(b, [part, *fnames]).where(F.col("want").bitwiseAND(F.col("bits")) != 0).select("src", "dst")


def dbscan_positions(points: DataFrame, eps: float, min_samples: int, key: str, part: str,
                     dims: list[str]) -> DataFrame:
    """Labels per distinct position: ``(part, dims..., pid, w, is_core, root)``.

    ``pid`` names a position: its smallest order key, then its coordinates, so
    that equal keys at different places stay apart. ``root`` is the smallest
    ``pid`` among the core points of the cluster (null for noise).
    """
    d = len(dims)
    fine = _sub_side(eps, d) * SUB_PER_FINE
    pos = (points.where(_valid(part, dims, eps))
                 .groupBy(part, *dims)
                 .agg(F.min(key).alias("_k"), F.count(F.lit(1)).alias("w")))
    pid = F.struct(F.col("_k").alias("k"), *dims)  # made where it is needed: tables carry the key alone
    # sub-cells of side fine/K; a fine cell is exactly K x K (x K) sub-cells
    sub = _sub_side(eps, d)
    snames = [f"s{i}" for i in range(d)]
    fnames = [f"f{i}" for i in range(d)]
    pos = pos.select("*", *[F.floor(F.col(c) / F.lit(sub)).cast("long").alias(snames[i]) for i, c in enumerate(dims)])
    pos = pos.select("*", *[F.floor(F.col(snames[i]) / F.lit(SUB_PER_FINE)).cast("long").alias(fnames[i])
                            for i in range(d)])
    cellw = pos.groupBy(part, *fnames).agg(F.sum("w").alias("cw"))
    pos = cut_lineage(pos.join(cellw, [part] + fnames))

    # 3. neighbour counts for positions of sparse cells only
    sparse = pos.where(F.col("cw") < min_samples)
    counts = near_aggregate(sparse, pos, eps, part, dims, "sum", out="n")
    pos = pos.join(counts, [part, *dims], "left").withColumn(
        "is_core", (F.col("cw") >= min_samples) | (F.coalesce(F.col("n"), F.lit(0)) >= min_samples)).drop("n")
    pos = cut_lineage(pos)

    # 4. one graph node per fine cell holding core positions, numbered block by block: neighbours get near numbers
    core = pos.where("is_core").select(part, *dims, "_k", "w", *fnames, *snames)
    blocks = [F.floor(F.col(f) / F.lit(BLOCK_CELLS)) for f in fnames]
    cells = core.select(part, *fnames).distinct().repartitionByRange(part, *blocks, *fnames) \
                .sortWithinPartitions(part, *blocks, *fnames).withColumn("cid", F.monotonically_increasing_id())
    cells = cut_lineage(cells)
    core = cut_lineage(core.join(cells, [part] + fnames))

    # 4a. certain edges: two core sub-cells whose farthest corners are within eps
    #     connect their cells with no point test (work ~ occupied cells)
    edges = _auto_edges(core, part, fnames, snames)
    comp = cut_lineage(connected_components(cells, edges, node="cid"))
    core = cut_lineage(core.join(comp.withColumnRenamed("node", "cid"), "cid").select(part, *dims, "_k", "w", "root"))

    # 4b. box by box, then point by point, between what is still in different components
    links = near_groups(core, eps, part, dims, "root")
    if links is not None:
        more = long_components(links)
        core = core.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
                   .withColumn("root", F.coalesce("top", "root")).drop("top")
    # a cluster is named by its smallest order key
    names = core.groupBy("root").agg(F.min(pid).alias("first"))
    core_lab = cut_lineage(core.join(names, "root").select(part, *dims, "w", F.col("first").alias("root")))

    # 5. border points: smallest root among core neighbours
    border = near_aggregate(pos.where("not is_core"), core_lab, eps, part, dims, "min", by="root", out="broot")
    out = (pos.join(core_lab.drop("w"), [part, *dims], "left")
              .join(border, [part, *dims], "left")
              .withColumn("root", F.coalesce("root", "broot"))
              .select(part, *dims, pid.alias("pid"), "w", "is_core", "root"))
    return out


def cluster_numbers(labels: DataFrame, part: str) -> DataFrame:
    """``(part, root, cluster_local_id, cluster_id)`` per cluster.

    Local ids restart at 0 per partition in ascending root order; global ids
    run over partitions in ascending order (offset = running cluster count).
    """
    clusters = labels.where(F.col("root").isNotNull()).select(part, "root").distinct()
    ranked, groups = rank_within(clusters, part, ["root"], out="cluster_local_id")
    # one row per partition value; Spark's size threshold decides on the join
    from pyspark.sql import Window
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offs = groups.select(part, F.coalesce(F.sum("_count").over(w), F.lit(0)).alias("_off"))
    return (ranked.join(offs, part)
                  .select(part, "root", F.col("cluster_local_id").cast("int").alias("cluster_local_id"),
                          (F.col("cluster_local_id") + F.col("_off")).cast("int").alias("cluster_id")))


def dbscan(points: DataFrame, eps: float = 500.0, min_samples: int = 10, key: str = "observation_uuid",
           part: str = "cluster_year", dims: list[str] | None = None, frozen: bool = False) -> DataFrame:
    """C1 + C2: the input rows plus ``cluster_local_id`` and ``cluster_id`` (-1 = noise/unclustered).

    ``frozen``: ``points`` are read from a stored table already and are not written again.
    """
    dims = dims or ["E_lv95", "N_lv95"]
    # freeze the (often long) input plan once: clustering and the final join read the frozen rows
    points = points if frozen else cut_lineage(points)
    slim = points.where(_valid(part, dims, eps)).select(part, key, *dims)
    labels = cut_lineage(dbscan_positions(slim, eps, min_samples, key, part, dims))
    nums = cluster_numbers(labels, part)
    lab = labels.join(nums, [part, "root"], "left").select(part, *dims, "cluster_local_id", "cluster_id")
    out = points.join(lab, [part] + dims, "left")
    return out.select(*points.columns,
                      F.coalesce("cluster_local_id", F.lit(-1)).cast("int").alias("cluster_local_id"),
                      F.coalesce("cluster_id", F.lit(-1)).cast("int").alias("cluster_id"))


def cluster_summary(clustered: DataFrame, part: str = "cluster_year", elev: str = "elevation_m") -> DataFrame:
    """Per (year, cluster) point count, mean elevation (nulls skipped) and local id."""
    alt = F.avg(F.col(elev)) if elev in clustered.columns else F.lit(None).cast("double")
    return (clustered.where(F.col("cluster_id") != -1)
                     .groupBy(F.col(part).alias("year"), "cluster_id")
                     .agg(F.count(F.lit(1)).alias("n_points"), alt.alias("alt_mean"),
                          F.min("cluster_local_id").alias("cluster_local_id")))
