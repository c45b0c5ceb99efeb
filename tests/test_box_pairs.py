"""Neighbour counts and touching groups by refined cells, and components of long chains, against brute force."""

import random

import numpy as np

from alpina.operators.box_pairs import near_aggregate, near_groups
from alpina.operators.components import connected_components, forest
from alpina.operators.dbscan import dbscan
from alpina.operators.neighbours import neighbour_counts


def _frame(spark, xy, **more):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"p": 1, "x": xy[:, 0], "y": xy[:, 1], **more}))


def test_counts_of_a_dense_cell_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.uniform(0, 1, (4000, 2)), rng.uniform(-2, 3, (500, 2)), np.array([[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]])])
    df = _frame(spark, xy, k=np.arange(len(xy)))
    got = {r.k: r.n for r in neighbour_counts(df, 1.0, "k", "p", ["x", "y"], out="n").collect()}
    d2 = (xy[:, None, 0] - xy[None, :, 0]) * (xy[:, None, 0] - xy[None, :, 0]) + (xy[:, None, 1] - xy[None, :, 1]) * (xy[:, None, 1] - xy[None, :, 1])
    assert [got[i] for i in range(len(xy))] == (d2 <= 1.0).sum(1).tolist()


def test_smallest_group_within_eps(spark):
    rng = np.random.default_rng(4)
    a, b = rng.uniform(0, 3, (600, 2)), rng.uniform(0, 3, (600, 2))
    g = rng.integers(0, 40, 600)
    got = {(r.x, r.y): r.v for r in near_aggregate(_frame(spark, a, w=1), _frame(spark, b, w=1, g=g), 0.2, "p", ["x", "y"], "min", by="g", out="v").collect()}
    d2 = (a[:, None, 0] - b[None, :, 0]) ** 2 + (a[:, None, 1] - b[None, :, 1]) ** 2
    want = {tuple(a[i]): int(g[d2[i] <= 0.04].min()) for i in range(600) if (d2[i] <= 0.04).any()}
    assert got == want


def test_blobs_just_over_eps_apart_stay_apart(spark):
    rng = np.random.default_rng(5)
    n = 3000
    left = np.column_stack([rng.uniform(0, 1, n), rng.uniform(0, 1, n)])
    right = np.column_stack([rng.uniform(2.0 + 1e-9, 3, n), rng.uniform(0, 1, n)])
    left[0], right[0] = (1.0, 0.5), (2.0 + 1e-9, 0.5)
    xy = np.concatenate([left, right])
    df = _frame(spark, xy, g=np.repeat([0, 1], n))
    links = near_groups(df, 1.0, "p", ["x", "y"], "g")
    assert links is None or links.count() == 0
    xy[n, 0] = 2.0
    assert [(r.src, r.dst) for r in near_groups(_frame(spark, xy, g=np.repeat([0, 1], n)), 1.0, "p", ["x", "y"], "g").collect()] == [(0, 1)]
    labels = dbscan(_frame(spark, np.concatenate([left, right]), k=np.arange(2 * n)), 1.0, 5, "k", "p", ["x", "y"])
    assert {r.cluster_id: r["count"] for r in labels.groupBy("cluster_id").count().collect()} == {0: n, 1: n}


def test_forest_of_random_edges():
    rng = np.random.default_rng(6)
    u, v = rng.integers(0, 500, 400), rng.integers(0, 500, 400)
    node, root = forest(u, v)
    parent = dict(zip(node.tolist(), root.tolist()))
    low = {x: x for x in set(u.tolist()) | set(v.tolist())}
    while True:
        new = dict(low)
        for a, b in zip(u.tolist(), v.tolist()):
            new[a] = new[b] = min(new[a], new[b])
        if new == low:
            break
        low = new
    assert {x: parent.get(x, x) for x in low} == low


def test_chain_of_100000_nodes(spark, monkeypatch):
    import alpina.operators.components as components
    monkeypatch.setattr(components, "CHUNK", 5000)  # many chunks, so that the rounds have work left
    n = 100_000
    ids = list(range(n))
    random.Random(2).shuffle(ids)
    import pandas as pd
    edges = spark.createDataFrame(pd.DataFrame({"src": ids[:-1], "dst": ids[1:]}))
    nodes = edges.selectExpr("src AS node").union(edges.selectExpr("dst AS node"))
    out = connected_components(nodes, edges)
    assert out.count() == n and out.where("root <> 0").count() == 0


def test_a_cell_goes_to_the_blocks_around_it(spark):
    from alpina.operators.box_pairs import block_names, in_block, in_blocks_around
    rows = [(x, y) for x in range(-9, 10) for y in range(-9, 10)]
    df = spark.createDataFrame(rows, "x long, y long")
    a = in_blocks_around(df.selectExpr("x ax", "y ay"), ["ax", "ay"], 2)
    b = in_block(df.selectExpr("x bx", "y by"), ["bx", "by"], 2)
    met = a.join(b, block_names(2)).where("abs(ax - bx) <= 1 and abs(ay - by) <= 1")
    got = sorted((r.ax, r.ay, r.bx, r.by) for r in met.collect())
    assert got == sorted((*p, *q) for p in rows for q in rows if abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)
    assert a.count() < 3 * len(rows)  # nine for each cell before


def test_certain_edges_come_once_a_pair_of_cells(spark):
    from pyspark.sql import functions as F

    from alpina.operators.dbscan import SUB_PER_FINE, _auto_edges, _auto_offsets
    rng = np.random.default_rng(8)
    for d, n in ((1, 30), (2, 300), (3, 400)):
        sub = np.unique(rng.integers(-9, 9, (n, d)), axis=0).tolist()
        fine = {f: i for i, f in enumerate(sorted({tuple(v // SUB_PER_FINE for v in s) for s in sub}))}
        s, f = [f"s{i}" for i in range(d)], [f"f{i}" for i in range(d)]
        core = spark.createDataFrame([(1, *x, *[v // SUB_PER_FINE for v in x], fine[tuple(v // SUB_PER_FINE for v in x)]) for x in sub],
                                     ["p", *s, *f, "cid"]).select(*[F.col(c).cast("long").alias(c) for c in ["p", *s, *f, "cid"]])
        got = [tuple(sorted((r.src, r.dst))) for r in _auto_edges(core, "p", f, s).collect()]
        offsets, have = _auto_offsets(d), {tuple(x) for x in sub}
        cell = lambda x: fine[tuple(v // SUB_PER_FINE for v in x)]
        want = {tuple(sorted((cell(x), cell(y)))) for x in have for o in offsets if (y := tuple(a + b for a, b in zip(x, o))) in have and cell(x) != cell(y)}
        assert want and sorted(got) == sorted(want)
