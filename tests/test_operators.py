"""Operator tests: hand fixtures, brute-force DBSCAN, footprint invariants."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import dbscan_per_group
from alpina.operators.combine import combine
from alpina.operators.components import connected_components
from alpina.operators.dbscan import dbscan
from alpina.operators.footprint import arc_area, boundary_arcs, footprint_vertices
from alpina.operators.ranking import global_rank, rank_within
from alpina.operators.taxa import request_batches, upsert_taxa
from alpina.operators.tiles import urls_missing, urls_needed
from alpina.sources.raster import raster_catalog


def _labels(spark, pts, eps, ms, dims=("x", "y")):
    cols = ", ".join(f"{d} double" for d in dims)
    df = spark.createDataFrame(pts, f"k long, yr int, {cols}")
    out = dbscan(df, eps, ms, key="k", part="yr", dims=list(dims))
    return {r.k: (r.cluster_local_id, r.cluster_id) for r in out.collect()}


def test_dbscan_fx_dbscan(spark):
    xs = [0, 1, 2, 3, 10, 20, 20, 20]
    pts = [(i, 2020, float(x), 0.0) for i, x in enumerate(xs)]
    got = _labels(spark, pts, 1.0, 3)
    assert [got[i][0] for i in range(8)] == [0, 0, 0, 0, -1, 1, 1, 1]


def test_dbscan_fx_border_takes_lower_cluster(spark):
    xy = [(0, 0), (-0.5, 0), (-0.5, 0.1), (-0.5, -0.1), (1, 0), (2, 0), (2.5, 0), (2.5, 0.1), (2.5, -0.1)]
    pts = [(i, 1, float(x), float(y)) for i, (x, y) in enumerate(xy)]
    got = _labels(spark, pts, 1.0, 4)
    assert got[4] == (0, 0) and got[0][0] == 0 and got[5][0] == 1


def test_dbscan_matches_brute_force_random(spark):
    rnd = random.Random(7)
    pts = []
    k = 0
    for yr in (2019, 2020, 2021):
        centres = [(rnd.uniform(0, 60), rnd.uniform(0, 60)) for _ in range(4)]
        for _ in range(120):
            cx, cy = rnd.choice(centres)
            x, y = round(cx + rnd.gauss(0, 3), 1), round(cy + rnd.gauss(0, 3), 1)
            pts.append((k, yr, x, y))
            k += 1
        for _ in range(10):  # exact duplicates and exact-eps ties
            p = rnd.choice([q for q in pts if q[1] == yr])
            pts.append((k, yr, p[2], p[3]))
            pts.append((k + 1, yr, p[2] + 2.0, p[3]))
            k += 2
    rnd.shuffle(pts)
    got = _labels(spark, pts, 2.0, 5)
    X = np.array([[p[2], p[3]] for p in pts])
    ref = dbscan_per_group([p[0] for p in pts], [p[1] for p in pts], X, 2.0, 5)
    assert got == ref


def test_dbscan_3d_and_null_rows(spark):
    rnd = random.Random(3)
    pts = [(i, 1, rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.uniform(0, 4)) for i in range(150)]
    got = _labels(spark, pts, 1.5, 4, dims=("x", "y", "z"))
    X = np.array([p[2:] for p in pts])
    assert got == dbscan_per_group([p[0] for p in pts], [1] * len(pts), X, 1.5, 4)
    df = spark.createDataFrame([(1, None, 0.0, 0.0), (2, 1, None, 0.0), (3, 1, 0.0, 0.0)], "k long, yr int, x double, y double")
    out = {r.k: r.cluster_id for r in dbscan(df, 1.0, 1, key="k", part="yr", dims=["x", "y"]).collect()}
    assert out == {1: -1, 2: -1, 3: 0}


def test_connected_components_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(100, 101)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in list(range(n)) + [100, 101, 200]], "node long")
    got = {r.node: r.root for r in connected_components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(n)) and got[101] == 100 and got[200] == 200


def test_global_rank_and_batches(spark):
    ids = spark.createDataFrame([(i * 3,) for i in range(500)], "taxon_id long")
    r = {x.taxon_id: x.rank0 for x in global_rank(ids, ["taxon_id"], num_partitions=7).collect()}
    assert r == {i * 3: i for i in range(500)}
    b = request_batches(ids, 200).collect()
    assert max(x.batch_no for x in b) == 2 and sum(1 for x in b if x.batch_no == 2) == 100
    grp = spark.createDataFrame([(y, v) for y in (1, 2) for v in range(30)], "yr int, v long")
    ranked, starts = rank_within(grp, "yr", ["v"], out="r")
    assert all(x.r == x.v for x in ranked.collect())


def test_combine_fx_combine(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 7, None)], "id long, a long, b string")
    b = spark.createDataFrame([(1, 5, "p"), (3, 9, "q")], "id long, a long, c string")
    u = {r.id: (r.a, r.b, r.c) for r in combine([a, b], "id", "union").collect()}
    assert u == {1: (5, "x", "p"), 2: (7, None, None), 3: (9, None, "q")}
    i = {r.id: (r.a, r.b, r.c) for r in combine([a, b], "id", "intersect").collect()}
    assert i == {1: (5, "x", "p")}


def test_upsert_later_wins(spark):
    cache = spark.createDataFrame([(1, "Aves", "a"), (2, "Fungi", None)], "taxon_id long, iconic_taxon_name string, common_name string")
    fresh = spark.createDataFrame([(2, "Plantae", "b"), (3, None, "c")], "taxon_id long, iconic_taxon_name string, common_name string")
    got = {r.taxon_id: (r.iconic_taxon_name, r.common_name) for r in upsert_taxa(cache, fresh).collect()}
    assert got == {1: ("Aves", "a"), 2: ("Plantae", "b"), 3: (None, "c")}


def test_url_filter_fx_url(spark):
    urls = spark.createDataFrame([(0, "https://h/a/x_2019_2600-1199_0.5_2056.tif"), (1, "https://h/2600-1199.tif"),
                                  (2, "https://h/x_2600-1199_2600-1199_b.tif"), (3, "https://h/x_2601-1199_b.tif")],
                                 "pos long, url string")
    need = spark.createDataFrame([("2600-1199",)], "tile_key string")
    assert sorted(r.pos for r in urls_needed(urls, need).collect()) == [0, 2]
    present = spark.createDataFrame([("2600-1199.tif",)], "name string")
    assert sorted(r.pos for r in urls_missing(urls, present).collect()) == [0, 2, 3]


def test_raster_catalog_keys(spark):
    paths = spark.createDataFrame([("/t/swissalti3d_2019_2600-1199_2_2056.tif",), ("/t/swissalti3d_2021_2600-1199_2_2056.TIF",),
                                   ("/t/readme_2600-1199.txt",), ("/t/abc_x-y.tif",)], "path string")
    got = {r.tile_key: r.path for r in raster_catalog(paths).collect()}
    assert got == {"2600-1199": "/t/swissalti3d_2021_2600-1199_2_2056.TIF"}


def _footprint(spark, centres, r):
    df = spark.createDataFrame([(1, float(x), float(y)) for x, y in centres], "cluster_id int, E_lv95 double, N_lv95 double")
    arcs = boundary_arcs(df, r)
    return arcs, arc_area(arcs, r).first()


def test_footprint_single_disc_and_lens(spark):
    r = 500.0
    _, one = _footprint(spark, [(2600000, 1200000)], r)
    assert abs(one.area - math.pi * r * r) < 1e-3
    d = 300.0
    _, two = _footprint(spark, [(2600000, 1200000), (2600000 + d, 1200000)], r)
    lens = 2 * r * r * math.acos(d / (2 * r)) - d / 2 * math.sqrt(4 * r * r - d * d)
    assert abs(two.area - (2 * math.pi * r * r - lens)) < 1e-3


def test_footprint_monte_carlo_and_rings(spark):
    rnd = random.Random(11)
    r = 1.0
    centres = [(rnd.uniform(0, 6), rnd.uniform(0, 6)) for _ in range(30)]
    arcs, row = _footprint(spark, centres, r)
    C = np.array(centres)
    P = np.random.default_rng(1).uniform([-1, -1], [7, 7], size=(200000, 2))
    inside = (((P[:, None, :] - C[None, :, :]) ** 2).sum(-1) <= r * r).any(1).mean() * 64.0
    assert abs(row.area - inside) < 0.05 * inside
    v = footprint_vertices(arcs, r, simplify=0.0).toPandas()
    assert (v.groupby(["part", "ring"]).size() >= 4).all()
    for (_, ring), g in v.groupby(["part", "ring"]):
        xy = g.sort_values("idx")[["x", "y"]].to_numpy()
        assert np.allclose(xy[0], xy[-1])
        area = 0.5 * np.sum(xy[:-1, 0] * xy[1:, 1] - xy[1:, 0] * xy[:-1, 1])
        assert (area > 0) == (ring == 0)


def test_stream_enrichment_smoke(spark, tmpdir_path):
    import os
    from alpina.plans import fixtures as fx
    from alpina.streaming.stream import enrich_stream, observation_stream
    obs = fx.observations(spark, "/root/testdata/sf0.001")
    src = os.path.join(tmpdir_path, "in")
    obs.write.parquet(src)
    s = enrich_stream(observation_stream(spark, src, obs.schema), fx.taxa_cache(spark, "/root/testdata/sf0.001"))
    q = (s.writeStream.format("memory").queryName("alpina_stream_smoke")
          .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    n = spark.sql("SELECT count(*) AS n FROM alpina_stream_smoke").first().n
    assert n == 504


def test_footprint_prune_is_exact(spark):
    rnd = random.Random(5)
    pts = [(1, rnd.uniform(0, 8), rnd.uniform(0, 8)) for _ in range(400)] + \
          [(2, rnd.uniform(20, 23), rnd.uniform(0, 3)) for _ in range(60)]
    df = spark.createDataFrame(pts, "cluster_id int, E_lv95 double, N_lv95 double")
    full = {r.cluster_id: r for r in arc_area(boundary_arcs(df, 1.0, prune=False), 1.0).collect()}
    pruned = {r.cluster_id: r for r in arc_area(boundary_arcs(df, 1.0), 1.0).collect()}
    assert full.keys() == pruned.keys()
    for k in full:
        assert full[k].n_arcs == pruned[k].n_arcs and abs(full[k].area - pruned[k].area) < 1e-6


def test_rings_nest_holes_and_chain_long_boundaries(spark):
    # a closed necklace of discs (shell and hole), a disc alone in the hole, and a long straight chain
    r, n = 1.0, 40
    ring = [(1, 8 * math.cos(2 * math.pi * i / n), 8 * math.sin(2 * math.pi * i / n)) for i in range(n)] + [(1, 0.25, 0.1)]
    chain = [(2, 100 + 1.5 * i, 0.0) for i in range(300)]
    df = spark.createDataFrame([(c, float(x), float(y)) for c, x, y in ring + chain], "cluster_id int, E_lv95 double, N_lv95 double")
    v = footprint_vertices(boundary_arcs(df, r), r, simplify=0.0).toPandas()
    shape = {k: len(g) for k, g in v.groupby(["cluster_id", "part", "ring"])}
    assert set(shape) == {(1, 0, 0), (1, 0, 1), (1, 1, 0), (2, 0, 0)}
    assert shape[2, 0, 0] > 300
    for k, g in v.groupby(["cluster_id", "part", "ring"]):
        xy = g.sort_values("idx")[["x", "y"]].to_numpy()
        assert np.allclose(xy[0], xy[-1]) and (np.diff(g["idx"].sort_values()) == 1).all()
        assert np.hypot(*np.diff(xy, axis=0).T).max() < 0.2  # neighbours on the ring follow each other
        area = 0.5 * np.sum(xy[:-1, 0] * xy[1:, 1] - xy[1:, 0] * xy[:-1, 1])
        assert (area > 0) == (k[2] == 0)


@pytest.mark.parametrize("out", [1e-5, 1e-8])
def test_rings_go_on_past_arcs_shorter_than_the_reach(spark, out):
    # clusters 0-2: three circles nearly through one point, the middle one comes out by next to nothing (its arc's ends
    # are nearer than any match needs); 3: three circles leave a hole of that size; 4: two of them alone
    r, x, y = 500.0, 2600000.0, 1200000.0
    away = lambda k, degree, d: (k, x + d * math.cos(math.radians(degree)), y + d * math.sin(math.radians(degree)))
    rows = [away(k, turn + side, r) for k, turn in ((0, 0), (1, 77), (2, 200)) for side in (140, -140)]
    rows += [away(k, turn + 180, r - out) for k, turn in ((0, 0), (1, 77), (2, 200))]
    rows += [away(3, degree, r + out) for degree in (10, 130, 250)] + [away(4, 140, r), away(4, -140, r)]
    arcs = boundary_arcs(spark.createDataFrame(rows, "cluster_id int, E_lv95 double, N_lv95 double"), r)
    tiny = arcs.where("a1 - a0 < 1e-6").count()
    assert tiny >= (4 if out > 1e-6 else 1)
    v = footprint_vertices(arcs, r, simplify=0.0).toPandas()
    rings = {(k, *x[1:]): g.sort_values("idx")[["x", "y"]].to_numpy() for k in range(5) for x, g in v[v.cluster_id == k].groupby(["cluster_id", "part", "ring"])}
    assert set(rings) == {(k, 0, 0) for k in range(5)} | ({(3, 0, 1)} if out > 1e-6 else set())
    area = {k: 0.5 * np.sum((p[:-1, 0] - x) * (p[1:, 1] - y) - (p[1:, 0] - x) * (p[:-1, 1] - y)) for k, p in rings.items()}
    whole = {row.cluster_id: row.area for row in arc_area(arcs, r).collect()}
    for k in range(5):
        assert np.array_equal(rings[k, 0, 0][0], rings[k, 0, 0][-1])
        assert 0.995 * whole[k] < area[k, 0, 0] < whole[k]
    assert area.get((3, 0, 1), -1.0) < 0
    assert footprint_vertices(arcs, r).select("cluster_id").distinct().count() == 5


def test_cover_test_shuffles_blocks_and_intervals_once(spark):
    from alpina.operators.footprint import _uncovered_circles
    rnd, r, h = random.Random(8), 1.0, 0.25
    pts = {(1, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for _ in range(300)} | {(2, rnd.uniform(-3, 9), rnd.uniform(50, 51)) for _ in range(60)}
    df = spark.createDataFrame([*pts], "cid int, cx double, cy double")
    # by hand: a cell is covered by a centre in a cell whose farthest corner is within r; a circle with all its cells covered is dropped
    reach = [(a, b) for a in range(-4, 5) for b in range(-4, 5) if (abs(a) + 1) ** 2 + (abs(b) + 1) ** 2 <= 16]
    cell = lambda v: math.floor(v / h)
    covered = {(c, cell(x) + a, cell(y) + b) for c, x, y in pts for a, b in reach}

    def crossed(x, y):
        for i in range(cell(x) - 5, cell(x) + 6):
            for j in range(cell(y) - 5, cell(y) + 6):
                near = math.hypot(max(i * h - x, 0, x - i * h - h), max(j * h - y, 0, y - j * h - h))
                far = math.hypot(max(abs(x - i * h), abs(x - i * h - h)), max(abs(y - j * h), abs(y - j * h - h)))
                if near <= r <= far:
                    yield i, j

    left = {(c, x, y) for c, x, y in pts if any((c, i, j) not in covered for i, j in crossed(x, y))}
    found = _uncovered_circles(df, r)
    assert {tuple(row) for row in found.collect()} == left and 0 < len(left) < len(pts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString().split("\n")
        shuffles = [line for line in plan(_uncovered_circles(df, r)) if "Exchange hashpartitioning" in line]
        assert shuffles and not any("qx" in line for line in shuffles)
        arcs = boundary_arcs(df.withColumnsRenamed({"cid": "cluster_id", "cx": "E_lv95", "cy": "N_lv95"}), r)
        assert sum("Exchange hashpartitioning" in line for line in plan(arcs)) == 3  # both sides of the pairs, then the intervals
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
