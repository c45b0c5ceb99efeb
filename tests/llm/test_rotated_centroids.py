"""Integer k-means against a plain loop in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from alpina.llm.rotated_centroids import Centroids, clustered, nearest, principal_axes


def _plain(rows, k, rounds, length, seed=3):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        a = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (c, _) in zip(kept, a) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    a = assign()
    total = sum(d for _, d in a)
    return sorted((str(i), c, d, sum(x for y, x in a if y == c), total, hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, a))


def _rows(n, length, rnd):
    centres = [[rnd.gauss(0, 1) for _ in range(length)] for _ in range(5)]
    return [(i, [float(np.float32(c + rnd.gauss(0, 0.3))) for c in rnd.choice(centres)]) for i in range(n)]


def _got(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_equals_a_plain_loop(spark):
    rnd = random.Random(1)
    rows = _rows(300, 8, rnd)
    # left out: null, short, long, null / NaN / infinite components; kept: repeated rows, ties, a null id, large values
    rows += [(900, None), (901, [1.0] * 7), (902, [1.0] * 9), (903, [None] + [1.0] * 7), (904, [float("nan")] + [0.0] * 7), (905, [float("inf")] * 8)]
    rows += [rows[5], rows[5], (None, [0.5] * 8), (7, [-0.25] * 8), (906, [100000.0] * 8), (907, [0.0] * 8), (908, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cluster int").repartition(5)
    assert _got(clustered(df, length=8, lead=3)) == _plain(rows, 8, 10, 8)
    assert _got(clustered(df, k=3, rounds=2, length=8, lead=8)) == _plain(rows, 3, 2, 8)


def test_small_and_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clustered(empty, length=4).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert clustered(empty, length=4).count() == 0
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(clustered(df, length=2, lead=1)) == _plain(rows, 8, 10, 2)


def test_components_that_would_overflow_raise(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="27 bits"):
        clustered(df, length=2).collect()


def test_screen_prunes_and_never_loses():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 4000, (8, 64))
    v = (centres[rng.integers(0, 8, 3000)] + rng.normal(0, 300, (3000, 64))).astype(np.int32)
    axes = principal_axes(v)
    c = Centroids.of(centres.astype(np.int64), axes, 16)
    turned = v @ axes
    number, distance, checked = nearest(v, turned[:, :16], np.sqrt(np.square(turned[:, 16:]).sum(1)), c)
    all_d = np.square(v[:, None].astype(np.int64) - c.v[None]).sum(2)
    assert (distance == all_d.min(1)).all() and (number == all_d.argmin(1)).all()
    assert checked < 1.2 * len(v)  # of 8 * len(v)
