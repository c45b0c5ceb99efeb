"""The join against all pairs."""

import random
import re

import numpy as np
import pytest

from alpina.llm import near_join as N

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, node long, h int, grp string"


def shingle_set(t):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain(rows):
    sets = [shingle_set(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)
    rank = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)), key=rank)
                root[y] = x
    return sorted(((rows[i][0], rows[find(i)][0], links[i]) for i in range(len(rows))), key=repr)


def corpus(seed=8):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 6)))
    rows = []
    for g in range(6):
        base = [word() for _ in range(r.choice([40, 80, 150]))]
        for _ in range(r.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    r.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block, shortest", [(512, 6), (4, 4)])
def test_equals_all_pairs(spark, block, shortest):
    rows = corpus() + [(500, None), (501, ""), (None, "a b c d e f g"), (503, "a b c d e f g"), (503, "A b, c d e f g"), (504, "x y"), (505, "x Y"), (506, "..."), (507, "long " * 20_000), (None, "z")]
    df = spark.createDataFrame([(*r, 1, 2, "g") for r in rows], SCHEMA)
    got = N.near_duplicates(df, block=block, shortest=shortest).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == plain(rows)


def test_one_per_group(spark):
    rows = corpus() + [(500, None), (501, ""), (7000, "p q r s t"), (7000, "p q r s t"), (None, "p q r s t")]
    df = spark.createDataFrame([(*r, 1, 2, "g") for r in rows], SCHEMA)
    kept = N.one_per_group(df)
    assert kept.columns == df.columns
    wanted = sorted({c for _, c, _ in plain(rows)}, key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == wanted
    assert N.one_per_group(df.limit(0)).count() == 0


def test_depth_reaches_recall():
    d = N.depth_for(0.99)
    assert 1 - (1 - 0.8 ** d) ** N.TREES >= 0.99 > 1 - (1 - 0.8 ** (d + 1)) ** N.TREES


def test_common_counts():
    rng = np.random.default_rng(4)
    a = [np.unique(rng.integers(0, 40, 12)).astype(np.uint64) for _ in range(5)]
    b = [np.unique(rng.integers(0, 40, 9)).astype(np.uint64) for _ in range(4)]
    assert (N.common_counts(a, b, width=7) == [[len(np.intersect1d(x, y)) for y in b] for x in a]).all()
    same = N.common_counts(a, width=7)
    assert all(same[i, j] == len(np.intersect1d(a[i], a[j])) for i in range(5) for j in range(5) if i != j)


def test_shorter_prefixes_only_in_small_runs(spark):
    # five texts share four labels of one tree and nothing else; three of another tree share five
    def paths(i, trees, depth):
        labels = np.arange(trees * depth, dtype=">u4") + 1000 * (i + 1)
        if i < 5:
            labels[:4] = [1, 2, 3, 4]
        if i < 3:
            labels[depth:depth + 5] = [5, 6, 7, 8, 9]
        return bytearray(labels.tobytes())

    classes = spark.createDataFrame([(i, paths(i, 2, 8)) for i in range(8)], "node long, paths binary")
    edges = lambda small: {(r.src, r.dst) for r in N.candidate_edges(classes, 2, 8, 6, 4, small).collect()}
    assert edges(16) == {(1, 0), (2, 0), (3, 0), (4, 0)}
    assert edges(4) == {(1, 0), (2, 0)} and edges(2) == set()
