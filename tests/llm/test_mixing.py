"""Mixing against a plain Python version: targets by repeated resharing, order by sorted keys."""

import hashlib
import math
import re

import pytest

from alpina.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long"


def plain_targets(sizes, weights=(5, 2, 1), ratio=1.5, limit=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = ratio * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total >= limit * sizes[s]]
        if not over:
            target.update({s: left * w[s] / total for s in open_})
            break
        for s in over:
            target[s] = float(limit * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def plain_mix(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target, out = plain_targets(sizes), []
    for s in sizes:
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        left = math.floor(target[s] + 0.5) - epochs * sizes[s]
        keyed = []
        for d, t, s2 in rows:
            if s2 == s:
                t = t or ""
                u = (int(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
                kept = sum(c not in mixing.SYMBOLS for c in t)
                keyed.append((-math.log(u) / (0.1 + 0.9 * (kept / len(t) if t else 1.0)), d is None, d or 0, size(t), d))
        for _, _, _, n, d in sorted(keyed):
            part = max(0, min(n, left))
            left -= part
            out.append((d, n, s, epochs * n + part))
    return target, sorted(out, key=repr)


def rows_of(n, sources, seed=1):
    import random
    r = random.Random(seed)
    return [(i, " ".join(r.choice(["a", "bb", "c#c", "d!"]) for _ in range(r.choice([1, 3, 9, 40]))), r.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["a", "b", "c", "d", None], ["x"] * 20 + ["y", "z", "é"]])
def test_equals_plain(spark, sources):
    rows = rows_of(150, sources) + [(900, None, sources[0]), (901, "", None), (902, "w " * 3000, sources[-1]), (None, "null id", sources[0])]
    df = spark.createDataFrame([(*x, 7) for x in rows], SCHEMA)
    got = mixing.mix(df).collect()
    target, plain = plain_mix(rows)
    assert sorted(((r.doc_id, r.size, r.source, r.taken) for r in got), key=repr) == plain
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.partial
    taken = {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)


def test_reruns_agree_and_ties(spark):
    rows = [(1, "a b c", "s", 0)] * 4 + [(1, "a b", "s", 0), (2, "a b c", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    one, two = (sorted(map(tuple, mixing.mix(df).collect())) for _ in range(2))
    assert one == two and sum(r[7] for r in one) == 26  # 1.5 x 17 words, rounded


def test_mixed_documents_are_whole(spark):
    rows = rows_of(80, ["a", "b", None], seed=4)
    df = spark.createDataFrame([(*x, 7) for x in rows], SCHEMA)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    texts = {(d, t) for d, t, _ in rows}
    got = mixed.collect()
    assert got and all((r.doc_id, r.text) in texts and r.size == 7 for r in got)
    target, _ = plain_mix(rows)
    words = {}
    for r in got:
        words[r.source] = words.get(r.source, 0) + len((r.text or "").split())
    assert all(abs(words[s] - target[s]) <= 20 for s in words)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0
