"""The factorisation machine against the sum over pairs; training and scoring on planted junk."""

import random

import numpy as np

from alpina.llm import quality as Q

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, score int, n_chars int"


def test_sum_of_squares_equals_pairs():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=30), rng.normal(size=(30, Q.RANK))
    doc, feature, value = np.array([0, 0, 0, 1, 1]), np.array([3, 7, 20, 0, 29]), rng.normal(size=5)
    raw, _ = Q.raw_scores(0.3, w, v, doc, feature, value, 2)
    for d in (0, 1):
        at = np.flatnonzero(doc == d)
        pairs = sum(v[feature[i]] @ v[feature[j]] * value[i] * value[j] for n, i in enumerate(at) for j in at[n + 1:])
        assert abs(raw[d] - (0.3 + (w[feature[at]] * value[at]).sum() + pairs)) < 1e-9


def corpus(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choice("abcdefg") for _ in range(r.randint(2, 8))) for _ in range(r.randint(20, 80))]
        good = r.random() < 0.7
        if not good:
            kind = r.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + "%%%" for w in words] if kind == 1 else [words[0]] * len(words)
        rows.append((i, " ".join(words), int(good)))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = corpus(500)
    extra = [(None, "no id"), (900, None), (901, ""), (902, "word " * 30_000), (3, rows[3][1])]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t, _ in rows] + [(*x, 1, 2) for x in extra], SCHEMA)
    labels = spark.createDataFrame([(d, y, None) for d, _, y in rows] + [(None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    got = Q.quality(docs, labels).collect()
    assert len(got) == 505 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    label = {d: y for d, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert len(held) > 100 and np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95
    assert [r.score for r in Q.quality(docs.limit(4), labels.limit(0)).collect()] == [0.5] * 4
    assert Q.quality(docs.limit(0), labels).count() == 0
