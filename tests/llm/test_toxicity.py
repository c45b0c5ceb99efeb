"""The chain against enumeration of all labellings; training and scoring on planted words."""

import itertools
import random

import numpy as np

from alpina.llm import toxicity as T

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, score int, spans string"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, a = rng.normal(0, 2, 7), rng.normal(0, 1, (2, 2))
    starts, lengths = np.array([0, 4, 5]), np.array([4, 1, 2])
    f, b = T.forward_backward(scores, starts, lengths, a)
    for s, n in zip(starts, lengths):
        weight = {y: np.exp(sum(scores[s + i] * y[i] for i in range(n)) + sum(a[y[i], y[i + 1]] for i in range(n - 1))) for y in itertools.product((0, 1), repeat=int(n))}
        for i in range(n):
            p = sum(w for y, w in weight.items() if y[i]) / sum(weight.values())
            assert abs(p - 1 / (1 + np.exp(-f[s + i] - b[s + i]))) < 1e-9


def corpus(n, seed=2):
    r = random.Random(seed)
    syllables = "ka ro mi ten sul ver pa lon di ga".split()
    rows = []
    for i in range(n):
        words = ["".join(r.choice(syllables) for _ in range(r.randint(2, 4))) for _ in range(r.randint(5, 60))]
        bad = r.random() < 0.25
        if bad:
            words[r.randrange(len(words))] = r.choice(["grumph", "zwackel" + r.choice(syllables), "blerg"])
        rows.append((i, " ".join(words) + ".", int(bad)))
    return rows


def test_planted_words_are_found_with_offsets():
    rows = corpus(600)
    model = T.train([t for _, t, _ in rows[:400]], np.array([y for _, _, y in rows[:400]], bool))
    score, spans = T.Scorer(model).score([t for _, t, _ in rows[400:]])
    y = np.array([y for _, _, y in rows[400:]])
    assert ((score >= 0.3) == y).mean() > 0.97
    for (_, t, label), found in zip(rows[400:], spans):
        if label and found:
            assert any(t[s["start"]:s["end"]].startswith(("grumph", "zwackel", "blerg")) for s in found)


def test_query_edges(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t, _ in rows] + [(None, "no id", 1, "s"), (900, None, 1, "s"), (901, "", 1, "s"), (902, "word " * 30_000, 1, "s"), (3, rows[3][1], 1, "s")], SCHEMA)
    labels = spark.createDataFrame([(d, y, None) for d, _, y in rows] + [(None, 1, 1), (5, None, 1)], "doc_id long, toxic int, quality int")
    got = T.toxicity(docs, labels).collect()
    assert len(got) == 305 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    plain = {r.doc_id: r for r in got}
    assert not plain[900].predicted and not plain[901].predicted and not plain[902].predicted and plain[900].score == plain[901].score
    unlabelled = T.toxicity(docs.limit(5), labels.limit(0)).collect()
    assert [r.score for r in unlabelled] == [0.0] * 5
    assert T.toxicity(docs.limit(0), labels).count() == 0


def test_repeated_rows_are_one_training_document(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(40)] + [(d, f"text {d}") for d in range(2, 10)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 30 + [(d, d % 2) for d in range(2, 10)] + [(4, 1)], "doc_id long, toxic int")
    texts, y = T.labelled_sample(docs, labels, "toxic", 4, 9, (6, 3))
    assert texts[0].startswith("copy ") and texts[1:] == [f"text {d}" for d in range(2, 10)]
    assert y.tolist() == [True, False, True, True, True, False, True, False, True]
    assert len(T.labelled_sample(docs, labels, "toxic", 4, 9, (2, 2))[0]) == 4
