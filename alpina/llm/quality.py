"""Quality scores by a factorisation machine of second order.

Features of a document: its hashed words (``WORD_SCALE``/sqrt(distinct words)
times the damped count), structure statistics in bins, and the length of the
text (the table's ``n_chars``, counted anew so that it is never null) in bins. The score is
``w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum (v_if x_i)^2]``
through a logistic function: linear time in the number of features by the
sum-of-squares identity.

Training runs on a bounded sample of labelled documents (``MAX_EACH`` of each
class, of at most ``MAX_CHARS`` characters, chosen by a hash; near copies count once) with adaptive
gradient steps on mini-batches; the last step shifts ``w0`` so that the sample
is weighed by the true share of the classes. Scoring maps over all documents whole.

Defined results: a null or empty text has no words and zero statistics and is
scored like any other; rows without a label train nothing; without labels of
both classes every score is 0.5; repeated rows are scored separately; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .toxicity import labelled_sample, remainder

WORDS = 1 << 16
BINS = 16
RANK = 8
WORD_SCALE = 0.5
MAX_EACH, MAX_CHARS = 2000, 10_000
MEMO = 400_000
TOKENS = re.compile(r"[^\W_]+")
#: fixed values: byte classes - 0 other ASCII symbols, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sentence mark, 7 beyond ASCII
_CLASS = bytes(
    7 if b > 127 else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57
    else 5 if b in (10, 13) else 4 if b in (9, 32) else 6 if chr(b) in ".,;:?'\"-()" else 0 for b in range(256))
STATISTICS = 13
FEATURES = WORDS + STATISTICS * BINS


def statistics(text: str, ids: np.ndarray) -> list[float]:
    """Structure statistics of a text and its word numbers, each without unit."""
    raw = text.encode("utf-8", "replace")
    c = np.bincount(np.frombuffer(raw.translate(_CLASS), np.uint8), minlength=8)
    total, letters, n = max(1, len(raw)), max(1, int(c[1] + c[2])), len(ids)
    counts = np.bincount(ids) if n else np.zeros(1, int)
    return [c[0] / total, c[2] / letters, c[3] / total, c[4] / total, c[5] / total, c[6] / total, c[7] / total,
            math.log1p(n), (counts > 0).sum() / max(1, n), float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
            counts.max() / max(1, n), len(raw) / max(1, n), math.log1p(len(text))]


@dataclass(frozen=True)
class Model:
    """Bias, linear weights, factors, bin edges of the statistics; ``known``: both classes were seen."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    edges: np.ndarray
    known: bool


class Encoder:
    """Feature triples (document, feature, value) of whole texts; word hashes are kept until the memo is full."""

    def __init__(self, memo: int = MEMO):
        self.memo, self.limit = {}, memo

    def words(self, text: str) -> np.ndarray:
        tokens = TOKENS.findall(text.lower())
        memo = self.memo
        new = set(tokens).difference(memo)
        if new:
            if len(memo) + len(new) > self.limit:
                memo.clear()
                new = set(tokens)
            memo.update((x, zlib.crc32(x.encode()) % WORDS) for x in new)
        return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))

    def rows(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        ids = [self.words(t) for t in texts]
        return ids, np.array([statistics(t, i) for t, i in zip(texts, ids)], float).reshape(len(texts), STATISTICS)


def triples(ids: list[np.ndarray], stats: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, feature, value)`` sorted by document."""
    sizes = np.array([len(x) for x in ids], np.int64)
    key, count = np.unique(np.repeat(np.arange(len(ids)), sizes) * WORDS + np.concatenate([*ids, np.zeros(0, np.int64)]), return_counts=True)
    doc, feature = np.divmod(key, WORDS)
    distinct = np.maximum(1, np.bincount(doc, minlength=len(ids)))
    value = WORD_SCALE * np.log1p(count) / math.log(2) / np.sqrt(distinct[doc])
    bins = np.stack([np.searchsorted(edges[j], stats[:, j], side="right") for j in range(STATISTICS)], axis=1)
    s_feature = (WORDS + np.arange(STATISTICS) * BINS + bins).ravel()
    s_doc = np.repeat(np.arange(len(ids)), STATISTICS)
    doc, feature = np.concatenate([doc, s_doc]), np.concatenate([feature, s_feature])
    value = np.concatenate([value, np.ones(len(s_doc))])
    order = np.argsort(doc, kind="stable")
    return doc[order], feature[order], value[order]


def _sums(x: np.ndarray, doc: np.ndarray, documents: int) -> np.ndarray:
    """Sums of the rows of ``x`` per document; every document has rows and they are sorted."""
    return np.add.reduceat(x, np.searchsorted(doc, np.arange(documents)), axis=0)


def raw_scores(model_w0, w, v, doc, feature, value, documents) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the logistic function, and ``sum v_if x_i`` of each document."""
    vx = v[feature] * value[:, None]
    s = _sums(vx, doc, documents)
    squares = _sums((vx * vx).sum(axis=1), doc, documents)
    return model_w0 + _sums(w[feature] * value, doc, documents) + 0.5 * ((s * s).sum(axis=1) - squares), s


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[str], good: np.ndarray, epochs: int = 12, batch: int = 64, ridge: float = 1e-4, seed: int = 7, prior: float | None = None) -> Model:
    """Fit the machine on whole texts with 0/1 labels; ``prior``: the positive share of all labels."""
    good = np.asarray(good, bool)
    if not len(texts) or good.all() or not good.any():
        return Model(0.0, np.zeros(FEATURES), np.zeros((FEATURES, RANK)), np.zeros((STATISTICS, BINS - 1)), False)
    ids, stats = Encoder().rows(texts)
    # near copies (same few smallest word hashes) count once
    seen: dict = {}
    for i, x in enumerate(ids):
        seen.setdefault((tuple(np.unique(x)[:4].tolist()), len(x) // 8), i)
    keep = sorted(seen.values())
    ids, stats, good = [ids[i] for i in keep], stats[keep], good[keep]
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    y, rng = good.astype(float), np.random.default_rng(seed)
    w, v, w0 = np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK)), 0.0
    g_w, g_v, g_0 = np.full(FEATURES, 1e-4), np.full((FEATURES, RANK), 1e-4), 1e-4
    doc, feature, value = triples(ids, stats, edges)
    begin = np.searchsorted(doc, np.arange(len(ids) + 1))
    share = good.mean()
    weight = np.where(good, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for i in range(0, len(order), batch):
            chosen = np.sort(order[i:i + batch])
            at = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in chosen])
            own = np.repeat(np.arange(len(chosen)), begin[chosen + 1] - begin[chosen])
            f, x = feature[at], value[at]
            raw, s = raw_scores(w0, w, v, own, f, x, len(chosen))
            error = (_sigmoid(raw) - y[chosen]) * weight[chosen] / len(chosen)
            uniq, inverse = np.unique(f, return_inverse=True)
            ex = error[own] * x
            grad_w = np.bincount(inverse, ex, len(uniq)) + ridge * w[uniq]
            part = ex[:, None] * (s[own] - v[f] * x[:, None])
            grad_v = np.stack([np.bincount(inverse, part[:, k], len(uniq)) for k in range(RANK)], axis=1) + ridge * v[uniq]
            g_w[uniq] += grad_w ** 2
            g_v[uniq] += grad_v ** 2
            g_0 += error.sum() ** 2
            w[uniq] -= 0.1 * grad_w / np.sqrt(g_w[uniq])
            v[uniq] -= 0.05 * grad_v / np.sqrt(g_v[uniq])
            w0 -= 0.1 * error.sum() / math.sqrt(g_0)
    prior = min(max(share if prior is None else prior, 1e-3), 1 - 1e-3)
    return Model(w0 + 0.5 * math.log(prior / (1 - prior)), w, v, edges, True)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.encoder = model, Encoder()

    def score(self, texts: list[str]) -> list[np.ndarray]:
        m = self.model
        if not m.known:
            return [np.full(len(texts), 0.5)]
        doc, feature, value = triples(*self.encoder.rows(texts), m.edges)
        return [_sigmoid(raw_scores(m.w0, m.w, m.v, doc, feature, value, len(texts))[0])]


def quality_model(docs: DataFrame, labels: DataFrame, divisor: int = 3, held_out: int = 1) -> Model:
    texts, good = labelled_sample(docs, labels, "quality", divisor, held_out, (MAX_EACH, MAX_EACH), MAX_CHARS)
    share = labels.where((remainder(F.col("doc_id"), divisor) != held_out)).agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return train(texts, good, prior=share)


_WORKER: dict = {}


def worker_scorer(number: int, model: Model) -> Scorer:
    """The scorer of this Python worker for the model with that broadcast number, kept between tasks."""
    if number not in _WORKER:
        _WORKER.clear()
        _WORKER[number] = Scorer(model)
    return _WORKER[number]


def score_quality(docs: DataFrame, model: Model, keep_rows: bool = False) -> DataFrame:
    """``score`` of every document, with ``doc_id`` or its ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x (RANK + 1) numbers, about 5 MB
    number = shared._jbroadcast.id()

    def make():
        from alpina.llm.quality import worker_scorer  # the worker's own module keeps the memo
        return worker_scorer(number, shared.value).score

    return map_texts(docs, make, "score double", keep_rows)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score_quality(docs, quality_model(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
