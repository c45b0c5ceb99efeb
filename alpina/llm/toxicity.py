"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training runs on a bounded sample of labelled documents (``MAX_TOXIC`` toxic
and ``MAX_CLEAN`` others of at most ``MAX_CHARS`` characters, chosen by a hash;
near copies count once). Labels are per document, so tokens are labelled first:
features that stand in many toxic and hardly ever in clean documents are picked,
then further ones greedily until the toxic documents are explained; tokens with a picked feature
are toxic in toxic documents, all others are not. The chain (two labels;
hashed word and prefix features; transition weights) is then fitted by its
conditional likelihood, with gradients from forward-backward marginals. Two
figures of a document - the log-odds of its largest marginal and the sum of its
marginals that are not negligible - go through a logistic calibration to the score.

Scoring maps over all documents whole: sentences are chains, all chains of a
batch run in step, word scores are kept in a bounded memo per worker.

Defined results: a null or empty text has no tokens and scores like a text
whose tokens are all clean; rows without a label train nothing; if there is no
toxic label to learn from, every score is 0; repeated rows train once and are
scored separately; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

PREFIXES = (4, 5, 6, 7)
#: a feature below this weight is kept only if this many training documents have it
LEAST_WEIGHT, LEAST_DOCS = 0.05, 5
LEAST_MARGINAL = 0.1
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1500, 2000, 4000
#: word scores that a worker keeps (about 20 MB), and characters scored together
MEMO = 100_000
GROUP_CHARS = 500_000
SPAN = "array<struct<start: int, end: int, p: double>>"
TOKENS = re.compile(r"[^\W_]+|[.!?\n]")
ENDS = frozenset(".!?\n")


def remainder(doc_id: Column, divisor: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def same_length_lower(text: str) -> str:
    """Lower case by character, so that offsets hold (a letter that would become two stays)."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: the word itself, then its prefixes (the word again where it is shorter)."""
    own = zlib.crc32(b"w" + word.encode())
    return [own] + [zlib.crc32(b"p" + word[:n].encode()) if len(word) >= n else own for n in PREFIXES]


@dataclass(frozen=True)
class Model:
    """Weights by feature hash, bias, transition weights ``[from, to]`` (0 clean, 1 toxic), calibration; ``known``: toxic labels were seen."""

    weights: dict[int, float]
    bias: float
    transitions: np.ndarray
    calibration: np.ndarray
    known: bool


def chains(is_end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs without sentence ends; ``first`` marks tokens that begin a document."""
    inside = ~is_end
    begins = inside & np.concatenate([[True], is_end[:-1]]) | inside & first
    starts = np.flatnonzero(begins)
    number = np.cumsum(begins)[inside] - 1
    return starts, np.bincount(number, minlength=len(starts))


def forward_backward(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds messages ``(forward, backward)`` of every token; all chains advance in step."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    f, b = np.zeros(len(scores)), np.zeros(len(scores))
    if not len(starts):
        return f, b
    f[starts] = scores[starts]
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, lengths[0] + 1), side="left")  # chains longer than t
    (e00, e01), (e10, e11) = np.exp(a)
    for t in range(1, lengths[0]):
        at = starts[: active[t]] + t
        ratio = np.exp(np.clip(f[at - 1], -30, 30))
        f[at] = scores[at] + np.log((e01 + ratio * e11) / (e00 + ratio * e10))
    for t in range(lengths[0] - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        ratio = np.exp(np.clip(scores[at + 1] + b[at + 1], -30, 30))
        b[at] = np.log((e10 + ratio * e11) / (e00 + ratio * e01))
    return f, b


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _document_figures(p: np.ndarray, doc: np.ndarray, documents: int) -> np.ndarray:
    """Per document: 1, log-odds of the largest marginal, log of 1 + the sum of marginals of ``LEAST_MARGINAL`` or more."""
    top = np.full(documents, 1e-6)
    np.maximum.at(top, doc, p)
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(documents), np.log(top / (1 - top)), np.log1p(np.bincount(doc, np.where(p >= LEAST_MARGINAL, p, 0), documents))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = _sigmoid(x @ w)
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - q) - ridge * w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return w


def _distinct(token_words: list[np.ndarray], hashes: np.ndarray, bands: int = 8, rows: int = 4) -> list[int]:
    """Numbers of the documents to keep: of near copies (a band of word MinHashes in common) the first."""
    rng = np.random.default_rng(3)
    mult, add = rng.integers(1, 1 << 31, (2, bands * rows, 1), dtype=np.int64)
    seen, keep = set(), []
    for i, w in enumerate(token_words):
        h = hashes[np.unique(w)]
        low = ((h * mult + add) % 2147483647).min(axis=1, initial=1 << 31).reshape(bands, rows)
        own = [(k, *x) for k, x in enumerate(low.tolist())]
        if seen.isdisjoint(own):
            keep.append(i)
        seen.update(own)
    return keep


def _pick_features(pairs_doc: np.ndarray, pairs_feature: np.ndarray, toxic: np.ndarray, n_features: int, of_words: np.ndarray, least_odds: float = 3.0, least_docs: int = 3) -> np.ndarray:
    """Features of a large share of the toxic documents; then, one by one, those that explain most of the documents left."""
    is_toxic = toxic[pairs_doc]
    n_toxic = np.bincount(pairs_feature[is_toxic], minlength=n_features)
    n_clean = np.bincount(pairs_feature[~is_toxic], minlength=n_features)
    odds = np.log((n_toxic + 0.5) / (toxic.sum() + 1)) - np.log((n_clean + 0.5) / ((~toxic).sum() + 1))
    plain = (odds >= 1.5) & (n_toxic >= max(5, int(toxic.sum()) // 50))
    able = (odds >= least_odds) & (n_toxic >= least_docs)
    # a prefix that nearly always stands for one word says no more than the word
    prefix, word = of_words[:, 1:].ravel(), np.repeat(of_words[:, 0], of_words.shape[1] - 1)
    other = prefix != word
    most = np.zeros(n_features, np.int64)
    np.maximum.at(most, prefix[other], n_toxic[word[other]])
    able &= most < 0.8 * np.maximum(1, n_toxic)
    use = is_toxic & able[pairs_feature]
    least_docs = max(least_docs, int(toxic.sum()) // 200)
    # plain evidence: features of one toxic document in fifty
    picked = np.flatnonzero(plain & (most < 0.8 * np.maximum(1, n_toxic))).tolist()
    doc, feature = pairs_doc[use], pairs_feature[use]
    rest = ~np.isin(doc, doc[np.isin(feature, picked)])
    doc, feature = doc[rest], feature[rest]
    while len(doc):
        n = np.bincount(feature, minlength=n_features)
        best = int(np.argmax(n * (1 + 1e-3 * odds)))
        if n[best] < least_docs:
            break
        picked.append(best)
        rest = ~np.isin(doc, doc[feature == best])
        doc, feature = doc[rest], feature[rest]
    return np.array(picked, np.int64)


def train(texts: list[str], toxic: np.ndarray, rounds: int = 30, ridge: float = 1e-3) -> Model:
    """Fit the chain on whole texts with document labels (see the module text)."""
    nothing = Model({}, 0.0, np.zeros((2, 2)), np.zeros(3), False)
    if not len(texts) or not toxic.any() or toxic.all():
        return nothing
    number: dict[str, int] = {}
    tokens = [np.fromiter((number.setdefault(x, len(number)) for x in TOKENS.findall(same_length_lower(t))), np.int64) for t in texts]
    vocabulary = list(number)
    hashes = np.array([word_features(w) for w in vocabulary], np.int64).reshape(len(vocabulary), 1 + len(PREFIXES))
    names, features = np.unique(hashes, return_inverse=True)
    features, n_features = features.reshape(hashes.shape), len(names)
    ends = np.array([w in ENDS for w in vocabulary], bool)
    keep = _distinct(tokens, hashes[:, 0])
    tokens, toxic = [tokens[i] for i in keep], np.asarray(toxic, bool)[keep]

    sizes = np.array([len(x) for x in tokens])
    flat, doc = np.concatenate(tokens), np.repeat(np.arange(len(tokens)), sizes)
    pair = np.unique(doc * len(vocabulary) + flat)
    pair_doc, pair_word = np.divmod(pair, len(vocabulary))
    pair_word_ok = ~ends[pair_word]
    pair_doc, pair_word = pair_doc[pair_word_ok], pair_word[pair_word_ok]
    both_doc, both_feature = np.divmod(np.unique((pair_doc[:, None] * n_features + features[pair_word]).ravel()), n_features)
    picked = _pick_features(both_doc, both_feature, toxic, n_features, features)
    # prefixes that were not picked would only repeat the word: they carry no weight
    free = np.zeros(n_features, bool)
    free[features[:, 0]] = True
    free[picked] = True
    marked = np.isin(features, picked).any(axis=1) & ~ends
    y = marked[flat] & toxic[doc]
    explained = np.zeros(len(tokens), bool)
    explained[doc[y]] = True
    used = explained | ~toxic
    if not y.any():
        return nothing

    chosen = used[doc]
    flat_used, doc_used, y_used = flat[chosen], doc[chosen], y[chosen].astype(float)
    is_end = ends[flat_used]
    begins = np.concatenate([[True], doc_used[1:] != doc_used[:-1]])
    starts, lengths = chains(is_end, begins)
    inside = ~is_end
    follows = inside.copy()
    follows[starts] = False
    second = np.flatnonzero(follows)  # tokens with a predecessor in their chain
    weights, a, bias = np.zeros(n_features), np.zeros((2, 2)), -5.0
    seen_w, seen_a = np.full(n_features, 1e-6), np.full((2, 2), 1e-6)
    seen_bias = 1e-6
    n_words = len(vocabulary)
    for _ in range(rounds):
        word_score = weights[features].sum(axis=1) + bias
        scores = word_score[flat_used]
        f, b = forward_backward(scores, starts, lengths, a)
        p = _sigmoid(f + b)
        error = np.where(inside, y_used - p, 0.0)
        by_word = np.bincount(flat_used, error, n_words)
        grad = np.bincount(features.ravel(), np.repeat(by_word, features.shape[1]), n_features) * free - ridge * weights
        # pair marginals of consecutive tokens
        left, right = f[second - 1], scores[second] + b[second]
        joint = np.stack([np.zeros_like(left) + a[0, 0], right + a[0, 1], left + a[1, 0], left + right + a[1, 1]])
        joint = np.exp(joint - np.logaddexp.reduce(joint, axis=0))
        y0, y1 = y_used[second - 1], y_used[second]
        seen = np.array([((1 - y0) * (1 - y1)).sum(), ((1 - y0) * y1).sum(), (y0 * (1 - y1)).sum(), (y0 * y1).sum()])
        grad_a = (seen - joint.sum(axis=1)).reshape(2, 2) - ridge * a
        seen_w += grad * grad
        seen_a += grad_a * grad_a
        seen_bias += error.sum() ** 2
        weights += 0.7 * grad / np.sqrt(seen_w)
        bias += 0.1 * error.sum() / np.sqrt(seen_bias)
        a = a + 0.1 * grad_a / np.sqrt(seen_a)
    scores = (weights[features].sum(axis=1) + bias)[flat]
    is_end = ends[flat]
    starts, lengths = chains(is_end, np.concatenate([[True], doc[1:] != doc[:-1]]))
    f, b = forward_backward(scores, starts, lengths, a)
    inside = ~is_end
    figures = _document_figures(_sigmoid(f + b)[inside], doc[inside], len(tokens))
    kept = (weights > LEAST_WEIGHT) | (np.bincount(both_feature, minlength=n_features) >= LEAST_DOCS)
    return Model(dict(zip(names[kept].tolist(), weights[kept].tolist())), bias, a, _logistic(figures, toxic.astype(float)), True)


class Scorer:
    """Scores batches of whole texts; word scores are kept until the memo is full."""

    def __init__(self, model: Model, memo: int = MEMO):
        self.model, self.limit = model, memo
        self.memo: dict[str, float] = {}
        self._clear()

    def _clear(self):
        self.memo = {e: float("nan") for e in ENDS}

    def _learn(self, words: set[str]):
        get, bias = self.model.weights.get, self.model.bias
        self.memo.update((x, sum([get(i, 0.0) for i in word_features(x)]) + bias) for x in words)

    def score(self, texts: list[str], spans_from: float = 0.5) -> tuple[np.ndarray, list[list]]:
        """Document scores, and ``[start, end, p]`` of the tokens with a marginal of ``spans_from`` or more."""
        if not self.model.known:
            return np.zeros(len(texts)), [[] for _ in texts]
        # a sentence mark ends each document, so chains cannot cross
        lower = [same_length_lower(t) for t in texts]
        tokens = [TOKENS.findall(t) for t in lower]
        new = {x for ts in tokens for x in ts}.difference(self.memo)
        if new:
            if len(self.memo) + len(new) > self.limit:
                self._clear()
                new = {x for ts in tokens for x in ts}.difference(self.memo)
            self._learn(new)
        sizes = np.array([len(ts) for ts in tokens])
        get = self.memo.__getitem__
        scores = np.concatenate([np.fromiter(map(get, ts), np.float64, len(ts)) for ts in tokens] + [np.zeros(0)])
        doc = np.repeat(np.arange(len(texts)), sizes)
        is_end = np.isnan(scores)
        scores[is_end] = 0
        first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
        starts, lengths = chains(is_end, first) if len(doc) else (np.zeros(0, int), np.zeros(0, int))
        f, b = forward_backward(scores, starts, lengths, self.model.transitions)
        p = np.where(is_end, 0, _sigmoid(f + b))
        out = _sigmoid(_document_figures(p, doc, len(texts)) @ self.model.calibration)
        spans: list[list] = [[] for _ in texts]
        begin = np.cumsum(sizes) - sizes
        hits = np.flatnonzero(p >= spans_from)
        for d in np.unique(doc[hits]):
            wanted = dict(zip((hits[doc[hits] == d] - begin[d]).tolist(), p[hits[doc[hits] == d]].tolist()))
            spans[d] = [{"start": m.start(), "end": m.end(), "p": wanted[i]} for i, m in enumerate(TOKENS.finditer(lower[d])) if i in wanted]
        return out, spans


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, most: tuple[int, int], max_chars: int = MAX_CHARS) -> tuple[list[str], np.ndarray]:
    """At most ``most[0]`` positive and ``most[1]`` negative training documents, chosen by a hash of ``doc_id``.

    Rows whose crc32(doc_id) mod ``divisor`` is ``held_out`` are never read. An id
    is one document, however often it stands in either table: positive if any of
    its label rows is, with the text of the smallest hash.
    """
    able = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), divisor) != held_out)).select("doc_id", F.col(label).cast("int").alias("y"))
    able = able.where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    short = docs.where(F.length("text").between(1, max_chars)).select("doc_id").distinct()
    able = able.join(short, "doc_id", "left_semi")
    by_hash = F.xxhash64("doc_id")
    chosen = able.where("y = 1").orderBy(by_hash).limit(most[0]).unionByName(able.where("y = 0").orderBy(by_hash).limit(most[1]))
    # at most most[0] + most[1] ids: a bound by parameter
    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.length("text").between(1, max_chars))
    # and one row of each, reduced before the collect
    got = got.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted((r["doc_id"], r["text"], r["y"]) for r in got.collect())
    return [r[1] for r in rows], np.array([r[2] for r in rows], bool)


def toxicity_model(docs: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2) -> Model:
    return train(*labelled_sample(docs, labels, "toxic", divisor, held_out, (MAX_TOXIC, MAX_CLEAN)))


_WORKER: dict = {}


def worker_scorer(number: int, model: Model) -> Scorer:
    """The scorer of this Python worker for the model with that broadcast number, kept between tasks."""
    if number not in _WORKER:
        _WORKER.clear()
        _WORKER[number] = Scorer(model)
    return _WORKER[number]


def score_toxicity(docs: DataFrame, model: Model, keep_rows: bool = False) -> DataFrame:
    """``score`` and ``spans`` (offsets and marginals of toxic tokens) of every document, with ``doc_id`` or its ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the training sample allows
    number = shared._jbroadcast.id()

    def make():
        from alpina.llm.toxicity import worker_scorer  # the worker's own module keeps the memo
        return worker_scorer(number, shared.value).score

    return map_texts(docs, make, f"score double, spans {SPAN}", keep_rows, GROUP_CHARS)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every document."""
    scored = score_toxicity(docs, toxicity_model(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
