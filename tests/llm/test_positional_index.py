"""Decontamination against a direct search for word windows."""

import hashlib
import re

import pytest

from alpina.llm import positional_index as P

# extra columns carry the operator's own column names
DOCS = "doc_id long, text string, key string, term string, n_words int"
ITEMS = "item_id long, text string, phrase string"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def plain(docs, items, window):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(0, len(w) - window) + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for p, ids in wins.items():
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s:s + len(p)]) == p:
                    hit.update(range(s, s + len(p)))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


CASES = [(1, "the quick brown fox jumps over"), (2, "THE quick, brown fox! the quick brown fox jumps"), (3, None), (4, ""), (5, "a a a a a a"),
         (6, "one"), (7, "x one y é É"), (7, "x one y é É"), (None, "brown fox jumps over the lazy dog"), (8, "w " * 3000 + "quick brown fox jumps"), (9, "quick brown lazy fox jumps")]
BENCH = [(10, "Quick brown fox jumps over it"), (2, "a a a"), (3, None), (4, "one"), (5, "é"), (2, "over the lazy dog"), (6, "..."), (11, "quick brown fox")]


@pytest.mark.parametrize("window", [3, 10])
@pytest.mark.parametrize("most", [P.MAX_BROADCAST, -1])
def test_equals_search(spark, monkeypatch, window, most):
    monkeypatch.setattr(P, "MAX_BROADCAST", most)  # -1: every join shuffles on (term, salt)
    docs = spark.createDataFrame([(*r, "k", "t", 1) for r in CASES], DOCS)
    items = spark.createDataFrame([(*r, "p") for r in BENCH], ITEMS)
    got = P.contamination(docs, items, window).drop("key").collect()
    assert sorted(map(tuple, got), key=repr) == plain(CASES, BENCH, window)


def test_clean_documents_and_empty_tables(spark):
    docs = spark.createDataFrame([(*r, "k", "t", 1) for r in CASES], DOCS)
    items = spark.createDataFrame([(*r, "p") for r in BENCH], ITEMS)
    kept = P.clean_documents(docs, items, 3)
    assert kept.columns == docs.columns
    bad = {(d, t) for (d, t), r in zip(CASES, [r for c in CASES for r in plain([c], BENCH, 3)]) if r[5]}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((c for c in CASES if c not in bad), key=repr)
    none = P.contamination(docs, items.limit(0), 3).collect()
    assert len(none) == len(CASES) and not any(r.contaminated for r in none)
    assert P.contamination(docs.limit(0), items, 3).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(*r, "k", "t", 1) for r in CASES], DOCS)
    table = P.phrases(spark.createDataFrame([(1, "quick brown fox jumps", "p")], ITEMS))
    index = P.build_index(docs, table.selectExpr("explode(terms) AS term"))
    near = {r.key.doc_id for r in P.proximity_matches(index, table, slack=1).collect()}
    exact = {r.key.doc_id for r in P.exact_matches(index, table).collect()}
    assert exact == {1, 2, 8} and near == {1, 2, 8, 9}


def test_items_with_null_id_hit(spark):
    docs = spark.createDataFrame([(1, "x quick brown fox y"), (2, "x lazy old dog y quick brown fox"), (3, "lazy old dog"), (4, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "quick brown fox"), (7, "lazy old dog"), (None, "lazy old dog")], "item_id long, text string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = sorted(map(tuple, P.contamination(docs, items, 3).drop("key").collect()))
    assert got == [(1, 5, 3, 1, sha(""), True), (2, 8, 6, 2, sha("7"), True), (3, 3, 3, 2, sha("7"), True), (4, 3, 0, 0, sha(""), False)]
    assert [r.doc_id for r in P.clean_documents(docs, items, 3).collect()] == [4]
