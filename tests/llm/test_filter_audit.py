"""The filter audit against a row-by-row simulation of every order."""

import itertools
import random
import re
from collections import Counter

from alpina.llm.filter_audit import FILTERS, audit


def _fails(rows):
    out = []
    for doc_id, text, _, _ in rows:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        smaller = doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _, _ in rows)
        out.append({f for f, bad in zip(FILTERS, (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                                                  bool(re.search("[#$%&*|]", t)), smaller)) if bad})
    return out


def _simulated(rows, good, toxic):
    fails, out = _fails(rows), {}
    shapley = Counter()
    for order in itertools.permutations(FILTERS):
        left = list(range(len(rows)))
        for step, f in enumerate(order, 1):
            before = set(left)
            gone = [i for i in left if f in fails[i]]
            left = [i for i in left if f not in fails[i]]
            for p in {r[2] or "" for r in rows}:
                mine = [i for i in range(len(rows)) if (rows[i][2] or "") == p]
                mg = [i for i in gone if i in set(mine)]
                shapley[p, f] += len(mg)
                out[p, "".join(order), step] = [sum(i in set(mine) for i in left), len(mg), sum(f in fails[i] and i not in before for i in mine),
                                                sum(fails[i] == {f} for i in mine), sum(rows[i][0] in good for i in mg), sum(rows[i][0] in toxic for i in mg)]
    return {k: tuple(v) + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def _rows():
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        n = rnd.choice([3, 199, 200, 260])
        pool = [f"w{j}" for j in range(rnd.choice([20, 400]))]
        t = " ".join(rnd.choice(pool) for _ in range(n)) + rnd.choice(["", " AAAA" * 10, " 5%", " A # b"])
        rows.append((i, t, rnd.choice(["x", "x", "y", None, ""]), 0))
    # copies in other parts, repeated rows, null and empty texts, a null id, a long text
    rows += [(50 + i, rows[i][1], "y", 0) for i in range(8)] + [rows[4], rows[4]]
    rows += [(None, rows[0][1], "x", 0), (60, None, "x", 0), (61, "", "y", 0), (62, " \n", None, 0), (63, "long word " * 30000, "y", 0)]
    return rows


def test_every_order_equals_a_simulation(spark):
    rows = _rows()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 64, 2)] + [(1, None, 1), (1, 1, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part long")
    marks = spark.createDataFrame([(a, b, None if c is None else int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int")
    good = {a for a, b, _ in labels if b == 1 and a is not None}
    toxic = {a for a, _, c in labels if c == 1 and a is not None}
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in audit(docs, marks).collect()}
    want = _simulated(rows, good, toxic)
    assert len(got) == 3 * 600
    assert got == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs, marks).count() == 0
    one = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    rows = audit(one, marks).collect()
    assert len(rows) == 600 and {r.removed for r in rows if r.filter_order[r.step - 1] == "A"} == {1} and all(r.kept in (0, 1) for r in rows)


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "same text", "s", 0) for i in range(700)] + [(1000 + i, f"t{i} u", "s", 0) for i in range(1400)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    first = {r.filter_order: r.removed for r in audit(docs, marks).where("step = 1").collect()}
    assert first["EABCD"] == 699 and first["ABCDE"] == 2100
