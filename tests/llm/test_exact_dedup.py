"""Exact dedup against a dictionary, and the filter it screens with."""

import hashlib
import re

import numpy as np
import pytest

from alpina.llm import binary_fuse, exact_dedup

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, key string, rid int, batch int"


def plain(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = []
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        sha, left = hashlib.sha256(t.encode()).hexdigest(), True
        for d in sorted(ids, key=lambda x: (x is None, x or 0)):
            out.append((d, keep, len(ids), d == keep and left, sha))
            left = left and d != keep
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_equals_dictionary(spark, batches):
    rows = [(i, f"text {i % 7}\t x") for i in range(60)] + [(100, None), (101, ""), (102, " "), (103, "\n"), (None, "text 1 x"), (None, "alone"),
                                                        (104, "y" * 100_000), (105, "y" * 100_000), (106, "é x"), (107, "é x"), (7, "text 0 x"), (7, "text 0 x")]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    got = exact_dedup.exact_duplicates(df, batches=batches, bucket_keys=10).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_empty(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 30_000])
def test_filter_has_no_false_negative(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2 ** 63, n).astype(np.uint64)
    f = binary_fuse.build(keys)
    assert binary_fuse.probe(keys, *f).all()
    assert binary_fuse.probe(rng.integers(0, 2 ** 63, 100_000).astype(np.uint64), *f).mean() < 2e-4
