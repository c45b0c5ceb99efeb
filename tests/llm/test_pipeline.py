"""Each stage of the pipeline against a brute-force version, on its own input."""

import re
import zlib

import numpy as np
from conftest import SF_SMALL

import corpus_pipeline as C
from alpina.llm import token_output, toxicity
from alpina.llm.common import read_table, store


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    assert [n for n, _ in C.STAGES] == ["toxicity", "near-duplicates", "decontamination", "mixing", "token-output"]
    before = {r.doc_id: r for r in docs.collect()}
    kept, frames = docs, []
    for name, stage in C.STAGES:
        kept = store(stage(spark, kept, SF_SMALL), f"test-{name}")
        frames.append(kept)
        if name != "token-output":
            assert kept.columns == docs.columns
    clean, unique, pure, mixed, tokens = (f.collect() for f in frames)

    model = toxicity.toxicity_model(docs, read_table(spark, SF_SMALL, "labels"))
    score, _ = toxicity.Scorer(model).score([r.text for r in before.values()])
    assert {r.doc_id for r in clean} == {d for d, s in zip(before, score) if s < C.TOXIC_FROM}

    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t))
    sets = {r.doc_id: {tuple(words(r.text)[i:i + 5]) for i in range(max(1, len(words(r.text)) - 4))} for r in clean}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in unique} == {find(d) for d in ids}

    windows = set()
    for r in read_table(spark, SF_SMALL, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[s:s + 10]) for s in range(max(0, len(w) - 10) + 1)}
    hit = lambda t: any(tuple(words(t)[s:s + n]) in windows for n in {len(x) for x in windows} for s in range(len(words(t)) - n + 1))
    assert {r.doc_id for r in pure} == {r.doc_id for r in unique if not hit(r.text)}

    assert {r.doc_id for r in mixed} <= {r.doc_id for r in pure}
    times = {d: sum(r.doc_id == d for r in mixed) for d in {r.doc_id for r in mixed}}
    assert max(times.values()) <= 2

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(token_output.vocabulary_path())
    wanted, total = [], 0
    for r in sorted(mixed, key=lambda r: r.doc_id):
        t = np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        wanted.append((r.doc_id, total, len(t), zlib.crc32(t.tobytes())))
        total += len(t)
    assert sorted(map(tuple, tokens)) == wanted
