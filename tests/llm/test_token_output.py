"""Token files against the tokenizers library itself, and the integer code."""

import zlib

import numpy as np
import pytest

from alpina.llm import stream_vbyte
from alpina.llm import token_output as T

# extra columns carry the operator's own column names
SCHEMA = "doc_id long, text string, range int, row int, ids string"
ODD = ["", None, "a <|endoftext|>b", "İstanbul ΣΑΣ ΣΑΣ. ﬁ", "x y\x1fz\x0bq", "été.,", "don't I'LL 's 12.5 ½²", "ß ẞ ÀÉ naïve", "　全角　テスト",
       "a" * 5000 + " " + "b.,.,", " , . ,. ", "ŉ ǰ ɐ", "é e", "word " * 3000]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_code_round_trip(n):
    rng = np.random.default_rng(n)
    v = (rng.integers(0, 2 ** 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    control, data = stream_vbyte.encode(v)
    assert len(control) == -(-n // 4) and (stream_vbyte.decode(control, data, n) == v).all()


def test_equals_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(T.vocabulary_path())
    rows = [(None if i == 4 else 50 - i, t) for i, t in enumerate(ODD)] + [(60, "zz"), (60, "zz"), (60, "aa")]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    got = T.token_round_trip(df).collect()
    wanted = []
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        wanted.append((d, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(wanted, key=repr)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [None] + sorted(d for d, _ in rows if d is not None)
    total = 0
    for r in in_order:
        assert r.start == total
        total += r.n_tokens


def test_empty(spark):
    assert T.token_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_memo_may_overflow():
    t = T.PieceTokenizer(T.vocabulary_path(), memo=3)
    texts = ["one two three four five", "six one. Two", "", "été one"]
    assert t.encode(texts) == [np.array(t.library.encode(x, add_special_tokens=False).ids, t.kind).tobytes() for x in texts]


def test_punctuation_behind_letters_and_a_repeated_document(spark):
    t = T.PieceTokenizer(T.vocabulary_path())
    texts = ["word$$$ Wörd!! a&&&b (c) d* e's it's. x|> <|x y_z_ foo.\u00bb q-- 5%% é%%", "été!? ÉTÉ... l'été; --- <|endoftext|>! a<b"]
    assert [np.frombuffer(x, t.kind).tolist() for x in t.encode(texts)] == [t.library.encode(x, add_special_tokens=False).ids for x in texts]
    df = spark.createDataFrame([(7, "same words here")] * 300 + [(i, "x") for i in range(20)], "doc_id long, text string")
    got = T.token_round_trip(df).collect()
    assert len(got) == 320 and len({r.start for r in got}) == 320 and len({r.ids_crc32 for r in got}) == 2
    manifest, _, _ = T.token_files(df.repartition(6))
    assert T.read_documents(manifest, np.arange(9), "unused").rdd.getNumPartitions() == manifest.count() >= 1


def test_words_are_learned_once_whatever_their_capitals_and_punctuation():
    t = T.PieceTokenizer(T.vocabulary_path())
    learned, learn = [], t._learned
    t._learned = lambda piece: learned.append(piece) or learn(piece)
    texts = ["Wort wort, WORT. (Wort)", "Été été! ÉTÉ, wort.", "été,\nWORT!"]
    assert [np.frombuffer(x, t.kind).tolist() for x in t.encode(texts)] == [t.library.encode(x, add_special_tokens=False).ids for x in texts]
    # "(Wort)" is no run of letters with punctuation behind it: it goes through the whole tokenizer
    assert sorted(x for x in learned if x.strip(T.TAILS)) == ["(Wort)", "wort", "été"] and len(learned) == len(set(learned))


def test_every_letter_and_mark_as_the_library_has_it():
    t = T.PieceTokenizer(T.vocabulary_path())
    texts = [f"a{c}b {c}x, {c} y{c}, {c}{c}. Z{c}! ,{c}. 1{c} e{c}'s" for c in map(chr, range(0x2100))]
    assert [np.frombuffer(x, t.kind).tolist() for x in t.encode(texts)] == [x.ids for x in t.library.encode_batch(texts, add_special_tokens=False)]


def test_groups_of_texts_and_slices(spark, monkeypatch):
    import pyarrow as pa
    t = T.PieceTokenizer(T.vocabulary_path())
    texts = ["Ab cd.", "", "x" * 30 + " y", " ", "é! Ab"]
    whole = t.encode(texts)
    assert t.encode([]) == [] and t.encode(pa.array(texts).slice(2, 2)) == whole[2:4] and t.encode(pa.array(texts, pa.large_string())) == whole
    monkeypatch.setattr(T, "GROUP", 8)  # the function sent to the tasks carries it
    rows = T.tokenised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), T.vocabulary_path(), 2).collect()
    end = (2).to_bytes(int(t.kind[-1]), "little")
    assert {r.doc_id: bytes(r.ids) for r in rows} == {i: x + end for i, x in enumerate(whole)}
