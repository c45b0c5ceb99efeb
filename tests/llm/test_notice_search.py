"""Notice search against a sliding edit distance over whole words, and planted notices."""

import random
import re

from alpina.llm.notice_search import NOTICES, PHRASES, Notice, NoticeMatcher, license_notices, license_query, pieces, plain_words, phrase_places

NOISE = "the tool was made public for all who work under a license of their own and it is kept in version two of the store".split()


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _brute_labels(plain: str, notices) -> set:
    """Labels of the notices within their errors of any run of whole words."""
    w, out = plain.split(), set()
    for n in notices:
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                s = " ".join(w[i:j])
                if len(s) > len(n.words) + n.errors:
                    break
                if len(s) >= len(n.words) - n.errors and _edits(s, n.words) <= n.errors:
                    out.add(n.label)
    return out


def _damaged(words: str, edits: int, rnd: random.Random) -> str:
    s = list(words)
    for _ in range(edits):
        at = rnd.randrange(len(s))
        s[at:at + 1] = rnd.choice([[], [rnd.choice("abcdefghij ")], [s[at], rnd.choice("xyz")]])
    return "".join(s)


def test_pieces_cover_a_notice():
    for n in NOTICES:
        assert "".join(p for _, p in pieces(n.words, n.errors)) == n.words and len(pieces(n.words, n.errors)) == n.errors + 1
        assert all(n.words[o:o + len(p)] == p and p for o, p in pieces(n.words, n.errors))


def test_matches_equal_brute_force():
    rnd = random.Random(8)
    matcher = NoticeMatcher(NOTICES)
    seen = set()
    for _ in range(150):
        n = rnd.choice(NOTICES)
        body = [rnd.choice(NOISE) for _ in range(12)]
        body[6:6] = [_damaged(n.words, rnd.randrange(n.errors + 3), rnd)]
        plain, _ = plain_words(" ".join(body))
        got = {m[0] for m in matcher.matches(plain)}
        assert got == _brute_labels(plain, NOTICES), plain
        for label, a, b, edits, _ in matcher.matches(plain):
            assert any(x.label == label and _edits(plain[a:b], x.words) == edits for x in NOTICES)
        seen |= got
    assert len(seen) > 6


def test_phrases_by_words():
    plain, n = plain_words("MIT-License, summit license; the GNU\nGeneral  Public LICENSE mit license")
    assert n == 11
    assert [(plain.count(" ", 0, a), p) for a, p in phrase_places(plain, PHRASES)] == [(0, "mit license"), (6, "general public license"), (9, "mit license")]
    text = "Été MIT LICENSE é"
    assert plain_words(text)[0].split() == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def test_edge_rows(spark):
    long = "word " * 200_000 + "Relased  under the\nMIT Licence. " + "x" * 100_000
    rows = [(1, None, "a"), (2, "", "b"), (3, "  \n ", "c"), (4, long, "d"), (4, long, "d"), (None, "All rights\n * reserved!", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string").withColumnsRenamed({"labels": "n_words"})
    got = [r.asDict(True) for r in license_notices(docs).collect()]
    for r in got:
        if r["doc_id"] in (1, 2, 3):
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"], r["spans"]) == (0, 0, None, None, "", "", 0.0, [])
    fours = [r for r in got if r["doc_id"] == 4]
    assert len(fours) == 2 and fours[0] == fours[1] and fours[0]["labels"] == "mit" and fours[0]["base_labels"] == ""
    s = fours[0]["spans"][0]
    assert long[s["start"]:s["end"]] == "under the\nMIT Licence" and s["edits"] == 1 and 0.9 < fours[0]["score"] < 1
    none = [r for r in got if r["doc_id"] is None][0]
    assert none["labels"] == "all-rights-reserved" and none["spans"][0]["n_words"] == 3
    assert license_query(docs.limit(0)).count() == 0


def test_of_overlapping_matches_the_best_stays():
    m = NoticeMatcher((Notice("mozilla public license", "mpl", 2),))
    assert [x[1:4] for x in m.matches("a mozilla public license b mozila public licence")] == [(2, 24, 0), (27, 48, 2)]


def test_base_columns_equal_sql(spark):
    import duckdb
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_query(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    want = duckdb.sql(r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM '/root/testdata/sf0.01/documents.parquet'),
        s AS (SELECT doc_id, unnest(range(0, len(w))) AS i, w FROM d),
        h AS (SELECT doc_id, i, CASE WHEN w[i + 1] = 'mit' AND w[i + 2] = 'license' THEN 'mit' WHEN w[i + 1] = 'apache' AND w[i + 2] = 'license' THEN 'apache'
                   WHEN w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license' THEN 'gpl' END AS label FROM s),
        g AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM h WHERE label IS NOT NULL GROUP BY doc_id)
        SELECT d.doc_id, len(w), coalesce(n, 0), a, b, coalesce(l, '') FROM d LEFT JOIN g USING (doc_id)""").fetchall()
    assert got == set(want) and any(r[2] for r in want)
