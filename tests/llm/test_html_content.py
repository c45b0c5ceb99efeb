"""The tree model against enumeration, and page texts against a plain reading."""

import html
import itertools
import re

import numpy as np
import pytest
from conftest import SF_SMALL

from alpina.llm import html_content as H
from alpina.llm.common import read_table

# extra columns carry the operator's own column names
SCHEMA = "page_id long, url string, html string, text int, n_chars string"


def test_marginals_equal_enumeration():
    t = H.Tree([-1, 0, 1, 1, 0, 4], ["x"] * 6, [""] * 6, [])
    f = H.forest([t])
    rng = np.random.default_rng(5)
    scores, pair = rng.normal(0, 1.5, 6), rng.normal(0, 1, (2, 2))
    inward, outward, _ = H.messages(scores, f, pair)
    weight = {y: np.exp(sum(scores[i] * y[i] for i in range(6)) + sum(pair[y[t.parents[i]], y[i]] for i in range(1, 6))) for y in itertools.product((0, 1), repeat=6)}
    for i in range(6):
        p = sum(w for y, w in weight.items() if y[i]) / sum(weight.values())
        assert abs(p - 1 / (1 + np.exp(-inward[i] - outward[i]))) < 1e-9


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " ")))
    return "\n".join(x for x in blocks if x)


def test_pages_equal_plain_reading(spark):
    pages = read_table(spark, SF_SMALL, "pages")
    texts = {r.page_id: r for r in H.main_text(pages).collect()}
    for r in pages.collect():
        assert texts[r.page_id].text == article(r.html) and texts[r.page_id].n_chars == len(article(r.html)) and texts[r.page_id].url == r.url


@pytest.mark.parametrize("page,blocks", [
    ("a<p>b<br>c<b>d</b></p>e<script>x<y</script>f", ["a", "b cd", "ef"]), ("<ul><li>1<li>2</ul>3", ["1", "2", "3"]),
    ("<p>A &amp B &am; &eacute;</p><!-- no -- >--><p>x < y</p>", ["A & B &am; é", "x < y"]), ("<b>x<p>y</b>z</p>", ["x", "yz"]), ("<td>1<td>2", ["1", "2"]), ("<a href='>'>q</a", ["q"])])
def test_blocks(page, blocks):
    t = H.parse(page)
    assert H.block_text(t, np.ones(len(t.tags), bool)) == "\n".join(blocks)


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>broken <b"), (3, "u", "<div>" * 20_000 + "deep"), (3, "u", "plain"), (4, "u", "<" * 5000)]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA)
    got = H.main_text(df).collect()
    assert len(got) == 6 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert H.main_text(df.limit(0)).count() == 0


def test_repeated_pages_fill_no_sample(spark):
    schema = "page_id long, url string, html string"
    once = [(i, f"http://h/{i}", f"<p>page {i}</p>") for i in range(30)] + [(None, None, "<p>no id</p>"), (40, "u", None), (41, "u", "")]
    plain = H.training_pages(spark.createDataFrame(once, schema), most=12)
    assert len(plain) == 12
    for row in once[:31]:
        many = spark.createDataFrame(once + [row] * 50, schema).repartition(5) if row[0] in (None, 0, 7) else None
        if many is not None:
            assert H.training_pages(many, most=12) == plain
    assert H.training_pages(spark.createDataFrame([], schema)) == []
