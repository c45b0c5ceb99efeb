"""WARC archives and their index: exact round trip and lookups."""

import base64
import hashlib

from alpina.llm import warc_index as W
from alpina.llm.common import shared_path

# extra columns carry the operator's own column names
SCHEMA = "page_id long, url string, html string, payload int, sha string, n int"
ROWS = [(1, "http://a.com/x", "A"), (2, "http://a.com/x", "A"), (2, "http://a.com/x", "A"), (None, None, None), (5, "http://www.b.com/", ""),
        (7, "https://a.com:8080/y?q=1", "Bé"), (None, "http://a.com/x", "A"), (8, "not a url\t", "<p>" + "long " * 50_000), (9, "http://[bad", "C")]


def plain(rows):
    top = {}
    for p, _, h in rows:
        top.setdefault(h or "", []).append(p)
    out = []
    for h, ids in top.items():
        best = max((p for p in ids if p is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        left = True
        for p in sorted(ids, key=lambda x: (x != best, x is None)):
            out.append((p, len(h.encode()), digest, "response" if left and p == best else "revisit", None if left and p == best else best))
            left = left and p != best
    return sorted(out, key=repr)


def test_round_trip_and_lookup(spark):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in ROWS], SCHEMA)
    archives, index = shared_path(spark, "warc"), shared_path(spark, "index")
    ranges = W.write_index(W.write_archives(W.typed_records(df), archives), index, block_lines=2)
    got = W.read_archives(W.read_captures(ranges, index), archives).drop("url").collect()
    assert sorted(map(tuple, got), key=repr) == plain(ROWS)

    everything = W.find_captures(ranges, index, df.select("url"))
    assert sorted(map(tuple, everything.collect())) == sorted(map(tuple, W.read_captures(ranges, index).collect()))
    some = W.read_archives(W.find_captures(ranges, index, spark.createDataFrame([("http://b.com/",), ("http://zzz.com/",), (None,)], "url string")), archives)
    assert sorted((r.page_id or 0) for r in some.collect()) == [0, 5]
    assert sorted(map(tuple, W.archive_round_trip(df).drop("url").collect()), key=repr) == plain(ROWS)

    urls = spark.createDataFrame([("http://a.com/x",), ("http://b.com/",), ("http://zzz.com/",), ("not a url\t",)], "url string")
    found = W.lookup(spark, ranges, index, archives, urls).collect()
    assert sorted((r.url, r.page_id or 0, r.record_type) for r in found) == sorted(
        [("http://a.com/x", 2, "response"), ("http://a.com/x", 2, "revisit"), ("http://a.com/x", 1, "revisit"), ("http://a.com/x", 0, "revisit"),
         ("http://b.com/", 5, "response"), ("not a url\t", 8, "response")])
    assert [r.payload_bytes for r in found if r.page_id == 8] == [250_003]


def test_small_payloads_may_be_kept(spark):
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in ROWS], SCHEMA)
    kinds = W.typed_records(df, min_bytes=2).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in kinds} == {"response": 9}


def test_empty(spark):
    assert W.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keys_reverse_the_host():
    assert W.surt("http://www.Example.com/B?x=1") == "com,example)/B?x=1"
    assert W.surt("https://m.a.org:8443") == "org,a,m:8443)/" and W.surt(None) == ""
