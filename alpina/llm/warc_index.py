"""WARC archives with a two-level capture index.

Writing: each task streams its rows to one ``.warc.gz`` in the shared folder, a
gzip member per record, and returns a capture row per record (URL key, file,
offset, length). File names hold a random part, so a retried task writes a file
of its own; only files named in the committed capture table count.

Equal payloads: the row with the largest ``page_id`` is the response, the
others are revisits without a payload. Digests that occur once need no shuffle
of their pages; for repeated ones only narrow rows move, pre-aggregated, and
the payload itself travels once per digest and task.

Index: captures are range-partitioned by (reversed-host URL key, time, file,
offset). A task writes its range as gzip blocks of ``BLOCK_LINES`` lines, then
the sparse directory (first key, offset and length of each block), then a
footer with the directory's place. The table of ranges is the upper level: it
has a row per index file. Reading back, the pages' distinct keys are sorted,
resolved through ranges and directories by binary search, and the blocks and
then the records are read by byte range, each block once, in tasks of a stated
number of blocks or bytes. Texts and URLs of any length are written whole;
``page_id`` is a long; only the named columns are read, so others cannot clash.

Defined results: a null html is the empty payload and is deduplicated like any
other; a null ``page_id`` is the smallest and is written as ``-``; a null URL
has the empty key; of repeated rows with one ``page_id`` and payload one is the
response; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_fs, shared_path, store

BLOCK_LINES = 3000
#: index blocks, and bytes of the archives, that one task reads back
BLOCKS_PER_TASK, BYTES_PER_TASK = 8, 16 << 20
FOOTER = "<QQ4s"
MAGIC = b"CIX1"
#: fixed value: the capture time of every record (the tables have none)
WHEN = "2020-01-01T00:00:00Z"
CAPTURE = ("page_id long, url string, surt string, record_type string, refers_to long, "
           "file string, offset long, length long")


def surt(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.com:80/B?x`` gives ``com,a)/B?x`` (host in lower case, no ``www.``)."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    key = ",".join(reversed(host.split("."))) if host else ""
    key += f":{port}" if port and port not in (80, 443) else ""
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _header(value) -> str:
    return " ".join(str(value).split()) if value is not None else "-"


def record(kind: str, page_id, url, digest: str, n_bytes: int, payload: bytes, refers_to) -> bytes:
    """One WARC record; a revisit carries the HTTP header (with the payload's length) alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {WHEN}",
             f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {_header(page_id)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {_header(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, payload and its digest; a response's digest is computed from the bytes read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    number = lambda k: None if warc.get(k, "-") == "-" else int(warc[k])
    revisit = warc["WARC-Type"] == "revisit"
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit:
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != length:
            raise ValueError(f"record of page {warc['X-Page-Id']}: payload does not match its digest or length")
    return {"page_id": number("X-Page-Id"), "payload_bytes": length, "payload_digest": digest,
            "record_type": warc["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "payload": payload, "url": warc["WARC-Target-URI"]}


def typed_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, sha, n_bytes, payload, record_type, refers_to`` of every page; see the module text.

    Payloads below ``min_bytes`` are all responses.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    wide = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    same = ["sha", "n_bytes"]
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url")
    repeated = store(wide.where(F.col("n_bytes") >= min_bytes).groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("top")).where("n > 1").drop("n"), "warc-repeated")
    once = wide.join(repeated.select(*same), same, "left_anti").withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long"))
    twice = wide.join(repeated.select(*same), same, "left_semi")
    rows = twice.groupBy("page_id", "url", *same).agg(F.count(F.lit(1)).alias("copies")).join(repeated, same)
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    rows = rows.select("page_id", "url", *same, "top", is_top.alias("is_top"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("no"))
    first = F.col("is_top") & (F.col("no") == 1)
    bodies = twice.groupBy(*same).agg(F.first("payload").alias("payload"))
    responses = rows.where(first).join(bodies, same).withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long"))
    revisits = rows.where(~first).withColumn("payload", F.lit(b"")).withColumn("record_type", F.lit("revisit")).withColumn("refers_to", F.col("top.page_id"))
    columns = ["page_id", "url", "sha", "n_bytes", "payload", "record_type", "refers_to"]
    return once.select(*columns).unionByName(responses.select(*columns)).unionByName(revisits.select(*columns))


def _int(value):
    return None if pd.isna(value) else int(value)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write typed records to WARC files below ``folder``; returns the stored capture rows."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, fs, name, offset = None, None, "", 0
        try:
            for pdf in batches:
                if out is None and len(pdf):
                    fs, path = open_fs(folder)
                    fs.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                made = []
                for r in pdf.itertuples(index=False):
                    page_id, refers_to, url = _int(r.page_id), _int(r.refers_to), None if pd.isna(r.url) else r.url
                    digest = base64.b32encode(bytes.fromhex(r.sha)).decode()
                    data = gzip.compress(record(r.record_type, page_id, url, digest, int(r.n_bytes), r.payload, refers_to), 6, mtime=0)
                    out.write(data)
                    made.append((page_id, url, surt(url), r.record_type, refers_to, name, offset, len(data)))
                    offset += len(data)
                frame = pd.DataFrame(made, columns=[c.split()[0] for c in CAPTURE.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "offset": "int64", "length": "int64"})
        finally:
            if out is not None:
                out.close()

    return store(records.mapInPandas(write, CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the two-level index below ``folder``; returns the stored table of ranges, one row per index file."""
    order = ["surt", "file", "offset"]
    lines = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_fs(folder)
        out, name, held, directory, at, last = None, "", [], [], 0, ""

        def flush():
            nonlocal at
            data = gzip.compress("".join(held).encode(), 6, mtime=0)
            out.write(data)
            directory.append([held[0].split("\t", 1)[0], at, len(data)])
            at += len(data)
            held.clear()

        for pdf in batches:
            if out is None and len(pdf):
                fs.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.cix"
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            for r in pdf[["surt", "page_id", "url", "record_type", "refers_to", "file", "offset", "length"]].itertuples(index=False):
                held.append("\t".join([_key(r.surt), json.dumps([_int(r.page_id), r.url, r.record_type, _int(r.refers_to), r.file, int(r.offset), int(r.length)])]) + "\n")
                if len(held) >= block_lines:
                    flush()
            last = _key(pdf["surt"].iloc[-1]) if len(pdf) else last
        if out is None:
            return
        if held:
            flush()
        data = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
        out.write(data)
        out.write(struct.pack(FOOTER, at, len(data), MAGIC))
        out.close()
        yield pd.DataFrame({"file": [name], "first": [directory[0][0]], "last": [last], "blocks": [len(directory)]})

    return store(lines.mapInPandas(write, "file string, first string, last string, blocks long"), "index-ranges")


def _key(text: str) -> str:
    """A key as it stands in the index: white space cannot end a line or field."""
    return text.replace("%", "%25").replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


def read_directory(folder: str, name: str) -> list:
    """The sparse directory of an index file: ``[first key, offset, length]`` of each block."""
    fs, path = open_fs(folder)
    with fs.open_input_file(f"{path}/{name}") as f:
        size = f.size()
        at, length, magic = struct.unpack(FOOTER, f.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"{name} is no capture index")
        return json.loads(gzip.decompress(f.read_at(length, at)))


def _block(f, at: int, length: int) -> list[tuple[str, list]]:
    rows = (x.split("\t", 1) for x in gzip.decompress(f.read_at(length, at)).decode().split("\n")[:-1])
    return [(k, json.loads(v)) for k, v in rows]


def lookup(spark: SparkSession, ranges: DataFrame, index_folder: str, archive_folder: str, urls: DataFrame) -> DataFrame:
    """All captures of the given ``url`` rows, read by two binary searches and range reads.

    The upper level (a row per index file) goes to the tasks; directories and
    blocks are read only where a key can be.
    """
    top = sorted((r["first"], r["last"], r["file"]) for r in ranges.collect())
    firsts = [x[0] for x in top]

    def find(batches):
        fs, path = open_fs(index_folder)
        arch, arch_path = open_fs(archive_folder)
        for pdf in batches:
            found = []
            for url in pdf["url"]:
                key = _key(surt(url))
                # the range before the first one that starts at the key may end with it
                i = max(0, bisect.bisect_left(firsts, key) - 1)
                for first, last, name in top[i:]:
                    if first > key:
                        break
                    if last < key:
                        continue
                    directory = read_directory(index_folder, name)
                    with fs.open_input_file(f"{path}/{name}") as f:
                        for b in range(max(0, bisect.bisect_left([d[0] for d in directory], key) - 1), len(directory)):
                            if directory[b][0] > key:
                                break
                            for k, (page_id, found_url, kind, refers_to, file, offset, length) in _block(f, *directory[b][1:]):
                                if k == key:
                                    with arch.open_input_file(f"{arch_path}/{file}") as a:
                                        got = parse_record(zlib.decompress(a.read_at(length, offset), 31))
                                    found.append((url, page_id, kind, refers_to, got["payload_bytes"], got["payload"]))
            frame = pd.DataFrame(found, columns=["url", "page_id", "record_type", "refers_to", "payload_bytes", "payload"])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    return urls.select("url").mapInPandas(find, "url string, page_id long, record_type string, refers_to long, payload_bytes long, payload binary")


def search_blocks(ranges: DataFrame, index_folder: str, urls: DataFrame) -> DataFrame:
    """``index, at, bytes, key``: the index blocks in which the captures of the given ``url`` rows can stand.

    Distinct keys are sorted into ranges; a task walks its keys through the
    upper level and the directories by binary search, each directory read once.
    No block is read here, so a key with very many captures only names blocks.
    """
    top = sorted((r["first"], r["last"], r["file"]) for r in ranges.collect())  # a row per index file
    firsts = [x[0] for x in top]

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": sorted({_key(surt(None if pd.isna(u) else u)) for u in pdf["url"]})}, dtype=object)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name_read, directory, starts = None, [], []
        for pdf in batches:
            found = []
            for key in pdf["key"]:
                # the range before the first one that starts at the key may end with it
                for first, last, name in top[max(0, bisect.bisect_left(firsts, key) - 1):]:
                    if first > key:
                        break
                    if last < key:
                        continue
                    if name != name_read:
                        name_read, directory = name, read_directory(index_folder, name)
                        starts = [d[0] for d in directory]
                    for block in directory[max(0, bisect.bisect_left(starts, key) - 1):bisect.bisect_right(starts, key)]:
                        found.append((name, block[1], block[2], key))
            yield pd.DataFrame(found, columns=["index", "at", "bytes", "key"]).astype({"at": "int64", "bytes": "int64"})

    wanted = urls.select("url").distinct().mapInPandas(keys, "key string").distinct()
    return wanted.repartitionByRange("key").sortWithinPartitions("key").mapInPandas(find, "index string, at long, bytes long, key string")


def find_captures(ranges: DataFrame, index_folder: str, urls: DataFrame) -> DataFrame:
    """``file, offset, length`` of all captures of the given ``url`` rows; each block is read once."""
    wanted = store(search_blocks(ranges, index_folder, urls), "index-search")
    total = ranges.agg(F.sum("blocks")).first()[0] or 0
    # a stated number of tasks: the rows are small, what they stand for is not
    dealt = wanted.repartition(max(1, -(-total // BLOCKS_PER_TASK)), "index", "at").sortWithinPartitions("index", "at", "key")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = open_fs(index_folder)
        at, held = None, {}
        for pdf in batches:
            got = []
            for r in pdf.itertuples(index=False):
                if (r.index, r.at) != at:
                    at, held = (r.index, r.at), {}
                    with fs.open_input_file(f"{path}/{r.index}") as f:
                        for key, v in _block(f, int(r.at), int(r.bytes)):
                            held.setdefault(key, []).append(v[4:])
                got += held.get(r.key, [])
            yield pd.DataFrame(got, columns=["file", "offset", "length"]).astype({"offset": "int64", "length": "int64"})

    return dealt.mapInPandas(blocks, "file string, offset long, length long")


def read_captures(ranges: DataFrame, index_folder: str) -> DataFrame:
    """Every capture in the index, read block by block through the directories."""

    def directories(batches):
        for pdf in batches:
            for name in pdf["file"]:
                d = read_directory(index_folder, name)
                yield pd.DataFrame({"index": name, "at": [x[1] for x in d], "bytes": [x[2] for x in d]})

    def blocks(batches):
        fs, path = open_fs(index_folder)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                with fs.open_input_file(f"{path}/{r.index}") as f:
                    got = [v[4:] for _, v in _block(f, int(r.at), int(r.bytes))]
                yield pd.DataFrame(got, columns=["file", "offset", "length"])

    total = ranges.agg(F.sum("blocks")).first()[0] or 0
    parts = ranges.select("file").mapInPandas(directories, "index string, at long, bytes long").repartition(max(1, -(-total // BLOCKS_PER_TASK)), "index", "at")
    return parts.mapInPandas(blocks, "file string, offset long, length long")


def read_archives(captures: DataFrame, archive_folder: str) -> DataFrame:
    """The records at the given captures: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``.

    Captures are dealt by file and 8 MB of it, so a task reads forward; a file is
    never held whole. A task gets about ``BYTES_PER_TASK`` of the archives.
    """
    captures = store(captures, "captures-found")
    total = captures.agg(F.sum("length")).first()[0] or 0
    dealt = captures.withColumn("piece", F.floor(F.col("offset") / F.lit(8 << 20)))
    dealt = dealt.repartition(max(1, -(-total // BYTES_PER_TASK)), "file", "piece").sortWithinPartitions("file", "offset")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def read(batches):
        fs, path = open_fs(archive_folder)
        name, f = None, None
        for pdf in batches:
            made = []
            for r in pdf.itertuples(index=False):
                if r.file != name:
                    if f is not None:
                        f.close()
                    name, f = r.file, fs.open_input_file(f"{path}/{r.file}")
                got = parse_record(zlib.decompress(f.read_at(int(r.length), int(r.offset)), 31))
                made.append([got[c] for c in columns])
            yield pd.DataFrame(made, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    return dealt.mapInPandas(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write archives and index of ``pages``, then find every page's URL in the index and read the records back."""
    spark = pages.sparkSession
    archives, index = shared_path(spark, "warc"), shared_path(spark, "warc-index")
    ranges = write_index(write_archives(typed_records(pages), archives), index)
    return read_archives(find_captures(ranges, index, pages.select("url")), archives)
