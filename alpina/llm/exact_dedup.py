"""Exact duplicates against immutable snapshots, screened by static binary-fuse filters.

A snapshot is the set of distinct texts of the documents that have come so
far: a table of digests with the smallest member, and one filter per bucket of
digests. It is never changed. A new batch first groups its own digests
(partial aggregation, so a group of copies that fills a third of the batch
shuffles a row per task), then probes the filters bucket by bucket. Only
positives are joined to the exact bucket, where the byte check compares the
256-bit digest and the byte length of the normalised text; the texts are not
moved. Negatives are certainly new.

Defined results: null counts as the empty text, and empty texts are equal; a
null ``doc_id`` is the largest; of repeated rows with one ``doc_id`` one stays;
an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import binary_fuse
from .common import SPACES, store, text_or_empty

#: digests of one bucket, and so of one filter (about 120 KB)
BUCKET_KEYS = 50_000


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, rid, sha, n_bytes, key`` of every row; ``rid`` numbers the rows."""
    text = F.regexp_replace(text_or_empty("text"), SPACES, " ")
    d = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
                    F.octet_length(text).cast("long").alias("n_bytes"))
    return d.withColumn("key", F.xxhash64("sha"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct text: its first member (null last, then row number) and the number of members."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    return rows.groupBy("key", "sha", "n_bytes").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("members"))


@dataclass(frozen=True)
class Snapshot:
    """An immutable snapshot: exact rows (with their bucket) and one filter row per bucket."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def _bucket(buckets: int):
    return F.pmod(F.col("key"), F.lit(buckets)).cast("int")


def _filter_of(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, seg_len, seg_count, prints = binary_fuse.build(pdf["key"].to_numpy().view(np.uint64))
    return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "seed": seed, "seg_len": seg_len, "seg_count": seg_count, "prints": [prints]})


def build_snapshot(groups: DataFrame, bucket_keys: int = BUCKET_KEYS) -> Snapshot:
    """Freeze grouped digests as a snapshot in the shared folder."""
    groups = store(groups, "snapshot-exact")
    buckets = max(1, math.ceil(groups.count() / bucket_keys))
    exact = groups.withColumn("bucket", _bucket(buckets))
    filters = exact.select("bucket", "key").groupBy("bucket").applyInPandas(
        _filter_of, "bucket int, seed long, seg_len long, seg_count long, prints binary")
    return Snapshot(exact, store(filters, "snapshot-filters"), buckets)


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    out = batch[["key"]].copy()
    out["maybe"] = False
    if len(filters) and len(batch):
        f = filters.iloc[0]
        out["maybe"] = binary_fuse.probe(batch["key"].to_numpy().view(np.uint64), int(f.seed), int(f.seg_len), int(f.seg_count), f.prints)
    return out


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The keys of a batch's groups with ``maybe``: whether the snapshot's filter may hold them."""
    keys = groups.select("key").distinct().withColumn("bucket", _bucket(snapshot.buckets))
    return keys.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(_screen, "key long, maybe boolean")


def merge_batch(batch_groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Groups of snapshot and batch together: ``key, sha, n_bytes, first, members``."""
    batch = store(batch_groups, "batch-groups")
    positive = screen(batch, snapshot).where("maybe").select("key")
    seen = batch.join(positive, "key", "left_semi")
    same = ["key", "sha", "n_bytes"]
    hits = store(seen.join(snapshot.exact.select(*same), same, "left_semi"), "batch-hits")
    added = hits.select(*same, F.col("first").alias("first2"), F.col("members").alias("members2"))
    old = (snapshot.exact.select(*same, "first", "members").join(added, same, "left")
           .select(*same, F.least("first", "first2").alias("first"), (F.col("members") + F.coalesce("members2", F.lit(0))).alias("members")))
    new = batch.join(hits.select(*same), same, "left_anti").select(*same, "first", "members")
    return old.unionByName(new)


def exact_duplicates(docs: DataFrame, batches: int = 2, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    The documents arrive in ``batches`` parts, dealt by a hash of ``doc_id``:
    the first is frozen as a snapshot, each further one is screened against
    the snapshot of all before it.
    """
    rows = store(digests(docs).withColumn("batch", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(batches))), "digests")
    groups = grouped(rows.where("batch = 0"))
    for b in range(1, batches):
        groups = merge_batch(grouped(rows.where(F.col("batch") == b)), build_snapshot(groups, bucket_keys))
    groups = groups.select("sha", "n_bytes", "first", "members")
    out = rows.join(groups, ["sha", "n_bytes"])
    return out.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("members").alias("group_size"),
                      (F.col("rid") == F.col("first.rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
