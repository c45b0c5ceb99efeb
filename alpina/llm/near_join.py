"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

1. Every text becomes its set of five-word shingles (hashes), and the set a
   signature of ``TREES`` x ``DEPTH`` MinHashes. Texts with equal sets form a
   class; all further steps see one row per class, weighted by its members.
2. Each tree is a sorted prefix trie: its labels are a path of ``DEPTH``
   MinHashes, and texts that agree on a prefix stand together. All texts are
   matched on the longest prefix ``d`` at which ``1 - (1 - t^d)^TREES`` - the
   chance that a pair at the threshold ``t`` shares a prefix of that length in
   some tree - reaches the target recall. From there prefixes can be shortened
   text by text and tree by tree, one label at a time down to ``shortest``, as
   long as the run that the shorter prefix gives has at most ``SMALL_RUN``
   texts: a text in a crowd keeps the prefix that reaches the target. By default
   ``shortest`` is ``SHORTEST``, the prefix that reaches the target itself: with
   shorter ones more unlike texts hang together in one group before they are
   verified, and the work on large groups outgrows the disk budget (README.md
   of this folder). Texts of one run are candidates; a run is kept as links to
   its first text, never as pairs.
3. Candidate classes of one connected group are verified exactly: a group is
   cut into blocks of about ``BLOCK`` classes and at most about
   ``BLOCK_SHINGLES`` shingles, and each pair of blocks is compared in one task
   by counting common shingles. A task returns a row per class - its
   links and the class it hangs on - and no pairs. Each class goes with its
   shingles to every block of its group: ``N * ceil(N / BLOCK)`` rows for ``N``.
4. Links and members are summed; classes joined by links form a near-duplicate
   group, named by its smallest ``doc_id``.

Defined results: words are those of the decontamination contract, lower-cased;
a text with fewer than five words is one shingle of all of them; a null or
empty text has no shingle, is linked to nothing and is a class of its own;
repeated rows with one text are members of one class; a null ``doc_id`` is the
largest; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import packed, remove_table, shared_path, store, text_groups, text_or_empty, trim_memory, unpacked

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.99
TREES, DEPTH = 16, 8
#: the shortest prefix, and the largest run that a prefix may be shortened to
SHORTEST, SMALL_RUN = 6, 16
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
#: shingles of verification work that go to one task together, on average
PACK_SHINGLES = 1 << 21
#: the word class of the contract, on UTF-8 bytes
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_U = np.uint64


def shingles(text: str, ngram: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    tokens = WORDS.findall(text.encode("utf-8", "replace").lower())  # bytes: A-Z alone are lower-cased
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh64_intdigest, tokens)), np.uint64)
    n = min(ngram, len(tokens))
    out = np.zeros(len(tokens) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ h[i:len(h) - n + 1 + i]) * _U(0x9E3779B97F4A7C15)
            out ^= out >> _U(29)
        return np.unique(mixed(out))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def signature(sets: list[np.ndarray], size: int) -> np.ndarray:
    """MinHashes of non-empty sets, one row each: the smallest of ``size`` multiply-add hashes (upper 32 bits)."""
    rng = np.random.default_rng(11)
    mult = rng.integers(1, 1 << 63, size, dtype=np.uint64) * _U(2) + _U(1)
    add = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    flat, starts = np.concatenate(sets), np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), size), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(size):
            out[:, k] = np.minimum.reduceat((flat * mult[k] + add[k]) >> _U(32), starts)
    return out


def depth_for(recall: float, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold is found with the target recall."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    return 1


def set_key(sets: np.ndarray) -> int:
    """A 63-bit name of a shingle set."""
    with np.errstate(over="ignore"):
        return int((mixed(sets).sum(dtype=np.uint64) ^ mixed(sets * _U(3)).sum(dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(1))


def sketched(docs: DataFrame, ngram: int, trees: int, depth: int) -> DataFrame:
    """Stored ``doc_id, h, node, n, paths``: a text's hash, the class of its shingle set, the set's size and a path per tree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in text_groups(texts, 500_000):
                sets = [shingles(t, ngram) for t in texts[part]]
                full = [i for i, s in enumerate(sets) if len(s)]
                paths: list = [None] * len(sets)
                if full:
                    sign = signature([sets[i] for i in full], trees * depth).astype(">u4")
                    for i, row in zip(full, sign):
                        paths[i] = row.tobytes()
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[part].astype("Int64"), "h": pdf["h"].iloc[part], "node": [set_key(s) if len(s) else -1 for s in sets], "n": [len(s) for s in sets], "paths": paths})
            del pdf, texts
        trim_memory()

    text = text_or_empty("text")
    return store(docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h")).mapInPandas(run, "doc_id long, h long, node long, n long, paths binary"), "near-sketches")


def candidate_edges(classes: DataFrame, trees: int, depth: int, prefix: int, shortest: int = SHORTEST, small: int = SMALL_RUN) -> DataFrame:
    """``src, dst``: texts of a run of a tree, each with the run's first one.

    Runs at ``prefix`` labels hold for all texts; shorter prefixes, down to
    ``shortest``, only where their run has at most ``small`` texts.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    lengths = F.array(*[F.lit(d) for d in range(prefix, min(shortest, prefix) - 1, -1)])
    rows = classes.select("node", "paths", tree.alias("tree")).select("node", "paths", "tree", F.explode(lengths).alias("d"))
    label = F.substring(F.col("paths"), F.col("tree") * (4 * depth) + 1, F.col("d") * 4)
    rows = rows.select("node", "d", F.xxhash64("tree", "d", label).alias("run"))
    # runs of one row have no neighbour, and a shorter prefix must not lead into a crowd
    shared = rows.groupBy("run", "d").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("dst"))
    shared = store(shared.where((F.col("size") > 1) & ((F.col("d") == prefix) | (F.col("size") <= small))).select("run", "dst"), "near-runs")
    # the texts of a run hang on its first one: no run is sorted or held in one task
    return rows.select("run", F.col("node").alias("src")).join(shared, "run").where("src <> dst").select("src", "dst").distinct()


def _ones(sets: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the shingles of ``sets`` that are in ``columns``, ordered by column."""
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
    inside = columns[at] == flat
    at, row = at[inside], row[inside]
    order = np.argsort(at, kind="stable")
    return row[order], at[order]


def common_counts(a: list[np.ndarray], b: list[np.ndarray] | None = None, width: int = 4096) -> np.ndarray:
    """Numbers of common shingles of every set of ``a`` with every set of ``b`` (of ``a`` itself; its diagonal is not meant)."""
    if b is None:
        values, times = np.unique(np.concatenate(a), return_counts=True)
        shared = values[times > 1]
    else:
        shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(a if b is None else b)), np.int64)
    if not len(shared):
        return out
    row_a, at_a = _ones(a, shared)
    row_b, at_b = (row_a, at_a) if b is None else _ones(b, shared)
    for lo in range(0, len(shared), width):
        n = min(width, len(shared) - lo)

        def part(sets, row, at):
            i, j = np.searchsorted(at, [lo, lo + n])
            m = np.zeros((len(sets), n), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            return m

        left = part(a, row_a, at_a)
        out += (left @ (left if b is None else part(b, row_b, at_b)).T).astype(np.int64)
    return out


def verified_block(nodes: np.ndarray, sets: list[np.ndarray], members: np.ndarray, side: np.ndarray, threshold: float) -> pd.DataFrame:
    """``node, links, root`` of a block with itself (``side`` all 0) or with another.

    ``links`` counts the members of linked classes; ``root`` is the smallest class
    that the links of this block reach.
    """
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    sizes = np.array([len(s) for s in sets])
    links, root = np.zeros(len(nodes), np.int64), nodes.copy()
    high = np.iinfo(np.int64).max
    if not len(left) or not len(right):
        one = left if len(left) else right
        common = common_counts([sets[i] for i in one])
        near = common >= threshold * (sizes[one][:, None] + sizes[one][None, :] - common) - 1e-9
        np.fill_diagonal(near, False)
        pairs = [(one, one, near)] if len(left) else []
    else:
        common = common_counts([sets[i] for i in left], [sets[i] for i in right])
        near = common >= threshold * (sizes[left][:, None] + sizes[right][None, :] - common) - 1e-9
        pairs = [(left, right, near), (right, left, near.T)]
    for x, y, m in pairs:
        links[x] += m @ members[y]
    changed = True
    while changed:
        changed = False
        for x, y, m in pairs:
            lower = np.minimum(root[x], np.where(m, root[y][None, :], high).min(axis=1, initial=high))
            if (lower < root[x]).any():
                root[x], changed = lower, True
    return pd.DataFrame({"node": nodes, "links": links, "root": root})


def _verify_pack(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby(["grp", "b1", "b2"], sort=False):
            sets = [np.frombuffer(x, "<u8") for x in g["shingles"]]
            out.append(verified_block(g["node"].to_numpy(), sets, g["members"].to_numpy(), g["side"].to_numpy(), threshold))
        trim_memory()
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")

    return run


def near_groups(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL,
                    trees: int = TREES, depth: int = DEPTH, block: int = BLOCK, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id, h, grp, class_id, rep_id, n_links`` of every document.

    ``h`` is the text's hash and ``grp`` the number of its group (null for texts
    without words). ``rep_id`` is the smallest id with the same shingle set,
    ``n_links`` the number of other documents with a similarity of ``threshold``
    or more, and ``class_id`` the smallest id that links lead to.
    """
    made: list[str] = []

    def kept(df: DataFrame, tag: str) -> DataFrame:
        made.append(shared_path(df.sparkSession, tag))
        return store(df, tag, path=made[-1])

    rows = sketched(docs, ngram, trees, depth)
    full = rows.where("n > 0")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    classes = kept(full.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min(least).alias("rep"), F.first("n").alias("n"), F.first("paths").alias("paths")), "near-classes")
    edges = kept(candidate_edges(classes, trees, depth, depth_for(recall, threshold, trees, depth), shortest), "near-edges")
    groups = connected_components(edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))), edges)
    groups = kept(groups.join(classes.select("node", "members", "rep", "n"), "node").select("node", F.col("root").alias("grp"), "members", "rep", "n"), "near-groups")

    # blocks: classes of a group dealt by hash; a group of one block is compared with itself
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(float(block))), F.ceil(F.sum("n") / F.lit(float(BLOCK_SHINGLES)))).cast("int")
    sizes = kept(groups.groupBy("grp").agg(blocks.alias("blocks"), F.sum("n").alias("shingles")), "near-sizes")
    dealt = groups.join(sizes.select("grp", "blocks"), "grp").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    jobs = dealt.select("grp", "node", "members", "rep", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    jobs = jobs.select("grp", "node", "members", "rep", F.least("b", "other").alias("b1"), F.greatest("b", "other").alias("b2"), (F.col("b") > F.col("other")).cast("int").alias("side"))

    # shingles of one text per class, read again for the candidates alone
    wanted = kept(groups.select(F.col("rep.doc_id").alias("doc_id"), "node"), "near-wanted")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in text_groups(texts, 500_000):
                sets = [shingles(t, ngram) for t in texts[part]]
                yield pd.DataFrame({"node": [set_key(s) for s in sets], "shingles": [s.astype("<u8").tobytes() for s in sets]})
            del pdf, texts
        trim_memory()

    texts = docs.select("doc_id", text_or_empty("text").alias("text")).join(wanted.select(F.col("doc_id").alias("_d")).distinct(), F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")
    sets = texts.mapInPandas(sets_of, "node long, shingles binary").join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    work = jobs.join(sets, "node")
    total = sizes.agg(F.sum(F.col("shingles") * F.col("blocks"))).first()[0] or 0
    packs = max(1, -(-total // PACK_SHINGLES))
    work = work.withColumn("pack", F.pmod(F.xxhash64("grp", "b1", "b2"), F.lit(packs)))
    checked = work.select("pack", "grp", "node", "members", "b1", "b2", "side", "shingles").groupBy("pack").applyInPandas(_verify_pack(threshold), "node long, links long, root long")
    checked = kept(checked, "near-checked")

    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    found = checked.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")).distinct()
    roots = connected_components(found.select(F.col("src").alias("node")).unionByName(found.select(F.col("dst").alias("node"))), found)
    named = classes.select("node", "members", "rep").join(links, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    named = kept(named, "near-named")
    first = named.groupBy("root").agg(F.min("rep").alias("first"))
    named = store(named.join(first, "root").select("node", F.col("root").alias("grp"), F.col("rep.doc_id").alias("rep_id"), F.col("first.doc_id").alias("class_id"),
                  (F.col("members") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")), "near-result")
    for path in made:  # what is left to read are the sketches and the result
        remove_table(docs.sparkSession, path)
    out = full.select("doc_id", "h", "node").join(named, "node").select("doc_id", "h", "grp", "class_id", "rep_id", "n_links")
    alone = rows.where("n = 0").select("doc_id", "h", F.lit(None).cast("long").alias("grp"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, rep_id, n_links`` of every document; see ``near_groups``."""
    return near_groups(docs, **options).select("doc_id", "class_id", "rep_id", "n_links")


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest ``doc_id`` (then text hash) of every group, columns as in ``docs``.

    Texts without words stay. Repeated rows with one ``doc_id`` and text are one document.
    """
    groups = store(near_groups(docs, **options).where("grp is not null").select("doc_id", "h", "grp"), "near-kept")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    keys = groups.groupBy("grp", "doc_id", "h").agg(F.count(F.lit(1)).alias("rows"))
    first = groups.groupBy("grp").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    others = keys.join(first, "grp").select(F.struct("doc_id", "h").alias("key"), "rows", (key == F.col("first")).alias("stays"))
    others = store(others.where("not stays or rows > 1"), "near-dropped")
    rows = packed(docs).withColumn("key", F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64(text_or_empty(F.col("row.text"))).alias("h")))
    out = rows.join(others.select("key"), "key", "left_anti").select("row")
    repeated = rows.join(others.where("stays").select("key"), "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row")
    return unpacked(out.unionByName(repeated), docs.columns)
