"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

``build_index`` stores a posting (term, document key, position) for each token
of the training texts whose term a test set holds - no other posting can be
looked up. The index is document-partitioned: postings stay with the input
split they come from, a term's together, so building it shuffles nothing and a
hot term is spread over all splits. The same pass stores each text's length.

``exact_matches`` orders the terms of each test phrase by their frequency in
the index. Postings of the rarest term, moved back by the term's offset, give
the candidate starts; they are intersected with the moved postings of the
second rarest term, and what is left with those of all other terms. A start at
which every term of the phrase stands is an exact occurrence.
``proximity_matches`` does the same with a slack in positions.

The test set's terms and phrases, and the keys of the documents with a
candidate, go to the tasks only if their stored size is
below ``MAX_BROADCAST`` bytes; larger ones are joined by shuffling on (term,
salt), where a term's postings are dealt over ``SALTS`` parts.

Defined results: a null or empty text has no words and is never hit; an item
without words has no window; items with a null ``item_id`` hit like any other,
count as one item together and have no name in the list of ids; words are
compared after lower-casing A-Z;
documents are told apart by (``doc_id``, text hash), so repeated rows share one
result and a null ``doc_id`` is a document; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_or_empty, words

WINDOW = 10
MAX_BROADCAST = 32 << 20
SALTS = 32


def document_key(doc_id: Column, text: Column) -> Column:
    """What tells documents apart: the id and a 64-bit hash of the text."""
    return F.struct(doc_id.alias("doc_id"), F.xxhash64(text).alias("h"))


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``phrase, terms, items`` - every distinct window of the items' words and the items it stands in.

    Items are structs of the id: a set of bare ids would leave out a null one.
    """
    w = items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = w.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s") + 1, F.lit(window)).alias("terms"))
    return each.groupBy("terms").agg(F.collect_set(F.struct("item_id")).alias("items")).select(
        F.concat_ws(" ", "terms").alias("phrase"), "terms", "items")


@dataclass(frozen=True)
class Index:
    """Postings ``term, key, pos`` of the terms that a test set holds, and ``key, n_words`` of every document."""

    postings: DataFrame
    documents: DataFrame


def _small(df: DataFrame, width: Column) -> bool:
    return (df.agg(F.sum(width)).first()[0] or 0) <= MAX_BROADCAST


def _with_terms(postings: DataFrame, side: DataFrame, small: bool, how: str = "inner") -> DataFrame:
    """Join postings to a table with a ``term`` column; the size of that table decides how."""
    if small:
        return postings.join(F.broadcast(side), "term", how)
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return postings.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"], how).drop("salt")


def build_index(docs: DataFrame, terms: DataFrame) -> Index:
    """Store the postings of ``docs`` for the given ``term`` rows."""
    d = docs.select(document_key(F.col("doc_id"), text_or_empty("text")).alias("key"), words("text").alias("w"))
    # one more token after the last: the empty term, whose position is the number of words
    tokens = d.select("key", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "term"))
    terms = store(terms.distinct().unionByName(docs.sparkSession.createDataFrame([("",)], "term string")), "index-terms")
    held = _with_terms(tokens, terms, _small(terms, F.octet_length("term") + 16), "left_semi")
    # a single long key: Spark sorts it by radix, and equal terms stay in document order
    held = store(held.select("term", "key", "pos").sortWithinPartitions(F.xxhash64("term")), "index-postings")
    ends = held.where(F.col("term") == "")
    return Index(held.where(F.col("term") != ""), ends.select("key", F.col("pos").cast("long").alias("n_words")))


def phrase_terms(index: Index, phrase_table: DataFrame) -> DataFrame:
    """``phrase, term, offset, order, n``: the terms of each phrase, the rarest in the index first."""
    each = phrase_table.select("phrase", F.posexplode("terms").alias("offset", "term"))
    frequency = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ranked = each.join(frequency, "term", "left").select("phrase", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term").alias("t"))
    lists = ranked.groupBy("phrase").agg(F.sort_array(F.collect_list("t")).alias("ts")).where("ts[0].df > 0")
    return (lists.select("phrase", F.size("ts").alias("n"), F.posexplode("ts").alias("order", "t"))
            .select("phrase", "n", "order", F.col("t.offset").alias("offset"), F.col("t.term").alias("term")))


def exact_matches(index: Index, phrase_table: DataFrame) -> DataFrame:
    """``key, phrase, start, n``: every place at which all terms of a phrase stand in a row."""
    terms = store(phrase_terms(index, phrase_table), "phrase-terms")
    small = _small(terms, F.octet_length("phrase") + F.octet_length("term") + 32)

    def moved(order: Column) -> DataFrame:
        at = _with_terms(index.postings, terms.where(order), small)
        return at.select("key", "phrase", (F.col("pos") - F.col("offset")).alias("start"), "n", "order").where("start >= 0")

    spot = ["key", "phrase", "start", "n"]
    # repeated rows have their postings twice: a list either has the place or not
    two = moved(F.col("order") < 2).groupBy(*spot).agg(F.bit_or(F.col("order") + 1).alias("lists"))
    two = store(two.where(F.col("lists") == F.when(F.col("n") > 1, 3).otherwise(1)).select(*spot), "index-candidates")
    # the other terms: look up the postings of the candidates' own documents and positions
    asked = two.join(F.broadcast(terms.where("order >= 2").drop("n")) if small else terms.where("order >= 2").drop("n"), "phrase")
    asked = asked.select(*spot, "term", (F.col("start") + F.col("offset")).alias("pos"))
    found = store(two.select("key").distinct(), "index-found")
    found = F.broadcast(found) if _small(found, F.lit(32)) else found
    held = index.postings.join(found, "key", "left_semi")
    rest = asked.join(held, ["key", "term", "pos"], "left_semi").groupBy(*spot).agg(F.count(F.lit(1)).alias("found"))
    return two.where("n <= 2").unionByName(rest.where("found = n - 2").select(*spot))


def proximity_matches(index: Index, phrase_table: DataFrame, slack: int = 3) -> DataFrame:
    """``key, phrase, start``: places of a phrase's rarest term around which every other term stands,
    in any order, within ``slack`` positions of where an exact occurrence would have it."""
    terms = store(phrase_terms(index, phrase_table), "phrase-terms")
    small = _small(terms, F.octet_length("phrase") + F.octet_length("term") + 32)
    anchors = _with_terms(index.postings, terms.where("order = 0"), small)
    anchors = store(anchors.select("key", "phrase", "n", (F.col("pos") - F.col("offset")).alias("start")), "near-anchors")
    asked = anchors.join(terms.where("order > 0").drop("n"), "phrase").select(
        "key", "phrase", "n", "start", "order", "term", F.explode(F.sequence(F.col("start") + F.col("offset") - slack, F.col("start") + F.col("offset") + slack)).alias("pos"))
    found = asked.join(index.postings, ["key", "term", "pos"], "left_semi").select("key", "phrase", "n", "start", "order").distinct()
    full = found.groupBy("key", "phrase", "n", "start").agg(F.count(F.lit(1)).alias("found")).where("found = n - 1")
    return anchors.where("n = 1").select("key", "phrase", "start").unionByName(full.select("key", "phrase", "start"))


def covered(spans: Column) -> Column:
    """Positions in the union of sorted ``(start, n)`` spans of one document."""
    step = lambda acc, s: F.struct(
        (acc["words"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["end"], s["start"]))).cast("long").alias("words"),
        F.greatest(acc["end"], s["start"] + s["n"]).cast("int").alias("end"))
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("int").alias("end")), step, lambda acc: acc["words"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    table = store(phrases(items, window), "phrases")
    index = build_index(docs, table.select(F.explode("terms").alias("term")))
    found = store(exact_matches(index, table), "index-matches")
    hit = found.select("key", "start", "n").distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("spans"))
    hit = hit.select("key", covered(F.col("spans")).alias("n_hit"))
    of_items = found.select("key", "phrase").distinct().join(table.select("phrase", "items"), "phrase")
    of_items = of_items.select("key", F.explode("items").alias("item")).select("key", F.col("item.item_id").cast("string").alias("item"))
    # a null id counts as an item and has no name in the list
    of_items = of_items.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull().cast("int")).alias("unnamed"))
    per_doc = hit.join(of_items, "key", "left")
    out = index.documents.join(per_doc, "key", "left")
    return out.select("key", F.col("key.doc_id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.size("items") + F.col("unnamed"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any window of the items, columns as in ``docs``."""
    bad = store(contamination(docs, items, window).where("contaminated").select("key").distinct(), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("key", document_key(F.col("row.doc_id"), text_or_empty(F.col("row.text"))))
    return rows.join(bad, "key", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
