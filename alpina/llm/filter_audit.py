"""Audit of how filters interact: failing-id relations, joined for every prefix of every order.

1. One pass over the texts computes what the filters look at; every row gets a
   row id and keeps its part and labels (``facts``).
2. Each filter's failing rows are stored as a table of row ids.
3. What is left after a prefix depends on the set of its filters alone, so the
   120 orders of five filters have 32 prefixes. Survivors of all sets are built
   filter by filter: the survivors so far, left-anti joined to the filter's ids,
   are the survivors of the same sets with the filter added.
4. Survivors of a set without a filter, left-semi joined to the filter's ids,
   are what it removes there; counted with their labels. Rows that fail and are
   not removed were removed earlier (redundant); what is removed after all
   other filters fails this one only.
5. The counts, at most 80 a part, are laid out along all orders.

All joins are on row ids, which are unique, so a part with a third of all rows
is no hot key; counting aggregates per task first. Identical texts are found by
a digest of the text: groups are aggregated per task, and groups that hold at
least a thousandth of all rows (so at most a thousand) are joined by broadcast.

Defined results: a null text is empty, a null source is the part "" (together
with the empty one); a null ``doc_id`` has no labels, is smaller than no other
and fails E never; repeated rows count once each, and with one ``doc_id`` none
is a smaller one; of several label rows of a document any counts; ties do not
occur, as counts have no order; texts of any length are read whole; an empty
table has no part and gives no row. Further columns are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, store, text_or_empty

#: names of the filters, in the order of their bits
FILTERS = "ABCDE"
#: groups of identical texts with at least this share of all rows are joined by broadcast: at most its inverse
HOT_SHARE = 0.001


def facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored ``row_id, doc_id, part, good, toxic, digest, fails_A .. fails_D`` of every document."""
    text = text_or_empty("text")
    words = F.filter(F.split(F.col("text"), SPACES), lambda w: w != "")
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", "text", words.alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    upper = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "part",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        (n < 200).alias("fails_A"), (F.lit(100) * distinct < F.lit(50) * n).alias("fails_B"),
        (F.lit(100).cast("long") * upper > F.lit(2).cast("long") * F.length("text")).alias("fails_C"),
        F.col("text").rlike("[#$%&*|]").alias("fails_D"))
    rows = store(rows, "audit-texts")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    out = rows.join(marks, "doc_id", "left")
    return store(out.select("row_id", "doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
                            "digest", "fails_A", "fails_B", "fails_C", "fails_D"), "audit-facts")


def repeated_ids(rows: DataFrame) -> DataFrame:
    """``row_id`` of the rows whose text a smaller ``doc_id`` has too."""
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = store(groups.where("n > 1"), "audit-groups")
    total = rows.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    least = max(2, math.ceil(total * HOT_SHARE))
    # at most 1 / HOT_SHARE groups are as large as that
    hot = F.broadcast(groups.where(F.col("n") >= least).select("digest", "first"))
    few = groups.where(F.col("n") < least).select("digest", "first")
    rows = rows.select("row_id", "doc_id", "digest")
    both = rows.join(hot, "digest").unionByName(rows.join(hot, "digest", "left_anti").join(few, "digest"))
    return both.where("doc_id > first").select("row_id")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """A stored table of ``row_id`` per filter."""
    out = {f: store(rows.where(f"fails_{f}").select("row_id"), f"audit-fails-{f}") for f in FILTERS[:-1]}
    out[FILTERS[-1]] = store(repeated_ids(rows), f"audit-fails-{FILTERS[-1]}")
    return out


def survivors(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """``passed, row_id, part, good, toxic``: the rows that fail none of the filters of the bit set ``passed``, for all sets."""
    left = rows.select(F.lit(0).cast("byte").alias("passed"), "row_id", "part", "good", "toxic")
    for bit, f in enumerate(FILTERS[:len(failing)]):
        ids = failing[f].hint("shuffle_hash")
        more = left.join(ids, "row_id", "left_anti").withColumn("passed", F.col("passed").bitwiseOR(F.lit(1 << bit).cast("byte")))
        left = left.unionByName(store(more.select(*left.columns), f"audit-survivors-{f}"))
    return left


def removals(left: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """``part, passed, bit, removed, good_lost, toxic_lost``: what each filter removes after each set without it."""
    out = None
    for bit, f in enumerate(FILTERS[:len(failing)]):
        ids = failing[f].hint("shuffle_hash")
        gone = left.where(F.col("passed").bitwiseAND(F.lit(1 << bit).cast("byte")) == 0).join(ids, "row_id", "left_semi")
        counts = gone.groupBy("part", "passed").agg(
            F.count(F.lit(1)).alias("removed"), F.count(F.when(F.col("good"), 1)).alias("good_lost"),
            F.count(F.when(F.col("toxic"), 1)).alias("toxic_lost")).withColumn("bit", F.lit(bit))
        out = counts if out is None else out.unionByName(counts)
    return out.select("part", F.col("passed").cast("int").alias("passed"), "bit", "removed", "good_lost", "toxic_lost")


def _steps() -> Column:
    """All orders and their steps as an array of structs: a literal of 120 x 5."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, passed = "".join(FILTERS[b] for b in order), 0
        for step, bit in enumerate(order, 1):
            out.append((name, step, bit, passed))
            passed |= 1 << bit
    rows = ",".join(f"named_struct('filter_order','{o}','step',{s},'bit',{b},'passed',{p})" for o, s, b, p in out)
    return F.expr(f"array({rows})")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: see the contract columns in the last select."""
    rows = facts(docs, labels)
    failing = failing_ids(rows)
    left = survivors(rows, failing)
    kept = left.groupBy("part", F.col("passed").cast("int").alias("passed")).agg(F.count(F.lit(1)).alias("kept"))
    # one row a part: at most 32 and 80 entries
    kept = kept.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("passed", "kept"))).alias("kept_after"))
    n, all_bits = len(FILTERS), (1 << len(FILTERS)) - 1
    weight = F.element_at(F.array(*[F.lit(math.factorial(s) * math.factorial(n - 1 - s)) for s in range(n)]), F.bit_count("passed") + 1)
    gone = store(removals(left, failing), "audit-removals")
    per_filter = gone.groupBy("part", "bit").agg(
        F.sum(F.when(F.col("passed") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.expr("passed | (1 << bit)") == all_bits, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    per_filter = per_filter.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct("bit", F.struct("fails", "unique_fails", "shapley").alias("of")))).alias("filters"))
    gone = gone.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("bit") * (all_bits + 1) + F.col("passed")).alias("at"), F.struct("removed", "good_lost", "toxic_lost").alias("of")))).alias("gone"))
    wide = kept.join(gone, "part", "left").join(per_filter, "part", "left").withColumn("s", F.explode(_steps()))

    def count(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long")

    here = F.col("gone")[F.col("s.bit") * (all_bits + 1) + F.col("s.passed")]
    own = F.col("filters")[F.col("s.bit")]
    after = F.expr("s.passed | (1 << s.bit)")
    removed = count(here["removed"])
    return wide.select("part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"),
                       count(F.col("kept_after")[after]).alias("kept"), removed.alias("removed"),
                       (count(own["fails"]) - removed).alias("redundant"), count(own["unique_fails"]).alias("unique_fails"),
                       count(here["good_lost"]).alias("good_lost"), count(here["toxic_lost"]).alias("toxic_lost"),
                       count(own["shapley"]).alias("shapley"))
