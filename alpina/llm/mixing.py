"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key ``-ln(u) / quality_weight``; ``u`` is a
hash of the seed and ``doc_id``, so reruns agree. A source's target is filled
with complete epochs first; the rest of the budget takes documents in
ascending key order until the prefix sum of their sizes meets it.

The order within a source is never built in one task. The key is read digit by
digit: sizes are summed per (source, digit), the digit in which the budget
ends is found on that small table, and only rows of that digit go on. After
two digits of 1,024 values about a millionth of a source is left; those rows
alone are sorted and prefix-summed. All others are decided by comparing digits.

Defined results: a null or empty text has size 0 and takes nothing; a null
source is a source (the last); repeated rows are separate documents, ordered
by (key, doc_id, size, text hash); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACED_WORD, packed, store, text_or_empty

WEIGHTS = (5, 2, 1)
DIGIT = 1024
#: fixed values: symbols that count against a text's quality weight
SYMBOLS = "!#$%&*+<=>@[]^_{|}~"


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED_WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: falls with the share of symbols that prose seldom has."""
    kept = F.length(F.translate(text, SYMBOLS, "")).cast("double")
    return F.lit(0.1) + F.lit(0.9) * F.when(F.length(text) > 0, kept / F.length(text)).otherwise(F.lit(1.0))


def _uniform(seed: str, doc_id: Column) -> Column:
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def _keyed(docs: DataFrame, seed: str, weight) -> DataFrame:
    """``row`` (all columns) with its source, size, key and the key's two digits."""
    text = text_or_empty(F.col("row.text"))
    d = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
                            size_of(text).alias("size"), weight(text).alias("w"), F.xxhash64(text).alias("h"))
    d = d.withColumn("key", -F.log(_uniform(seed, F.col("doc_id"))) / F.col("w")).drop("w")
    fine = F.floor(F.col("key") * (DIGIT * DIGIT))
    return d.withColumn("d1", F.floor(fine / DIGIT)).withColumn("d2", fine - F.col("d1") * DIGIT)


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_ratio: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. A target is
    ``min(max_epochs * size, level * weight)``: the level at which the shares
    add up once the sources that reach their limit have passed on the excess.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % n + 1))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_epochs))
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(every) * F.lit(total_ratio))
          .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
          # levels fall once a source stays below its limit: the first such level is the largest
          .withColumn("level", F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(every)))
    limited = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return s.select("source", "source_size", "weight", F.coalesce(limited, F.col("cap").cast("double")).alias("target"))


def _ends_in(rows: DataFrame, budget: DataFrame, digit: str) -> DataFrame:
    """For each source the digit in which its budget ends, and what is left of the budget there."""
    sums = rows.groupBy("source", digit).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy(digit)
    sums = sums.withColumn("upto", F.sum("words").over(upto))
    j = sums.join(budget.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return (j.where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("words") < F.col("left")))
             .select("source", F.col(digit).alias("end"), (F.col("left") - F.col("upto") + F.col("words")).alias("left")))


def mix(docs: DataFrame, weights=WEIGHTS, total_ratio: float = 1.5, max_epochs: int = 2, seed: str = "mix",
        weight=quality_weight, boundary: str = "cut", keep_rows: bool = False) -> DataFrame:
    """What a mix takes of each document.

    Returns ``doc_id, source, size, source_size, target, copies, partial, taken``:
    ``copies`` complete readings and ``partial`` words of one more. With
    ``boundary="cut"`` the document in which a budget ends gives its leading
    words, so a source's taken words equal its target rounded; with
    ``"nearest"`` that document is taken whole or not at all. ``keep_rows``
    adds the input row as struct column ``row``.
    """
    keyed = _keyed(docs, seed, weight)
    narrow = store(keyed.drop("row", "h"), "mix-keys")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, total_ratio, max_epochs)
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    t = store(t.withColumn("left", F.round("target").cast("long") - F.col("epochs") * F.col("source_size")), "mix-targets")

    first = store(_ends_in(narrow, t.where("left > 0").select("source", "left"), "d1"), "mix-first")
    at = F.col("source").eqNullSafe(F.col("_s")) & (F.col("d1") == F.col("_e"))
    inside = narrow.join(first.select(F.col("source").alias("_s"), F.col("end").alias("_e")), at, "left_semi")
    second = _ends_in(inside, first.select("source", "left"), "d2")
    ends = store(first.select(F.col("source").alias("_s"), F.col("end").alias("e1"))
                 .join(second.select("source", F.col("end").alias("e2"), F.col("left").alias("rest")), F.col("_s").eqNullSafe(F.col("source")))
                 .select("source", "e1", "e2", "rest"), "mix-ends")

    plan = (t.withColumnRenamed("source", "_s").join(ends, F.col("_s").eqNullSafe(F.col("source")), "left").drop("source"))
    plan = store(plan, "mix-plan")
    rows = (keyed if keep_rows else narrow.withColumn("h", F.lit(0))).join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    full = (F.col("d1") < F.col("e1")) | ((F.col("d1") == F.col("e1")) & (F.col("d2") < F.col("e2")))
    last = F.coalesce((F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), F.lit(False))
    decided = rows.where(~last).withColumn("part", F.when(full, F.col("size")).otherwise(F.lit(0)))
    prefix = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "h").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(prefix), F.lit(0))
    sorted_rows = rows.where(last).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - ahead)))
    out = decided.unionByName(sorted_rows)
    if boundary == "nearest":
        out = out.withColumn("part", F.when(F.col("part") * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)))
    whole = (F.col("part") == F.col("size")) & (F.col("size") > 0)
    return out.select(*(["row"] if keep_rows else []), "doc_id", "source", "size", "source_size", "target",
                      (F.col("epochs") + F.when(whole, 1).otherwise(0)).alias("copies"),
                      F.when(whole, F.lit(0)).otherwise(F.col("part")).cast("long").alias("partial"),
                      (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it, columns as in ``docs``.

    Whole documents only (``boundary="nearest"``), so no text is shortened.
    """
    taken = mix(docs, boundary="nearest", keep_rows=True, **options).where("copies > 0")
    copies = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
