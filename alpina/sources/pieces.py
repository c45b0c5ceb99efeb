"""Large single documents read by many tasks: quoted CSV files and GeoJSON collections.

A file is read as pieces between separators (line feeds, closing braces), a
byte range per task. Whether a piece starts inside quotes, and how deep in
braces, follows from what stands before it: sums per byte range (one row for
each), prefix sums over the ranges, and a running sum within a range. Records
are then put together again from the pieces; only those of several pieces are
shuffled. The order of pieces is that of ``file, block, id``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import store

BLOCK = ["file", "block"]


def text_pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, size, block, id, value``: the texts between separators, with their file, the start of their byte range and their order in it."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.translate(text, char, ""))


# --- CSV with quoted line feeds (S1, S2) ------------------------------------------------------

def csv_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``first, value``: the records of CSV files whose quoted fields may hold line feeds.

    ``first`` marks a file's first record. Quotes inside a field are doubled, so a
    line feed ends a record where an even number of quotes stands before it.
    Byte ranges in which no line has an odd number need no order and no
    shuffle; the lines of the others are shuffled once, by range, and only
    records that cross ranges a second time. A quote that is never closed makes
    one record of the rest of its file; blank lines are no records.
    """
    lines = text_pieces(spark, path, "\n").withColumn("odd", _count(F.col("value"), quote) % 2)
    by_file = Window.partitionBy("file").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    # a range is named by the number of its first line
    blocks = (lines.groupBy(*BLOCK).agg(F.sum("odd").alias("n_odd"), F.min("id").alias("part"), F.max(F.when(F.col("odd") == 1, F.col("id"))).alias("last_odd"))
                   .withColumns({"before": F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)) % 2,
                                 "opened": F.last(F.when(F.col("n_odd") > 0, F.col("part")), ignorenulls=True).over(earlier),
                                 "head": F.row_number().over(by_file) == 1}))
    placed = lines.join(store(blocks, "csv-blocks"), BLOCK)
    # a record that goes on in later ranges is named by the range that opened it
    leaves = ((F.col("before") + F.col("n_odd")) % 2 == 1) & (F.col("id") >= F.col("last_odd"))
    placed = placed.select("part", "block", "id", "value", "odd", "n_odd", "before", "opened",
                           (F.col("head") & (F.col("id") == F.col("part"))).alias("first"), F.coalesce(leaves, F.lit(False)).alias("leaves"))

    upto = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    noisy = placed.where("n_odd > 0").drop("n_odd")
    start = (F.col("before") + F.sum("odd").over(upto) - F.col("odd")) % 2 == 0
    noisy = noisy.withColumn("start", start).withColumn("since", F.max(F.when(F.col("start"), F.col("id"))).over(upto))
    named = noisy.withColumns({"of": F.when(F.col("since").isNull(), F.col("opened")).otherwise(F.col("part")),
                               "since": F.when(F.col("since").isNull() | F.col("leaves"), F.lit(-1)).otherwise(F.col("since"))})
    text = lambda *order: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "value"))), lambda p: p["value"]), "\n")
    stretch = named.groupBy("part", "block", "of", "since").agg(F.max("first").alias("first"), F.min("id").alias("id"), text("id").alias("value"))
    quiet = placed.where("n_odd = 0")
    across = stretch.where("since < 0").select("of", "block", "id", "first", "value").unionByName(
        quiet.where("before = 1").select(F.col("opened").alias("of"), "block", "id", "first", "value"))
    joined = across.groupBy("of").agg(F.max("first").alias("first"), text("block", "id").alias("value")).select("first", "value")
    both = stretch.where("since >= 0").select("first", "value").unionByName(joined).unionByName(quiet.where("before = 0").select("first", "value"))
    return both.withColumn("value", F.regexp_replace("value", "\r$", "")).where(F.length("value") > 0)


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """S2 for large files: every column as text, like :func:`alpina.sources.tables.read_csv_strings`, but many tasks read a file.

    All files have the header of the first; the order of rows is not kept.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    names = spark.read.options(header="true", inferSchema="false", **options).csv(path).columns
    if not names:
        raise ValueError(f"empty CSV: {path}")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = csv_records(spark, path).where(~F.col("first"))
    return rows.select(F.from_csv("value", schema, options).alias("r")).select("r.*")


# --- one GeoJSON collection (S8) -----------------------------------------------------------------

#: what may stand before an object: anything but braces, or whole strings
_BEFORE_OBJECT = r'^(?:[^{"]++|"(?:[^"\\]++|\\.)*+")*+'


def collection_objects(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the texts of all objects one level below the top of a JSON document.

    ``path`` is a file, or a folder whose parts in order of their names are the
    document. The document is cut at closing braces; one that stands in a
    string or deeper than an object's own does not end the object. Braces that
    do not match are an error.
    """
    pieces = text_pieces(spark, path, "}").withColumn("bare", F.regexp_replace("value", r"\\.", ""))
    pieces = pieces.withColumn("odd", _count(F.col("bare"), '"') % 2)
    # what the piece adds to the depth if it starts outside strings, and if it starts in one; its own brace counts outside only
    outside = F.regexp_replace(F.regexp_replace("bare", r'"[^"]*+"', ""), r'"[^"]*+$', "")
    inside = F.regexp_replace(F.regexp_replace(F.regexp_replace("bare", r'^[^"]*+"?', ""), r'"[^"]*+"', ""), r'"[^"]*+$', "")
    pieces = pieces.withColumns({"d0": _count(outside, "{") - F.when(F.col("odd") == 0, 1).otherwise(0),
                                 "d1": _count(inside, "{") - F.when(F.col("odd") == 1, 1).otherwise(0)})
    in_block = Window.partitionBy(*BLOCK).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("quotes", F.sum("odd").over(in_block) - F.col("odd"))
    even = F.col("quotes") % 2 == 0
    blocks = pieces.groupBy("file", "size", "block").agg(
        F.sum("odd").alias("odd"), F.max("id").alias("last"), F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.sum(F.when(even, F.col("d0")).otherwise(F.col("d1"))).alias("s0"), F.sum(F.when(even, F.col("d1")).otherwise(F.col("d0"))).alias("s1"))
    # one row for each byte range: the prefix sums over them are a small table
    order = Window.partitionBy(F.lit(path)).orderBy(*BLOCK)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    by_file = Window.partitionBy("file")
    # the last piece of a file has no brace of its own where the bytes are one fewer
    blocks = blocks.withColumn("open_end", F.when(F.col("block") == F.max("block").over(by_file), F.sum("bytes").over(by_file) - F.col("size")).otherwise(0))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("adds", F.when(F.col("before") == 0, F.col("s0")).otherwise(F.col("s1")) + F.col("open_end"))
    blocks = store(blocks.withColumn("depth", F.coalesce(F.sum("adds").over(earlier), F.lit(0))), "json-blocks")
    total = blocks.agg(F.sum("adds").alias("depth"), F.sum("odd").alias("odd")).first()
    if total["depth"] or (total["odd"] or 0) % 2:
        raise ValueError(f"braces or quotes of {path} do not match")

    placed = pieces.join(blocks.select(*BLOCK, "before", "depth", "last", "open_end"), BLOCK)
    bare_end = (F.col("id") == F.col("last")) & (F.col("open_end") == 1)
    in_string = (F.col("before") + F.col("quotes")) % 2 == 1
    placed = placed.withColumn("adds", F.when(in_string, F.col("d1")).otherwise(F.col("d0")) + F.when(bare_end, 1).otherwise(0))
    placed = placed.withColumn("after", F.col("depth") + F.sum("adds").over(in_block))
    ends = (F.col("after") == 1) & ~bare_end & ((F.col("before") + F.col("quotes") + F.col("odd")) % 2 == 0)
    placed = placed.withColumn("ends", ends.cast("int"))
    placed = placed.withColumn("k", F.sum("ends").over(in_block) - F.col("ends"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", F.concat("value", F.when(bare_end, F.lit("")).otherwise(F.lit("}"))).alias("value")))), lambda p: p["value"]), "")
    stretch = store(placed.groupBy(*BLOCK, "k").agg(text.alias("value"), F.max("ends").alias("ends"), F.min(F.col("after") - F.col("adds")).alias("from")), "json-stretches")
    # a range's first stretch goes on from the last earlier range in which an object ended
    summary = stretch.groupBy(*BLOCK).agg(F.max("ends").alias("any"))
    place = F.struct(*BLOCK)
    summary = summary.withColumn("of", F.last(F.when(F.col("any") == 1, place), ignorenulls=True).over(earlier)).drop("any")
    inner = stretch.where("k > 0 AND ends = 1").select("value", "from")
    edge = stretch.where("k = 0 OR ends = 0").join(summary, BLOCK)
    own = F.when(F.col("k") > 0, place).otherwise(F.col("of"))
    across = edge.select(own.alias("of"), *BLOCK, "k", "value", "from", "ends").groupBy("of").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*BLOCK, "k", "value"))), lambda p: p["value"]), "").alias("value"),
        F.min("from").alias("from")).select("value", "from")
    cut = lambda c: F.regexp_replace(c, _BEFORE_OBJECT, "")
    # the first object stands behind the document's own brace
    below = F.when(F.col("from") == 0, cut(F.expr("substring(v, 2)"))).otherwise(F.col("v"))
    objects = inner.unionByName(across).select(cut(F.col("value")).alias("v"), "from").select(below.alias("value"))
    return objects.where(F.col("value").startswith("{"))


def read_feature_collection(spark: SparkSession, *candidates: str) -> DataFrame:
    """S8 for large documents: features of the first candidate that exists and whose braces match; many tasks read it."""
    from .tables import parse_geojson
    for path in candidates:
        try:
            return parse_geojson(collection_objects(spark, path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        except ValueError:
            continue
    raise FileNotFoundError(f"no GeoJSON collection among {candidates}")
