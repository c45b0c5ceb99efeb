"""Line dedup by a log-template tree (DataFrame functions only).

A line's tokens are its white-space words; a token with a digit is a variable
field and becomes ``<*>``. The tree has a fixed depth: token count, then the
first ``DEPTH`` tokens. Its leaves are (count, leading tokens).

1. Lines are counted once per document. A template - the masked line - found in
   ``min_docs`` documents recurs. Only hashes and leaf keys are shuffled.
2. In nodes that ``min_docs`` documents reach with several templates, the
   fields without digits are generalised: a position is constant if one token
   has more than half of the node's lines there, else ``<*>``. Lines that agree
   with the constants in ``similarity`` of all positions belong to the general
   template; if they come from ``min_docs`` different documents, they recur as
   well. Lines of no template go down ``LEVELS`` further levels: a node splits
   at the position of its commonest token that is no constant, one child for each
   token of ``min_docs`` lines there and one for all others. So several
   templates of one leaf, and templates among prose, are found apart.
3. Lines of recurring templates are dropped, wherever they stand. Only
   generalising needs ``min_tokens`` tokens: a shorter line recurs as itself.

A hot line is one row per task after partial aggregation; nodes are split
over distinct lines, so copies add weight and no rows. A general template's
documents are counted over its lines that do not recur by themselves: one that
does has enough alone.

Defined results: a null or empty text has one empty line and stays as it is
(null stays null); blank lines are kept; a document is (``doc_id``, text hash),
and repeated rows count as one and have one result; empty tables give an
empty result. Lines end at ``\\n`` only; texts and lines of any length are
processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, store, text_or_empty

DEPTH = 2
LEVELS = 2
MIN_DOCS = 10
MIN_TOKENS = 4
SIMILARITY = 0.6
#: fixed values: white space inside a line that is no single space, and a token that holds a digit (tried at token starts only, so linear in the text)
_INNER = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
_FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def masked_lines(text: Column) -> Column:
    """Array of a text's lines: variable fields masked, white space single and trimmed."""
    masked = lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, _FIELD, "<*>")).otherwise(x)
    return F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(masked(x), _INNER, " ")))


def _described(line: Column) -> list[Column]:
    n = (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("int")
    return [n.alias("n"), F.xxhash64(n, F.substring_index(line, " ", DEPTH)).alias("leaf"),
            F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _row_key(row: str = "row") -> list[Column]:
    text = text_or_empty(F.col(f"{row}.text"))
    return [F.xxhash64(f"{row}.doc_id", text).alias("k1"), F.xxhash64(F.lit(1), text, f"{row}.doc_id").alias("k2")]


def line_table(rows: DataFrame) -> DataFrame:
    """Stored ``k1, k2, no, n, leaf, h1, h2`` of every line, in one pass over the texts; no text is stored."""
    lines = rows.select("k1", "k2", F.posexplode(masked_lines(text_or_empty(F.col("row.text")))).alias("no", "line"))
    return store(lines.select("k1", "k2", "no", *_described(F.col("line"))), "line-table")


def marked_templates(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY, levels: int = LEVELS) -> DataFrame:
    """``h1, h2, sure, node`` of the masked lines that recur as themselves (``sure``) or may under the general template of ``node``."""
    once = lines.where(F.col("h1") != F.xxhash64(F.lit(""))).select("k1", "k2", "h1", "h2", "leaf", "n").distinct()  # all but blank lines
    counted = store(once.groupBy("h1", "h2", "leaf", "n").agg(F.count(F.lit(1)).alias("docs")), "line-templates")
    exact = counted.where(F.col("docs") >= min_docs).select("h1", "h2")

    nodes = _open_nodes(counted.where(F.col("n") >= min_tokens).withColumnRenamed("leaf", "node"), min_docs, "line-leaves")
    # the texts of the distinct lines in those leaves, with their counts
    texts = docs.select(F.explode(masked_lines(text_or_empty("text"))).alias("line")).select("line", *_described(F.col("line")))
    texts = texts.join(nodes.select(F.col("node").alias("leaf")), "leaf", "left_semi").select("line", "h1", "h2").distinct()
    open_lines = store(texts.join(counted.withColumnRenamed("leaf", "node"), ["h1", "h2"]), "line-open")
    found = None
    for level in range(levels + 1):
        weight = _token_weights(open_lines, nodes, min_docs)
        alike = _alike(open_lines, weight, min_docs, similarity)
        found = alike if found is None else found.unionByName(alike)
        if level < levels:
            open_lines = _split(open_lines, weight, alike, min_docs)
            nodes = _open_nodes(open_lines, min_docs, "line-nodes")
            open_lines = open_lines.join(nodes, "node", "left_semi")
    marks = exact.select("h1", "h2", F.lit(True).alias("sure"), F.lit(None).cast("long").alias("node"))
    marks = marks.unionByName(found.select("h1", "h2", F.lit(False).alias("sure"), "node"))
    return marks.groupBy("h1", "h2").agg(F.max("sure").alias("sure"), F.max("node").alias("node"))


def recurring_lines(lines: DataFrame, marks: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``k1, k2, no`` of every line that recurs, as itself or under a general template.

    A general template's documents are counted once each, however many of its
    lines they have, and only over lines that do not recur by themselves.
    """
    marks = store(marks, "line-marks")
    hits = store(lines.select("k1", "k2", "no", "h1", "h2").join(marks, ["h1", "h2"]).drop("h1", "h2"), "line-hits")
    reached = hits.where(~F.col("sure")).select("node", "k1", "k2").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("docs"))
    wide = reached.where(F.col("docs") >= min_docs).select("node").unionByName(marks.where("sure").select("node"))
    general = hits.where(~F.col("sure")).join(wide, "node", "left_semi")
    return hits.where("sure").unionByName(general.select(*hits.columns)).select("k1", "k2", "no")


def _open_nodes(lines: DataFrame, min_docs: int, tag: str) -> DataFrame:
    """``node, node_docs`` where several templates have ``min_docs`` documents between them."""
    nodes = lines.groupBy("node").agg(F.sum("docs").alias("node_docs"), F.count(F.lit(1)).alias("templates"))
    return store(nodes.where((F.col("node_docs") >= min_docs) & (F.col("templates") > 1)).select("node", "node_docs"), tag)


def _token_weights(lines: DataFrame, nodes: DataFrame, min_docs: int) -> DataFrame:
    """Stored ``node, pos, token, weight, constant`` of the tokens that are constants or can split a node."""
    tokens = lines.select("node", "docs", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    weight = tokens.groupBy("node", "pos", "token").agg(F.sum("docs").alias("weight")).join(nodes, "node")
    weight = weight.withColumn("constant", F.col("weight") * 2 > F.col("node_docs")).drop("node_docs")
    return store(weight.where(F.col("constant") | (F.col("weight") >= min_docs)), "line-tokens")


def _alike(lines: DataFrame, weight: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """Stored ``node, h1, h2, docs`` of the lines that agree with their node's constants, where there may be enough."""
    constant = weight.where("constant").select("node", "pos", "token")
    # a node whose constants are too few for any of its lines gives no general template
    sizes = constant.groupBy("node").agg(F.count(F.lit(1)).alias("constants"))
    able = lines.join(sizes, "node").where(F.col("constants") >= F.col("n") * F.lit(similarity))
    same = able.select("node", "n", "h1", "h2", "docs", F.posexplode(F.split("line", " ")).alias("pos", "token")).join(constant, ["node", "pos", "token"])
    like = same.groupBy("node", "n", "h1", "h2", "docs").agg(F.count(F.lit(1)).alias("equal")).where(F.col("equal") >= F.col("n") * F.lit(similarity))
    like = store(like.select("node", "h1", "h2", "docs"), "line-like")
    enough = like.groupBy("node").agg(F.sum("docs").alias("all")).where(F.col("all") >= min_docs)
    return like.join(enough, "node", "left_semi")


def _split(lines: DataFrame, weight: DataFrame, alike: DataFrame, min_docs: int) -> DataFrame:
    """The lines of no template, each in the child of its node that has its token at the position split."""
    own = weight.where(~F.col("constant") & (F.col("weight") >= min_docs))
    at = own.groupBy("node").agg(F.min_by("pos", F.struct(-F.col("weight"), "pos")).alias("pos"))
    known = own.join(at, ["node", "pos"]).select("node", "pos", "token", F.lit(True).alias("known"))
    rest = lines.join(alike, ["node", "h1", "h2"], "left_anti").join(at, "node")
    rest = rest.withColumn("token", F.split("line", " ")[F.col("pos")]).join(known, ["node", "pos", "token"], "left")
    child = F.xxhash64("node", "pos", F.when(F.col("known"), F.col("token")).otherwise(F.lit("")))
    return store(rest.select("line", "h1", "h2", "n", "docs", child.alias("node")), "line-split")


def drop_template_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY, levels: int = LEVELS) -> DataFrame:
    """``row`` (the input row), ``text`` without its recurring lines, ``n_lines`` and ``n_dropped``."""
    rows = packed(docs).select("row", *_row_key())
    lines = line_table(rows)
    marks = marked_templates(docs, lines, min_docs, min_tokens, similarity, levels)
    found = recurring_lines(lines, marks, min_docs)
    dropped = found.groupBy("k1", "k2").agg(F.collect_set("no").alias("numbers"))
    dropped = store(dropped, "line-dropped")
    out = rows.join(dropped, ["k1", "k2"], "left")
    parts = F.split(F.col("row.text"), "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("numbers"), i))
    return out.select("row", F.when(F.col("numbers").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                      F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("numbers"), F.lit(0)).cast("long").alias("n_dropped"))
