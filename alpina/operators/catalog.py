"""Dataset-catalog operators (N1-N4, O2): one row per dataset path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import section_tags, selection_tags


def with_tags(catalog: DataFrame, path: str = "path") -> DataFrame:
    """N1 + N2 columns: selection tags and section tags (prefix kept)."""
    f, e = selection_tags(F.col(path))
    s = section_tags(F.col(path))
    return catalog.withColumn("sel_filters", f).withColumn("sel_enrichments", e) \
                  .withColumn("prefix", s["prefix"]).withColumn("filters", s["filters"]) \
                  .withColumn("enrichments", s["enrichments"])


def best_dataset(catalog: DataFrame, path: str = "path", exclude_filter=(), include_filter=(),
                 exclude_enrich=(), include_enrich=(), raw_default: str | None = None) -> DataFrame:
    """N4 + O2: the CSV with most filter tags, then most enrichment tags, honouring the
    include/exclude lists; ties broken by path. No candidate -> ``raw_default`` or error."""
    lit_arr = lambda xs: F.array(*[F.lit(x.lower()) for x in xs]) if xs else F.array().cast("array<string>")
    f, e = selection_tags(F.col(path))
    c = catalog.where(F.col(path).endswith(".csv")).select(path, f.alias("f"), e.alias("e"))
    if exclude_filter:
        c = c.where(~F.arrays_overlap(F.col("f"), lit_arr(exclude_filter)))
    if exclude_enrich:
        c = c.where(~F.arrays_overlap(F.col("e"), lit_arr(exclude_enrich)))
    if include_filter:
        c = c.where(F.size(F.array_except(lit_arr(include_filter), F.col("f"))) == 0)
    if include_enrich:
        c = c.where(F.size(F.array_except(lit_arr(include_enrich), F.col("e"))) == 0)
    best = c.select(path, F.size("f").alias("n_filters"), F.size("e").alias("n_enrichments")) \
            .orderBy(F.desc("n_filters"), F.desc("n_enrichments"), F.asc(path)).limit(1)
    # one row at most: collected once, so the choice and its error cost one run
    found = best.collect()
    if not found and raw_default is None:
        raise ValueError("no dataset fits and there is no default")
    rows = [tuple(r) for r in found] or [(raw_default, 0, 0)]
    return catalog.sparkSession.createDataFrame(rows, f"{path} string, n_filters int, n_enrichments int")
