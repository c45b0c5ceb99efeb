"""Map-side summaries of a clustered table.

The map front end only reads these small tables; every one of them is an
aggregation that Spark pre-combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import cluster_fill, cluster_hue, cluster_stroke, display_label, normalise_grade

ALL_GRADES = "all"


def _clustered_rows(df: DataFrame, year: str) -> DataFrame:
    """rows in a cluster and with a year."""
    return df.where((F.col("cluster_id").isNotNull()) & (F.col("cluster_id") != -1) & F.col(year).isNotNull())


def taxon_counts(df: DataFrame, year: str = "cluster_year") -> DataFrame:
    """``(grade_key, year, cluster_id, label, n_obs)``.

    Every row counts under ``all`` and again under its grade when the grade is
    valid. Counts are pre-aggregated per grade first; the ``all`` copy is made on
    that small result (not GROUPING SETS, whose null-grade group would differ).
    """
    base = _clustered_rows(df, year).select(
        F.col(year).alias("year"), "cluster_id",
        normalise_grade(F.col("quality_grade")).alias("grade"),
        display_label(F.col("common_name"), F.col("iconic_taxon_name"), F.col("group")).alias("label"))
    pre = base.groupBy("grade", "year", "cluster_id", "label").agg(F.count(F.lit(1)).alias("n"))
    keys = F.array_compact(F.array(F.lit(ALL_GRADES), F.col("grade")))
    return (pre.select(F.explode(keys).alias("grade_key"), "year", "cluster_id", "label", "n")
               .groupBy("grade_key", "year", "cluster_id", "label").agg(F.sum("n").alias("n_obs")))


def top_taxa(counts: DataFrame, k: int | None = None) -> DataFrame:
    """Labels ranked by count (descending, then label) per grade, year and cluster."""
    w = Window.partitionBy("grade_key", "year", "cluster_id").orderBy(F.desc("n_obs"), F.asc("label"))
    r = counts.withColumn("rank", F.row_number().over(w))
    return r.where(F.col("rank") <= k) if k else r


def available_grades(df: DataFrame, year: str = "cluster_year") -> DataFrame:
    """Valid grades present among clustered rows."""
    g = normalise_grade(F.col("quality_grade"))
    return _clustered_rows(df, year).select(g.alias("grade")).where(F.col("grade").isNotNull()).distinct()


def year_list(features: DataFrame) -> DataFrame:
    """A10: the feature years (ascending, comma-joined), their count, min and max."""
    ys = F.sort_array(F.collect_set("year"))
    return features.agg(F.array_join(ys, ",").alias("years"), F.size(ys).alias("n_years"),
                        F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def bounds(df: DataFrame, eps: float, year: str = "cluster_year", e: str = "E_lv95", n: str = "N_lv95") -> DataFrame:
    """Footprint envelope per year plus the overall one (``year`` null), in LV95.

    A footprint is a union of radius-eps discs, so its envelope is the points'
    envelope grown by eps.
    """
    rows = _clustered_rows(df, year)
    return (rows.rollup(F.col(year).alias("year"))
                .agg((F.min(e) - F.lit(eps)).alias("min_e"), (F.min(n) - F.lit(eps)).alias("min_n"),
                     (F.max(e) + F.lit(eps)).alias("max_e"), (F.max(n) + F.lit(eps)).alias("max_n")))


def visible_features(features: DataFrame, counts: DataFrame, grade: str | None = None) -> DataFrame:
    """Features with a non-empty count for the selected grade (default ``all``)."""
    key = grade or ALL_GRADES
    have = counts.where((F.col("grade_key") == key) & (F.col("n_obs") > 0)).select("year", "cluster_id")
    return features.join(have, ["year", "cluster_id"], "left_semi")


def visible_bounds(vertices: DataFrame, features: DataFrame, counts: DataFrame, grade: str | None = None,
                   x: str = "x", y: str = "y") -> DataFrame:
    """``(year, west, south, east, north, n_features)`` of the shown layer per year, and of all years (``year`` null).

    ``vertices``: the simplified footprints by ``cluster_id``, in lon/lat for the
    map. Features without an observation of the grade do not count; a year
    without a shown feature has no row; if none is shown at all there is no row.
    """
    shown = visible_features(features.select("year", "cluster_id").distinct(), counts, grade)
    return (vertices.select("cluster_id", F.col(x).alias("_x"), F.col(y).alias("_y"))
                    .groupBy("cluster_id").agg(F.min("_x").alias("w"), F.min("_y").alias("s"), F.max("_x").alias("e"), F.max("_y").alias("n"))
                    .join(shown, "cluster_id").rollup("year")
                    .agg(F.min("w").alias("west"), F.min("s").alias("south"), F.max("e").alias("east"), F.max("n").alias("north"),
                         F.count(F.lit(1)).alias("n_features")))


def cluster_style(features: DataFrame) -> DataFrame:
    """Hue, stroke and fill colour per feature."""
    return features.select("year", "cluster_id", cluster_hue("cluster_id").alias("hue"),
                           cluster_stroke("cluster_id").alias("stroke"), cluster_fill("cluster_id").alias("fill"))
