"""The end-to-end clustering plan, composed from the operators.

observations -> accuracy filter -> taxa -> elevation -> year -> LV95 ->
per-year DBSCAN -> (labelled rows, cluster summary, footprints, taxon counts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.dbscan import cluster_summary, dbscan
from ..operators.elevation import enrich_elevation
from ..operators.summary import taxon_counts
from ..operators.taxa import enrich_taxa
from ..session import cut_lineage
from . import fixtures as fx


@dataclass
class PipelineParams:
    max_accuracy: float = 100.0
    eps: float = 500.0
    min_samples: int = 10
    use_altitude: bool = False
    alt_scale: float = 1.0


def with_altitude(df: DataFrame, alt_scale: float = 1.0, elev: str = "elevation_m") -> tuple[DataFrame, list[str]]:
    """A4 + P8: the rows and the coordinates to cluster on.

    Altitude, divided by ``alt_scale``, is a third coordinate only if every row
    has one; otherwise clustering falls back to two.
    """
    flat = ["E_lv95", "N_lv95"]
    missing = df.where(F.col(elev).isNull()).isEmpty() is False if elev in df.columns else True
    if missing:
        return df, flat
    return df.withColumn("z", F.col(elev) / F.lit(float(alt_scale))), [*flat, "z"]


def with_z(df: DataFrame, alt_scale: float = 1.0, elev: str = "elevation_m") -> DataFrame:
    """A4 + P8 inside the plan: column ``z``, the altitude divided by ``alt_scale`` if every row has one, else 0 in all rows.

    The rows are stored first, and the question is a scalar subquery over the
    altitude column of that table: whatever made the rows runs once. With 0
    everywhere distances are those of two dimensions.
    """
    df = cut_lineage(df)
    if elev not in df.columns:
        return df.withColumn("z", F.lit(0.0))
    partial = df.agg(F.coalesce(F.bool_or(F.col(elev).isNull()), F.lit(False)).alias("partial")).scalar()
    return df.withColumn("z", F.when(partial, F.lit(0.0)).otherwise(F.col(elev) / F.lit(float(alt_scale))))


def cluster_observations(obs: DataFrame, taxa: DataFrame, dem_tile: DataFrame, dem_strip: DataFrame,
                         p: PipelineParams) -> DataFrame:
    """Labelled rows: the input columns plus taxa, elevation, year, LV95 and cluster ids."""
    x = quality.filter_position(obs, p.max_accuracy)
    x = enrich_taxa(x, taxa)
    x = enrich_elevation(x, dem_tile, dem_strip)
    x = quality.with_year(fx.projected(x))
    dims = ["E_lv95", "N_lv95"]
    if p.use_altitude:
        x, dims = with_z(x, p.alt_scale), [*dims, "z"]
    return dbscan(x, p.eps, p.min_samples, dims=dims, frozen=p.use_altitude)


def flagship(spark: SparkSession, sf_dir: str, p: PipelineParams | None = None) -> DataFrame:
    """Taxon counts per (grade, year, cluster, label) for the clustered observations."""
    p = p or PipelineParams()
    tiles, strips = fx.dem_tables(spark, sf_dir)
    c = cluster_observations(fx.observations(spark, sf_dir), fx.taxa_cache(spark, sf_dir), tiles, strips, p)
    return taxon_counts(c)


def flagship_outputs(spark: SparkSession, sf_dir: str, p: PipelineParams | None = None) -> dict[str, DataFrame]:
    p = p or PipelineParams()
    tiles, strips = fx.dem_tables(spark, sf_dir)
    c = cluster_observations(fx.observations(spark, sf_dir), fx.taxa_cache(spark, sf_dir), tiles, strips, p)
    return {"clustered": c, "summary": cluster_summary(c), "taxon_counts": taxon_counts(c)}
