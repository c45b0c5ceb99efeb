"""Elevation sampling from strip tables.

point -> LV95 -> tile key -> header lookup (geotransform) -> pixel (px, py)
-> equi-join on ``(tile_key, py)`` with ``dem_strip`` -> ``vals[px]``.
Missing tile, out-of-bounds pixel, nodata or unparseable coordinates give
null; values are rounded half-even to 3 decimals. The points are evaluated once:
those without a pixel get salted keys that no strip has, so they spread over the
tasks of the strip join. Strips stored by ``sources.raster.store_strips`` are
bucketed and sorted by the join's keys and need no exchange there. Spark's size
threshold and AQE choose the join strategies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import column_type, to_double
from ..functions.geo import pixel_index, tile_key, wgs84_to_lv95
from .quality import resolve_lon_lat


def with_tile_key(obs: DataFrame, lon: str | None = None, lat: str | None = None,
                  e_col: str = "_E", n_col: str = "_N", key_col: str = "_tk") -> DataFrame:
    lon, lat = resolve_lon_lat(obs, lon, lat)
    lo = to_double(F.col(lon), column_type(obs, lon))
    la = to_double(F.col(lat), column_type(obs, lat))
    e, n = wgs84_to_lv95(lo, la)
    return obs.withColumn(e_col, e).withColumn(n_col, n).withColumn(key_col, tile_key(F.col(e_col), F.col(n_col)))


def enrich_elevation(obs: DataFrame, dem_tile: DataFrame, dem_strip: DataFrame,
                     lon: str | None = None, lat: str | None = None, out: str = "elevation_m") -> DataFrame:
    """Add (or recompute) ``out`` for every row; the row set is unchanged."""
    cols = list(obs.columns)
    base = obs.drop(out) if out in cols else obs
    pts = with_tile_key(base, lon, lat)
    hdr = dem_tile.select(F.col("tile_key").alias("_tk"), F.col("x0").alias("_x0"), F.col("px_w").alias("_pw"),
                          F.col("y0").alias("_y0"), F.col("px_h").alias("_ph"), F.col("n_cols").alias("_nc"),
                          F.col("n_rows").alias("_nr"), F.col("nodata").alias("_nd"))
    j = pts.join(hdr, "_tk", "left")
    px = pixel_index("_E", "_x0", "_pw")
    py = pixel_index("_N", "_y0", "_ph")
    inb = (px >= 0) & (px < F.col("_nc")) & (py >= 0) & (py < F.col("_nr"))
    j = j.withColumn("_px", F.when(inb, px)).withColumn("_py", F.when(inb, py))
    inside = F.col("_py").isNotNull() & F.col("_tk").isNotNull()
    salt = (-1 - F.pmod(F.xxhash64(*_hashable(pts)), F.lit(1_000_000))).cast("int")
    # the key types are the strips' own: a cast on their side would cost the bucketing
    kind = dem_strip.schema["py"].dataType
    j = j.withColumn("_sk", F.when(inside, F.col("_tk")).otherwise(F.lit(""))).withColumn("_sp", F.when(inside, F.col("_py")).otherwise(salt).cast(kind))
    strips = dem_strip.select(F.col("tile_key").alias("_sk"), F.col("py").alias("_sp"), F.col("vals").alias("_vals"))
    j = j.join(strips, ["_sk", "_sp"], "left")
    # strips hold floats: the nodata value is compared as one
    v = F.try_element_at(F.col("_vals"), F.col("_px") + 1)
    elev = F.when(v.isNotNull() & (F.col("_nd").isNull() | (v != F.col("_nd").cast("float"))), F.bround(v.cast("double"), 3))
    j = j.withColumn(out, elev)
    order = cols if out in cols else cols + [out]
    return j.select(*order)


def _hashable(df: DataFrame) -> list:
    """Columns that Spark can hash (maps and variants have no hash)."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]


def elevation_coverage(obs: DataFrame, dem_tile: DataFrame, lon: str | None = None,
                       lat: str | None = None) -> DataFrame:
    """A3: points per needed tile and whether the tile is available."""
    pts = with_tile_key(obs, lon, lat).where(F.col("_tk").isNotNull())
    per_tile = pts.groupBy(F.col("_tk").alias("tile_key")).agg(F.count(F.lit(1)).alias("n_points"))
    have = dem_tile.select("tile_key").distinct().withColumn("has_tile", F.lit(True))
    return per_tile.join(have, "tile_key", "left").select(
        "tile_key", "n_points", F.coalesce("has_tile", F.lit(False)).alias("has_tile"))
