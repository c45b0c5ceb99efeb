"""Observation-shaped views derived from the driver's parquet tables.

The test tables are TPC-H-like; these builders turn them into the data model
of the library (observations, taxa dimension, elevation grid) with plain
column expressions, so every query's work grows with the tables. The same
views are given as SQL text (``VIEW_SQL``) for the DuckDB oracle; both sides
use only ``+ - *`` and ``%`` on doubles so they agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.geo import floor_div, wgs84_to_lv95
from ..session import table_path
from ..sources.raster import grid_to_strips


def _d(v: float):
    return F.lit(float(v))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def observations(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """``obs``: one observation per order, with dirty accuracy/grade/taxon values.

    Sites follow the customers (chains of 25 sites 300 m apart, ever more of
    them as the table grows); every tenth order stands at one hot site; some
    rows have no longitude, year or taxon. The taxon is the smallest part of the
    order's lines. ``dated`` gives an ``observed_on`` text instead of the year.
    """
    o = read_table(spark, sf_dir, "orders")
    parts = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("part"))
    o = o.join(parts, o.o_orderkey == parts.l_orderkey, "left")
    k = F.col("o_orderkey")
    away = F.least(k % 10, F.lit(1).cast(o.schema["o_orderkey"].dataType))  # 0 at the hot site: site 0 without scatter
    c = F.col("o_custkey") * away
    chain = (c - c % 25) / 25
    row = (c - c % 500) / 500
    lon = _d(7.0) + (c % 25) * _d(0.004) + (chain % 20) * _d(0.12) + ((k * 7919) % 1000 * away) * _d(0.0000013)
    lat = _d(46.0) + row * _d(0.01) + ((k * 104729) % 1000 * away) * _d(0.0000009)
    lon = F.when(k % 23 != 0, lon)
    acc = (F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.lit("abc"))
            .otherwise(((k * 31) % 250).cast("string")))
    grade = (F.when(k % 17 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderstatus") == "F", F.lit("research"))
              .when(F.col("o_orderstatus") == "O", F.lit("needs_id"))
              .otherwise(F.lit("casual")))
    taxon = F.when(k % 19 == 0, F.lit(None).cast("long")).otherwise(F.col("part"))
    year = F.when(k % 31 == 0, F.lit(None).cast("int")).otherwise(F.year("o_orderdate").cast("int"))
    day = lambda f: F.date_format("o_orderdate", f)
    text = (F.when(k % 4 == 0, day("dd/MM/yyyy")).when(k % 4 == 1, day("yyyy-MM-dd"))
             .when(k % 4 == 2, F.concat(day("yyyy-MM-dd"), F.lit("T00:30:00.125+02:00"))).otherwise(F.concat(day("yyyy/MM/dd"), F.lit(" 23:59"))))
    # inline() keeps the optimizer from repeating the site formula wherever a position is used
    place = F.inline(F.array(F.struct(lon.alias("longitude"), lat.alias("latitude"))))
    when = text.alias("observed_on") if dated else year.alias("year")
    obs = o.select(k.alias("observation_uuid"), acc.alias("positional_accuracy"), grade.alias("quality_grade"),
                   taxon.alias("taxon_id"), when, place)
    return obs.select("observation_uuid", "longitude", "latitude", "positional_accuracy", "quality_grade", "taxon_id", obs.columns[4])


def taxa_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``taxa``: the cached taxon dimension; one part in seven is not cached yet."""
    p = read_table(spark, sf_dir, "part")
    m = F.col("p_partkey") % 8
    iconic = (F.when(m == 0, "Plantae").when(m == 1, "Aves").when(m == 2, "Fungi")
               .when(m == 3, "Mammalia").when(m == 4, F.lit(None).cast("string"))
               .when(m == 5, "insecta").when(m == 6, "").otherwise("Animalia"))
    common = F.when(F.col("p_partkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name"))
    return p.where(F.col("p_partkey") % 7 != 3).select(
        F.col("p_partkey").alias("taxon_id"), iconic.alias("iconic_taxon_name"), common.alias("common_name"))


def taxa_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshly fetched taxon entries: the missing ones and some that are cached (upper-cased names), one without an id each 50."""
    p = read_table(spark, sf_dir, "part")
    m = F.col("p_partkey") % 4
    iconic = F.when(m == 0, "Plantae").when(m == 1, "Aves").when(m == 2, "Reptilia").otherwise("Chromista")
    key = F.when(F.col("p_partkey") % 50 == 0, F.lit(None).cast(p.schema["p_partkey"].dataType)).otherwise(F.col("p_partkey"))
    return p.where((F.col("p_partkey") % 7).isin(3, 4)).select(
        key.alias("taxon_id"), iconic.alias("iconic_taxon_name"), F.upper("p_name").alias("common_name"))


def projected(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    e, n = wgs84_to_lv95(F.col(lon), F.col(lat))
    return df.withColumn("E_lv95", e).withColumn("N_lv95", n)


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("te", floor_div("E_lv95", 1000.0)).withColumn("tn", floor_div("N_lv95", 1000.0))


def observed_tiles(spark: SparkSession, sf_dir: str, where) -> DataFrame:
    """Distinct ``(te, tn)`` of the observations that fulfil ``where``.

    The condition is tested on the aggregate's result: pushed below, it would
    repeat the whole projection formula in the filter.
    """
    t = keyed(projected(observations(spark, sf_dir))).groupBy("te", "tn").agg(F.max(where).alias("ok"))
    return t.where("ok").select("te", "tn")


NODATA = -9999.9


def dem_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dem_pixel``: 10 x 10 pixels of 100 m per 1 km tile around the observations.

    The missing-tile feature: tiles with ``(te + tn) % 9 = 0`` are absent. Every
    fifth tile is two columns narrower (points beside it are out of bounds),
    every fourth has an older vintage with other values, and pixels with
    ``(px * py) % 37 = 36`` hold a nodata value that no float equals.
    """
    te, tn = F.col("te"), F.col("tn")
    t = observed_tiles(spark, sf_dir, (te + tn) % 9 != 0)
    t = t.withColumn("n_cols", F.when((te + tn) % 5 == 0, 8).otherwise(10))
    t = t.withColumn("vintage", F.explode(F.when((te + tn) % 4 == 0, F.array(F.lit(2017), F.lit(2019))).otherwise(F.array(F.lit(2019)))))
    t = t.withColumn("px", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1))).withColumn("py", F.explode(F.sequence(F.lit(0), F.lit(9))))
    val = F.when((F.col("px") * F.col("py")) % 37 == 36, _d(NODATA)).otherwise(((te * 31 + tn * 17 + F.col("px") * 3 + F.col("py") * 7) % 4000) * _d(0.125))
    return t.select(
        F.concat_ws("-", te.cast("string"), tn.cast("string")).alias("tile_key"),
        (te * 1000).alias("x0"), (tn * 1000 + 1000).alias("y0"), "n_cols", "vintage",
        F.col("px").cast("int").alias("px"), F.col("py").cast("int").alias("py"),
        F.when(F.col("vintage") == 2017, _d(7777.0)).otherwise(val).alias("val"))


def dem_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(dem_tile, dem_strip) for the derived grid; strips come from the S6 ingest."""
    pix = dem_pixels(spark, sf_dir)
    tiles = pix.select("tile_key", "x0", "y0", "n_cols").distinct().select(
        "tile_key", F.col("x0").cast("double").alias("x0"), _d(100.0).alias("px_w"),
        F.col("y0").cast("double").alias("y0"), _d(-100.0).alias("px_h"),
        "n_cols", F.lit(10).alias("n_rows"), _d(NODATA).alias("nodata"),
        F.lit(2019).alias("vintage"),
        F.concat(F.lit("tiles/swissalti3d_2019_"), F.col("tile_key"), F.lit("_2_2056_5728.tif")).alias("path"))
    strips = grid_to_strips(pix.select("tile_key", "px", "py", "val", "vintage"), tiles)
    return tiles, strips


# --- the same views as SQL text (DuckDB oracle) --------------------------------

def _q(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


VIEW_SQL = {
    "obs": """
SELECT o_orderkey AS observation_uuid,
       CASE WHEN o_orderkey % 23 <> 0 THEN CAST(7.0 AS DOUBLE) + (site % 25) * CAST(0.004 AS DOUBLE)
                 + ((site // 25) % 20) * CAST(0.12 AS DOUBLE)
                 + ((o_orderkey * 7919) % 1000 * away) * CAST(0.0000013 AS DOUBLE) END AS longitude,
       CAST(46.0 AS DOUBLE) + (site // 500) * CAST(0.01 AS DOUBLE)
            + ((o_orderkey * 104729) % 1000 * away) * CAST(0.0000009 AS DOUBLE) AS latitude,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN 'abc'
            ELSE CAST((o_orderkey * 31) % 250 AS VARCHAR) END AS positional_accuracy,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderstatus = 'F' THEN 'research'
            WHEN o_orderstatus = 'O' THEN 'needs_id' ELSE 'casual' END AS quality_grade,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE part END AS taxon_id,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS year
FROM (SELECT *, least(o_orderkey % 10, 1) AS away, o_custkey * least(o_orderkey % 10, 1) AS site FROM orders) o
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "taxa": """
SELECT p_partkey AS taxon_id,
       CASE p_partkey % 8 WHEN 0 THEN 'Plantae' WHEN 1 THEN 'Aves'
            WHEN 2 THEN 'Fungi' WHEN 3 THEN 'Mammalia' WHEN 4 THEN NULL
            WHEN 5 THEN 'insecta' WHEN 6 THEN '' ELSE 'Animalia' END AS iconic_taxon_name,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END AS common_name
FROM part WHERE p_partkey % 7 <> 3""",
    "proj": f"""
SELECT * EXCLUDE (lo, la),
  {_q(geo.LV95_E0)} + {_q(geo.LV95_E_LON)}*lo - {_q(geo.LV95_E_LON_LAT)}*lo*la
    - {_q(geo.LV95_E_LON_LAT2)}*lo*(la*la) - {_q(geo.LV95_E_LON3)}*(lo*lo*lo) AS E_lv95,
  {_q(geo.LV95_N0)} + {_q(geo.LV95_N_LAT)}*la + {_q(geo.LV95_N_LON2)}*(lo*lo)
    + {_q(geo.LV95_N_LAT2)}*(la*la) - {_q(geo.LV95_N_LON2_LAT)}*(lo*lo)*la
    + {_q(geo.LV95_N_LAT3)}*(la*la*la) AS N_lv95
FROM (SELECT *, (longitude*CAST(3600 AS DOUBLE) - {_q(geo.LV95_LON_SHIFT_SEC)})/CAST(10000 AS DOUBLE) AS lo,
             (latitude*CAST(3600 AS DOUBLE) - {_q(geo.LV95_LAT_SHIFT_SEC)})/CAST(10000 AS DOUBLE) AS la
      FROM obs) q""",
    "keyed": """
SELECT *, CAST(floor(E_lv95 / CAST(1000 AS DOUBLE)) AS BIGINT) AS te,
          CAST(floor(N_lv95 / CAST(1000 AS DOUBLE)) AS BIGINT) AS tn
FROM proj""",
    "dem_pixel": """
SELECT CAST(t.te AS VARCHAR) || '-' || CAST(t.tn AS VARCHAR) AS tile_key,
       t.te*1000 AS x0, t.tn*1000+1000 AS y0, px.n_nationkey AS px, py.n_nationkey AS py,
       CASE WHEN (px.n_nationkey * py.n_nationkey) % 37 = 36 THEN NULL
            ELSE ((t.te*31 + t.tn*17 + px.n_nationkey*3 + py.n_nationkey*7) % 4000) * CAST(0.125 AS DOUBLE) END AS val
FROM (SELECT DISTINCT te, tn FROM keyed WHERE (te+tn) % 9 <> 0) t
JOIN nation px ON px.n_nationkey < CASE WHEN (t.te + t.tn) % 5 = 0 THEN 8 ELSE 10 END
JOIN nation py ON py.n_nationkey < 10""",
}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the named views (and what they depend on) as CTEs."""
    order = ["obs", "taxa", "proj", "keyed", "dem_pixel", "urls", "elev", "catalog"]
    deps = {"obs": [], "taxa": [], "proj": ["obs"], "keyed": ["proj"], "dem_pixel": ["keyed"],
            "urls": ["keyed"], "elev": ["keyed", "dem_pixel"], "catalog": []}
    need: set[str] = set()

    def add(v):
        if v in need:
            return
        need.add(v)
        for d in deps[v]:
            add(d)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({VIEW_SQL[v].strip()})" for v in order if v in need]
    if not ctes:
        return body.strip()
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("WITH RECURSIVE"):].lstrip()
    if body.upper().startswith("WITH"):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body


def tile_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download list ``(pos, url)`` derived from the observation tiles.

    Per observed tile: its own 2 m tile (vintage 2019), the 0.5 m tile east of
    it (vintage 2021) and a bare ``<key>.tif`` name that must never match.
    """
    t = observed_tiles(spark, sf_dir, F.col("te").isNotNull())
    v = t.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(2))))
    e = F.when(F.col("variant") == 1, F.col("te") + 1).otherwise(F.col("te"))
    key = F.concat_ws("-", e.cast("string"), F.col("tn").cast("string"))
    name = (F.when(F.col("variant") == 0, F.concat(F.lit("swissalti3d_2019_"), key, F.lit("_2_2056_5728.tif")))
             .when(F.col("variant") == 1, F.concat(F.lit("swissalti3d_2021_"), key, F.lit("_0.5_2056_5728.tif")))
             .otherwise(F.concat(key, F.lit(".tif"))))
    url = F.concat(F.lit("https://data.geo.example/swissalti3d/"), key, F.lit("/"), name)
    pos = (F.col("te") * 10000000 + F.col("tn")) * 4 + F.col("variant")
    return v.select(pos.alias("pos"), url.alias("url"))


def present_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names already downloaded: the raster files behind ``dem_tile``."""
    tiles, _ = dem_tables(spark, sf_dir)
    return tiles.select(F.element_at(F.split("path", "/"), -1).alias("name"))


VIEW_SQL["urls"] = """
SELECT (t.te * 10000000 + t.tn) * 4 + v.variant AS pos,
       'https://data.geo.example/swissalti3d/' || k.key || '/' ||
       CASE v.variant WHEN 0 THEN 'swissalti3d_2019_' || k.key || '_2_2056_5728.tif'
                      WHEN 1 THEN 'swissalti3d_2021_' || k.key || '_0.5_2056_5728.tif'
                      ELSE k.key || '.tif' END AS url
FROM (SELECT DISTINCT te, tn FROM keyed WHERE te IS NOT NULL) t
CROSS JOIN (SELECT n_nationkey AS variant FROM nation WHERE n_nationkey < 3) v
CROSS JOIN LATERAL (SELECT CAST(CASE WHEN v.variant = 1 THEN t.te + 1 ELSE t.te END AS VARCHAR)
                           || '-' || CAST(t.tn AS VARCHAR) AS key) k"""

VIEW_SQL["elev"] = """
SELECT k.* EXCLUDE (te, tn), d.val AS elevation_m
FROM keyed k LEFT JOIN dem_pixel d
  ON d.tile_key = CAST(k.te AS VARCHAR) || '-' || CAST(k.tn AS VARCHAR)
 AND d.px = CAST(trunc((k.E_lv95 - CAST(d.x0 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS INT)
 AND d.py = CAST(trunc((k.N_lv95 - CAST(d.y0 AS DOUBLE)) / CAST(-100 AS DOUBLE)) AS INT)"""


def dataset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset paths a pipeline run would have written, one per (year, priority, status) of ``orders``.

    The five priorities map to five naming shapes: filtered+enriched, several
    tags with ``needs_id``, enrichment only, ``enriched`` before ``filtered``,
    and a raw upper-case ``.CSV`` name.
    """
    o = read_table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), F.substring("o_orderpriority", 1, 1).alias("p"), "o_orderstatus").distinct()
    y = F.col("y").cast("string")
    s = F.lower(F.col("o_orderstatus"))
    name = (F.when(F.col("p") == "1", F.concat(F.lit("obs"), y, F.lit("_"), s, F.lit("_filtered_position_enriched_taxa.csv")))
             .when(F.col("p") == "2", F.concat(F.lit("obs"), y, F.lit("_filtered_position_grade_needs_id_"), s,
                                               F.lit("_enriched_taxa_elevation.csv")))
             .when(F.col("p") == "3", F.concat(F.lit("obs"), y, F.lit("_"), s, F.lit("_enriched_elevation.csv")))
             .when(F.col("p") == "4", F.concat(F.lit("Obs"), y, F.lit("_enriched_taxa_filtered_elevation_"), s, F.lit(".csv")))
             .otherwise(F.concat(F.lit("OBS"), y, F.lit("_"), s, F.lit(".CSV"))))
    return o.select(F.concat(F.lit("processed/"), name).alias("path"))


VIEW_SQL["catalog"] = """
SELECT 'processed/' || CASE p
  WHEN '1' THEN 'obs' || y || '_' || s || '_filtered_position_enriched_taxa.csv'
  WHEN '2' THEN 'obs' || y || '_filtered_position_grade_needs_id_' || s || '_enriched_taxa_elevation.csv'
  WHEN '3' THEN 'obs' || y || '_' || s || '_enriched_elevation.csv'
  WHEN '4' THEN 'Obs' || y || '_enriched_taxa_filtered_elevation_' || s || '.csv'
  ELSE 'OBS' || y || '_' || s || '.CSV' END AS path
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y, substring(o_orderpriority, 1, 1) AS p,
             lower(o_orderstatus) AS s FROM orders) q"""
