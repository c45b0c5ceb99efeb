"""Registered queries: one DataFrame plan per operator family, with the
equivalent DuckDB SQL used as the correctness oracle.

Every query reads the driver's parquet tables (through the views of
:mod:`alpina.plans.fixtures`) in full. The views drop rows by residue class
only where absence is the feature: taxa not yet cached, tiles not there.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.geo import tile_key as tile_key_col
from ..operators import quality, taxa as taxa_ops
from . import fixtures as fx
from .fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views)
        return fn
    return deco


# --- shared SQL fragments --------------------------------------------------------

def _listed(values: list[str], sep: str = ",") -> str:
    return sep.join(f"'{v}'" for v in values)


GROUP_SQL = f"""CASE WHEN lower({{c}}) = '{labels.FLORA_CLASS}' THEN '{labels.GROUP_FLORA}'
     WHEN lower({{c}}) IN ({_listed(labels.FAUNA_CLASSES)}) THEN '{labels.GROUP_FAUNA}'
     WHEN coalesce(length({{c}}), 0) > 0 THEN '{labels.GROUP_OTHER}' ELSE '{labels.GROUP_UNKNOWN}' END"""


# --- filters, projections (F1-F3, P4, P6, P7) --------------------------------------

@register("filter_position",
          "SELECT * FROM obs WHERE TRY_CAST(positional_accuracy AS DOUBLE) <= 100", ("obs",))
def q_filter_position(spark, sf):
    return quality.filter_position(fx.observations(spark, sf), 100.0)


@register("filter_grade", "SELECT * FROM obs WHERE quality_grade IN ('research')", ("obs",))
def q_filter_grade(spark, sf):
    return quality.filter_grade(fx.observations(spark, sf), ["research"])


@register("project_lv95",
          "SELECT observation_uuid, round(E_lv95, 3) AS E_lv95, round(N_lv95, 3) AS N_lv95 FROM proj",
          ("proj",))
def q_project_lv95(spark, sf):
    p = fx.projected(fx.observations(spark, sf))
    return p.select("observation_uuid", F.round("E_lv95", 3).alias("E_lv95"), F.round("N_lv95", 3).alias("N_lv95"))


@register("tile_key",
          "SELECT observation_uuid, CAST(te AS VARCHAR) || '-' || CAST(tn AS VARCHAR) AS tile_key FROM keyed",
          ("keyed",))
def q_tile_key(spark, sf):
    p = fx.projected(fx.observations(spark, sf))
    return p.select("observation_uuid", tile_key_col("E_lv95", "N_lv95").alias("tile_key"))


@register("extract_year", """
SELECT o_orderkey AS observation_uuid, CAST(year(o_orderdate) AS INT) AS cluster_year FROM orders""")
def q_extract_year(spark, sf):
    # the texts carry offsets and times of day; the year must be that of the date as written
    return quality.with_year(fx.observations(spark, sf, dated=True)).select("observation_uuid", "cluster_year")


# --- taxa (J1, P10, J8, W2, K2) -------------------------------------------------

@register("enrich_taxa", f"""
SELECT o.observation_uuid, o.taxon_id, t.iconic_taxon_name, t.common_name,
       {GROUP_SQL.format(c='t.iconic_taxon_name')} AS "group"
FROM obs o LEFT JOIN taxa t ON o.taxon_id = t.taxon_id""", ("obs", "taxa"))
def q_enrich_taxa(spark, sf):
    e = taxa_ops.enrich_taxa(fx.observations(spark, sf), fx.taxa_cache(spark, sf))
    return e.select("observation_uuid", "taxon_id", "iconic_taxon_name", "common_name", "group")


@register("taxon_groups", f"""
SELECT g AS "group", count(*) AS n_obs FROM (
  SELECT {GROUP_SQL.format(c='t.iconic_taxon_name')} AS g
  FROM obs o LEFT JOIN taxa t ON o.taxon_id = t.taxon_id) q
GROUP BY g""", ("obs", "taxa"))
def q_taxon_groups(spark, sf):
    e = taxa_ops.enrich_taxa(fx.observations(spark, sf), fx.taxa_cache(spark, sf))
    return e.groupBy("group").agg(F.count(F.lit(1)).alias("n_obs"))


@register("taxa_missing", """
SELECT DISTINCT taxon_id FROM obs
WHERE taxon_id IS NOT NULL AND taxon_id NOT IN (SELECT taxon_id FROM taxa)""", ("obs", "taxa"))
def q_taxa_missing(spark, sf):
    return taxa_ops.missing_taxa(fx.observations(spark, sf), fx.taxa_cache(spark, sf))


@register("taxa_cached", "SELECT * FROM taxa WHERE taxon_id IN (SELECT taxon_id FROM obs)", ("obs", "taxa"))
def q_taxa_cached(spark, sf):
    return taxa_ops.cached_taxa_for(fx.observations(spark, sf), fx.taxa_cache(spark, sf))


@register("taxa_batches", """
SELECT taxon_id, CAST((rn - 1) // 300 * 2 + ((rn - 1) % 300) // 200 AS BIGINT) AS batch_no,
       CAST(((rn - 1) % 300) % 200 AS INT) AS pos_in_batch
FROM (SELECT taxon_id, row_number() OVER (ORDER BY taxon_id) AS rn
      FROM (SELECT DISTINCT taxon_id FROM obs WHERE taxon_id IS NOT NULL) d) q""", ("obs",))
def q_taxa_batches(spark, sf):
    return taxa_ops.request_batches(taxa_ops.required_taxon_ids(fx.observations(spark, sf)), 300)


@register("taxa_upsert", """
WITH fresh AS (
  SELECT p_partkey AS taxon_id,
         CASE p_partkey % 4 WHEN 0 THEN 'Plantae' WHEN 1 THEN 'Aves' WHEN 2 THEN 'Reptilia'
              ELSE 'Chromista' END AS iconic_taxon_name,
         upper(p_name) AS common_name
  FROM part WHERE p_partkey % 7 IN (3, 4) AND p_partkey % 50 <> 0)
SELECT * FROM fresh
UNION ALL
SELECT * FROM taxa WHERE taxon_id NOT IN (SELECT taxon_id FROM fresh)""", ("taxa",))
def q_taxa_upsert(spark, sf):
    return taxa_ops.upsert_taxa(fx.taxa_cache(spark, sf), fx.taxa_fetched(spark, sf))


# --- elevation (J2, A3, F2) -------------------------------------------------------

def _elevated(spark, sf):
    from ..operators.elevation import enrich_elevation
    tiles, strips = fx.dem_tables(spark, sf)
    return enrich_elevation(fx.observations(spark, sf), tiles, strips)


@register("enrich_elevation", "SELECT observation_uuid, elevation_m FROM elev", ("elev",))
def q_enrich_elevation(spark, sf):
    return _elevated(spark, sf).select("observation_uuid", "elevation_m")


@register("enrich_elevation_bucketed", "SELECT observation_uuid, elevation_m FROM elev", ("elev",))
def q_enrich_elevation_bucketed(spark, sf):
    from ..operators.elevation import enrich_elevation
    from ..session import shared_path
    from ..sources.raster import store_strips
    tiles, strips = fx.dem_tables(spark, sf)
    path = shared_path(spark, "dem-strips")
    table = store_strips(strips, path.rsplit("/", 1)[-1].replace("-", "_"), int(spark.conf.get("spark.sql.shuffle.partitions")), path)
    return enrich_elevation(fx.observations(spark, sf), tiles, table).select("observation_uuid", "elevation_m")


@register("filter_elevation", """
SELECT observation_uuid, longitude, latitude, positional_accuracy, quality_grade, taxon_id, year, elevation_m
FROM elev WHERE elevation_m IS NOT NULL""", ("elev",))
def q_filter_elevation(spark, sf):
    return quality.filter_elevation(_elevated(spark, sf))


@register("elevation_coverage", """
SELECT k.tile_key, count(*) AS n_points, (d.tile_key IS NOT NULL) AS has_tile
FROM (SELECT CAST(te AS VARCHAR) || '-' || CAST(tn AS VARCHAR) AS tile_key FROM keyed WHERE te IS NOT NULL) k
LEFT JOIN (SELECT DISTINCT tile_key FROM dem_pixel) d ON d.tile_key = k.tile_key
GROUP BY k.tile_key, d.tile_key""", ("keyed", "dem_pixel"))
def q_elevation_coverage(spark, sf):
    from ..operators.elevation import elevation_coverage
    tiles, _ = fx.dem_tables(spark, sf)
    return elevation_coverage(fx.observations(spark, sf), tiles)


# --- tiles (A2, J6, J7) ----------------------------------------------------------

@register("tiles_needed",
          "SELECT DISTINCT CAST(te AS VARCHAR) || '-' || CAST(tn AS VARCHAR) AS tile_key FROM keyed WHERE te IS NOT NULL", ("keyed",))
def q_tiles_needed(spark, sf):
    from ..operators.tiles import tiles_needed
    return tiles_needed(fx.observations(spark, sf))


@register("tile_urls_needed", """
SELECT u.pos, u.url FROM urls u
WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT CAST(te AS VARCHAR) || '-' || CAST(tn AS VARCHAR) AS k FROM keyed WHERE te IS NOT NULL) n
              WHERE contains(regexp_extract(u.url, '[^/]*$'), '_' || n.k || '_'))""", ("urls",))
def q_tile_urls_needed(spark, sf):
    from ..operators.tiles import tiles_needed, urls_needed
    return urls_needed(fx.tile_urls(spark, sf), tiles_needed(fx.observations(spark, sf)))


@register("tile_urls_missing", """
SELECT u.pos, u.url FROM urls u
WHERE regexp_extract(u.url, '[^/]*$') NOT IN (
  SELECT 'swissalti3d_2019_' || tile_key || '_2_2056_5728.tif' FROM (SELECT DISTINCT tile_key FROM dem_pixel) d)""",
          ("urls", "dem_pixel"))
def q_tile_urls_missing(spark, sf):
    from ..operators.tiles import urls_missing
    return urls_missing(fx.tile_urls(spark, sf), fx.present_tiles(spark, sf))


# --- combine (J4, J5) -----------------------------------------------------------------

def _combine_inputs(spark, sf):
    obs = fx.observations(spark, sf)
    a = quality.filter_position(obs, 100.0).select("observation_uuid", "longitude", "latitude", "positional_accuracy")
    b = quality.filter_grade(obs, ["research", "needs_id"]).select(
        "observation_uuid", "quality_grade", "taxon_id", F.lit(None).cast("string").alias("positional_accuracy"))
    c = taxa_ops.enrich_taxa(obs, fx.taxa_cache(spark, sf)).where(F.col("group") != "unknown").select(
        "observation_uuid", "taxon_id", "group", "year", "latitude")
    return [a, b, c]


COMBINE_SQL = """
WITH a AS (SELECT observation_uuid, longitude, latitude, positional_accuracy FROM obs
           WHERE TRY_CAST(positional_accuracy AS DOUBLE) <= 100),
b AS (SELECT observation_uuid, quality_grade, taxon_id, CAST(NULL AS VARCHAR) AS positional_accuracy FROM obs
      WHERE quality_grade IN ('research', 'needs_id')),
c AS (SELECT * FROM (SELECT o.observation_uuid, o.taxon_id, {grp} AS "group", o.year, o.latitude
                     FROM obs o LEFT JOIN taxa t ON o.taxon_id = t.taxon_id) q WHERE "group" <> 'unknown')
SELECT coalesce(a.observation_uuid, b.observation_uuid, c.observation_uuid) AS observation_uuid,
       a.longitude, coalesce(a.latitude, c.latitude) AS latitude,
       coalesce(a.positional_accuracy, b.positional_accuracy) AS positional_accuracy,
       b.quality_grade, coalesce(b.taxon_id, c.taxon_id) AS taxon_id, c."group", c.year
FROM a {j} JOIN b ON a.observation_uuid = b.observation_uuid
{j} JOIN c ON coalesce(a.observation_uuid, b.observation_uuid) = c.observation_uuid"""


@register("combine_union", COMBINE_SQL.format(grp=GROUP_SQL.format(c="t.iconic_taxon_name"), j="FULL"),
          ("obs", "taxa"))
def q_combine_union(spark, sf):
    from ..operators.combine import combine
    return combine(_combine_inputs(spark, sf), how="union")


@register("combine_intersect", COMBINE_SQL.format(grp=GROUP_SQL.format(c="t.iconic_taxon_name"), j="INNER"),
          ("obs", "taxa"))
def q_combine_intersect(spark, sf):
    from ..operators.combine import combine
    return combine(_combine_inputs(spark, sf), how="intersect")


# --- clustering (J13, C1, C2, A6) ---------------------------------------------------

EPS = 500.0
MIN_SAMPLES = 6


def dbscan_sql(points_cte: str, rows_cte: str, eps: float, min_samples: int, three_d: bool) -> str:
    """Recursive-CTE DBSCAN: pairs -> core -> smallest reachable core id -> borders -> numbering."""
    z = " + (a.z - b.z) * (a.z - b.z)" if three_d else ""
    return f"""
WITH RECURSIVE pts AS ({points_cte}),
allrows AS ({rows_cte}),
nb AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON a.yr = b.yr
       AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y){z} <= CAST({eps * eps} AS DOUBLE)),
core AS (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= {min_samples}),
ce AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON nb.a = c1.id JOIN core c2 ON nb.b = c2.id),
reach(id, root) AS (
  SELECT id, id FROM core
  UNION
  SELECT ce.b, reach.root FROM reach JOIN ce ON ce.a = reach.id WHERE reach.root < ce.b),
croot AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
broot AS (SELECT nb.a AS id, min(croot.root) AS root FROM nb JOIN croot ON nb.b = croot.id
          WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a),
lab AS (SELECT id, root FROM croot UNION ALL SELECT id, root FROM broot),
cl AS (SELECT DISTINCT p.yr, lab.root FROM lab JOIN pts p ON p.id = lab.id),
num AS (SELECT yr, root,
               CAST(dense_rank() OVER (PARTITION BY yr ORDER BY root) - 1 AS INT) AS cluster_local_id,
               CAST(dense_rank() OVER (ORDER BY yr, root) - 1 AS INT) AS cluster_id FROM cl)
SELECT r.*, coalesce(num.cluster_local_id, -1) AS cluster_local_id, coalesce(num.cluster_id, -1) AS cluster_id
FROM allrows r LEFT JOIN lab ON lab.id = r.observation_uuid
LEFT JOIN num ON num.root = lab.root AND num.yr = r.cluster_year"""


def _clustered_2d(spark, sf):
    from ..operators.dbscan import dbscan
    p = quality.with_year(fx.projected(fx.observations(spark, sf)))
    return dbscan(p, EPS, MIN_SAMPLES)


def _clustered_3d(spark, sf):
    from ..operators.dbscan import dbscan
    e = quality.filter_elevation(_elevated(spark, sf))
    p = quality.with_year(fx.projected(e)).withColumn("z", F.col("elevation_m") / F.lit(1.0))
    return dbscan(p, EPS, MIN_SAMPLES, dims=["E_lv95", "N_lv95", "z"])


@register("eps_neighbours", f"""
SELECT a.observation_uuid, count(*) AS n_neighbours
FROM proj a JOIN proj b ON a.year = b.year
 AND (a.E_lv95 - b.E_lv95) * (a.E_lv95 - b.E_lv95) + (a.N_lv95 - b.N_lv95) * (a.N_lv95 - b.N_lv95)
     <= CAST({EPS * EPS} AS DOUBLE)
GROUP BY a.observation_uuid""", ("proj",))
def q_eps_neighbours(spark, sf):
    from ..operators.neighbours import neighbour_counts
    p = fx.projected(fx.observations(spark, sf)).where(F.col("year").isNotNull() & F.col("E_lv95").isNotNull())
    return neighbour_counts(p, EPS, "observation_uuid", "year", ["E_lv95", "N_lv95"]) \
        .select("observation_uuid", "n_neighbours")


@register("dbscan_2d", dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y FROM proj WHERE year IS NOT NULL AND E_lv95 IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year FROM proj", EPS, MIN_SAMPLES, False), ("proj",))
def q_dbscan_2d(spark, sf):
    return _clustered_2d(spark, sf).select("observation_uuid", "cluster_year", "cluster_local_id", "cluster_id")


@register("dbscan_3d", dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y, elevation_m / CAST(1.0 AS DOUBLE) AS z "
    "FROM elev WHERE year IS NOT NULL AND elevation_m IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year FROM elev WHERE elevation_m IS NOT NULL",
    EPS, MIN_SAMPLES, True), ("elev",))
def q_dbscan_3d(spark, sf):
    return _clustered_3d(spark, sf).select("observation_uuid", "cluster_year", "cluster_local_id", "cluster_id")


@register("dbscan_scaled_altitude", dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y, elevation_m / CAST(2.5 AS DOUBLE) AS z "
    "FROM elev WHERE year IS NOT NULL AND elevation_m IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year FROM elev WHERE elevation_m IS NOT NULL",
    EPS, MIN_SAMPLES, True), ("elev",))
def q_dbscan_scaled_altitude(spark, sf):
    return _clustered_with_z(quality.filter_elevation(_elevated(spark, sf)))


# some rows have no altitude, so it counts for none
@register("dbscan_partial_altitude", dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y FROM elev WHERE year IS NOT NULL AND E_lv95 IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year FROM elev", EPS, MIN_SAMPLES, False), ("elev",))
def q_dbscan_partial_altitude(spark, sf):
    return _clustered_with_z(_elevated(spark, sf))


def _clustered_with_z(elevated):
    from ..operators.dbscan import dbscan
    from .pipeline import with_z
    p = with_z(quality.with_year(fx.projected(elevated)), 2.5)
    return dbscan(p, EPS, MIN_SAMPLES, dims=["E_lv95", "N_lv95", "z"], frozen=True).select("observation_uuid", "cluster_year", "cluster_local_id", "cluster_id")


@register("cluster_summary", """
WITH c AS (""" + dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y, elevation_m / CAST(1.0 AS DOUBLE) AS z "
    "FROM elev WHERE year IS NOT NULL AND elevation_m IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year, elevation_m FROM elev WHERE elevation_m IS NOT NULL",
    EPS, MIN_SAMPLES, True) + """)
SELECT cluster_year AS year, cluster_id, count(*) AS n_points, round(avg(elevation_m), 6) AS alt_mean,
       min(cluster_local_id) AS cluster_local_id
FROM c WHERE cluster_id <> -1 GROUP BY cluster_year, cluster_id""", ("elev",))
def q_cluster_summary(spark, sf):
    from ..operators.dbscan import cluster_summary
    s = cluster_summary(_clustered_3d(spark, sf))
    return s.withColumn("alt_mean", F.round("alt_mean", 6))


# --- map summaries (A8-A11, W4, J9, P11-P13) -----------------------------------------

LABEL_SQL = """coalesce(nullif(common_name, ''), nullif(iconic_taxon_name, ''), 'inconnu')
    || CASE WHEN nullif("group", '') IS NOT NULL THEN ' (' || "group" || ')' ELSE '' END"""

GRADE_SQL = f"CASE WHEN lower(quality_grade) IN ({_listed(labels.QUALITY_GRADES, ', ')}) THEN lower(quality_grade) END"

CLUSTERED_TAXA_SQL = dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y FROM proj WHERE year IS NOT NULL AND E_lv95 IS NOT NULL",
    f"""SELECT o.observation_uuid, o.year AS cluster_year, o.quality_grade, o.E_lv95, o.N_lv95,
               t.iconic_taxon_name, t.common_name, {GROUP_SQL.format(c='t.iconic_taxon_name')} AS "group"
        FROM proj o LEFT JOIN taxa t ON o.taxon_id = t.taxon_id""", EPS, MIN_SAMPLES, False)

COUNTS_SQL = f"""
base AS (SELECT cluster_year AS year, cluster_id, {GRADE_SQL} AS grade, {LABEL_SQL} AS label
         FROM c WHERE cluster_id <> -1 AND cluster_year IS NOT NULL),
counts AS (SELECT g AS grade_key, year, cluster_id, label, count(*) AS n_obs FROM (
             SELECT 'all' AS g, year, cluster_id, label FROM base
             UNION ALL SELECT grade AS g, year, cluster_id, label FROM base WHERE grade IS NOT NULL) q
           GROUP BY g, year, cluster_id, label),
features AS (SELECT DISTINCT cluster_year AS year, cluster_id FROM c WHERE cluster_id <> -1)"""


def _summary_sql(select: str) -> str:
    return f"WITH c AS ({CLUSTERED_TAXA_SQL}),{COUNTS_SQL}\n{select}"


def _clustered_taxa(spark, sf):
    from ..operators.dbscan import dbscan
    e = taxa_ops.enrich_taxa(fx.observations(spark, sf), fx.taxa_cache(spark, sf))
    return dbscan(quality.with_year(fx.projected(e)), EPS, MIN_SAMPLES)


def _features(clustered):
    return clustered.where(F.col("cluster_id") != -1).select(
        F.col("cluster_year").alias("year"), "cluster_id").distinct()


@register("taxon_counts", _summary_sql("SELECT * FROM counts"), ("proj", "taxa"))
def q_taxon_counts(spark, sf):
    from ..operators.summary import taxon_counts
    return taxon_counts(_clustered_taxa(spark, sf))


@register("top_taxa", _summary_sql("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grade_key, year, cluster_id
                                            ORDER BY n_obs DESC, label) AS rank FROM counts) r
WHERE rank <= 5"""), ("proj", "taxa"))
def q_top_taxa(spark, sf):
    from ..operators.summary import taxon_counts, top_taxa
    return top_taxa(taxon_counts(_clustered_taxa(spark, sf)), 5)


@register("available_grades", _summary_sql(
    "SELECT DISTINCT grade FROM base WHERE grade IS NOT NULL"), ("proj", "taxa"))
def q_available_grades(spark, sf):
    from ..operators.summary import available_grades
    return available_grades(_clustered_taxa(spark, sf))


@register("year_list", _summary_sql("""
SELECT string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years, CAST(count(*) AS INT) AS n_years,
       min(year) AS min_year, max(year) AS max_year
FROM (SELECT DISTINCT year FROM features) y"""), ("proj", "taxa"))
def q_year_list(spark, sf):
    from ..operators.summary import year_list
    return year_list(_features(_clustered_taxa(spark, sf)))


@register("bounds", _summary_sql(f"""
SELECT cluster_year AS year, round(min(E_lv95) - {EPS}, 3) AS min_e, round(min(N_lv95) - {EPS}, 3) AS min_n,
       round(max(E_lv95) + {EPS}, 3) AS max_e, round(max(N_lv95) + {EPS}, 3) AS max_n
FROM c WHERE cluster_id <> -1 AND cluster_year IS NOT NULL GROUP BY ROLLUP (cluster_year)"""), ("proj", "taxa"))
def q_bounds(spark, sf):
    from ..operators.summary import bounds
    b = bounds(_clustered_taxa(spark, sf), EPS)
    return b.select("year", *[F.round(c, 3).alias(c) for c in ("min_e", "min_n", "max_e", "max_n")])


@register("visible_features", _summary_sql("""
SELECT f.year, f.cluster_id FROM features f
WHERE EXISTS (SELECT 1 FROM counts k WHERE k.grade_key = 'research' AND k.year = f.year
              AND k.cluster_id = f.cluster_id AND k.n_obs > 0)"""), ("proj", "taxa"))
def q_visible_features(spark, sf):
    from ..operators.summary import taxon_counts, visible_features
    c = _clustered_taxa(spark, sf)
    return visible_features(_features(c), taxon_counts(c), "research")


# lon/lat of simplified vertices: compared with a plain count in the tests
@register("visible_bounds")
def q_visible_bounds(spark, sf):
    from ..functions.geo import with_wgs84
    from ..operators.footprint import boundary_arcs, footprint_vertices
    from ..operators.summary import taxon_counts, visible_bounds
    from ..session import cut_lineage
    c = cut_lineage(_clustered_taxa(spark, sf))
    v = with_wgs84(footprint_vertices(boundary_arcs(c, EPS), EPS), "x", "y", "lon", "lat")
    return visible_bounds(v, _features(c), taxon_counts(c), "research", "lon", "lat")


def _colour_sql(hue: str, form: str) -> str:
    before, after = form.replace("%%", "%").split("%d")
    return f"'{before}' || CAST({hue} AS VARCHAR) || '{after}'"


_HUE_SQL = f"(CAST(cluster_id AS BIGINT) * {labels.HUE_FACTOR}) % 360"


@register("cluster_style", _summary_sql(f"""
SELECT year, cluster_id, CAST({_HUE_SQL} AS INT) AS hue,
       {_colour_sql(_HUE_SQL, labels.STROKE_FMT)} AS stroke,
       {_colour_sql(_HUE_SQL, labels.FILL_FMT)} AS fill
FROM features"""), ("proj", "taxa"))
def q_cluster_style(spark, sf):
    from ..operators.summary import cluster_style
    return cluster_style(_features(_clustered_taxa(spark, sf)))


# --- reprojection (P5) --------------------------------------------------------------

def lv95_to_wgs84_sql(src: str, e: str, n: str, iterations: int = 6) -> str:
    """SQL text for the same steps as :func:`alpina.functions.geo.with_wgs84` (one CTE per step)."""
    import math
    from ..functions import geo
    c = geo.BERN

    def d(v):
        return f"CAST({float(v)!r} AS DOUBLE)"

    cb0, sb0 = d(math.cos(c["b0"])), d(math.sin(c["b0"]))
    q = [f"w0 AS (SELECT *, ({e} - {d(2600000.0)}) / {d(c['r'])} AS l, "
         f"{d(2.0)} * (atan(exp(({n} - {d(1200000.0)}) / {d(c['r'])})) - {d(math.pi / 4)}) AS bb FROM {src})",
         f"w1 AS (SELECT *, asin({cb0} * sin(bb) + {sb0} * cos(bb) * cos(l)) AS b, "
         f"{d(c['lam0'])} + atan2(sin(l), {cb0} * cos(l) - {sb0} * tan(bb)) / {d(c['alpha'])} AS lam FROM w0)",
         f"w2 AS (SELECT *, (ln(tan({d(math.pi / 4)} + b / {d(2.0)})) - {d(c['k'])}) / {d(c['alpha'])} AS sb, "
         f"b AS phi0 FROM w1)"]
    for i in range(iterations):
        q.append(f"p{i + 1} AS (SELECT *, {d(2.0)} * atan(exp(sb + {d(c['e'])} * ln(tan({d(math.pi / 4)} + "
                 f"asin({d(c['e'])} * sin(phi{i})) / {d(2.0)})))) - {d(math.pi / 2)} AS phi{i + 1} "
                 f"FROM {'w2' if i == 0 else f'p{i}'})")
    ph = f"phi{iterations}"
    q.append(f"g0 AS (SELECT *, {d(geo.BESSEL_A)} / sqrt({d(1.0)} - {d(geo.BESSEL_E2)} * sin({ph}) * sin({ph})) AS nb "
             f"FROM p{iterations})")
    q.append(f"g1 AS (SELECT *, nb * cos({ph}) * cos(lam) + {d(geo.SHIFT_DX)} AS gx, "
             f"nb * cos({ph}) * sin(lam) + {d(geo.SHIFT_DY)} AS gy, "
             f"nb * ({d(1.0)} - {d(geo.BESSEL_E2)}) * sin({ph}) + {d(geo.SHIFT_DZ)} AS gz FROM g0)")
    q.append("g2 AS (SELECT *, sqrt(gx * gx + gy * gy) AS pp FROM g1)")
    q.append("t0 AS (SELECT *, atan(gz / pp) AS lat0 FROM g2)")
    for i in range(iterations):
        lat = f"lat{i}"
        q.append(f"t{i + 1} AS (SELECT *, atan((gz + {d(geo.WGS84_E2)} * ({d(geo.WGS84_A)} / sqrt({d(1.0)} - "
                 f"{d(geo.WGS84_E2)} * sin({lat}) * sin({lat}))) * sin({lat})) / pp) AS lat{i + 1} FROM t{i})")
    q.append(f"wgs AS (SELECT *, degrees(atan2(gy, gx)) AS lon_wgs84, degrees(lat{iterations}) AS lat_wgs84 "
             f"FROM t{iterations})")
    return ",\n".join(q)


@register("reproject_wgs84", "WITH " + lv95_to_wgs84_sql("proj", "E_lv95", "N_lv95") + """
SELECT observation_uuid, round(lon_wgs84, 7) AS lon_wgs84, round(lat_wgs84, 7) AS lat_wgs84,
       round(longitude, 7) AS longitude, round(latitude, 7) AS latitude FROM wgs""", ("proj",))
def q_reproject_wgs84(spark, sf):
    from ..functions.geo import with_wgs84
    p = with_wgs84(fx.projected(fx.observations(spark, sf)), "E_lv95", "N_lv95")
    return p.select("observation_uuid", F.round("lon_wgs84", 7).alias("lon_wgs84"),
                    F.round("lat_wgs84", 7).alias("lat_wgs84"),
                    F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"))


# --- footprints (G1-G6, K4, K5): simplified geometry is checked by invariants in the tests ------------

#: arcs narrower than this (radians) are rounding of three circles through one point
LEAST_ARC = 1e-9

ARCS_SQL = f"""
WITH RECURSIVE c AS (""" + dbscan_sql(
    "SELECT observation_uuid AS id, year AS yr, E_lv95 AS x, N_lv95 AS y FROM proj WHERE year IS NOT NULL AND E_lv95 IS NOT NULL",
    "SELECT observation_uuid, year AS cluster_year, E_lv95, N_lv95 FROM proj", EPS, MIN_SAMPLES, False) + f"""),
ctr AS MATERIALIZED (SELECT DISTINCT cluster_id, E_lv95 AS x, N_lv95 AS y FROM c WHERE cluster_id <> -1),
pr AS (SELECT a.cluster_id, a.x, a.y, atan2(b.y - a.y, b.x - a.x) AS th, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS d
       FROM ctr a JOIN ctr b ON a.cluster_id = b.cluster_id AND abs(a.x - b.x) < {2 * EPS} AND abs(a.y - b.y) < {2 * EPS}),
ang AS (SELECT cluster_id, x, y, CASE WHEN th - acos(d / {2 * EPS}) < 0 THEN th - acos(d / {2 * EPS}) + 2 * pi() ELSE th - acos(d / {2 * EPS}) END AS s, 2 * acos(d / {2 * EPS}) AS w
        FROM pr WHERE d > 0 AND d < {2 * EPS}),
iv AS (SELECT cluster_id, x, y, s, least(s + w, 2 * pi()) AS e FROM ang
       UNION ALL SELECT cluster_id, x, y, CAST(0 AS DOUBLE), s + w - 2 * pi() FROM ang WHERE s + w > 2 * pi()),
new AS (SELECT *, max(e) OVER (PARTITION BY cluster_id, x, y ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM iv),
num AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY cluster_id, x, y ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM new),
isl AS (SELECT cluster_id, x, y, k, min(s) AS s, max(e) AS e FROM num GROUP BY cluster_id, x, y, k),
gap AS (SELECT cluster_id, x, y, e AS a0, coalesce(lead(s) OVER (PARTITION BY cluster_id, x, y ORDER BY s),
               first_value(s) OVER (PARTITION BY cluster_id, x, y ORDER BY s) + 2 * pi()) AS a1 FROM isl),
arcs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY cluster_id, x, y, a0) AS id, *,
           0.5 * ({EPS * EPS} * (a1 - a0) + {EPS} * x * (sin(a1) - sin(a0)) - {EPS} * y * (cos(a1) - cos(a0))) AS term
         FROM (SELECT * FROM gap WHERE a1 - a0 > {LEAST_ARC}
               UNION ALL SELECT cluster_id, x, y, CAST(0 AS DOUBLE), 2 * pi() FROM ctr WHERE NOT EXISTS (SELECT 1 FROM ang WHERE ang.cluster_id = ctr.cluster_id AND ang.x = ctr.x AND ang.y = ctr.y)) q)"""


@register("footprint_arcs_area", ARCS_SQL + """
SELECT cluster_id, count(*) AS n_arcs, round(sum(term), 1) AS area FROM arcs GROUP BY cluster_id""", ("proj",))
def q_footprint_arcs_area(spark, sf):
    from ..operators.footprint import arc_area, boundary_arcs
    arcs = boundary_arcs(_footprint_base(spark, sf), EPS).where(F.col("a1") - F.col("a0") > LEAST_ARC)
    return arc_area(arcs, EPS).withColumn("area", F.round("area", 1))


def _footprint_base(spark, sf):
    from ..operators.dbscan import dbscan
    return dbscan(quality.with_year(fx.projected(_elevated(spark, sf))), EPS, MIN_SAMPLES)


# rings: an arc goes on at the arc that starts nearest to its end; a ring is the set reached from its smallest arc
@register("footprint_polygons", ARCS_SQL + f""",
pt AS (SELECT id, cluster_id, term, x + {EPS} * cos(a0) AS sx, y + {EPS} * sin(a0) AS sy, x + {EPS} * cos(a1) AS ex, y + {EPS} * sin(a1) AS ey FROM arcs),
nx AS MATERIALIZED (SELECT a.id, arg_min(b.id, (b.sx - a.ex) * (b.sx - a.ex) + (b.sy - a.ey) * (b.sy - a.ey)) AS next FROM pt a JOIN pt b ON a.cluster_id = b.cluster_id
       AND abs(b.sx - a.ex) <= {1e-6 * EPS} AND abs(b.sy - a.ey) <= {1e-6 * EPS} GROUP BY a.id),
ring(id, root) AS (SELECT id, id FROM nx UNION SELECT nx.next, ring.root FROM ring JOIN nx ON nx.id = ring.id WHERE ring.root < nx.next),
named AS (SELECT id, min(root) AS root FROM ring GROUP BY id),
rings AS (SELECT cluster_id, root, sum(term) AS area FROM named JOIN pt USING (id) GROUP BY cluster_id, root)
SELECT cluster_id, count(*) FILTER (area > 0) AS n_parts, count(*) AS n_rings FROM rings GROUP BY cluster_id""", ("proj",))
def q_footprint_polygons(spark, sf):
    from ..operators.footprint import boundary_arcs, footprint_vertices
    arcs = boundary_arcs(_footprint_base(spark, sf), EPS).where(F.col("a1") - F.col("a0") > LEAST_ARC)
    v = footprint_vertices(arcs, EPS)
    return v.groupBy("cluster_id").agg(F.countDistinct("part").alias("n_parts"),
                                       F.countDistinct("part", "ring").alias("n_rings"))


@register("footprint_geojson")
def q_footprint_geojson(spark, sf):
    from ..operators.dbscan import cluster_summary
    from ..operators.footprint import footprints
    from ..sinks.writers import feature_json
    c = _footprint_base(spark, sf)
    return feature_json(footprints(c, EPS, cluster_summary(c)))


@register("footprint_geojson_wgs84")
def q_footprint_geojson_wgs84(spark, sf):
    from ..operators.dbscan import cluster_summary
    from ..operators.footprint import footprints
    from ..sinks.writers import feature_json
    c = _footprint_base(spark, sf)
    return feature_json(footprints(c, EPS, cluster_summary(c), wgs84=True))


# --- dataset catalog (N1-N4, N6-N8, K6) ----------------------------------------------------

SEL_TAGS_SQL = """
WITH s AS (SELECT path, list_filter(string_split(lower(regexp_extract(regexp_extract(path, '[^/]*$'),
                   '^(.+?)(\\.[^.]*)?$', 1)), '_'), lambda x: x <> '') AS parts FROM catalog),
a AS (SELECT *, list_position(parts, 'filtered') AS fi, list_position(parts, 'enriched') AS ei0 FROM s),
b AS (SELECT *, CASE WHEN fi IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_slice(parts, fi + 1, len(parts)) END AS af
      FROM a),
c AS (SELECT *, list_position(af, 'enriched') AS ei FROM b),
t AS (SELECT path, parts,
        CASE WHEN fi IS NULL THEN CAST([] AS VARCHAR[]) WHEN ei IS NULL THEN af ELSE list_slice(af, 1, ei - 1) END AS f,
        CASE WHEN fi IS NOT NULL THEN (CASE WHEN ei IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_slice(af, ei + 1, len(af)) END)
             WHEN ei0 IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_slice(parts, ei0 + 1, len(parts)) END AS e
      FROM c)"""


# the same split on the tokens as written (file names are abbreviated with their case)
CASED_TAGS_SQL = SEL_TAGS_SQL.replace("string_split(lower(", "string_split((")

# every token with its section: that of the last marker up to it
SECTIONS_SQL = """
sec AS (SELECT path, i, tk, m, coalesce(last_value(m IGNORE NULLS) OVER (
                 PARTITION BY path ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'p') AS mode
        FROM (SELECT path, i, parts[i] AS tk, CASE lower(parts[i]) WHEN 'filtered' THEN 'f' WHEN 'enriched' THEN 'e' END AS m
              FROM (SELECT path, parts, unnest(range(1, len(parts) + 1)) AS i
                    FROM (SELECT path, list_filter(string_split(regexp_extract(regexp_extract(path, '[^/]*$'),
                                 '^(.+?)(\\.[^.]*)?$', 1), '_'), lambda x: x <> '') AS parts FROM catalog)))),
tags AS (SELECT path, coalesce(list(tk ORDER BY i) FILTER (mode = 'p'), []) AS prefix,
                coalesce(list(lower(tk) ORDER BY i) FILTER (mode = 'f' AND m IS NULL), []) AS fs,
                coalesce(list(lower(tk) ORDER BY i) FILTER (mode = 'e' AND m IS NULL), []) AS es
         FROM sec GROUP BY path)"""


def _once(tags: str) -> str:
    return f"list_filter({tags}, lambda x, i: list_position({tags}, x) = i)"


def _section_text(marker: str, tags: str) -> str:
    return f"CASE WHEN len({tags}) > 0 THEN '_{marker}_' || array_to_string({tags}, '_') ELSE '' END"


def _expanded(tags: str, names: dict) -> str:
    from ..functions.tags import NO_TAG_LABEL
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE WHEN len({tags}) > 0 THEN array_to_string(list_transform({tags}, lambda x: CASE x {whens} ELSE x END), ', ') ELSE '{NO_TAG_LABEL}' END"


ABBREVIATED_SQL = CASED_TAGS_SQL + f""",
ini AS (SELECT path, parts, list_transform(f, lambda x: lower(x[1])) AS fi, list_transform(e, lambda x: lower(x[1])) AS ei FROM t),
abbr AS (SELECT path, fi, ei, 'clusters-run/' || parts[1] || '_clusters' || {_section_text('filtered', 'fi')}
                || {_section_text('enriched', 'ei')} || '.csv' AS entry FROM ini)"""


@register("parse_tags", SEL_TAGS_SQL + "," + SECTIONS_SQL + """
SELECT t.path, array_to_string(f, ',') AS sel_filters, array_to_string(e, ',') AS sel_enrichments,
       array_to_string(prefix, ',') AS prefix, array_to_string(fs, ',') AS filters, array_to_string(es, ',') AS enrichments
FROM t JOIN tags USING (path)""", ("catalog",))
def q_parse_tags(spark, sf):
    from ..operators.catalog import with_tags
    t = with_tags(fx.dataset_catalog(spark, sf))
    return t.select("path", *[F.array_join(c, ",").alias(c) for c in
                              ("sel_filters", "sel_enrichments", "prefix", "filters", "enrichments")])


@register("name_dataset", "WITH " + SECTIONS_SQL.strip() + f""",
n AS (SELECT path, array_to_string(prefix, '_') AS p, {_once("list_concat(fs, ['grade', 'needs_id'])")} AS f2,
             {_once("es")} AS e1, {_once("list_concat(es, ['taxa'])")} AS e2, regexp_extract(path, '[.][^.]*$') AS ext FROM tags),
-- the first name is read again for the second: its tags are split anew
r AS (SELECT *, string_split(array_to_string(f2, '_'), '_') AS fr FROM n),
o AS (SELECT *, {_once("fr")} AS f3 FROM r)
SELECT path, 'processed/' || p || {_section_text('filtered', 'f2')} || {_section_text('enriched', 'e1')} || ext AS filtered_name,
       'processed/' || p || {_section_text('filtered', 'f3')} || {_section_text('enriched', 'e2')} || ext AS enriched_name FROM o""", ("catalog",))
def q_name_dataset(spark, sf):
    from ..functions.tags import name_with_tags
    c = fx.dataset_catalog(spark, sf)
    step = c.withColumn("filtered_name", name_with_tags("path", "filtered", ["Grade", "needs_id"]))
    return step.withColumn("enriched_name", name_with_tags("filtered_name", "enriched", ["taxa"]))


BEST_SQL = SEL_TAGS_SQL + """
SELECT path, CAST(len(f) AS INT) AS n_filters, CAST(len(e) AS INT) AS n_enrichments FROM t
WHERE path LIKE '%.csv' AND list_contains(f, 'position') AND NOT list_contains(e, 'elevation')
ORDER BY n_filters DESC, n_enrichments DESC, path LIMIT 1"""


@register("best_dataset", BEST_SQL, ("catalog",))
def q_best_dataset(spark, sf):
    from ..operators.catalog import best_dataset
    return best_dataset(fx.dataset_catalog(spark, sf), include_filter=["position"], exclude_enrich=["elevation"],
                        raw_default="observations_swiss.csv")


def _label_sql() -> str:
    from ..functions.tags import ENRICH_ABBR, FILTER_ABBR
    return ABBREVIATED_SQL + f"""
SELECT path, entry AS clusters_file, 'clusters-run | Filtres: ' || {_expanded('fi', FILTER_ABBR)}
       || ' | Enrichissements: ' || {_expanded('ei', ENRICH_ABBR)} AS label FROM abbr"""


@register("cluster_label", _label_sql(), ("catalog",))
def q_cluster_label(spark, sf):
    from ..functions.tags import abbreviated_name, decode_abbreviated, human_label
    c = fx.dataset_catalog(spark, sf).withColumn(
        "clusters_file", F.concat(F.lit("clusters-run/"), abbreviated_name("path")))
    d = decode_abbreviated("clusters_file")
    return c.select("path", "clusters_file", human_label(d).alias("label"))


@register("manifest_append", ABBREVIATED_SQL + """,
m AS (SELECT row_number() OVER (ORDER BY entry) - 1 AS pos, entry FROM (SELECT DISTINCT entry FROM abbr))
SELECT * FROM m UNION ALL
SELECT (SELECT coalesce(max(pos) + 1, 0) FROM m), 'clusters-new/obs_clusters_filtered_p.csv'
WHERE 'clusters-new/obs_clusters_filtered_p.csv' NOT IN (SELECT entry FROM m)""", ("catalog",))
def q_manifest_append(spark, sf):
    from ..functions.tags import abbreviated_name
    from ..operators.ranking import global_rank
    from ..sinks.writers import manifest_append
    names = fx.dataset_catalog(spark, sf).select(
        F.concat(F.lit("clusters-run/"), abbreviated_name("path")).alias("entry")).distinct()
    manifest = global_rank(names, ["entry"], out="pos")
    return manifest_append(manifest, "clusters-new\\obs_clusters_filtered_p.csv")


@register("selection_tags", SEL_TAGS_SQL + """
SELECT path, array_to_string(f, ',') AS sel_filters, array_to_string(e, ',') AS sel_enrichments FROM t""",
          ("catalog",))
def q_selection_tags(spark, sf):
    from ..functions.tags import selection_tags
    f, e = selection_tags(F.col("path"))
    return fx.dataset_catalog(spark, sf).select(
        "path", F.array_join(f, ",").alias("sel_filters"), F.array_join(e, ",").alias("sel_enrichments"))


@register("best_dataset_position", BEST_SQL, ("catalog",))
def q_best_dataset_position(spark, sf):
    from ..operators.catalog import best_dataset
    return best_dataset(fx.dataset_catalog(spark, sf), include_filter=["position"], exclude_enrich=["elevation"])


@register("row_counts", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE year IS NULL) AS n_without_year FROM obs""", ("obs",))
def q_row_counts(spark, sf):
    return quality.row_counts(quality.with_year(fx.observations(spark, sf)))


@register("combined_name", "WITH " + SECTIONS_SQL.strip() + f""",
g AS (SELECT regexp_extract(path, '([0-9]{{4}})', 1) AS y, first(p ORDER BY path) FILTER (p <> '') AS p,
             flatten(list(fs ORDER BY path)) AS f, flatten(list(es ORDER BY path)) AS e
      FROM (SELECT *, array_to_string(prefix, '_') AS p FROM tags) GROUP BY y),
n AS (SELECT y, coalesce(p, 'combined') AS p, {_once('f')} AS f, {_once('e')} AS e FROM g)
SELECT y, p || {_section_text('filtered', 'f')} || {_section_text('enriched', 'e')} || '.csv' AS combined_name FROM n""", ("catalog",))
def q_combined_name(spark, sf):
    from ..functions.tags import combined_name
    c = fx.dataset_catalog(spark, sf).withColumn("y", F.regexp_extract("path", r"(\d{4})", 1))
    groups = c.groupBy("y").agg(F.sort_array(F.collect_list("path")).alias("inputs"))
    return groups.select("y", combined_name("inputs").alias("combined_name"))


# --- parsers (S3) over documents that Spark makes of the tables -----------------------------------

@register("taxa_json", "SELECT taxon_id, iconic_taxon_name, common_name FROM taxa", ("taxa",))
def q_taxa_json(spark, sf):
    from ..sources.tables import parse_taxa_json
    entry = F.struct(F.col("taxon_id").cast("string"), F.struct("iconic_taxon_name", "common_name"))
    # a document holds at most 500 taxa
    documents = fx.taxa_cache(spark, sf).groupBy(F.floor(F.col("taxon_id") / 500).alias("document")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    return parse_taxa_json(documents)


# --- large single documents (S1, S2, S8, K1, K4), written from the tables and read back by byte ranges ---------

@register("csv_roundtrip", """
SELECT doc_id, source, length(text) AS n_chars, sha256(text) AS text_sha256 FROM documents""")
def q_csv_roundtrip(spark, sf):
    from ..session import shared_path, table_path
    from ..sinks.writers import write_csv
    from ..sources.pieces import read_csv_split
    path = shared_path(spark, "csv")
    write_csv(spark.read.parquet(table_path(sf, "documents")).select("doc_id", "source", "text"), path)
    back = read_csv_split(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.length("text").cast("long").alias("n_chars"),
                       F.sha2("text", 256).alias("text_sha256"))


@register("geojson_roundtrip", """
SELECT year, taxon_id AS cluster_id, count(*) AS n_points, CAST(NULL AS DOUBLE) AS alt_mean, 'Polygon' AS geom_type,
       min(longitude) AS west, min(latitude) AS south, max(longitude) AS east, max(latitude) AS north
FROM obs WHERE year IS NOT NULL AND taxon_id IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL GROUP BY year, taxon_id""", ("obs",))
def q_geojson_roundtrip(spark, sf):
    from ..session import shared_path
    from ..sinks.writers import write_feature_collection
    from ..sources.pieces import read_feature_collection
    seen = fx.observations(spark, sf).where("year IS NOT NULL AND taxon_id IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL")
    box = seen.groupBy("year", F.col("taxon_id").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n_points"), F.min("longitude").alias("w"), F.min("latitude").alias("s"), F.max("longitude").alias("e"), F.max("latitude").alias("n"))
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("w", "s"), corner("e", "s"), corner("e", "n"), corner("w", "n"), corner("w", "s"))
    features = box.select("year", "cluster_id", F.lit(0).alias("cluster_local_id"), "n_points", F.lit(None).cast("double").alias("alt_mean"),
                          F.lit("Polygon").alias("geom_type"), F.to_json(F.array(ring)).alias("coordinates"))
    path = shared_path(spark, "geojson")
    write_feature_collection(features, path)
    back = read_feature_collection(spark, path)
    at = F.from_json("geometry.coordinates", "array<array<array<double>>>")[0]
    return back.select("properties.year", "properties.cluster_id", "properties.n_points", "properties.alt_mean", F.col("geometry.type").alias("geom_type"),
                       at[0][0].alias("west"), at[0][1].alias("south"), at[2][0].alias("east"), at[2][1].alias("north"))
