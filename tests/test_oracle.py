"""Registered queries vs their DuckDB oracle SQL on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# of the clustering-based queries some are covered here, the others by the brute-force tests
SWEEP = ["filter_position", "filter_grade", "project_lv95", "tile_key", "extract_year", "enrich_taxa",
         "taxon_groups", "taxa_missing", "taxa_cached", "taxa_batches", "taxa_upsert", "enrich_elevation", "filter_elevation",
         "elevation_coverage", "tiles_needed", "tile_urls_needed", "tile_urls_missing", "combine_union",
         "combine_intersect", "eps_neighbours", "reproject_wgs84", "dbscan_2d", "selection_tags",
         "best_dataset_position", "best_dataset", "manifest_append", "parse_tags", "row_counts", "taxa_json", "dbscan_3d",
         "footprint_arcs_area", "footprint_polygons", "enrich_elevation_bucketed", "name_dataset", "combined_name", "cluster_label"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_a_callable_and_oracles_are_known():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(SWEEP) <= set(o)


@pytest.mark.parametrize("name", SWEEP)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"grade_key", "year", "cluster_id", "label", "n_obs"}
    assert df.count() > 0
