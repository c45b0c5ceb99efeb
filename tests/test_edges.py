"""Cases that tidy tables do not hold: repeated and null keys, huge coordinates, quotes, missing files, odd dates."""

import os

import pytest
from pyspark.sql import functions as F

from alpina.operators import quality
from alpina.operators.catalog import best_dataset
from alpina.operators.combine import combine
from alpina.operators.dbscan import dbscan
from alpina.operators.elevation import enrich_elevation
from alpina.operators.neighbours import neighbour_counts
from alpina.operators.taxa import cached_taxa_for, request_batches, required_taxon_ids, upsert_taxa
from alpina.operators.summary import visible_bounds
from alpina.plans.pipeline import with_altitude, with_z
from alpina.sinks.writers import geojson_collection, write_csv
from alpina.sources.raster import grid_to_strips, require_tiles
from alpina.sources.tables import read_csv_strings, read_geojson_features, csv_entries, read_manifest, read_taxa_json

POINTS = "observation_uuid long, cluster_year int, E_lv95 double, N_lv95 double"


def _labels(spark, rows, eps=1.0, m=2):
    out = dbscan(spark.createDataFrame(rows, POINTS), eps, m).collect()
    return sorted((r.E_lv95 if r.E_lv95 is not None else -1.0, r.cluster_id) for r in out)


def test_dbscan_repeated_key_far_apart(spark):
    assert _labels(spark, [(7, 2020, 0.0, 0.0), (7, 2020, 100.0, 0.0)]) == [(0.0, -1), (100.0, -1)]


def test_dbscan_null_keys_cluster(spark):
    assert _labels(spark, [(None, 2020, 0.0, 0.0), (None, 2020, 0.5, 0.0), (None, 2020, 1.0, 0.0)]) == [(0.0, 0), (0.5, 0), (1.0, 0)]


def test_dbscan_huge_null_and_yearless_rows_stay_unclustered(spark):
    rows = [(1, 2020, 0.0, 0.0), (2, 2020, 0.5, 0.0), (3, 2020, 1e20, 0.0), (4, 2020, float("inf"), 0.0),
            (5, 2020, float("nan"), 0.0), (6, 2020, None, 0.0), (7, None, 0.0, 0.0)]
    out = {r.observation_uuid: r.cluster_id for r in dbscan(spark.createDataFrame(rows, POINTS), 1.0, 2).collect()}
    assert out == {1: 0, 2: 0, 3: -1, 4: -1, 5: -1, 6: -1, 7: -1}


def test_neighbour_counts_reject_infinity(spark):
    df = spark.createDataFrame([(1, 2020, 0.0, 0.0), (2, 2020, float("inf"), 0.0), (3, 2020, 1e300, 0.0)], POINTS)
    got = {r.observation_uuid: r.n_neighbours for r in neighbour_counts(df, 1.0, "observation_uuid", "cluster_year", ["E_lv95", "N_lv95"]).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [(None, "c"), (2, "d")]])
@pytest.mark.parametrize("how", ["union", "intersect"])
def test_combine_refuses_duplicate_and_null_ids(spark, rows, how):
    a, b = spark.createDataFrame(rows, "id long, x string"), spark.createDataFrame([(1, 5), (2, 6)], "id long, y int")
    with pytest.raises(Exception, match="duplicate ids|without an id"):
        combine([a, b], "id", how).collect()


def test_combine_intersect_has_one_shuffle(spark):
    a, b = spark.createDataFrame([(1, "a")], "id long, x string"), spark.createDataFrame([(1, 5)], "id long, y int")
    plan = combine([a, b], "id", "intersect")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_csv_quotes_and_line_feeds_round_trip(spark, tmpdir_path):
    rows = [("1", 'a "b", c', "x\ny"), ("2", None, "\\"), ("3", '"', "plain")]
    path = os.path.join(tmpdir_path, "t")
    write_csv(spark.createDataFrame(rows, "id string, text string, more string"), path)
    got = sorted(tuple(r) for r in read_csv_strings(spark, path).collect())
    assert got == rows
    assert 'a ""b"", c' in "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))


def test_missing_cache_and_manifest_are_empty(spark, tmpdir_path):
    assert read_taxa_json(spark, os.path.join(tmpdir_path, "none.json")).count() == 0
    assert read_manifest(spark, os.path.join(tmpdir_path, "none.json")).count() == 0
    second = os.path.join(tmpdir_path, "m.json")
    open(second, "w").write('["a.csv", "b.txt"]')
    assert [tuple(r) for r in csv_entries(read_manifest(spark, os.path.join(tmpdir_path, "none.json"), second)).collect()] == [(0, "a.csv")]


def test_geojson_collection_reads_back(spark, tmpdir_path):
    f = spark.createDataFrame([(2020, 1, 0, 3, 1.5, "MultiPolygon", "[]"), (2021, 2, 0, 4, None, "MultiPolygon", "[]")],
                              "year int, cluster_id int, cluster_local_id int, n_points long, alt_mean double, geom_type string, coordinates string")
    path = os.path.join(tmpdir_path, "c")
    geojson_collection(f).write.text(path)
    got = read_geojson_features(spark, os.path.join(tmpdir_path, "none"), path).select("properties.*").collect()
    assert sorted((r.year, r.cluster_id, r.n_points) for r in got) == [(2020, 1, 3), (2021, 2, 4)]
    with pytest.raises(FileNotFoundError):
        read_geojson_features(spark, os.path.join(tmpdir_path, "none"))


@pytest.mark.parametrize("text,year", [
    ("2020-01-01T00:30:00+02:00", 2020), ("2020-05-01T10:00:00", 2020), ("2020-05-01 10:00:00.123", 2020), ("2020/05/01", 2020),
    ("2019-12-31 23:59:59 +0200", 2019), ("31/12/2018", 2018), ("12/31/2018", 2018), ("2020-13-01", None), ("soon", None), ("", None), (None, None)])
def test_year_is_that_of_the_written_date(spark, text, year):
    df = spark.createDataFrame([(text,)], "observed_on string")
    assert quality.with_year(df).first().cluster_year == year


def test_nodata_is_compared_as_float_and_newest_vintage_wins(spark):
    tiles = spark.createDataFrame([("2600-1200", 2600000.0, 100.0, 1201000.0, -100.0, 10, 10, -9999.9)],
                                  "tile_key string, x0 double, px_w double, y0 double, px_h double, n_cols int, n_rows int, nodata double")
    pixels = spark.createDataFrame([("2600-1200", 0, 9, -9999.9, 2019), ("2600-1200", 1, 9, 5.0, 2015), ("2600-1200", 1, 9, 4.0, 2019)],
                                   "tile_key string, px int, py int, val double, vintage int")
    strips = grid_to_strips(pixels, tiles)
    assert strips.first().vals[:3] == [pytest.approx(-9999.9, rel=1e-6), 4.0, None]
    from alpina.functions.geo import with_wgs84
    at = spark.createDataFrame([(i, 2600050.0 + 100 * i, 1200050.0) for i in range(3)] + [(9, 2600050.0, 1300000.0)], "id int, e double, n double")
    obs = with_wgs84(at, "e", "n").select("id", F.col("lon_wgs84").alias("lon"), F.col("lat_wgs84").alias("lat"))
    obs = spark.createDataFrame([tuple(r) for r in obs.collect()], "id int, lon double, lat double")
    bad = spark.createDataFrame([(10, None, 46.0), (11, float("nan"), 46.0)], "id int, lon double, lat double")
    got = {r.id: r.elevation_m for r in enrich_elevation(obs.unionByName(bad), tiles, strips).collect()}
    assert got == {0: None, 1: 4.0, 2: None, 9: None, 10: None, 11: None}


def test_taxa_edges(spark):
    obs = spark.createDataFrame([("x",), (None,)], "taxon_id string")
    with pytest.raises(ValueError, match="no valid taxon id"):
        required_taxon_ids(obs)
    cache = spark.createDataFrame([(1, "Aves", "a"), (2, "Fungi", "b")], "taxon_id long, iconic_taxon_name string, common_name string")
    fresh = spark.createDataFrame([(None, "Plantae", "n"), (2, "Plantae", "c")], cache.schema)
    assert sorted(tuple(r) for r in upsert_taxa(cache, fresh).collect()) == [(1, "Aves", "a"), (2, "Plantae", "c")]
    assert [r.taxon_id for r in cached_taxa_for(spark.createDataFrame([("2",), ("7",)], "taxon_id string"), cache).collect()] == [2]


def test_batches_are_cut_twice(spark):
    got = request_batches(spark.range(650).select(F.col("id").alias("taxon_id")), 300).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in got] == [200, 100, 200, 100, 50]


def test_altitude_falls_back_to_two_dimensions(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0), (1.0, 2.0, None)], "E_lv95 double, N_lv95 double, elevation_m double")
    assert with_altitude(df)[1] == ["E_lv95", "N_lv95"]
    full, dims = with_altitude(df.where("elevation_m is not null"), 5.0)
    assert dims == ["E_lv95", "N_lv95", "z"] and full.first().z == 2.0


def test_altitude_counts_for_all_rows_or_none(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (3.0, 30.0)], "E_lv95 double, elevation_m double")
    assert [r.z for r in with_z(df, 5.0).orderBy("E_lv95").collect()] == [0.0, 0.0, 0.0]
    assert [r.z for r in with_z(df.where("elevation_m is not null"), 5.0).orderBy("E_lv95").collect()] == [2.0, 6.0]
    assert with_z(df.where("false")).count() == 0 and with_z(df.drop("elevation_m")).first().z == 0.0
    # one null altitude: the points are clustered in two dimensions
    rows = [(i, 2020, float(i), 0.0, 1000.0 * i) for i in range(4)] + [(9, 2020, 50.0, 0.0, None)]
    p = with_z(spark.createDataFrame(rows, POINTS + ", elevation_m double"))
    assert sorted(r.cluster_id for r in dbscan(p, 1.0, 2, dims=["E_lv95", "N_lv95", "z"]).collect()) == [-1, 0, 0, 0, 0]
    assert {r.cluster_id for r in dbscan(with_z(p.drop("z").where("elevation_m is not null")), 1.0, 2, dims=["E_lv95", "N_lv95", "z"]).collect()} == {-1}


def test_bounds_of_the_shown_layer(spark):
    v = spark.createDataFrame([(1, 6.0, 46.0), (1, 6.5, 46.2), (2, 7.0, 45.0), (2, 7.5, 45.5), (3, 9.0, 47.0), (3, 9.5, 47.5)], "cluster_id int, lon double, lat double")
    features = spark.createDataFrame([(2020, 1), (2020, 2), (2021, 3), (2022, 4)], "year int, cluster_id int")
    counts = spark.createDataFrame([("all", y, c, "x", 3) for y, c in ((2020, 1), (2020, 2), (2021, 3))] + [("research", 2020, 1, "x", 1), ("research", 2021, 3, "x", 0)],
                                   "grade_key string, year int, cluster_id int, label string, n_obs long")
    got = lambda g: {r[0]: tuple(r)[1:] for r in visible_bounds(v, features, counts, g, "lon", "lat").collect()}
    assert got(None) == {2020: (6.0, 45.0, 7.5, 46.2, 2), 2021: (9.0, 47.0, 9.5, 47.5, 1), None: (6.0, 45.0, 9.5, 47.5, 3)}
    assert got("research") == {2020: (6.0, 46.0, 6.5, 46.2, 1), None: (6.0, 46.0, 6.5, 46.2, 1)}
    assert got("casual") == {}


def test_errors_name_what_is_missing(spark):
    with pytest.raises(ValueError, match="positional_accuracy"):
        quality.filter_position(spark.range(1))
    with pytest.raises(ValueError, match="no raster tile"):
        require_tiles(spark.createDataFrame([], "tile_key string"))
    none = spark.createDataFrame([("a.csv",)], "path string")
    with pytest.raises(ValueError, match="no default"):
        best_dataset(none, include_filter=["position"])
    assert best_dataset(none, include_filter=["position"], raw_default="raw.csv").first().path == "raw.csv"


def test_bucketed_strips_join_without_an_exchange(spark):
    from alpina.session import shared_path
    from alpina.sources.raster import store_strips
    tiles = spark.createDataFrame([("2600-1200", 2_600_000.0, 100.0, 1_201_000.0, -100.0, 10, 10, -9999.0)],
                                  "tile_key string, x0 double, px_w double, y0 double, px_h double, n_cols int, n_rows int, nodata double")
    strips = spark.createDataFrame([("2600-1200", py, [float(10 * py + i) for i in range(10)]) for py in range(10)], "tile_key string, py int, vals array<float>")
    path = shared_path(spark, "strips")
    table = store_strips(strips, path.rsplit("/", 1)[-1].replace("-", "_"), 4, path)
    rows = [(i, 7.4386 + (i % 40) * 0.0003, 46.9511 + (i // 40) * 0.0003, {"k": "v"}) for i in range(1200)] + [(5000 + i, None, None, None) for i in range(500)]
    obs = spark.createDataFrame(rows, "id long, longitude double, latitude double, extra map<string,string>")
    plain = {r.id: r.elevation_m for r in enrich_elevation(obs, tiles, strips).collect()}
    assert len(plain) == len(rows) and len({v for v in plain.values() if v is not None}) > 20 and plain[5000] is None
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich_elevation(obs, tiles, table)
        assert {r.id: r.elevation_m for r in joined.collect()} == plain
        plan = joined._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        scan = [x for x in plan.splitlines() if "Scan parquet" in x and "vals" in x]
        assert scan and all("Bucketed: true" in x for x in scan)
        # exchanges: the tile headers and the points by tile, then the points by strip
        initial = plan.split("Initial Plan")[-1]
        assert initial.count("Exchange hashpartitioning") <= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_existing_elevation_is_recomputed_in_place(spark):
    tiles = spark.createDataFrame([("2600-1200", 2_600_000.0, 100.0, 1_201_000.0, -100.0, 10, 10, -9999.0)],
                                  "tile_key string, x0 double, px_w double, y0 double, px_h double, n_cols int, n_rows int, nodata double")
    strips = spark.createDataFrame([("2600-1200", py, [float(10 * py + i) for i in range(10)]) for py in range(10)], "tile_key string, py int, vals array<float>")
    obs = spark.createDataFrame([(1, 7.4390, -5.0, 46.9520, "a"), (2, None, 77.0, 46.9520, "b")], "id long, longitude double, elevation_m double, latitude double, tag string")
    fresh = {r.id: r.elevation_m for r in enrich_elevation(obs.drop("elevation_m"), tiles, strips).collect()}
    again = enrich_elevation(obs, tiles, strips)
    assert again.columns == obs.columns
    assert {r.id: r.elevation_m for r in again.collect()} == fresh and fresh[2] is None and fresh[1] >= 0.0


def test_with_z_makes_its_rows_once(spark):
    df = spark.range(5).selectExpr("id", "cast(id as double) elevation_m").repartition(3)
    plan = with_z(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "Range" not in plan
