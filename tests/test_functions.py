"""Hand fixtures for the column functions (FIXTURES.md section 2)."""

import math

from pyspark.sql import functions as F

from alpina.functions.coerce import to_double
from alpina.functions.geo import pixel_index, tile_key, wgs84_to_lv95, with_wgs84
from alpina.functions.labels import cluster_fill, cluster_stroke, display_label, normalise_grade, taxon_group
from alpina.functions.tags import (abbreviated_name, decode_abbreviated, human_label, name_with_tags,
                                   section_tags, selection_tags)
from alpina.operators import quality


def test_accuracy_filter_fx_acc(spark):
    vals = [None, "", "abc", "nan", "1d", "99.9", "100", "100.0001", "-5"]
    df = spark.createDataFrame([(v,) for v in vals], "positional_accuracy string")
    kept = sorted(r[0] for r in quality.filter_position(df, 100).collect())
    assert kept == sorted(["99.9", "100", "-5"])


def test_to_double_edge_tokens(spark):
    df = spark.createDataFrame([(" 12 ",), ("1e3",), ("inf",), ("-Infinity",), ("2f",), (".5",)], "v string")
    got = [r[0] for r in df.select(to_double("v")).collect()]
    assert got[:2] == [12.0, 1000.0] and math.isinf(got[2]) and math.isinf(got[3])
    assert got[4] is None and got[5] == 0.5


def test_grade_filter_fx_grade(spark):
    df = spark.createDataFrame([(None,), ("Research",), ("research",), ("needs_id",)], "quality_grade string")
    assert [r[0] for r in quality.filter_grade(df, ["research"]).collect()] == ["research"]


def test_taxon_group_fx_taxon(spark):
    vals = ["Plantae", "plantae", "AVES", "Fungi", "Animalia", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "i string")
    got = [r[0] for r in df.select(taxon_group("i")).collect()]
    assert got == ["flora", "flora", "fauna", "other", "other", "unknown", "unknown"]


def test_projection_fx_proj(spark):
    pts = [(7.4386372, 46.9510811), (8.5417, 47.3769), (6.1432, 46.2044), (10.4, 46.6)]
    exp = [(2600000.344642, 1199999.829586, "2600-1199"), (2683304.034626, 1247925.597493, "2683-1247"),
           (2500016.170636, 1117821.018188, "2500-1117"), (2826856.573329, 1165252.806275, "2826-1165")]
    df = spark.createDataFrame(pts, "lon double, lat double")
    e, n = wgs84_to_lv95(F.col("lon"), F.col("lat"))
    rows = df.select(e.alias("e"), n.alias("n")).select("e", "n", tile_key("e", "n").alias("k")).collect()
    for r, (ee, nn, k) in zip(rows, exp):
        assert abs(r.e - ee) < 1e-5 and abs(r.n - nn) < 1e-5 and r.k == k


def test_inverse_projection_fx_inv(spark):
    pts = [(2600000.0, 1200000.0), (2683304.0, 1247925.0), (2700000.0, 1100000.0)]
    exp = [(7.438632421, 46.951082772), (8.541701298, 47.376894350), (8.730496987, 46.044130243)]
    df = with_wgs84(spark.createDataFrame(pts, "e double, n double"), "e", "n")
    for r, (lo, la) in zip(df.collect(), exp):
        assert abs(r.lon_wgs84 - lo) < 2e-8 and abs(r.lat_wgs84 - la) < 2e-8


def test_roundtrip_projection(spark):
    df = spark.createDataFrame([(7.0 + i * 0.3, 46.0 + i * 0.15) for i in range(10)], "lon double, lat double")
    e, n = wgs84_to_lv95(F.col("lon"), F.col("lat"))
    back = with_wgs84(df.select("lon", "lat", e.alias("e"), n.alias("n")), "e", "n")
    for r in back.collect():  # the forward formula is approximate to about a metre
        assert abs(r.lon_wgs84 - r.lon) < 3e-5 and abs(r.lat_wgs84 - r.lat) < 3e-5


def test_pixel_index_fx_px(spark):
    df = spark.createDataFrame([(2599950.0,), (2600000.0,), (2600999.9,), (2601000.0,)], "e double")
    px = [r[0] for r in df.select(pixel_index("e", F.lit(2600000.0), F.lit(100.0))).collect()]
    assert px == [0, 0, 9, 10]  # 10 is out of a 10-column tile and dropped by the bounds check


def test_display_label_fx_label(spark):
    df = spark.createDataFrame([("Renard", "Mammalia", "fauna"), (None, "Aves", "fauna"), (None, None, None)],
                               "c string, i string, g string")
    got = [r[0] for r in df.select(display_label("c", "i", "g")).collect()]
    assert got == ["Renard (fauna)", "Aves (fauna)", "inconnu"]


def test_grade_and_colours(spark):
    df = spark.createDataFrame([("Research", 0), ("bogus", 1), (None, 7)], "g string, c int")
    r = df.select(normalise_grade("g"), cluster_stroke("c"), cluster_fill("c")).collect()
    assert [x[0] for x in r] == ["research", None, None]
    assert r[1][1] == "hsl(257, 70%, 35%)" and r[2][2] == "hsl(359, 80%, 65%)"


def test_names_fx_name(spark):
    df = spark.createDataFrame([("obs.csv",)], "p string")
    a = df.select(name_with_tags("p", "filtered", ["position"]).alias("p"))
    b = a.select(name_with_tags("p", "enriched", ["taxa"]).alias("p"))
    c = b.select(name_with_tags("p", "filtered", ["grade", "needs_id"]).alias("p"))
    assert a.first()[0] == "obs_filtered_position.csv"
    assert b.first()[0] == "obs_filtered_position_enriched_taxa.csv"
    assert c.first()[0] == "obs_filtered_position_grade_needs_id_enriched_taxa.csv"
    t = c.select(section_tags("p").alias("t")).first()[0]
    assert t.filters == ["position", "grade", "needs", "id"] and t.enrichments == ["taxa"] and t.prefix == ["obs"]


def test_tag_parsers(spark):
    df = spark.createDataFrame([("d/x_enriched_taxa_filtered_position.csv",), ("x_enriched_e_t.csv",)], "p string")
    f, e = selection_tags(F.col("p"))
    rows = df.select(f.alias("f"), e.alias("e"), section_tags("p").alias("s")).collect()
    assert rows[0].f == ["position"] and rows[0].e == []
    assert rows[0].s.filters == ["position"] and rows[0].s.enrichments == ["taxa"]
    assert rows[1].f == [] and rows[1].e == ["e", "t"]


def test_abbreviated_names(spark):
    df = spark.createDataFrame([("observations_filtered_position_elevation_enriched_elevation_taxa.csv",)], "p string")
    n = df.select(abbreviated_name("p").alias("n")).first()[0]
    assert n == "observations_clusters_filtered_p_e_enriched_e_t.csv"
    d = spark.createDataFrame([("run-1/" + n,)], "p string").select(human_label(decode_abbreviated("p"))).first()[0]
    assert d == "run-1 | Filtres: position, elevation | Enrichissements: elevation, taxa"


def test_combined_name(spark):
    from alpina.functions.tags import combined_name
    df = spark.createDataFrame([(["a/obs_filtered_position.csv", "b/obs_enriched_taxa_filtered_grade.csv"],),
                                (["filtered_x.csv"],)], "p array<string>")
    got = [r[0] for r in df.select(combined_name("p")).collect()]
    assert got == ["obs_filtered_position_grade_enriched_taxa.csv", "combined_filtered_x.csv"]
