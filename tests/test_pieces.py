"""Files cut into small byte ranges give what the plain parsers give."""

import csv
import json
import os
import random

import pytest

from alpina.sinks.writers import write_feature_collection
from alpina.sources.pieces import collection_objects, read_csv_split, read_feature_collection, text_pieces


@pytest.fixture()
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_quoted_csv_by_byte_ranges(spark, tmpdir_path, small_ranges):
    rnd = random.Random(2)
    words = ["plain", "line\nfeed", 'say "no"', "a,b", "\n\n", '"', 'x"\n"y', "é\nü", "long " * 30, "many\nlines\n" * 15]
    for name in ("a.csv", "b.csv"):
        rows = [(f"{name}-{i}", rnd.choice(words), rnd.choice(words) + str(i)) for i in range(60)]
        with open(os.path.join(tmpdir_path, name), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\r\n" if name == "b.csv" else "\n")
            w.writerow(["id", "one", "two"])
            w.writerows(rows)
    want = []
    for name in ("a.csv", "b.csv"):
        with open(os.path.join(tmpdir_path, name), newline="", encoding="utf-8") as f:
            want += [tuple(r) for r in list(csv.reader(f))[1:]]
    assert text_pieces(spark, tmpdir_path, "\n").select("file", "block").distinct().count() > 20
    got = read_csv_split(spark, tmpdir_path)
    assert got.columns == ["id", "one", "two"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


DOCUMENT = {"type": "FeatureCollection", "name": "na{me}", "crs": {"type": "name", "properties": {"name": "EPSG:2056"}},
            "features": [{"type": "Feature", "properties": {"cluster_id": i, "cluster_local_id": 0, "year": 2020 + i % 3, "n_points": i, "alt_mean": None,
                                                            "note": ['}', '{', '"}', '\\', '\\"}', "", "é}"][i % 7] * (i % 4)},
                          "geometry": {"type": "Point", "coordinates": [i, i / 2]}} for i in range(50)], "more": {"deep": {"er": {}}}}


@pytest.mark.parametrize("layout", [{"separators": (",", ":")}, {"indent": 2}, {"ensure_ascii": False}])
def test_collection_is_cut_at_features(spark, tmpdir_path, small_ranges, layout):
    path = os.path.join(tmpdir_path, "c.geojson")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(DOCUMENT, **layout) + ("\n" if "indent" in layout else ""))
    got = [json.loads(r.value) for r in collection_objects(spark, path).collect()]
    key = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, [DOCUMENT["crs"], *DOCUMENT["features"], DOCUMENT["more"]]))
    assert sorted(r.n for r in read_feature_collection(spark, path).selectExpr("properties.n_points AS n").collect()) == list(range(50))


def test_broken_collection_falls_back(spark, tmpdir_path):
    broken, good = os.path.join(tmpdir_path, "x_4326.geojson"), os.path.join(tmpdir_path, "x.geojson")
    with open(broken, "w") as f:
        f.write(json.dumps(DOCUMENT)[:-9])
    with open(good, "w") as f:
        f.write(json.dumps(DOCUMENT))
    assert read_feature_collection(spark, os.path.join(tmpdir_path, "none"), broken, good).count() == 50
    with pytest.raises(FileNotFoundError):
        read_feature_collection(spark, broken)


@pytest.mark.parametrize("n", [0, 1, 200])
def test_collection_over_part_files(spark, tmpdir_path, small_ranges, n):
    features = spark.createDataFrame([(2000 + i % 5, i, 0, i, None, "Point", f"[{i},{i}.5]") for i in range(n)],
                                     "year int, cluster_id int, cluster_local_id int, n_points long, alt_mean double, geom_type string, coordinates string")
    path = os.path.join(tmpdir_path, "out")
    write_feature_collection(features.repartition(6), path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    whole = json.loads("".join(open(os.path.join(path, p)).read() for p in parts))
    assert [(f["properties"]["year"], f["properties"]["cluster_id"]) for f in whole["features"]] == sorted((2000 + i % 5, i) for i in range(n))
    assert whole["type"] == "FeatureCollection" and whole["crs"]["properties"]["name"] == "EPSG:2056"
    assert sorted(r.n for r in read_feature_collection(spark, path).selectExpr("properties.n_points AS n").collect()) == list(range(n))
