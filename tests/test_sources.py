import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.sources import files, geopackage, pages
from terrane.streaming import ingest


def test_geopackage_round_trip(spark, tmp_path):
    geo.register(spark)
    path = str(tmp_path / "x.gpkg")
    rows = [(5, "POINT (1 2)", "a", 1.5), (9, "POINT (3 4)", None, None), (12, None, "c", 2.0)]
    df = spark.createDataFrame(rows, "fid long, w string, name string, v double").withColumn("geom", geo.st_from_text(F.col("w"))).drop("w")
    assert geopackage.export_layer(df, path, "things", "fid") == 3
    geopackage.export_layer(df.limit(0), path, "none", "fid")
    spark.dataSource.register(geopackage.GeoPackageSource)
    back = spark.read.format("geopackage").option("path", path).option("layer", "things").option("splits", "3").load()
    got = sorted((r["fid"], r["t"], r["name"], r["v"]) for r in back.withColumn("t", geo.st_to_text(F.col("geom"))).collect())
    assert got == [(5, "POINT (1 2)", "a", 1.5), (9, "POINT (3 4)", None, None), (12, None, "c", 2.0)]
    pruned = spark.read.format("geopackage").option("path", path).option("layer", "things").option("columns", "name").option("fid", "thing_fid").load()
    assert pruned.columns == ["thing_fid", "name"] and pruned.count() == 3
    assert spark.read.format("geopackage").option("path", path).option("layer", "none").load().count() == 0
    assert geopackage.layers(path) == ["things", "none"] and geopackage.layer_info(path, "things")["features"] == 3
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT count(*) FROM things").fetchone()[0] == 3


def test_headers():
    import struct

    blob = b"GP\x00\x03" + struct.pack("<i", 27700) + struct.pack("<4d", 1, 2, 3, 4) + b"WKB"
    assert geopackage.wkb_of(blob) == b"WKB" and geopackage.envelope_of(blob) == (1, 3, 2, 4) and geopackage.wkb_of(None) is None


def test_points(spark, tmp_path):
    p = tmp_path / "p.csv"
    p.write_text("name,Easting,Northing\na,1,2\nb,x,3\nc,inf,1\nd,,\n")
    assert [(r["x"], r["y"], r["name"]) for r in files.read_points(spark, str(p)).collect()] == [(1.0, 2.0, "a")]
    g = tmp_path / "p.geojson"
    g.write_text(json.dumps({"type": "FeatureCollection", "features": [{"id": 1, "geometry": {"type": "Point", "coordinates": [3, 4.5]}, "properties": {"k": "v"}}, {"id": 2, "geometry": None, "properties": {}}]}))
    assert [(r["x"], r["y"]) for r in files.read_points(spark, str(g)).collect()] == [(3.0, 4.5)]
    with pytest.raises(ValueError, match="cannot read"):
        files.read_points(spark, "x.xyz")


def test_candidate_files_and_layers(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"{n}.csv").write_text(f"id,ids\n1,{n}|2\n")
    df = files.read_candidates(spark, f"{tmp_path}, {tmp_path}/a.csv,{tmp_path}/*.csv", "id long, ids string")
    assert sorted(r["ids"] for r in df.collect()) == ["a|2", "b|2"]
    files.write_layers(str(tmp_path / "root"), {"one": spark.range(3), "two": spark.range(2)})
    files.write_layers(str(tmp_path / "root"), {"two": spark.range(7)})
    assert spark.read.parquet(str(tmp_path / "root/one")).count() == 3 and spark.read.parquet(str(tmp_path / "root/two")).count() == 7
    flat = files.flat(spark.createDataFrame([(1, [1, 2])], "a int, b array<int>"))
    assert flat.first()["b"] == "[1,2]"
    assert files.optional(spark, str(tmp_path / "nowhere"), "a int").count() == 0


def test_paged_download(spark, tmp_path):
    calls = []

    def answers():
        state = {"n": 0}

        def fetch(box, start, size):
            state["n"] += 1
            calls.append(start)
            if state["n"] == 1:
                return 429, {"Retry-After": "0"}, ""
            if state["n"] == 2:
                return 500, {}, ""
            if state["n"] == 3:
                return 200, {}, "not json"
            total = 5
            return 200, {}, json.dumps({"features": [{"id": i} for i in range(start, min(total, start + size))]})

        return fetch

    fetch = answers()
    waits = []
    assert pages.fetch_page(fetch, (0, 0, 1, 1), 0, 2, sleep=waits.append)["features"] == [{"id": 0}, {"id": 1}] and waits[0] == 0.0
    with pytest.raises(RuntimeError):
        pages.fetch_page(lambda *a: (404, {}, ""), (0, 0, 1, 1), 0, 2)
    with pytest.raises(RuntimeError):
        pages.fetch_page(lambda *a: (503, {}, ""), (0, 0, 1, 1), 0, 2, sleep=lambda s: None)

    def steady(box, start, size):
        return 200, {}, json.dumps({"features": [{"id": i} for i in range(start, min(5, start + size))]})

    w = spark.createDataFrame([(0, 0.0, 0.0, 1.0, 1.0), (1, 1.0, 0.0, 2.0, 1.0)], "window int, xmin double, ymin double, xmax double, ymax double")
    sig = pages.input_signature(size=2)
    assert sorted(map(tuple, pages.download(spark, w, steady, str(tmp_path / "store"), 2, sig).collect())) == [(0, 5), (1, 5)]
    assert pages.download(spark, w, steady, str(tmp_path / "store"), 2, sig).count() == 2


def test_stream_ingest_twice(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    f = lambda i, t: {"id": i, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i, 1], [0, 0]]]}, "properties": {"TOID": t, "Theme": "Land"}}
    (folder / "1.json").write_text(json.dumps({"features": [f(1, "t1"), f(2, None)]}))
    args = (spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"))
    assert ingest.ingest(*args) == 2 and ingest.ingest(*args) == 2
    (folder / "2.json").write_text(json.dumps({"features": [f(1, "t1"), f(3, "t3")]}))
    assert ingest.ingest(*args) == 3


def test_stable_ids(spark):
    new = spark.createDataFrame([(k,) for k in (4, 2, 9, 7)], "k long")
    old = spark.createDataFrame([(2, 50), (7, 10)], "k long, fid long")
    assert {r["k"]: r["fid"] for r in files.stable_ids(new, old, "k", "fid").collect()} == {2: 50, 7: 10, 4: 51, 9: 52}
