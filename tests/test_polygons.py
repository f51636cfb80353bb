import math
import random

import pytest
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import polygons

RND = random.Random(12)


def _text(*rings):
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")"
    return "POLYGON (" + ", ".join(ring(r) for r in rings) + ")"


def _turned(cx, cy, w, h, degrees):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(cx + x * c - y * s, cy + x * s + y * c) for x, y in ((-w / 2, -h / 2), (w / 2, -h / 2), (w / 2, h / 2), (-w / 2, h / 2))]


SQUARE, DIAMOND = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(5.0, 0.0), (10.0, 5.0), (5.0, 10.0), (0.0, 5.0)]
ELL, HOLE = [(20.0, 0.0), (30.0, 0.0), (30.0, 5.0), (25.0, 5.0), (25.0, 10.0), (20.0, 10.0)], [(2.0, 2.0), (2.0, 8.0), (8.0, 8.0), (8.0, 2.0)]


def _shapes(spark, rows):
    return polygons.with_shape(spark.createDataFrame(rows, "k long, wkt string"))


def test_rotated_ells_and_holes(spark):
    rows = [(1, _text(SQUARE)), (2, _text(DIAMOND)), (3, _text(ELL)), (4, _text([(26.0, 6.0), (29.0, 6.0), (29.0, 9.0), (26.0, 9.0)])), (5, _text(SQUARE, HOLE)), (6, _text([(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0)])), (7, _text([(25.0, 5.0), (30.0, 5.0), (30.0, 10.0), (25.0, 10.0)])), (8, None), (9, "nonsense"), (10, "POLYGON EMPTY")]
    df = _shapes(spark, rows)
    got = {(r["a_k"], r["b_k"]): (round(r["len"], 6), round(r["overlap"], 6)) for r in polygons.touching(df, df, "k").collect()}
    assert got[1, 2] == (0.0, 50.0)  # a square turned by 45 degrees within another
    assert got[3, 7] == (10.0, 0.0)  # a square in the notch of an L
    assert got[4, 7] == (0.0, 9.0) and (3, 4) not in got  # in the box of the L, yet not in the L
    assert got[1, 5] == (40.0, 64.0) and (5, 6) not in got and got[1, 6] == (0.0, 9.0)  # in a hole
    assert {k for pair in got for k in pair} == set(range(1, 8))
    points = spark.createDataFrame([(1, 27.0, 7.0), (2, 5.0, 5.0), (3, 1.0, 1.0), (4, 30.0, 5.0), (5, None, 1.0), (6, 2.0, 5.0)], "pid long, x double, y double")
    held = {}
    for r in polygons.points_in(points, df, "pid", "k").collect():
        held.setdefault(r["pid"], set()).add(r["k"])
    assert held == {1: {4, 7}, 2: {1, 2, 6}, 3: {1, 5}, 4: {3, 7}, 6: {1, 2, 5}}
    strict = {(r["pid"], r["k"]) for r in polygons.points_in(points, df, "pid", "k", strict=True).collect()}
    assert (4, 3) not in strict and (6, 5) not in strict and (6, 1) in strict
    assert {r["k"]: r["n"] for r in polygons.count_points(points, df, "pid", "k").collect()}[4] == 1


@pytest.mark.parametrize("reach", [0.0, 25.0])
def test_candidates_of_all_sizes(spark, reach):
    rows = [(i, _text(_turned(RND.uniform(-500, 500), RND.uniform(-500, 500), 10 ** RND.uniform(0, 3), 10 ** RND.uniform(0, 2), RND.uniform(0, 180)))) for i in range(120)]
    df = _shapes(spark, rows).persist()
    boxes = [(r["k"], r["xmin"], r["ymin"], r["xmax"], r["ymax"]) for r in df.collect()]
    got = [(r["a_k"], r["b_k"]) for r in polygons.candidates(df, df, reach).select("a_k", "b_k").collect()]
    want = {(a[0], b[0]) for a in boxes for b in boxes if a[1] - reach <= b[3] and b[1] <= a[3] + reach and a[2] - reach <= b[4] and b[2] <= a[4] + reach}
    assert len(got) == len(set(got)) and set(got) == want
    left, right = df.select(F.col("k").alias("a"), F.col("geom").alias("g")), df.select(F.col("k").alias("b"), F.col("geom").alias("h"))
    near = {(r["a"], r["b"]) for r in left.crossJoin(right).where(geo.st_distance(F.col("g"), F.col("h")) <= reach).collect()}
    assert {(r["a_k"], r["b_k"]) for r in polygons.within(df, df, reach).collect()} == near


def test_nearest_far_away_and_empty(spark):
    df = _shapes(spark, [(1, _text(SQUARE)), (2, _text(ELL))])
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 5000.0, 0.0), (3, -3.0, 0.0), (4, 15.0, 2.0)], "pid long, x double, y double")
    got = {r["pid"]: (r["k"], round(r["dist"], 6)) for r in polygons.nearest(points, df, "pid", "k", 1.0).collect()}
    assert got == {1: (1, 0.0), 2: (2, 4970.0), 3: (1, 3.0), 4: (2, 5.0)}
    none = df.limit(0)
    assert polygons.nearest(points, none, "pid", "k", 1.0).count() == 0 and polygons.touching(df, none).count() == 0 and polygons.points_in(points, none, "pid", "k").count() == 0
    assert {r["n"] for r in polygons.count_points(points.limit(0), df, "pid", "k").collect()} == {0}
