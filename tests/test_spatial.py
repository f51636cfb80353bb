import math
import random
import re

import pytest

from terrane.operators import joins, spatial

RND = random.Random(3)


FARTHEST = spatial.FARTHEST


def parse_parts(wkt: str | None) -> list[list[tuple[float, float, float, float]]]:
    """Edges of each polygon of a POLYGON or MULTIPOLYGON text; unreadable text has no parts."""
    if not wkt or "POLYGON" not in wkt.upper():
        return []
    parts = []
    for body in re.findall(r"\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)", wkt):
        edges = []
        for ring in re.findall(r"\(([^()]*)\)", body):
            try:
                pts = [tuple(float(v) for v in p.split()[:2]) for p in ring.split(",")]
            except ValueError:
                return []
            if any(len(p) != 2 or not all(abs(v) <= FARTHEST for v in p) for p in pts):
                return []
            if pts and pts[0] != pts[-1]:
                pts.append(pts[0])
            edges += [(*a, *b) for a, b in zip(pts, pts[1:], strict=False) if a != b]
        if edges:
            parts.append(edges)
    return parts


def _odd(edges: list[tuple[float, float, float, float]], px: float, py: float) -> bool:
    odd = False
    for ax, ay, bx, by in edges:
        if (ay > py) != (by > py) and px > ax + (py - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def _holds(wkt, x, y):
    for edges in parse_parts(wkt):
        for ax, ay, bx, by in edges:
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
        if _odd(edges, x, y):
            return True
    return False


WKT = [
    "POLYGON ((0 0, 40 0, 40 30, 0 30, 0 0), (10 10, 20 10, 20 20, 10 20, 10 10))", "MULTIPOLYGON (((50 0, 60 0, 60 10, 50 10, 50 0)), ((-20 -20, -5 -20, -5 -5, -20 -5, -20 -20)))",
    "POLYGON ((100 0, 130 15, 100 30, 70 15, 100 0))", "POLYGON ((0 100, 900 100, 900 400, 450 250, 0 400, 0 100))", "POLYGON ((3 3, 3.25 3, 3.25 3.25, 3 3.25, 3 3))",
    "POLYGON EMPTY", "nonsense", "POLYGON ((1 1, x 2))", None, "POINT (1 1)",
]


def test_regions_against_brute(spark):
    pts = {(RND.randrange(-100, 3700) / 4, RND.randrange(-100, 1700) / 4) for _ in range(3000)} | {(10.0, 10.0), (15.0, 15.0), (20.0, 12.0), (40.0, 30.0), (85.0, 7.5), (450.0, 250.0), (-20.0, -5.0)}
    pts |= {(x / 4, y / 4) for x in range(-8, 180, 3) for y in range(-8, 140, 3)}
    regions = spark.createDataFrame(list(enumerate(WKT)), "region_id long, wkt string")
    cells = spatial.cover(regions).persist()
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    places = spark.createDataFrame(list(pts), "x double, y double")
    got = {(r["region_id"], r["x"], r["y"]) for r in spatial.spots_in_regions(places, cells, levels).collect()}
    assert got == {(i, x, y) for i, w in enumerate(WKT) for x, y in pts if w and _holds(w, x, y)}
    assert cells.where("inside").count() > 0


def test_near_against_brute(spark):
    rows = [(i, RND.randrange(0, 400) / 4, RND.randrange(0, 400) / 4) for i in range(600)] + [(1000 + i, 5.0, 5.0) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    want = {(a, b) for a, ax, ay in rows for b, bx, by in rows if a < b and (ax - bx) ** 2 + (ay - by) ** 2 <= 4}
    got = [(r[0], r[1]) for r in spatial.near_pairs(df, 2.0).collect()]
    assert set(got) == want and len(got) == len(want)
    probes = spark.createDataFrame([(1, 5.0, 5.0), (1, 50.0, 50.0), (2, 13.0, 5.0)], "probe_id long, px double, py double")
    pts = {(p, i) for p, px, py in [(1, 5.0, 5.0), (1, 50.0, 50.0), (2, 13.0, 5.0)] for i, x, y in rows if (px - x) ** 2 + (py - y) ** 2 <= 64}
    assert {(r[0], r[1]) for r in spatial.near_points(probes, df, 8.0).collect()} == pts


def test_latest_location(spark):
    rows = [(1, 1.0, 1.0, 1), (1, 2.0, 2.0, 2), (2, 1.0, 1.0, 1), (2, None, 1.0, 2), (3, 0.0, 0.0, 1), (4, 0.0, 5.0, 1), (None, 1.0, 1.0, 1), (5, float("nan"), 1.0, 1), (1, 2.0, 2.0, 2)]
    df = spark.createDataFrame(rows, "k long, x double, y double, at long")
    assert sorted(map(tuple, spatial.latest_location(df, "k", "x", "y", "at").collect())) == [(1, 2.0, 2.0), (4, 0.0, 5.0)]


def test_empty(spark):
    none = spark.createDataFrame([], "id long, x double, y double")
    assert spatial.near_pairs(none, 2.0).count() == 0
    assert spatial.cover(spark.createDataFrame([], "region_id long, wkt string")).count() == 0


def test_cover_of_random_polygons(spark):
    """Star-shaped polygons with many corners, some with a hole, against ray casting; inside cells and strict hits too."""
    rows, pts = [], [(RND.uniform(-400, 400), RND.uniform(-400, 400)) for _ in range(1500)]
    for i in range(30):
        n, cx, cy, size = RND.randrange(3, 60), RND.uniform(-200, 200), RND.uniform(-200, 200), 10 ** RND.uniform(0.3, 2.5)
        ring = [(cx + size * r * math.cos(2 * math.pi * k / n), cy + size * r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [RND.uniform(0.4, 1.0)]]
        hole = [(cx + size * 0.2 * math.cos(a), cy + size * 0.2 * math.sin(a)) for a in (0, 1.5, 3, 4.5)]
        text = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")"
        rows.append((i, f"POLYGON ({text(ring)}{', ' + text(hole) if i % 2 else ''})"))
    cells = spatial.cover(spark.createDataFrame(rows, "region_id long, wkt string")).persist()
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    places = spark.createDataFrame(pts, "x double, y double")
    for strict in (False, True):
        got = {(r["region_id"], r["x"], r["y"]) for r in spatial.spots_in_regions(places, cells, levels, strict).collect()}
        assert got == {(i, x, y) for i, w in rows for x, y in pts if _holds(w, x, y)}


def test_strict_leaves_out_the_border(spark):
    cells = spatial.cover(spark.createDataFrame([(1, WKT[0])], "region_id long, wkt string")).persist()
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    places = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (10.0, 15.0), (15.0, 15.0), (40.0, 3.0)], "x double, y double")
    assert {(r["x"], r["y"]) for r in spatial.spots_in_regions(places, cells, levels, strict=True).collect()} == {(5.0, 5.0)}


@pytest.mark.parametrize("reach", [0.0, 3.0])
def test_box_pairs_against_brute(spark, reach):
    rows = [(i, *(lambda x, y, w, h: (float(x), float(y), float(x + w), float(y + h)))(RND.randrange(0, 300), RND.randrange(0, 300), RND.randrange(1, 90), RND.randrange(1, 40))) for i in range(150)]
    df = spark.createDataFrame(rows, "clean_fid long, xmin double, ymin double, xmax double, ymax double")
    got = [(r["a_clean_fid"], r["b_clean_fid"]) for r in joins.box_pairs(df, df, same=True, reach=reach).collect()]
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] - reach <= b[3] and b[1] <= a[3] + reach and a[2] - reach <= b[4] and b[2] <= a[4] + reach}
    assert len(got) == len(set(got)) and set(got) == want
