"""Exact joins of polygons and points, for shapes of any form and size.

Candidates are found on a quadtree: a polygon stands on the at most four cells of about its own size that its box touches,
and is looked for on the coarser cells above them only where a larger polygon stands. So a river is one of few on a coarse
level and small parcels never meet each other there. Each pair of boxes is compared in one cell, the one that holds the lower
left corner of their common part, so no pair comes twice. What the boxes let through is decided on the geometry itself.

Defined results: null, empty or unreadable geometry meets nothing; keys are taken as unique; repeated polygons of one key meet
as often as they are repeated; empty tables give empty results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import spatial
from terrane.session import Scratch

LOWEST, HIGHEST = 3, 24
_BOX = ("xmin", "ymin", "xmax", "ymax")


def with_shape(df: DataFrame, wkt: str = "wkt") -> DataFrame:
    """``df`` with geom, box, area and perimeter of a polygon text; rows without a readable one are left out."""
    geo.register(df.sparkSession)
    return with_measures(df.drop("geom").withColumn("geom", geo.st_from_text(F.col(wkt))))


def with_measures(df: DataFrame) -> DataFrame:
    """``df`` with box, area and perimeter of its geom; rows without geometry are left out."""
    geo.register(df.sparkSession)
    names = [*_BOX, "area", "perimeter"]
    out = df.drop(*names).withColumn("_b", geo.st_box(F.col("geom"))).where("_b is not null")
    return out.select("*", *[F.col("_b")[i].alias(n) for i, n in enumerate(names)]).drop("_b")


def _level(df: DataFrame) -> Column:
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(1.0))
    return F.least(F.greatest(F.ceil(F.log2(extent)), F.lit(LOWEST)), F.lit(HIGHEST)).cast("int")


def _on(df: DataFrame, levels: Column) -> DataFrame:
    """Rows on the cells that their box touches, at each of the given levels."""
    side = F.pow(F.lit(2.0), F.col("lv"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    return df.withColumn("lv", F.explode(levels)).withColumn("cx", span("xmin", "xmax")).withColumn("cy", span("ymin", "ymax"))


def candidates(left: DataFrame, right: DataFrame, reach: float = 0.0) -> DataFrame:
    """Pairs of rows (columns a_..., b_...) whose boxes touch, overlap or lie within ``reach`` of one another."""
    name = lambda df, p: df.select(*[F.col(c) if c in ("lv", "cx", "cy", "own") else F.col(c).alias(p + c) for c in df.columns])
    grown = left
    for c, by in (("xmin", -reach), ("ymin", -reach), ("xmax", reach), ("ymax", reach)):
        grown = grown.withColumn(c, F.col(c) + by) if reach else grown
    a, b = grown.withColumn("own", _level(grown)), right.withColumn("own", _level(right))
    at = [sorted(r[0] for r in df.select("own").distinct().collect()) for df in (a, b)]  # at most 22 numbers each
    above = lambda ls: F.filter(F.array(*[F.lit(v) for v in ls]) if ls else F.array().cast("array<int>"), lambda v: v > F.col("own"))
    home = lambda df: _on(df, F.array("own")).drop("own")
    below_or_home = _on(b, F.concat(F.array("own"), above(at[0]))).drop("own")
    below = _on(a, above(at[1])).drop("own")
    x0, y0 = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    side = F.pow(F.lit(2.0), F.col("lv"))
    hit = (x0 <= F.least("a_xmax", "b_xmax")) & (y0 <= F.least("a_ymax", "b_ymax")) & (F.floor(x0 / side) == F.col("cx")) & (F.floor(y0 / side) == F.col("cy"))
    cell = ["lv", "cx", "cy"]
    out = name(home(a), "a_").join(name(below_or_home, "b_"), cell).where(hit).drop(*cell).unionByName(name(below, "a_").join(name(home(b), "b_"), cell).where(hit).drop(*cell))
    for c, by in (("a_xmin", reach), ("a_ymin", reach), ("a_xmax", -reach), ("a_ymax", -reach)):
        out = out.withColumn(c, F.col(c) + by) if reach else out
    return out


def touching(left: DataFrame, right: DataFrame, same_key: str | None = None) -> DataFrame:
    """Pairs of polygons that touch or overlap, with ``len`` of their common border and ``overlap``; of one table each pair
    once, the smaller ``same_key`` first."""
    pairs = candidates(left, right)
    if same_key:
        pairs = pairs.where(F.col(f"a_{same_key}") < F.col(f"b_{same_key}"))
    g, h = F.col("a_geom"), F.col("b_geom")
    return pairs.where(geo.st_intersects(g, h)).withColumn("len", geo.st_shared_length(g, h)).withColumn("overlap", geo.st_shared_area(g, h))


def within(left: DataFrame, right: DataFrame, reach: float) -> DataFrame:
    """Pairs of polygons at most ``reach`` apart, with their ``dist``."""
    return candidates(left, right, reach).withColumn("dist", geo.st_distance(F.col("a_geom"), F.col("b_geom"))).where(F.col("dist") <= reach)


def points_in(points: DataFrame, polygons: DataFrame, pid: str, key: str, wkt: str = "wkt", strict: bool = False) -> DataFrame:
    """Distinct (pid, key) of points (pid, x, y) covered by polygons (key, wkt); ``strict`` leaves out borders."""
    scratch = Scratch(points.sparkSession, "points_in")
    cells = scratch.put(spatial.cover(polygons.select(F.col(key).alias("region_id"), F.col(wkt).alias("wkt"))), "cells")
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # at most 22 levels
    located = points.where(spatial.has_place(F.col("x"), F.col("y")) | ((F.col("x") == 0) & (F.col("y") == 0))).select(pid, "x", "y")
    if not levels:
        return located.join(polygons.select(key), F.lit(False)).select(pid, key)
    held = spatial.spots_in_regions(located.select("x", "y").distinct(), cells, levels, strict)
    return held.join(located, ["x", "y"]).select(pid, F.col("region_id").alias(key)).distinct()


def count_points(points: DataFrame, polygons: DataFrame, pid: str, key: str, strict: bool = False) -> DataFrame:
    """(key, n): distinct points of every polygon, 0 where there is none."""
    n = points_in(points, polygons, pid, key, strict=strict).groupBy(key).agg(F.count("*").alias("n"))
    return polygons.select(key).join(n, key, "left").select(key, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def nearest(points: DataFrame, polygons: DataFrame, pid: str, key: str, reach: float, farthest: float | None = None) -> DataFrame:
    """(pid, key, dist) of the polygon nearest to every point; ties by area, then key. Points with nothing within ``reach``
    ask again within four times as much, up to ``farthest`` (or as far as the tables lie apart), so only few ask far."""
    geo.register(points.sparkSession)
    scratch = Scratch(points.sparkSession, "nearest")
    text = F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")"))
    asked = scratch.put(points.select(pid, "x", "y", geo.st_from_text(text).alias("geom"), F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax")), "asked")
    shapes = polygons.select(key, "geom", "area", *_BOX)
    if farthest is None:
        bounds = lambda df: df.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
        p, q = bounds(asked), bounds(shapes)
        farthest = 0.0 if None in (*p, *q) else max(p[2], q[2]) - min(p[0], q[0]) + max(p[3], q[3]) - min(p[1], q[1])
    found, radius, rounds = [], min(reach, farthest), 0
    while True:
        best = within(asked, shapes, radius).groupBy(F.col(f"a_{pid}").alias(pid)).agg(F.min(F.struct("dist", F.col("b_area").alias("area"), F.col(f"b_{key}").alias("k"))).alias("m"))
        found.append(scratch.put(best.select(pid, F.col("m.k").alias(key), F.col("m.dist").alias("dist")), f"found{rounds}"))
        asked = scratch.put(asked.join(found[-1].select(pid), pid, "left_anti"), f"asked{rounds}")
        if radius >= farthest or asked.isEmpty():
            break
        radius, rounds = min(4 * radius, farthest), rounds + 1
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
