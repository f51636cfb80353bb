"""Points near points and regions that hold points.

Method: a region is covered by quadtree cells, refined where its border runs. Cells wholly inside
are accepted by an equi-join on the cell alone; only matches in border cells are tested exactly,
against the few edges that matter for that cell. Near neighbours use a grid of the search distance.
Points on one spot are joined as one spot and multiplied afterwards.

Defined results
- borders and exact distances count; the inside of a hole does not;
- null, NaN or unreadable geometry or coordinates, and those beyond a million kilometres, match nothing; empty inputs give empty results;
- repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo

#: A cell is one number: level, column and row, the latter two of 29 bits from the middle on. Coordinates beyond
#: FARTHEST metres do not fit and are no places.
HALF, FARTHEST = 1 << 28, 1e9


def latest_location(df: DataFrame, key: str, x: str, y: str, at: str) -> DataFrame:
    """(id, x, y) of the newest row of each key; a null or all-zero place is no location.

    Of rows with the same instant the greatest coordinates count."""
    newest = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.struct(F.col(at).alias("at"), F.col(x).alias("x"), F.col(y).alias("y"))).alias("m"))
        .select("id", "m.x", "m.y")
    )
    return newest.where(has_place(F.col("x"), F.col("y")))


def has_place(x: Column, y: Column) -> Column:
    return x.isNotNull() & y.isNotNull() & (F.abs(x) <= FARTHEST) & (F.abs(y) <= FARTHEST) & ~((x == 0) & (y == 0))


def spots(points: DataFrame) -> DataFrame:
    """Distinct places of (id, x, y) with the number of ids on each."""
    return points.groupBy("x", "y").agg(F.count("*").alias("n"))


def _cell(c: Column, side: float) -> Column:
    return F.floor(c / F.lit(float(side))).cast("long")


def _number(cx: Column, cy: Column, level: int = 0) -> Column:
    return F.lit(level << 58).bitwiseOR(F.shiftleft(cx + HALF, 29)).bitwiseOR(cy + HALF)


def _home(x: Column, y: Column, side: float, level: int = 0) -> Column:
    """The cell of a point."""
    return _number(_cell(x, side), _cell(y, side), level)


def _in_reach(df: DataFrame, side: float, reach: float) -> DataFrame:
    """Each row on every cell that a box of ``reach`` round it touches: 2.25 cells on average for a side of four reaches."""
    span = lambda c: F.explode(F.sequence(_cell(F.col(c) - reach, side), _cell(F.col(c) + reach, side)))
    return df.withColumn("cx", span("x")).withColumn("cy", span("y")).withColumn("cell", _number(F.col("cx"), F.col("cy"))).drop("cx", "cy")


def _close(ax: Column, ay: Column, bx: Column, by: Column, reach: float) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by) <= F.lit(float(reach) * float(reach))


def near_pairs(points: DataFrame, reach: float, places: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id), left < right, of points (id, x, y) at most ``reach`` apart; ``places`` are their spots."""
    places, side = spots(points) if places is None else places, 4 * reach
    home = places.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("n").alias("an"), _home(F.col("x"), F.col("y"), side).alias("cell"))
    pairs = home.join(_in_reach(places, side, reach), "cell").where(
        ((F.col("ax") < F.col("x")) | ((F.col("ax") == F.col("x")) & (F.col("ay") <= F.col("y")))) & _close(F.col("ax"), F.col("ay"), F.col("x"), F.col("y"), reach)
        & ~((F.col("ax") == F.col("x")) & (F.col("ay") == F.col("y")) & (F.col("n") == 1))
    ).select("ax", "ay", F.col("x").alias("bx"), F.col("y").alias("by"))
    left = points.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = points.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    both = pairs.join(left, ["ax", "ay"]).join(right, ["bx", "by"])
    same = (F.col("ax") == F.col("bx")) & (F.col("ay") == F.col("by"))
    return both.where((F.col("a") < F.col("b")) | (~same & (F.col("a") != F.col("b")))).select(
        F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")
    )


def near_points(probes: DataFrame, points: DataFrame, reach: float, places: DataFrame | None = None) -> DataFrame:
    """(probe_id, id) of probes (probe_id, px, py) and points (id, x, y) at most ``reach`` apart; ``places`` are their spots."""
    side = 4 * reach
    asked = probes.select("probe_id", F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    round_probe = _in_reach(asked, side, reach).select("probe_id", F.col("x").alias("px"), F.col("y").alias("py"), "cell")
    places = (spots(points) if places is None else places).select("x", "y", _home(F.col("x"), F.col("y"), side).alias("cell"))
    hits = round_probe.join(places, "cell").where(_close(F.col("px"), F.col("py"), F.col("x"), F.col("y"), reach)).select("probe_id", "x", "y")
    return hits.join(points, ["x", "y"]).select("probe_id", "id").distinct()


# ---------------------------------------------------------------- regions


def cover(regions: DataFrame) -> DataFrame:
    """(region_id, level, cell, inside, border): quadtree cells of distinct regions (region_id, wkt), made in the JVM."""
    geo.register(regions.sparkSession)
    return regions.where(F.col("wkt").isNotNull()).select("region_id", F.explode(F.call_function("terrane_cover", F.col("wkt"))).alias("c")).select("region_id", "c.*")


def place_in(x: Column, y: Column, inside: Column, border: Column) -> Column:
    """1 for a point inside, 2 for one on the border, 0 outside; border cells are tested exactly."""
    return F.when(inside, F.lit(1)).otherwise(F.call_function("terrane_in_cell", x, y, border))


def spots_in_regions(places: DataFrame, cells: DataFrame, levels: list[int], strict: bool = False) -> DataFrame:
    """Distinct (region_id, x, y) of places covered by the regions of a written cover table; ``strict`` leaves out borders."""
    keys = F.explode(F.array(*[_home(F.col("x"), F.col("y"), 2.0**lv, lv) for lv in levels]))
    keyed = places.select("x", "y", keys.alias("cell"))
    place = place_in(F.col("x"), F.col("y"), F.col("inside"), F.col("border"))
    hit = place == 1 if strict else place > 0
    return cells.join(keyed, "cell").where(hit).select("region_id", "x", "y").distinct()
