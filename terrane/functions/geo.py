"""Geometry functions on WKB columns, run in the JVM by a small jar on the JTS classes of Spark.

Null or unreadable geometry gives null. ``register`` attaches the jar to a running session.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

JAR = Path(__file__).resolve().parent.parent / "geom" / "terrane-geo.jar"

_GEOMETRIES = T.ArrayType(T.BinaryType())
_FUNCTIONS = {
    "terrane_one": ("One", T.BinaryType()), "terrane_two": ("Two", T.BinaryType()), "terrane_measure": ("Measure", T.DoubleType()),
    "terrane_relate": ("Relate", T.BooleanType()), "terrane_parts": ("Parts", _GEOMETRIES), "terrane_union_all": ("UnionAll", T.BinaryType()),
    "terrane_shape": ("Shape", T.ArrayType(T.DoubleType())), "terrane_from_text": ("FromText", T.BinaryType()), "terrane_to_text": ("ToText", T.StringType()),
    "terrane_box": ("Box", T.ArrayType(T.DoubleType())), "terrane_in_cell": ("InCell", T.IntegerType()),
    "terrane_cover": ("Cover", T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("cell", T.LongType()), T.StructField("inside", T.BooleanType()), T.StructField("border", T.BinaryType())]))),
}
#: Order of the measures that the shape function gives.
SHAPE_FIELDS = (
    "area", "perimeter", "part_count", "hole_count", "hole_area", "mrr_short", "mrr_long", "mrr_area", "mrr_axis", "hull_area",
    "hull_perimeter", "bbox_area", "near10", "near15", "near20", "deviation_mean", "deviation_p90",
)


def register(spark: SparkSession) -> None:
    """Attach the jar and name its functions; safe to call again."""
    if spark.conf.get("terrane.geo", None) == spark.sparkContext.applicationId:
        return
    spark.sql(f"ADD JAR '{JAR}'")
    for name, (cls, kind) in _FUNCTIONS.items():
        spark.udf.registerJavaFunction(name, f"terrane.geo.{cls}", kind)
    spark.conf.set("terrane.geo", spark.sparkContext.applicationId)


def _one(op: str, g: Column, n: Column | float = 0.0) -> Column:
    return F.call_function("terrane_one", F.lit(op), g, n if isinstance(n, Column) else F.lit(float(n)))


def st_from_text(wkt: Column) -> Column:
    return F.call_function("terrane_from_text", wkt)


def st_to_text(g: Column) -> Column:
    return F.call_function("terrane_to_text", g)


def st_box(g: Column) -> Column:
    """array of xmin, ymin, xmax, ymax, area, perimeter."""
    return F.call_function("terrane_box", g)


def st_make_valid(g: Column) -> Column:
    return _one("valid", g)


def st_polygonal(g: Column, least: float = 0.0) -> Column:
    """Only the polygons of a geometry, without those below an area."""
    return _one("polygonal", g, least)


def st_fill_holes(g: Column) -> Column:
    return _one("filled", g)


def st_hull(g: Column) -> Column:
    return _one("hull", g)


def st_envelope(g: Column) -> Column:
    return _one("envelope", g)


def st_centroid(g: Column) -> Column:
    return _one("centroid", g)


def st_inner_point(g: Column) -> Column:
    return _one("inner_point", g)


def st_rectangle(g: Column) -> Column:
    """Minimum rotated rectangle."""
    return _one("rectangle", g)


def st_buffer(g: Column, r: float, mitre: bool = False) -> Column:
    return _one("mitre" if mitre else "buffer", g, r)


def st_closing(g: Column, r: float) -> Column:
    """Slits narrower than 2r closed (mitred buffer out and in)."""
    return _one("closing", g, r)


def st_opening(g: Column, r: float) -> Column:
    return _one("opening", g, r)


def st_difference(a: Column, b: Column) -> Column:
    return F.call_function("terrane_two", F.lit("difference"), a, b)


def st_intersection(a: Column, b: Column) -> Column:
    return F.call_function("terrane_two", F.lit("intersection"), a, b)


def st_union(a: Column, b: Column) -> Column:
    return F.call_function("terrane_two", F.lit("union"), a, b)


def st_union_all(array: Column) -> Column:
    return F.call_function("terrane_union_all", array)


def st_parts(g: Column, least: float = 0.0) -> Column:
    """array of the polygons of a geometry at or above an area."""
    return F.call_function("terrane_parts", F.lit("polygons"), g, F.lit(float(least)))


def st_holes(g: Column, least: float = 0.0) -> Column:
    return F.call_function("terrane_parts", F.lit("holes"), g, F.lit(float(least)))


def st_shared_area(a: Column, b: Column) -> Column:
    return F.call_function("terrane_measure", F.lit("shared_area"), a, b)


def st_shared_length(a: Column, b: Column) -> Column:
    return F.call_function("terrane_measure", F.lit("shared_length"), a, b)


def st_shared_pieces(a: Column, b: Column) -> Column:
    return F.call_function("terrane_measure", F.lit("shared_pieces"), a, b).cast("int")


def st_distance(a: Column, b: Column) -> Column:
    return F.call_function("terrane_measure", F.lit("distance"), a, b)


def _relate(op: str, a: Column, b: Column, tolerance: float = 0.0) -> Column:
    return F.call_function("terrane_relate", F.lit(op), a, b, F.lit(float(tolerance)))


def st_intersects(a: Column, b: Column) -> Column:
    return _relate("intersects", a, b)


def st_covers(a: Column, b: Column) -> Column:
    return _relate("covers", a, b)


def st_within(a: Column, b: Column) -> Column:
    return _relate("within", a, b)


def st_touches(a: Column, b: Column) -> Column:
    return _relate("touches", a, b)


def st_near(a: Column, b: Column, tolerance: float) -> Column:
    """Covered, or within a tolerance."""
    return _relate("near", a, b, tolerance)


def st_iou(a: Column, b: Column, area_a: Column, area_b: Column) -> Column:
    shared = st_shared_area(a, b)
    return shared / F.when(area_a + area_b - shared == 0, 1.0).otherwise(area_a + area_b - shared)


def st_shape(g: Column) -> Column:
    """struct of SHAPE_FIELDS and the ratios made from them."""
    m = F.call_function("terrane_shape", g)
    f = {name: m[i] for i, name in enumerate(SHAPE_FIELDS)}

    def over(a: Column, b: Column) -> Column:
        return a / F.when(b == 0, 1.0).otherwise(b)

    derived = {
        "mrr_ratio": over(f["area"], f["mrr_area"]), "hull_gap": F.lit(1.0) - over(f["area"], f["hull_area"]),
        "convexity": over(f["area"], f["hull_area"]), "bbox_fill": over(f["area"], f["bbox_area"]),
        "compactness": F.lit(12.566370614359172) * over(f["area"], f["perimeter"] * f["perimeter"]),
        "notch": F.greatest(F.lit(0.0), over(f["perimeter"], f["hull_perimeter"]) - 1.0),
        "aspect": over(f["mrr_long"], f["mrr_short"]),
    }
    fit = F.least(F.lit(1.0), over(F.lit(2.0) * (f["mrr_short"] + f["mrr_long"]), f["perimeter"]))
    derived["regularity"] = 0.35 * derived["mrr_ratio"] + 0.25 * derived["convexity"] + 0.20 * fit + 0.20 * f["near10"]
    return F.struct(*[v.alias(k) for k, v in (f | derived).items()])


def box_wkt(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """POLYGON text of an axis-parallel box."""
    p = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(
        F.lit("POLYGON (("), F.concat_ws(", ", p(xmin, ymin), p(xmax, ymin), p(xmax, ymax), p(xmin, ymax), p(xmin, ymin)), F.lit("))")
    )


def square_wkt(x: Column, y: Column, side: float) -> Column:
    """A square round a point."""
    h = side / 2.0
    return box_wkt(x - h, y - h, x + h, y + h)


def line_wkt(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """A line between two points."""
    p = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(F.lit("LINESTRING ("), p(ax, ay), F.lit(", "), p(bx, by), F.lit(")"))
