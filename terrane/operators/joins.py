"""Joins of boxes and points by grid cells, and the joins built on them.

A box meets every cell it touches; two boxes are compared in the one cell that holds the lower left
corner of their common part, so no pair comes twice and nothing has to be made distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = 64.0


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))


def on_grid(df: DataFrame, cell: float = CELL) -> DataFrame:
    """Boxes (xmin, ymin, xmax, ymax) once per cell they touch."""
    return df.withColumn("_cx", _cells(F.col("xmin"), F.col("xmax"), cell)).withColumn("_cy", _cells(F.col("ymin"), F.col("ymax"), cell))


def points_on_grid(df: DataFrame, cell: float = CELL) -> DataFrame:
    return df.withColumn("_cx", F.floor(F.col("x") / cell)).withColumn("_cy", F.floor(F.col("y") / cell))


def renamed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("_cx", "_cy")) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def box_pairs(left: DataFrame, right: DataFrame, same: bool = False, reach: float = 0.0, cell: float = CELL) -> DataFrame:
    """Pairs of boxes that touch or overlap, or lie within ``reach`` (columns a_..., b_...); of one table each pair once."""
    grown = left.withColumn("xmin", F.col("xmin") - reach).withColumn("ymin", F.col("ymin") - reach).withColumn("xmax", F.col("xmax") + reach).withColumn("ymax", F.col("ymax") + reach) if reach else left
    a, b = renamed(on_grid(grown, cell), "a_"), renamed(on_grid(right, cell), "b_")
    x0, y0 = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    hit = (x0 <= F.least("a_xmax", "b_xmax")) & (y0 <= F.least("a_ymax", "b_ymax"))
    home = (F.floor(x0 / cell) == F.col("_cx")) & (F.floor(y0 / cell) == F.col("_cy"))
    out = a.join(b, ["_cx", "_cy"]).where(hit & home).drop("_cx", "_cy")
    if same:
        out = out.where("a_clean_fid < b_clean_fid")
    if reach:
        for c, d in (("a_xmin", reach), ("a_ymin", reach), ("a_xmax", -reach), ("a_ymax", -reach)):
            out = out.withColumn(c, F.col(c) + d)
    return out


def overlap_x() -> Column:
    return F.greatest(F.lit(0.0), F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin"))


def overlap_y() -> Column:
    return F.greatest(F.lit(0.0), F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin"))


def with_contact(pairs: DataFrame) -> DataFrame:
    """``len``: length of the common border of two boxes; ``overlap``: common area."""
    ix, iy = overlap_x(), overlap_y()
    c = F.col
    side = lambda hit, v: F.when(hit, v).otherwise(0.0)
    length = (
        side((c("a_xmax") == c("b_xmin")) | (c("b_xmax") == c("a_xmin")), iy) + side((c("a_xmin") == c("b_xmin")) & (ix > 0), iy) + side((c("a_xmax") == c("b_xmax")) & (ix > 0), iy)
        + side((c("a_ymax") == c("b_ymin")) | (c("b_ymax") == c("a_ymin")), ix) + side((c("a_ymin") == c("b_ymin")) & (iy > 0), ix) + side((c("a_ymax") == c("b_ymax")) & (iy > 0), ix)
    )
    return pairs.withColumn("len", length).withColumn("overlap", ix * iy)


def points_in_boxes(points: DataFrame, boxes: DataFrame, strict: bool = False, cell: float = CELL) -> DataFrame:
    """Point columns and box columns (b_...) of each point in a box; ``strict`` leaves out the border."""
    pts, bx = points_on_grid(points, cell), renamed(on_grid(boxes, cell), "b_")
    x, y = F.col("x"), F.col("y")
    inside = (
        (x > F.col("b_xmin")) & (x < F.col("b_xmax")) & (y > F.col("b_ymin")) & (y < F.col("b_ymax"))
        if strict
        else (x >= F.col("b_xmin")) & (x <= F.col("b_xmax")) & (y >= F.col("b_ymin")) & (y <= F.col("b_ymax"))
    )
    return pts.join(bx, ["_cx", "_cy"]).where(inside).drop("_cx", "_cy")


def count_points(points: DataFrame, boxes: DataFrame, key: str, pid: str, strict: bool = False) -> DataFrame:
    """(key, n): distinct points of every box, 0 where there is none."""
    hits = points_in_boxes(points, boxes, strict).groupBy(F.col(f"b_{key}").alias(key)).agg(F.countDistinct(pid).alias("n"))
    return boxes.select(key).join(hits, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order (null orders must be explicit)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def exactly_one(df: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right) where a left row has exactly one distinct right row."""
    return df.groupBy(left).agg(F.countDistinct(right).alias("_n"), F.min(right).alias(right)).where("_n = 1").drop("_n")


def cardinality_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: none for a valid many-to-one side."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def nearest_box(points: DataFrame, boxes: DataFrame, pid: str, key: str, cutoff: float, cell: float = CELL) -> DataFrame:
    """(pid, key, dist) of the nearest box within ``cutoff``; ties by area, then key. Each point asks the cells in reach only."""
    asked = points.withColumn("xmin", F.col("x") - cutoff).withColumn("ymin", F.col("y") - cutoff).withColumn("xmax", F.col("x") + cutoff).withColumn("ymax", F.col("y") + cutoff)
    pairs = box_pairs(asked, boxes, cell=cell)
    dx = F.greatest(F.col("b_xmin") - F.col("a_x"), F.col("a_x") - F.col("b_xmax"), F.lit(0.0))
    dy = F.greatest(F.col("b_ymin") - F.col("a_y"), F.col("a_y") - F.col("b_ymax"), F.lit(0.0))
    near = pairs.withColumn("d2", dx * dx + dy * dy).where(F.col("d2") <= cutoff * cutoff)
    best = near.groupBy(F.col(f"a_{pid}").alias(pid)).agg(F.min(F.struct("d2", F.col("b_area").alias("area"), F.col(f"b_{key}").alias("k"))).alias("m"))
    return best.select(pid, F.col("m.k").alias(key), F.sqrt("m.d2").alias("dist"))


def direct_owners(claims: DataFrame) -> DataFrame:
    """One owner per free polygon: (zero, anchor, len, ratio), greatest ratio, then length, then smaller anchor."""
    return first_by(claims, ["zero"], [F.desc("ratio"), F.desc("len"), F.asc("anchor")])


def secondary_owners(claims: DataFrame, owners: DataFrame, allowed: DataFrame, least_share: float, least_ratio: float) -> DataFrame:
    """A second owner for anchors in ``allowed`` (anchor) whose ratio comes close to the best, if the best is not in it."""
    best = owners.select("zero", F.col("anchor").alias("best_anchor"), F.col("ratio").alias("best_ratio"))
    joined = claims.join(best, "zero").join(allowed, "anchor", "left_semi").join(allowed.withColumnRenamed("anchor", "best_anchor"), "best_anchor", "left_anti")
    share = F.when(F.col("best_ratio") == 0, 0.0).otherwise(F.col("ratio") / F.col("best_ratio"))
    close = joined.withColumn("share", share).where((F.col("share") >= least_share) & (F.col("ratio") >= least_ratio) & (F.col("anchor") != F.col("best_anchor")))
    return first_by(close, ["zero"], [F.desc("share"), F.desc("ratio"), F.desc("len"), F.asc("anchor")]).select("zero", "anchor", "len", "ratio", "share")


def set_overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, both) for sets given as (left_id, item) and (right_id, item): an inverted-index join."""
    return left.distinct().join(right.distinct(), "item").groupBy("left_id", "right_id").agg(F.count("*").alias("both"))


def containment_class(both: Column, left_size: Column, right_size: Column) -> Column:
    """exact, partial (left within right), overmerge (right within left), mismatch or none."""
    return (
        F.when(F.coalesce(both, F.lit(0)) == 0, "none").when((both == left_size) & (both == right_size), "exact").when(both == left_size, "partial")
        .when(both == right_size, "overmerge").otherwise("mismatch")
    )
