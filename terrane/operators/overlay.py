"""Overlay of polygons: removing overlaps, filling holes and gaps, coverage, windows over the plane.

Polygons are rows (clean_fid, geom, area, xmin, ymin, xmax, ymax, ...); geometry is WKB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import joins
from terrane.operators import polygons as polygons_
from terrane.operators.selection import numbered
from terrane.session import Scratch

UNION_CELL = 256.0


def deoverlap(polygons: DataFrame, order: list[str], least: float) -> DataFrame:
    """(clean_fid, geom, area, removed): every polygon without the parts that pieces accepted before it in ``order`` hold.

    Cutting by all earlier polygons gives the same, unless a piece below ``least`` was dropped and leaves its part to
    others; only then the pieces are accepted in rounds, each polygon once all earlier ones it overlaps are decided.
    The earlier neighbours of a polygon are gathered per polygon (neighbours only), never all."""
    scratch = Scratch(polygons.sparkSession, "deoverlap")
    ranked = polygons.withColumn("rank", F.struct(*order, "clean_fid"))
    pairs = polygons_.candidates(ranked, ranked).where(F.col("b_rank") < F.col("a_rank"))
    cover = pairs.groupBy("a_clean_fid").agg(geo.st_union_all(F.collect_list("b_geom")).alias("cover")).withColumnRenamed("a_clean_fid", "clean_fid")
    uncut = F.when(F.col("cover").isNull(), F.col("geom")).otherwise(geo.st_difference(F.col("geom"), F.col("cover")))
    cut = polygons.join(cover, "clean_fid", "left").withColumn("whole", uncut)
    out = scratch.put(cut.select("clean_fid", "area", geo.st_polygonal(F.col("whole"), least).alias("left"), F.coalesce(geo.st_shape(F.col("whole"))["area"], F.lit(0.0)).alias("kept")), "cut")
    out = out.withColumn("left_area", F.coalesce(geo.st_shape(F.col("left"))["area"], F.lit(0.0)))
    if not out.where("kept - left_area > 1e-9").isEmpty():
        return _deoverlap_in_rounds(polygons, pairs.select(F.col("a_clean_fid").alias("later"), F.col("b_clean_fid").alias("earlier")), least, scratch)
    return out.select("clean_fid", F.col("left").alias("geom"), F.col("left_area").alias("area"), (F.col("area") - F.col("left_area")).alias("removed"))


def _deoverlap_in_rounds(polygons: DataFrame, pairs: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    pairs = scratch.put(pairs, "pairs")
    open_ = scratch.put(polygons.select("clean_fid", "geom", "area"), "open0")
    accepted, done, r = None, [], 0
    while not open_.isEmpty():
        r += 1
        waits = pairs.join(open_.select(F.col("clean_fid").alias("earlier")), "earlier", "left_semi").select(F.col("later").alias("clean_fid"))
        due = scratch.put(open_.join(waits, "clean_fid", "left_anti"), f"due{r}")
        if accepted is None:
            piece = due.withColumn("left", geo.st_polygonal(F.col("geom"), least))
        else:
            cover = pairs.join(due.select(F.col("clean_fid").alias("later")), "later", "left_semi").join(accepted.withColumnRenamed("clean_fid", "earlier"), "earlier")
            cover = cover.groupBy(F.col("later").alias("clean_fid")).agg(geo.st_union_all(F.collect_list("left")).alias("cover"))
            rest = F.when(F.col("cover").isNull(), F.col("geom")).otherwise(geo.st_difference(F.col("geom"), F.col("cover")))
            piece = due.join(cover, "clean_fid", "left").withColumn("left", geo.st_polygonal(rest, least))
        done.append(scratch.put(piece.select("clean_fid", "area", "left", F.coalesce(geo.st_shape(F.col("left"))["area"], F.lit(0.0)).alias("left_area")), f"done{r}"))
        open_ = scratch.put(open_.join(due.select("clean_fid"), "clean_fid", "left_anti"), f"open{r}")
        fresh = done[-1].where("left_area > 0").select("clean_fid", "left")
        accepted = fresh if accepted is None else accepted.unionByName(fresh)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("clean_fid", F.col("left").alias("geom"), F.col("left_area").alias("area"), (F.col("area") - F.col("left_area")).alias("removed"))


def union_of(df: DataFrame, key: str) -> DataFrame:
    """(key, geom): the union of the polygons (key, geom, xmin, ymin) of each key, first by cells of the plane, whose inner
    borders vanish, then of the cells; so no row gathers all polygons of a large group."""
    cell = lambda c: F.floor(F.col(c) / UNION_CELL)
    near = df.groupBy(key, cell("xmin").alias("_cx"), cell("ymin").alias("_cy")).agg(geo.st_union_all(F.collect_list("geom")).alias("geom"))
    return near.groupBy(key).agg(geo.st_union_all(F.collect_list("geom")).alias("geom"))


def overlap_total(polygons: DataFrame, tolerance: float, most: int | None = None) -> DataFrame:
    """One row: pairs that overlap by more than ``tolerance``, their total, and whether all pairs were looked at."""
    pairs = joins.with_contact(joins.box_pairs(polygons, polygons, same=True)).where(F.col("overlap") > tolerance).select("overlap")
    if most is not None:
        pairs = pairs.limit(most + 1)
    out = pairs.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("overlap"), F.lit(0.0)).alias("total"))
    return out.withColumn("validated", F.lit(True) if most is None else F.col("pairs") <= most)


def hole_rows(polygons: DataFrame, least: float, most: float, first_id: int) -> DataFrame:
    """(clean_fid, parent, geom, area): holes within an area window, with negative ids from ``first_id`` down."""
    holes = polygons.select(F.col("clean_fid").alias("parent"), F.posexplode(geo.st_holes(F.col("geom"), least)).alias("pos", "geom"))
    sized = holes.withColumn("area", geo.st_shape(F.col("geom"))["area"]).where(F.col("area") <= most)
    return numbered(sized, ["parent", "pos"], "_n").withColumn("clean_fid", F.lit(first_id) - F.col("_n")).select("clean_fid", "parent", "geom", "area")


def coverage_gaps(polygons: DataFrame, component: str, least: float, most: float) -> DataFrame:
    """(component, geom, area): holes in the union of each component that no polygon of it fills."""
    merged = union_of(polygons, component).withColumnRenamed("geom", "u")
    return merged.select(component, F.explode(geo.st_holes(F.col("u"), least)).alias("geom")).withColumn("area", geo.st_shape(F.col("geom"))["area"]).where(F.col("area") <= most)


def gap_owner(gaps: DataFrame, polygons: DataFrame, least_len: float, least_neighbours: int) -> DataFrame:
    """(gap_id, clean_fid, len): the neighbour with the longest border of gaps (gap_id, geom, box) with enough neighbours."""
    pairs = joins.box_pairs(gaps, polygons).withColumn("len", geo.st_shared_length(F.col("a_geom"), F.col("b_geom"))).where(F.col("len") >= least_len)
    n = pairs.groupBy("a_gap_id").agg(F.count("*").alias("n"), F.max(F.struct("len", (-F.col("b_clean_fid")).alias("m"))).alias("m"))
    return n.where(F.col("n") >= least_neighbours).select(F.col("a_gap_id").alias("gap_id"), (-F.col("m.m")).alias("clean_fid"), F.col("m.len").alias("len"))


def coverage_of_boxes(targets: DataFrame, polygons: DataFrame, key: str) -> DataFrame:
    """(key, covered, ratio, missing) of each target by the union of the polygons that touch it; no target has ratio 1 for nothing
    unless its area is 0."""
    pairs = joins.box_pairs(targets, polygons)
    cover = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(geo.st_union_all(F.collect_list("b_geom")).alias("cover"))
    joined = targets.join(cover, key, "left")
    shared = F.least(F.coalesce(geo.st_shared_area(F.col("geom"), F.col("cover")), F.lit(0.0)), F.col("area"))
    return joined.withColumn("covered", shared).select(
        key, "covered", F.when(F.col("area") <= 0, 1.0).otherwise(F.col("covered") / F.col("area")).alias("ratio"), (F.col("area") - F.col("covered")).alias("missing")
    )


def with_box(df: DataFrame) -> DataFrame:
    """xmin, ymin, xmax, ymax of a geometry column."""
    box = df.withColumn("_b", geo.st_box(F.col("geom")))
    return box.select(*df.columns, *[F.col("_b")[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))])


def absorb(parts: DataFrame, hosts: DataFrame, share: float) -> DataFrame:
    """(clean_fid, host): polygons that lie to ``share`` in a hole of a host (host, hole geometry); the best host wins."""
    pairs = joins.box_pairs(parts, hosts).withColumn("cov", geo.st_shared_area(F.col("a_geom"), F.col("b_geom")) / F.col("a_area")).where(F.col("cov") >= share)
    return pairs.groupBy("a_clean_fid").agg(F.max(F.struct("cov", (-F.col("b_host")).alias("m"))).alias("m")).select(F.col("a_clean_fid").alias("clean_fid"), (-F.col("m.m")).alias("host"))


def window_grid(bounds: DataFrame, size: float, overlap: float) -> DataFrame:
    """(ix, iy, xmin, ymin, xmax, ymax): sliding windows over a bounding box, cut at its far edges."""
    step = size - overlap
    n = lambda lo, hi: F.greatest(F.lit(1), F.ceil((F.col(hi) - F.col(lo)) / step).cast("int"))
    grid = bounds.withColumn("ix", F.explode(F.sequence(F.lit(0), n("xmin", "xmax") - 1))).withColumn("iy", F.explode(F.sequence(F.lit(0), n("ymin", "ymax") - 1)))
    x, y = F.col("xmin") + F.col("ix") * step, F.col("ymin") + F.col("iy") * step
    return grid.select("ix", "iy", x.alias("wx"), y.alias("wy"), F.least(x + size, F.col("xmax")).alias("wxmax"), F.least(y + size, F.col("ymax")).alias("wymax")).select(
        "ix", "iy", F.col("wx").alias("xmin"), F.col("wy").alias("ymin"), F.col("wxmax").alias("xmax"), F.col("wymax").alias("ymax")
    )


def merge_groups(polygons: DataFrame, target: DataFrame) -> DataFrame:
    """(target, geom, area, members): polygons merged into the target they are assigned to (clean_fid, target)."""
    moved = polygons.join(target, "clean_fid")
    g = union_of(moved, "target").join(moved.groupBy("target").agg(F.array_sort(F.collect_list("clean_fid")).alias("members")), "target")
    return g.select("target", "geom", geo.st_shape(F.col("geom"))["area"].alias("area"), "members")


def half_clip(polygons: DataFrame, key: str, seed: int) -> DataFrame:
    """Each polygon cut to one of the four halves of its box, chosen by a hash of its key (for negative examples)."""
    side = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(4))
    mx, my = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    box = geo.box_wkt(
        F.when(side == 0, mx).otherwise(F.col("xmin")), F.when(side == 1, my).otherwise(F.col("ymin")),
        F.when(side == 2, mx).otherwise(F.col("xmax")), F.when(side == 3, my).otherwise(F.col("ymax")),
    )
    return polygons.withColumn("geom", geo.st_intersection(F.col("geom"), geo.st_from_text(box)))


def neighbour_sliver(pairs: DataFrame, reach: float) -> DataFrame:
    """The first polygon of a pair (a_geom, b_geom) with the part of the second that lies within ``reach`` of it."""
    return pairs.withColumn("geom", geo.st_union(F.col("a_geom"), geo.st_intersection(F.col("b_geom"), geo.st_buffer(F.col("a_geom"), reach))))
