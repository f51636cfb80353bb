"""The parcel workflow on one page: anchors, council parcels with one anchor, owned free polygons, the parcel of each point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import exprs, geo
from terrane.functions.exprs import ratio_or_zero
from terrane.operators import graph, joins, overlay, polygons, selection
from terrane.plans import fixtures as fx
from terrane.plans import runner
from terrane.plans.fixtures import CNT, E, L, P, R, U, sql
from terrane.plans.spatial_queries import anchors_in
from terrane.session import Scratch
from terrane.sources.tables import table

QUERIES, ORACLES = {}, {}


def anchors(points: DataFrame, parcels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchors, free): parcels with and without points, with their counts."""
    counted = parcels.join(joins.count_points(points, parcels, "clean_fid", "uprn"), "clean_fid")
    return counted.where("n > 0"), counted.where("n = 0")


def anchor_workflow_all(spark: SparkSession, d: str) -> DataFrame:
    """(uprn, origin, parcel, area): the council parcel where it has exactly one anchor, else the anchor with what it owns."""
    parcels, points = fx.parcels(spark, d), fx.uprns(spark, d)
    scratch = Scratch(spark, "anchors")
    held, free = (scratch.put(df, name) for df, name in zip(anchors(points, parcels), ("held", "free"), strict=True))
    return _assigned(points, held, free, held, fx.plots(spark, d))


def _assigned(points: DataFrame, held: DataFrame, free: DataFrame, counted: DataFrame, councils: DataFrame) -> DataFrame:
    single = joins.exactly_one(anchors_in(counted, councils), "council_fid", "anchor")
    touching = joins.with_contact(joins.box_pairs(free, held)).where("len >= 0.5")
    claims = touching.select(F.col("a_clean_fid").alias("zero"), F.col("b_clean_fid").alias("anchor"), "len", ratio_or_zero(F.col("len"), F.col("b_perimeter")).alias("ratio"), F.col("a_area").alias("area"))
    owned = joins.direct_owners(claims).where("ratio >= 0.2").groupBy("anchor").agg(F.sum("area").alias("added"))
    fallback = held.select(F.col("clean_fid").alias("anchor"), "area").join(owned, "anchor", "left").select("anchor", (F.col("area") + F.coalesce("added", F.lit(0.0))).alias("area"))
    at = joins.points_in_boxes(points, held).groupBy("uprn").agg(F.min_by("b_clean_fid", F.struct("b_area", "b_clean_fid")).alias("anchor"))
    council = single.join(councils, "council_fid").select("anchor", "council_fid", ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("carea"))
    best = council.groupBy("anchor").agg(F.min(F.struct("council_fid", "carea")).alias("c"))
    out = at.join(fallback, "anchor").join(best, "anchor", "left")
    return out.select("uprn", F.when(F.col("c").isNotNull(), "council").otherwise("fallback").alias("origin"), F.coalesce("c.council_fid", "anchor").alias("parcel"), F.coalesce("c.carea", "area").alias("area"))


QUERIES["anchor_workflow_all"] = anchor_workflow_all
ORACLES["anchor_workflow_all"] = sql(P, U, L, CNT, E, """SINGLE AS (SELECT council_fid, min(clean_fid) AS anchor FROM (SELECT l.council_fid, p.clean_fid FROM P p JOIN CNT c ON c.clean_fid = p.clean_fid JOIN L l ON p.xmin < l.xmax AND l.xmin < p.xmax AND p.ymin < l.ymax AND l.ymin < p.ymax
  AND (least(p.xmax,l.xmax)-greatest(p.xmin,l.xmin))*(least(p.ymax,l.ymax)-greatest(p.ymin,l.ymin)) >= 90 WHERE c.n > 0) GROUP BY 1 HAVING count(*) = 1)""",
  """OWN AS (SELECT anchor, sum(area) AS added FROM (SELECT e.a AS zero, e.b AS anchor, p.area, e.len/q.perimeter AS ratio, row_number() OVER (PARTITION BY e.a ORDER BY e.len/q.perimeter DESC, e.len DESC, e.b) AS rn
  FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e JOIN P p ON p.clean_fid = e.a JOIN P q ON q.clean_fid = e.b JOIN CNT ca ON ca.clean_fid = e.a JOIN CNT cb ON cb.clean_fid = e.b WHERE ca.n = 0 AND cb.n > 0 AND e.len >= 0.5) WHERE rn = 1 AND ratio >= 0.2 GROUP BY 1)""",
  """PT AS (SELECT uprn, clean_fid AS anchor, area FROM (SELECT u.uprn, p.clean_fid, p.area, row_number() OVER (PARTITION BY u.uprn ORDER BY p.area, p.clean_fid) AS rn FROM U u JOIN P p ON u.x BETWEEN xmin AND xmax AND u.y BETWEEN ymin AND ymax) WHERE rn = 1)""",
  """CP AS (SELECT anchor, council_fid, (xmax-xmin)*(ymax-ymin) AS area, row_number() OVER (PARTITION BY anchor ORDER BY council_fid) AS rn FROM SINGLE JOIN L USING (council_fid))""",
  body="""SELECT uprn, CASE WHEN s.anchor IS NOT NULL THEN 'council' ELSE 'fallback' END AS origin, coalesce(s.council_fid, PT.anchor) AS parcel, coalesce(s.area, PT.area + coalesce(OWN.added, 0)) AS area
FROM PT LEFT JOIN OWN ON OWN.anchor = PT.anchor LEFT JOIN CP s ON s.anchor = PT.anchor AND s.rn = 1""")


# ---------------------------------------------------------------- preprocessing of raw polygons

#: Parameters of the preprocessing and their usual values.
PREPROCESS = {
    "min_area": 0.25, "overlap_tolerance": 0.01, "max_area": 1_000_000.0, "min_mrr_ratio": 0.2, "max_hull_gap": 0.6, "min_compactness": 0.02, "drop_large_roads": True, "road_width": 8.0, "road_area": 5_000.0,
    "hole_least": 1.0, "hole_most": 400.0, "gap_least": 1.0, "gap_most": 400.0, "gap_neighbours": 2, "gap_border": 0.5,
}


def _parts(df: DataFrame, least: float) -> DataFrame:
    """Polygons taken apart, numbered anew by source and part."""
    out = df.select("source_fid", "theme", "role", F.posexplode(geo.st_parts(F.col("geom"), least)).alias("part", "geom"))
    return polygons.with_measures(selection.numbered(out.withColumn("_k", F.xxhash64("geom")), ["source_fid", "part", "_k"], "clean_fid").drop("_k", "part"))


def preprocess_stages(raw: DataFrame, params: dict[str, object]) -> list[tuple[str, runner.Stage]]:
    """The stages of preprocessing raw polygons (source_fid, theme, wkt), each a function of the tables before it: normalised,
    without overlaps, within thresholds (and what was left out, with its reason), holes filled, gaps filled, validated."""
    p = PREPROCESS | params

    def normalised(spark, done):
        valid = raw.select("source_fid", "theme", geo.st_make_valid(geo.st_from_text(F.col("wkt"))).alias("geom")).where("geom is not null")
        rows = _parts(valid.withColumn("role", exprs.role(F.col("theme"), "preprocess")), p["min_area"])
        return rows.where(exprs.road_kept(F.col("theme"), F.col("area"), F.col("perimeter"), p["road_width"], p["road_area"])) if p["drop_large_roads"] else rows

    def deoverlapped(spark, done):
        ranked = done["normalised"].withColumn("role_rank", F.when(F.col("role") == "building", 0).when(F.col("role") == "road", 1).when(F.col("role") == "land", 2).otherwise(3))
        cut = overlay.deoverlap(ranked, ["role_rank", "area"], p["min_area"]).select("clean_fid", "geom").where("geom is not null")
        return _parts(cut.join(done["normalised"].drop("geom"), "clean_fid").select("source_fid", "theme", "role", "geom"), p["min_area"])

    def checked(spark, done):
        m = geo.st_shape(F.col("geom"))
        rules = [("too_large", F.col("area") > p["max_area"]), ("thin", F.col("m.mrr_ratio") < p["min_mrr_ratio"]), ("ragged", F.col("m.hull_gap") > p["max_hull_gap"]), ("not_compact", F.col("m.compactness") < p["min_compactness"])]
        return done["deoverlapped"].withColumn("m", m).withColumn("reason", exprs.exclude_reason(rules)).drop("m")

    def kept(spark, done):
        return done["checked"].where("reason is null or reason = ''").drop("reason")

    def holes_filled(spark, done):
        clean = done["kept"]
        holes = polygons.with_measures(overlay.hole_rows(clean, p["hole_least"], p["hole_most"], -1))
        taken = polygons.touching(holes, clean).where(F.col("overlap") > p["overlap_tolerance"]).select(F.col("a_clean_fid").alias("clean_fid"))
        free = holes.join(taken, "clean_fid", "left_anti").join(clean.select(F.col("clean_fid").alias("parent"), "source_fid"), "parent")
        return clean.unionByName(free.select(*[F.lit("gap").alias(c) if c in ("theme", "role") else F.col(c) for c in clean.columns]))

    def gaps_filled(spark, done):
        clean = done["holes_filled"]
        scratch = Scratch(spark, "gaps")
        near = scratch.put(polygons.touching(clean, clean, "clean_fid").where("len > 0 or overlap > 0").select(F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), "len"), "near")
        labels = graph.component_labels(near, clean.select(F.col("clean_fid").alias("v")), Scratch(spark, "gap-components"))
        gaps = overlay.coverage_gaps(clean.join(labels.withColumnRenamed("v", "clean_fid"), "clean_fid"), "component", p["gap_least"], p["gap_most"])
        gaps = scratch.put(polygons.with_measures(selection.numbered(gaps.withColumn("_k", F.xxhash64("geom")), ["component", "_k"], "gap_id").drop("_k", "component")), "found")
        taken = polygons.touching(gaps, clean).where(F.col("overlap") > p["overlap_tolerance"]).select(F.col("a_gap_id").alias("gap_id"))
        held = polygons.touching(gaps, clean).where(F.col("len") >= p["gap_border"]).groupBy(F.col("a_gap_id").alias("gap_id")).agg(
            F.count("*").alias("n"), F.max_by("b_source_fid", F.struct("len", (-F.col("b_clean_fid")).alias("m"))).alias("source_fid")
        ).where(F.col("n") >= p["gap_neighbours"])
        low = clean.agg(F.coalesce(F.min("clean_fid"), F.lit(0)).alias("low")).first()["low"]
        filled = gaps.join(taken, "gap_id", "left_anti").join(held.select("gap_id", "source_fid"), "gap_id").withColumn("clean_fid", F.lit(min(low, 0) - 1) - F.col("gap_id"))
        return clean.unionByName(filled.select(*[F.lit("gap").alias(c) if c in ("theme", "role") else F.col(c) for c in clean.columns]))

    def validated(spark, done):
        clean = done["gaps_filled"]
        over = polygons.touching(clean, clean, "clean_fid").where(F.col("overlap") > p["overlap_tolerance"])
        return over.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("overlap"), F.lit(0.0)).alias("overlap"))

    return [(f.__name__, f) for f in (normalised, deoverlapped, checked, kept, holes_filled, gaps_filled, validated)]


def preprocess(spark: SparkSession, raw: DataFrame, root: str, inputs: list[str] | None = None, **params: object) -> dict[str, object]:
    """Run all stages below ``root``; finished ones are skipped. Gives the summary of :func:`runner.run_stages`."""
    geo.register(spark)
    return runner.run_stages(spark, preprocess_stages(raw, params), root, PREPROCESS | params, inputs=inputs)


def preprocess_parcels(spark: SparkSession, d: str) -> DataFrame:
    """(stage, rows, area) of preprocessing the predicted parcels, from raw to validated, and the overlap left at the end."""
    root = Scratch(spark, "preprocess").base
    t = table(spark, d, "predicted_parcels_with_uprn").where("pred_component_id is not null and geom_wkt is not null")
    raw = t.groupBy(F.col("pred_component_id").alias("source_fid")).agg(F.min("geom_wkt").alias("wkt"), F.max(F.when(F.col("source_count") > 1, "Land").otherwise("Building")).alias("theme"))
    done = preprocess(spark, raw, root, drop_large_roads=False)
    at = f"{root}/{done['signature']}"
    out = None
    for name in ("normalised", "deoverlapped", "kept", "holes_filled", "gaps_filled"):
        one = spark.read.parquet(f"{at}/{name}").agg(F.lit(name).alias("stage"), F.count("*").alias("rows"), F.round(F.sum("area"), 4).alias("area"))
        out = one if out is None else out.unionByName(one)
    return out.unionByName(spark.read.parquet(f"{at}/validated").select(F.lit("overlap_left").alias("stage"), F.col("pairs").alias("rows"), F.round("overlap", 4).alias("area")))


QUERIES["preprocess_parcels"] = preprocess_parcels
