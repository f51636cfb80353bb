"""Queries of the spatial joins and everything built on neighbouring parcels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.functions import exprs, geo
from terrane.operators import joins
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import B, CNT, E, L, P, R, U, sql

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its function name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _counted(spark: SparkSession, d: str) -> DataFrame:
    p = fx.parcels(spark, d)
    return p.join(joins.count_points(fx.uprns(spark, d), p, "clean_fid", "uprn"), "clean_fid")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring pairs a < b with contact length and overlap."""
    p = fx.parcels(spark, d)
    return joins.with_contact(joins.box_pairs(p, p, same=True))


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("a", "b", "len").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "len"))


def _short(e: DataFrame) -> DataFrame:
    return e.where("len > 0").select(F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), "len")


@query(sql(P, U, CNT, body="SELECT clean_fid, CAST(n AS BIGINT) AS n FROM CNT"))
def point_parcel_count(spark, d):
    return joins.count_points(fx.uprns(spark, d), fx.parcels(spark, d), "clean_fid", "uprn")


@query(sql(P, B, body="""SELECT clean_fid, sum(i) AS n_intersects, sum(w) AS n_within FROM (
  SELECT p.clean_fid, CAST(x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax AS BIGINT) AS i, CAST(x > xmin AND x < xmax AND y > ymin AND y < ymax AS BIGINT) AS w FROM P p, B b)
GROUP BY 1 HAVING sum(i) > 0"""))
def point_parcel_within_vs_intersects(spark, d):
    p, b = fx.parcels(spark, d), fx.border_points(spark, d)
    n, w = joins.count_points(b, p, "clean_fid", "pid"), joins.count_points(b, p, "clean_fid", "pid", strict=True)
    return n.where("n > 0").join(w.withColumnRenamed("n", "n_within"), "clean_fid").select("clean_fid", F.col("n").alias("n_intersects"), "n_within")


@query(sql(P, U, CNT, body="""SELECT uprn, clean_fid, matches FROM (
  SELECT u.uprn, p.clean_fid, count(p.clean_fid) OVER (PARTITION BY u.uprn) AS matches,
    row_number() OVER (PARTITION BY u.uprn ORDER BY CAST(c.n = 1 AS INT) DESC NULLS LAST, CAST(c.n > 0 AS INT) DESC NULLS LAST, p.area NULLS LAST, p.clean_fid) AS rn
  FROM U u LEFT JOIN P p ON u.x BETWEEN p.xmin AND p.xmax AND u.y BETWEEN p.ymin AND p.ymax LEFT JOIN CNT c ON c.clean_fid = p.clean_fid) WHERE rn = 1"""))
def point_best_parcel_left(spark, d):
    u = fx.uprns(spark, d)
    hits = joins.points_in_boxes(u, _counted(spark, d)).select("uprn", "b_clean_fid", "b_n", "b_area")
    order = [F.desc((F.col("b_n") == 1).cast("int")), F.desc((F.col("b_n") > 0).cast("int")), F.asc("b_area"), F.asc("b_clean_fid")]
    best = joins.first_by(hits, ["uprn"], order).join(hits.groupBy("uprn").agg(F.count("*").alias("matches")), "uprn")
    return u.select("uprn").join(best, "uprn", "left").select("uprn", F.col("b_clean_fid").alias("clean_fid"), F.coalesce("matches", F.lit(0)).alias("matches"))


@query(sql(P, U, CNT, body="""SELECT uprn, clean_fid, round(dist, 6) AS dist FROM (SELECT u.uprn, p.clean_fid, sqrt(dx*dx+dy*dy) AS dist,
  row_number() OVER (PARTITION BY u.uprn ORDER BY dx*dx+dy*dy, p.area, p.clean_fid) AS rn FROM (
   SELECT u, p, greatest(p.xmin-u.x, u.x-p.xmax, 0) AS dx, greatest(p.ymin-u.y, u.y-p.ymax, 0) AS dy FROM U u, (SELECT P.* FROM P JOIN CNT ON P.clean_fid = CNT.clean_fid WHERE CNT.n > 0) p)
  WHERE dx*dx+dy*dy <= 225) WHERE rn = 1"""))
def point_nearest_anchor(spark, d):
    anchors = _counted(spark, d).where("n > 0")
    return joins.nearest_box(fx.uprns(spark, d), anchors, "uprn", "clean_fid", 15.0).withColumn("dist", F.round("dist", 6))


@query(sql(P, U, body="""SELECT uprn, clean_fid, hits FROM (SELECT u.uprn, p.clean_fid, count(*) OVER (PARTITION BY u.uprn) AS hits,
  row_number() OVER (PARTITION BY u.uprn ORDER BY p.area, p.clean_fid) AS rn FROM U u JOIN P p ON u.x BETWEEN xmin AND xmax AND u.y BETWEEN ymin AND ymax) WHERE rn = 1"""))
def point_smallest_container(spark, d):
    hits = joins.points_in_boxes(fx.uprns(spark, d), fx.parcels(spark, d))
    return hits.groupBy("uprn").agg(F.min_by("b_clean_fid", F.struct("b_area", "b_clean_fid")).alias("clean_fid"), F.count("*").alias("hits"))


_OVER = """O AS (SELECT p.clean_fid, r.council_fid, p.area, greatest(0.0, least(p.xmax,r.xmax)-greatest(p.xmin,r.xmin))*greatest(0.0, least(p.ymax,r.ymax)-greatest(p.ymin,r.ymin)) AS overlap FROM P p, R r)"""


@query(sql(P, R, _OVER, body="""SELECT clean_fid, council_fid, round(overlap/area, 6) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY clean_fid ORDER BY overlap/area DESC, overlap DESC, council_fid) AS rn
  FROM O WHERE overlap > 0) WHERE rn = 1"""))
def parcel_max_overlap_reference(spark, d):
    pairs = joins.box_pairs(fx.parcels(spark, d), fx.councils(spark, d)).withColumn("overlap", joins.overlap_x() * joins.overlap_y()).where("overlap > 0")
    best = pairs.groupBy("a_clean_fid").agg(F.max(F.struct((F.col("overlap") / F.col("a_area")).alias("cov"), "overlap", (-F.col("b_council_fid")).alias("m"))).alias("m"))
    return best.select(F.col("a_clean_fid").alias("clean_fid"), (-F.col("m.m")).alias("council_fid"), F.round("m.cov", 6).alias("coverage"))


@query(sql(P, E, body="""SELECT land, building, round(score, 6) AS score FROM (SELECT a AS land, b AS building, len / max(len) OVER (PARTITION BY a) AS score,
  row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b
  WHERE p.theme = 'Land' AND q.theme = 'Building' AND len > 0) WHERE rn = 1"""))
def land_best_building(spark, d):
    theme = fx.parcels(spark, d).select(F.col("clean_fid"), "theme")
    e = _both_ways(_short(_edges(spark, d))).join(theme.where("theme = 'Land'").select(F.col("clean_fid").alias("a")), "a").join(theme.where("theme = 'Building'").select(F.col("clean_fid").alias("b")), "b")
    scored = e.withColumn("score", F.col("len") / F.max("len").over(Window.partitionBy("a")))
    return joins.first_by(scored, ["a"], [F.desc("len"), F.asc("b")]).select(F.col("a").alias("land"), F.col("b").alias("building"), F.round("score", 6).alias("score"))


@query(sql(P, E, body="""SELECT a AS building, b AS land, len FROM (SELECT a, b, len, row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e
  JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE p.theme = 'Building' AND q.theme = 'Land' AND len > 0
  AND a NOT IN (SELECT b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e
    JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE p.theme = 'Land' AND q.theme = 'Building' AND len > 0) WHERE rn = 1)) WHERE rn = 1"""))
def independent_building_land(spark, d):
    used = land_best_building(spark, d).select(F.col("building").alias("a"))
    theme = fx.parcels(spark, d).select("clean_fid", "theme")
    e = _both_ways(_short(_edges(spark, d))).join(theme.where("theme = 'Building'").select(F.col("clean_fid").alias("a")), "a").join(theme.where("theme = 'Land'").select(F.col("clean_fid").alias("b")), "b")
    return joins.first_by(e.join(used, "a", "left_anti"), ["a"], [F.desc("len"), F.asc("b")]).select(F.col("a").alias("building"), F.col("b").alias("land"), "len")


_CLAIMS = """CL AS (SELECT e.a AS zero, e.b AS anchor, e.len, e.len/q.perimeter AS ratio FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e JOIN P q ON q.clean_fid = e.b
  JOIN CNT ca ON ca.clean_fid = e.a JOIN CNT cb ON cb.clean_fid = e.b WHERE ca.n = 0 AND cb.n > 0 AND e.len >= 0.5)"""
_OWN = "OWN AS (SELECT zero, anchor, len, ratio FROM (SELECT *, row_number() OVER (PARTITION BY zero ORDER BY ratio DESC, len DESC, anchor) AS rn FROM CL) WHERE rn = 1)"


def _claims(spark, d):
    c = _counted(spark, d).select("clean_fid", "n", "perimeter")
    zero = c.where("n = 0").select(F.col("clean_fid").alias("a"))
    anchor = c.where("n > 0").select(F.col("clean_fid").alias("b"), "perimeter")
    e = _both_ways(_short(_edges(spark, d))).where("len >= 0.5").join(zero, "a").join(anchor, "b")
    return e.select(F.col("a").alias("zero"), F.col("b").alias("anchor"), "len", exprs.ratio_or_zero(F.col("len"), F.col("perimeter")).alias("ratio"))


@query(sql(P, U, CNT, E, _CLAIMS, _OWN, body="SELECT zero, anchor, len, round(ratio, 6) AS ratio FROM OWN"))
def k0_direct_owner(spark, d):
    return joins.direct_owners(_claims(spark, d)).withColumn("ratio", F.round("ratio", 6))


@query(sql(P, U, CNT, E, _CLAIMS, _OWN, body="""SELECT zero, anchor, round(share, 6) AS share FROM (SELECT c.zero, c.anchor, c.ratio/o.ratio AS share,
  row_number() OVER (PARTITION BY c.zero ORDER BY c.ratio/o.ratio DESC, c.ratio DESC, c.len DESC, c.anchor) AS rn FROM CL c JOIN OWN o ON o.zero = c.zero
  WHERE c.anchor % 2 = 0 AND o.anchor % 2 <> 0 AND c.anchor <> o.anchor AND c.ratio/o.ratio >= 0.4 AND c.ratio >= 0.05) WHERE rn = 1"""))
def k0_secondary_claims(spark, d):
    claims = _claims(spark, d)
    allowed = fx.parcels(spark, d).where("clean_fid % 2 = 0").select(F.col("clean_fid").alias("anchor"))
    return joins.secondary_owners(claims, joins.direct_owners(claims), allowed, 0.4, 0.05).select("zero", "anchor", F.round("share", 6).alias("share"))


@query(sql(P, U, CNT, E, _CLAIMS, _OWN, body="""SELECT zero, owner, via, len FROM (SELECT e.b AS zero, o.anchor AS owner, o.zero AS via, e.len,
  row_number() OVER (PARTITION BY e.b ORDER BY e.len/p.perimeter DESC, e.len DESC, o.ratio DESC, o.anchor, o.zero) AS rn
  FROM OWN o JOIN (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) e ON e.a = o.zero JOIN CNT c ON c.clean_fid = e.b JOIN P p ON p.clean_fid = o.anchor
  WHERE e.len >= 0.5 AND c.n = 0 AND e.b NOT IN (SELECT zero FROM OWN)) WHERE rn = 1"""))
def k1_indirect_owner(spark, d):
    own = joins.direct_owners(_claims(spark, d))
    c = _counted(spark, d)
    free = c.where("n = 0").select(F.col("clean_fid").alias("b")).join(own.select(F.col("zero").alias("b")), "b", "left_anti")
    e = _both_ways(_short(_edges(spark, d))).where("len >= 0.5").join(free, "b")
    via = own.select(F.col("zero").alias("a"), F.col("anchor").alias("owner"), F.col("ratio").alias("parent"))
    hop = e.join(via, "a").join(c.select(F.col("clean_fid").alias("owner"), "perimeter"), "owner").withColumn("ratio", exprs.ratio_or_zero(F.col("len"), F.col("perimeter")))
    best = joins.first_by(hop, ["b"], [F.desc("ratio"), F.desc("len"), F.desc("parent"), F.asc("owner"), F.asc("a")])
    return best.select(F.col("b").alias("zero"), "owner", F.col("a").alias("via"), "len")


@query(sql(P, U, CNT, L, body="""SELECT council_fid, min(clean_fid) AS anchor FROM (SELECT l.council_fid, p.clean_fid FROM P p JOIN CNT c ON c.clean_fid = p.clean_fid JOIN L l ON p.xmin < l.xmax AND l.xmin < p.xmax AND p.ymin < l.ymax AND l.ymin < p.ymax
  AND (least(p.xmax,l.xmax)-greatest(p.xmin,l.xmin))*(least(p.ymax,l.ymax)-greatest(p.ymin,l.ymin)) >= 90 WHERE c.n > 0) GROUP BY 1 HAVING count(*) = 1"""))
def exactly_one_anchor_all(spark, d):
    """Council parcels with exactly one anchor of any number of points."""
    return joins.exactly_one(anchors_in(_counted(spark, d).where("n > 0"), fx.plots(spark, d)), "council_fid", "anchor")


def anchors_in(held: DataFrame, councils: DataFrame) -> DataFrame:
    """(council_fid, anchor): anchors of which at least 90 m2 lie in a council parcel."""
    pairs = joins.box_pairs(held, councils).where(joins.overlap_x() * joins.overlap_y() >= 90)
    return pairs.select(F.col("b_council_fid").alias("council_fid"), F.col("a_clean_fid").alias("anchor"))


@query(sql(P, E, body="SELECT a, b, len, overlap FROM E WHERE len >= 0.5 AND overlap <= 4"))
def shared_edge_graph(spark, d):
    return _edges(spark, d).where("len >= 0.5 and overlap <= 4").select(F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), "len", "overlap")


@query(sql(P, E, body="""SELECT a, b, len, CAST(rn AS INTEGER) AS rn FROM (SELECT a, b, len, row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn
  FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) WHERE len > 0) WHERE rn <= 3"""))
def shared_edge_topn(spark, d):
    w = Window.partitionBy("a").orderBy(F.desc("len"), F.asc("b"))
    return _both_ways(_short(_edges(spark, d))).withColumn("rn", F.row_number().over(w)).where("rn <= 3")


@query(sql(P, E, body="""SELECT a, count(*) AS degree, sum(len) AS total, string_agg(CAST(b AS VARCHAR), '|' ORDER BY b) AS neighbours FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) WHERE len > 0 GROUP BY a"""))
def adjacency_arrays(spark, d):
    g = _both_ways(_short(_edges(spark, d))).groupBy("a").agg(F.count("*").alias("degree"), F.sum("len").alias("total"), F.array_sort(F.collect_list("b")).alias("n"))
    return g.select("a", "degree", "total", F.array_join("n", "|").alias("neighbours"))


@query(sql(P, body="""SELECT p.clean_fid, count(*) AS n, sum(q.area) AS area, min(q.area) AS least, max(q.area) AS most FROM P p JOIN P q ON p.clean_fid <> q.clean_fid
  AND q.xmax >= p.xmin - 12 AND q.xmin <= p.xmax + 12 AND q.ymax >= p.ymin - 12 AND q.ymin <= p.ymax + 12 WHERE p.theme = 'Water' GROUP BY 1"""))
def local_context_radius(spark, d):
    p = fx.parcels(spark, d)
    pairs = joins.box_pairs(p.where("theme = 'Water'"), p, reach=12.0).where("a_clean_fid <> b_clean_fid")
    return pairs.groupBy(F.col("a_clean_fid").alias("clean_fid")).agg(F.count("*").alias("n"), F.sum("b_area").alias("area"), F.min("b_area").alias("least"), F.max("b_area").alias("most"))


@query(sql(P, E, body="""SELECT a, b, len, p.area + q.area AS pair_area, round(len/least(p.perimeter, q.perimeter), 6) AS share_min, round(len/greatest(p.perimeter, q.perimeter), 6) AS share_max,
  least(p.theme, q.theme) || '>' || greatest(p.theme, q.theme) AS role_pair, round(ln(1+len), 6) AS log_len, CAST(p.source_fid = q.source_fid AS INTEGER) AS same_source,
  round(least(p.area,q.area)/greatest(p.area,q.area), 6) AS area_ratio FROM E JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE len > 0"""))
def pair_features(spark, d):
    e = _edges(spark, d).where("len > 0")
    c = F.col
    return e.select(
        c("a_clean_fid").alias("a"), c("b_clean_fid").alias("b"), "len", (c("a_area") + c("b_area")).alias("pair_area"),
        F.round(exprs.safe_ratio(c("len"), F.least("a_perimeter", "b_perimeter")), 6).alias("share_min"), F.round(exprs.safe_ratio(c("len"), F.greatest("a_perimeter", "b_perimeter")), 6).alias("share_max"),
        F.concat_ws(">", F.least("a_theme", "b_theme"), F.greatest("a_theme", "b_theme")).alias("role_pair"), F.round(F.log1p("len"), 6).alias("log_len"),
        (c("a_source_fid") == c("b_source_fid")).cast("int").alias("same_source"), F.round(exprs.safe_ratio(F.least("a_area", "b_area"), F.greatest("a_area", "b_area")), 6).alias("area_ratio"),
    )


@query(sql(P, R, U, CNT, body="""SELECT u.uprn, CASE WHEN r.council_fid IS NOT NULL THEN 'council' WHEN f.clean_fid IS NOT NULL THEN 'fallback' WHEN w.clean_fid IS NOT NULL THEN 'raw' ELSE 'none' END AS origin
  FROM U u LEFT JOIN (SELECT * FROM R WHERE council_fid % 3 = 0) r ON u.x >= r.xmin AND u.x < r.xmax AND u.y >= r.ymin AND u.y < r.ymax
  LEFT JOIN (SELECT uprn, min(clean_fid) AS clean_fid FROM U JOIN P ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax WHERE theme = 'Building' GROUP BY 1) f ON f.uprn = u.uprn
  LEFT JOIN (SELECT uprn, min(clean_fid) AS clean_fid FROM U JOIN P ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax GROUP BY 1) w ON w.uprn = u.uprn"""))
def fallback_chain(spark, d):
    u, p = fx.uprns(spark, d), fx.parcels(spark, d)
    half_open = (F.col("x") < F.col("b_xmax")) & (F.col("y") < F.col("b_ymax"))
    council = joins.points_in_boxes(u, fx.councils(spark, d).where("council_fid % 3 = 0")).where(half_open).select("uprn", F.lit(1).alias("c")).distinct()
    hits = joins.points_in_boxes(u, p)
    seen = hits.groupBy("uprn").agg(F.max((F.col("b_theme") == "Building").cast("int")).alias("f"), F.lit(1).alias("w"))
    origin = F.when(F.col("c") == 1, "council").when(F.col("f") == 1, "fallback").when(F.col("w") == 1, "raw").otherwise("none")
    return u.select("uprn").join(council, "uprn", "left").join(seen, "uprn", "left").select("uprn", origin.alias("origin"))


@query(sql(P, R, body="SELECT p.clean_fid FROM P p WHERE EXISTS (SELECT 1 FROM R r WHERE r.council_fid % 4 = 1 AND p.xmin <= r.xmax AND r.xmin <= p.xmax AND p.ymin <= r.ymax AND r.ymin <= p.ymax)"))
def subset_by_target_mask(spark, d):
    p = fx.parcels(spark, d)
    hit = joins.box_pairs(p, fx.councils(spark, d).where("council_fid % 4 = 1")).select(F.col("a_clean_fid").alias("clean_fid"))
    return p.select("clean_fid").join(hit, "clean_fid", "left_semi")


@query(sql(P, body="SELECT clean_fid, area, perimeter, 1.0 AS mrr_ratio, 0.0 AS hull_gap, round(12.566370614359172*area/(perimeter*perimeter), 6) AS compactness, 1.0 AS regularity, greatest(xmax-xmin, ymax-ymin) AS mrr_long, least(xmax-xmin, ymax-ymin) AS mrr_short FROM P"))
def shape_metrics(spark, d):
    m = fx.with_geometry(fx.parcels(spark, d)).select("clean_fid", geo.st_shape(F.col("geom")).alias("m"))
    r = lambda n: F.round(f"m.{n}", 6) + 0.0
    return m.select("clean_fid", *[r(n).alias(n) for n in ("area", "perimeter", "mrr_ratio", "compactness", "regularity", "mrr_long", "mrr_short")], F.abs(r("hull_gap")).alias("hull_gap"))


def _pair_measures(pairs: DataFrame) -> DataFrame:
    g, h = F.col("a_geom"), F.col("b_geom")
    return pairs.select(
        F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), F.round(geo.st_shared_length(g, h), 6).alias("len"),
        F.round(geo.st_shared_area(g, h), 6).alias("overlap"), F.round(geo.st_iou(g, h, F.col("a_area"), F.col("b_area")), 6).alias("iou"),
    )


@query(sql(P, E, body="SELECT a, b, round(len, 6) AS len, round(overlap, 6) AS overlap, round(overlap/(p.area+q.area-overlap), 6) AS iou FROM E JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b"))
def geometry_pair_measures_all(spark, d):
    """Every pair of neighbours, measured on the geometry."""
    p = fx.with_geometry(fx.parcels(spark, d))
    return _pair_measures(joins.box_pairs(p, p, same=True))


@query(sql(P, body="SELECT clean_fid, area + 2*perimeter + 16 AS grown, round(area, 6) AS opened, round(area, 6) AS closed, CAST((xmin+xmax)/2 AS DOUBLE) AS cx FROM P"))
def buffers_and_openings(spark, d):
    p = fx.with_geometry(fx.parcels(spark, d))
    g = F.col("geom")
    area = lambda c: F.round(geo.st_shape(c)["area"], 6)
    return p.select(
        "clean_fid", area(geo.st_buffer(g, 2.0, mitre=True)).alias("grown"), area(geo.st_opening(g, 1.0)).alias("opened"), area(geo.st_closing(g, 1.0)).alias("closed"),
        F.regexp_extract(geo.st_to_text(geo.st_centroid(g)), r"\(([0-9.]+) ", 1).cast("double").alias("cx"),
    )


@query(sql(P, R, _OVER, body="SELECT council_fid, sum(area - overlap) AS left_over, count(*) AS n FROM O WHERE overlap > 0 GROUP BY 1"))
def difference_areas(spark, d):
    p, r = fx.with_geometry(fx.parcels(spark, d)), fx.with_geometry(fx.councils(spark, d))
    pairs = joins.box_pairs(p, r).where(joins.overlap_x() * joins.overlap_y() > 0)
    area = F.coalesce(geo.st_shape(geo.st_difference(F.col("a_geom"), F.col("b_geom")))["area"], F.lit(0.0))
    return pairs.groupBy(F.col("b_council_fid").alias("council_fid")).agg(F.sum(area).alias("left_over"), F.count("*").alias("n"))
