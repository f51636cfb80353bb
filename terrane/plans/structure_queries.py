"""Queries of overlay, graph, enumeration and feature operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import exprs, geo
from terrane.operators import features, graph, joins, overlay
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import CNT, E, P, R, U, sql
from terrane.plans.spatial_queries import _counted, _edges, _short
from terrane.session import Scratch

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its function name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


#: Edges between neighbours of one column of the grid with a long border: many small components.
_STRONG = "S AS (SELECT a, b, len FROM E WHERE len >= 8)"
_BOTH = "W AS (SELECT a, b, len FROM S UNION ALL SELECT b, a, len FROM S)"


def _components(ways: str) -> str:
    """SQL of (v, component) over edges both ways."""
    return f"(WITH RECURSIVE reach AS (SELECT a AS v, a AS low FROM {ways} UNION SELECT w.b, r.low FROM reach r JOIN {ways} w ON w.a = r.v WHERE r.low < w.b) SELECT v, min(low) AS component FROM reach GROUP BY v)"


def _strong(spark: SparkSession, d: str) -> DataFrame:
    return _short(_edges(spark, d)).where("len >= 8")


@query(sql(P, E, _STRONG, _BOTH, body="SELECT v, component FROM (WITH RECURSIVE reach AS (SELECT a AS v, a AS low FROM W UNION SELECT w.b, r.low FROM reach r JOIN W w ON w.a = r.v WHERE r.low < w.b) SELECT v, min(low) AS component FROM reach GROUP BY v)"))
def connected_components(spark, d):
    e = Scratch(spark, "components-edges").put(_strong(spark, d), "e")
    return graph.component_labels(e, graph.both_ways(e).select(F.col("a").alias("v")), Scratch(spark, "labels"))


@query(sql(P, E, _STRONG, _BOTH, body="SELECT v, dense_rank() OVER (ORDER BY component) - 1 AS component_id FROM (WITH RECURSIVE reach AS (SELECT a AS v, a AS low FROM W UNION SELECT w.b, r.low FROM reach r JOIN W w ON w.a = r.v WHERE r.low < w.b) SELECT v, min(low) AS component FROM reach GROUP BY v)"))
def dense_component_ids(spark, d):
    return graph.dense_ids(connected_components(spark, d))


@query(sql(P, E, _STRONG, _BOTH, body="SELECT v, min(depth) AS depth FROM (WITH RECURSIVE h AS (SELECT clean_fid AS v, 0 AS depth FROM P WHERE theme = 'Water' UNION SELECT w.b, h.depth + 1 FROM h JOIN W w ON w.a = h.v WHERE h.depth < 3) SELECT * FROM h) GROUP BY v"))
def bfs_depth(spark, d):
    return graph.hops(_strong(spark, d), fx.parcels(spark, d).where("theme = 'Water'").select(F.col("clean_fid").alias("v")), 3)


@query(sql(P, E, body="""SELECT anchor, v, CAST(depth AS INTEGER) AS depth, len FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY len DESC, v) AS rn FROM (SELECT a AS anchor, b AS v, 1 AS depth, len FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) JOIN P p ON p.clean_fid = a WHERE p.theme = 'Building' AND len > 0)) WHERE rn <= 2
  UNION ALL SELECT clean_fid, clean_fid, 0, 0.0 FROM P WHERE theme = 'Building'"""))
def neighbourhood_pool(spark, d):
    anchors = fx.parcels(spark, d).where("theme = 'Building'").select(F.col("clean_fid").alias("v"))
    return graph.bounded_pool(_short(_edges(spark, d)), anchors, 1, 2)


@query(sql(P, E, body="""SELECT anchor, least(anchor, v) || '|' || greatest(anchor, v) AS ids, len AS shared FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY len DESC, least(anchor, v), greatest(anchor, v)) AS rn FROM (SELECT a AS anchor, b AS v, len FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) JOIN P p ON p.clean_fid = a WHERE p.theme = 'Building' AND len > 0)) WHERE rn <= 4
  UNION ALL SELECT clean_fid, CAST(clean_fid AS VARCHAR), 0.0 FROM P WHERE theme = 'Building'"""))
def groups_of_two(spark, d):
    anchors = fx.parcels(spark, d).where("theme = 'Building'").select(F.col("clean_fid").alias("v"))
    return graph.connected_groups(_short(_edges(spark, d)), anchors, 2, 4).select("anchor", F.array_join("ids", "|").alias("ids"), "shared")


def _level(k: int) -> str:
    """SQL of the groups of k pieces from those of k - 1, sixteen per anchor."""
    return f"""G{k} AS (SELECT anchor, ids, shared FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY shared DESC, ids) AS rn FROM (SELECT DISTINCT anchor, list_sort(list_append(ids, b)) AS ids, shared + more AS shared FROM (
  SELECT g.anchor, g.ids, g.shared, w.b, sum(w.len) AS more FROM (SELECT anchor, ids, shared, unnest(ids) AS v FROM G{k - 1}) g JOIN (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) w ON w.a = g.v AND w.len > 0 WHERE NOT list_contains(g.ids, w.b) GROUP BY 1, 2, 3, 4))) WHERE rn <= 16)"""


@query(sql(P, E, "G1 AS (SELECT clean_fid AS anchor, [clean_fid] AS ids, 0.0::DOUBLE AS shared FROM P WHERE theme = 'Building')", _level(2), _level(3), _level(4),
           body="SELECT anchor, array_to_string(ids, '|') AS ids, shared FROM (SELECT * FROM G1 UNION ALL SELECT * FROM G2 UNION ALL SELECT * FROM G3 UNION ALL SELECT * FROM G4)"))
def groups_enumerated(spark, d):
    """Connected groups of up to four pieces round each anchor, with a beam of 16 per size."""
    anchors = fx.parcels(spark, d).where("theme = 'Building'").select(F.col("clean_fid").alias("v"))
    e = Scratch(spark, "groups-edges").put(_short(_edges(spark, d)), "e")
    return graph.connected_groups(e, anchors, 4, 16).select("anchor", exprs.ids_to_text(F.col("ids")).alias("ids"), "shared")


def _pool(spark, d):
    p = fx.parcels(spark, d).select("clean_fid", "theme", "area")
    e = graph.both_ways(_short(_edges(spark, d)))
    return e.join(p.where("theme = 'Building'").select(F.col("clean_fid").alias("a")), "a").join(p.select(F.col("clean_fid").alias("b"), "area"), "b").select(F.col("a").alias("anchor"), F.col("b").alias("v"), (F.col("area") - F.col("len")).alias("cost"))


_POOL = "POOL AS (SELECT w.a AS anchor, w.b AS v, q.area - w.len AS cost FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) w JOIN P p ON p.clean_fid = w.a JOIN P q ON q.clean_fid = w.b WHERE p.theme = 'Building' AND w.len > 0)"


@query(sql(P, E, _POOL, body="""SELECT anchor, ids, cost FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY cost, i, j) AS rn FROM (SELECT anchor, CAST(v AS VARCHAR) AS ids, cost, v AS i, 0 AS j FROM POOL)) WHERE rn <= 5
  UNION ALL SELECT anchor, ids, cost FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY cost, i, j) AS rn FROM (SELECT x.anchor, x.v || '|' || y.v AS ids, x.cost + y.cost AS cost, x.v AS i, y.v AS j FROM POOL x JOIN POOL y ON x.anchor = y.anchor AND x.v < y.v)) WHERE rn <= 5"""))
def combo_quota(spark, d):
    return graph.combinations(_pool(spark, d), 2, 5).select("anchor", F.array_join("ids", "|").alias("ids"), "cost")


@query(sql(P, E, _POOL, body="""SELECT anchor, array_to_string(ids, '|') AS ids FROM (
  WITH RECURSIVE sub AS (SELECT anchor, [v] AS ids, v AS top FROM POOL UNION ALL SELECT s.anchor, list_append(s.ids, p.v), p.v FROM sub s JOIN POOL p ON p.anchor = s.anchor AND p.v > s.top) SELECT * FROM sub)
  WHERE len(list_filter(ids, lambda v: v % 3 = 1 AND NOT list_contains(ids, v - 1))) = 0"""))
def powerset_with_parents(spark, d):
    pool = _pool(spark, d).select("anchor", "v", F.when(F.col("v") % 3 == 1, F.col("v") - 1).alias("parent"))
    return graph.subsets(pool, 6).select("anchor", exprs.ids_to_text(F.col("ids")).alias("ids"))


@query(sql(P, E, body="SELECT clean_fid, true AS connected FROM P WHERE clean_fid IN (SELECT a FROM E WHERE len > 0 UNION SELECT b FROM E WHERE len > 0)"))
def group_connectivity(spark, d):
    e = Scratch(spark, "connect-edges").put(_short(_edges(spark, d)), "e")
    star = graph.both_ways(e).groupBy("a").agg(F.collect_set("b").alias("n")).select(F.col("a").alias("clean_fid"), F.array_sort(F.concat("n", F.array("a"))).alias("ids"))
    return graph.group_connected(star, e, ["clean_fid"], "ids")


@query(sql(P, E, _STRONG, _BOTH, body="""SELECT a, b FROM S WHERE (a, b, b) NOT IN (SELECT (ea, eb, v) FROM (
  WITH RECURSIVE r AS (SELECT a AS ea, b AS eb, a AS v FROM S UNION SELECT r.ea, r.eb, w.b FROM r JOIN W w ON w.a = r.v WHERE NOT (least(w.a, w.b) = r.ea AND greatest(w.a, w.b) = r.eb)) SELECT * FROM r))"""))
def bridge_edges(spark, d):
    return graph.bridges(_strong(spark, d), Scratch(spark, "bridges"))


@query(sql(P, R, E, _STRONG, _BOTH, "REF AS (SELECT p.clean_fid AS v, min(r.council_fid) AS ref FROM P p JOIN R r ON p.xmin BETWEEN r.xmin AND r.xmax AND p.ymin BETWEEN r.ymin AND r.ymax GROUP BY 1)",
           "K AS (SELECT w.a, w.b FROM W w LEFT JOIN REF x ON x.v = w.a LEFT JOIN REF y ON y.v = w.b WHERE x.ref IS NULL OR y.ref IS NULL OR x.ref = y.ref UNION SELECT a, a FROM W)", body="SELECT v, component FROM " + _components("K")))
def split_by_reference(spark, d):
    """Components after edges between parcels of different councils are dropped."""
    p = fx.parcels(spark, d).select("clean_fid", F.col("xmin").alias("x"), F.col("ymin").alias("y"))
    own = joins.points_in_boxes(p, fx.councils(spark, d)).groupBy(F.col("clean_fid").alias("v")).agg(F.min("b_council_fid").alias("ref"))
    e = Scratch(spark, "split-edges").put(_strong(spark, d), "e")
    return graph.split_by_reference(e, own, Scratch(spark, "split"))


@query(sql(P, E, _STRONG, _BOTH, f"C AS (SELECT v, component FROM {_components('W')})",
           "BAD AS (SELECT component FROM C JOIN P p ON p.clean_fid = C.v GROUP BY 1 HAVING sum(area) / ((max(xmax) - min(xmin)) * (max(ymax) - min(ymin))) < 0.7)",
           body="SELECT S.a, S.b, S.len FROM S JOIN C ON C.v = S.a WHERE C.component NOT IN (SELECT component FROM BAD) OR S.len >= 9"))
def shape_guarded_edges(spark, d):
    """Weak edges are dropped inside components whose parcels fill little of their common box."""
    e = Scratch(spark, "guard-edges").put(_strong(spark, d), "e")
    labels = graph.component_labels(e, graph.both_ways(e).select(F.col("a").alias("v")), Scratch(spark, "guard"))
    boxes = labels.join(fx.parcels(spark, d).withColumnRenamed("clean_fid", "v"), "v").groupBy("component").agg(
        F.sum("area").alias("area"), ((F.max("xmax") - F.min("xmin")) * (F.max("ymax") - F.min("ymin"))).alias("box")
    )
    return graph.shape_guard(e, labels, boxes.where("area / box < 0.7").select("component"), F.col("len") >= 9)


def _pass(k: int) -> str:
    """SQL of the polygons held after pass k."""
    return f"""H{k} AS (SELECT v, owner, pass FROM H{k - 1} UNION ALL SELECT v, owner, {k} FROM (SELECT v, owner, row_number() OVER (PARTITION BY v ORDER BY len DESC, owner) AS rn FROM (
  SELECT w.a AS v, h.owner, sum(w.len) AS len FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) w JOIN H{k - 1} h ON h.v = w.b JOIN CNT c ON c.clean_fid = w.a
  WHERE w.len > 0 AND c.n = 0 AND w.a NOT IN (SELECT v FROM H{k - 1}) GROUP BY 1, 2 HAVING sum(w.len) >= 0.5)) WHERE rn = 1)"""


@query(sql(P, U, CNT, E, "H0 AS (SELECT clean_fid AS v, clean_fid AS owner, 0 AS pass FROM CNT WHERE n > 0)", _pass(1), _pass(2), _pass(3), _pass(4), body="SELECT v, owner, CAST(pass AS INTEGER) AS pass FROM H4"))
def attachment_passes(spark, d):
    """Parcels without points join the owner they share most border with, pass by pass."""
    c = _counted(spark, d)
    return graph.attach_passes(
        c.where("n = 0").select(F.col("clean_fid").alias("v")), _short(_edges(spark, d)), c.where("n > 0").select(F.col("clean_fid").alias("v"), F.col("clean_fid").alias("owner")), 4, 0.5, Scratch(spark, "attach")
    )


_ROLE = "CASE WHEN theme LIKE '%Building%' THEN 'building' WHEN theme LIKE '%Land%' THEN 'land' WHEN theme LIKE 'Roads%' THEN 'road' ELSE 'other' END"


@query(sql(P, U, CNT, E, """G AS (SELECT p.clean_fid AS anchor, p.clean_fid AS v FROM P p WHERE theme = 'Building' UNION SELECT w.a, w.b FROM (SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E) w JOIN P p ON p.clean_fid = w.a WHERE p.theme = 'Building' AND w.len > 0)""", body=f"""
SELECT g.anchor AS gid, count(*) AS n, sum(p.area) AS area, sum(c.n) AS uprns, sum(CAST(g.v <> g.anchor AND c.n > 0 AS BIGINT)) AS other_anchors, sum(CAST({_ROLE} = 'land' AS BIGINT)) AS n_land, sum(CASE WHEN {_ROLE} = 'building' AND g.v <> g.anchor THEN p.area ELSE 0 END) AS added_area_building,
  coalesce(max(t.si), 0) AS shared_inside, coalesce(max(t.so), 0) AS shared_outside, coalesce(max(t.nb), 0) AS neighbours, round(coalesce(max(t.si), 0)/sum(p.perimeter), 6) AS share_inside
FROM G g JOIN P p ON p.clean_fid = g.v JOIN CNT c ON c.clean_fid = g.v LEFT JOIN (SELECT x.anchor, sum(CASE WHEN y.v IS NOT NULL THEN w.len ELSE 0 END)/2 AS si, sum(CASE WHEN y.v IS NULL THEN w.len ELSE 0 END) AS so, count(DISTINCT CASE WHEN y.v IS NULL THEN w.b END) AS nb
  FROM G x JOIN (SELECT a, b, len FROM E WHERE len > 0 UNION ALL SELECT b, a, len FROM E WHERE len > 0) w ON w.a = x.v LEFT JOIN G y ON y.anchor = x.anchor AND y.v = w.b GROUP BY 1) t ON t.anchor = g.anchor GROUP BY 1"""))
def anchor_group_features(spark, d):
    p = _counted(spark, d)
    nodes = p.select(F.col("clean_fid").alias("v"), "area", "perimeter", exprs.role(F.col("theme"), "anchor").alias("role"), F.col("n").alias("uprns"))
    e = Scratch(spark, "feature-edges").put(_short(_edges(spark, d)), "e")
    star = graph.both_ways(e).groupBy("a").agg(F.collect_set("b").alias("s")).withColumnRenamed("a", "clean_fid")
    groups = p.where("theme = 'Building'").select("clean_fid").join(star, "clean_fid", "left").select(F.col("clean_fid").alias("gid"), F.col("clean_fid").alias("anchor"), F.array_distinct(F.concat(F.array("clean_fid"), F.coalesce("s", F.array().cast("array<bigint>")))).alias("ids"))
    f = features.group_features(groups, nodes, e)
    return f.select("gid", "n", "area", "uprns", "other_anchors", "n_land", "added_area_building", "shared_inside", "shared_outside", "neighbours", F.round("share_inside", 6).alias("share_inside"))


@query(sql(P, body="SELECT clean_fid, CASE WHEN clean_fid % 5 = 0 THEN 1 WHEN clean_fid % 3 = 0 THEN 0 WHEN clean_fid % 2 = 0 THEN 1 END AS label, CASE WHEN clean_fid % 5 = 0 THEN 'manual' WHEN clean_fid % 3 = 0 THEN 'reference' WHEN clean_fid % 2 = 0 THEN 'weak' END AS label_source, CAST(CASE WHEN clean_fid % 5 = 0 THEN 3 WHEN clean_fid % 3 = 0 THEN 1 WHEN clean_fid % 2 = 0 THEN 0.3 ELSE 0 END AS DOUBLE) AS sample_weight FROM P"))
def label_assignment(spark, d):
    k = F.col("clean_fid")
    p = fx.parcels(spark, d).select(k, F.when(k % 5 == 0, 1).alias("m"), F.when(k % 3 == 0, 0).alias("r"), F.when(k % 2 == 0, 1).alias("w"))
    return features.label_candidates(p, "m", "r", "w").select("clean_fid", "label", "label_source", "sample_weight")


@query(sql(P, E, "W AS (SELECT a, b FROM E WHERE len > 0 UNION ALL SELECT b, a FROM E WHERE len > 0)",
           "T AS (SELECT CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR) AS target, [a, b] AS ids FROM E WHERE len > 0 UNION ALL SELECT 's' || CAST(source_fid AS VARCHAR), list_sort(list(clean_fid)) FROM P GROUP BY source_fid)",
           "X AS (SELECT target, ids, x.v, w.b FROM (SELECT target, ids, unnest(ids) AS v FROM T) x JOIN W w ON w.a = x.v WHERE NOT list_contains(ids, w.b))",
           body="""SELECT target, kind, array_to_string(ids, '|') AS ids FROM (
  SELECT target, 'omit' AS kind, list_filter(ids, lambda x: x <> v) AS ids FROM (SELECT target, ids, unnest(ids) AS v FROM T WHERE len(ids) > 1)
  UNION ALL SELECT DISTINCT target, 'overmerge', list_sort(list_append(ids, b)) FROM X
  UNION ALL SELECT DISTINCT target, 'replace', list_sort(list_append(list_filter(ids, lambda x: x <> v), b)) FROM X WHERE len(ids) > 1
  UNION ALL SELECT target, 'subset', list_filter(ids, lambda x, i: (mask >> (i - 1)::INTEGER) & 1 = 1) FROM (SELECT target, ids, unnest(generate_series(1, (2 ** len(ids))::INTEGER - 2))::INTEGER AS mask FROM T WHERE len(ids) > 2) WHERE bit_count(mask) <= len(ids) - 2)"""))
def hard_negatives_all(spark, d):
    """Every negative of every kind, row by row; the targets are all pairs with a common border and all source groups."""
    e = _short(_edges(spark, d))
    pairs = e.select(F.concat_ws("-", "a", "b").alias("target"), F.array("a", "b").alias("ids"))
    groups = fx.parcels(spark, d).groupBy("source_fid").agg(F.array_sort(F.collect_set("clean_fid")).alias("ids")).select(F.concat(F.lit("s"), "source_fid").alias("target"), "ids")
    return features.hard_negatives(pairs.unionByName(groups), e).select("target", "kind", exprs.ids_to_text(F.col("ids")).alias("ids"))


@query(sql(P, body="SELECT 'has_area' AS rule, CAST(0 AS BIGINT) AS rows UNION ALL SELECT 'narrow', sum(CAST(xmax - xmin > 11 AS BIGINT)) FROM P UNION ALL SELECT 'theme', sum(CAST(theme = 'Water' AS BIGINT)) FROM P"))
def dataset_invariants(spark, d):
    return features.invariant_violations(fx.parcels(spark, d), {"has_area": "area > 0", "narrow": "xmax - xmin <= 11", "theme": "theme <> 'Water'"})


@query(sql(P, """F AS (SELECT clean_fid, count(*) AS area FROM (SELECT clean_fid, row_number() OVER (PARTITION BY cx, cy ORDER BY CASE WHEN theme LIKE '%Building%' THEN 0 WHEN theme LIKE 'Roads%' THEN 1 ELSE 2 END, area, clean_fid) AS rn
  FROM P, LATERAL (SELECT unnest(generate_series(CAST(xmin AS BIGINT), CAST(xmax AS BIGINT) - 1)) AS cx), LATERAL (SELECT unnest(generate_series(CAST(ymin AS BIGINT), CAST(ymax AS BIGINT) - 1)) AS cy)) WHERE rn = 1 GROUP BY 1)""",
           body="SELECT p.clean_fid, CAST(coalesce(F.area, 0) AS DOUBLE) AS area, p.area - coalesce(F.area, 0) AS removed FROM P p LEFT JOIN F ON F.clean_fid = p.clean_fid"))
def deoverlap_area(spark, d):
    """Parcels cut by those before them in order of role and area; no two overlap afterwards."""
    p = fx.with_geometry(fx.parcels(spark, d)).withColumn("role_rank", F.when(F.col("theme").contains("Building"), 0).when(F.col("theme").startswith("Roads"), 1).otherwise(2))
    return overlay.deoverlap(p, ["role_rank", "area"], 0.25).select("clean_fid", F.round("area", 6).alias("area"), F.round("removed", 6).alias("removed"))


@query(sql(P, E, body="SELECT count(*) AS pairs, sum(overlap) AS total, true AS validated FROM E WHERE overlap > 1"))
def overlap_validation(spark, d):
    return overlay.overlap_total(fx.parcels(spark, d), 1.0)


@query(sql(P, "V AS (SELECT min(xmin) AS x0, min(ymin) AS y0, max(xmax) AS x1, max(ymax) AS y1 FROM P)", body="""
SELECT CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy, x0 + ix*80 AS xmin, y0 + iy*80 AS ymin, least(x0 + ix*80 + 100, x1) AS xmax, least(y0 + iy*80 + 100, y1) AS ymax
FROM (SELECT V.*, unnest(generate_series(0, CAST(ceil((x1-x0)/80) AS BIGINT) - 1)) AS ix FROM V) JOIN (SELECT unnest(generate_series(0, CAST(ceil((y1-y0)/80) AS BIGINT) - 1)) AS iy FROM V) ON TRUE"""))
def spatial_window_grid(spark, d):
    b = fx.parcels(spark, d).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    return overlay.window_grid(b, 100.0, 20.0)


def _ringed(spark, d):
    """Each council area as a polygon with one square hole, from its own numbers."""
    r = fx.councils(spark, d)
    ring = lambda x0, y0, x1, y1: F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]), F.lit(")"))
    c, side = F.col, 10 + F.col("council_fid") % 7
    wkt = F.concat(F.lit("POLYGON ("), ring(c("xmin"), c("ymin"), c("xmax"), c("ymax")), F.lit(", "), ring(c("xmin") + 20, c("ymin") + 20, c("xmin") + 20 + side, c("ymin") + 20 + side), F.lit(")"))
    geo.register(spark)
    return r.withColumn("geom", geo.st_from_text(wkt)).withColumnRenamed("council_fid", "clean_fid")


@query("SELECT -row_number() OVER (ORDER BY n_nationkey) AS clean_fid, CAST(n_nationkey AS BIGINT) AS parent, CAST((10 + n_nationkey % 7)*(10 + n_nationkey % 7) AS DOUBLE) AS area FROM nation WHERE 10 + n_nationkey % 7 BETWEEN 11 AND 15")
def polygon_holes(spark, d):
    return overlay.hole_rows(_ringed(spark, d), 121.0, 225.0, -1).select("clean_fid", "parent", "area")


@query("SELECT CAST(n_nationkey AS BIGINT) AS clean_fid, 8000.0 - (10 + n_nationkey % 7)*(10 + n_nationkey % 7) AS area, 8000.0 AS filled, CAST(1 AS INTEGER) AS holes FROM nation")
def hole_metrics_and_fill(spark, d):
    m = geo.st_shape(F.col("geom"))
    return _ringed(spark, d).select("clean_fid", m["area"].alias("area"), geo.st_shape(geo.st_fill_holes(F.col("geom")))["area"].alias("filled"), m["hole_count"].cast("int").alias("holes"))


@query("SELECT CAST(n_regionkey AS BIGINT) AS n_regionkey, CAST(count(*) AS BIGINT) AS gaps, CAST(sum((10 + n_nationkey % 7)*(10 + n_nationkey % 7)) AS DOUBLE) AS area FROM nation GROUP BY 1")
def enclosed_gaps(spark, d):
    r = _ringed(spark, d).join(spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias("clean_fid"), F.col("n_regionkey").cast("bigint").alias("n_regionkey")), "clean_fid")
    gaps = overlay.coverage_gaps(r, "n_regionkey", 1.0, 400.0)
    return gaps.groupBy("n_regionkey").agg(F.count("*").alias("gaps"), F.sum("area").alias("area"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS gap_id, CAST(n_nationkey AS BIGINT) AS clean_fid, CAST(4*(10 + n_nationkey % 7) AS DOUBLE) AS len FROM nation")
def gap_owner(spark, d):
    r = _ringed(spark, d)
    gaps = overlay.with_box(r.select(F.col("clean_fid").alias("gap_id"), F.explode(geo.st_holes(F.col("geom"))).alias("geom")))
    return overlay.gap_owner(gaps, r, 0.05, 1)


@query("SELECT CAST(n_nationkey AS BIGINT) AS clean_fid, CAST(n_nationkey AS BIGINT) AS host FROM nation")
def absorbed_fillers(spark, d):
    r = _ringed(spark, d)
    holes = overlay.with_box(r.select(F.col("clean_fid").alias("host"), F.explode(geo.st_holes(F.col("geom"))).alias("geom")))
    fill = overlay.with_box(holes.select(F.col("host").alias("clean_fid"), F.col("geom"))).withColumn("area", geo.st_shape(F.col("geom"))["area"])
    return overlay.absorb(fill, holes, 0.98)


@query(sql(P, body="SELECT clean_fid, area / 2 AS area FROM P"))
def half_clips(spark, d):
    p = overlay.half_clip(fx.with_geometry(fx.parcels(spark, d)), "clean_fid", 3)
    return p.select("clean_fid", geo.st_shape(F.col("geom"))["area"].alias("area"))


#: The parcels as unit cells: areas of unions are counts of distinct cells.
_CELLS = "Q AS (SELECT clean_fid, source_fid, cx, cy FROM P, LATERAL (SELECT unnest(generate_series(CAST(xmin AS BIGINT), CAST(xmax AS BIGINT) - 1)) AS cx), LATERAL (SELECT unnest(generate_series(CAST(ymin AS BIGINT), CAST(ymax AS BIGINT) - 1)) AS cy))"


@query(sql(P, R, _CELLS, body="""SELECT council_fid, CAST(count(cx) AS DOUBLE) AS covered, round(count(cx)/8000.0::DOUBLE, 6) AS ratio, 8000.0::DOUBLE - count(cx) AS missing
  FROM R LEFT JOIN (SELECT DISTINCT cx, cy FROM Q) ON cx >= xmin AND cx < xmax AND cy >= ymin AND cy < ymax GROUP BY 1"""))
def coverage_ratio_missing_all(spark, d):
    """Every council area by the union of all parcels, which overlap."""
    p = fx.with_geometry(fx.parcels(spark, d))
    r = fx.with_geometry(fx.councils(spark, d)).withColumn("area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    return overlay.coverage_of_boxes(r, p, "council_fid").select("council_fid", F.round("covered", 6).alias("covered"), F.round("ratio", 6).alias("ratio"), F.round("missing", 6).alias("missing"))


@query(sql(P, _CELLS, body="""SELECT source_fid AS target, CAST(area AS DOUBLE) AS area, members FROM (SELECT source_fid, count(*) AS area FROM (SELECT DISTINCT source_fid, cx, cy FROM Q) GROUP BY 1)
  JOIN (SELECT source_fid, string_agg(CAST(clean_fid AS VARCHAR), '|' ORDER BY clean_fid) AS members FROM P GROUP BY 1) USING (source_fid)"""))
def group_merge_all(spark, d):
    """All parcels of every source merged into one polygon; they may overlap."""
    p = fx.with_geometry(fx.parcels(spark, d))
    return overlay.merge_groups(p, p.select("clean_fid", F.col("source_fid").alias("target"))).select("target", F.round("area", 6).alias("area"), F.array_join("members", "|").alias("members"))


@query()
def neighbour_slivers_all(spark, d):
    """The area of every parcel with the sliver of each neighbour it has a border with, both ways (no oracle: corners are round)."""
    p = fx.with_geometry(fx.parcels(spark, d))
    pairs = joins.with_contact(joins.box_pairs(p, p)).where("len > 0 and a_clean_fid <> b_clean_fid")
    s = overlay.neighbour_sliver(pairs, 0.5).withColumn("area", geo.st_shape(F.col("geom"))["area"])
    return s.select(F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), F.round("area", 6).alias("area"))
