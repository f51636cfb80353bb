"""Queries of the spatial joins over polygons that are no boxes: L-shapes, holes and multipolygons, and the predicted parcels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.functions import exprs, geo
from terrane.operators import candidates, graph, joins, polygons
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import COUNCIL_SQL, SHAPE_SQL, B, P, R, U, edge_tables, pair_table, sql
from terrane.plans.spatial_queries import _CLAIMS, _OWN
from terrane.session import Scratch
from terrane.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


#: The parcels as polygons, under the names that the queries over boxes use: P, CNT and E.
_BOXES = P.replace("P AS (", "PB AS (", 1)
_G = f"G AS (SELECT clean_fid AS id, {SHAPE_SQL} AS wkt FROM PB)"
_SHAPES = (_BOXES, _G, *edge_tables("G"), "P AS (SELECT b.clean_fid, b.source_fid, b.theme, m.xmin, m.ymin, m.xmax, m.ymax, m.area, m.perimeter FROM PB b JOIN M m ON m.id = b.clean_fid)")
_TOUCH = ("PAIRS AS (SELECT p.clean_fid AS a, q.clean_fid AS b FROM P p JOIN P q ON p.clean_fid < q.clean_fid AND p.xmin <= q.xmax AND q.xmin <= p.xmax AND p.ymin <= q.ymax AND q.ymin <= p.ymax)", *pair_table("E", "", "", "PAIRS"))


def _hits(name: str, points: str, pid: str) -> str:
    """SQL table (pid, id, on_border) of points in or on the polygons of G."""
    return f"""{name} AS (SELECT {pid}, id, bool_or(on_it) AS on_border FROM (
  SELECT u.{pid}, s.id, s.pi, bool_or((s.ax = s.bx AND u.x = s.ax AND u.y BETWEEN least(s.ay, s.by_) AND greatest(s.ay, s.by_)) OR (s.ay = s.by_ AND u.y = s.ay AND u.x BETWEEN least(s.ax, s.bx) AND greatest(s.ax, s.bx))) AS on_it,
    sum(CASE WHEN s.ax = s.bx AND (s.ay > u.y) <> (s.by_ > u.y) AND u.x > s.ax THEN 1 ELSE 0 END) % 2 = 1 AS odd
  FROM {points} u JOIN M m ON u.x BETWEEN m.xmin AND m.xmax AND u.y BETWEEN m.ymin AND m.ymax JOIN S s ON s.id = m.id GROUP BY 1, 2, 3) WHERE on_it OR odd GROUP BY 1, 2)"""


_HIT = _hits("HIT", "U", "uprn")
_CNT = "CNT AS (SELECT p.clean_fid, count(h.uprn) AS n FROM P p LEFT JOIN HIT h ON h.id = p.clean_fid GROUP BY 1)"
_COUNTED = (*_SHAPES, U, _HIT, _CNT)


def _counted(spark: SparkSession, d: str) -> DataFrame:
    """The polygons with the number of points in each, written once a query."""
    s = fx.shapes(spark, d)
    return Scratch(spark, "counted").put(s.join(polygons.count_points(fx.uprns(spark, d), s, "uprn", "clean_fid"), "clean_fid"), "counted")


def _edges(shapes: DataFrame) -> DataFrame:
    """(a, b, len, overlap) of neighbours a < b, written once a query."""
    e = polygons.touching(shapes.select("clean_fid", "geom", "xmin", "ymin", "xmax", "ymax"), shapes.select("clean_fid", "geom", "xmin", "ymin", "xmax", "ymax"), "clean_fid")
    r = lambda c: F.round(c, 6).alias(c)
    return Scratch(shapes.sparkSession, "edges").put(e.select(F.col("a_clean_fid").alias("a"), F.col("b_clean_fid").alias("b"), r("len"), r("overlap")), "edges")


def _both(e: DataFrame) -> DataFrame:
    return e.select("a", "b", "len").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "len"))


_WAYS = "(SELECT a, b, len FROM E UNION ALL SELECT b, a, len FROM E)"


@query(sql(*_COUNTED, body="SELECT clean_fid, CAST(n AS BIGINT) AS n FROM CNT"))
def poly_point_count(spark, d):
    return polygons.count_points(fx.uprns(spark, d), fx.shapes(spark, d), "uprn", "clean_fid")


@query(sql(*_SHAPES, B, _hits("HIT", "B", "pid"), body="SELECT id AS clean_fid, count(*) AS n_intersects, count(*) FILTER (NOT on_border) AS n_within FROM HIT GROUP BY 1"))
def poly_point_within_vs_intersects(spark, d):
    s, b = fx.shapes(spark, d), fx.border_points(spark, d)
    n = polygons.count_points(b, s, "pid", "clean_fid").where("n > 0")
    w = polygons.count_points(b, s, "pid", "clean_fid", strict=True)
    return n.join(w.withColumnRenamed("n", "n_within"), "clean_fid").select("clean_fid", F.col("n").alias("n_intersects"), "n_within")


@query(sql(*_COUNTED, body="""SELECT uprn, clean_fid, CAST(matches AS BIGINT) AS matches FROM (
  SELECT u.uprn, h.id AS clean_fid, count(h.id) OVER (PARTITION BY u.uprn) AS matches,
    row_number() OVER (PARTITION BY u.uprn ORDER BY CAST(c.n = 1 AS INT) DESC NULLS LAST, CAST(c.n > 0 AS INT) DESC NULLS LAST, p.area NULLS LAST, h.id) AS rn
  FROM U u LEFT JOIN HIT h ON h.uprn = u.uprn LEFT JOIN P p ON p.clean_fid = h.id LEFT JOIN CNT c ON c.clean_fid = h.id) WHERE rn = 1"""))
def poly_point_best_left(spark, d):
    u, c = fx.uprns(spark, d), _counted(spark, d)
    hits = polygons.points_in(u, c, "uprn", "clean_fid").join(c.select("clean_fid", "n", "area"), "clean_fid")
    order = F.struct((F.col("n") != 1).cast("int"), (F.col("n") == 0).cast("int"), "area", "clean_fid")
    best = hits.groupBy("uprn").agg(F.min_by("clean_fid", order).alias("clean_fid"), F.count("*").alias("matches"))
    return u.select("uprn").join(best, "uprn", "left").select("uprn", "clean_fid", F.coalesce("matches", F.lit(0).cast("long")).alias("matches"))


@query(sql(*_COUNTED, body="SELECT uprn, min_by(id, (p.area, id)) AS clean_fid, count(*) AS hits FROM HIT JOIN P p ON p.clean_fid = id GROUP BY 1"))
def poly_point_smallest_container(spark, d):
    s = fx.shapes(spark, d)
    hits = polygons.points_in(fx.uprns(spark, d), s, "uprn", "clean_fid").join(s.select("clean_fid", "area"), "clean_fid")
    return hits.groupBy("uprn").agg(F.min_by("clean_fid", F.struct("area", "clean_fid")).alias("clean_fid"), F.count("*").alias("hits"))


@query(sql(*_COUNTED, body="""SELECT uprn, clean_fid, round(dist, 6) AS dist FROM (SELECT u.uprn, p.clean_fid, d.dist, row_number() OVER (PARTITION BY u.uprn ORDER BY round(d.dist, 9), p.area, p.clean_fid) AS rn
  FROM U u JOIN (SELECT u.uprn, s.id, min(CASE WHEN h.id IS NOT NULL THEN 0 ELSE sqrt(pow(greatest(0, least(s.ax,s.bx) - u.x, u.x - greatest(s.ax,s.bx)), 2) + pow(greatest(0, least(s.ay,s.by_) - u.y, u.y - greatest(s.ay,s.by_)), 2)) END) AS dist
    FROM U u JOIN CNT c ON c.n > 1 JOIN S s ON s.id = c.clean_fid LEFT JOIN HIT h ON h.uprn = u.uprn AND h.id = s.id GROUP BY 1, 2) d ON d.uprn = u.uprn JOIN P p ON p.clean_fid = d.id) WHERE rn = 1"""))
def poly_point_nearest_fallback(spark, d):
    """The nearest polygon with at least two points, however far it is."""
    held = _counted(spark, d).where("n > 1")
    return polygons.nearest(fx.uprns(spark, d), held, "uprn", "clean_fid", 8.0).withColumn("dist", F.round("dist", 6))


_COUNCIL = (R.replace("R AS (", "RB AS (", 1), f"GR AS (SELECT council_fid AS id, {COUNCIL_SQL} AS wkt FROM RB)", *edge_tables("GR", "R"),
            "OVERS AS (SELECT p.clean_fid AS a, r.id AS b FROM P p JOIN RM r ON p.xmin <= r.xmax AND r.xmin <= p.xmax AND p.ymin <= r.ymax AND r.ymin <= p.ymax)", *pair_table("O", "", "R", "OVERS"))


def _with_councils(spark, d, held=None):
    s = fx.shapes(spark, d) if held is None else held
    return polygons.touching(s, fx.council_shapes(spark, d)).withColumn("overlap", F.round("overlap", 6))


@query(sql(*_SHAPES, *_COUNCIL, body="""SELECT clean_fid, council_fid, round(coverage, 6) AS coverage FROM (SELECT O.a AS clean_fid, O.b AS council_fid, overlap/p.area AS coverage,
  row_number() OVER (PARTITION BY O.a ORDER BY overlap DESC, O.b) AS rn FROM O JOIN P p ON p.clean_fid = O.a WHERE overlap > 0) WHERE rn = 1"""))
def poly_max_overlap_reference(spark, d):
    best = _with_councils(spark, d).where("overlap > 0").groupBy("a_clean_fid").agg(F.max(F.struct("overlap", (-F.col("b_council_fid")).alias("m"), (F.col("overlap") / F.col("a_area")).alias("coverage"))).alias("m"))
    return best.select(F.col("a_clean_fid").alias("clean_fid"), (-F.col("m.m")).alias("council_fid"), F.round("m.coverage", 6).alias("coverage"))


@query(sql(*_COUNTED, *_COUNCIL, body="SELECT O.b AS council_fid, min(O.a) AS anchor FROM O JOIN CNT c ON c.clean_fid = O.a WHERE overlap >= 60 AND n > 1 GROUP BY 1 HAVING count(*) = 1"))
def poly_exactly_one_anchor(spark, d):
    """Council areas that hold exactly one polygon with several points."""
    pairs = _with_councils(spark, d, _counted(spark, d).where("n > 1")).where("overlap >= 60")
    return joins.exactly_one(pairs.select(F.col("b_council_fid").alias("council_fid"), F.col("a_clean_fid").alias("anchor")), "council_fid", "anchor")


@query(sql(*_SHAPES, *_COUNCIL, body="SELECT DISTINCT O.a AS clean_fid FROM O JOIN RM t ON t.id = O.b WHERE t.ymin >= 200"))
def poly_subset_by_target(spark, d):
    """Polygons that meet a target: the council areas in the north are the targets."""
    mask = fx.council_shapes(spark, d).where("ymin >= 200")
    return polygons.touching(fx.shapes(spark, d), mask).select(F.col("a_clean_fid").alias("clean_fid")).distinct()


@query(sql(*_SHAPES, *_TOUCH, body="SELECT a, b, len, overlap FROM E WHERE len >= 0.5 AND overlap <= 4"))
def poly_shared_edge_graph(spark, d):
    return _edges(fx.shapes(spark, d)).where("len >= 0.5 and overlap <= 4")


@query(sql(*_SHAPES, *_TOUCH, body="SELECT a, b, len, overlap, round(overlap/(p.area+q.area-overlap), 6) AS iou FROM E JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b"))
def poly_pair_measures(spark, d):
    s = fx.shapes(spark, d)
    area = lambda k: s.select(F.col("clean_fid").alias(k), F.col("area").alias(f"area_{k}"))
    e = _edges(s).join(area("a"), "a").join(area("b"), "b")
    return e.select("a", "b", "len", "overlap", F.round(F.col("overlap") / (F.col("area_a") + F.col("area_b") - F.col("overlap")), 6).alias("iou"))


@query(sql(*_SHAPES, *_TOUCH, body=f"SELECT a, count(*) AS degree, sum(len) AS total, string_agg(CAST(b AS VARCHAR), '|' ORDER BY b) AS neighbours FROM {_WAYS} WHERE len > 0 GROUP BY a"))
def poly_adjacency_arrays(spark, d):
    g = _both(_edges(fx.shapes(spark, d)).where("len > 0")).groupBy("a").agg(F.count("*").alias("degree"), F.sum("len").alias("total"), F.array_sort(F.collect_list("b")).alias("n"))
    return g.select("a", "degree", "total", F.array_join("n", "|").alias("neighbours"))


@query(sql(*_SHAPES, "NEAR AS (SELECT p.clean_fid AS a, q.clean_fid AS b FROM P p JOIN P q ON p.clean_fid <> q.clean_fid AND p.xmin - 6 <= q.xmax AND q.xmin <= p.xmax + 6 AND p.ymin - 6 <= q.ymax AND q.ymin <= p.ymax + 6 WHERE p.theme = 'Water')",
           *[t.replace("WHERE overlap > 0 OR gap = 0", "") for t in pair_table("N", "", "", "NEAR")],
           body="SELECT a AS clean_fid, count(*) AS n, sum(q.area) AS area, min(q.area) AS least, max(q.area) AS most FROM N JOIN P q ON q.clean_fid = N.b WHERE gap <= 6 GROUP BY 1"))
def poly_local_context_radius(spark, d):
    """What lies within 6 m of water, by the distance of the polygons themselves."""
    s = fx.shapes(spark, d)
    pairs = polygons.within(s.where("theme = 'Water'"), s, 6.0).where("a_clean_fid <> b_clean_fid")
    return pairs.groupBy(F.col("a_clean_fid").alias("clean_fid")).agg(F.count("*").alias("n"), F.sum("b_area").alias("area"), F.min("b_area").alias("least"), F.max("b_area").alias("most"))


@query(sql(*_SHAPES, *_TOUCH, body=f"""SELECT land, building, round(score, 6) AS score FROM (SELECT a AS land, b AS building, len / max(len) OVER (PARTITION BY a) AS score,
  row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM {_WAYS} e JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b
  WHERE p.theme = 'Land' AND q.theme = 'Building' AND len > 0) WHERE rn = 1"""))
def poly_land_best_building(spark, d):
    s = fx.shapes(spark, d)
    return _best_by_theme(_edges(s), s, "Land", "Building").select(F.col("a").alias("land"), F.col("b").alias("building"), "score")


def _best_by_theme(edges: DataFrame, shapes: DataFrame, of: str, to: str, without: DataFrame | None = None) -> DataFrame:
    """The neighbour of theme ``to`` with the longest common border, for polygons of theme ``of`` that are not in ``without`` (a)."""
    theme = lambda name, k: shapes.where(F.col("theme") == name).select(F.col("clean_fid").alias(k))
    e = _both(edges.where("len > 0")).join(theme(of, "a"), "a").join(theme(to, "b"), "b")
    e = e if without is None else e.join(without, "a", "left_anti")
    scored = e.withColumn("score", F.round(F.col("len") / F.max("len").over(Window.partitionBy("a")), 6))
    return joins.first_by(scored, ["a"], [F.desc("len"), F.asc("b")])


@query(sql(*_SHAPES, *_TOUCH, body=f"""SELECT a AS building, b AS land, len FROM (SELECT a, b, len, row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM {_WAYS} e
  JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE p.theme = 'Building' AND q.theme = 'Land' AND len > 0
  AND a NOT IN (SELECT b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY len DESC, b) AS rn FROM {_WAYS} e
    JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE p.theme = 'Land' AND q.theme = 'Building' AND len > 0) WHERE rn = 1)) WHERE rn = 1"""))
def poly_independent_building_land(spark, d):
    s = fx.shapes(spark, d)
    e = _edges(s)
    used = _best_by_theme(e, s, "Land", "Building").select(F.col("b").alias("a"))
    return _best_by_theme(e, s, "Building", "Land", used).select(F.col("a").alias("building"), F.col("b").alias("land"), "len")


def _claims(counted: DataFrame, edges: DataFrame) -> DataFrame:
    """Claims of polygons with points on neighbours without: common border and its share of the claimant's perimeter."""
    zero, anchor = counted.where("n = 0").select(F.col("clean_fid").alias("a")), counted.where("n > 0").select(F.col("clean_fid").alias("b"), "perimeter")
    e = _both(edges).where("len >= 0.5").join(zero, "a").join(anchor, "b")
    return e.select(F.col("a").alias("zero"), F.col("b").alias("anchor"), "len", exprs.ratio_or_zero(F.col("len"), F.col("perimeter")).alias("ratio"))


@query(sql(*_COUNTED, *_TOUCH, _CLAIMS, _OWN, body="SELECT zero, anchor, len, round(ratio, 6) AS ratio FROM OWN"))
def poly_k0_direct_owner(spark, d):
    c = _counted(spark, d)
    return joins.direct_owners(_claims(c, _edges(c))).withColumn("ratio", F.round("ratio", 6))


@query(sql(*_COUNTED, *_TOUCH, _CLAIMS, _OWN, body="""SELECT zero, anchor, round(share, 6) AS share FROM (SELECT c.zero, c.anchor, c.ratio/o.ratio AS share,
  row_number() OVER (PARTITION BY c.zero ORDER BY c.ratio/o.ratio DESC, c.ratio DESC, c.len DESC, c.anchor) AS rn FROM CL c JOIN OWN o ON o.zero = c.zero
  JOIN P pc ON pc.clean_fid = c.anchor JOIN P po ON po.clean_fid = o.anchor WHERE pc.area >= 100 AND po.area < 100 AND c.anchor <> o.anchor AND c.ratio/o.ratio >= 0.4 AND c.ratio >= 0.05) WHERE rn = 1"""))
def poly_k0_secondary_claims(spark, d):
    """A second owner out of an allowed set (here those of 100 m2 or more), where the first is not in it."""
    c = _counted(spark, d)
    claims = Scratch(spark, "claims").put(_claims(c, _edges(c)), "claims")
    allowed = c.where("area >= 100").select(F.col("clean_fid").alias("anchor"))
    return joins.secondary_owners(claims, joins.direct_owners(claims), allowed, 0.4, 0.05).select("zero", "anchor", F.round("share", 6).alias("share"))


@query(sql(*_COUNTED, *_TOUCH, _CLAIMS, _OWN, body=f"""SELECT zero, owner, via, len FROM (SELECT e.b AS zero, o.anchor AS owner, o.zero AS via, e.len,
  row_number() OVER (PARTITION BY e.b ORDER BY e.len/p.perimeter DESC, e.len DESC, o.ratio DESC, o.anchor, o.zero) AS rn
  FROM OWN o JOIN {_WAYS} e ON e.a = o.zero JOIN CNT c ON c.clean_fid = e.b JOIN P p ON p.clean_fid = o.anchor
  WHERE e.len >= 0.5 AND c.n = 0 AND e.b NOT IN (SELECT zero FROM OWN)) WHERE rn = 1"""))
def poly_k1_indirect_owner(spark, d):
    c = _counted(spark, d)
    e = _edges(c)
    own = Scratch(spark, "own").put(joins.direct_owners(_claims(c, e)), "own")
    free = c.where("n = 0").select(F.col("clean_fid").alias("b")).join(own.select(F.col("zero").alias("b")), "b", "left_anti")
    via = own.select(F.col("zero").alias("a"), F.col("anchor").alias("owner"), F.col("ratio").alias("parent"))
    hop = _both(e).where("len >= 0.5").join(free, "b").join(via, "a").join(c.select(F.col("clean_fid").alias("owner"), "perimeter"), "owner").withColumn("ratio", exprs.ratio_or_zero(F.col("len"), F.col("perimeter")))
    best = joins.first_by(hop, ["b"], [F.desc("ratio"), F.desc("len"), F.desc("parent"), F.asc("owner"), F.asc("a")])
    return best.select(F.col("b").alias("zero"), "owner", F.col("a").alias("via"), "len")


@query(sql(*_SHAPES, *_TOUCH, body="""SELECT a, b, len, p.area + q.area AS pair_area, round(len/least(p.perimeter, q.perimeter), 6) AS share_min, round(len/greatest(p.perimeter, q.perimeter), 6) AS share_max,
  least(p.theme, q.theme) || '>' || greatest(p.theme, q.theme) AS role_pair, round(ln(1+len), 6) AS log_len, CAST(p.source_fid = q.source_fid AS INTEGER) AS same_source,
  round(least(p.area,q.area)/greatest(p.area,q.area), 6) AS area_ratio, overlap, round(overlap/least(p.area, q.area), 6) AS overlap_share FROM E JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE len > 0"""))
def poly_pair_features(spark, d):
    s = fx.shapes(spark, d)
    side = lambda k: s.select(F.col("clean_fid").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("area", "perimeter", "theme", "source_fid")])
    e, c, r = _edges(s).where("len > 0").join(side("a"), "a").join(side("b"), "b"), F.col, lambda x, n: F.round(x, 6).alias(n)
    return e.select(
        "a", "b", "len", (c("a_area") + c("b_area")).alias("pair_area"), r(exprs.safe_ratio(c("len"), F.least("a_perimeter", "b_perimeter")), "share_min"),
        r(exprs.safe_ratio(c("len"), F.greatest("a_perimeter", "b_perimeter")), "share_max"), F.concat_ws(">", F.least("a_theme", "b_theme"), F.greatest("a_theme", "b_theme")).alias("role_pair"),
        r(F.log1p("len"), "log_len"), (c("a_source_fid") == c("b_source_fid")).cast("int").alias("same_source"), r(exprs.safe_ratio(F.least("a_area", "b_area"), F.greatest("a_area", "b_area")), "area_ratio"),
        "overlap", r(exprs.safe_ratio(c("overlap"), F.least("a_area", "b_area")), "overlap_share"),
    )


@query(sql(*_SHAPES, *_TOUCH, body="SELECT count(*) AS pairs, sum(overlap) AS total, max(overlap) AS most FROM E WHERE overlap > 0.5"))
def poly_overlap_validation(spark, d):
    """Overlaps beyond half a square metre: how many pairs, how much in all, the largest."""
    return _edges(fx.shapes(spark, d)).where("overlap > 0.5").agg(F.count("*").alias("pairs"), F.round(F.sum("overlap"), 6).alias("total"), F.max("overlap").alias("most"))


#: Pieces of the candidate dataset, in Spark and in SQL.
_ROLE = "CASE WHEN theme LIKE '%Building%' THEN 'building' WHEN theme LIKE '%Land%' THEN 'land' WHEN theme LIKE 'Roads%' THEN 'road' ELSE 'other' END"
_PIECE = f"p.clean_fid AS v, source_fid AS source, area, perimeter, {_ROLE} AS role, theme LIKE '%Land%' OR theme LIKE '%Building%' AS plot, CAST(p.clean_fid % 7 = 0 AS INTEGER) AS hole_fill, CAST(p.clean_fid % 11 = 0 AS INTEGER) AS gap_fill"
SIZE, BEAM = 3, 8


def _level(k: int) -> str:
    return f"""G{k} AS (SELECT anchor, ids, shared FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY shared DESC, ids) AS rn FROM (SELECT DISTINCT anchor, list_sort(list_append(ids, b)) AS ids, shared + more AS shared FROM (
  SELECT g.anchor, g.ids, g.shared, w.b, sum(w.len) AS more FROM (SELECT anchor, ids, shared, unnest(ids) AS v FROM G{k - 1}) g JOIN {_WAYS} w ON w.a = g.v AND w.len > 0 WHERE NOT list_contains(g.ids, w.b) GROUP BY 1, 2, 3, 4))) WHERE rn <= {BEAM})"""


def _sql_features() -> str:
    """SQL of every column of candidates.group_table, and of the targets."""
    count, total = lambda cond: f"count(*) FILTER ({cond})", lambda cond, v: f"coalesce(sum({v}) FILTER ({cond}), 0)"
    added, roles = "v <> anchor", candidates.ROLES
    inner = {
        "candidate_clean_count": "count(*)", "candidate_source_count": "count(DISTINCT source)", "anchor_clean_count": count("v = anchor"), "added_clean_count": count(added), "area_sum": "sum(area)", "area_max": "max(area)", "area_min": "min(area)",
        "perimeter_sum": "sum(perimeter)", "anchor_area": total("v = anchor", "area"), "anchor_outline": total("v = anchor", "perimeter"), "added_area_sum": total(added, "area"), "added_area_max": f"coalesce(max(area) FILTER ({added}), 0)",
        "uprn_count": "sum(uprns)", "anchor_uprn_count": total("v = anchor", "uprns"), "added_uprn_count": total(added, "uprns"), "added_uprn_polygon_count": count(f"{added} AND uprns > 0"), "contains_other_anchor_area": total(f"{added} AND uprns > 0", "area"),
        "anchor_role": "max(role) FILTER (v = anchor)", "is_polygon_hole_fill_count": "sum(hole_fill)", "is_enclosed_gap_fill_count": "sum(gap_fill)", "src": "list(DISTINCT source)",
        **{f"role_{r}_count": count(f"role = '{r}'") for r in roles}, **{f"role_{r}_area": total(f"role = '{r}'", "area") for r in roles}, **{f"added_role_{r}_count": count(f"role = '{r}' AND {added}") for r in roles},
    }
    free = "NOT inn AND buprns = 0 AND bplot"
    outer = {
        "internal_shared_len": total("inn", "len") + "/2", "anchor_added_shared_len": total("inn AND (v = anchor OR b = anchor)", "len") + "/2", "external_shared_len": total("NOT inn", "len"), "outside_neighbor_count": "count(DISTINCT b) FILTER (NOT inn)",
        "outside_uprn_neighbor_count": "count(DISTINCT b) FILTER (NOT inn AND buprns > 0)", "outside_building_neighbor_count": "count(DISTINCT b) FILTER (NOT inn AND brole = 'building')", "outside_zero_uprn_plot_neighbor_count": f"count(DISTINCT b) FILTER ({free})",
        "outside_zero_uprn_plot_shared_len": total(free, "len"), "outside_zero_uprn_plot_best_shared_len": f"coalesce(max(len) FILTER ({free}), 0)", "outside_zero_uprn_plot_max_area": f"coalesce(max(barea) FILTER ({free}), 0)",
        **{f"outside_zero_uprn_{r}_neighbor_count": f"count(DISTINCT b) FILTER ({free} AND brole = '{r}')" for r in roles}, **{f"outside_zero_uprn_{r}_shared_len": total(f"{free} AND brole = '{r}'", "len") for r in roles},
    }
    areas = {"outside_zero_uprn_plot_area": total("TRUE", "barea"), **{f"outside_zero_uprn_{r}_area": total(f"brole = '{r}'", "barea") for r in roles}}
    ratio = lambda a, b: f"{a}/CASE WHEN {b} = 0 THEN 1 ELSE {b} END"
    same, union = "len(list_intersect(src, target_sources))", "len(list_distinct(list_concat(src, target_sources)))"
    more = {
        "added_source_count": "greatest(candidate_source_count - 1, 0)", "added_area_mean": "CASE WHEN added_clean_count = 0 THEN 0 ELSE added_area_sum/added_clean_count END", "added_area_to_anchor": ratio("added_area_sum", "anchor_area"),
        "largest_part_area_ratio": ratio("area_max", "area_sum"), "smallest_part_area_ratio": ratio("area_min", "area_sum"), "anchor_added_shared_to_anchor_perimeter": ratio("anchor_added_shared_len", "anchor_outline"),
        "shared_to_external_shared": ratio("internal_shared_len", "external_shared_len"), "outside_zero_uprn_plot_mean_area": "CASE WHEN outside_zero_uprn_plot_neighbor_count = 0 THEN 0 ELSE outside_zero_uprn_plot_area/outside_zero_uprn_plot_neighbor_count END",
        "outside_zero_uprn_plot_shared_to_internal": ratio("outside_zero_uprn_plot_shared_len", "internal_shared_len"), "outside_zero_uprn_plot_shared_to_external": ratio("outside_zero_uprn_plot_shared_len", "external_shared_len"),
        "contains_other_anchor_count": "added_uprn_polygon_count", "role_signature": "concat_ws('|', " + ", ".join(f"CASE WHEN role_{r}_count > 0 THEN '{r}:' || role_{r}_count END" for r in sorted(roles)) + ")",
        "source_target_overlap_count": f"CASE WHEN target_sources IS NULL THEN 0 ELSE {same} END", "source_target_jaccard": f"CASE WHEN target_sources IS NULL THEN 0 ELSE {same}/greatest({union}, 1) END",
        "label": f"CASE WHEN target_sources IS NOT NULL THEN CAST({same} = {union} AND {union} > 0 AS INTEGER) END",
    }
    cols = lambda d: ", ".join(f"{v} AS {k}" for k, v in d.items())
    zero = lambda d: ", ".join(f"coalesce({k}, 0) AS {k}" for k in d)
    body = f"""SELECT * EXCLUDE (src, target_sources), {cols(more)} FROM (SELECT i.*, {zero(outer)}, {zero(areas)}, target_sources FROM
      (SELECT gid, anchor, {cols(inner)} FROM MEM JOIN N USING (v) GROUP BY 1, 2) i
      LEFT JOIN (SELECT gid, {cols(outer)} FROM TOU GROUP BY 1) o USING (gid)
      LEFT JOIN (SELECT gid, {cols(areas)} FROM (SELECT DISTINCT gid, b, brole, barea FROM TOU WHERE {free}) GROUP BY 1) q USING (gid)
      LEFT JOIN TG t ON t.anchor = i.anchor)"""
    return sql(
        *_COUNTED, *_TOUCH, f"N AS (SELECT {_PIECE}, c.n AS uprns FROM P p JOIN CNT c ON c.clean_fid = p.clean_fid)", "G1 AS (SELECT clean_fid AS anchor, [clean_fid] AS ids, 0.0::DOUBLE AS shared FROM P WHERE theme = 'Building')", _level(2), _level(3),
        "TG AS (SELECT a AS anchor, list(DISTINCT source) AS target_sources FROM (SELECT a, b FROM " + _WAYS + " WHERE len >= 8 UNION SELECT clean_fid, clean_fid FROM P) JOIN N ON N.v = b JOIN P ON P.clean_fid = a JOIN CNT ON CNT.clean_fid = a WHERE P.theme = 'Building' AND CNT.n > 0 GROUP BY 1)",
        "WANT AS (SELECT anchor, list_sort(list(DISTINCT v)) AS ids FROM (SELECT anchor, unnest(target_sources) AS source FROM TG) JOIN N USING (source) GROUP BY 1)",
        "GR AS (SELECT anchor || ':' || array_to_string(ids, '|') AS gid, anchor, ids FROM (SELECT anchor, ids FROM G1 UNION SELECT anchor, ids FROM G2 UNION SELECT anchor, ids FROM G3 UNION SELECT anchor, ids FROM WANT WHERE list_contains(ids, anchor)))",
        "MEM AS (SELECT gid, anchor, unnest(ids) AS v FROM GR)",
        f"TOU AS (SELECT m.gid, m.anchor, m.v, w.b, w.len, x.v IS NOT NULL AS inn, n.role AS brole, n.area AS barea, n.uprns AS buprns, n.plot AS bplot FROM MEM m JOIN {_WAYS} w ON w.a = m.v AND w.len > 0 JOIN N n ON n.v = w.b LEFT JOIN MEM x ON x.gid = m.gid AND x.v = w.b)",
        body=body,
    )


def _dataset(spark: SparkSession, d: str, shapes: bool) -> DataFrame:
    c = _counted(spark, d)
    e = _edges(c)
    piece = c.alias("p").select(*[F.expr(x) for x in _PIECE.replace("p.clean_fid", "clean_fid").replace("INTEGER", "INT").split(", ")], F.col("n").alias("uprns"), "geom")
    building = c.where("theme = 'Building'").select(F.col("clean_fid").alias("v"))
    strong = graph.both_ways(e).where("len >= 8").select("a", F.col("b").alias("v")).unionByName(c.select(F.col("clean_fid").alias("a"), F.col("clean_fid").alias("v")))
    targets = strong.join(c.where("theme = 'Building' and n > 0").select(F.col("clean_fid").alias("a")), "a").join(piece.select("v", "source"), "v").groupBy(F.col("a").alias("anchor")).agg(F.collect_set("source").alias("target_sources"))
    return candidates.candidate_dataset(piece, e, building, targets, SIZE, BEAM, shapes)


@query(_sql_features())
def candidate_dataset(spark, d):
    """Pool, enumeration, label and all counting features of the candidates of every building, in one plan; anchors with
    points have a target, which is what they share a long border with."""
    return _dataset(spark, d, shapes=False).drop("sources", "target_sources")


@query()
def candidate_dataset_shapes(spark, d):
    """The same with the shapes of group and anchor: all columns a model reads (no oracle: unions of overlapping forms)."""
    return _dataset(spark, d, shapes=True).drop("sources", "target_sources")


@query(sql(*_SHAPES, *_TOUCH, f"W AS (SELECT a, b, len FROM {_WAYS} WHERE len > 0)", "T AS (SELECT a, sum(len) AS total FROM W GROUP BY 1)", body="""SELECT CAST(W.a AS VARCHAR) || '+' || CAST(W.b AS VARCHAR) AS gid, p.area AS before_area_sum, p.area + q.area AS after_area_sum, q.area AS delta_area_sum,
  (p.area + q.area)/p.area AS ratio_area_sum, CAST(0 AS DOUBLE) AS before_internal_shared_len, len AS after_internal_shared_len, len AS delta_internal_shared_len, len AS ratio_internal_shared_len,
  t.total AS before_external_shared_len, t.total + s.total - 2*len AS after_external_shared_len, s.total - 2*len AS delta_external_shared_len, (t.total + s.total - 2*len)/t.total AS ratio_external_shared_len
  FROM W JOIN P p ON p.clean_fid = W.a JOIN P q ON q.clean_fid = W.b JOIN T t ON t.a = W.a JOIN T s ON s.a = W.b"""))
def completion_deltas(spark, d):
    """What adding each neighbour to each single piece changes: area, border inside, border outside, before and after."""
    c = fx.shapes(spark, d)
    e = _edges(c).where("len > 0").select("a", "b", "len")
    nodes = c.select(F.col("clean_fid").alias("v"), F.col("source_fid").alias("source"), "area", "perimeter", exprs.role(F.col("theme"), "anchor").alias("role"), F.lit(0).alias("uprns"), F.lit(True).alias("plot"), F.lit(0).alias("hole_fill"), F.lit(0).alias("gap_fill"))
    single = c.select(F.col("clean_fid").cast("string").alias("gid"), F.col("clean_fid").alias("anchor"), F.array("clean_fid").alias("ids"))
    more = candidates.completions(single, e).select(F.concat_ws("+", "gid", F.col("v").cast("string")).alias("gid"), F.col("gid").cast("bigint").alias("anchor"), "ids")
    measures = ["area_sum", "internal_shared_len", "external_shared_len"]
    before = candidates.group_table(single, nodes, e).join(more.select("anchor", F.col("gid").alias("to")), "anchor").select(F.col("to").alias("gid"), *measures)
    return candidates.deltas(before, candidates.group_table(more, nodes, e), "gid", measures)


_REAL = ("G AS (SELECT pred_component_id AS id, min(geom_wkt) AS wkt FROM predicted_parcels_with_uprn WHERE pred_component_id IS NOT NULL AND geom_wkt IS NOT NULL GROUP BY 1)", *edge_tables("G"))


def _real(spark: SparkSession, d: str) -> DataFrame:
    """The predicted parcels with a region, one row an id."""
    t = table(spark, d, "predicted_parcels_with_uprn").where("pred_component_id is not null and geom_wkt is not null")
    return polygons.with_shape(t.groupBy("pred_component_id").agg(F.min("geom_wkt").alias("wkt")))


@query(sql(*_REAL, "PAIRS AS (SELECT p.id AS a, q.id AS b FROM M p JOIN M q ON p.id < q.id AND p.xmin <= q.xmax AND q.xmin <= p.xmax AND p.ymin <= q.ymax AND q.ymin <= p.ymax)", *pair_table("E", "", "", "PAIRS"),
           body="SELECT a, b, len, overlap FROM E"))
def parcel_conflicts(spark, d):
    """Predicted parcels that touch or overlap, with their common border and area."""
    real = _real(spark, d)
    e = polygons.touching(real, real, "pred_component_id")
    return e.select(F.col("a_pred_component_id").alias("a"), F.col("b_pred_component_id").alias("b"), F.round("len", 6).alias("len"), F.round("overlap", 6).alias("overlap"))


@query(sql(*_REAL, "PAIRS AS (SELECT p.id AS a, q.id AS b FROM M p JOIN M q ON p.id < q.id AND p.xmin <= q.xmax AND q.xmin <= p.xmax AND p.ymin <= q.ymax AND q.ymin <= p.ymax)", *pair_table("E", "", "", "PAIRS"),
           body="SELECT DISTINCT CASE WHEN u.area < v.area OR (u.area = v.area AND a > b) THEN a ELSE b END AS pred_component_id FROM E JOIN M u ON u.id = a JOIN M v ON v.id = b WHERE overlap >= 0.9 * least(u.area, v.area)"))
def parcel_covered_drop(spark, d):
    """Predicted parcels of which at least nine tenths lie in one larger parcel (of equal ones the smaller id stays)."""
    real = _real(spark, d)
    e = polygons.touching(real, real, "pred_component_id").where(F.round("overlap", 6) >= 0.9 * F.least("a_area", "b_area"))
    first = (F.col("a_area") < F.col("b_area")) | ((F.col("a_area") == F.col("b_area")) & (F.col("a_pred_component_id") > F.col("b_pred_component_id")))
    return e.select(F.when(first, F.col("a_pred_component_id")).otherwise(F.col("b_pred_component_id")).alias("pred_component_id")).distinct()


@query(sql(*_REAL, body="SELECT id AS pred_component_id, area, perimeter FROM M"))
def parcel_measures(spark, d):
    return _real(spark, d).select("pred_component_id", "area", "perimeter")


_SPOTS = """LOC AS (SELECT uprn, x, y FROM (SELECT uprn, x_27700 AS x, y_27700 AS y, row_number() OVER (PARTITION BY uprn ORDER BY loaded_at DESC NULLS LAST, x_27700 DESC NULLS LAST, y_27700 DESC NULLS LAST) AS rn
  FROM osopenuprn_address WHERE uprn IS NOT NULL) WHERE rn = 1 AND x IS NOT NULL AND y IS NOT NULL AND NOT (x = 0 AND y = 0))"""
_PARCELS = ("G AS (SELECT row_number() OVER (ORDER BY pred_component_id, geom_wkt) AS id, pred_component_id AS pid, geom_wkt AS wkt FROM (SELECT DISTINCT pred_component_id, geom_wkt FROM predicted_parcels_with_uprn WHERE pred_component_id IS NOT NULL AND geom_wkt IS NOT NULL))", *edge_tables("G"))

#: The oracle of p1_found: pairs by grid cells of the search distance, regions by counting edges.
ORACLES["p1_found"] = sql(
    _SPOTS, *_PARCELS, _hits("HIT", "LOC", "uprn"), "HELD AS (SELECT DISTINCT h.uprn, g.pid FROM HIT h JOIN G g ON g.id = h.id)",
    "NB AS (SELECT uprn, x, y, floor(x / 2) AS cx, floor(y / 2) AS cy FROM LOC)", "PT AS (SELECT DISTINCT point_fid, x_27700 AS x, y_27700 AS y FROM oachargeid_point_candidate_assignments WHERE point_fid IS NOT NULL AND x_27700 IS NOT NULL AND y_27700 IS NOT NULL)",
    "D AS (SELECT i.i, j.i AS j FROM (SELECT unnest([-1, 0, 1]) AS i) i, (SELECT unnest([-1, 0, 1]) AS i) j)",
    body="""SELECT DISTINCT 'near' AS kind, a.uprn AS left_id, b.uprn AS right_id FROM (SELECT NB.*, cx + i AS mx, cy + j AS my FROM NB, D) a JOIN NB b ON b.cx = a.mx AND b.cy = a.my
  WHERE a.uprn < b.uprn AND (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) <= 4
UNION ALL SELECT DISTINCT 'point', p.point_fid, b.uprn FROM (SELECT PT.*, floor(x / 8) + i AS mx, floor(y / 8) + j AS my FROM PT, D) p JOIN (SELECT *, floor(x / 8) AS ex, floor(y / 8) AS ey FROM LOC) b ON b.ex = p.mx AND b.ey = p.my
  WHERE (p.x-b.x)*(p.x-b.x) + (p.y-b.y)*(p.y-b.y) <= 64
UNION ALL SELECT 'in', uprn, pid FROM HELD
UNION ALL SELECT DISTINCT 'recount', q.pred_component_id, coalesce(c.n, 0) FROM predicted_parcels_with_uprn q LEFT JOIN (SELECT pid, count(*) AS n FROM HELD GROUP BY 1) c ON c.pid = q.pred_component_id
  WHERE q.pred_component_id IS NOT NULL AND q.geom_wkt IS NOT NULL AND q.pred_uprn_count IS NOT NULL AND coalesce(c.n, 0) <> q.pred_uprn_count""",
)
