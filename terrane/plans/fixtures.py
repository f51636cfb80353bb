"""Rectangles and points made from the star-schema tables, in Spark and in SQL.

All coordinates are whole or half metres, so every area and length is an exact double."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.geo import box_wkt
from terrane.sources.tables import table


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    x, y = (k % 40) * 10, F.floor(k / 40) * 10
    theme = F.element_at(F.array(*[F.lit(t) for t in ("Building", "Land", "Roads Tracks And Paths", "Land,Building", "Water")]), (k % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        k.alias("clean_fid"), (k - k % 3).alias("source_fid"), x.cast("double").alias("xmin"), y.cast("double").alias("ymin"),
        (x + 8 + F.col("p_size") % 5).cast("double").alias("xmax"), (y + 8 + (k * 7) % 5).cast("double").alias("ymax"), theme.alias("theme"),
    ).withColumn("area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).withColumn(
        "perimeter", 2 * (F.col("xmax") - F.col("xmin") + F.col("ymax") - F.col("ymin"))
    )


def uprns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(c.alias("uprn"), ((c * 37) % 400 + 0.5).cast("double").alias("x"), ((c * 53) % 500 + 0.5).cast("double").alias("y"))


def border_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(s.alias("pid"), ((s % 40) * 10).cast("double").alias("x"), ((s * 3) % 500).cast("double").alias("y"))


def councils(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    x, y = (n % 5) * 80, F.floor(n / 5) * 100
    return table(spark, sf_dir, "nation").select(
        n.cast("bigint").alias("council_fid"), x.cast("double").alias("xmin"), y.cast("double").alias("ymin"), (x + 80).cast("double").alias("xmax"), (y + 100).cast("double").alias("ymax")
    )


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Council parcels of 12, 22 or 32 m, so that some hold exactly one parcel and others several."""
    s = F.col("s_suppkey")
    x, y, side = (s * 7 % 40) * 10, (s * 3 % 50) * 10, 12 + s % 3 * 10
    return table(spark, sf_dir, "supplier").select(
        s.cast("bigint").alias("council_fid"), x.cast("double").alias("xmin"), y.cast("double").alias("ymin"), (x + side).cast("double").alias("xmax"), (y + side).cast("double").alias("ymax")
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate rows: one per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("anchor"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.col("l_extendedprice").alias("score"), F.col("l_quantity").alias("size"), (F.col("l_discount") * 10).alias("proba"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.concat(F.lit("m"), ((F.col("l_partkey") + F.col("l_linenumber")) % 6).cast("string")).alias("mode"),
    )


def with_geometry(df: DataFrame) -> DataFrame:
    from terrane.functions.geo import register, st_from_text

    register(df.sparkSession)
    return df.withColumn("geom", st_from_text(box_wkt(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))))


def _point(x: str, y: str) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST({y} AS BIGINT) AS VARCHAR)"


def _ring(*corners: tuple[str, str]) -> str:
    return "'(' || " + " || ', ' || ".join(_point(x, y) for x, y in (*corners, corners[0])) + " || ')'"


#: Polygon text of a parcel: an L without its upper right corner, a box with a hole, a box, an L without its lower left corner.
_BOX_RING = _ring(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))
SHAPE_SQL = f"""CASE clean_fid % 4
  WHEN 0 THEN 'POLYGON (' || {_ring(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax - 4"), ("xmax - 3", "ymax - 4"), ("xmax - 3", "ymax"), ("xmin", "ymax"))} || ')'
  WHEN 1 THEN 'POLYGON (' || {_BOX_RING} || ', ' || {_ring(("xmin + 2", "ymin + 2"), ("xmin + 2", "ymin + 5"), ("xmin + 4", "ymin + 5"), ("xmin + 4", "ymin + 2"))} || ')'
  WHEN 2 THEN 'POLYGON (' || {_BOX_RING} || ')'
  ELSE 'MULTIPOLYGON ((' || {_ring(("xmin + 2", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin + 3"), ("xmin + 2", "ymin + 3"))} || '))' END"""


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parcels as L-shapes, boxes with a hole and boxes, with their geometry."""
    from terrane.operators.polygons import with_shape

    return with_shape(parcels(spark, sf_dir).withColumn("wkt", F.expr(SHAPE_SQL.replace("VARCHAR", "STRING"))))


def council_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.operators.polygons import with_shape

    return with_shape(councils(spark, sf_dir).withColumn("wkt", F.expr(COUNCIL_SQL.replace("VARCHAR", "STRING"))))


COUNCIL_SQL = f"""'POLYGON (' || {_ring(("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax - 30"), ("xmin + 30", "ymax - 30"), ("xmin + 30", "ymax"), ("xmin", "ymax"))} || ')'"""


def edge_tables(source: str, p: str = "") -> tuple[str, ...]:
    """SQL tables of polygon texts (id, wkt) of any axis-parallel form: edges {p}S, signed corners {p}K and measures {p}M.

    A form is the sum of its corners, each a quarter plane with a sign, so common areas are sums over pairs of corners."""
    return (
        f"{p}RG AS (SELECT id, pi, unnest(rings) AS ring, generate_subscripts(rings, 1) AS ri FROM (SELECT id, pi, regexp_extract_all(part, '\\(([^()]*)\\)', 1) AS rings FROM (SELECT id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pi FROM (SELECT id, regexp_extract_all(wkt, '\\([ ]*\\([^()]*\\)(?:[ ]*,[ ]*\\([^()]*\\))*[ ]*\\)') AS parts FROM {source}))))",
        f"{p}V AS (SELECT id, pi, ri, k, CAST(string_split(trim(pt), ' ')[1] AS DOUBLE) AS x, CAST(string_split(trim(pt), ' ')[2] AS DOUBLE) AS y FROM (SELECT id, pi, ri, unnest(pts) AS pt, generate_subscripts(pts, 1) AS k FROM (SELECT id, pi, ri, string_split(ring, ',') AS pts FROM {p}RG)))",
        f"{p}S AS (SELECT * FROM (SELECT id, pi, ri, k, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM {p}V WINDOW w AS (PARTITION BY id, pi, ri ORDER BY k)) WHERE bx IS NOT NULL)",
        f"{p}TURN AS (SELECT id, pi, ri, sign(sum(ax*by_ - bx*ay)) * CASE WHEN ri = 1 THEN 1 ELSE -1 END AS s FROM {p}S GROUP BY 1, 2, 3)",
        f"{p}K AS (SELECT id, x, y, s * CASE WHEN upright = was_upright THEN 0 WHEN was_upright THEN 1 ELSE -1 END AS s FROM (SELECT id, pi, ri, ax AS x, ay AS y, ax = bx AS upright, coalesce(lag(ax = bx) OVER w, last_value(ax = bx) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS was_upright FROM {p}S WINDOW w AS (PARTITION BY id, pi, ri ORDER BY k)) JOIN {p}TURN USING (id, pi, ri))",
        f"{p}M AS (SELECT id, min(least(ax, bx)) AS xmin, min(least(ay, by_)) AS ymin, max(greatest(ax, bx)) AS xmax, max(greatest(ay, by_)) AS ymax, sum(abs(ax-bx) + abs(ay-by_)) AS perimeter, abs(sum(CASE WHEN ri = 1 THEN 1 ELSE -1 END * abs_part)) AS area FROM {p}S JOIN (SELECT id, pi, ri, abs(sum(ax*by_ - bx*ay))/2/count(*) AS abs_part FROM {p}S GROUP BY 1, 2, 3) USING (id, pi, ri) GROUP BY 1)",
    )


def pair_table(name: str, a: str, b: str, pairs: str) -> tuple[str, ...]:
    """SQL table {name} (a, b, len, overlap) of pairs of ids (a, b) of two sets of edge tables."""
    return (
        f"{name}_AREA AS (SELECT a, b, sum(k.s * q.s * (m - greatest(k.x, q.x)) * (n - greatest(k.y, q.y))) AS overlap FROM (SELECT p.a, p.b, greatest(u.xmax, v.xmax) AS m, greatest(u.ymax, v.ymax) AS n FROM {pairs} p JOIN {a}M u ON u.id = p.a JOIN {b}M v ON v.id = p.b) JOIN {a}K k ON k.id = a JOIN {b}K q ON q.id = b GROUP BY 1, 2)",
        f"{name}_LEN AS (SELECT a, b, sum(CASE WHEN e.ay = e.by_ AND f.ay = f.by_ AND e.ay = f.ay THEN greatest(0, least(greatest(e.ax,e.bx), greatest(f.ax,f.bx)) - greatest(least(e.ax,e.bx), least(f.ax,f.bx))) WHEN e.ax = e.bx AND f.ax = f.bx AND e.ax = f.ax THEN greatest(0, least(greatest(e.ay,e.by_), greatest(f.ay,f.by_)) - greatest(least(e.ay,e.by_), least(f.ay,f.by_))) ELSE 0 END) AS len, min(sqrt(pow(greatest(0, greatest(least(e.ax,e.bx), least(f.ax,f.bx)) - least(greatest(e.ax,e.bx), greatest(f.ax,f.bx))), 2) + pow(greatest(0, greatest(least(e.ay,e.by_), least(f.ay,f.by_)) - least(greatest(e.ay,e.by_), greatest(f.ay,f.by_))), 2))) AS gap FROM {pairs} p JOIN {a}S e ON e.id = p.a JOIN {b}S f ON f.id = p.b GROUP BY 1, 2)",
        f"{name} AS (SELECT a, b, len, overlap, CASE WHEN overlap > 0 THEN 0 ELSE gap END AS gap FROM {name}_AREA JOIN {name}_LEN USING (a, b) WHERE overlap > 0 OR gap = 0)",
    )


P = """P AS (SELECT *, (xmax-xmin)*(ymax-ymin) AS area, 2*(xmax-xmin+ymax-ymin) AS perimeter FROM (
  SELECT p_partkey AS clean_fid, p_partkey - p_partkey % 3 AS source_fid,
    CAST((p_partkey % 40)*10 AS DOUBLE) AS xmin, CAST((p_partkey // 40)*10 AS DOUBLE) AS ymin,
    CAST((p_partkey % 40)*10 + 8 + p_size % 5 AS DOUBLE) AS xmax, CAST((p_partkey // 40)*10 + 8 + (p_partkey*7) % 5 AS DOUBLE) AS ymax,
    CASE p_partkey % 5 WHEN 0 THEN 'Building' WHEN 1 THEN 'Land' WHEN 2 THEN 'Roads Tracks And Paths' WHEN 3 THEN 'Land,Building' ELSE 'Water' END AS theme
  FROM part))"""
U = "U AS (SELECT c_custkey AS uprn, CAST((c_custkey*37) % 400 + 0.5 AS DOUBLE) AS x, CAST((c_custkey*53) % 500 + 0.5 AS DOUBLE) AS y FROM customer)"
B = "B AS (SELECT s_suppkey AS pid, CAST((s_suppkey % 40)*10 AS DOUBLE) AS x, CAST((s_suppkey*3) % 500 AS DOUBLE) AS y FROM supplier)"
R = """R AS (SELECT CAST(n_nationkey AS BIGINT) AS council_fid, CAST((n_nationkey % 5)*80 AS DOUBLE) AS xmin, CAST((n_nationkey // 5)*100 AS DOUBLE) AS ymin,
  CAST((n_nationkey % 5)*80+80 AS DOUBLE) AS xmax, CAST((n_nationkey // 5)*100+100 AS DOUBLE) AS ymax FROM nation)"""
#: Council parcels of :func:`plots`.
L = """L AS (SELECT CAST(s_suppkey AS BIGINT) AS council_fid, CAST((s_suppkey*7 % 40)*10 AS DOUBLE) AS xmin, CAST((s_suppkey*3 % 50)*10 AS DOUBLE) AS ymin,
  CAST((s_suppkey*7 % 40)*10 + 12 + s_suppkey % 3 * 10 AS DOUBLE) AS xmax, CAST((s_suppkey*3 % 50)*10 + 12 + s_suppkey % 3 * 10 AS DOUBLE) AS ymax FROM supplier)"""
C = """C AS (SELECT l_orderkey AS anchor, CAST(l_linenumber AS INTEGER) AS line, l_partkey AS part, l_suppkey AS supp, l_extendedprice AS score, l_quantity AS size,
  l_discount*10 AS proba, CAST(l_returnflag = 'R' AS INTEGER) AS label, 'm' || CAST((l_partkey + l_linenumber) % 6 AS VARCHAR) AS mode FROM lineitem)"""
#: Points per parcel, borders included.
CNT = "CNT AS (SELECT p.clean_fid, count(DISTINCT u.uprn) AS n FROM P p LEFT JOIN U u ON u.x BETWEEN p.xmin AND p.xmax AND u.y BETWEEN p.ymin AND p.ymax GROUP BY 1)"
#: Neighbouring pairs a < b with their contact length and shared area (all collinear pieces of the two borders).
E = """E AS (SELECT * FROM (SELECT a.clean_fid AS a, b.clean_fid AS b,
  (CASE WHEN a.xmax = b.xmin OR b.xmax = a.xmin THEN iy ELSE 0 END) + (CASE WHEN a.xmin = b.xmin AND ix > 0 THEN iy ELSE 0 END) + (CASE WHEN a.xmax = b.xmax AND ix > 0 THEN iy ELSE 0 END)
  + (CASE WHEN a.ymax = b.ymin OR b.ymax = a.ymin THEN ix ELSE 0 END) + (CASE WHEN a.ymin = b.ymin AND iy > 0 THEN ix ELSE 0 END) + (CASE WHEN a.ymax = b.ymax AND iy > 0 THEN ix ELSE 0 END) AS len, ix*iy AS overlap
  FROM (SELECT p AS a, q AS b, greatest(0.0, least(p.xmax,q.xmax)-greatest(p.xmin,q.xmin)) AS ix, greatest(0.0, least(p.ymax,q.ymax)-greatest(p.ymin,q.ymin)) AS iy
        FROM P p JOIN P q ON p.clean_fid < q.clean_fid AND p.xmin <= q.xmax AND q.xmin <= p.xmax AND p.ymin <= q.ymax AND q.ymin <= p.ymax)) WHERE TRUE)"""


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + body
