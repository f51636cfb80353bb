"""Queries of the assembly operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.functions import exprs
from terrane.operators import assembly as asm
from terrane.operators import graph, joins, selection
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import CNT, C, E, P, R, U, sql
from terrane.plans.spatial_queries import _counted, _edges, _short
from terrane.plans.structure_queries import _BOTH, _STRONG, _strong, connected_components
from terrane.session import Scratch
from terrane.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its function name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_OVERLAP = "OV AS (SELECT r.council_fid, p.clean_fid AS v, p.area, 8000.0 AS council_area, greatest(0.0, least(p.xmax,r.xmax)-greatest(p.xmin,r.xmin))*greatest(0.0, least(p.ymax,r.ymax)-greatest(p.ymin,r.ymin)) AS shared FROM P p, R r)"


def _overlaps(spark, d):
    p, r = fx.parcels(spark, d), fx.councils(spark, d).withColumn("area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    return joins.box_pairs(p, r).select(F.col("b_council_fid").alias("council_fid"), F.col("a_clean_fid").alias("v"), F.col("a_area").alias("area"), F.col("b_area").alias("council_area"), (joins.overlap_x() * joins.overlap_y()).alias("shared")).where("shared > 0")


@query(sql(P, E, _STRONG, _BOTH, body="SELECT e.a, e.b, ca.c AS component FROM E e JOIN (SELECT v, min(low) AS c FROM (WITH RECURSIVE reach AS (SELECT a AS v, a AS low FROM W UNION SELECT w.b, r.low FROM reach r JOIN W w ON w.a = r.v WHERE r.low < w.b) SELECT * FROM reach) GROUP BY v) ca ON ca.v = e.a JOIN (SELECT v, min(low) AS c FROM (WITH RECURSIVE reach AS (SELECT a AS v, a AS low FROM W UNION SELECT w.b, r.low FROM reach r JOIN W w ON w.a = r.v WHERE r.low < w.b) SELECT * FROM reach) GROUP BY v) cb ON cb.v = e.b WHERE ca.c = cb.c AND e.len > 0"))
def restamped_edges(spark, d):
    return asm.restamp_edges(_short(_edges(spark, d)), connected_components(spark, d)).select("a", "b", "component")


@query(sql(P, "A AS (SELECT source_fid AS component, sum(area) AS area FROM P GROUP BY 1)", "M AS (SELECT component - component % 9 AS merge_id, component, area FROM A)", body="""SELECT clean_fid AS v, b.w AS component, CAST(b.w <> P.source_fid AS INTEGER) AS moved FROM P JOIN M ON M.component = P.source_fid
  JOIN (SELECT merge_id, component AS w, row_number() OVER (PARTITION BY merge_id ORDER BY area DESC, component) AS rn FROM M) b ON b.merge_id = M.merge_id AND rn = 1"""))
def repair_write_back(spark, d):
    p = fx.parcels(spark, d)
    areas = p.groupBy(F.col("source_fid").alias("component")).agg(F.sum("area").alias("area"))
    merges = areas.select((F.col("component") - F.col("component") % 9).alias("merge_id"), "component")
    return asm.write_back(p.select(F.col("clean_fid").alias("v"), F.col("source_fid").alias("component")), merges, areas)


@query(sql(P, body="SELECT g AS gid, string_agg(CAST(p.clean_fid AS VARCHAR), '|' ORDER BY p.clean_fid) AS ids, CAST(3 - count(DISTINCT s) AS BIGINT) AS missing FROM (SELECT DISTINCT source_fid - source_fid % 30 AS g, unnest([source_fid - source_fid % 30, source_fid - source_fid % 30 + 3, source_fid - source_fid % 30 + 4]) AS s FROM P) JOIN P p ON p.source_fid = s GROUP BY 1"))
def translated_sets(spark, d):
    p = fx.parcels(spark, d)
    base = F.col("source_fid") - F.col("source_fid") % 30
    sets = p.select(base.alias("gid")).distinct().withColumn("ids", F.array(F.col("gid"), F.col("gid") + 3, F.col("gid") + 4))
    out = asm.translate_sets(sets, asm.id_index(p, "source_fid", "clean_fid"), "source_fid")
    return out.select("gid", exprs.ids_to_text(F.col("ids")).alias("ids"), "missing")


@query(sql(C, body="SELECT anchor, line, part, CAST(rn AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY proba DESC, size DESC, line*1000000 + part) AS rn FROM C) WHERE rn <= 2"))
def proposal_ranking(spark, d):
    return asm.three_key_ranking(fx.candidates(spark, d).withColumn("e", F.col("line") * 1_000_000 + F.col("part")), "anchor", "proba", "size", "e", 2).select("anchor", "line", "part", "place")


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'base' ELSE 'more' END AS origin FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def ordered_union(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return asm.union_in_order(c.where("k % 2 = 0").withColumn("origin", F.lit("base")), c.where("k % 3 = 0").withColumn("origin", F.lit("more")), ["k"])


@query(sql(C, "F1 AS (SELECT *, anchor*10 + line AS cid, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, anchor*10 + line, part, supp) AS rn FROM C)", body="""SELECT s.anchor, coalesce(b.cid, s.cid) AS cid, coalesce(b.score, s.score) AS score, CAST(b.cid IS NOT NULL AS INTEGER) AS replaced FROM (SELECT * FROM F1 WHERE rn = 1) s
  LEFT JOIN (SELECT anchor, cid, score FROM (SELECT anchor, cid, score, row_number() OVER (PARTITION BY anchor ORDER BY proba DESC, score DESC, cid) AS r FROM F1 WHERE rn > 1 AND proba >= 0.8) WHERE r = 1) b ON b.anchor = s.anchor"""))
def replacement_selector(spark, d):
    c = fx.candidates(spark, d).withColumn("cid", F.col("anchor") * 10 + F.col("line"))
    from pyspark.sql import Window

    ranked = c.withColumn("rn", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "cid", "part", "supp")))
    return asm.replacements(ranked.where("rn = 1").select("anchor", "cid", "score"), ranked.where("rn > 1").select("anchor", "cid", "score", F.col("proba").alias("gain")), 0.8)


@query(sql(P, R, _OVERLAP, body="""SELECT council_fid, string_agg(CAST(v AS VARCHAR), '|' ORDER BY v) AS ids, min(v) FILTER (WHERE v % 97 = 0) AS anchor FROM OV WHERE shared/area >= 0.7
  GROUP BY 1 HAVING count(*) FILTER (WHERE v % 97 = 0) = 1 AND sum(shared)/8000.0 >= 0.7"""))
def training_targets(spark, d):
    """Every 97th parcel stands for an anchor."""
    anchors = fx.parcels(spark, d).where("clean_fid % 97 = 0").select(F.col("clean_fid").alias("v"))
    return asm.two_way_targets(_overlaps(spark, d), anchors, 0.7).select("council_fid", exprs.ids_to_text(F.col("ids")).alias("ids"), "anchor")


@query(sql(P, R, U, CNT, _OVERLAP, body="""SELECT council_fid, parts, shared, largest, with_points, CASE WHEN 8000.0 > 9000 THEN 'too_large' WHEN shared/8000.0 < 0.8 THEN 'low_coverage' WHEN with_points > 1 THEN 'several_with_points' ELSE 'complete' END AS reason,
  CASE WHEN shared/8000.0 < 0.8 THEN 'keep' WHEN with_points > 1 THEN 'review' ELSE 'merge' END AS decision FROM (SELECT council_fid, count(*) AS parts, sum(shared) AS shared, max(area) AS largest, sum(CAST(CNT.n > 0 AS BIGINT)) AS with_points FROM OV JOIN CNT ON CNT.clean_fid = OV.v WHERE shared/area >= 0.9 GROUP BY 1) WHERE parts >= 2"""))
def hybrid_patches(spark, d):
    pairs = _overlaps(spark, d).join(_counted(spark, d).select(F.col("clean_fid").alias("v"), F.col("n").alias("uprns")), "v")
    return asm.patch_candidates(pairs, 0.9, 0.8, 9000.0).select("council_fid", "parts", "shared", "largest", "with_points", "reason", "decision")


@query()
def greedy_iou_all(spark, d):
    """All parcels of a council area, which overlap; the pieces kept and their ratio (no oracle)."""
    boxes = fx.parcels(spark, d).select(F.col("clean_fid").alias("v"), "xmin", "ymin", "xmax", "ymax")
    frame = fx.councils(spark, d).select("council_fid", *[F.col(c).alias("c" + c) for c in ("xmin", "ymin", "xmax", "ymax")])
    g = asm.greedy_boxes(_overlaps(spark, d).join(boxes, "v").join(frame, "council_fid"))
    return g.select("council_fid", F.size("ids").cast("bigint").alias("parts"), exprs.ids_to_text(F.col("ids")).alias("ids"), F.round("iou", 6).alias("iou"))


@query()
def gap_assignment(spark, d):
    """Parcels of theme water act as gaps; each goes to the neighbour it shares most border with, smallest first."""
    p = fx.parcels(spark, d)
    water = p.where("theme = 'Water'").select(F.col("clean_fid").alias("gap"), "area")
    e = graph.both_ways(_short(_edges(spark, d))).join(water.select(F.col("gap").alias("a")), "a").join(water.select(F.col("gap").alias("b"), F.lit(1).alias("w")), "b", "left")
    touching = e.select(F.col("a").alias("gap"), F.when(F.col("w").isNull(), F.col("b")).alias("clean_fid"), F.when(F.col("w") == 1, F.col("b")).alias("other_gap"), "len")
    return asm.assign_gaps(water, touching, Scratch(spark, "gaps"))


@query()
def component_split(spark, d):
    """Strong components with several parcels that hold points, cut into one part per such parcel."""
    labels = Scratch(spark, "split-labels").put(connected_components(spark, d), "l")
    c = _counted(spark, d).select(F.col("clean_fid").alias("v"), (F.col("n") > 0).alias("seed"))
    e = _strong(spark, d).join(labels.withColumnRenamed("v", "a"), "a").select("component", "a", "b", "len")
    scratch = Scratch(spark, "split-parts")
    return asm.best_split(scratch.put(labels.join(c, "v").select("component", "v", "seed"), "members"), scratch.put(e, "edges"))


@query()
def refined_groups(spark, d):
    """Hill climbing from each building over its pool of neighbours; the gain is border less a share of the outline."""
    e = _short(_edges(spark, d))
    anchors = fx.parcels(spark, d).where("theme = 'Building'").select(F.col("clean_fid").alias("v"))
    pool = graph.bounded_pool(e, anchors, 2, 8).where("depth > 0")
    p = fx.parcels(spark, d).select(F.col("clean_fid").alias("v"), "perimeter")
    gains = pool.join(p, "v").select("anchor", "v", (F.col("len") - 0.22 * F.col("perimeter")).alias("gain"), F.lit(None).cast("bigint").alias("needs"))
    out = asm.refine(anchors.select(F.col("v").alias("anchor"), F.array("v").alias("ids")), gains)
    return out.select("anchor", exprs.ids_to_text(F.col("ids")).alias("ids"), F.round("total", 6).alias("total"))


@query(sql(P, body="SELECT source_fid AS merge_id, clean_fid AS v, CAST((source_fid % 40)*10 AS DOUBLE) AS ax, CAST((clean_fid % 40)*10 AS DOUBLE) AS bx FROM P WHERE clean_fid <> source_fid AND source_fid IN (SELECT clean_fid FROM P)"))
def repair_line_rows(spark, d):
    p = fx.parcels(spark, d)
    return asm.repair_lines(p.select(F.col("source_fid").alias("merge_id"), F.col("source_fid").alias("anchor"), F.col("clean_fid").alias("v")), p.select(F.col("clean_fid").alias("v"), F.col("xmin").alias("x"), F.col("ymin").alias("y"))).select("merge_id", "v", "ax", "bx")


@query("SELECT candidate_id, raw_anchor_group_proba AS proba FROM (SELECT candidate_id, CASE WHEN isnan(raw_anchor_group_proba) THEN NULL ELSE raw_anchor_group_proba END AS raw_anchor_group_proba, row_number() OVER (PARTITION BY candidate_id ORDER BY CASE WHEN isnan(raw_anchor_group_proba) THEN NULL ELSE raw_anchor_group_proba END DESC NULLS LAST, exported_at) AS rn FROM wfs_raw_anchor_group_predictions_v1) WHERE rn = 1")
def candidate_cleanup(spark, d):
    raw = table(spark, d, "wfs_raw_anchor_group_predictions_v1").select("candidate_id", F.col("raw_anchor_group_proba").alias("proba"), "exported_at")
    return asm.best_per_key(raw, ["candidate_id"], "proba", F.asc_nulls_last("exported_at")).select("candidate_id", "proba")


@query("SELECT count(*) AS n FROM (SELECT p_partkey FROM part LIMIT 250)")
def seeded_sample_size(spark, d):
    """The sampling operator draws a fixed number of rows by hash; its size is what SQL can say."""
    return selection.seeded_sample(table(spark, d, "part"), "p_partkey", 250, 42).agg(F.count("*").alias("n"))
