"""Queries of expressions, aggregations, rankings, set operations and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrane.functions import exprs
from terrane.operators import aggregates as ag
from terrane.operators import joins, selection
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import C, E, P, R, sql
from terrane.plans.spatial_queries import _edges, _short
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


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.5' ELSE 'k' || o_orderkey END AS key FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def key_canonicaliser(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 7 == 0, None).when(k % 5 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit(" k"), k.cast("string"), F.lit(" ")))
    return table(spark, d, "orders").select("o_orderkey").distinct().select("o_orderkey", exprs.canonical_key(raw).alias("key"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN -1.0 ELSE c_custkey * 0.5 END AS value, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS DOUBLE) ELSE c_custkey / 2.0 END AS ratio FROM customer""")
def safe_casts_and_ratios(spark, d):
    k = F.col("c_custkey")
    text = F.when(k % 8 == 0, "n/a").when(k % 4 == 0, "NaN").otherwise((k * 0.5).cast("string"))
    return table(spark, d, "customer").select("c_custkey", exprs.safe_number(text, -1.0).alias("value"), exprs.safe_ratio(k.cast("double"), F.when(k % 2 == 0, 0.0).otherwise(2.0)).alias("ratio"))


@query(sql(P, body="SELECT clean_fid, CAST(lower(theme) LIKE '%road%' OR lower(theme) LIKE '%water%' AS BOOLEAN) AS hit, false AS none, true AS every FROM P"))
def term_filter(spark, d):
    t = F.col("theme")
    return fx.parcels(spark, d).select("clean_fid", exprs.any_term(t, ["ROAD", "water"], False).alias("hit"), exprs.any_term(t, [], False).alias("none"), exprs.any_term(t, [" "], True).alias("every"))


@query(sql(P, body="""SELECT clean_fid, CASE WHEN theme LIKE '%Building%' THEN 'building' WHEN theme LIKE 'Roads%' THEN 'road' WHEN theme LIKE '%Land%' THEN 'land' ELSE 'other' END AS preprocess,
  CASE WHEN theme LIKE '%Building%' THEN 'building' WHEN theme LIKE '%Land%' THEN 'land' WHEN theme LIKE 'Roads%' THEN 'road' ELSE 'other' END AS anchor,
  CASE WHEN theme LIKE '%Building%' THEN 'building' WHEN theme LIKE '%Land%' THEN 'land' ELSE 'other' END AS edge,
  CASE WHEN clean_fid % 11 = 0 THEN 'hard_road' WHEN theme LIKE '%Building%' THEN 'building' WHEN clean_fid % 7 = 0 THEN 'roadside' WHEN theme LIKE '%Water%' THEN 'water' WHEN theme LIKE '%Land%' THEN 'land' ELSE 'other' END AS point,
  theme LIKE '%Land%' OR theme LIKE '%Building%' AS plot FROM P"""))
def role_variants(spark, d):
    t, k = F.col("theme"), F.col("clean_fid")
    group = F.when(k % 11 == 0, "Road Or Track").when(k % 7 == 0, "Roadside")
    return fx.parcels(spark, d).select(
        "clean_fid", *[exprs.role(t, v).alias(v) for v in ("preprocess", "anchor", "edge")], exprs.point_role(t, group, F.lit(None).cast("string")).alias("point"), exprs.plot_eligible(t, True).alias("plot"),
    )


@query(sql(P, body="SELECT clean_fid, theme NOT LIKE 'Roads%' OR (2*area/perimeter <= 5 AND area <= 110) AS kept FROM P"))
def road_keep_mask(spark, d):
    return fx.parcels(spark, d).select("clean_fid", exprs.road_kept(F.col("theme"), F.col("area"), F.col("perimeter"), 5.0, 110.0).alias("kept"))


@query(sql(P, body="""SELECT clean_fid, concat_ws('|', CASE WHEN area/144 < 0.6 THEN 'low_mrr_ratio' END, CASE WHEN area > 120 THEN 'high_hull_gap' END, CASE WHEN area/perimeter < 2.4 THEN 'low_compactness' END) AS warning,
  CASE WHEN theme = 'Water' THEN 'theme' WHEN area < 70 THEN 'tiny' WHEN theme LIKE 'Roads%' AND area > 100 THEN 'large_road' END AS reason FROM P"""))
def shape_warning_and_exclusion(spark, d):
    a, t = F.col("area"), F.col("theme")
    return fx.parcels(spark, d).select(
        "clean_fid", exprs.shape_warning(a / 144, a / 1000, a / F.col("perimeter"), 0.6, 0.12, 2.4).alias("warning"),
        exprs.exclude_reason([("theme", t == "Water"), ("tiny", a < 70), ("large_road", t.startswith("Roads") & (a > 100))]).alias("reason"),
    )


@query("""SELECT o_orderkey, bool_or(flag) AS usable FROM (SELECT o_orderkey, o_orderstatus IN ('O', 'F') AND (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0) AS flag FROM orders) GROUP BY 1""")
def usable_match_mask(spark, d):
    k = F.col("o_orderkey")
    text = F.when(~F.col("o_orderstatus").isin("O", "F"), None).when(k % 3 == 0, "1.0").when(k % 5 == 0, " Yes ").otherwise("0")
    return table(spark, d, "orders").select("o_orderkey", exprs.truthy(text).alias("flag")).groupBy("o_orderkey").agg(F.max("flag").alias("usable"))


@query(sql(C, body="""SELECT anchor, string_agg(CAST(part AS VARCHAR), '|' ORDER BY part) AS ids, count(*) AS n FROM (SELECT DISTINCT anchor, part FROM C) GROUP BY 1"""))
def idset_codec(spark, d):
    ids = fx.candidates(spark, d).groupBy("anchor").agg(F.collect_set("part").alias("s")).select("anchor", exprs.ids_to_text(F.col("s")).alias("ids"))
    return ids.select("anchor", exprs.ids_to_text(exprs.text_to_ids(F.concat(F.lit("x| "), "ids", F.lit("||")))).alias("ids"), F.size(exprs.text_to_ids(F.col("ids"))).cast("bigint").alias("n"))


@query("""SELECT c_custkey, CAST(abs(((c_custkey * 7) % 360 - c_custkey % 180 + 45 + 3600) % 90 - 45) AS DOUBLE) AS dev,
  CAST(least(((c_custkey * 7) % 360 - c_custkey % 180 + 3600) % 90, 90 - ((c_custkey * 7) % 360 - c_custkey % 180 + 3600) % 90) AS DOUBLE) AS delta FROM customer""")
def angle_algebra(spark, d):
    a, x = ((F.col("c_custkey") * 7) % 360).cast("double"), (F.col("c_custkey") % 180).cast("double")
    return table(spark, d, "customer").select("c_custkey", exprs.axis_deviation(a, x).alias("dev"), exprs.axis_delta(a, x).alias("delta"))


@query(sql(C, body="""SELECT part AS source, anchor AS owner FROM (SELECT part, anchor, row_number() OVER (PARTITION BY part ORDER BY n, anchor) AS rn FROM (SELECT DISTINCT anchor, part FROM C) JOIN (SELECT anchor, count(DISTINCT part) AS n FROM C GROUP BY 1) USING (anchor)) WHERE rn = 1"""))
def source_owner_map(spark, d):
    sets = fx.candidates(spark, d).groupBy("anchor").agg(F.collect_set("part").alias("ids"))
    owned = sets.select("anchor", F.size("ids").alias("n"), F.explode("ids").alias("source"))
    return owned.groupBy("source").agg(F.min_by("anchor", F.struct("n", "anchor")).alias("owner"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def merge_cardinality_violations(spark, d):
    return joins.cardinality_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) AS has_large FROM customer")
def semi_anti_by_ids(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(big, "c_custkey", "left_semi").withColumn("has_large", F.lit(True)).unionByName(c.join(big, "c_custkey", "left_anti").withColumn("has_large", F.lit(False)))


@query(sql(C, "D AS (SELECT DISTINCT anchor, part FROM C)", "N AS (SELECT anchor, count(*) AS n FROM D GROUP BY 1)", body="""SELECT N.anchor AS left_id, r AS right_id, coalesce(cls, 'none') AS cls FROM N LEFT JOIN (
  SELECT l, r, row_number() OVER (PARTITION BY l ORDER BY k DESC, k*1.0/(nl+nr-k) DESC, r) AS rn, CASE WHEN k = nl AND k = nr THEN 'exact' WHEN k = nl THEN 'partial' WHEN k = nr THEN 'overmerge' ELSE 'mismatch' END AS cls
  FROM (SELECT l, r, k, a.n AS nl, b.n AS nr FROM (SELECT a.anchor AS l, b.anchor AS r, count(*) AS k FROM D a JOIN D b ON a.part = b.part WHERE a.anchor % 2 = 0 AND b.anchor % 2 = 1 GROUP BY 1, 2) JOIN N a ON a.anchor = l JOIN N b ON b.anchor = r)) ON l = N.anchor AND rn = 1
WHERE N.anchor % 2 = 0"""))
def set_containment_all(spark, d):
    """Every even anchor against all odd ones, so every anchor is on a side; ``none`` where no set shares an item."""
    c = fx.candidates(spark, d).select("anchor", "part").distinct()
    size = c.groupBy("anchor").agg(F.count("*").alias("n"))
    left = size.where("anchor % 2 = 0").select(F.col("anchor").alias("left_id"), F.col("n").alias("nl"))
    both = joins.set_overlaps(c.where("anchor % 2 = 0").select(F.col("anchor").alias("left_id"), F.col("part").alias("item")), c.where("anchor % 2 = 1").select(F.col("anchor").alias("right_id"), F.col("part").alias("item")))
    j = both.join(left, "left_id").join(size.select(F.col("anchor").alias("right_id"), F.col("n").alias("nr")), "right_id")
    j = j.withColumn("jac", F.col("both") / (F.col("nl") + F.col("nr") - F.col("both")))
    best = j.groupBy("left_id").agg(F.max(F.struct("both", "jac", (-F.col("right_id")).alias("m"), "nr")).alias("b"))
    return left.join(best, "left_id", "left").select("left_id", (-F.col("b.m")).alias("right_id"), joins.containment_class(F.col("b.both"), F.col("nl"), F.col("b.nr")).alias("cls"))


@query(sql(C, body="""SELECT anchor, string_agg(mode, ' | ' ORDER BY f, mode) AS modes FROM (SELECT anchor, mode, f, row_number() OVER (PARTITION BY anchor ORDER BY f, mode) AS rn FROM (SELECT anchor, mode, min(line) AS f FROM C GROUP BY 1, 2)) WHERE rn <= 3 GROUP BY 1"""))
def ordered_distinct_concat(spark, d):
    return ag.ordered_distinct_text(fx.candidates(spark, d), ["anchor"], ["line"], "mode", "modes", " | ", 3)


@query("""SELECT oachargeid, candidate_id, count(*) AS point_count, sum(CAST(p = 'same' AS BIGINT)) AS same_count, sum(CAST(p = 'opposite' AS BIGINT)) AS opposite_count, sum(CAST(p NOT IN ('same','opposite') AS BIGINT)) AS blank_parity_count,
  round(sum(CAST(p = 'same' AS BIGINT))/count(*), 6) AS same_ratio, round(CASE WHEN sum(CAST(p IN ('same','opposite') AS BIGINT)) > 0 THEN sum(CAST(p = 'same' AS BIGINT))/sum(CAST(p IN ('same','opposite') AS BIGINT)) ELSE 0 END, 6) AS same_ratio_known,
  round(avg(s), 6) AS address_similarity_mean, max(s) AS address_similarity_max, count(DISTINCT point_fid) AS point_fids
  FROM (SELECT DISTINCT assignment_id, oachargeid, candidate_id, point_fid, lower(trim(coalesce(address_range_parity, ''))) AS p, coalesce(CASE WHEN isnan(api_address_similarity) THEN NULL ELSE api_address_similarity END, 0) AS s FROM oachargeid_point_candidate_assignments) GROUP BY 1, 2""")
def parcel_candidate_metrics(spark, d):
    rows = table(spark, d, "oachargeid_point_candidate_assignments").select("assignment_id", "oachargeid", "candidate_id", "point_fid", "address_range_parity", "api_address_similarity").distinct()
    m = ag.group_metrics(rows, ["oachargeid", "candidate_id"], "address_range_parity", "api_address_similarity", "point_fid")
    return m.withColumns({c: F.round(c, 6) for c in ("same_ratio", "same_ratio_known", "address_similarity_mean")})


@query(sql(C, body="SELECT anchor, string_agg(mode || ':' || n, '|' ORDER BY mode || ':' || n) AS signature FROM (SELECT anchor, mode, count(*) AS n FROM C GROUP BY 1, 2) GROUP BY 1"))
def composition_signature(spark, d):
    return ag.role_signature(fx.candidates(spark, d), ["anchor"], "mode")


@query(sql(P, R, body="""SELECT council_fid, count(*) AS source_count, sum(area) AS area, min(area) AS least, max(area) AS most, round(avg(area), 6) AS mean, count(DISTINCT source_fid) AS sources, max(CAST(k > 1 AS INTEGER)) AS possible_split
  FROM (SELECT *, count(DISTINCT council_fid) OVER (PARTITION BY source_fid) AS k FROM (SELECT r.council_fid, p.clean_fid, p.source_fid, p.area FROM P p JOIN R r ON p.xmin >= r.xmin AND p.xmin < r.xmax AND p.ymin >= r.ymin AND p.ymin < r.ymax)) GROUP BY 1"""))
def component_rollup_split_flags(spark, d):
    p = fx.parcels(spark, d).withColumn("x", F.col("xmin")).withColumn("y", F.col("ymin")).select("clean_fid", "source_fid", "area", "x", "y")
    at = joins.points_in_boxes(p, fx.councils(spark, d)).where("x < b_xmax and y < b_ymax").select(F.col("b_council_fid").alias("council_fid"), "clean_fid", "source_fid", "area")
    split = at.groupBy("source_fid").agg((F.countDistinct("council_fid") > 1).cast("int").alias("s"))
    return at.join(split, "source_fid").groupBy("council_fid").agg(
        F.count("*").alias("source_count"), F.sum("area").alias("area"), F.min("area").alias("least"), F.max("area").alias("most"), F.round(F.avg("area"), 6).alias("mean"),
        F.countDistinct("source_fid").alias("sources"), F.max("s").alias("possible_split"),
    )


@query(sql(C, body="""SELECT part, supp, n, round(total, 6) AS total, most, round(mean, 6) AS mean, example, CAST(rk AS INTEGER) AS rk, round(most/coalesce(lead(most) OVER (PARTITION BY part ORDER BY most DESC, supp), most), 6) AS margin,
  CASE WHEN n >= 3 THEN 'strong' WHEN n = 2 THEN 'medium' ELSE 'weak' END AS tier FROM (SELECT part, supp, count(*) AS n, sum(size) AS total, max(score) AS most, avg(size) AS mean, arg_max(anchor, (score, -anchor)) AS example,
    row_number() OVER (PARTITION BY part ORDER BY max(score) DESC, supp) AS rk FROM (SELECT part, supp, size, score, anchor FROM C) GROUP BY 1, 2)"""))
def edge_pair_aggregate(spark, d):
    g = fx.candidates(spark, d).groupBy("part", "supp").agg(
        F.count("*").alias("n"), F.round(F.sum("size"), 6).alias("total"), F.max("score").alias("most"), F.round(F.avg("size"), 6).alias("mean"),
        (-F.max(F.struct("score", (-F.col("anchor")).alias("m")))["m"]).alias("example"),
    )
    w = Window.partitionBy("part").orderBy(F.desc("most"), "supp")
    tier = F.when(F.col("n") >= 3, "strong").when(F.col("n") == 2, "medium").otherwise("weak")
    return g.withColumn("rk", F.row_number().over(w)).withColumn("margin", F.round(F.col("most") / F.coalesce(F.lead("most").over(w), F.col("most")), 6)).withColumn("tier", tier)


@query(sql(C, body="""SELECT anchor, count(*) AS pool, max(score) FILTER (WHERE rk = 1) AS top_score, max(part) FILTER (WHERE rk = 1) AS top_part, round(sum(score) FILTER (WHERE rk <= 3), 4) AS top3,
  round(max(score) FILTER (WHERE rk = 1) - coalesce(max(score) FILTER (WHERE rk = 2), 0), 4) AS top2_margin, sum(CAST(proba >= 0.5 AS BIGINT)) AS high, count(DISTINCT part) AS parts
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, line) AS rk FROM C) GROUP BY 1"""))
def anchor_pool_summary(spark, d):
    ranked = fx.candidates(spark, d).withColumn("rk", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "line")))
    at = lambda k, c: F.max(F.when(F.col("rk") == k, F.col(c)))
    return ranked.groupBy("anchor").agg(
        F.count("*").alias("pool"), at(1, "score").alias("top_score"), at(1, "part").alias("top_part"), F.round(F.sum(F.when(F.col("rk") <= 3, F.col("score"))), 4).alias("top3"),
        F.round(at(1, "score") - F.coalesce(at(2, "score"), F.lit(0.0)), 4).alias("top2_margin"), F.sum((F.col("proba") >= 0.5).cast("int")).alias("high"), F.countDistinct("part").alias("parts"),
    )


@query(sql(P, body="""SELECT theme, mode, support FROM (SELECT theme, bin, count(*) AS support, quantile_cont(area, 0.5) AS mode, row_number() OVER (PARTITION BY theme ORDER BY count(*) DESC, bin) AS rn
  FROM (SELECT theme, area, round_even(area / greatest(5, med * 0.08), 0) AS bin FROM P JOIN (SELECT theme, quantile_cont(area, 0.5) AS med FROM P GROUP BY 1) USING (theme)) GROUP BY 1, 2) WHERE rn = 1"""))
def local_mode_area(spark, d):
    return ag.local_mode(fx.parcels(spark, d), ["theme"], "area")


@query(sql(C, body="SELECT part, CASE WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS state FROM (SELECT p_partkey AS part FROM part) LEFT JOIN (SELECT part, count(*) AS n FROM C WHERE line = 1 GROUP BY 1) USING (part) WHERE n IS NULL OR n > 1"))
def coverage_audit(spark, d):
    return ag.coverage_audit(fx.candidates(spark, d).where("line = 1"), table(spark, d, "part").select(F.col("p_partkey").alias("part")), "part")


_CUR = """PER AS (SELECT proba AS threshold, sum(label) AS p, count(*) AS n FROM C GROUP BY 1), CUR AS (SELECT threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w - sum(p) OVER w AS BIGINT) AS fp, (SELECT sum(p) FROM PER) AS all_p FROM PER WINDOW w AS (ORDER BY threshold DESC))"""


@query(sql(C, body="""SELECT tp, fp, fn, tn, round(tp/(tp+fp), 6) AS precision, round(tp/(tp+fn), 6) AS recall, round(2*tp/(2*tp+fp+fn), 6) AS f1, round(brier, 6) AS brier, round(log_loss, 6) AS log_loss FROM (SELECT
  sum(CAST(label=1 AND proba>=0.5 AS BIGINT)) AS tp, sum(CAST(label=0 AND proba>=0.5 AS BIGINT)) AS fp, sum(CAST(label=1 AND proba<0.5 AS BIGINT)) AS fn, sum(CAST(label=0 AND proba<0.5 AS BIGINT)) AS tn, avg((proba-label)*(proba-label)) AS brier,
  avg(-CASE WHEN label=1 THEN ln(greatest(proba,1e-15)) ELSE ln(greatest(1-proba,1e-15)) END) AS log_loss FROM C)"""))
def classification_metrics(spark, d):
    return ag.confusion(fx.candidates(spark, d), "label", "proba", 0.5).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "brier", "log_loss")})


@query(sql(C, _CUR, body="SELECT threshold, tp, fp, round(tp/(tp+fp), 6) AS precision, round(tp/all_p, 6) AS recall FROM CUR"))
def pr_curve(spark, d):
    return ag.curve(fx.candidates(spark, d), "label", "proba").select("threshold", "tp", "fp", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(sql(C, _CUR, body="""SELECT arg_max(threshold, (round(2*tp/(tp+fp+all_p), 12), threshold)) AS best_f1, arg_max(threshold, (tp/all_p, threshold)) FILTER (WHERE tp/(tp+fp) >= 0.249) AS for_precision,
  arg_max(threshold, (tp/(tp+fp), threshold)) FILTER (WHERE tp/all_p >= 0.6) AS for_recall FROM CUR"""))
def pr_threshold(spark, d):
    return ag.pick_thresholds(ag.curve(fx.candidates(spark, d), "label", "proba"), 0.249, 0.6)


@query(sql(C, _CUR, body="""SELECT round(sum((fp-fp0)*(tp+tp0)/2.0)/(max(tp)*max(fp)), 6) AS roc_auc, round(sum((tp-tp0)/all_p*tp/(tp+fp)), 6) AS average_precision FROM (SELECT *, coalesce(lag(tp) OVER (ORDER BY threshold DESC), 0) AS tp0, coalesce(lag(fp) OVER (ORDER BY threshold DESC), 0) AS fp0 FROM CUR)"""))
def auc_rank(spark, d):
    c = fx.candidates(spark, d)
    auc = ag.roc_auc(c, "label", "proba").select(F.round("roc_auc", 6).alias("roc_auc"))
    return auc.crossJoin(F.broadcast(ag.average_precision(ag.curve(c, "label", "proba")).select(F.round("average_precision", 6).alias("average_precision"))))  # one row each


@query(sql(C, body="SELECT m AS mode, count(*) AS n, round(avg(CASE WHEN label=1 THEN CAST(proba>=0.5 AS INT) END), 6) AS recall, round(avg(CASE WHEN label=0 THEN CAST(proba>=0.5 AS INT) END), 6) AS fpr, round(quantile_cont(score, 0.1), 4) AS p10, round(quantile_cont(score, 0.5), 4) AS p50, round(quantile_cont(score, 0.9), 4) AS p90 FROM (SELECT *, CASE WHEN line = 7 THEN NULL ELSE mode END AS m FROM C) GROUP BY 1"))
def slice_quantiles(spark, d):
    hit = (F.col("proba") >= 0.5).cast("int")
    p = lambda q: F.round(F.percentile("score", F.lit(q)), 4)
    return fx.candidates(spark, d).withColumn("mode", F.when(F.col("line") != 7, F.col("mode"))).groupBy("mode").agg(
        F.count("*").alias("n"), F.round(F.avg(F.when(F.col("label") == 1, hit)), 6).alias("recall"), F.round(F.avg(F.when(F.col("label") == 0, hit)), 6).alias("fpr"), p(0.1).alias("p10"), p(0.5).alias("p50"), p(0.9).alias("p90"),
    )


@query(sql(C, body="""SELECT count(*) AS groups, round(avg(CAST(rank=1 AS INT)), 6) AS top1, round(avg(CAST(rank<=2 AS INT)), 6) AS within_k, round(avg(rank), 6) AS mean_rank, quantile_cont(rank, 0.5) AS median_rank, quantile_cont(rank, 0.9) AS p90_rank
  FROM (SELECT anchor, min(rn) FILTER (WHERE label=1) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, line) AS rn FROM C) GROUP BY 1) WHERE rank IS NOT NULL"""))
def ranking_metrics(spark, d):
    return ag.ranking_metrics(fx.candidates(spark, d), ["anchor"], "score", "label", [F.asc("line")], 2).withColumns({c: F.round(c, 6) for c in ("top1", "within_k", "mean_rank")})


@query(sql(C, body="SELECT mode, label, count(*) AS n FROM C GROUP BY 1, 2"))
def value_counts(spark, d):
    return fx.candidates(spark, d).groupBy("mode", "label").agg(F.count("*").alias("n"))


@query(sql(C, body="SELECT anchor, line, CAST(rn AS INTEGER) AS rn FROM (SELECT anchor, line, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, part, line) AS rn FROM C) WHERE rn <= 3"))
def topk_budget(spark, d):
    w = Window.partitionBy("anchor").orderBy(F.desc("score"), "part", "line")
    return fx.candidates(spark, d).withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("anchor", "line", "rn")


@query(sql(C, body="SELECT anchor, line, part, rank() OVER (PARTITION BY anchor ORDER BY size) + (count(*) OVER (PARTITION BY anchor, size) - 1)/2.0 AS up, rank() OVER (PARTITION BY anchor ORDER BY size DESC) + (count(*) OVER (PARTITION BY anchor, size) - 1)/2.0 AS down FROM C"))
def average_rank(spark, d):
    c = fx.candidates(spark, d)
    return ag.average_rank(ag.average_rank(c, ["anchor"], "size", "up"), ["anchor"], "size", "down", descending=True).select("anchor", "line", "part", "up", "down")


@query(sql(C, body="SELECT anchor, line, part, round(CASE WHEN max(proba) OVER w = 0 THEN 0 ELSE proba/max(proba) OVER w END, 6) AS share_of_max, round(proba - min(proba) OVER w, 6) AS above_min FROM C WINDOW w AS (PARTITION BY anchor)"))
def pool_max_delta(spark, d):
    return ag.relative_to_group(fx.candidates(spark, d), ["anchor"], "proba").select("anchor", "line", "part", F.round("share_of_max", 6).alias("share_of_max"), F.round("above_min", 6).alias("above_min"))


@query(sql(C, body="SELECT anchor, line, part, round(score - first_value(score) OVER w, 4) AS delta, round(score/first_value(score) OVER w, 6) AS ratio, coalesce(lead(score) OVER w, -1) AS next_best FROM C WINDOW w AS (PARTITION BY anchor ORDER BY score DESC, part, line)"))
def first_row_delta(spark, d):
    w = Window.partitionBy("anchor").orderBy(F.desc("score"), "part", "line")
    top = F.first("score").over(w)
    return fx.candidates(spark, d).select("anchor", "line", "part", F.round(F.col("score") - top, 4).alias("delta"), F.round(exprs.safe_ratio(F.col("score"), top), 6).alias("ratio"), F.coalesce(F.lead("score").over(w), F.lit(-1.0)).alias("next_best"))


@query(sql(C, body="SELECT anchor, count(DISTINCT part) AS pool, count(DISTINCT part) FILTER (WHERE proba >= 0.5) AS chosen, count(DISTINCT part) - count(DISTINCT part) FILTER (WHERE proba >= 0.5) AS omitted FROM C GROUP BY 1"))
def pool_completeness(spark, d):
    g = fx.candidates(spark, d).groupBy("anchor").agg(F.collect_set("part").alias("all"), F.collect_set(F.when(F.col("proba") >= 0.5, F.col("part"))).alias("some"))
    return g.select("anchor", F.size("all").cast("bigint").alias("pool"), F.size("some").cast("bigint").alias("chosen"), F.size(F.array_except("all", "some")).cast("bigint").alias("omitted"))


@query(sql(C, body="SELECT anchor, line, part, dense_rank() OVER (PARTITION BY anchor ORDER BY mode) AS code, n AS kinds FROM C JOIN (SELECT anchor, count(DISTINCT mode) AS n FROM C GROUP BY 1) USING (anchor)"))
def distinct_over_partition(spark, d):
    w = Window.partitionBy("anchor")
    c = fx.candidates(spark, d).withColumn("code", F.dense_rank().over(w.orderBy("mode")).cast("bigint"))
    return c.withColumn("kinds", F.max("code").over(w)).select("anchor", "line", "part", "code", "kinds")


@query(sql(C, body="SELECT anchor, part, supp FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY label DESC, proba DESC, size DESC, part DESC, supp DESC) AS rn FROM C) WHERE rn = 1"))
def lexicographic_best(spark, d):
    return fx.candidates(spark, d).groupBy("anchor").agg(F.max(F.struct("label", "proba", "size", "part", "supp")).alias("m")).select("anchor", "m.part", "m.supp")


@query(sql(P, body="SELECT clean_fid, CASE WHEN g < 7 THEN 'train' WHEN g < 9 THEN 'val' ELSE 'test' END AS part FROM (SELECT clean_fid, CAST(floor(xmin/50)*31 + floor(ymin/50)*17 AS BIGINT) % 10 AS g FROM P)"))
def spatial_group_split(spark, d):
    return fx.parcels(spark, d).select("clean_fid", selection.split_of_cell(F.col("xmin"), F.col("ymin"), 50.0, 7, 2, 10).alias("part"))


@query("SELECT count(*) FILTER (WHERE p_partkey % 20 = 0) AS held_out, count(*) FILTER (WHERE p_partkey % 20 = 5) AS second, count(*) FILTER (WHERE p_partkey % 20 NOT IN (0, 5)) AS train, CAST(0 AS BIGINT) AS shared FROM part")
def modulo_split_audit(spark, d):
    k = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.pmod("p_partkey", F.lit(20)).alias("m"))
    shared = k.where("m in (0, 5)").select("k").intersect(k.where("m not in (0, 5)").select("k")).agg(F.count("*").alias("shared"))
    n = lambda c: F.sum(c.cast("int"))
    return k.agg(n(F.col("m") == 0).alias("held_out"), n(F.col("m") == 5).alias("second"), n(~F.col("m").isin(0, 5)).alias("train")).crossJoin(F.broadcast(shared))  # one row each


@query("SELECT event_type AS kind, CAST(event_id AS BIGINT) AS id, value, NULL AS area FROM events UNION ALL SELECT 'part', p_partkey, NULL, CAST(p_size AS DOUBLE) FROM part")
def union_heterogeneous(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("kind"), F.col("event_id").cast("bigint").alias("id"), "value")
    return e.unionByName(table(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("area")), allowMissingColumns=True)


@query("SELECT key, min(o_orderkey) AS o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'gml:' || o_custkey WHEN o_orderkey % 3 = 1 THEN 'toid:' || o_orderstatus ELSE 'obj:' || o_orderkey END AS key FROM orders) GROUP BY 1")
def priority_key_dedupe(spark, d):
    k = F.col("o_orderkey")
    key = selection.first_key(("gml", F.when(k % 3 == 0, F.col("o_custkey"))), ("toid", F.when(k % 3 == 1, F.col("o_orderstatus")).otherwise("")), ("obj", k))
    return table(spark, d, "orders").select("o_orderkey", key.alias("key")).groupBy("key").agg(F.min("o_orderkey").alias("o_orderkey"))


@query(sql(C, body="SELECT anchor, count(DISTINCT part) FILTER (WHERE x AND y) AS both, count(DISTINCT part) AS either, count(DISTINCT part) FILTER (WHERE x AND NOT y) AS only_first, round(count(DISTINCT part) FILTER (WHERE x AND y)/count(DISTINCT part), 6) AS jaccard FROM (SELECT anchor, part, bool_or(label = 1) AS x, bool_or(proba >= 0.5) AS y FROM C GROUP BY 1, 2) WHERE x OR y GROUP BY 1"))
def idset_algebra(spark, d):
    g = fx.candidates(spark, d).groupBy("anchor").agg(F.collect_set(F.when(F.col("label") == 1, F.col("part"))).alias("x"), F.collect_set(F.when(F.col("proba") >= 0.5, F.col("part"))).alias("y"))
    n = lambda c: F.size(c).cast("bigint")
    out = g.select("anchor", n(F.array_intersect("x", "y")).alias("both"), n(F.array_union("x", "y")).alias("either"), n(F.array_except("x", "y")).alias("only_first"), F.round(selection.jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))
    return out.where("either > 0")


@query(sql(P, E, body="SELECT DISTINCT CASE WHEN p.area < q.area THEN a ELSE b END AS clean_fid FROM E JOIN P p ON p.clean_fid = a JOIN P q ON q.clean_fid = b WHERE overlap / least(p.area, q.area) >= 0.25"))
def covered_drop(spark, d):
    return selection.covered(_edges(spark, d), 0.25)


@query(sql(C, body="SELECT CAST(b AS INTEGER) AS budget, t AS threshold, count(*) AS rows, sum(label) AS hits, count(DISTINCT anchor) AS anchors FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, part, line) AS rn FROM C), (SELECT unnest([1, 3, 5]) AS b), (SELECT unnest([0.2, 0.5, 0.8]) AS t) WHERE rn <= b AND proba >= t GROUP BY 1, 2"))
def sweep_grid(spark, d):
    grid = F.explode(F.array(*[F.struct(F.lit(b).alias("budget"), F.lit(t).alias("threshold")) for b in (1, 3, 5) for t in (0.2, 0.5, 0.8)]))
    c = fx.candidates(spark, d).withColumn("rn", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "part", "line")))
    return c.where("rn <= 5").withColumn("g", grid).where("rn <= g.budget and proba >= g.threshold").groupBy("g.budget", "g.threshold").agg(F.count("*").alias("rows"), F.sum("label").alias("hits"), F.countDistinct("anchor").alias("anchors"))


@query(sql(C, body="SELECT m AS split, round(tp/(tp+fp), 6) AS precision, round(tp/(tp+fn), 6) AS recall, tp/(tp+fp) >= 0.95 AND tp/(tp+fn) >= 0.95 AS passed FROM (SELECT anchor % 20 AS m, sum(CAST(label=1 AND proba>=0.3 AS BIGINT)) AS tp, sum(CAST(label=0 AND proba>=0.3 AS BIGINT)) AS fp, sum(CAST(label=1 AND proba<0.3 AS BIGINT)) AS fn FROM C GROUP BY 1) WHERE m IN (0, 5)"))
def gate_95(spark, d):
    y, hit = F.col("label") == 1, F.col("proba") >= 0.3
    s = lambda c: F.sum(c.cast("bigint"))
    m = fx.candidates(spark, d).withColumn("split", F.pmod("anchor", F.lit(20))).groupBy("split").agg(s(y & hit).alias("tp"), s(~y & hit).alias("fp"), s(y & ~hit).alias("fn")).where("split in (0, 5)")  # the two held-out splits
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / (F.col("tp") + F.col("fn"))
    return m.select("split", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), ((p >= 0.95) & (r >= 0.95)).alias("passed"))


@query()
def greedy_packing(spark, d):
    """Orders ranked by price claim their parts; the kept orders share no part."""
    rows = fx.candidates(spark, d).groupBy("anchor").agg(F.collect_set("part").alias("resources"), F.max("score").alias("top")).select(F.col("anchor").alias("id"), (-F.col("top")).alias("minus"), "resources")
    return selection.pack(rows, Scratch(spark, "pack"), ["minus"])


@query()
def notch_matching(spark, d):
    pairs = _short(_edges(spark, d)).select((F.col("a") * 1_000_000 + F.col("b")).alias("id"), "a", "b", (-F.col("len")).alias("minus"))
    return selection.match_pairs(pairs, Scratch(spark, "match"), ["minus"]).select((F.floor(F.col("id") / 1_000_000)).alias("a"), (F.col("id") % 1_000_000).alias("b"))


@query("SELECT unnest(['line', 'score', 'size']) AS feature, unnest(['numeric', 'numeric', 'numeric']) AS kind UNION ALL SELECT 'mode', 'categorical'")
def feature_whitelist(spark, d):
    """Columns of the candidates that may be features: no ids, labels or model outputs."""
    c = fx.candidates(spark, d).withColumnsRenamed({"anchor": "anchor_fid", "part": "part_id", "supp": "supp_id"})
    numeric, categorical = exprs.feature_columns(c, ["label", "proba"])
    rows = [(n, "numeric") for n in numeric] + [(n, "categorical") for n in categorical]
    return spark.createDataFrame(rows, "feature string, kind string")


@query(sql(C, body="SELECT label, count(*) AS n FROM C WHERE label = 1 GROUP BY 1"))
def class_aware_sample(spark, d):
    """All positives and no negatives, the two ends of the sampling operator that SQL can say."""
    c = fx.candidates(spark, d).withColumn("k", F.concat_ws("-", "anchor", "line", "part", "supp"))
    return selection.class_sample(c, "label", "k", 1.1, 0.0, 5).groupBy("label").agg(F.count("*").alias("n"))
