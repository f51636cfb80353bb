"""The wide table of candidate groups: pools, enumeration, labels and features of every (anchor, set of pieces) in one plan.

A candidate is (gid, anchor, ids). Its features come from one explode of the ids, one join with the pieces, one with the
edges and two groupings by candidate; shapes come from the union of its pieces, which the size of a group bounds. No task
sees more than its candidates, and anchors are spread over tasks by hash.

Defined results: ids that are no piece are left out; repeated ids count once; a candidate without any edge has zero lengths;
a zero denominator counts as one; null areas, perimeters and counts count as zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.functions.exprs import safe_ratio
from terrane.operators import graph
from terrane.session import Scratch

ROLES = ("building", "land", "road", "gapfill", "other")
#: Names of the shape measures as models know them, and where geo.st_shape has them.
SHAPE = {
    "area": "area", "perimeter": "perimeter", "mrr_ratio": "mrr_ratio", "hull_gap_ratio": "hull_gap", "bbox_fill_ratio": "bbox_fill", "compactness": "compactness", "convexity": "convexity",
    "notch_ratio": "notch", "mrr_aspect": "aspect", "near10_ratio": "near10", "near15_ratio": "near15", "near20_ratio": "near20", "axis_dev_mean": "deviation_mean", "axis_dev_p90": "deviation_p90",
    "regularity_score": "regularity", "part_count": "part_count", "hole_count": "hole_count", "hole_area": "hole_area",
}


def _number(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0.0)))


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def group_table(groups: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts, areas and border lengths of candidates (gid, anchor, ids).

    ``nodes`` is (v, source, area, perimeter, role, uprns, plot, hole_fill, gap_fill), ``edges`` (a, b, len) each once.
    A piece is an added one unless it is the anchor; neighbours are pieces outside that share a border with one inside."""
    n = nodes.select(
        "v", "source", F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise("other").alias("role"), _number("area").alias("area"), _number("perimeter").alias("perimeter"),
        _number("uprns").alias("uprns"), F.coalesce("plot", F.lit(False)).alias("plot"), _number("hole_fill").alias("hole_fill"), _number("gap_fill").alias("gap_fill"),
    )
    members = groups.select("gid", "anchor", F.explode(F.array_distinct("ids")).alias("v"))
    added, held = F.col("v") != F.col("anchor"), F.col("uprns") > 0
    area, c = F.col("area"), F.col
    of_role = lambda r: c("role") == r
    inner = members.join(n, "v").groupBy("gid", "anchor").agg(
        F.count("*").alias("candidate_clean_count"), F.countDistinct("source").alias("candidate_source_count"), _count_if(~added).alias("anchor_clean_count"), _count_if(added).alias("added_clean_count"),
        F.sum("area").alias("area_sum"), F.max("area").alias("area_max"), F.min("area").alias("area_min"), F.sum("perimeter").alias("perimeter_sum"), _sum_if(~added, area).alias("anchor_area"),
        _sum_if(~added, c("perimeter")).alias("anchor_outline"), _sum_if(added, area).alias("added_area_sum"), F.max(F.when(added, area).otherwise(0.0)).alias("added_area_max"),
        F.sum("uprns").alias("uprn_count"), F.sum(F.when(added, 0).otherwise(c("uprns"))).alias("anchor_uprn_count"), F.sum(F.when(added, c("uprns")).otherwise(0)).alias("added_uprn_count"),
        _count_if(added & held).alias("added_uprn_polygon_count"), _sum_if(added & held, area).alias("contains_other_anchor_area"), F.max(F.when(~added, c("role"))).alias("anchor_role"),
        F.sum("hole_fill").alias("is_polygon_hole_fill_count"), F.sum("gap_fill").alias("is_enclosed_gap_fill_count"), F.collect_set("source").alias("sources"),
        *[_count_if(of_role(r)).alias(f"role_{r}_count") for r in ROLES], *[_sum_if(of_role(r), area).alias(f"role_{r}_area") for r in ROLES],
        *[_count_if(of_role(r) & added).alias(f"added_role_{r}_count") for r in ROLES],
    )
    ends = graph.both_ways(edges)
    near = n.select(c("v").alias("b"), c("role").alias("brole"), c("area").alias("barea"), c("uprns").alias("buprns"), c("plot").alias("bplot"))
    touch = members.join(ends.withColumnRenamed("a", "v"), "v").join(members.select("gid", c("v").alias("b"), F.lit(True).alias("in")), ["gid", "b"], "left").join(near, "b")
    inside = F.coalesce("in", F.lit(False))
    # Per neighbour first, so that its area counts once however many pieces it touches.
    per = touch.groupBy("gid", "anchor", "b", "brole", "barea", "buprns", "bplot", inside.alias("inside")).agg(
        F.sum("len").alias("len"), F.max("len").alias("best"), _sum_if((c("v") == c("anchor")) | (c("b") == c("anchor")), c("len")).alias("anchor_len")
    )
    out, free = ~c("inside"), ~c("inside") & (c("buprns") == 0) & c("bplot")
    role = lambda r: free & (c("brole") == r)
    outer = per.groupBy("gid").agg(
        (_sum_if(c("inside"), c("len")) / 2).alias("internal_shared_len"), (_sum_if(c("inside"), c("anchor_len")) / 2).alias("anchor_added_shared_len"), _sum_if(out, c("len")).alias("external_shared_len"),
        _count_if(out).alias("outside_neighbor_count"), _count_if(out & (c("buprns") > 0)).alias("outside_uprn_neighbor_count"), _count_if(out & (c("brole") == "building")).alias("outside_building_neighbor_count"),
        _count_if(free).alias("outside_zero_uprn_plot_neighbor_count"), _sum_if(free, c("len")).alias("outside_zero_uprn_plot_shared_len"), F.max(F.when(free, c("best")).otherwise(0.0)).alias("outside_zero_uprn_plot_best_shared_len"),
        _sum_if(free, c("barea")).alias("outside_zero_uprn_plot_area"), F.max(F.when(free, c("barea")).otherwise(0.0)).alias("outside_zero_uprn_plot_max_area"),
        *[_count_if(role(r)).alias(f"outside_zero_uprn_{r}_neighbor_count") for r in ROLES], *[_sum_if(role(r), c("barea")).alias(f"outside_zero_uprn_{r}_area") for r in ROLES],
        *[_sum_if(role(r), c("len")).alias(f"outside_zero_uprn_{r}_shared_len") for r in ROLES],
    )
    both = inner.join(outer, "gid", "left").na.fill(0, [x for x in outer.columns if x != "gid"])
    mean = lambda total, count: F.when(c(count) == 0, 0.0).otherwise(c(total) / c(count))
    signature = F.array_join(F.filter(F.array(*[F.when(c(f"role_{r}_count") > 0, F.concat(F.lit(f"{r}:"), c(f"role_{r}_count").cast("string"))) for r in sorted(ROLES)]), lambda x: x.isNotNull()), "|")
    return both.withColumns({
        "added_source_count": F.greatest(c("candidate_source_count") - 1, F.lit(0).cast("long")), "added_area_mean": mean("added_area_sum", "added_clean_count"), "added_area_to_anchor": safe_ratio(c("added_area_sum"), c("anchor_area")),
        "largest_part_area_ratio": safe_ratio(c("area_max"), c("area_sum")), "smallest_part_area_ratio": safe_ratio(c("area_min"), c("area_sum")),
        "anchor_added_shared_to_anchor_perimeter": safe_ratio(c("anchor_added_shared_len"), c("anchor_outline")), "shared_to_external_shared": safe_ratio(c("internal_shared_len"), c("external_shared_len")),
        "outside_zero_uprn_plot_mean_area": mean("outside_zero_uprn_plot_area", "outside_zero_uprn_plot_neighbor_count"),
        "outside_zero_uprn_plot_shared_to_internal": safe_ratio(c("outside_zero_uprn_plot_shared_len"), c("internal_shared_len")), "outside_zero_uprn_plot_shared_to_external": safe_ratio(c("outside_zero_uprn_plot_shared_len"), c("external_shared_len")),
        "contains_other_anchor_count": c("added_uprn_polygon_count"), "role_signature": signature,
    })


def with_shapes(table: DataFrame, groups: DataFrame, pieces: DataFrame) -> DataFrame:
    """``table`` of :func:`group_table` with the shapes of the group and of its anchor, and what changes between them.
    ``pieces`` is (v, geom)."""
    geo.register(table.sparkSession)
    shape = geo.st_shape(F.col("geom"))
    own = pieces.select("v", "geom", shape.alias("m"))
    members = groups.select("gid", F.explode(F.array_distinct("ids")).alias("v")).join(own, "v")
    weight = F.greatest(F.col("m.area"), F.lit(1e-6))
    whole = members.groupBy("gid").agg(geo.st_union_all(F.collect_list("geom")).alias("geom"), safe_ratio(F.sum(F.col("m.regularity") * weight), F.sum(weight)).alias("weighted_part_regularity"))
    named = lambda p, m: [F.col(f"{m}.{at}").cast("double").alias(f"{p}_{name}") for name, at in SHAPE.items()]
    group = whole.select("gid", "weighted_part_regularity", shape.alias("m")).select("gid", "weighted_part_regularity", *named("group", "m"))
    anchor = own.select(F.col("v").alias("anchor"), *[c.alias(f"anchor_{n}" if n != "area" else "anchor_shape_area") for c, n in zip(named("anchor", "m"), SHAPE, strict=True)])
    t, c = table.join(group, "gid").join(anchor, "anchor"), F.col
    change = lambda name, sign=1.0: (c(f"group_{name}") - c(f"anchor_{name}")) * sign
    return t.withColumns({
        "candidate_area": c("group_area"), "candidate_area_to_anchor": safe_ratio(c("group_area"), c("anchor_shape_area")),
        "boundary_simplification": safe_ratio(c("perimeter_sum") - c("group_perimeter"), c("perimeter_sum")), "internal_shared_to_sqrt_area": safe_ratio(c("internal_shared_len"), F.sqrt(F.greatest(c("group_area"), F.lit(0.0)))),
        "outside_zero_uprn_plot_area_to_candidate": safe_ratio(c("outside_zero_uprn_plot_area"), c("group_area")), "outside_zero_uprn_plot_shared_to_perimeter": safe_ratio(c("outside_zero_uprn_plot_shared_len"), c("group_perimeter")),
        "contains_other_anchor_area_fraction": safe_ratio(c("contains_other_anchor_area"), c("group_area")), "regularity_gain_vs_anchor": change("regularity_score"), "hull_gap_reduction_vs_anchor": change("hull_gap_ratio", -1.0),
        "mrr_gain_vs_anchor": change("mrr_ratio"), "compactness_gain_vs_anchor": change("compactness"), "regularity_gain_vs_parts": c("group_regularity_score") - c("weighted_part_regularity"),
        **{f"role_{r}_area_fraction": safe_ratio(c(f"role_{r}_area"), c("group_area")) for r in ROLES}, **{f"outside_zero_uprn_{r}_area_fraction": safe_ratio(c(f"outside_zero_uprn_{r}_area"), c("group_area")) for r in ROLES},
    })


def with_targets(table: DataFrame, targets: DataFrame) -> DataFrame:
    """``table`` with its anchor's target (anchor, target_sources): common sources, their share of all, and the label, which is
    1 where the sources are the same sets. Candidates of anchors without a target get a null label."""
    t = table.join(targets.select("anchor", F.array_distinct("target_sources").alias("target_sources")), "anchor", "left")
    same = F.size(F.array_intersect("sources", "target_sources"))
    union = F.size(F.array_union("sources", "target_sources"))
    known = F.col("target_sources").isNotNull()
    return t.withColumns({
        "source_target_overlap_count": F.when(known, same).otherwise(0), "source_target_jaccard": F.when(known, same / F.greatest(union, F.lit(1))).otherwise(0.0),
        "label": F.when(known, ((same == union) & (union > 0)).cast("int")),
    })


def candidate_dataset(nodes: DataFrame, edges: DataFrame, anchors: DataFrame, targets: DataFrame, size: int, beam: int, shapes: bool = True) -> DataFrame:
    """The dataset of all anchors (v): connected groups of up to ``size`` pieces round each of them, and the target itself
    where its pieces are known; each (anchor, ids) once, with label and features.

    ``nodes`` as in :func:`group_table`, with geom if ``shapes``; ``targets`` is (anchor, target_sources)."""
    scratch = Scratch(nodes.sparkSession, "candidates")
    nodes, edges = scratch.put(nodes, "nodes"), scratch.put(edges.where("len > 0").select("a", "b", "len"), "edges")
    found = graph.connected_groups(edges, anchors, size, beam).select("anchor", "ids")
    wanted = targets.select("anchor", F.explode("target_sources").alias("source")).join(nodes.select("source", "v"), "source").groupBy("anchor").agg(F.array_sort(F.collect_set("v")).alias("ids"))
    wanted = wanted.join(anchors.select(F.col("v").alias("anchor")), "anchor", "left_semi").where(F.array_contains("ids", F.col("anchor")))
    groups = found.unionByName(wanted).distinct().withColumn("gid", F.concat_ws(":", F.col("anchor").cast("string"), F.array_join("ids", "|")))
    groups = scratch.put(groups, "groups")
    table = group_table(groups, nodes, edges)
    if shapes:
        table = with_shapes(table, groups, nodes.select("v", "geom"))
    return with_targets(table, targets)


def deltas(before: DataFrame, after: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """(key, before_..., after_..., delta_..., ratio_...) of the same measures of two states: what completing a parcel adds,
    pruning one takes away, or assembling fragments gives. Keys of one state alone count as zero in the other."""
    a = before.select(key, *[F.col(m).alias(f"before_{m}") for m in measures])
    b = after.select(key, *[F.col(m).alias(f"after_{m}") for m in measures])
    t = a.join(b, key, "full").na.fill(0.0, [f"{s}_{m}" for s in ("before", "after") for m in measures])
    return t.select("*", *[(F.col(f"after_{m}") - F.col(f"before_{m}")).alias(f"delta_{m}") for m in measures], *[safe_ratio(F.col(f"after_{m}"), F.col(f"before_{m}")).alias(f"ratio_{m}") for m in measures])


def completions(groups: DataFrame, edges: DataFrame, ids: str = "ids") -> DataFrame:
    """(gid, v, ids): each group with each neighbour it shares a border with added; the candidates of completion."""
    inside = groups.select("gid", F.explode(ids).alias("a"))
    near = inside.join(graph.both_ways(edges.where("len > 0")), "a").select("gid", F.col("b").alias("v")).distinct()
    return groups.select("gid", F.col(ids).alias("ids")).join(near, "gid").where(~F.array_contains("ids", F.col("v"))).select("gid", "v", F.array_sort(F.concat("ids", F.array("v"))).alias("ids"))


def prunings(groups: DataFrame, ids: str = "ids") -> DataFrame:
    """(gid, v, ids): each group of two or more pieces with one of them taken out; the candidates of pruning."""
    return groups.where(F.size(ids) > 1).select("gid", F.explode(ids).alias("v"), F.col(ids).alias("all")).select("gid", "v", F.array_sort(F.array_remove("all", F.col("v"))).alias("ids"))
