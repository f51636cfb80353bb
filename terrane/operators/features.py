"""Wide candidate features: one row per (anchor, group of ids), made by one explode, two joins and one grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.exprs import safe_ratio

ROLES = ("building", "land", "road", "gapfill", "other")


def group_features(groups: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Features of groups (gid, anchor, ids) from nodes (v, area, perimeter, role, uprns) and edges (a, b, len).

    Counts and areas by role for all and for added pieces, shared lengths inside, from anchor to added and to the outside,
    neighbours by role, points inside and others' anchors."""
    members = groups.select("gid", "anchor", F.explode("ids").alias("v"))
    m = members.join(nodes, "v")
    added = F.col("v") != F.col("anchor")
    aggs = [F.count("*").alias("n"), F.sum("area").alias("area"), F.sum("perimeter").alias("perimeter_sum"), F.sum("uprns").alias("uprns"), F.avg("area").alias("area_mean"), F.stddev_pop("area").alias("area_std")]
    aggs += [F.sum((added & (F.col("uprns") > 0)).cast("int")).alias("other_anchors")]
    for r in ROLES:
        is_role = F.col("role") == r
        aggs += [F.sum(is_role.cast("int")).alias(f"n_{r}"), F.sum(F.when(is_role, F.col("area")).otherwise(0.0)).alias(f"area_{r}"), F.sum((is_role & added).cast("int")).alias(f"added_{r}"), F.sum(F.when(is_role & added, F.col("area")).otherwise(0.0)).alias(f"added_area_{r}")]
    base = m.groupBy("gid", "anchor").agg(*aggs)
    ends = edges.select("a", "b", "len").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "len"))
    touch = members.join(ends.withColumnRenamed("a", "v"), "v")
    inside = members.select("gid", F.col("v").alias("b"), F.lit(1).alias("in"))
    t = touch.join(inside, ["gid", "b"], "left").join(nodes.select(F.col("v").alias("b"), F.col("role").alias("brole")), "b", "left")
    within = F.col("in").isNotNull()
    taggs = [
        (F.sum(F.when(within, F.col("len")).otherwise(0.0)) / 2).alias("shared_inside"), F.sum(F.when(~within, F.col("len")).otherwise(0.0)).alias("shared_outside"),
        F.sum(F.when(within & (F.col("v") == F.col("anchor")), F.col("len")).otherwise(0.0)).alias("shared_anchor"), F.countDistinct(F.when(~within, F.col("b"))).alias("neighbours"),
    ]
    taggs += [F.countDistinct(F.when(~within & (F.col("brole") == r), F.col("b"))).alias(f"neighbours_{r}") for r in ROLES]
    out = base.join(t.groupBy("gid").agg(*taggs), "gid", "left").na.fill(0)
    outline = F.col("perimeter_sum") - 2 * F.col("shared_inside")
    return (
        out.withColumn("outline", outline).withColumn("share_inside", safe_ratio(F.col("shared_inside"), F.col("perimeter_sum"))).withColumn("enclosure", F.least(F.lit(1.0), safe_ratio(F.col("shared_outside"), F.col("outline"))))
        .withColumn("compactness", safe_ratio(F.lit(12.566370614359172) * F.col("area"), F.col("outline") * F.col("outline"))).withColumn("log_area", F.log1p("area"))
        .withColumns({f"share_{r}": safe_ratio(F.col(f"area_{r}"), F.col("area")) for r in ROLES})
    )


def label_candidates(df: DataFrame, manual: str, reference: str, weak: str) -> DataFrame:
    """``label``, ``label_source`` and ``sample_weight``: a manual label before one by reference before a weak one."""
    source = F.when(F.col(manual).isNotNull(), "manual").when(F.col(reference).isNotNull(), "reference").when(F.col(weak).isNotNull(), "weak")
    weight = F.when(F.col("label_source") == "manual", 3.0).when(F.col("label_source") == "reference", 1.0).when(F.col("label_source") == "weak", 0.3).otherwise(0.0)
    return df.withColumn("label_source", source).withColumn("label", F.coalesce(manual, reference, weak)).withColumn("sample_weight", weight)


def hard_negatives(targets: DataFrame, edges: DataFrame) -> DataFrame:
    """(target, ids, kind): each target set with one id left out, with one neighbour too many, and with one exchanged, and
    every subset with two or more ids left out. Subsets are 2**n: a target of more than 20 ids raises."""
    whole = targets.select("target", "ids")
    omit = whole.withColumn("v", F.explode("ids")).where("size(ids) > 1").select("target", F.array_sort(F.array_remove("ids", F.col("v"))).alias("ids"), F.lit("omit").alias("kind"))
    ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outer = whole.withColumn("a", F.explode("ids")).join(ends, "a").where(~F.array_contains("ids", F.col("b")))
    over = outer.select("target", F.array_sort(F.concat("ids", F.array("b"))).alias("ids"), F.lit("overmerge").alias("kind")).distinct()
    swap = outer.where("size(ids) > 1").select("target", F.array_sort(F.concat(F.array_remove("ids", F.col("a")), F.array("b"))).alias("ids"), F.lit("replace").alias("kind")).distinct()
    bounded = whole.where("size(ids) > 2").withColumn("n", F.when(F.size("ids") <= 20, F.size("ids")).otherwise(F.raise_error(F.lit("hard_negatives: a target of more than 20 ids"))))
    masks = bounded.withColumn("mask", F.explode(F.sequence(F.lit(1), (F.pow(F.lit(2), F.col("n")) - 2).cast("int")))).where(F.bit_count("mask") <= F.col("n") - 2)
    chosen = F.filter("ids", lambda x, i: F.getbit(F.col("mask"), i) == 1)
    subset = masks.select("target", F.array_sort(chosen).alias("ids"), F.lit("subset").alias("kind"))
    return omit.unionByName(over).unionByName(swap).unionByName(subset)


def invariant_violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(rule, rows): how many rows break each rule (a condition that must hold; null breaks it)."""
    pairs = [F.struct(F.lit(n).alias("rule"), F.when(F.coalesce(F.expr(c), F.lit(False)), 0).otherwise(1).alias("broken")) for n, c in rules.items()]
    return df.select(F.explode(F.array(*pairs)).alias("r")).groupBy("r.rule").agg(F.sum("r.broken").alias("rows"))
