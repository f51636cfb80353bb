"""Aggregations, windows and rankings with fixed null and tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_distinct_text(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, sep: str, limit: int) -> DataFrame:
    """First-seen distinct values of each key joined by ``sep``, at most ``limit``. Repeats are dropped before
    they are collected, so the array holds distinct values only."""
    firsts = df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_o"))
    w = Window.partitionBy(*keys).orderBy("_o", value)
    kept = firsts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(value).cast("string").alias("v")))), lambda s: s["v"]), sep)
    return kept.groupBy(*keys).agg(joined.alias(out))


def group_metrics(df: DataFrame, keys: list[str], parity: str, similarity: str, point: str) -> DataFrame:
    """Counts of parity, ratios (an empty group counts as 1) and similarity of each group of points."""
    p = F.lower(F.trim(F.coalesce(F.col(parity), F.lit(""))))
    s = F.coalesce(F.when(~F.isnan(similarity), F.col(similarity)), F.lit(0.0))
    same, opposite = F.sum((p == "same").cast("int")), F.sum((p == "opposite").cast("int"))
    known = F.sum(p.isin("same", "opposite").cast("int"))
    return df.groupBy(*keys).agg(
        F.count("*").alias("point_count"), same.alias("same_count"), opposite.alias("opposite_count"), (F.count("*") - known).alias("blank_parity_count"),
        (same / F.count("*")).alias("same_ratio"), F.when(known > 0, same / known).otherwise(0.0).alias("same_ratio_known"),
        F.avg(s).alias("address_similarity_mean"), F.max(s).alias("address_similarity_max"), F.countDistinct(point).alias("point_fids"),
    )


def role_signature(df: DataFrame, keys: list[str], role: str) -> DataFrame:
    """``role:n`` sorted by role and joined by a pipe."""
    per = df.groupBy(*keys, role).agg(F.count("*").alias("n"))
    text = F.concat_ws(":", F.col(role), F.col("n").cast("string"))
    return per.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(text)), "|").alias("signature"))


def local_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mode of a histogram with an adaptive bin (8 % of the median, 5 at least): median within the fullest bin and its size.
    The smallest of equally full bins counts; only positive finite values."""
    sound = df.where((F.col(value) > 0) & ~F.isnan(value) & (F.abs(value) != float("inf")))
    med = sound.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("_med"))
    binned = sound.join(med, keys).withColumn("_bin", F.bround(F.col(value) / F.greatest(F.lit(5.0), F.col("_med") * 0.08)).cast("bigint"))
    per = binned.groupBy(*keys, "_bin").agg(F.count("*").alias("support"), F.percentile(value, F.lit(0.5)).alias("mode"))
    return per.groupBy(*keys).agg(F.max(F.struct("support", (-F.col("_bin")).alias("b"), "mode")).alias("m")).select(*keys, "m.mode", "m.support")


def average_rank(df: DataFrame, keys: list[str], value: str, out: str, descending: bool = False) -> DataFrame:
    """Rank with ties sharing the mean of their places."""
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    w, ties = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys, value)
    return df.withColumn(out, F.rank().over(w) + (F.count("*").over(ties) - 1) / 2.0)


def relative_to_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``share_of_max`` (0 where the maximum is 0 or null) and ``above_min``."""
    w = Window.partitionBy(*keys)
    top = F.max(value).over(w)
    return df.withColumn("share_of_max", F.coalesce(F.when(top == 0, None).otherwise(F.col(value) / top), F.lit(0.0))).withColumn(
        "above_min", F.col(value) - F.min(value).over(w)
    )


def confusion(df: DataFrame, label: str, proba: str, threshold: float) -> DataFrame:
    """One row of counts and rates at a threshold (score at or above it is positive); a zero denominator gives 0."""
    y, hit = F.col(label) == 1, F.col(proba) >= threshold
    c = df.agg(
        *[F.coalesce(F.sum(x.cast("bigint")), F.lit(0)).alias(n) for n, x in (("tp", y & hit), ("fp", ~y & hit), ("fn", y & ~hit), ("tn", ~y & ~hit))],
        F.avg((F.col(proba) - F.col(label)) ** 2).alias("brier"),
        F.avg(-F.when(y, F.log(F.greatest(F.col(proba), F.lit(1e-15)))).otherwise(F.log(F.greatest(1 - F.col(proba), F.lit(1e-15))))).alias("log_loss"),
    )
    div = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    p, r = div(F.col("tp"), F.col("tp") + F.col("fp")), div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.withColumn("precision", p).withColumn("recall", r).withColumn("f1", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def curve(df: DataFrame, label: str, proba: str) -> DataFrame:
    """(threshold, tp, fp, precision, recall, all_p, tp_here, fp_here) at each distinct score; the last two are the rows of
    that score alone. Scores are counted first, so the ordered
    window runs over distinct scores, in ranges; a global running sum is put together from the sums of the ranges."""
    per = df.groupBy(F.col(proba).alias("threshold")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count("*").alias("n"))
    ranged = per.withColumn("_part", F.floor(F.col("threshold") * 64))
    parts = ranged.groupBy("_part").agg(F.sum("p").alias("pp"), F.sum("n").alias("nn"))
    over = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_part", F.coalesce(F.sum("pp").over(over), F.lit(0)).alias("p0"), F.coalesce(F.sum("nn").over(over), F.lit(0)).alias("n0"))
    total = per.agg(F.sum("p").alias("all_p"))
    w = Window.partitionBy("_part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    run = ranged.join(before, "_part").withColumn("tp", F.col("p0") + F.sum("p").over(w)).withColumn("seen", F.col("n0") + F.sum("n").over(w))
    return run.crossJoin(F.broadcast(total)).select(  # one row
        "threshold", "tp", (F.col("seen") - F.col("tp")).alias("fp"), (F.col("tp") / F.col("seen")).alias("precision"),
        F.when(F.col("all_p") == 0, 0.0).otherwise(F.col("tp") / F.col("all_p")).alias("recall"), "all_p", F.col("p").alias("tp_here"), (F.col("n") - F.col("p")).alias("fp_here"),
    )


def average_precision(points: DataFrame) -> DataFrame:
    """Sum of precision times the step of recall over falling thresholds (positives of one score step together)."""
    step = F.when(F.col("all_p") == 0, 0.0).otherwise(F.col("tp_here") / F.col("all_p"))
    return points.agg(F.sum(F.col("precision") * step).alias("average_precision"))


def roc_auc(df: DataFrame, label: str, proba: str) -> DataFrame:
    """Area under the curve from counts per distinct score, ties counted half. Every point knows the step that leads to it, so
    nothing is ordered beyond the ranges of :func:`curve`."""
    area = F.sum(F.col("fp_here") * (2 * F.col("tp") - F.col("tp_here")) / 2.0)
    return curve(df, label, proba).agg(area.alias("a"), F.max("tp").alias("p"), F.max("fp").alias("n")).select((F.col("a") / F.nullif(F.col("p") * F.col("n"), F.lit(0))).alias("roc_auc"))


def pick_thresholds(points: DataFrame, least_precision: float, least_recall: float) -> DataFrame:
    """Best F1; most recall with enough precision; most precision with enough recall (ties: the higher threshold)."""
    s = F.col("precision") + F.col("recall")
    f1 = F.when(s == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / s)
    return points.withColumn("f1", f1).agg(
        F.max(F.struct(F.round("f1", 12), "threshold"))["threshold"].alias("best_f1"),
        F.max(F.when(F.col("precision") >= least_precision, F.struct("recall", "threshold")))["threshold"].alias("for_precision"),
        F.max(F.when(F.col("recall") >= least_recall, F.struct("precision", "threshold")))["threshold"].alias("for_recall"),
    )


def ranking_metrics(df: DataFrame, keys: list[str], score: str, label: str, tie: list[Column], k: int) -> DataFrame:
    """Groups with a positive: share whose first positive is first, or within k; mean, median and 90th rank of it."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), *tie)
    first = df.withColumn("_rn", F.row_number().over(w)).groupBy(*keys).agg(F.min(F.when(F.col(label) == 1, F.col("_rn"))).alias("rank")).where("rank is not null")
    return first.agg(
        F.count("*").alias("groups"), F.avg((F.col("rank") == 1).cast("int")).alias("top1"), F.avg((F.col("rank") <= k).cast("int")).alias("within_k"),
        F.avg("rank").alias("mean_rank"), F.percentile("rank", F.lit(0.5)).alias("median_rank"), F.percentile("rank", F.lit(0.9)).alias("p90_rank"),
    )


def coverage_audit(selected: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """Keys of the universe that are missing from, or more than once in, the selected rows; and foreign ones."""
    n = selected.groupBy(key).agg(F.count("*").alias("n"))
    joined = universe.select(key).distinct().withColumn("_in", F.lit(1)).join(n, key, "full")
    state = F.when(F.col("_in").isNull(), "foreign").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return joined.select(key, state.alias("state")).where("state is not null")
