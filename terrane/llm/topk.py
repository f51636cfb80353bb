"""Top N items within every group.

Method: a mergeable aggregation that keeps a heap of at most N items per group. It runs before the
shuffle (one bounded heap per group and task) and the heaps are merged after it, so a group of any
size sends at most N items a task. Items compare by score, then further keys, then identifier.

``collect_top_k`` is an internal function of Spark 4.1; a test holds it to a brute force. Beyond
``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` groups in a task (128 by default) Spark sorts
the rest by group before merging; a session that keeps many groups in memory may raise it.

Defined results
- a null or NaN score or a null group takes no place; a null second key counts as the lowest;
- of several rows of one identifier the newest counts (of equally new ones the greatest row);
- fewer than N items give fewer places; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction


def newest_version(df: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """One row per key: that with the greatest ``at``; of equal ones the greatest values."""
    row = F.struct(F.col(at).alias("_at"), *values)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(row).alias("_row")).select(key, *[F.col(f"_row.{v}").alias(v) for v in values])


def top_n(df: DataFrame, group: str, order: list[Column], item: str, n: int) -> DataFrame:
    """(group, place, item): the ``n`` greatest items of each group by ``order`` (all descending), then by the
    smaller ``item``. Rows with a null group or a null first order key are left out."""
    heap = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], (-F.col(item)).alias("minus"))
    kept = df.where(F.col(group).isNotNull() & order[0].isNotNull()).groupBy(group).agg(
        InternalFunction.collect_top_k(heap, n, False).alias("best")
    )
    ranked = kept.select(F.col(group), F.posexplode(F.reverse(F.array_sort("best"))).alias("p", "b"))
    return ranked.select(group, (F.col("p") + 1).cast("int").alias("place"), (-F.col("b.minus")).alias(item))


def usable(score: Column) -> Column:
    """NaN as null, and -0.0 as 0.0, so that scores compare as numbers."""
    return F.when(~F.isnan(score), score + F.lit(0.0))
