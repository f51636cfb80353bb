"""Sorting out rows: seeded samples, splits, set algebra, duplicates and conflict-free selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.session import Scratch


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows chosen by a hash of the key, the same on every run."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def split_of_cell(x: Column, y: Column, cell: float, train: int, val: int, of: int) -> Column:
    """train, val or test by the cell a point lies in: rows of one cell never part."""
    g = F.pmod(F.floor(x / cell) * 31 + F.floor(y / cell) * 17, F.lit(of))
    return F.when(g < train, "train").when(g < train + val, "val").otherwise("test")


def first_key(*parts: tuple[str, Column]) -> Column:
    """The first key that is not empty, with its kind in front."""
    return F.coalesce(*[F.when(F.length(F.coalesce(c.cast("string"), F.lit(""))) > 0, F.concat(F.lit(kind + ":"), c.cast("string"))) for kind, c in parts])


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / F.when(F.size(F.array_union(a, b)) == 0, 1).otherwise(F.size(F.array_union(a, b)))


def covered(pairs: DataFrame, share: float) -> DataFrame:
    """Keys of boxes covered by a larger one to ``share``; of equally large ones the greater key goes."""
    c = F.col
    a_goes = (c("a_area") < c("b_area")) | ((c("a_area") == c("b_area")) & (c("a_clean_fid") > c("b_clean_fid")))
    gone = F.when(a_goes, c("a_clean_fid")).otherwise(c("b_clean_fid"))
    area = F.when(a_goes, c("a_area")).otherwise(c("b_area"))
    return pairs.where(c("overlap") / area >= share).select(gone.alias("clean_fid")).distinct()


def pack(rows: DataFrame, scratch: Scratch, order: list[str], rounds: int = 1000) -> DataFrame:
    """Greedy conflict-free selection as if walked in ``order`` (ascending, unique): a row is kept if none of its
    ``resources`` is taken by a kept row before it. Rows have a unique ``id`` and an array ``resources``.

    Each round keeps the rows that come first on every resource they touch and drops those that touch a taken one;
    the result equals the sequential walk. The rank is a struct, so no global row number is needed."""
    left = scratch.put(rows.select("id", F.struct(*order, "id").alias("rank"), F.array_distinct("resources").alias("resources")), "left0")
    kept: list[DataFrame] = []
    for r in range(rounds):
        if left.isEmpty():
            break
        uses = left.select("id", "rank", F.explode("resources").alias("resource"))
        first = uses.groupBy("resource").agg(F.min("rank").alias("first"))
        marked = uses.join(first, "resource")
        won = scratch.put(
            marked.groupBy("id").agg(F.min((F.col("rank") == F.col("first")).cast("int")).alias("all")).where("all = 1").select("id")
            .unionByName(left.where(F.size("resources") == 0).select("id")),
            f"won{r}",
        )
        kept.append(won)
        taken = uses.join(won, "id", "left_semi").select("resource").distinct()
        blocked = uses.join(taken, "resource", "left_semi").select("id").distinct()
        nxt = scratch.put(left.join(won, "id", "left_anti").join(blocked, "id", "left_anti"), f"left{r + 1}")
        scratch.drop(f"left{r}")
        left = nxt
    else:
        raise RuntimeError("pack: more rounds than allowed")
    if not kept:
        return rows.select("id").limit(0)
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out


def match_pairs(pairs: DataFrame, scratch: Scratch, order: list[str]) -> DataFrame:
    """Greedy matching of pairs (id, a, b): both ends are used once, best pair first."""
    return pack(pairs.withColumn("resources", F.array("a", "b")), scratch, order)


def class_sample(df: DataFrame, label: str, key: str, positives: float, negatives: float, seed: int) -> DataFrame:
    """Each class thinned to a share of its rows by a hash of the key; the same rows on every run."""
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0
    return df.where(F.when(F.col(label) == 1, draw < positives).otherwise(draw < negatives))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name`` = 0, 1, ... in the order of the given columns, which must be unique. Rows are spread by ranges,
    counted per range and numbered within it, so no task sorts them all."""
    parts = Scratch(df.sparkSession, "numbered").put(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "parts")
    counts = parts.groupBy("_p").agg(F.count("*").alias("_n"))  # one row a range
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    at = F.col("_base") + F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return parts.join(F.broadcast(before), "_p").withColumn(name, at.cast("bigint")).drop("_p", "_base")
