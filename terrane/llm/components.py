"""Consolidating pairwise matches into groups (connected components).

Method: low-diameter decomposition. On every level each vertex draws an exponentially distributed
shift (rate BETA); clusters start at ``-shift`` and grow one hop a round, every vertex joining the
cluster that reaches it first, until no vertex gets an earlier offer: O(log n / BETA) rounds, of which
only the vertices that changed in the last one make offers. Clusters become the vertices of the next
level, the edges between clusters its edges, and the levels end when no edge is left. The assignments
of all levels are then composed. An edge outlives a level with a chance of at most
1 - exp(-BETA), a third; about a fifth do on paths and on parcel edges (measured by a test).

A level of at most SMALL_EDGES edges (16 bytes each) is decomposed by the same rule within one task, so the
tail of small levels costs one job. The result is the same at every size.

Hot vertices (more than 1/HOT_SHARE of all edge ends, so at most HOT_SHARE exist) are joined by
broadcast; all others by shuffle. Minima are combined before the shuffle.

Defined results
- edges with a null end are dropped; an edge from a vertex to itself makes a group of one;
- repeated edges and both directions count once; no edges give no rows;
- the group id is the smallest vertex of the component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import Scratch

HOT_SHARE = 512
#: Rate of the exponential shifts: a mean of 1/BETA hops.
BETA = 0.4
#: Rows (24 bytes each, under 60 MB as a broadcast) up to which changed vertices and their offers are broadcast.
BROADCAST_ROWS = 500_000
SMALL_EDGES = 200_000
MAX_LEVELS, MAX_ROUNDS = 200, 10_000


def _start(v: Column, level: int) -> Column:
    """Start time of the cluster of a vertex: minus an exponential shift, the same on every executor."""
    uniform = (F.pmod(F.xxhash64(v, F.lit(level)), F.lit(2**52)) + F.lit(1)) / F.lit(float(2**52 + 1))
    return F.log(uniform) / F.lit(BETA)


def _hot(counts: DataFrame, key: str, n: str) -> list[int]:
    """Keys that hold more than 1/HOT_SHARE of the total of ``n``: at most HOT_SHARE of them."""
    size = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total"), F.coalesce(F.max(n), F.lit(0)).alias("most")).first()
    floor = max(1000, size["total"] // HOT_SHARE)
    if size["most"] <= floor:
        return []
    return [r[key] for r in counts.where(F.col(n) > floor).select(key).collect()]


def lookup(big: DataFrame, small: DataFrame, key: str, hot: list[int], how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` on ``key`` (unique in ``small``); rows with a hot key meet their few
    partners by broadcast, so no task holds all rows of a hot key."""
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    cold = big.where(~is_hot).join(small.where(~is_hot), key, how)
    warm = big.where(is_hot).join(F.broadcast(small.where(is_hot)), key, how)
    return cold.unionByName(warm)


def _grow(edges: DataFrame, level: int, scratch: Scratch) -> tuple[DataFrame, list[int]]:
    """((v, center) of every vertex on an edge, each in the cluster that reaches it first, as a written table; hot vertices).

    While many vertices change, a round rewrites all labels; once few do, it only writes the changed ones and meets edges
    and labels by broadcast, so the long tail of rounds shuffles next to nothing."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("w").alias("to")), F.struct(F.col("w").alias("v"), F.col("u").alias("to")))).alias("e")).select("e.v", "e.to")
    # The first round: every vertex offers its own cluster to its neighbours.
    first = ends.groupBy("v").agg(F.min_by("to", _start(F.col("to"), level)).alias("o"), F.count("*").alias("degree"))
    theirs, own = _start(F.col("o"), level) + 1, _start(F.col("v"), level)
    begun = scratch.put(first.select("v", F.when(theirs < own, F.col("o")).otherwise(F.col("v")).alias("center"), F.least(theirs, own).alias("at"), "degree"), f"grow{level}_0")
    hot, labels, deltas = _hot(begun, "v", "degree"), begun.select("v", "center", "at"), []
    frontier, kept = labels.where("center <> v"), [f"grow{level}_0"]
    for r in range(1, MAX_ROUNDS):
        size = frontier.count()
        if not size:
            break
        offers = ends.join(F.broadcast(frontier), "v") if size <= BROADCAST_ROWS else lookup(ends, frontier, "v", hot)
        best = offers.groupBy(F.col("to").alias("v")).agg(F.min(F.struct("at", "center")).alias("m")).select("v", F.col("m.center").alias("c"), (F.col("m.at") + 1).alias("t"))
        if size <= BROADCAST_ROWS:
            best = scratch.put(best, f"best{level}_{r}")
            kept.append(f"best{level}_{r}")
        if size <= BROADCAST_ROWS and best.count() <= BROADCAST_ROWS:
            met = labels.join(F.broadcast(best), "v").where("t < at").select("v", "c", "t")
            for past in deltas:
                met = met.join(past.select("v", F.col("at").alias("then")), "v", "left").where("then is null or t < then").drop("then")
            frontier = scratch.put(met.select("v", F.col("c").alias("center"), F.col("t").alias("at")), f"delta{level}_{r}")
            kept.append(f"delta{level}_{r}")
            deltas.append(frontier)
            if len(deltas) >= 4:
                deltas = [scratch.put(_latest(deltas), f"deltas{level}_{r}")]
                kept.append(f"deltas{level}_{r}")
        else:
            earlier = F.coalesce(F.col("t") < F.col("at"), F.lit(False))
            labels = scratch.put(
                _latest([labels, *deltas]).join(best, "v", "left").select(
                    "v", F.when(earlier, F.col("c")).otherwise(F.col("center")).alias("center"), F.when(earlier, F.col("t")).otherwise(F.col("at")).alias("at"), earlier.alias("changed")
                ),
                f"grow{level}_{r}",
            )
            for name in kept:
                scratch.drop(name)
            frontier, labels, deltas, kept = labels.where("changed").select("v", "center", "at"), labels.select("v", "center", "at"), [], [f"grow{level}_{r}"]
    else:
        raise RuntimeError("components: no end of growth")
    assign = scratch.put(_latest([labels, *deltas]).select("v", "center"), f"assign{level}")
    for name in kept:
        scratch.drop(name)
    return assign, hot


def _latest(tables: list[DataFrame]) -> DataFrame:
    """(v, center, at) with the earliest offer of each vertex."""
    if len(tables) == 1:
        return tables[0]
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return union.groupBy("v").agg(F.min(F.struct("at", "center")).alias("m")).select("v", "m.center", "m.at")


def shifts(n: int, rng: np.random.Generator, beta: float) -> np.ndarray:
    return -rng.exponential(1.0 / beta, n)


def grow_once(n: int, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, int]:
    """(cluster of each vertex, rounds) of the graph with edge ends ``a`` to ``b`` (both ways) and the given start times."""
    center, at, active, rounds = np.arange(n), start.copy(), np.ones(n, dtype=bool), 0
    while active.any():
        rounds += 1
        use = active[a]
        src, dst = a[use], b[use]
        order = np.lexsort((center[src], at[src], dst))
        src, dst = src[order], dst[order]
        lead = np.flatnonzero(np.diff(dst, prepend=-1))
        src, dst = src[lead], dst[lead]
        better = at[src] + 1 < at[dst]
        new_at, new_center = at[src[better]] + 1, center[src[better]]
        active = np.zeros(n, dtype=bool)
        active[dst[better]] = True
        at[dst[better]], center[dst[better]] = new_at, new_center
    return center, rounds


def decompose(u: np.ndarray, w: np.ndarray, beta: float = BETA) -> tuple[np.ndarray, np.ndarray, list[tuple[float, int]]]:
    """(vertices, root of each, (share of edges left, rounds) of each level) of a graph in memory."""
    names, inverse = np.unique(np.concatenate([u, w]), return_inverse=True)
    a, b = inverse[: len(u)], inverse[len(u) :]
    of, rng, told = np.arange(len(names)), np.random.default_rng(13), []
    while len(a):
        live, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = inverse[: len(a)], inverse[len(a) :]
        center, rounds = grow_once(len(live), np.concatenate([x, y]), np.concatenate([y, x]), shifts(len(live), rng, beta))
        to = np.arange(len(names))
        to[live] = live[center]
        of = to[of]
        a, b = to[a], to[b]
        told.append((float((a != b).mean()), rounds))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
        a, b = pairs
    return names, names[of], told


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(v, center) of a small level, decomposed to the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [f for f in batches if len(f)]
        if frames:
            u, w = (np.concatenate([f[c].to_numpy() for f in frames]) for c in ("u", "w"))
            names, roots, _ = decompose(u, w)
            yield pd.DataFrame({"v": names, "center": roots})

    return edges.select("u", "w").coalesce(1).mapInPandas(run, "v long, center long")


def components(spark: SparkSession, pairs: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """(v, group_id) of every vertex on a pair (u, w)."""
    scratch = Scratch(spark, "components")
    all_pairs = scratch.put(
        pairs.where("u is not null and w is not null").select(F.least("u", "w").alias("u"), F.greatest("u", "w").alias("w")).distinct(), "edges0"
    )
    loops = all_pairs.where("u = w").select(F.col("u").alias("v"))
    edges = all_pairs.where("u <> w")
    levels: list[DataFrame] = []
    while size := edges.count():
        level = len(levels)
        if level >= MAX_LEVELS:
            raise RuntimeError("components: no end of levels")
        if size <= small:
            levels.append(scratch.put(_in_one_task(edges), f"assign{level}"))
            break
        assign, hot = _grow(edges, level, scratch)
        levels.append(assign)
        to = assign.select("v", "center")
        half = lookup(edges.withColumnRenamed("u", "v"), to, "v", hot).select(F.col("center").alias("cu"), F.col("w").alias("v"))
        both = lookup(half, to, "v", hot).where("cu <> center")
        nxt = both.select(F.least("cu", "center").alias("u"), F.greatest("cu", "center").alias("w")).distinct()
        edges = scratch.put(nxt, f"edges{level + 1}")
        if level:
            scratch.drop(f"edges{level}")
    if not levels:
        return loops.select("v", F.col("v").alias("group_id")).distinct()

    # Smallest original vertex of every cluster, from the bottom up.
    least = levels[0].groupBy("center").agg(F.min("v").alias("low"), F.count("*").alias("n"))
    lows = [scratch.put(least, "low0")]
    for level, assign in enumerate(levels[1:], 1):
        below = lows[-1].select(F.col("center").alias("v"), "low")
        up = assign.select("v", "center").join(below, "v").groupBy("center").agg(F.min("low").alias("low"), F.count("*").alias("n"))
        lows.append(scratch.put(up, f"low{level}"))
    # From the top down: the group of a cluster is that of its own cluster on the level above.
    groups = lows[-1].select("center", F.col("low").alias("group_id"))
    for level in range(len(levels) - 1, 0, -1):
        hot = _hot(lows[level], "center", "n")
        above = lookup(levels[level].select("v", "center"), groups, "center", hot).select(F.col("v").alias("center"), F.col("group_id").alias("g"))
        below = lows[level - 1].select("center", "low")
        groups = scratch.put(
            below.join(above, "center", "left").select("center", F.coalesce("g", "low").alias("group_id")), f"groups{level}"
        )
    out = lookup(levels[0].select("v", "center"), groups, "center", _hot(lows[0], "center", "n")).select("v", "group_id")
    alone = loops.join(levels[0].select("v"), "v", "left_anti").select("v", F.col("v").alias("group_id"))
    return out.unionByName(alone)
