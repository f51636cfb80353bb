"""Components, hop distances, bounded enumeration of connected groups and splits on a shared-edge graph.

Edges are rows (a, b, len). Groups are enumerated per anchor; the bounds on depth and size keep the
rows of an anchor bounded, and anchors are spread over tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.operators.selection import numbered
from terrane.session import Scratch

if TYPE_CHECKING:
    import pandas as pd


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "len").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "len"))


#: Edges that one task joins at once; a graph of no more is done in one task.
CHUNK = 500_000
#: Share of its edges that a level of stars may leave; beyond it labels are spread in rounds.
MOST_LEFT = 0.7


def component_labels(edges: DataFrame, vertices: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, component): the smallest vertex linked directly or indirectly. Every task joins the edges of a range of
    vertices into stars round their smallest vertex; vertices that stand in several stars link these, and the links are
    the edges of the next, smaller graph. Where a graph hardly shrinks so, labels are spread in rounds instead."""
    kind = vertices.schema["v"].dataType
    a, b = F.col("a").cast(kind), F.col("b").cast(kind)
    pairs = scratch.put(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b"), "pairs0")
    left, maps = pairs.count(), []
    while left:
        r = len(maps)
        tasks = 1 if left <= CHUNK else max(math.ceil(left / CHUNK), int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        spread = pairs.coalesce(1) if tasks == 1 else pairs.repartitionByRange(tasks, "a")
        stars = scratch.put(spread.mapInPandas(_stars, T.StructType([T.StructField("v", kind), T.StructField("low", kind)])), f"stars{r}")
        held = scratch.put(stars.groupBy("v").agg(F.min("low").alias("low"), F.collect_set("low").alias("lows")), f"held{r}")
        maps.append(held.select("v", "low"))
        links = held.where(F.size("lows") > 1).select(F.col("low").alias("a"), F.explode("lows").alias("b")).where("a < b").distinct()
        pairs, before = scratch.put(links, f"pairs{r + 1}"), left
        left = pairs.count()
        if left > CHUNK and left > MOST_LEFT * before:
            ends = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v")))
            maps.append(_spread_labels(pairs, ends, scratch).withColumnRenamed("component", "low"))
            break
    out = vertices.select("v").distinct().withColumn("component", F.col("v"))
    for m in maps:
        out = out.join(m.select(F.col("v").alias("component"), F.col("low").alias("_low")), "component", "left").select("v", F.coalesce("_low", "component").alias("component"))
    return scratch.put(out, "labels")


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(v, low) of the vertices of edges (a, b), low being the smallest vertex they hang together with here; beyond CHUNK
    vertices it starts anew, which is as good as another task."""
    import pandas as pd

    up: dict = {}

    def root(v):
        while up[v] != v:
            up[v] = v = up[up[v]]
        return v

    def stars() -> pd.DataFrame:
        return pd.DataFrame({"v": list(up), "low": [root(v) for v in up]})

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = root(a), root(b)
            if x < y:
                up[y] = x
            elif y < x:
                up[x] = y
        if len(up) > CHUNK:
            yield stars()
            up.clear()
    if up:
        yield stars()


def _spread_labels(edges: DataFrame, vertices: DataFrame, scratch: Scratch) -> DataFrame:
    """As :func:`component_labels`, for graphs that do not shrink by stars. Labels spread by neighbours and by jumping
    to the label of the label, so long chains take few rounds; every round is a written table."""
    ends = both_ways(edges.withColumn("len", F.lit(0.0)) if "len" not in edges.columns else edges).select("a", "b").distinct()
    ends = scratch.put(ends, "ends")
    labels = scratch.put(vertices.select("v").distinct().withColumn("component", F.col("v")), "labels0")
    for r in range(1, 10_000):
        seen = ends.join(labels.select(F.col("v").alias("b"), "component"), "b").groupBy(F.col("a").alias("v")).agg(F.min("component").alias("low"))
        hop = labels.join(seen, "v", "left").select("v", "component", F.least("component", F.coalesce("low", "component")).alias("low"))
        jump = labels.select(F.col("v").alias("low"), F.col("component").alias("far"))
        nxt = scratch.put(hop.join(jump, "low", "left").select("v", "component", F.least("low", F.coalesce("far", "low")).alias("new")), f"labels{r}")
        changed = not nxt.where("new <> component").isEmpty()
        labels = nxt.select("v", F.col("new").alias("component"))
        if r > 1:
            scratch.drop(f"labels{r - 2}")
        if not changed:
            return labels
    raise RuntimeError("_spread_labels: no end")


def dense_ids(labels: DataFrame) -> DataFrame:
    """Components numbered 0, 1, ... by their smallest vertex."""
    ids = numbered(labels.select("component").distinct(), ["component"], "component_id")
    return labels.join(ids, "component").select("v", "component_id")


def hops(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """(v, depth) of vertices within ``depth`` hops of any source (v); each hop is a written table."""
    scratch = Scratch(edges.sparkSession, "hops")
    ends = scratch.put(both_ways(edges).select("a", "b"), "ends")
    reached = frontier = scratch.put(sources.select("v").distinct().withColumn("depth", F.lit(0)), "hop0")
    for k in range(1, depth + 1):
        step = ends.join(frontier.select(F.col("v").alias("a")), "a").select(F.col("b").alias("v")).distinct()
        frontier = scratch.put(step.join(reached, "v", "left_anti").withColumn("depth", F.lit(k)), f"hop{k}")
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached


def bounded_pool(edges: DataFrame, anchors: DataFrame, depth: int, most: int) -> DataFrame:
    """(anchor, v, depth, len): per anchor the nearest vertices, strongest edges first, at most ``most``."""
    ends = both_ways(edges)
    layer = anchors.select(F.col("v").alias("anchor"), F.col("v"), F.lit(0).alias("depth"), F.lit(0.0).alias("len"))
    out = layer
    w = Window.partitionBy("anchor").orderBy(F.desc("len"), "v")
    for k in range(1, depth + 1):
        step = layer.join(ends.select(F.col("a").alias("v"), F.col("b").alias("to"), F.col("len").alias("l")), "v").groupBy("anchor", F.col("to").alias("v")).agg(F.max("l").alias("len"))
        layer = step.join(out.select("anchor", "v"), ["anchor", "v"], "left_anti").withColumn("depth", F.lit(k)).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).drop("_rn").select("anchor", "v", "depth", "len")
        out = out.unionByName(layer)
    keep = Window.partitionBy("anchor").orderBy("depth", F.desc("len"), "v")
    return out.withColumn("_rn", F.row_number().over(keep)).where(F.col("_rn") <= most + 1).drop("_rn")


def connected_groups(edges: DataFrame, anchors: DataFrame, size: int, beam: int) -> DataFrame:
    """(anchor, ids, shared): connected groups of 1 to ``size`` vertices that hold the anchor, grown one neighbour at a
    time; of each size at most ``beam`` groups per anchor go on, greatest shared length first, then smaller ids."""
    ends = both_ways(edges)
    level = anchors.select(F.col("v").alias("anchor"), F.array("v").alias("ids"), F.lit(0.0).alias("shared"))
    out = level
    for _ in range(1, size):
        grown = level.withColumn("v", F.explode("ids")).join(ends.select(F.col("a").alias("v"), F.col("b").alias("to"), "len"), "v").where(~F.array_contains("ids", F.col("to")))
        nxt = grown.groupBy("anchor", "ids", "shared", "to").agg(F.sum("len").alias("more")).select(
            "anchor", F.array_sort(F.concat("ids", F.array("to"))).alias("ids"), (F.col("shared") + F.col("more")).alias("shared")
        ).distinct()
        w = Window.partitionBy("anchor").orderBy(F.desc("shared"), "ids")
        level = nxt.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= beam).drop("_rn")
        out = out.unionByName(level)
    return out


def combinations(pool: DataFrame, size: int, quota: int) -> DataFrame:
    """(anchor, ids, cost): for each size up to ``size`` the ``quota`` cheapest combinations of the pool
    (anchor, v, cost). The pool of an anchor is bounded before (see :func:`bounded_pool`)."""
    level = pool.select("anchor", F.array("v").alias("ids"), "cost")
    out, w = None, Window.partitionBy("anchor").orderBy("cost", "ids")
    for k in range(1, size + 1):
        best = level.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= quota).drop("_rn")
        out = best if out is None else out.unionByName(best)
        if k < size:
            more = pool.select("anchor", "v", F.col("cost").alias("c"))
            level = level.join(more, "anchor").where(F.col("v") > F.element_at("ids", -1)).select("anchor", F.concat("ids", F.array("v")).alias("ids"), (F.col("cost") + F.col("c")).alias("cost"))
    return out


def subsets(pool: DataFrame, most: int = 10) -> DataFrame:
    """(anchor, ids): every subset of a pool (anchor, v, parent) in which a vertex comes with its parent (null: none).
    Pools of more than ``most`` vertices are not enumerated: they give the singles and a greedy path, which adds the
    cheapest vertex (by ``cost``, where the pool has it, then the smaller v) whose parent is there, up to the whole set."""
    sized = pool.withColumn("_n", F.count("*").over(Window.partitionBy("anchor")))
    items = sized.where(F.col("_n") <= most).groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("v", "parent"))).alias("items"))
    masks = items.withColumn("mask", F.explode(F.sequence(F.lit(1), (F.pow(F.lit(2), F.size("items")) - 1).cast("int"))))
    chosen = F.filter("items", lambda x, i: F.getbit(F.col("mask"), i) == 1)
    ids = F.transform("chosen", lambda x: x["v"])
    ok = F.forall("chosen", lambda x: x["parent"].isNull() | F.array_contains(F.col("ids"), x["parent"]))
    return masks.withColumn("chosen", chosen).withColumn("ids", ids).where(ok).select("anchor", "ids").unionByName(_greedy_paths(sized.where(F.col("_n") > most).drop("_n")))


def _greedy_paths(pool: DataFrame) -> DataFrame:
    """(anchor, ids): singles without parent, and the growing sets of a greedy path in which a vertex follows its parent."""
    cost = F.col("cost").cast("double") if "cost" in pool.columns else F.lit(0.0)

    def path(pdf):
        import heapq

        import pandas as pd

        free, waiting = [], {}
        for v, parent, c in zip(pdf["v"], pdf["parent"], pdf["cost"], strict=True):
            if pd.isna(parent):
                free.append((c, v))
            else:
                waiting.setdefault(int(parent), []).append((c, v))
        out, ids = {(v,) for _, v in free}, []
        heapq.heapify(free)
        while free:
            _, v = heapq.heappop(free)
            ids.append(v)
            out.add(tuple(sorted(ids)))
            for item in waiting.get(v, ()):
                heapq.heappush(free, item)
        return pd.DataFrame({"anchor": pdf["anchor"].iloc[0], "ids": [list(i) for i in sorted(out)]})

    return pool.select("anchor", "v", "parent", cost.alias("cost")).groupBy("anchor").applyInPandas(path, "anchor long, ids array<long>")


def group_connected(groups: DataFrame, edges: DataFrame, key: list[str], ids: str) -> DataFrame:
    """``key`` with ``connected``: whether the ids of a group hang together. Reached from the smallest id hop by hop;
    hops are written tables and end when no group grows."""
    members = groups.select(*key, F.explode(ids).alias("a"))
    inside = members.join(both_ways(edges).select("a", "b"), "a").join(members.withColumnRenamed("a", "b"), [*key, "b"]).select(*key, "a", "b")
    sizes = groups.select(*key, F.size(ids).alias("n"), F.array_min(ids).alias("a"))
    scratch = Scratch(edges.sparkSession, "connected")
    inside, frontier, reached = scratch.put(inside, "inside"), scratch.put(sizes.select(*key, "a"), "hop0"), None
    for k in range(1, 1_000_000):
        reached = frontier if reached is None else reached.unionByName(frontier)
        step = inside.join(frontier, [*key, "a"]).select(*key, F.col("b").alias("a")).distinct()
        frontier = scratch.put(step.join(reached, [*key, "a"], "left_anti"), f"hop{k}")
        if frontier.isEmpty():
            break
    got = reached.groupBy(*key).agg(F.count("*").alias("got"))
    return sizes.join(got, key, "left").select(*key, (F.coalesce("got", F.lit(0)) >= F.col("n")).alias("connected"))


def bridges(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of edges whose removal splits their component, by a low-link search; a task searches many components."""
    vertices = both_ways(edges).select(F.col("a").alias("v"))
    labels = component_labels(edges, vertices, Scratch(scratch.spark, "bridge-components"))
    e = scratch.put(edges.select("a", "b").join(labels.withColumnRenamed("v", "a"), "a"), "component-edges")
    return e.groupBy(bucket(e, "component")).applyInPandas(_bridges_of, "a long, b long")


def bucket(edges: DataFrame, key: str) -> Column:
    """A number by the hash of a key, of so many that a task has work for more than one key."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(max(math.ceil(edges.count() / CHUNK), int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def _bridges_of(pdf):
    """Low-link search over whole components (iterative)."""
    import pandas as pd

    near: dict[int, list[tuple[int, int]]] = {}
    for i, (a, b) in enumerate(zip(pdf["a"], pdf["b"], strict=True)):
        near.setdefault(a, []).append((b, i))
        near.setdefault(b, []).append((a, i))
    seen, low, out, clock = {}, {}, [], 0
    for root in near:
        if root in seen:
            continue
        seen[root] = low[root] = clock
        clock += 1
        stack = [(root, -1, iter(near[root]))]
        while stack:
            v, via, todo = stack[-1]
            for w, i in todo:
                if i == via:
                    continue
                if w in seen:
                    low[v] = min(low[v], seen[w])
                else:
                    seen[w] = low[w] = clock
                    clock += 1
                    stack.append((w, i, iter(near[w])))
                    break
            else:
                stack.pop()
                if stack:
                    u = stack[-1][0]
                    low[u] = min(low[u], low[v])
                    if low[v] > seen[u]:
                        out.append((min(u, v), max(u, v)))
    return pd.DataFrame(out, columns=["a", "b"])


def split_by_reference(edges: DataFrame, owners: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, component): components after edges between different references (v, ref) are dropped; a vertex without
    reference keeps its edges."""
    ra, rb = owners.select(F.col("v").alias("a"), F.col("ref").alias("ra")), owners.select(F.col("v").alias("b"), F.col("ref").alias("rb"))
    kept = edges.join(ra, "a", "left").join(rb, "b", "left").where("ra is null or rb is null or ra = rb").select("a", "b", "len")
    return component_labels(kept, both_ways(edges).select(F.col("a").alias("v")), scratch)


def shape_guard(edges: DataFrame, labels: DataFrame, bad: DataFrame, least: Column) -> DataFrame:
    """Edges without those that are weak (not ``least``) inside a badly shaped component (component)."""
    marked = edges.join(labels.withColumnRenamed("v", "a"), "a").join(bad.withColumn("_bad", F.lit(1)), "component", "left")
    return marked.where(F.col("_bad").isNull() | least).select("a", "b", "len")


def attach_passes(free: DataFrame, edges: DataFrame, owners: DataFrame, passes: int, least: float, scratch: Scratch) -> DataFrame:
    """(v, owner, pass): free vertices join the owner they share most border with, pass by pass; the border with all
    polygons an owner has by then is added up. ``owners`` is (v, owner)."""
    ends = scratch.put(both_ways(edges), "attach-ends")
    held = scratch.put(owners.select("v", "owner").withColumn("pass", F.lit(0)), "attach0")
    for k in range(1, passes + 1):
        open_ = free.select("v").join(held, "v", "left_anti")
        touch = ends.join(open_.withColumnRenamed("v", "a"), "a").join(held.select(F.col("v").alias("b"), "owner"), "b").groupBy("a", "owner").agg(F.sum("len").alias("len")).where(F.col("len") >= least)
        best = touch.groupBy("a").agg(F.max(F.struct("len", (-F.col("owner")).alias("m"))).alias("m")).select(F.col("a").alias("v"), (-F.col("m.m")).alias("owner"), F.lit(k).alias("pass"))
        nxt = scratch.put(held.unionByName(best), f"attach{k}")
        if nxt.count() == held.count():
            return nxt
        held = nxt
    return held
