"""Putting parcels together: write-backs, replacements, gap assignment, target sets, patches and refinement.

Steps that depend on the choices before them run in rounds over written tables, or as a plain function
inside one group whose size is bounded by the enumeration before it."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.exprs import exclude_reason, ratio_or_zero, safe_ratio
from terrane.operators.graph import bucket
from terrane.operators.joins import first_by
from terrane.session import Scratch


def restamp_edges(edges: DataFrame, owners: DataFrame) -> DataFrame:
    """Edges (a, b, ...) whose two ends are now in one component (v, component), with that component."""
    a, b = owners.select(F.col("v").alias("a"), F.col("component").alias("_ca")), owners.select(F.col("v").alias("b"), F.col("component").alias("_cb"))
    return edges.drop("component").join(a, "a").join(b, "b").where("_ca = _cb").withColumn("component", F.col("_ca")).drop("_ca", "_cb")


def write_back(owners: DataFrame, merges: DataFrame, areas: DataFrame) -> DataFrame:
    """(v, component, moved): members of a merge (merge_id, component) take the component with the greatest area
    (ties: the smaller id); all others keep theirs."""
    best = merges.join(areas, "component").groupBy("merge_id").agg(F.max(F.struct("area", (-F.col("component")).alias("m"))).alias("b"))
    to = merges.join(best.select("merge_id", (-F.col("b.m")).alias("winner")), "merge_id").groupBy("component").agg(F.min("winner").alias("winner"))
    return owners.join(to, "component", "left").select("v", F.coalesce("winner", "component").alias("new"), "component").select(
        "v", F.col("new").alias("component"), (F.col("new") != F.col("component")).cast("int").alias("moved")
    )


def id_index(rows: DataFrame, source: str, clean: str) -> DataFrame:
    """(source, clean ids): one source may own several clean parts."""
    return rows.groupBy(source).agg(F.array_sort(F.collect_set(clean)).alias("ids"))


def translate_sets(sets: DataFrame, index: DataFrame, source: str) -> DataFrame:
    """(gid, ids, missing): source id sets (gid, ids) as clean ids; ``missing`` counts sources without any."""
    parts = sets.select("gid", F.explode("ids").alias(source)).join(index.withColumnRenamed("ids", "_to"), source, "left")
    return parts.groupBy("gid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_to")))).alias("ids"), F.sum(F.col("_to").isNull().cast("int")).alias("missing"))


def three_key_ranking(df: DataFrame, key: str, score: str, fast: str, rank: str, keep: int) -> DataFrame:
    """The ``keep`` best rows of each key by score, then the quick score, then the order of enumeration."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(score), F.desc_nulls_last(fast), F.asc_nulls_last(rank))
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)


def union_in_order(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, each key once; those of the first go before."""
    both = first.withColumn("_o", F.lit(0)).unionByName(second.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    return first_by(both, keys, [F.asc("_o")]).drop("_o")


def replacements(selected: DataFrame, proposals: DataFrame, least: float) -> DataFrame:
    """Selected rows (anchor, cid, score), each exchanged for the best proposal (anchor, cid, score, gain) with enough gain."""
    best = first_by(proposals.where(F.col("gain") >= least), ["anchor"], [F.desc("gain"), F.desc("score"), F.asc("cid")])
    better = best.select("anchor", F.col("cid").alias("_cid"), F.col("score").alias("_score"))
    return selected.join(better, "anchor", "left").select("anchor", F.coalesce("_cid", "cid").alias("cid"), F.coalesce("_score", "score").alias("score"), F.col("_cid").isNotNull().cast("int").alias("replaced"))


def assign_gaps(gaps: DataFrame, touching: DataFrame, scratch: Scratch) -> DataFrame:
    """(gap, clean_fid, round): gaps (gap, area) go to the neighbour they share most border with, smallest first.

    ``touching`` is (gap, clean_fid, len) and (gap, other_gap, len) rows: a gap given away adds its border with other
    gaps to its new owner. Each round settles every gap with a border to an owner that is the smallest of its kind among
    the gaps it touches; the rounds end when no such gap is left, so only gaps that no owner can reach stay open."""
    border = scratch.put(touching.where("clean_fid is not null").select("gap", "clean_fid", "len"), "border0")
    between = scratch.put(touching.where("other_gap is not null").select("gap", "other_gap", "len"), "between")
    open_ = scratch.put(gaps.select("gap", "area"), "open0")
    result = scratch.put(gaps.select("gap", F.lit(None).cast("bigint").alias("clean_fid"), F.lit(0).alias("round")).limit(0), "given0")
    for r in itertools.count(1):
        ready = open_.join(border, "gap", "left_semi")
        if ready.isEmpty():
            return result
        rank = F.struct("area", "gap")
        near = between.join(ready.select(F.col("gap").alias("other_gap"), rank.alias("theirs")), "other_gap").groupBy("gap").agg(F.min("theirs").alias("theirs"))
        due = ready.withColumn("mine", rank).join(near, "gap", "left").where(F.col("theirs").isNull() | (F.col("mine") < F.col("theirs"))).select("gap")
        given = border.join(due, "gap").groupBy("gap", "clean_fid").agg(F.sum("len").alias("len")).groupBy("gap").agg(F.max(F.struct("len", (-F.col("clean_fid")).alias("m"))).alias("b"))
        won = scratch.put(given.select("gap", (-F.col("b.m")).alias("clean_fid"), F.lit(r).alias("round")), f"won{r}")
        if won.isEmpty():
            raise RuntimeError("assign_gaps: no progress")
        result = scratch.put(result.unionByName(won), f"given{r}")
        open_ = scratch.put(open_.join(won, "gap", "left_anti"), f"open{r}")
        grown = between.join(won.select(F.col("gap").alias("other_gap"), "clean_fid"), "other_gap").select("gap", "clean_fid", "len")
        border = scratch.put(border.unionByName(grown).join(open_, "gap", "left_semi"), f"border{r}")
        for name in (f"given{r - 1}", f"open{r - 1}", f"border{r - 1}", f"won{r}"):
            scratch.drop(name)


def fill_allowed(holes: DataFrame, occupied: DataFrame, points: DataFrame) -> DataFrame:
    """Holes (hole, parent) that hold neither a point (hole) nor another polygon (hole)."""
    return holes.join(occupied.select("hole"), "hole", "left_anti").join(points.select("hole"), "hole", "left_anti")


def two_way_targets(pairs: DataFrame, anchors: DataFrame, least: float) -> DataFrame:
    """(council_fid, ids, anchor): pieces covered to ``least`` by a council parcel, where the pieces cover it to ``least``
    too and exactly one of them is an anchor. ``pairs`` is (council_fid, v, shared, area, council_area)."""
    inside = pairs.where(safe_ratio(F.col("shared"), F.col("area")) >= least)
    marked = inside.join(anchors.select("v").withColumn("_a", F.lit(1)), "v", "left")
    g = marked.groupBy("council_fid").agg(
        F.array_sort(F.collect_set("v")).alias("ids"), F.sum("shared").alias("shared"), F.max("council_area").alias("council_area"),
        F.sum(F.coalesce("_a", F.lit(0))).alias("anchors"), F.min(F.when(F.col("_a") == 1, F.col("v"))).alias("anchor"),
    )
    return g.where((F.col("anchors") == 1) & (safe_ratio(F.col("shared"), F.col("council_area")) >= least)).select("council_fid", "ids", "anchor")


def patch_candidates(pairs: DataFrame, inside: float, cover: float, most_area: float) -> DataFrame:
    """One row per council parcel with two or more inner pieces: coverage figures and a decision with its reason.

    ``pairs`` is (council_fid, v, shared, area, council_area, uprns)."""
    kept = pairs.where(safe_ratio(F.col("shared"), F.col("area")) >= inside)
    g = kept.groupBy("council_fid").agg(
        F.count("*").alias("parts"), F.sum("shared").alias("shared"), F.sum("area").alias("area"), F.max("area").alias("largest"), F.max("council_area").alias("council_area"),
        F.sum((F.col("uprns") > 0).cast("int")).alias("with_points"),
    ).where("parts >= 2")
    c = g.withColumn("coverage", ratio_or_zero(F.col("shared"), F.col("council_area"))).withColumn("largest_share", ratio_or_zero(F.col("largest"), F.col("area")))
    rules = [("too_large", F.col("council_area") > most_area), ("low_coverage", F.col("coverage") < cover), ("several_with_points", F.col("with_points") > 1)]
    return c.withColumn("reason", F.coalesce(exclude_reason(rules), F.lit("complete"))).withColumn(
        "decision", F.when(F.col("reason") == "complete", "merge").when(F.col("reason") == "several_with_points", "review").otherwise("keep")
    )


def greedy_union(pieces: DataFrame) -> DataFrame:
    """(council_fid, ids, iou): pieces (council_fid, v, shared, area, council_area; not overlapping) are added, greatest
    shared area first, while the ratio of common to joint area does not fall.

    Adding a piece keeps the ratio exactly if shared / (area - shared) is at least the ratio so far, so the prefix sums
    of one ordered window give every ratio, and the answer is the longest rising prefix."""
    w = Window.partitionBy("council_fid").orderBy(F.desc("shared"), "v").rowsBetween(Window.unboundedPreceding, 0)
    run = pieces.withColumn("_s", F.sum("shared").over(w)).withColumn("_a", F.sum("area").over(w)).withColumn("iou", safe_ratio(F.col("_s"), F.col("council_area") + F.col("_a") - F.col("_s")))
    step = Window.partitionBy("council_fid").orderBy(F.desc("shared"), "v")
    falls = run.withColumn("_fall", (F.col("iou") < F.coalesce(F.lag("iou").over(step), F.lit(-1.0))).cast("int"))
    kept = falls.withColumn("_stop", F.max("_fall").over(w)).where("_stop = 0")
    return kept.groupBy("council_fid").agg(F.array_sort(F.collect_list("v")).alias("ids"), F.max("iou").alias("iou"))


def greedy_boxes(pieces: DataFrame) -> DataFrame:
    """(council_fid, ids, iou): boxes are added, greatest shared area first (then the smaller box, then the smaller id),
    each kept if the ratio of common to joint area does not fall; one that would lower it is passed over. Boxes may
    overlap: each counts with the part that those kept before do not cover.

    ``pieces`` is (council_fid, v, shared, area, council_area), the box of the piece and, with prefix c, that of the council."""

    def minus(boxes: list[tuple], cut: tuple) -> list[tuple]:
        out = []
        for x0, y0, x1, y1 in boxes:
            u0, v0, u1, v1 = max(x0, cut[0]), max(y0, cut[1]), min(x1, cut[2]), min(y1, cut[3])
            if u0 >= u1 or v0 >= v1:
                out.append((x0, y0, x1, y1))
                continue
            out += [b for b in ((x0, y0, u0, y1), (u1, y0, x1, y1), (u0, y0, u1, v0), (u0, v1, u1, y1)) if b[0] < b[2] and b[1] < b[3]]
        return out

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["shared", "area", "v"], ascending=[False, True, True])
        first = pdf.iloc[0]
        council, whole = (first["cxmin"], first["cymin"], first["cxmax"], first["cymax"]), first["council_area"]
        kept, ids, area, shared, iou = [], [], 0.0, 0.0, 0.0
        for v, *box in pdf[["v", "xmin", "ymin", "xmax", "ymax"]].itertuples(index=False):
            fresh = [tuple(box)]
            for k in kept:
                if k[0] < box[2] and box[0] < k[2] and k[1] < box[3] and box[1] < k[3]:
                    fresh = minus(fresh, k)
            more = sum((b[2] - b[0]) * (b[3] - b[1]) for b in fresh)
            inside = sum(max(0.0, min(b[2], council[2]) - max(b[0], council[0])) * max(0.0, min(b[3], council[3]) - max(b[1], council[1])) for b in fresh)
            joint = whole + area + more - shared - inside
            trial = (shared + inside) / joint if joint > 0 else 0.0
            if trial >= iou:
                kept.append(tuple(box))
                ids.append(v)
                area, shared, iou = area + more, shared + inside, trial
        return pd.DataFrame({"council_fid": [key[0]], "ids": [sorted(ids)], "iou": [float(iou)]})

    return pieces.groupBy("council_fid").applyInPandas(grow, "council_fid long, ids array<long>, iou double")


def best_split(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(component, v, part): components of any size with several seeds are cut into one part per seed.

    ``members`` is (component, v, seed); every other member joins the part it shares most border with, strongest border
    first (then the smaller v, then the smaller part). ``edges`` is (component, a, b, len). A worker cuts many components,
    each whole, with a heap, so the time grows with their edges and not with their square."""

    def split(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"component": [], "v": [], "part": []}, dtype="int64")
        of = dict(zip(left["v"], left["component"], strict=True))
        part = {v: v for v, s in zip(left["v"], left["seed"], strict=True) if s}
        near: dict[int, list[tuple[int, float]]] = {}
        for a, b, n in zip(right["a"], right["b"], right["len"], strict=True):
            near.setdefault(a, []).append((b, n))
            near.setdefault(b, []).append((a, n))
        todo = set(left["v"]) - set(part)
        gain: dict[tuple[int, int], float] = {}
        heap: list[tuple[float, int, int]] = []

        def spread(w: int) -> None:
            for v, n in near.get(w, ()):
                if v in todo:
                    gain[v, part[w]] = g = gain.get((v, part[w]), 0.0) + n
                    heapq.heappush(heap, (-g, v, part[w]))

        for w in list(part):
            spread(w)
        while heap:
            g, v, p = heapq.heappop(heap)
            if v in todo and -g == gain[v, p]:
                part[v] = p
                todo.discard(v)
                spread(v)
        least: dict[int, int] = {}
        for p in part.values():
            least[of[p]] = min(p, least.get(of[p], p))
        part.update((v, least[of[v]]) for v in todo)
        return pd.DataFrame({"component": [of[v] for v in part], "v": list(part), "part": list(part.values())})

    several = members.where("seed").groupBy("component").agg(F.countDistinct("v").alias("_n")).where("_n > 1").select("component")
    alone = members.join(several, "component", "left_anti").withColumn("part", F.min("v").over(Window.partitionBy("component"))).select("component", "v", "part")
    members, edges = members.join(several, "component", "left_semi"), edges.join(several, "component", "left_semi")
    at = bucket(edges, "component")
    return alone.unionByName(members.groupBy(at).cogroup(edges.groupBy(at)).applyInPandas(split, "component long, v long, part long"))


def refine(seeds: DataFrame, pool: DataFrame, score: str = "gain") -> DataFrame:
    """(anchor, ids, total): hill climbing per anchor from its seed set (anchor, ids) over a bounded pool
    (anchor, v, gain, needs): the best single addition or removal is made while the total rises. ``needs`` names the
    piece that must be there before (null: none). It ends, for the total rises with every move and sets are finite."""

    def climb(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                gain = {p["v"]: p["gain"] for p in r.pool}
                needs = {p["v"]: p["needs"] for p in r.pool}
                now = set(r.ids)
                while True:
                    moves = [(gain[v], v, True) for v in gain if v not in now and (needs[v] is None or needs[v] in now)]
                    moves += [(-gain[v], v, False) for v in now if v in gain and v != r.anchor and not any(needs[w] == v for w in now if w in needs)]
                    best = max(moves, key=lambda m: (m[0], -m[1]), default=(0.0, 0, True))
                    if best[0] <= 1e-12:
                        break
                    now = now | {best[1]} if best[2] else now - {best[1]}
                out.append((r.anchor, sorted(now), float(sum(gain.get(v, 0.0) for v in now))))
            yield pd.DataFrame(out, columns=["anchor", "ids", "total"])

    pools = pool.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("v", F.col(score).alias("gain"), "needs"))).alias("pool"))
    return seeds.join(pools, "anchor").select("anchor", "ids", "pool").mapInPandas(climb, "anchor long, ids array<long>, total double")


def top_up(measure, fetch, least: float, rounds: int) -> list[int]:
    """Download rounds: ``measure()`` gives the boxes still missing (a DataFrame) and ``fetch(boxes)`` the number of new
    features; it ends when all is covered, nothing new comes, or the same boxes come again."""
    gains, before = [], None
    for _ in range(rounds):
        boxes = measure(least)
        mark = boxes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*boxes.columns).cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        gains.append(fetch(boxes))
        if gains[-1] == 0:
            break
    return gains


def repair_lines(merges: DataFrame, centres: DataFrame) -> DataFrame:
    """Lines from the inner point of the anchor to those of the merged pieces: (merge_id, v, ax, ay, bx, by)."""
    a = centres.select(F.col("v").alias("anchor"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = centres.select("v", F.col("x").alias("bx"), F.col("y").alias("by"))
    return merges.join(a, "anchor").join(b, "v").where("anchor <> v").select("merge_id", "v", "ax", "ay", "bx", "by")


def best_per_key(df: DataFrame, keys: list[str], proba: str, tie: Column) -> DataFrame:
    """Candidate rows with numbers made safe, each key once by its best probability."""
    clean = df.withColumn(proba, F.when(~F.isnan(proba), F.col(proba)))
    return first_by(clean, keys, [F.desc_nulls_last(proba), tie])
