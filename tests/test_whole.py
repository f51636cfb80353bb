"""Queries over whole tables against brute force on the smallest tables (whole coordinates, so areas are counts of cells)."""

import duckdb
import pytest

from terrane.plans import catalogue

DIR = "/root/testdata/sf0.001"


def run(spark, name):
    return [r.asDict() for r in catalogue.QUERIES[name](spark, DIR).collect()]


def cells(box):
    x0, y0, x1, y1 = map(int, box)
    return {(x, y) for x in range(x0, x1) for y in range(y0, y1)}


@pytest.fixture(scope="module")
def parcels():
    rows = duckdb.sql(f"select p_partkey, p_size from '{DIR}/part.parquet'").fetchall()
    return {k: (x := k % 40 * 10, y := k // 40 * 10, x + 8 + s % 5, y + 8 + k * 7 % 5) for k, s in rows}


@pytest.fixture(scope="module")
def councils():
    rows = duckdb.sql(f"select n_nationkey from '{DIR}/nation.parquet'").fetchall()
    return {n: (n % 5 * 80, n // 5 * 100, n % 5 * 80 + 80, n // 5 * 100 + 100) for (n,) in rows}


def touching(p):
    return [(a, b) for a in p for b in p if a != b and p[a][0] <= p[b][2] and p[b][0] <= p[a][2] and p[a][1] <= p[b][3] and p[b][1] <= p[a][3]]


def test_pair_measures_of_all_pairs(spark, parcels):
    got = {(r["a"], r["b"]): r["overlap"] for r in run(spark, "geometry_pair_measures_all")}
    assert got == {(a, b): len(cells(parcels[a]) & cells(parcels[b])) for a, b in touching(parcels) if a < b}


def test_coverage_by_all_parcels(spark, parcels, councils):
    union = set().union(*map(cells, parcels.values()))
    got = {r["council_fid"]: (r["covered"], r["missing"]) for r in run(spark, "coverage_ratio_missing_all")}
    assert got == {n: (c := len(cells(b) & union), 8000 - c) for n, b in councils.items()}


def test_merge_of_all_members(spark, parcels):
    want = {}
    for k in sorted(parcels):
        want.setdefault(k - k % 3, []).append(k)
    got = {r["target"]: (r["area"], r["members"]) for r in run(spark, "group_merge_all")}
    assert got == {t: (len(set().union(*(cells(parcels[k]) for k in m))), "|".join(map(str, m))) for t, m in want.items()}


def test_slivers_of_all_neighbours(spark, parcels):
    got = {(r["a"], r["b"]): r["area"] for r in run(spark, "neighbour_slivers_all")}
    inner = lambda a, b, e: max(0, min(a[2] + e, b[2]) - max(a[0] - e, b[0])) * max(0, min(a[3] + e, b[3]) - max(a[1] - e, b[1]))
    for a, b in touching(parcels):
        p, q = parcels[a], parcels[b]
        ix, iy = min(p[2], q[2]) - max(p[0], q[0]), min(p[3], q[3]) - max(p[1], q[1])
        border = ((p[2] == q[0] or q[2] == p[0]) and iy > 0) or ((p[3] == q[1] or q[3] == p[1]) and ix > 0) or (ix > 0 and iy > 0 and any(p[i] == q[i] for i in range(4)))
        assert ((a, b) in got) == border
        if border:  # the buffer is the box grown by 0.5 less at most the four rounded corners
            most = len(cells(p)) + inner(p, q, 0.5) - inner(p, q, 0)
            assert most - 0.25 <= got[a, b] <= most + 1e-6


def test_greedy_iou_of_all_parcels(spark, parcels, councils):
    want = {}
    for n, b in councils.items():
        c = cells(b)
        near = {k: cells(q) for k, q in parcels.items() if cells(q) & c}
        kept, union, iou = [], set(), 0.0
        for k in sorted(near, key=lambda k: (-len(near[k] & c), len(near[k]), k)):
            u = union | near[k]
            if (t := len(u & c) / len(u | c)) >= iou:
                kept, union, iou = [*kept, k], u, t
        if near:
            want[n] = ("|".join(map(str, sorted(kept))), len(kept), round(iou, 6))
    assert {r["council_fid"]: (r["ids"], r["parts"], r["iou"]) for r in run(spark, "greedy_iou_all")} == want


def test_containment_classes_of_all_anchors(spark):
    sets = {}
    for a, p in duckdb.sql(f"select l_orderkey, l_partkey from '{DIR}/lineitem.parquet'").fetchall():
        sets.setdefault(a, set()).add(p)
    odd, want = [a for a in sets if a % 2], {}
    for a in sets:
        if a % 2 == 0:
            k, _, m = max((len(sets[a] & sets[b]), len(sets[a] & sets[b]) / len(sets[a] | sets[b]), -b) for b in odd)
            whole, other = k == len(sets[a]), k == len(sets[-m])
            want[a] = (-m, "exact" if whole and other else "partial" if whole else "overmerge" if other else "mismatch") if k else (None, "none")
    assert {r["left_id"]: (r["right_id"], r["cls"]) for r in run(spark, "set_containment_all")} == want


def test_exactly_one_anchor_of_any_number_of_points(spark, parcels):
    points = [((c * 37) % 400 + 0.5, (c * 53) % 500 + 0.5) for (c,) in duckdb.sql(f"select c_custkey from '{DIR}/customer.parquet'").fetchall()]
    held = {k: b for k, b in parcels.items() if any(b[0] <= x <= b[2] and b[1] <= y <= b[3] for x, y in points)}
    want = {}
    for (s,) in duckdb.sql(f"select s_suppkey from '{DIR}/supplier.parquet'").fetchall():
        x, y, side = s * 7 % 40 * 10, s * 3 % 50 * 10, 12 + s % 3 * 10
        inside = [k for k, b in held.items() if len(cells(b) & cells((x, y, x + side, y + side))) >= 90]
        if len(inside) == 1:
            want[s] = inside[0]
    assert {r["council_fid"]: r["anchor"] for r in run(spark, "exactly_one_anchor_all")} == want


def test_anchors_of_every_count_are_counted(spark):
    """A council parcel with an anchor of two points and one of three has two anchors; one with an anchor of five has one."""
    from terrane.plans import workflow

    p = spark.createDataFrame([(k, x, 0.0, x + 10.0, 10.0, 100.0, 40.0) for k, x in ((1, 0.0), (2, 10.0), (3, 100.0))], "clean_fid long, xmin double, ymin double, xmax double, ymax double, area double, perimeter double")
    u = spark.createDataFrame([(i, x, 5.0) for i, x in enumerate([5.0] * 2 + [15.0] * 3 + [105.0] * 5)], "uprn long, x double, y double")
    c = spark.createDataFrame([(7, 0.0, 0.0, 20.0, 10.0), (8, 100.0, 0.0, 110.0, 10.0)], "council_fid long, xmin double, ymin double, xmax double, ymax double")
    held, free = workflow.anchors(u, p)
    got = {r["uprn"]: (r["origin"], r["parcel"]) for r in workflow._assigned(u, held, free, held, c).collect()}
    assert got == {i: ("fallback", 1) if i < 2 else ("fallback", 2) if i < 5 else ("council", 8) for i in range(10)}


def _gap_rounds(areas, borders, between):
    owners, out = {g: dict(borders.get(g, {})) for g in areas}, {}
    for r in range(1, len(areas) + 1):
        ready = {g for g in areas if g not in out and owners[g]}
        due = [g for g in ready if all((areas[g], g) < (areas[o], o) for o in between.get(g, {}) if o in ready)]
        for g in due:
            out[g] = (max(owners[g], key=lambda p: (owners[g][p], -p)), r)
        for g in due:
            for o, n in between.get(g, {}).items():
                owners[o][out[g][0]] = owners[o].get(out[g][0], 0.0) + n
    return out


def test_gaps_are_all_given_away(spark):
    """A row of 60 touching gaps of rising area, and behind its end two gaps that touch only gaps; one gap no owner can reach."""
    from terrane.operators import assembly
    from terrane.session import Scratch

    areas = {g: float(g) for g in range(1, 61)} | {70: 0.5, 71: 0.4, 90: 1.0, 91: 2.0}
    borders = {g: {1000 + g % 3: 1.0 + g % 4} for g in range(1, 61)}
    between = {}
    for a, b, n in [(g, g + 1, 2.5) for g in range(1, 60)] + [(60, 70, 1.0), (70, 71, 1.0), (90, 91, 1.0)]:
        between.setdefault(a, {})[b] = n
        between.setdefault(b, {})[a] = n
    rows = [(g, p, None, n) for g, o in borders.items() for p, n in o.items()] + [(g, None, o, n) for g, q in between.items() for o, n in q.items()]
    got = assembly.assign_gaps(spark.createDataFrame(list(areas.items()), "gap long, area double"), spark.createDataFrame(rows, "gap long, clean_fid long, other_gap long, len double"), Scratch(spark, "t"))
    want = _gap_rounds(areas, borders, between)
    assert len(want) == 62 and max(r for _, r in want.values()) > 50
    assert {r["gap"]: (r["clean_fid"], r["round"]) for r in got.collect()} == want


def _grown(members, edges):
    part = {v: v for v, seed in members.items() if seed}
    if len(part) < 2:
        return dict.fromkeys(members, min(members))
    while todo := set(members) - set(part):
        gain = {}
        for a, b, n in edges:
            for v, w in ((a, b), (b, a)):
                if v in todo and w in part:
                    gain[v, part[w]] = gain.get((v, part[w]), 0.0) + n
        if not gain:
            return part | dict.fromkeys(todo, min(part.values()))
        v, p = max(gain, key=lambda k: (gain[k], -k[0], -k[1]))
        part[v] = p
    return part


def test_components_of_any_size_are_split(spark):
    """Components of 8, 13 and 120 members, one of them without a second seed, against the plain greedy walk."""
    import random

    from terrane.operators import assembly

    rnd, members, edges = random.Random(3), [], []
    for c, (size, seeds) in {100: (8, 3), 200: (13, 4), 1000: (120, 17), 3000: (40, 1)}.items():
        members += [(c, c + i, i % max(1, size // seeds) == 0 and i // max(1, size // seeds) < seeds) for i in range(size)]
        edges += [(c, c + i, c + j, float(rnd.randrange(1, 9))) for i in range(size) for j in (i + 1, i + 2, i + 9) if j < size]
    got = assembly.best_split(spark.createDataFrame(members, "component long, v long, seed boolean"), spark.createDataFrame(edges, "component long, a long, b long, len double"))
    want = {}
    for c in (100, 200, 1000, 3000):
        want |= _grown({v: s for k, v, s in members if k == c}, [e[1:] for e in edges if e[0] == c])
    assert len(set(want.values())) > 17
    assert {r["v"]: r["part"] for r in got.collect()} == want


def test_hard_negatives_of_every_kind(spark):
    from itertools import combinations

    from terrane.operators import features

    targets = {"p": [1, 2], "q": [1, 2, 3], "r": [4, 5, 6, 7], "one": [9]}
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (2, 8), (6, 9), (7, 1)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = set()
    for t, ids in targets.items():
        s = set(ids)
        for k in range(1, len(ids)):
            want |= {(t, "omit" if k == len(ids) - 1 else "subset", c) for c in combinations(sorted(ids), k)}
        for a in ids:
            for b in near.get(a, set()) - s:
                want.add((t, "overmerge", tuple(sorted(s | {b}))))
                if len(ids) > 1:
                    want.add((t, "replace", tuple(sorted(s - {a} | {b}))))
    got = features.hard_negatives(spark.createDataFrame(list(targets.items()), "target string, ids array<long>"), spark.createDataFrame(edges, "a long, b long"))
    rows = [(r["target"], r["kind"], tuple(r["ids"])) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_large_pools_lose_no_vertex(spark):
    from terrane.operators import graph

    rows = [(1, v, {13: 14, 14: 12}.get(v), float(20 - v)) for v in range(10, 16)] + [(2, 7, None, 1.0)]
    pool = spark.createDataFrame(rows, "anchor long, v long, parent long, cost double")
    got = [(r["anchor"], tuple(r["ids"])) for r in graph.subsets(pool, 4).collect()]
    path = [(15,), (12, 15), (12, 14, 15), (12, 13, 14, 15), (11, 12, 13, 14, 15), (10, 11, 12, 13, 14, 15)]
    assert len(got) == len(set(got)) and set(got) == {(1, i) for i in [(10,), (11,), (12,), *path]} | {(2, (7,))}
