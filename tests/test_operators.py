import json
import random

from pyspark.sql import functions as F

from terrane.functions import exprs, geo
from terrane.operators import aggregates, features, graph, learning, overlay, selection
from terrane.plans import runner
from terrane.session import Scratch

RND = random.Random(5)


def _union_find(edges, vertices):
    parent = {v: v for v in vertices}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {v: root(v) for v in vertices}


def test_component_labels_and_bridges(spark):
    edges = [(RND.randrange(200), RND.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "a long, b long, len double")
    vertices = sorted({v for e in edges for v in e})
    v = spark.createDataFrame([(x,) for x in vertices], "v long")
    got = {r["v"]: r["component"] for r in graph.component_labels(df, v, Scratch(spark, "t")).collect()}
    assert got == _union_find(edges, vertices)
    simple = sorted({(min(e), max(e)) for e in edges})
    want = {e for e in simple if len(set(_union_find([x for x in simple if x != e], vertices).values())) > len(set(got.values()))}
    found = graph.bridges(spark.createDataFrame([(a, b, 1.0) for a, b in simple], "a long, b long, len double"), Scratch(spark, "t"))
    assert {(r["a"], r["b"]) for r in found.collect()} == want


def test_pack_equals_walk(spark):
    rows = [(i, RND.random(), [RND.randrange(60) for _ in range(RND.randrange(0, 5))]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, minus double, resources array<long>")
    taken, want = set(), set()
    for i, _, res in sorted(rows, key=lambda r: (r[1], r[0])):
        if not taken & set(res):
            want.add(i)
            taken |= set(res)
    assert {r["id"] for r in selection.pack(df, Scratch(spark, "t"), ["minus"]).collect()} == want


def test_subsets_need_parents(spark):
    pool = spark.createDataFrame([(1, 10, None), (1, 11, 10), (1, 12, None)], "anchor long, v long, parent long")
    got = {tuple(r["ids"]) for r in graph.subsets(pool).collect()}
    assert got == {(10,), (12,), (10, 11), (10, 12), (10, 11, 12)}


def test_connected_groups(spark):
    e = spark.createDataFrame([(1, 2, 3.0), (2, 3, 1.0), (1, 4, 2.0)], "a long, b long, len double")
    got = {tuple(r["ids"]) for r in graph.connected_groups(e, spark.createDataFrame([(1,)], "v long"), 3, 10).collect()}
    assert got == {(1,), (1, 2), (1, 4), (1, 2, 3), (1, 2, 4)}


def test_overlay(spark):
    geo.register(spark)
    rows = [(1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))", 0.0, 0.0, 10.0, 10.0, 100.0), (2, "POLYGON ((5 5, 15 5, 15 15, 5 15, 5 5))", 5.0, 5.0, 15.0, 15.0, 100.0), (3, "POLYGON ((6 6, 7 6, 7 7, 6 7, 6 6))", 6.0, 6.0, 7.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "clean_fid long, wkt string, xmin double, ymin double, xmax double, ymax double, area double").withColumn("geom", geo.st_from_text(F.col("wkt")))
    got = {r["clean_fid"]: (r["area"], r["removed"]) for r in overlay.deoverlap(df, ["clean_fid"], 0.25).collect()}
    assert got == {1: (100.0, 0.0), 2: (75.0, 25.0), 3: (0.0, 1.0)}
    assert spark.createDataFrame([(None,), ("POLYGON ((1 1",)], "w string").select(geo.st_shape(geo.st_from_text(F.col("w")))["area"].alias("a")).where("a is not null").count() == 0


def test_geometry_cases(spark):
    geo.register(spark)
    shapes = {"bow": "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))", "turned": "POLYGON ((0 0, 8.660254037844386 5, 6.160254037844386 9.330127018922193, -2.5 4.330127018922193, 0 0))", "l": "POLYGON ((0 0, 4 0, 4 2, 2 2, 2 4, 0 4, 0 0))"}
    df = spark.createDataFrame(list(shapes.items()), "n string, w string").withColumn("g", geo.st_from_text(F.col("w")))
    m = {r["n"]: r["m"] for r in df.select("n", geo.st_shape(geo.st_make_valid(F.col("g"))).alias("m")).collect()}
    assert abs(m["bow"]["area"] - 2.0) < 1e-9 and m["bow"]["part_count"] == 2
    assert abs(m["turned"]["mrr_ratio"] - 1) < 1e-6 and abs(m["turned"]["near10"] - 1) < 1e-9 and abs(m["turned"]["mrr_short"] - 5) < 1e-6
    assert m["l"]["area"] == 12 and m["l"]["hull_area"] == 14


def test_expressions_on_nulls(spark):
    df = spark.createDataFrame([(None,), ("",), (" 12.0 ",), ("x",), ("1e400",)], "t string")
    keys = [r[0] for r in df.select(exprs.canonical_key(F.col("t"))).collect()]
    assert keys[:4] == ["", "", "12", "x"]
    assert [r[0] for r in df.select(exprs.safe_number(F.col("t"), -1.0)).collect()] == [-1.0, -1.0, 12.0, -1.0, -1.0]
    assert [r[0] for r in df.select(exprs.role(F.col("t"), "anchor")).collect()] == ["other"] * 5
    assert [r[0] for r in df.select(exprs.text_to_ids(F.col("t"))).collect()] == [[], [], [12], [], []]


def test_average_rank_and_mode(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", None)], "k string, v double")
    assert sorted(r["r"] for r in aggregates.average_rank(df, ["k"], "v", "r").collect()) == [1.5, 1.5, 3.0, 4.0]
    m = aggregates.local_mode(spark.createDataFrame([("a", 100.0), ("a", 101.0), ("a", 300.0), ("a", -1.0), ("a", None)], "k string, v double"), ["k"], "v").first()
    assert (m["mode"], m["support"]) == (100.5, 2)


def test_features_of_empty_groups(spark):
    groups = spark.createDataFrame([], "gid long, anchor long, ids array<long>")
    nodes = spark.createDataFrame([(1, 1.0, 4.0, "land", 0)], "v long, area double, perimeter double, role string, uprns int")
    edges = spark.createDataFrame([], "a long, b long, len double")
    assert features.group_features(groups, nodes, edges).count() == 0


def test_learning(spark):
    rows = [(float(i % 7), None if i % 11 == 0 else float(i % 3), "rare" if i == 5 else "abc"[i % 3], int(i % 7 > 3)) for i in range(400)]
    df = learning.fold_rare(spark.createDataFrame(rows, "x double, z double, c string, label int"), "c", 5)
    assert df.where("c = '(rare)'").count() == 1
    model = learning.train(df, ["x", "z"], ["c"], "label", iterations=3, depth=2)
    scored = learning.score(model, df.drop("z"), ["x", "z"], "p")
    assert scored.where("(p >= 0.5) = (label = 1)").count() == 400
    assert learning.importances(model, ["x", "z"])[0][0] == "x"


def test_runner(spark, tmp_path):
    stages = [("one", lambda s, _: s.range(5)), ("two", lambda s, done: done["one"].where("id > 2"))]
    first = runner.run_stages(spark, stages, str(tmp_path), {"a": 1})
    again = runner.run_stages(spark, stages, str(tmp_path), {"a": 1})
    assert [s["rows"] for s in first["stages"]] == [5, 2] and [s["state"] for s in again["stages"]] == ["skipped"] * 2
    assert json.loads((tmp_path / first["signature"] / "summary.json").read_text())["stages"][1]["rows"] == 2
    assert runner.run_stages(spark, stages, str(tmp_path), {"a": 2}, dry=True)["stages"][0]["state"] == "dry"
    assert runner.extrapolate(10, 100, 1000) == 100 and runner.forbidden_tokens("a council_iou b", ["IOU", "zz"]) == ["IOU"]


def test_component_labels_in_levels(spark, monkeypatch):
    """A graph of more edges than one task joins, in ranges and, where stars hardly shrink it, in rounds; a long chain needs few tables."""
    edges = [(RND.randrange(900), RND.randrange(900)) for _ in range(500)] + [(2000 + i, 2001 + i) for i in range(300)] + [(5, 5)]
    df = spark.createDataFrame([(a, b) for a, b in edges] + [(None, 7)], "a long, b long")
    vertices = sorted({v for e in edges for v in e} | {9999})
    v, want = spark.createDataFrame([(x,) for x in vertices], "v long"), _union_find(edges, vertices)
    for chunk, spread in ((40, True), (40, False), (graph.CHUNK, False)):
        monkeypatch.setattr(graph, "CHUNK", chunk)
        used = []
        if spread:
            monkeypatch.setattr(graph, "MOST_LEFT", 0.0)
            monkeypatch.setattr(graph, "_spread_labels", lambda *a, f=graph._spread_labels: used.append(1) or f(*a))
        else:
            monkeypatch.undo()
            monkeypatch.setattr(graph, "CHUNK", chunk)
        assert {r["v"]: r["component"] for r in graph.component_labels(df, v, Scratch(spark, "t")).collect()} == want
        assert bool(used) == spread


def test_component_labels_of_a_chain(spark):
    """Few jobs for a chain, which took two or three a round before."""
    n = 3000
    df, tables = spark.createDataFrame([((i * 7919) % n, ((i + 1) * 7919) % n) for i in range(n - 1)], "a long, b long"), []
    scratch = Scratch(spark, "t")
    put = scratch.put
    scratch.put = lambda frame, name: tables.append(name) or put(frame, name)
    got = graph.component_labels(df, spark.range(n).withColumnRenamed("id", "v"), scratch)
    assert got.where("component <> 0").isEmpty() and got.count() == n and len(tables) <= 6


def test_bridges_of_many_components_at_once(spark):
    """Components share tasks: far fewer calls than components, and the same bridges."""
    chains = [(10 * c + i, 10 * c + i + 1) for c in range(60) for i in range(3)] + [(10 * c, 10 * c + 2) for c in range(0, 60, 2)]
    df = spark.createDataFrame([(a, b, 1.0) for a, b in chains], "a long, b long, len double")
    want = {(10 * c + i, 10 * c + i + 1) for c in range(60) for i in range(3) if c % 2 or i == 2}
    found = graph.bridges(df, Scratch(spark, "t"))
    assert {(r["a"], r["b"]) for r in found.collect()} == want
    groups = df.groupBy(graph.bucket(df, "a")).count().count()
    assert groups <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    import pandas as pd

    whole = graph._bridges_of(pd.DataFrame(chains, columns=["a", "b"]))
    assert set(whole.itertuples(index=False, name=None)) == want


def test_anchor_workflow_counts_points_once(spark):
    """The plan reads counted parcels from written tables and does not count the points again for each use."""
    from terrane.plans import workflow

    plan = workflow.anchor_workflow_all(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "count(distinct uprn" not in plan.lower()
