from pyspark.sql import functions as F

from terrane.functions import geo
from terrane.operators import candidates, overlay, polygons, selection
from terrane.plans import runner, workflow


def _box(x0, y0, x1, y1, hole=None):
    ring = lambda a, b, c, d: f"({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b})"
    return f"POLYGON ({ring(x0, y0, x1, y1)}{', ' + ring(*hole) if hole else ''})"


NODES = "v long, source long, area double, perimeter double, role string, uprns int, plot boolean, hole_fill int, gap_fill int, wkt string"
PIECES = [
    (1, 10, 100.0, 40.0, "building", 2, True, 0, 0, _box(0, 0, 10, 10)), (2, 10, 100.0, 40.0, "land", 0, True, 1, 0, _box(10, 0, 20, 10)), (3, 30, 100.0, 40.0, None, 1, True, 0, 0, _box(20, 0, 30, 10)),
    (4, 40, None, None, "road", None, None, None, None, _box(0, 10, 10, 20)),
]
EDGES = [(1, 2, 10.0), (2, 3, 10.0), (1, 4, 10.0)]


def test_features_of_a_small_plot(spark):
    nodes = spark.createDataFrame(PIECES, NODES)
    edges = spark.createDataFrame(EDGES, "a long, b long, len double")
    groups = spark.createDataFrame([("g", 1, [1, 2, 2, 99]), ("h", 1, [1]), ("i", 3, [2, 3])], "gid string, anchor long, ids array<long>")
    t = {r["gid"]: r.asDict() for r in candidates.group_table(groups, nodes, edges).collect()}
    g = t["g"]
    assert (g["candidate_clean_count"], g["candidate_source_count"], g["added_clean_count"], g["area_sum"], g["internal_shared_len"], g["anchor_added_shared_len"]) == (2, 1, 1, 200.0, 10.0, 10.0)
    assert (g["external_shared_len"], g["outside_neighbor_count"], g["outside_uprn_neighbor_count"], g["outside_zero_uprn_plot_neighbor_count"]) == (20.0, 2, 1, 0)
    assert (g["role_signature"], g["anchor_role"], g["is_polygon_hole_fill_count"], g["contains_other_anchor_count"]) == ("building:1|land:1", "building", 1, 0)
    assert t["h"]["internal_shared_len"] == 0 and t["h"]["outside_zero_uprn_land_area"] == 100.0 and t["h"]["added_area_mean"] == 0.0
    assert t["i"]["role_other_count"] == 1 and t["i"]["outside_building_neighbor_count"] == 1
    geo.register(spark)
    shaped = candidates.with_shapes(candidates.group_table(groups, nodes, edges), groups, nodes.select("v", geo.st_from_text("wkt").alias("geom")))
    s = {r["gid"]: r.asDict() for r in shaped.collect()}["g"]
    assert s["candidate_area"] == 200.0 and s["group_perimeter"] == 60.0 and s["boundary_simplification"] == 0.25 and len(s) >= 120
    target = spark.createDataFrame([(1, [10]), (3, [10, 30])], "anchor long, target_sources array<long>")
    lab = {r["gid"]: (r["label"], r["source_target_jaccard"]) for r in candidates.with_targets(candidates.group_table(groups, nodes, edges), target).collect()}
    assert lab == {"g": (1, 1.0), "h": (1, 1.0), "i": (1, 1.0)}
    assert candidates.group_table(groups.limit(0), nodes, edges).count() == 0


def test_completion_and_pruning(spark):
    groups = spark.createDataFrame([("g", [1, 2])], "gid string, ids array<long>")
    edges = spark.createDataFrame(EDGES, "a long, b long, len double")
    assert {tuple(r["ids"]) for r in candidates.completions(groups, edges).collect()} == {(1, 2, 3), (1, 2, 4)}
    assert {tuple(r["ids"]) for r in candidates.prunings(groups).collect()} == {(1,), (2,)}
    d = candidates.deltas(spark.createDataFrame([(1, 2.0)], "k int, m double"), spark.createDataFrame([(1, 3.0), (2, 5.0)], "k int, m double"), "k", ["m"])
    assert {r["k"]: (r["delta_m"], r["ratio_m"]) for r in d.collect()} == {1: (1.0, 1.5), 2: (5.0, 5.0)}


def test_a_dropped_sliver_leaves_its_part_to_others(spark):
    """The second piece keeps less than the least area and is dropped; the third then keeps that part."""
    rows = [(1, 1, _box(0, 0, 10, 10)), (2, 2, _box(0, 0, 10.02, 10)), (3, 3, _box(9, 0, 12, 10))]
    df = polygons.with_shape(spark.createDataFrame(rows, "clean_fid long, rank int, wkt string"))
    got = {r["clean_fid"]: round(r["area"], 6) for r in overlay.deoverlap(df, ["rank"], 0.25).collect()}
    assert got == {1: 100.0, 2: 0.0, 3: 20.0}
    plain = {r["clean_fid"]: round(r["area"], 6) for r in overlay.deoverlap(df, ["rank"], 0.01).collect()}
    assert plain == {1: 100.0, 2: 0.2, 3: 19.8}


def test_preprocessing(spark, tmp_path):
    """Overlap, a hole, a gap within a ring of four, a bow-tie and nonsense, from raw to validated."""
    ring = [_box(100, 0, 130, 10), _box(100, 20, 130, 30), _box(100, 10, 110, 20), _box(120, 10, 130, 20)]
    rows = [(1, "Building", _box(0, 0, 10, 10)), (2, "Land", _box(5, 0, 20, 10)), (3, "Land", _box(40, 0, 60, 20, (45, 5, 50, 10))), (4, "Land", "POLYGON ((200 0, 210 10, 210 0, 200 10, 200 0))"), (5, "Land", "nonsense"), (6, "Land", None)]
    raw = spark.createDataFrame(rows + [(10 + i, "Land", w) for i, w in enumerate(ring)], "source_fid long, theme string, wkt string")
    done = workflow.preprocess(spark, raw, str(tmp_path))
    again = workflow.preprocess(spark, raw, str(tmp_path))
    assert {s["state"] for s in done["stages"]} == {"run"} and {s["state"] for s in again["stages"]} == {"skipped"}
    clean = spark.read.parquet(f"{tmp_path}/{done['signature']}/gaps_filled")
    area = {r["source_fid"]: round(r["a"], 6) for r in clean.groupBy("source_fid").agg(F.sum("area").alias("a")).collect()}
    assert area[1] == 100.0 and area[2] == 100.0 and area[3] == 400.0 and area[4] == 50.0 and sum(area[10 + i] for i in range(4)) == 900.0 and set(area) == {1, 2, 3, 4, 10, 11, 12, 13}
    assert clean.where("role = 'gap'").count() == 2 and clean.select("clean_fid").distinct().count() == clean.count()
    assert spark.read.parquet(f"{tmp_path}/{done['signature']}/validated").first()["pairs"] == 0


def test_numbered(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    assert [tuple(r) for r in selection.numbered(df, ["k"], "n").orderBy("k").collect()] == [(i, i) for i in range(500)]
    assert selection.numbered(df.limit(0), ["k"], "n").count() == 0


def test_changed_inputs_and_code_run_again(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stage = lambda s, done: s.read.parquet(str(tmp_path / "in"))
    run = lambda f: runner.run_stages(spark, [("a", f)], str(tmp_path / "out"), inputs=[str(tmp_path / "in")])
    assert run(stage)["stages"][0]["state"] == "run" and run(stage)["stages"][0]["state"] == "skipped"
    assert run(lambda s, done: s.read.parquet(str(tmp_path / "in")).limit(1))["stages"][0]["state"] == "run"
    spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
    assert run(stage)["stages"][0]["rows"] == 8
