import random

from pyspark.sql import functions as F

from terrane.llm import topk


def test_against_brute(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, float("nan"), 0.0, -0.0, 0.5, 0.9]), rnd.choice([None, 1.0, 2.0]), i) for i in range(300)]
    rows += [(7, 0.5, None, i) for i in range(1000, 3000)]
    df = spark.createDataFrame(rows, "g long, s double, a double, c long").repartition(6)
    order = [topk.usable(F.col("s")), F.coalesce(topk.usable(F.col("a")), F.lit(float("-inf")))]
    got = sorted((r["g"], r["place"], r["c"]) for r in topk.top_n(df, "g", order, "c", 3).collect())
    want = []
    for g in (1, 2, 3, 7):
        sound = [r for r in rows if r[0] == g and r[1] is not None and r[1] == r[1]]
        sound.sort(key=lambda r: (-(r[1] + 0.0), -(r[2] if r[2] is not None else float("-inf")), r[3]))
        want += [(g, i + 1, r[3]) for i, r in enumerate(sound[:3])]
    assert got == sorted(want)


def test_newest_version_and_empty(spark):
    rows = [(1, 1, 0.1), (1, 2, 0.2), (1, 2, 0.3), (None, 1, 0.5), (2, None, 0.4), (2, 1, None)]
    df = spark.createDataFrame(rows, "c long, at long, s double").withColumn("_at", F.lit("clash")).withColumn("_row", F.lit(0))
    assert sorted(map(tuple, topk.newest_version(df, "c", "at", ["s"]).collect())) == [(1, 0.3), (2, None)]
    assert topk.top_n(df.limit(0), "c", [F.col("s")], "at", 3).count() == 0
    assert "collect_top_k" in topk.top_n(df, "c", [F.col("s")], "at", 3)._jdf.queryExecution().toString()
