"""Queries of sources, sinks, streams and models over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import learning
from terrane.plans import fixtures as fx
from terrane.plans.fixtures import C, P, sql
from terrane.session import Scratch
from terrane.sources import files
from terrane.sources.tables import table
from terrane.streaming import ingest

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its function name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(sql(P, body="SELECT clean_fid, theme FROM P WHERE xmax >= 95 AND xmin <= 205 AND ymax >= 95 AND ymin <= 155"))
def bbox_scan(spark, d):
    return files.read_box(fx.parcels(spark, d), 95, 95, 205, 155).select("clean_fid", "theme")


@query(sql(P, body="SELECT count(*) AS features, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM P"))
def layer_metadata(spark, d):
    return fx.parcels(spark, d).agg(F.count("*").alias("features"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


@query(sql(P, body="SELECT clean_fid, area FROM P WHERE 104.5 BETWEEN xmin AND xmax AND 104.5 BETWEEN ymin AND ymax ORDER BY area, clean_fid LIMIT 1"))
def point_seed_scan(spark, d):
    return files.seed_polygon(fx.parcels(spark, d), 104.5, 104.5).select("clean_fid", "area")


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(NULL AS DOUBLE) AS missing FROM customer WHERE false")
def optional_scan(spark, d):
    return files.optional(spark, f"{d}/no_such_table.parquet", "c_custkey bigint, missing double")


@query("SELECT c_custkey, 1000000 + row_number() OVER (ORDER BY c_custkey) AS fid FROM customer WHERE c_custkey % 2 = 1 UNION ALL SELECT c_custkey, 1000000 - c_custkey FROM customer WHERE c_custkey % 2 = 0")
def stable_fid_sink(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    old = c.where("c_custkey % 2 = 0").select("c_custkey", (F.lit(1_000_000) - F.col("c_custkey")).alias("fid"))
    return files.stable_ids(c, Scratch(spark, "fids").put(old, "old"), "c_custkey", "fid")


@query(sql(C, body="""SELECT split, "case", anchor, line, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY split, "case" ORDER BY abs(proba - label) DESC, k) AS place FROM (SELECT *, anchor % 3 AS split, anchor*10 + line AS k,
  CASE WHEN label = 0 AND proba >= 0.5 THEN 'false_positive' WHEN label = 1 AND proba < 0.5 THEN 'false_negative' END AS "case" FROM (SELECT anchor, line, label, round(proba, 6) AS proba, max(part) AS part FROM C GROUP BY 1, 2, 3, 4)) WHERE "case" IS NOT NULL) WHERE place <= 25"""))
def error_case_report(spark, d):
    c = fx.candidates(spark, d).withColumn("proba", F.round("proba", 6)).select("anchor", "line", "label", "proba").distinct()
    rows = c.withColumn("split", F.pmod("anchor", F.lit(3))).withColumn("k", F.col("anchor") * 10 + F.col("line"))
    return files.error_cases(rows, "split", "label", "proba", "k", 25).select("split", "case", "anchor", "line", "place")


@query("SELECT c_custkey, CAST(c_custkey*37 % 400 + 0.5 AS DOUBLE) AS x FROM customer")
def geojson_round_trip(spark, d):
    """Points written as features by all tasks and read back."""
    path = Scratch(spark, "geojson").base
    u = fx.uprns(spark, d)
    files.write_geojson(u.select("x", "y", "uprn"), path)
    line = F.from_json("value", "geometry struct<coordinates:array<double>>, properties struct<uprn:bigint>")
    return spark.read.text(path).select(line.alias("f")).select(F.col("f.properties.uprn").alias("c_custkey"), F.col("f.geometry.coordinates")[0].alias("x"))


@query("SELECT count(DISTINCT key) AS features, count(DISTINCT theme) AS themes FROM (SELECT f->>'$.properties.TOID' AS key, f->>'$.properties.Theme' AS theme FROM (SELECT unnest(CAST(text->'$.features' AS JSON[])) AS f FROM documents WHERE source = 'page_export' AND json_valid(text))) WHERE key IS NOT NULL")
def page_features_scan(spark, d):
    """Features of the page texts among the documents."""
    pages = table(spark, d, "documents").where("source = 'page_export'").select(F.col("text").alias("value"))
    f = ingest.page_features(pages).where("key like 'toid:%'")
    return f.agg(F.countDistinct("key").alias("features"), F.countDistinct("theme").alias("themes"))


@query()
def page_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The same pages as files, taken in by a stream that is run twice; the second run adds nothing."""
    base = Scratch(spark, "ingest").base
    table(spark, d, "documents").where("source = 'page_export' and text is not null").select(F.regexp_replace("text", r"\s+", " ").alias("value")).repartition(4).write.text(f"{base}/pages")
    stream = spark.readStream.format("text").load(f"{base}/pages")

    def store(batch: DataFrame, _: int) -> None:
        ingest.page_features(batch).dropDuplicates(["key"]).write.mode("append").parquet(f"{base}/features")

    for _ in range(2):
        stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/features").select("key", "theme").distinct()


@query("SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS since, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    e = table(spark, d, "events")
    return ingest.windowed_counts(e.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", "event_type", "1 hour", "10 minutes")


@query()
def gbt_score(spark, d):
    """A boosted-tree model on all candidates, scored on all of them."""
    c = learning.fold_rare(fx.candidates(spark, d), "mode", 10)
    numeric = ["size", "score", "proba"]
    model = learning.train(c, numeric, ["mode"], "label", iterations=5, depth=3)
    return learning.score(model, c, numeric, "model_proba").select("anchor", "line", "part", "supp", F.round("model_proba", 6).alias("model_proba"))
