"""Resumable ingest of page files as a stream: every page once, every feature once.

Finished pages are kept by the checkpoint of the stream, features already stored are dropped by key
within the watermark-free state of the target (an anti-join per batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.selection import first_key
from terrane.session import exists
from terrane.sources.files import features_of


def page_features(pages: DataFrame) -> DataFrame:
    """(key, fid, theme, geometry_type, coordinates) of page texts (value); the key is the first of identifier, feature id and hash."""
    f = pages.select(F.explode(features_of(F.col("value"))).alias("f"))
    p = F.col("f.properties")
    key = first_key(("toid", p["TOID"]), ("id", F.col("f.id")), ("geometry", F.sha1(F.col("f.geometry.coordinates"))))
    return f.select(key.alias("key"), F.col("f.id").alias("fid"), p["Theme"].alias("theme"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str) -> int:
    """Take in all new page files of a folder; gives the number of rows stored after it. Safe to run again: each batch
    writes its own part of the target, so a batch that is repeated after a failure replaces what it wrote before."""
    stream = spark.readStream.format("text").option("wholetext", "true").load(folder)

    def store(batch: DataFrame, number: int) -> None:
        rows = page_features(batch).dropDuplicates(["key"])
        if exists(spark, target):
            before = spark.read.parquet(target).where(F.col("batch") != number).select("key")
            rows = rows.join(before, "key", "left_anti")
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).count() if exists(spark, target) else 0


def windowed_counts(events: DataFrame, at: str, kind: str, width: str, late: str) -> DataFrame:
    """Counts per kind and time window of a stream or table; rows later than ``late`` are dropped in a stream."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("since"), kind, "n")
