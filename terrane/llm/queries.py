"""Queries of the training-data operators and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import addresses, components, moderation, packing, tokenizer, topk
from terrane.session import Scratch
from terrane.sources.tables import table

BEST, LINK_PROBA, CAPACITY = 3, 0.5, 2048


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "sheffield_wp3_edit_geocoding").select("point_fid", *addresses.FIELDS, "x_27700", "y_27700", "edited_at")
    return addresses.same_place(records, Scratch(spark, "p3"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = topk.newest_version(
        table(spark, sf_dir, "wfs_raw_anchor_group_predictions_v1"), "candidate_id", "exported_at",
        ["anchor_source_fid", "raw_anchor_group_proba", "candidate_area"],
    )
    score = topk.usable(F.col("raw_anchor_group_proba"))
    area = F.coalesce(topk.usable(F.col("candidate_area")), F.lit(float("-inf")))
    best_raw = topk.top_n(raw, "anchor_source_fid", [score, area], "candidate_id", BEST)
    repair = topk.newest_version(
        table(spark, sf_dir, "anchor_group_repair_predictions_v1"), "candidate_id", "exported_at",
        ["anchor_component_id", "anchor_group_repair_proba"],
    )
    best_repair = topk.top_n(repair, "anchor_component_id", [topk.usable(F.col("anchor_group_repair_proba"))], "candidate_id", BEST)
    out = ["src", "group_id", "place", "candidate_id"]
    return best_raw.select(F.lit("raw").alias("src"), F.col("anchor_source_fid").alias("group_id"), "place", "candidate_id").select(*out).unionByName(
        best_repair.select(F.lit("repair").alias("src"), F.col("anchor_component_id").alias("group_id"), "place", "candidate_id")
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "edge_candidate_predictions_full").where(
        (F.col("model_proba") >= LINK_PROBA) & ~F.isnan("model_proba")
    ).select(F.col("left_source_fid").alias("u"), F.col("right_source_fid").alias("w"))
    return components.components(spark, pairs).select(F.col("v").alias("source_fid"), "group_id")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_containers(table(spark, sf_dir, "documents"), "doc_id", "text", CAPACITY)


def p8_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of room left unused."""
    used = p8_pack(spark, sf_dir).groupBy("container_id").agg(F.sum("tokens").alias("used"))
    return used.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens")).withColumn(
        "unused_share", F.lit(1.0) - F.col("tokens") / (F.col("containers") * CAPACITY)
    )


def p8_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row that must hold of any packing: documents, documents not placed or not whole, containers over the capacity,
    documents cut though they fit into one container."""
    documents = table(spark, sf_dir, "documents")
    placed = Scratch(spark, "p8_audit").put(packing.fill_containers(documents, "doc_id", "text", CAPACITY), "placed")
    sizes = documents.select("doc_id", packing.size_and_key(F.col("text"))["tokens"].alias("size"))
    per_doc = placed.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    whole = (F.col("tokens") == F.col("size")) & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("size") / CAPACITY)))
    by_doc = sizes.join(per_doc, "doc_id", "left").agg(
        F.count("*").alias("documents"), F.sum(F.when(F.coalesce(whole, F.lit(False)), 0).otherwise(1)).cast("long").alias("not_whole"),
        F.sum(F.when((F.col("size") <= CAPACITY) & (F.col("pieces") > 1), 1).otherwise(0)).cast("long").alias("cut_though_fitting"),
    )
    over = placed.groupBy("container_id").agg(F.sum("tokens").alias("used")).agg(F.sum(F.when(F.col("used") > CAPACITY, 1).otherwise(0)).cast("long").alias("over_full"))
    return by_doc.crossJoin(over)  # one row each


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, score) of every document."""
    documents = table(spark, sf_dir, "documents")
    model = moderation.fit_on(table(spark, sf_dir, "moderation_examples"), documents.select("doc_id", "text"))
    return documents.select("doc_id", "source", moderation.score(F.col("text"), model).alias("score"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).where(F.col("score") >= moderation.THRESHOLD).select("doc_id").distinct()


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, flagged documents and rate of each source (null source kept)."""
    flagged = F.sum(F.when(F.col("score") >= moderation.THRESHOLD, 1).otherwise(0))
    return p9_scores(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("documents"), flagged.alias("flagged"), (flagged / F.count("*")).alias("rate")
    )


QUERIES = {
    "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p7_ids": p7_ids, "p8_pack": p8_pack, "p8_room": p8_room, "p8_audit": p8_audit,
    "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates,
}

ORACLES = {
    "p8_audit": "SELECT count(*) AS documents, CAST(0 AS BIGINT) AS not_whole, CAST(0 AS BIGINT) AS cut_though_fitting, CAST(0 AS BIGINT) AS over_full FROM documents",
    "p4_found": """
WITH raw AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY exported_at DESC NULLS LAST) AS rn
                 FROM wfs_raw_anchor_group_predictions_v1 WHERE candidate_id IS NOT NULL) WHERE rn = 1),
rep AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY exported_at DESC NULLS LAST) AS rn
                 FROM anchor_group_repair_predictions_v1 WHERE candidate_id IS NOT NULL) WHERE rn = 1),
ranked AS (
  SELECT 'raw' AS src, anchor_source_fid AS group_id, candidate_id,
         row_number() OVER (PARTITION BY anchor_source_fid ORDER BY raw_anchor_group_proba DESC,
           CASE WHEN isnan(candidate_area) THEN NULL ELSE candidate_area END DESC NULLS LAST, candidate_id) AS place
  FROM raw WHERE anchor_source_fid IS NOT NULL AND raw_anchor_group_proba IS NOT NULL AND NOT isnan(raw_anchor_group_proba)
  UNION ALL
  SELECT 'repair', anchor_component_id, candidate_id,
         row_number() OVER (PARTITION BY anchor_component_id ORDER BY anchor_group_repair_proba DESC, candidate_id)
  FROM rep WHERE anchor_component_id IS NOT NULL AND anchor_group_repair_proba IS NOT NULL AND NOT isnan(anchor_group_repair_proba))
SELECT src, group_id, CAST(place AS INTEGER) AS place, candidate_id FROM ranked WHERE place <= 3
""",
    "p6_found": """
WITH RECURSIVE e AS (
  SELECT DISTINCT left_source_fid AS a, right_source_fid AS b FROM edge_candidate_predictions_full
  WHERE left_source_fid IS NOT NULL AND right_source_fid IS NOT NULL AND model_proba >= 0.5 AND NOT isnan(model_proba)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (
  SELECT a AS v, a AS low FROM both_ways
  UNION
  SELECT b.b, r.low FROM reach r JOIN both_ways b ON b.a = r.v WHERE r.low < b.b)
SELECT v AS source_fid, min(low) AS group_id FROM reach GROUP BY v
""",
}
