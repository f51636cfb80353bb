"""Queries over the generated parcel tables: points and regions, packed fields, orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators import packed, references, spatial
from terrane.session import Scratch
from terrane.sources.tables import table

NEAR_METRES, POINT_METRES = 2.0, 8.0

#: src, table, row id column, packed column
PACKED_FIELDS = (
    ("parcel", "predicted_parcels_with_uprn", "pred_component_id", "merge_source_fids"),
    ("repair", "anchor_group_repair_predictions_v1", "candidate_id", "zero_component_ids"),
    ("raw", "wfs_raw_anchor_group_predictions_v1", "candidate_id", "candidate_source_fids"),
    ("polygon", "oachargeid_candidate_polygons", "candidate_fid", "wfs_fids"),
)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "p1")
    uprns = table(spark, sf_dir, "osopenuprn_address").select("uprn", "x_27700", "y_27700", "loaded_at")
    points = scratch.put(spatial.latest_location(uprns, "uprn", "x_27700", "y_27700", "loaded_at"), "points")
    parcels = (
        table(spark, sf_dir, "predicted_parcels_with_uprn")
        .select(F.col("pred_component_id").alias("region_id"), F.col("geom_wkt").alias("wkt"), F.col("pred_uprn_count").alias("count"))
        .where(F.col("region_id").isNotNull() & F.col("wkt").isNotNull())
    )
    asked = (
        table(spark, sf_dir, "oachargeid_point_candidate_assignments")
        .select(F.col("point_fid").alias("probe_id"), F.col("x_27700").alias("px"), F.col("y_27700").alias("py"))
        .where("probe_id is not null and abs(px) <= 1e9 and abs(py) <= 1e9")
    )
    cells = scratch.put(spatial.cover(parcels.select("region_id", "wkt").distinct()), "cells")
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # at most 22 levels
    places = scratch.put(spatial.spots(points), "places")
    held = scratch.put(spatial.spots_in_regions(places, cells, levels), "held") if levels else places.select(F.lit(0).cast("long").alias("region_id"), "x", "y").limit(0)

    near = spatial.near_pairs(points, NEAR_METRES, places).select(F.lit("near").alias("kind"), "left_id", "right_id")
    point = spatial.near_points(asked, points, POINT_METRES, places).select(F.lit("point").alias("kind"), F.col("probe_id").alias("left_id"), F.col("id").alias("right_id"))
    inside = held.join(points, ["x", "y"]).select(F.lit("in").alias("kind"), F.col("id").alias("left_id"), F.col("region_id").alias("right_id"))
    counted = held.join(places, ["x", "y"]).groupBy("region_id").agg(F.sum("n").alias("n"))
    recount = (
        parcels.where(F.col("count").isNotNull()).select("region_id", "count").distinct()
        .join(counted, "region_id", "left")
        .where(F.coalesce("n", F.lit(0)) != F.col("count"))
        .select(F.lit("recount").alias("kind"), F.col("region_id").alias("left_id"), F.coalesce("n", F.lit(0)).alias("right_id"))
        .distinct()
    )
    return near.unionByName(point).unionByName(inside).unionByName(recount)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, name).select(F.lit(src).alias("src"), F.col(key).cast("long").alias("row_id"), F.col(field).alias("packed"))
        for src, name, key, field in PACKED_FIELDS
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return packed.unpack(union)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "p5")
    polygons = table(spark, sf_dir, "prediction_source_polygons").select("source_fid", "pred_component_id", "loaded_at", "deleted_at")
    untiled = table(spark, sf_dir, "untiled_source_polygons").select("source_fid")
    edges = table(spark, sf_dir, "edge_candidate_predictions_full").select("edge_id", "left_source_fid", "right_source_fid", "scored_at")
    councils = table(spark, sf_dir, "wfs_raw_merged_council_train_merged_only").select("train_component_id", "target_source_fids", "built_at")
    parcels = table(spark, sf_dir, "predicted_parcels_with_uprn").select("pred_component_id")

    by_edge = edges.select(
        F.lit("edge").alias("src"), F.col("edge_id").alias("row_id"), F.explode(F.array("left_source_fid", "right_source_fid")).alias("key"), F.col("scored_at").alias("at")
    ).where("key is not null")
    by_council = (
        packed.split_packed(councils, "target_source_fids", "ids")
        .select(F.lit("council").alias("src"), F.col("train_component_id").alias("row_id"), F.explode("ids").alias("id"), F.col("built_at").alias("at"))
        .select("src", "row_id", F.expr("try_cast(id as bigint)").alias("key"), "at")
        .where("key is not null")
    )
    refs = by_edge.unionByName(by_council)
    changes = references.existence_deltas(polygons, "source_fid", "loaded_at", "deleted_at").unionByName(
        references.existence_deltas(untiled, "source_fid", None, None)
    )
    keys = scratch.put(references.orphan_keys(refs, changes), "fid_keys")

    first = polygons.where("source_fid is not null").groupBy("source_fid").agg(F.min("loaded_at").alias("at"))
    by_source = polygons.where("pred_component_id is not null and source_fid is not null").select("source_fid", "pred_component_id").distinct()
    component_keys = scratch.put(
        references.orphan_keys(
            by_source.select(F.col("pred_component_id").alias("key"), F.lit(None).cast("timestamp_ntz").alias("at")),
            references.existence_deltas(parcels.distinct(), "pred_component_id", None, None),
        ),
        "component_keys",
    )
    dated = by_source.join(first, "source_fid").select(
        F.lit("source").alias("src"), F.col("source_fid").alias("row_id"), F.col("pred_component_id").alias("key"), "at"
    )
    return references.orphan_references(refs, keys).unionByName(references.orphan_references(dated, component_keys))


#: Not a number or null scores, quoting and time are as TESTDATA defines them; see the docstrings of the operators.
QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p5_found": p5_found}

_LATEST = """
WITH latest AS (
  SELECT uprn, x, y FROM (
    SELECT uprn, x_27700 AS x, y_27700 AS y,
           row_number() OVER (PARTITION BY uprn ORDER BY loaded_at DESC NULLS LAST, x_27700 DESC NULLS LAST, y_27700 DESC NULLS LAST) AS rn
    FROM osopenuprn_address WHERE uprn IS NOT NULL)
  WHERE rn = 1 AND x IS NOT NULL AND y IS NOT NULL AND NOT (x = 0 AND y = 0))
"""

#: The text form of a field with its quotes: tokens, then bare ids.
_SPLIT = """
SELECT src, row_id, idx AS pos, item FROM (
  SELECT src, row_id, unnest(items) AS item, generate_subscripts(items, 1) AS idx FROM (
    SELECT src, row_id, flatten(list_transform(
      regexp_extract_all(packed, '"[^"]*"|''[^'']*''|[0-9]+(?:\\.0+)?'),
      lambda t: CASE WHEN regexp_full_match(regexp_replace(t, '^["'']|["'']$', '', 'g'), '[\\s\\x{00A0}|,;/&.\\[\\](){}0-9]*')
                THEN regexp_extract_all(regexp_replace(t, '\\.0+\\b', '', 'g'), '[0-9]+')
                WHEN lower(trim(regexp_replace(t, '^["'']|["'']$', '', 'g'))) IN ('nan','none','null','nil','n/a','na','nothing','-','--','?','unknown','empty') THEN []
                ELSE [trim(regexp_replace(t, '^["'']|["'']$', '', 'g'))] END)) AS items
    FROM ({union}) WHERE packed IS NOT NULL))
"""

_P2_UNION = " UNION ALL ".join(
    f"SELECT '{src}' AS src, CAST({key} AS BIGINT) AS row_id, {field} AS packed FROM {name}" for src, name, key, field in PACKED_FIELDS
)

ORACLES = {
    "p2_found": "SELECT DISTINCT src, row_id, CAST(pos AS INTEGER) AS pos, item FROM (" + _SPLIT.replace("{union}", _P2_UNION) + ")",
    "p5_found": """
WITH live AS (
  SELECT source_fid AS fid, min(loaded_at) AS born, max(deleted_at) AS died FROM prediction_source_polygons WHERE source_fid IS NOT NULL GROUP BY 1
  UNION ALL SELECT source_fid, TIMESTAMP '0001-01-01', NULL FROM untiled_source_polygons),
refs AS (
  SELECT 'edge' AS src, edge_id AS row_id, left_source_fid AS fid, scored_at AS ts FROM edge_candidate_predictions_full
  UNION ALL SELECT 'edge', edge_id, right_source_fid, scored_at FROM edge_candidate_predictions_full
  UNION ALL SELECT 'council', train_component_id, CAST(unnest(regexp_extract_all(regexp_replace(target_source_fids, '\\.0+\\b', '', 'g'), '[0-9]+')) AS BIGINT), built_at
            FROM wfs_raw_merged_council_train_merged_only),
firsts AS (SELECT source_fid, min(loaded_at) AS ts FROM prediction_source_polygons GROUP BY 1)
SELECT DISTINCT src, strftime(ts, '%Y-%m') AS ref_month, row_id, fid FROM refs
WHERE fid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM live WHERE live.fid = refs.fid AND live.born <= refs.ts AND (live.died IS NULL OR refs.ts < live.died))
UNION ALL
SELECT DISTINCT 'source', strftime(f.ts, '%Y-%m'), p.source_fid, p.pred_component_id
FROM prediction_source_polygons p JOIN firsts f ON p.source_fid = f.source_fid
WHERE p.pred_component_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM predicted_parcels_with_uprn q WHERE q.pred_component_id = p.pred_component_id)
""",
}
