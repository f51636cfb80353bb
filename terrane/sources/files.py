"""Point files, GeoJSON, candidate files and layer directories.

A layer is a directory of Parquet below a root; rewriting some layers leaves the others alone, and
the commit protocol of Spark makes each rewrite atomic."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrane.operators.selection import numbered
from terrane.session import listing

#: Names under which coordinates are looked for, in this order.
X_NAMES = ("x_27700", "x", "easting", "eastings", "x_coord", "lon", "longitude", "long")
Y_NAMES = ("y_27700", "y", "northing", "northings", "y_coord", "lat", "latitude", "lat_dd")


def read_points(spark: SparkSession, path: str, x: str | None = None, y: str | None = None) -> DataFrame:
    """(x, y, ...) from CSV, JSON lines, GeoJSON or Parquet; rows without finite numbers are left out."""
    kind = os.path.splitext(path)[1].lower()
    if kind == ".geojson":
        g = read_geojson(spark, path).where("geometry.type = 'Point'")
        rows = g.select(F.get_json_object("coordinates", "$[0]").alias("x"), F.get_json_object("coordinates", "$[1]").alias("y"), "properties")
        return _finite(rows, "x", "y")
    readers = {".csv": lambda: spark.read.csv(path, header=True), ".json": lambda: spark.read.json(path), ".parquet": lambda: spark.read.parquet(path)}
    if kind not in readers:
        raise ValueError(f"cannot read points from {kind}")
    df = readers[kind]()
    lower = {c.lower(): c for c in df.columns}
    px = x or next((lower[n] for n in X_NAMES if n in lower), None)
    py = y or next((lower[n] for n in Y_NAMES if n in lower), None)
    if not px or not py:
        raise ValueError(f"no coordinate columns among {df.columns}")
    rest = [c for c in df.columns if c not in (px, py) and c.lower() not in ("x", "y")]
    return _finite(df.select(F.col(px).alias("x"), F.col(py).alias("y"), *rest), "x", "y")


def _finite(df: DataFrame, *names: str) -> DataFrame:
    out = df.withColumns({n: F.col(n).cast("string").try_cast("double") for n in names})
    ok = [F.col(n).isNotNull() & ~F.isnan(n) & (F.abs(n) != float("inf")) for n in names]
    return out.where(reduce(lambda a, b: a & b, ok))


_FEATURES = "struct<features:array<struct<id:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>>"


def features_of(text: Column) -> Column:
    """array of features (id, geometry type, raw coordinates, properties) of a FeatureCollection text."""
    return F.from_json(text, _FEATURES)["features"]


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(id, geometry, coordinates, properties, page): one row per feature of whole-file collections."""
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page"), F.explode(features_of(F.col("value"))).alias("f"))
    return pages.select("f.id", "f.geometry", F.col("f.geometry.coordinates").alias("coordinates"), "f.properties", "page")


def geojson_line(x: Column, y: Column, properties: Column) -> Column:
    """A point feature as text."""
    return F.to_json(F.named_struct(F.lit("type"), F.lit("Feature"), F.lit("geometry"), F.named_struct(F.lit("type"), F.lit("Point"), F.lit("coordinates"), F.array(x, y)), F.lit("properties"), properties))


def write_geojson(df: DataFrame, path: str, x: str = "x", y: str = "y") -> None:
    """One feature a line, written by all tasks."""
    rest = F.struct(*[c for c in df.columns if c not in (x, y)]) if len(df.columns) > 2 else F.struct(F.lit(0).alias("n"))
    df.select(geojson_line(F.col(x), F.col(y), rest).alias("value")).write.mode("overwrite").text(path)


def read_candidates(spark: SparkSession, sources: str, schema: StructType | str) -> DataFrame:
    """CSV files from a comma list of files, folders and patterns; each file once, with a declared schema."""
    found: list[str] = []
    for part in (p.strip() for p in sources.split(",")):
        if part:
            names = [name for name, _, _ in listing(spark, part)]
            found += names if len(names) == 1 else [n for n in names if n.endswith((".csv", ".csv.gz"))] or [part]
    return spark.read.csv(list(dict.fromkeys(found)), header=True, schema=schema)


def optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table, or an empty one of the same type where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_box(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose envelope meets a box; the comparisons reach the Parquet scan."""
    return df.where((F.col("xmax") >= xmin) & (F.col("xmin") <= xmax) & (F.col("ymax") >= ymin) & (F.col("ymin") <= ymax))


def seed_polygon(df: DataFrame, x: float, y: float) -> DataFrame:
    """The smallest box that holds a point."""
    return read_box(df, x, y, x, y).orderBy("area", "clean_fid").limit(1)


def write_layers(root: str, layers: dict[str, DataFrame]) -> None:
    """Replace the given layers below a root; nested columns are kept, as Parquet holds them."""
    for name, df in layers.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for formats without nesting."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])


def stable_ids(new: DataFrame, old: DataFrame, key: str, fid: str) -> DataFrame:
    """``new`` with the ids of ``old`` (key, fid); unseen rows are numbered on from the greatest id by key.

    Only unseen rows pass through the numbering: they are counted per range of keys first, so no single task sorts all."""
    known = new.join(old.select(key, fid), key, "left")
    top = old.agg(F.coalesce(F.max(fid), F.lit(0)).alias("top")).first()["top"]
    fresh = known.where(F.col(fid).isNull()).drop(fid)
    fresh = numbered(fresh, [key], fid).withColumn(fid, (F.col(fid) + F.lit(top) + 1).cast("bigint"))
    return known.where(F.col(fid).isNotNull()).unionByName(fresh)


def error_cases(df: DataFrame, split: str, label: str, proba: str, key: str, n: int) -> DataFrame:
    """The ``n`` worst false positives and false negatives of each split at 0.5."""
    kind = F.when((F.col(label) == 0) & (F.col(proba) >= 0.5), "false_positive").when((F.col(label) == 1) & (F.col(proba) < 0.5), "false_negative")
    worst = F.abs(F.col(proba) - F.col(label))
    w = Window.partitionBy(split, "case").orderBy(F.desc("error"), key)
    return df.withColumn("case", kind).where("case is not null").withColumn("error", worst).withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
