"""GeoPackage layers as a Spark data source, and a small export to one.

A layer is read in ranges of its feature id, so large layers spread over tasks. Geometry comes as
WKB (the GeoPackage header is cut off). Options: ``path``, ``layer`` (the first one if not given),
``fid`` (name of the id column), ``bbox`` (xmin,ymin,xmax,ymax against the envelope in the header),
``columns`` (comma list; without ``geom`` the geometry is not read), ``splits``.

Defined results: a missing file or layer raises; null geometry gives null; an empty layer gives no rows.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

_KINDS = {"INTEGER": LongType(), "INT": LongType(), "MEDIUMINT": LongType(), "BIGINT": LongType(), "BOOLEAN": LongType(), "REAL": DoubleType(), "DOUBLE": DoubleType(), "FLOAT": DoubleType(), "BLOB": BinaryType()}
_ENVELOPE = (0, 32, 48, 48, 64)


def wkb_of(blob: bytes | None) -> bytes | None:
    """WKB of a GeoPackage blob; plain WKB is passed on."""
    if blob is None or blob[:2] != b"GP":
        return blob
    return blob[8 + _ENVELOPE[(blob[3] >> 1) & 7] :]


def envelope_of(blob: bytes | None) -> tuple[float, float, float, float] | None:
    """(xmin, ymin, xmax, ymax) from the header, if it holds one."""
    if blob is None or blob[:2] != b"GP" or not (blob[3] >> 1) & 7:
        return None
    order = "<" if blob[3] & 1 else ">"
    xmin, xmax, ymin, ymax = struct.unpack(order + "4d", blob[8:40])
    return xmin, ymin, xmax, ymax


def layers(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]


def layer_info(path: str, layer: str) -> dict[str, object]:
    """Feature count, coordinate system and extent without reading rows."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        n = con.execute(f'SELECT count(*) FROM "{layer}"').fetchone()[0]
        row = con.execute("SELECT srs_id, min_x, min_y, max_x, max_y FROM gpkg_contents WHERE table_name = ?", (layer,)).fetchone()
    return {"features": n, "srs_id": row[0], "extent": row[1:]}


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int) -> None:
        self.lo, self.hi = lo, hi


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.o, self.schema = options, schema
        self.layer, self.key, self.geom, self.names = _layout(options)

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.o['path']}?mode=ro", uri=True) as con:
            lo, hi = con.execute(f'SELECT min("{self.key}"), max("{self.key}") FROM "{self.layer}"').fetchone()
        if lo is None:
            return [_Range(0, -1)]
        n = max(1, int(self.o.get("splits", "8")))
        step = -(-(hi - lo + 1) // n)
        return [_Range(a, min(a + step - 1, hi)) for a in range(lo, hi + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        bbox = [float(v) for v in self.o["bbox"].split(",")] if self.o.get("bbox") else None
        wanted = [n for n in self.schema.names if n not in (self.o.get("fid", "fid"), "geom")]
        cols = [f'"{self.key}"', *([f'"{self.geom}"'] if self.geom else []), *[f'"{n}"' for n in wanted]]
        has_geom = "geom" in self.schema.names
        with sqlite3.connect(f"file:{self.o['path']}?mode=ro", uri=True) as con:
            for row in con.execute(f'SELECT {", ".join(cols)} FROM "{self.layer}" WHERE "{self.key}" BETWEEN ? AND ?', (partition.lo, partition.hi)):
                blob = row[1] if self.geom else None
                if bbox:
                    box = envelope_of(blob)
                    if box and (box[2] < bbox[0] or box[0] > bbox[2] or box[3] < bbox[1] or box[1] > bbox[3]):
                        continue
                rest = dict(zip(wanted, row[1 + bool(self.geom) :], strict=True))
                yield tuple(row[0] if n == self.o.get("fid", "fid") else wkb_of(blob) if n == "geom" and has_geom else rest[n] for n in self.schema.names)


def _layout(options: dict[str, str]) -> tuple[str, str, str | None, list[tuple[str, str]]]:
    path = options["path"]
    names = layers(path)
    layer = options.get("layer") or names[0]
    if layer not in names:
        raise ValueError(f"no layer {layer} in {path}")
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        info = con.execute(f'PRAGMA table_info("{layer}")').fetchall()
        found = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
    key = next((c[1] for c in info if c[5]), "rowid")
    geom = found[0] if found else None
    return layer, key, geom, [(c[1], c[2].split("(")[0].upper()) for c in info if c[1] not in (key, geom)]


class GeoPackageSource(DataSource):
    """``spark.read.format("geopackage").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def schema(self) -> StructType:
        _, _, geom, names = _layout(dict(self.options))
        wanted = [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else None
        fields = [StructField(self.options.get("fid", "fid"), LongType())]
        fields += [StructField(n, _KINDS.get(k, StringType())) for n, k in names if wanted is None or n in wanted]
        if geom and (wanted is None or "geom" in wanted):
            fields.append(StructField("geom", BinaryType()))
        return StructType(fields)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def export_layer(df: DataFrame, path: str, layer: str, key: str, srs_id: int = 27700) -> int:
    """Write rows (key, geom, ...) as a layer of a GeoPackage; rows stream through the driver in key order.

    Meant for hand-over files; large results stay Parquet."""
    types = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "string": "TEXT", "boolean": "INTEGER"}
    rest = [(n, types.get(t, "TEXT")) for n, t in df.dtypes if n not in (key, "geom")]
    with sqlite3.connect(path) as con:
        con.executescript(
            "CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);"
            "CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);"
            f'DROP TABLE IF EXISTS "{layer}";'
        )
        con.execute("DELETE FROM gpkg_contents WHERE table_name = ?", (layer,))
        con.execute("DELETE FROM gpkg_geometry_columns WHERE table_name = ?", (layer,))
        con.execute(f'CREATE TABLE "{layer}" ("{key}" INTEGER PRIMARY KEY, geom BLOB{"".join(f", {chr(34)}{n}{chr(34)} {t}" for n, t in rest)})')
        con.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, NULL, NULL, NULL, NULL, ?)", (layer, layer, srs_id))
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srs_id))
        marks = ", ".join("?" * (2 + len(rest)))
        n = 0
        for row in df.orderBy(key).toLocalIterator():
            blob = None if row["geom"] is None else b"GP\x00\x01" + struct.pack("<i", srs_id) + bytes(row["geom"])
            con.execute(f'INSERT INTO "{layer}" VALUES ({marks})', (row[key], blob, *[row[c] for c, _ in rest]))
            n += 1
    return n
