"""Readers of harvested files: tables, features, archives and report texts."""

from __future__ import annotations

import io
import json
import sqlite3
import struct
import tempfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import content_hash
from strata.sources import shapes

FEATURES = "path string, layer string, properties map<string,string>, geometry string, lon double, lat double"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A .csv or .tsv file: Latin-1, a header, tabs if the suffix is .tsv, types inferred."""
    return spark.read.csv(path, header=True, inferSchema=True, sep="\t" if path.lower().endswith(".tsv") else ",", encoding="ISO-8859-1")


def file_system(path: str):  # noqa: ANN201
    """(file system, path on it) of a local path or an address that pyarrow.fs knows."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def opened(paths: DataFrame) -> DataFrame:
    """(path, content) of the files named by `path`, each read by the task that holds its row; null content if it can't be read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch.path:
                try:
                    system, inner = file_system(path)
                    with system.open_input_stream(inner) as f:
                        data = f.read()
                except OSError:
                    data = None
                yield pd.DataFrame([(path, data)], columns=["path", "content"])

    return paths.select("path").mapInPandas(read, "path string, content binary")


def contents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content, size_bytes, sha256) of the files of a folder and those below it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content", content_hash(F.col("content")).alias("h")).select("path", "content", "h.size_bytes", "h.sha256")


def expand_archives(files: DataFrame) -> DataFrame:
    """(path, content): files as they are, and in place of every .zip what is in it, archives in archives too.

    A broken archive yields one row of its path with null content.
    """

    def members(path: str, data: bytes, depth: int = 0) -> Iterator[tuple[str, bytes | None]]:
        if not path.lower().endswith((".zip", ".kmz")) or depth > 4:
            yield path, data
            return
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for info in z.infolist():
                    if not info.is_dir():
                        yield from members(f"{path.rsplit('.', 1)[0]}/{info.filename}", z.read(info), depth + 1)
        except zipfile.BadZipFile:
            yield path, None

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch.path, batch.content):
                for found in members(path, data):
                    yield pd.DataFrame([found], columns=["path", "content"])

    return files.select("path", "content").mapInPandas(expand, "path string, content binary")


def _geojson(data: bytes) -> Iterator[tuple[str, dict, dict | None]]:
    root = json.loads(data.decode("utf-8-sig"))
    crs = str(((root.get("crs") or {}).get("properties") or {}).get("name") or "CRS84")
    if not crs.endswith(("CRS84", "4326")):
        raise ValueError(f"coordinates of {crs}, not WGS 84")
    for f in root.get("features") or ([root] if root.get("type") == "Feature" else []):
        yield "", f.get("properties") or {}, f.get("geometry")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _line(pairs: list[list[float]]) -> Iterator[dict]:
    if pairs:
        yield {"type": "Point", "coordinates": pairs[0]} if len(pairs) == 1 else {"type": "LineString", "coordinates": pairs}


def _pairs(e: ET.Element) -> list[list[float]]:
    text = " ".join(c.text or "" for c in e.iter() if _local(c.tag) == "coordinates")
    return [[float(x) for x in p.split(",")[:2]] for p in text.split()]


def _shapes(e: ET.Element) -> Iterator[dict]:
    """The single geometries in an element of a .kml or .gpx file, in order."""
    tag = _local(e.tag)
    if tag == "Polygon":
        rings = sorted(((_local(c.tag) == "innerBoundaryIs", _pairs(r)) for c in e for r in c if _local(r.tag) == "LinearRing"), key=lambda x: x[0])
        if any(pairs for _, pairs in rings):
            yield {"type": "Polygon", "coordinates": [pairs for _, pairs in rings if pairs]}
    elif tag in ("Point", "LineString", "LinearRing"):
        yield from _line(_pairs(e))
    elif tag == "Track":
        yield from _line([[float(x) for x in c.text.split()[:2]] for c in e if _local(c.tag) == "coord" and c.text and c.text.strip()])
    elif tag in ("wpt", "rte", "trkseg"):
        yield from _line([[float(p.get("lon")), float(p.get("lat"))] for p in ([e] if tag == "wpt" else e) if _local(p.tag) in ("wpt", "rtept", "trkpt")])
    else:
        for c in e:
            yield from _shapes(c)


def _joined(shapes: list[dict]) -> dict | None:
    """One geometry of single ones: a Multi- one if they are of one type, else a collection."""
    kinds = {s["type"] for s in shapes}
    if len(shapes) < 2:
        return shapes[0] if shapes else None
    return {"type": f"Multi{kinds.pop()}", "coordinates": [s["coordinates"] for s in shapes]} if len(kinds) == 1 else {"type": "GeometryCollection", "geometries": shapes}


def _kml(data: bytes) -> Iterator[tuple[str, dict, dict | None]]:
    for mark in (e for e in ET.fromstring(data).iter() if _local(e.tag) in ("Placemark", "wpt", "rte", "trk")):
        props = {_local(c.tag): (c.text or "").strip() for c in mark if not len(c) and _local(c.tag) not in ("rtept", "trkseg")}
        props |= {d.get("name", ""): "".join(d.itertext()).strip() for d in mark.iter() if _local(d.tag) in ("Data", "SimpleData")}
        yield "", props, _joined(list(_shapes(mark)))


_KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection", 15: "MultiPolygon", 16: "MultiPolygon", 17: "Polygon"}


def _wkb(blob: bytes) -> dict | None:
    """A geometry of well-known binary without heights and measures; null if it has arcs, which GeoJSON doesn't know."""
    at = 0

    def number(order: str) -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(order + "I", blob, at - 4)[0]

    def points(order: str, n: int, width: int) -> list[list[float]]:
        nonlocal at
        flat = struct.unpack_from(f"{order}{n * width}d", blob, at)
        at += 8 * n * width
        return [list(flat[k : k + 2]) for k in range(0, n * width, width)]

    def shape() -> dict:
        nonlocal at
        order = "<" if blob[at : at + 1] == b"\x01" else ">"
        at += 1
        code = number(order)
        if code & 0x20000000:  # the extended form: flags for height, measure and reference system
            number(order)
        more, kind = divmod(code & 0x0FFFFFFF, 1000)
        name, width = _KINDS[kind], 2 + bool(more in (1, 3) or code & 0x80000000) + bool(more in (2, 3) or code & 0x40000000)
        if name == "Point":
            pair = points(order, 1, width)[0]
            return {"type": name, "coordinates": [] if pair[0] != pair[0] else pair}
        if name == "LineString":
            return {"type": name, "coordinates": points(order, number(order), width)}
        if name == "Polygon":
            return {"type": name, "coordinates": [points(order, number(order), width) for _ in range(number(order))]}
        parts = [shape() for _ in range(number(order))]
        return {"type": name, "geometries": parts} if name == "GeometryCollection" else {"type": name, "coordinates": [p["coordinates"] for p in parts]}

    try:
        return shape()
    except KeyError:
        return None


def _gpkg(data: bytes) -> Iterator[tuple[str, dict, dict | None]]:
    """Every feature layer of a GeoPackage."""
    with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
        f.write(data)
        f.flush()
        db = sqlite3.connect(f.name)
        known = [c[1] for c in db.execute("PRAGMA table_info(gpkg_geometry_columns)")]
        srs = "srs_id" if "srs_id" in known else "4326"
        for layer, column, system in db.execute(f"SELECT table_name, column_name, {srs} FROM gpkg_geometry_columns ORDER BY 1").fetchall():
            if system not in (4326, 0, -1):
                raise ValueError(f"coordinates of system {system}, not WGS 84")
            rows = db.execute(f'SELECT * FROM "{layer}"')
            names = [c[0] for c in rows.description]
            for row in rows:
                props = dict(zip(names, row))
                blob = props.pop(column, None)
                skip = 8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(blob[3] >> 1) & 7] if blob else 0
                yield layer, {k: v for k, v in props.items() if not isinstance(v, bytes)}, _wkb(blob[skip:]) if blob else None
        db.close()


_READERS: dict[str, Callable[[bytes], Iterator[tuple[str, dict, dict | None]]]] = {"geojson": _geojson, "json": _geojson, "kml": _kml, "gpx": _kml, "gpkg": _gpkg}


def features(files: DataFrame, readers: dict | None = None) -> DataFrame:
    """(path, layer, properties, geometry, lon, lat) of the vector files among (path, content); coordinates are WGS 84.

    A shapefile's parts are brought together by their stem. A file that fails has none of its features.

    Formats are told by suffix; other files have no rows, a file that can't be read, or has coordinates of another system, has
    one with null properties. `readers`
    adds formats: suffix to a function from bytes to (layer, properties, geometry).
    """
    known = {**_READERS, **(readers or {})}
    stem, suffix = F.regexp_replace("path", r"\.[^./]+$", ""), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    parts = files.where(suffix.isin("shp", "dbf", "prj")).groupBy(stem.alias("stem")).agg(
        F.max(F.when(suffix == "shp", F.col("path"))).alias("path"), *[F.max_by("content", F.when(suffix == s, F.col("path"))).alias(s) for s in ("shp", "dbf", "prj")]
    )

    def rows_of(path: str, found: Callable[[], Iterator[tuple[str, dict, dict | None]]]) -> list[tuple]:
        rows: list[tuple] = []
        try:
            for layer, props, shape in found():
                at = (shape or {}).get("coordinates") if (shape or {}).get("type") == "Point" else None
                text = {str(k): None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in props.items()}
                rows.append((path, layer, text, json.dumps(shape) if shape else None, float(at[0]) if at else None, float(at[1]) if at else None))
        except (ValueError, KeyError, IndexError, ET.ParseError, sqlite3.Error, struct.error):
            return [(path, "", None, None, None, None)]
        return rows

    columns = ["path", "layer", "properties", "geometry", "lon", "lat"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for path, data in zip(batch.path, batch.content):
                reader = known.get(path.rsplit(".", 1)[-1].lower())
                if reader is not None and data is not None:
                    rows += rows_of(path, lambda: reader(data))  # noqa: B023
            yield pd.DataFrame(rows, columns=columns)

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for path, shp, dbf, prj in zip(batch.path, batch.shp, batch.dbf, batch.prj):
                rows += rows_of(path, lambda: shapes.read(shp, dbf, prj))  # noqa: B023
            yield pd.DataFrame(rows, columns=columns)

    shapefiles = parts.where("shp IS NOT NULL").select("path", "shp", "dbf", "prj").mapInPandas(together, FEATURES)
    return files.mapInPandas(read, FEATURES).unionAll(shapefiles)


def sheets(files: DataFrame) -> DataFrame:
    """(path, row_no, cells): the first sheet of the .xlsx files among (path, content)."""

    def rows_of(data: bytes) -> Iterator[list[str | None]]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
            sheet = next(n for n in sorted(z.namelist()) if n.startswith("xl/worksheets/sheet"))
            for row in (e for e in ET.fromstring(z.read(sheet)).iter() if _local(e.tag) == "row"):
                cells: dict[int, str | None] = {}
                for c in row:
                    column = 0
                    for letter in (x for x in c.get("r", "A") if x.isalpha()):
                        column = column * 26 + ord(letter) - 64
                    value = next(("".join(v.itertext()) for v in c if _local(v.tag) in ("v", "is")), None)
                    cells[column] = shared[int(value)] if c.get("t") == "s" and value is not None else value
                yield [cells.get(k) for k in range(1, max(cells, default=0) + 1)]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(p, k, cells) for p, d in zip(batch.path, batch.content) if d is not None and p.lower().endswith(".xlsx") for k, cells in enumerate(rows_of(d))]
            yield pd.DataFrame(out, columns=["path", "row_no", "cells"])

    return files.mapInPandas(read, "path string, row_no int, cells array<string>")


def report_texts(files: DataFrame, extractor: Callable[[bytes], list[str]]) -> DataFrame:
    """(report_id, path, text, failed): pages that `extractor` finds in each .pdf file, joined by line feeds; null if none or if it fails."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, data in zip(batch.path, batch.content):
                if path.lower().endswith(".pdf"):
                    text, failed = None, data is None
                    try:
                        text = None if failed else "\n".join(extractor(data)).strip() or None
                    except Exception:  # noqa: BLE001 - one unreadable report must not end the others
                        failed = True
                    out.append((path.rsplit("/", 1)[-1].rsplit(".", 1)[0], path, text, failed))
            yield pd.DataFrame(out, columns=["report_id", "path", "text", "failed"])

    return files.mapInPandas(read, "report_id string, path string, text string, failed boolean")


def write_geojson(df: DataFrame, path: str) -> None:
    """Features (properties, geometry JSON) as line-delimited GeoJSON, which every partition writes for itself."""
    kind = F.lit("Feature").alias("type")
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce(F.to_json("properties"), F.lit("{}")), F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    df.select(kind, text.alias("value")).select("value").write.mode("overwrite").text(path)
