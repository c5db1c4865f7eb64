"""Shapefiles: geometries (.shp), attributes (.dbf) and the coordinate system (.prj) of one stem, put together."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

_LAND = {1: "Point", 3: "LineString", 5: "Polygon", 8: "MultiPoint"}


def wgs84(prj: bytes | None) -> bool:
    """Whether a .prj names geographic coordinates of WGS 84, or of NAD 83, which differs by less than two metres; a missing one does."""
    text = re.sub(r"[\s_]", "", (prj or b"").decode("latin-1")).upper()
    return not text or text.startswith("GEOGCS") and ("WGS1984" in text or "WGS84" in text or "NORTHAMERICAN1983" in text or "NAD83" in text)


def records(dbf: bytes | None) -> Iterator[dict[str, str | None] | None]:
    """The records of a .dbf as text, blank values as null; None for a deleted one."""
    if not dbf:
        return
    count, start, width = struct.unpack_from("<IHH", dbf, 4)
    fields, at, offset = [], 32, 1
    while dbf[at] != 0x0D:
        name, size = dbf[at : at + 11].split(b"\0")[0].decode("latin-1"), dbf[at + 16]
        fields.append((name, offset, offset + size))
        at, offset = at + 32, offset + size
    for k in range(count):
        row = dbf[start + k * width : start + (k + 1) * width]
        yield None if row[:1] == b"*" else {n: row[a:b].decode("latin-1").strip(" \0") or None for n, a, b in fields}


def _inside(point: list[float], ring: list[list[float]]) -> bool:
    x, y = point
    hit = False
    for (a, b), (c, d) in zip(ring, ring[1:]):
        if (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a:
            hit = not hit
    return hit


def _clockwise(ring: list[list[float]]) -> bool:
    return sum((c - a) * (d + b) for (a, b), (c, d) in zip(ring, ring[1:])) >= 0


def _polygon(rings: list[list[list[float]]]) -> dict:
    """Outer rings run clockwise; a hole belongs to the outer ring that holds its first point, else it stands by itself."""
    outer = [[r] for r in rings if _clockwise(r)]
    for hole in (r for r in rings if not _clockwise(r)):
        home = next((p for p in outer if _inside(hole[0], p[0])), None)
        if home is None:
            outer.append([hole])
        else:
            home.append(hole)
    return {"type": "Polygon", "coordinates": outer[0]} if len(outer) == 1 else {"type": "MultiPolygon", "coordinates": outer}


def geometries(shp: bytes) -> Iterator[dict | None]:
    """The geometries of a .shp without heights and measures, None for a null shape."""
    if struct.unpack_from(">i", shp, 0)[0] != 9994:
        raise ValueError("no shapefile")
    at = 100
    while at + 8 <= len(shp):
        size = struct.unpack_from(">i", shp, at + 4)[0] * 2
        body, at = shp[at + 8 : at + 8 + size], at + 8 + size
        code = struct.unpack_from("<i", body, 0)[0]
        if code == 0:
            yield None
            continue
        kind = _LAND[code % 10]
        pairs = lambda n, start: [list(struct.unpack_from("<dd", body, start + 16 * k)) for k in range(n)]  # noqa: B023, E731
        if kind == "Point":
            yield {"type": kind, "coordinates": pairs(1, 4)[0]}
        elif kind == "MultiPoint":
            yield {"type": kind, "coordinates": pairs(struct.unpack_from("<i", body, 36)[0], 40)}
        else:
            n_parts, n = struct.unpack_from("<ii", body, 36)
            starts = [*struct.unpack_from(f"<{n_parts}i", body, 44), n]
            points = pairs(n, 44 + 4 * n_parts)
            parts = [points[a:b] for a, b in zip(starts, starts[1:])]
            if kind == "Polygon":
                yield _polygon(parts)
            else:
                yield {"type": kind, "coordinates": parts[0]} if len(parts) == 1 else {"type": "MultiLineString", "coordinates": parts}


def read(shp: bytes, dbf: bytes | None, prj: bytes | None) -> Iterator[tuple[str, dict, dict | None]]:
    """(layer, properties, geometry) of each record that isn't deleted; coordinates of another system raise."""
    if not wgs84(prj):
        raise ValueError("coordinates of another system, not WGS 84")
    told = records(dbf)
    for shape in geometries(shp):
        row = next(told, {})
        if row is not None:
            yield "", row, shape
