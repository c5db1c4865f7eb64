"""Scalar functions of the lake, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.util import falsy, strip

#: Formats that the small harvest keeps.
CORE_FORMATS = ("shp", "zip", "csv", "tsv", "xlsx", "xls", "kml", "kmz", "geojson", "gpkg", "json", "fgdb", "gdb", "tif", "tiff", "gpx")
#: Context lengths that an embedder falls back to, the longest first.
LADDER = (1400, 1200, 1000, 800, 600, 400)


def format_norm(c: Column | str) -> Column:
    """A format in lower case without outer white space and leading dots; null becomes ''."""
    return F.regexp_replace(F.lower(strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))), r"^\.+", "")


def label(title: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The code of the first rule of which the title contains a needle, in any case; null if there is none."""
    low, out = F.lower(F.coalesce(title, F.lit(""))), F.lit(None).cast("string")
    for code, needles in reversed(rules):
        hit = F.lit(False)
        for needle in needles:
            hit = hit | low.contains(needle.lower())
        out = F.when(hit, code).otherwise(out)
    return out


def layer_name(jurisdiction: Column, code: Column, stem: Column) -> Column:
    """jurisdiction__code__stem with blanks and hyphens as underscores, cut to 62 characters."""
    return F.left(F.translate(F.concat_ws("__", jurisdiction, code, stem), " -", "__"), F.lit(62))


def stem(path: Column) -> Column:
    """The last part of a path without its suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]+$", "")


def raw_filename(resource_name: Column, resource_id: Column, fmt: Column) -> Column:
    """The name a downloaded file gets: slashes become underscores, a name without suffix gets the format, or .dat."""
    base = F.translate(falsy(resource_name, resource_id, F.lit("data")), "/", "_")
    suffixed = base.rlike(r"[^.]\.[^.]+$") | base.rlike(r"^\.+[^.]+\.[^.]+$")
    return F.when(suffixed, base).otherwise(F.concat(base, F.lit("."), falsy(format_norm(fmt), F.lit("dat"))))


def scalar_map(values: dict[str, Column], complex_keys: Sequence[str] = ()) -> Column:
    """A map of text from columns: nulls are left out, complex values become JSON, others text."""
    pairs: list[Column] = []
    for key, value in values.items():
        pairs += [F.lit(key), F.to_json(value) if key in complex_keys else value.cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def ladder(text: Column, limit: int) -> Column:
    """The text cut to the first length of LADDER that is within the limit; the last if none is."""
    rung = next((n for n in LADDER if n <= limit), LADDER[-1])
    return F.left(text, F.lit(rung))


def content_hash(content: Column) -> Column:
    """(sha256, size_bytes) of a text in UTF-8, or of bytes."""
    return F.struct(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("size_bytes"))


def megabytes(size: Column) -> Column:
    """A size in bytes as reports show it: megabytes with one digit, a question mark if it is unknown or 0."""
    return F.when(F.coalesce(size, F.lit(0)) != 0, F.format_string("%.1fMB", size / 1e6)).otherwise("?")


def jurisdiction_of(code: Column) -> Column:
    """The jurisdiction that a code of scraped reports begins with."""
    return F.split_part(code, F.lit("_"), F.lit(1))


def l2_normalize(v: Column) -> Column:
    """A vector of length one; a zero or empty vector stays as it is, null stays null."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm)).otherwise(F.transform(v, lambda x: x.cast("double")))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
