"""Cutting oversized texts into overlapping pieces at natural boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.util import running_total

#: The kinds of boundaries, the strongest first.
LEVELS = ("paragraph", "sentence", "word", "none")
#: What follows or precedes the end of a unit of each level but the last, which needs nothing.
_ENDS = (r"(?<=\S)(?=\s|\z)(?=\s*\n\s*\n|\s*\z)", r"(?<=[.!?])(?=\s)", r"(?<=\S)(?=\s)")


def _parts(text: Column, limit: Column, gaps: bool, one: bool = False) -> Column:
    """A text in parts of at most `limit` characters, cut by one regular expression.

    Its alternatives are in the order of the strength of the boundary they end at, each takes as many characters as it can,
    and the last takes any characters. A part ends with its unit: the white space after it begins the next part, where it is
    counted, or with gaps=False is not. one=True: only the first part, as a text.
    """
    n = F.concat(F.lit(".{1,"), limit.cast("string"), F.lit("}"))
    ways: list[Column] = [n, F.lit(r"\z")] if gaps else []
    for end in _ENDS:
        ways += [F.lit("|")] * bool(ways) + [n, F.lit(end)]
    pattern = F.concat(F.lit("(?sU)(?:" if gaps else r"(?sU)\s*+(?:"), *ways, F.lit("|"), n, F.lit(")"))
    return F.call_function("regexp_extract", text, pattern, F.lit(0)) if one else F.regexp_extract_all(text, pattern, F.lit(0))


def _cuts(parts: Column) -> Column:
    """The boundary at the end of each part; 'end' for the last."""
    after = lambda i: F.regexp_extract(F.get(parts, i + 1), r"(?U)\A\s*", 0)
    kind = lambda p, gap: F.when(gap.rlike(r"\n(?U:\s*)\n"), LEVELS[0]).when((gap != "") & p.rlike(r"[.!?]\z"), LEVELS[1]).when((gap != "") | p.rlike(r"(?U)\s\z"), LEVELS[2]).otherwise(LEVELS[3])
    return F.transform(parts, lambda p, i: F.when(i == F.size(parts) - 1, "end").otherwise(kind(p, after(i))))


def _limited(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """(id, doc_type, report_id, chunk_index, created_at, chunk_text, __m, __o, oversized): rows with the limit and overlap of their doc_type."""
    limits = limits.where("doc_type IS NOT NULL AND max_chars > 0").groupBy("doc_type").agg(F.min(F.struct(F.col("max_chars").alias("m"), F.greatest(F.coalesce("overlap_chars", F.lit(0)), F.lit(0)).alias("o"))).alias("__l"))
    rows = chunks.select("id", "doc_type", "report_id", "chunk_index", "created_at", "chunk_text").join(limits, "doc_type", "left")
    m = F.col("__l.m")
    rows = rows.withColumns({"__m": m, "__o": F.least(F.col("__l.o"), F.floor(m / 2).cast("int")), "oversized": F.coalesce(F.length("chunk_text") > m, F.lit(False))})
    return rows.drop("__l")


def _boundary() -> Column:
    """The strongest level of which all units fit the limit: the weakest boundary at which the parts are cut, white space aside."""
    return F.transform(F.array(_cuts(_parts(F.col("chunk_text"), F.col("__m"), gaps=False))), _weakest)[0]


def _weakest(cuts: Column) -> Column:
    out = F.lit(LEVELS[0])
    for level in LEVELS[1:]:
        out = F.when(F.array_contains(cuts, level), level).otherwise(out)
    return out


def oversized(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """(id, boundary) of every id whose text is longer than the max_chars of its doc_type; of a repeated id the row created last counts.

    boundary is the weakest at which the text is cut if white space between units isn't counted: the strongest level of which
    all units fit the limit. Null texts, and doc_types without a positive limit, are never too long.
    """
    over = _limited(chunks, limits).where("oversized").select("id", "created_at", _boundary().alias("boundary"))
    return over.groupBy("id").agg(F.max_by("boundary", F.struct("created_at", "boundary")).alias("boundary"))


def split_oversized(chunks: DataFrame, limits: DataFrame, block: int = 512) -> DataFrame:
    """Every chunk's pieces, numbered through the report: (id, report_id, doc_type, piece_no, chunk_index, text, cut, boundary).

    A text longer than the max_chars of its doc_type is cut into pieces within the limit; every piece but the first begins with
    the last overlap_chars characters of what came before it, and without these the pieces put together are the text. cut is
    the boundary at the piece's end ('end' for the last), boundary that of oversized(). Any other text is one piece, itself.
    An overlap of more than half the limit is taken as half of it; a null one as 0. If limits repeat a doc_type, its smallest
    limit holds. chunk_index counts the pieces of a report from 0 in the order of the stored chunk_index (null last), then id.
    A row without report_id is a report of its own. Of a repeated id within a report the row created last counts.

    Texts are cut once; the lengths of their parts are numbered, in blocks of `block` stored indices so that no report is one
    task, and meet the texts by a hash of the row: each text is moved once.
    """
    rows = _limited(chunks, limits).withColumn("__h", F.xxhash64("id", "doc_type", "report_id", "chunk_index", "created_at", "chunk_text"))
    report = F.coalesce(F.concat(F.lit("r"), F.nullif(F.col("report_id"), F.lit(""))), F.concat(F.lit("i"), F.col("id")), F.concat(F.lit("h"), F.col("__h").cast("string")))
    text, m, o, over = F.col("chunk_text"), F.col("__m"), F.col("__o"), F.col("oversized")
    parts = F.col("__parts")
    rows_cut = rows.withColumn("__first", F.when(over, _parts(text, m, gaps=True, one=True)))
    rows_cut = rows_cut.withColumn("__parts", F.when(over, F.array_prepend(_parts(F.substr(text, F.length("__first") + 1), m - o, gaps=True), F.col("__first"))))
    light = rows_cut.select(
        report.alias("__report"), "id", "created_at", "chunk_index", "__h", F.when(over, F.size(parts)).otherwise(1).alias("__n"),
        F.transform(parts, lambda p: F.length(p)).alias("__sizes"), F.when(over, _cuts(parts)).alias("__cuts"), F.when(over, _boundary()).alias("boundary"),
    )
    kept = F.struct("created_at", "__n", "__h", "chunk_index", "__sizes", "__cuts", "boundary")
    light = light.groupBy("__report", "id").agg(F.max(kept).alias("k")).select("__report", "id", "k.*")
    # Rows without index come last, in blocks of the first characters of their ids.
    light = light.withColumn("__block", F.struct(F.coalesce(F.floor(F.col("chunk_index") / block), F.lit(2**31)), F.when(F.col("chunk_index").isNull(), F.coalesce(F.left("id", F.lit(4)), F.lit("")))))
    order = [F.asc_nulls_last("chunk_index"), F.col("id"), F.col("__h")]
    numbered = running_total(light, ["__report"], order, F.col("__n"), F.col("__block"), "__at").select("__h", "__n", "__at", "__sizes", "__cuts", "boundary")
    same = Window.partitionBy("__h").orderBy("__h")
    texts = rows.select("__h", "id", "report_id", "doc_type", "chunk_text", "__o", F.row_number().over(same).alias("__k")).where("__k = 1")
    placed = texts.join(numbered, "__h").select("*", F.posexplode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("piece_no", "__i")).drop("__i")
    start = F.aggregate(F.slice("__sizes", F.lit(1), F.col("piece_no")), F.lit(0), lambda a, x: a + x)
    back = F.least(F.col("__o"), F.col("__start"))
    placed = placed.withColumn("__start", start)
    piece = F.when(F.col("__sizes").isNull(), text).otherwise(F.substr(text, F.col("__start") - back + 1, back + F.get("__sizes", F.col("piece_no"))))
    return placed.select(
        "id", "report_id", "doc_type", "piece_no", (F.col("__at") + F.col("piece_no")).cast("long").alias("chunk_index"), piece.alias("text"),
        F.coalesce(F.get("__cuts", F.col("piece_no")), F.lit("end")).alias("cut"), "boundary",
    )
