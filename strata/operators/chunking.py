"""Paragraph chunks of report texts, their ids, and ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators import extract
from strata.util import falsy, strip

MAX_CHARS, MIN_CHARS = 1400, 200
_GAP = r"(?U)\n\s*\n+"


def chunks(text: Column, most: int = MAX_CHARS, least: int = MIN_CHARS) -> Column:
    """The chunks of a text: paragraphs put together up to `most` characters, blank lines between them not counted.

    A text below `least` is one chunk. Blocks below `least` are left out; if that leaves nothing, the first paragraph
    stands. Every chunk is cut to 1400 characters; a greater `most` raises, as it would lose text. Null has no chunks.
    """
    if most > MAX_CHARS:
        raise ValueError(f"chunks hold {MAX_CHARS} characters at most")
    clean = strip(text)
    raw = F.split(clean, _GAP)
    paragraphs = F.filter(F.transform(raw, lambda p: strip(p)), lambda p: p != "")
    block = lambda parts: F.array_join(parts, "\n\n")
    add = lambda out, parts: F.when(F.length(block(parts)) >= least, F.array_append(out, block(parts))).otherwise(out)
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("out"), none.alias("cur"), F.lit(0).alias("n"))

    def step(s: Column, p: Column) -> Column:
        full = (s["n"] + F.length(p) > most) & (F.size(s["cur"]) > 0)
        return F.struct(
            F.when(full, add(s["out"], s["cur"])).otherwise(s["out"]).alias("out"),
            F.when(full, F.array(p)).otherwise(F.array_append(s["cur"], p)).alias("cur"), F.when(full, F.length(p)).otherwise(s["n"] + F.length(p)).alias("n"),
        )

    merged = F.aggregate(paragraphs, start, step, lambda s: F.when(F.size(s["cur"]) > 0, add(s["out"], s["cur"])).otherwise(s["out"]))
    kept = F.when(F.size(merged) > 0, merged).otherwise(F.slice(raw, 1, 1))
    return F.transform(F.when(F.length(clean) < least, F.array(clean)).otherwise(kept), lambda c: F.left(c, F.lit(MAX_CHARS)))


def chunk_id(jurisdiction: Column, code: Column, source_url: Column, report_id: Column, index: Column) -> Column:
    """32 hexadecimal digits from where a chunk stands; its text has no part in it. Nulls are empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.left(F.sha2(F.concat_ws(":", text(jurisdiction), text(code), falsy(source_url, text(report_id)), text(index)), 256), F.lit(32))


def chunked(docs: DataFrame, text: str = "text", **limits: int) -> DataFrame:
    """The documents' rows, one for each chunk, with chunk_index from 0 and chunk; documents without text have none."""
    keep = [c for c in docs.columns if c not in (text, "chunk_index", "chunk")]
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.posexplode(chunks(F.col(text), **limits)).alias("chunk_index", "chunk"))


def without_repeats(rows: DataFrame, keys: list[str], text: str = "chunk") -> DataFrame:
    """Of equal texts of a document the one with the least chunk_index; indices keep their gaps."""
    w = Window.partitionBy(*keys, F.sha2(F.col(text), 256)).orderBy("chunk_index")
    return rows.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def lost_characters(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, characters, kept): visible characters of each document and of its chunks; short blocks and ends of long ones are lost."""
    seen = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", ""))
    kept = F.aggregate(F.coalesce(chunks(F.col(text)), F.array().cast("array<string>")), F.lit(0), lambda n, c: n + seen(c))
    return docs.select(*keys, seen(F.col(text)).alias("characters"), kept.alias("kept"))


def record(row_id: Column, text: Column, own: dict[str, Column], extra: Column) -> Column:
    """A chunk as a flat record (id, text, metadata map): what `extra` names overrides the chunk's own fields; nulls are left out.

    A null `extra` names nothing; a key that it gives a null value is left out.
    """
    more = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    mine = F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v.cast("string"))])
    merged = F.map_concat(F.map_filter(mine, lambda k, _: ~F.map_contains_key(more, k)), more)
    return F.struct(row_id.alias("id"), text.alias("text"), F.map_filter(merged, lambda _, v: v.isNotNull()).alias("metadata"))


def ingest(docs: DataFrame, text: str = "text", metadata: str | None = None) -> DataFrame:
    """Chunk records of documents (jurisdiction, source_code, report_id, source_url, text) with their metadata.

    (id, text, jurisdiction, source_code, report_id, source_url, doc_type, commodity, company, nts_sheet, chunk_index).
    `metadata` names a column of map<string,string> whose values override what is found, under the names above.
    """
    given = F.col(metadata) if metadata else F.lit(None).cast("map<string,string>")
    own = [F.coalesce(F.try_element_at(given, F.lit(c)), F.col(c)).alias(c) for c in ("jurisdiction", "source_code", "report_id", "source_url")]
    described = extract.metadata(docs.select(*own, given.alias("__given"), F.col(text).alias("text")), "text")
    described = described.select(
        "jurisdiction", "source_code", "report_id", "source_url", "text",
        *[F.coalesce(F.try_element_at("__given", F.lit(c)), found).alias(c) for c, found in (("doc_type", F.col("report_type")), ("commodity", F.to_json("commodities")), ("company", F.col("company")), ("nts_sheet", F.col("nts_sheet")))],
    )
    rows = without_repeats(chunked(described), ["jurisdiction", "source_code", "report_id", "source_url"])
    return rows.select(
        chunk_id(F.col("jurisdiction"), F.col("source_code"), F.col("source_url"), F.col("report_id"), F.col("chunk_index")).alias("id"), F.col("chunk").alias("text"),
        "jurisdiction", "source_code", "report_id", "source_url", "doc_type", "commodity", "company", "nts_sheet", "chunk_index",
    )


def counters(docs: DataFrame, records: DataFrame | None, key: str = "report_id", failed: Column | None = None) -> DataFrame:
    """(total, ingested, failed, skipped, chunks) of an ingestion: documents with chunks are ingested, those that `failed` tells of failed, others skipped.

    Without records it is a dry run, which counts all documents as ingested and makes no chunks.
    """
    rows = docs.groupBy(key).agg(F.bool_or(failed if failed is not None else F.lit(False)).alias("bad"))
    if records is None:
        rows = rows.select(F.lit(1).alias("n"), F.lit(0).alias("chunks"), F.lit(False).alias("bad"))
    else:
        made = records.groupBy(key).agg(F.count("*").alias("n"))
        rows = rows.join(made, key, "left").select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n", F.lit(0)).alias("chunks"), F.coalesce("bad", F.lit(False)).alias("bad"))
    none = F.col("n") == 0
    return rows.agg(
        F.count("*").alias("total"), F.count_if(~none).alias("ingested"), F.count_if(none & F.col("bad")).alias("failed"), F.count_if(none & ~F.col("bad")).alias("skipped"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks")
    )
