"""Queries of the operators for training text, and the SQL that gives the same rows where there is such SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import mixing, names, noise, packing, quality, splitting
from strata.util import cut, table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return noise.find_noise(table(spark, folder, "rag_chunk"))


def p1_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """The paragraphs of every chunk without the noise of scanned pages."""
    return noise.repair(table(spark, folder, "rag_chunk"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.oversized(table(spark, folder, "rag_chunk"), table(spark, folder, "chunk_limit"))


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk's pieces, renumbered through its report."""
    return splitting.split_oversized(table(spark, folder, "rag_chunk"), table(spark, folder, "chunk_limit"))


def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the containers of each capacity."""
    return packing.pack(table(spark, folder, "documents"), table(spark, folder, "container_spec"))


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return packing.fill(p6_packed(spark, folder))


def p7_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of each mix with their copies."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_target"))[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares that each mix reaches, against its targets."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_target"))[1]


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.flag(table(spark, folder, "documents"), table(spark, folder, "common_word"))


def p8_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's statistics with their percentiles in its language."""
    return quality.percentiles(cut(quality.statistics(table(spark, folder, "documents"), table(spark, folder, "common_word"))))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.linked_pairs(table(spark, folder, "rag_chunk"))


def p3_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of company that names somebody, with the number of values that name the same."""
    named = cut(names.entities(table(spark, folder, "rag_chunk")))
    return named.join(named.groupBy("entity").agg((F.count("*") - 1).alias("links")), "entity").select("company", "entity", "links")


QUERIES = {
    "p1_found": p1_found, "p1_repaired": p1_repaired, "p2_found": p2_found, "p2_pieces": p2_pieces, "p3_found": p3_found, "p3_entities": p3_entities,
    "p6_packed": p6_packed, "p6_fill": p6_fill, "p7_mixed": p7_mixed, "p7_shares": p7_shares,
    "p8_found": p8_found, "p8_stats": p8_stats,
}

ORACLE = {
    "p2_found": r"""
WITH c AS (
  SELECT id, max_chars AS m, string_split_regex(chunk_text, '\n\s*\n') AS p
  FROM rag_chunk JOIN chunk_limit USING (doc_type) WHERE length(chunk_text) > max_chars),
u AS (
  SELECT id, m, p, flatten(list_transform(p, lambda x: string_split(regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))) AS s,
    flatten(list_transform(p, lambda x: string_split_regex(x, '\s+'))) AS w FROM c)
SELECT DISTINCT id, CASE
  WHEN list_max(list_transform(p, lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')))) <= m THEN 'paragraph'
  WHEN list_max(list_transform(s, lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')))) <= m THEN 'sentence'
  WHEN list_max(list_transform(w, lambda x: length(x))) <= m THEN 'word' ELSE 'none' END AS boundary FROM u"""
}
