"""Full-text search: tokens, an inverted index, BM25 ranking."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The usual parameters of BM25.
K, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    """Runs of letters and digits in lower case; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}0-9]+"), lambda t: t != "")


def postings(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, term, tf): the inverted index; counts are partial before the shuffle."""
    return docs.select(*keys, F.explode(tokens(F.col(text))).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, query: str, keys: Sequence[str], text: str = "text", limit: int | None = 50) -> DataFrame:
    """(keys, text, score) of the documents that hold any term of the query, the best first; equal scores by key.

    One pass counts documents, lengths and each term's documents; a second scores where a document stands, so no index and
    no shuffle of the texts is needed. Repeated documents count as often as they stand. A query without terms has no hits.
    """
    spark = docs.sparkSession
    terms = sorted({r["t"] for r in spark.createDataFrame([(query,)], "q string").select(F.explode(tokens(F.col("q"))).alias("t")).collect()})
    words = docs.select(*keys, F.col(text).alias("text"), tokens(F.col(text)).alias("__w"))
    counted = words.select(*keys, "text", F.size("__w").alias("__dl"), *[F.size(F.filter("__w", _is(t))).alias(f"__tf{i}") for i, t in enumerate(terms)])
    stats = counted.agg(F.count("*").alias("n"), F.avg("__dl").alias("avg"), *[F.count_if(F.col(f"__tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))]).head()
    score, n, avg = F.lit(0.0), stats["n"], stats["avg"] or 1.0
    for i in range(len(terms)):
        df, tf = stats[f"df{i}"], F.col(f"__tf{i}").cast("double")
        idf = F.ln(F.lit(1.0 + (n - df + 0.5) / (df + 0.5)))
        score = score + idf * tf * (K + 1) / (tf + K * (1 - B + B * F.col("__dl") / avg))
    hit = F.lit(False)
    for i in range(len(terms)):
        hit = hit | (F.col(f"__tf{i}") > 0)
    out = counted.where(hit).select(*keys, "text", F.round(score, 6).alias("score"))
    return out.orderBy(F.desc("score"), *keys).limit(limit) if limit else out


#: Folders of a stored index, by the hash of the term: a query reads those of its terms.
FOLDERS = 64


def write_index(docs: DataFrame, keys: Sequence[str], path: str, text: str = "text", folders: int = FOLDERS, analyze: Callable[[Column], Column] = tokens) -> None:
    """Stores an inverted index: path/postings (term, keys, tf, dl) in folders by term, sorted by it, and path/stats (n, avg).

    One shuffle counts terms by document, one brings those of a folder together; documents without terms count in the stats.
    A folder too large for one task, as of a term that stands everywhere, is split by its size into several files. `analyze` makes terms of a text: tokens(), or
    english.terms() for stems without accents and common words; a query must be read in the same way.
    """
    words = docs.select(*keys, analyze(F.col(text)).alias("__w"))
    words.agg(F.count("*").alias("n"), F.avg(F.size("__w")).alias("avg")).write.mode("overwrite").parquet(f"{path}/stats")
    found = words.select(*keys, F.size("__w").alias("dl"), F.explode("__w").alias("term")).groupBy(*keys, "dl", "term").agg(F.count("*").cast("int").alias("tf"))
    found = found.withColumn("folder", _folder(F.col("term"), folders))
    found = found.hint("rebalance", "folder").sortWithinPartitions("folder", "term")
    found.write.mode("overwrite").option("parquet.block.size", 16 << 20).partitionBy("folder").parquet(f"{path}/postings")


def _folder(term: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(folders)).cast("int")


def ranked(spark: SparkSession, path: str, query: str, keys: Sequence[str], limit: int | None = 50, folders: int = FOLDERS, analyze: Callable[[Column], Column] = tokens) -> DataFrame:
    """(keys, score) as bm25() has them, from a stored index: only the folders of the query's terms are read, and in them their rows."""
    few = spark.createDataFrame([(query,)], "q string").select(F.explode(F.array_distinct(analyze(F.col("q")))).alias("term"))
    terms = [(r["term"], r["folder"]) for r in few.select("term", _folder(F.col("term"), folders).alias("folder")).collect()]
    stats = spark.read.parquet(f"{path}/stats").head()
    rows = spark.read.parquet(f"{path}/postings").where(F.col("folder").isin(sorted({f for _, f in terms})) & F.col("term").isin(sorted(t for t, _ in terms)))
    counted = {r["term"]: r["df"] for r in rows.groupBy("term").agg(F.count("*").alias("df")).collect()}  # a row for each term of the query
    idf = F.lit(0.0)
    for term, df in counted.items():
        idf = F.when(F.col("term") == term, math.log(1.0 + (stats["n"] - df + 0.5) / (df + 0.5))).otherwise(idf)
    tf = F.col("tf").cast("double")
    score = idf * tf * (K + 1) / (tf + K * (1 - B + B * F.col("dl") / (stats["avg"] or 1.0)))
    out = rows.groupBy(*keys).agg(F.round(F.sum(score), 6).alias("score"))
    return out.orderBy(F.desc("score"), *keys).limit(limit) if limit else out


def _is(term: str):  # noqa: ANN202
    return lambda t: t == term
