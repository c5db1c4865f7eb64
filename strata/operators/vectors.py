"""Vector collections: embedders, upserts, exact nearest neighbours."""

from __future__ import annotations

import hashlib
import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.columns import squared_distance
from strata.sources.files import file_system
from strata.util import cut, scratch

Embedder = Callable[[list[str]], np.ndarray]


def hash_embedder(dim: int = 64) -> Embedder:
    """A deterministic embedder for tests: signed counts of hashed words, of length one; no words give the zero vector."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype="float32")
        for i, text in enumerate(texts):
            for word in (text or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                out[i, h % dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)

    return embed


def remote_embedder(host: str, model: str, timeout: float = 60, send: Callable[[str, dict, float], tuple[int, str]] | None = None) -> Embedder:
    """Vectors of a model served over HTTP (POST host/api/embed). A text too long for the model raises ValueError, any other failure RuntimeError."""

    def post(url: str, body: dict, timeout: float) -> tuple[int, str]:
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, answer.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode(errors="replace")

    def embed(texts: list[str]) -> np.ndarray:
        status, answer = (send or post)(f"{host.rstrip('/')}/api/embed", {"model": model, "input": texts}, timeout)
        if status == 200:
            return np.array(json.loads(answer)["embeddings"], dtype="float32")
        raise (ValueError if "context length" in answer else RuntimeError)(f"{status}: {answer[:200]}")

    return embed


def local_embedder(encode: Callable[[list[str]], np.ndarray], dim: int, most: int = 1400, least: int = 100) -> Embedder:
    """Vectors of a model in this process, of length one. Where it fails on a batch, the texts are cut shorter and shorter.

    `encode` raises RuntimeError on what it can't take. Each time half of what is left above `least` characters is given up; at
    last every text is tried by itself at `least`, and one that still fails has the zero vector.
    """

    def unit(vectors: np.ndarray) -> np.ndarray:
        v = np.asarray(vectors, dtype="float32").reshape(-1, dim)
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)

    def tried(texts: list[str]) -> np.ndarray | None:
        try:
            return unit(encode(texts))
        except RuntimeError:
            return None

    def embed(texts: list[str]) -> np.ndarray:
        size = most
        while size > least:
            got = tried([t[:size] for t in texts])
            if got is not None:
                return got
            size = (size + least) // 2 if size - least > 1 else least
        each = [tried([t[:least]]) for t in texts]
        return np.concatenate([np.zeros((1, dim), dtype="float32") if v is None else v for v in each])

    return embed


def backend(makers: dict[str, Callable[[str], Embedder]], name: str, model: str) -> Embedder:
    """The embedder that EMBEDDING_BACKEND names, or else `name`; a name that no maker has is the first maker's."""
    wanted = os.environ.get("EMBEDDING_BACKEND", name)
    return makers.get(wanted, next(iter(makers.values())))(model)


def embedded(df: DataFrame, embedder: Embedder, text: str = "text", out: str = "embedding", batch: int = 32, most: int = 1400) -> DataFrame:
    """Adds the embedding of each text, cut to `most` characters, in batches; a batch that fails is tried at shorter lengths."""

    @F.pandas_udf("array<float>")
    def embed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            rows: list = []
            for i in range(0, len(series), batch):
                part = [(t or "")[:most] for t in series.iloc[i : i + batch]]
                for limit in (most, 1200, 1000, 800, 600, 400):
                    try:
                        rows += list(embedder([t[:limit] for t in part]))
                        break
                    except ValueError:
                        if limit == 400:
                            raise
            yield pd.Series(rows)

    return df.withColumn(out, embed(F.col(text)))


def upsert(collection: DataFrame, batch: DataFrame, key: str = "id", order: Sequence[Column] = ()) -> DataFrame:
    """The collection after an upsert: of equal ids in the batch the first by `order` stands, and replaces the collection's row.

    Embeddings of different lengths raise: a collection has one dimension, and nothing is ever dropped to change it.
    """
    first = batch.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*(order or [F.lit(0)])))).where("__k = 1").drop("__k")
    both = collection.join(first.select(key), key, "left_anti").unionByName(first)
    if "embedding" in both.columns:
        dims = both.agg(F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("b")).head()
        if dims["a"] != dims["b"]:
            raise ValueError(f"embeddings of {dims['a']} and {dims['b']} dimensions in one collection")
    return both


class Collection:
    """A stored vector collection: rows (id, text, embedding, metadata columns...) in folders by the hash of their id."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def rows(self) -> DataFrame | None:
        """What the collection holds; None before anything was put in."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.parquet(self.path).drop("bucket") if there else None

    def upsert(self, batch: DataFrame, order: Sequence[Column] = (), key: str = "id") -> None:
        """Puts a batch in; see upsert(). Only folders that the batch has rows for are written anew, each at once."""
        bucket = F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        batch = cut(batch)
        held = self.rows()
        if held is None:
            out = upsert(batch.limit(0), batch, key, order)
        else:
            touched = batch.select(bucket.alias("bucket")).distinct()
            out = upsert(self.spark.read.parquet(self.path).join(F.broadcast(touched), "bucket", "left_semi").select(held.columns), batch, key, order)  # at most `buckets` rows
            dims = [df.where("embedding IS NOT NULL").select(F.size("embedding").alias("n")).head() for df in (held, batch)]
            if all(dims) and dims[0]["n"] != dims[1]["n"]:
                raise ValueError(f"embeddings of {dims[1]['n']} dimensions for a collection of {dims[0]['n']}")
        out = cut(out)  # what is read here is written over
        out.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def search(self, text: str, embedder: Embedder, k: int = 10, filters: dict | None = None) -> DataFrame:
        """The k rows nearest to a text, of those that have all values of `filters`; score is 1 less the distance."""
        where = F.lit(True)
        for name, value in (filters or {}).items():
            where = where & (F.col(f"`{name}`") == F.lit(value))
        hits = nearest(self.rows(), [float(x) for x in embedder([text])[0]], k, "id", where=where if filters else None)
        return hits.withColumn("score", 1 - F.col("distance"))


def nearest(collection: DataFrame, query: Sequence[float], k: int = 10, key: str = "id", vector: str = "embedding", where: Column | None = None) -> DataFrame:
    """The k rows nearest to a vector by squared distance, with distance and rank from 1; equal distances by key.

    `where` filters on metadata before any distance is computed. Every partition keeps its k best, which are merged.
    """
    rows = collection.where(where) if where is not None else collection
    distance = squared_distance(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
    best = rows.withColumn("distance", distance).orderBy("distance", key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy("distance", key)))


#: Rows of the collection that a task holds at once, while it reads the queries block by block.
BATCH = 65_536


def nearest_of_each(queries: DataFrame, collection: DataFrame, k: int = 10, key: str = "id", vector: str = "embedding", block: int = 1024) -> DataFrame:
    """(query_id, key, distance, rank): the k nearest rows of every query vector, exact; equal distances by key. Null vectors are left out.

    Query vectors are written to the shared folder. Each task scans its part of the collection once, and for every BATCH rows
    reads the queries in blocks of `block`, each one matrix product; of a batch a query keeps its k best rows and those as
    far, and the best of all batches are ranked by query. Neither side goes through the driver, nor is the collection moved.
    """
    path = scratch(collection.sparkSession)
    queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("q"), F.col(vector).alias("v")).write.parquet(path)
    schema = f"query_id {dict(queries.dtypes)[key]}, {key} {dict(collection.dtypes)[key]}, distance double"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import dataset

        system, inner = file_system(path)
        held: list[pd.DataFrame] = []

        def met() -> Iterator[pd.DataFrame]:
            rows = pd.concat(held, ignore_index=True)
            held.clear()
            if not len(rows):
                return
            x = np.stack(rows[vector].to_numpy()).astype("float64")
            for part in dataset.dataset(inner, filesystem=system, format="parquet").to_batches(batch_size=block):
                if not part.num_rows:
                    continue
                ids, q = part.column("q").to_pylist(), np.stack(part.column("v").to_numpy(zero_copy_only=False)).astype("float64")
                d = ((q**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * q @ x.T).clip(min=0)
                n = min(k, d.shape[1])
                kth = np.partition(d, n - 1, axis=1)[:, n - 1 : n] + 1e-9
                at, of = np.nonzero(d <= kth)
                exact = ((q[at] - x[of]) ** 2).sum(1)
                yield pd.DataFrame({"query_id": [ids[i] for i in at], key: rows[key].to_numpy()[of], "distance": exact})

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= BATCH:
                yield from met()
        if held:
            yield from met()

    hits = collection.select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(scan, schema)
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", key)))
    return ranked.where(F.col("rank") <= k)
