"""Filling containers of fixed capacity with documents, balanced by the cost of attention."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import VOCABULARY, count_tokens
from strata.util import cut

#: Cost of a document of n tokens: n + QUADRATIC * n^2, the linear layers and the attention inside the document.
QUADRATIC = 1 / 4096
#: Sequences that a round opens, as a share of those that its tokens need at least. Near 1 costs are balanced over nearly all
#: sequences; where large documents leave room that nothing fits, fewer are opened and what finds no room goes into later rounds.
#: The shares are tried in turn until so much of the sequences is filled, else the one with the fewest sequences stands.
OPENED, FILLED = (0.98, 0.8), 0.995
#: Items that one task packs; the share of a task's last, partly filled containers in all of them falls with it.
SHARD = 8192


def assign(sizes: np.ndarray, capacity: int, quadratic: float = QUADRATIC) -> np.ndarray:
    """The sequence of each item; sizes must not increase and none may exceed the capacity."""
    best = None
    for opened in OPENED:
        now = balanced(sizes, capacity, opened, quadratic)
        if best is None or now.max(initial=-1) < best.max(initial=-1):
            best = now
        if int(sizes.sum()) >= FILLED * capacity * (int(best.max(initial=-1)) + 1):
            break
    return best


def balanced(sizes: np.ndarray, capacity: int, opened: float, quadratic: float = QUADRATIC) -> np.ndarray:
    """assign() with one share of opened sequences.

    Each round opens that share of the sequences that its tokens need. An item goes to the sequence of the lowest cost that
    has room for it (equal costs: the first). Items for which no sequence has room are the next round's.
    """
    out = np.full(len(sizes), -1, dtype=np.int64)
    todo, base = np.arange(len(sizes)), 0
    while len(todo):
        k = max(1, int(-(-int(sizes[todo].sum()) // capacity) * opened))
        room, cost = np.full(k, capacity, dtype=np.int64), np.zeros(k)
        left = []
        for i in todo:
            n = sizes[i]
            at = int(np.argmin(np.where(room >= n, cost, np.inf)))
            if room[at] < n:
                left.append(i)
                continue
            room[at] -= n
            cost[at] += n + quadratic * n * n
            out[i] = base + at
        base += k
        todo = np.array(left, dtype=np.int64)
    return out


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """One shard's items in containers; numbers of containers are the shard's own."""
    capacity = int(group.capacity_tokens.iloc[0])
    group = group.sort_values(["size", "__hash", "__row"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    group["slot"] = assign(group["size"].to_numpy(), capacity)
    group["start_at"] = group.groupby("slot")["size"].cumsum() - group["size"]
    return group[["container_id", "capacity_tokens", "shard", "slot", "start_at", "doc_id", "part_no", "token_from", "size"]]


def pack(documents: DataFrame, spec: DataFrame, vocabulary: str = VOCABULARY, shard: int = SHARD) -> DataFrame:
    """Every document's place for each capacity.

    (container_id, capacity_tokens, container, start_at, doc_id, part_no, token_from, n_tokens): tokens token_from..+n_tokens
    of the document lie at start_at of the container; container is unique within container_id. A document within the capacity
    has one part. A longer one is cut into parts of the full capacity, each a container of its own, and one shorter rest,
    which is packed as documents are. Documents without tokens (null or empty text) are placed nowhere. Repeated rows are
    documents of their own. Capacities that are null or below 1 are left out. Columns not named here are ignored.

    Shards of about `shard` items are drawn by hash, so any document, source or group of copies spreads over all tasks.
    """
    docs = count_tokens(documents.select("doc_id", "text"), vocabulary=vocabulary).where("n_tokens > 0").select("doc_id", F.xxhash64("doc_id", "text").alias("__hash"), "n_tokens")
    # Equal rows are told apart by their number among the equal ones, so that places don't depend on how rows are partitioned.
    docs = docs.groupBy("doc_id", "__hash", "n_tokens").agg(F.count("*").alias("__times"))
    docs = cut(docs.select("doc_id", "__hash", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__row")))
    spec = spec.where("capacity_tokens > 0").select("container_id", "capacity_tokens").distinct()
    shards = max(1, round(docs.count() / shard))
    # The specification is a handful of rows, each of which takes all documents: documents are repeated for each of them.
    capacities = F.array(*[F.struct(F.lit(r[0]).cast("int").alias("container_id"), F.lit(r[1]).cast("int").alias("capacity_tokens")) for r in spec.limit(1001).collect()])
    if spec.count() > 1000:
        raise ValueError("more than 1000 capacities")
    items = docs.select("doc_id", "__hash", "__row", "n_tokens", F.explode(capacities).alias("c")).select("doc_id", "__hash", "__row", "n_tokens", "c.container_id", "c.capacity_tokens")
    full = F.floor(F.col("n_tokens") / F.col("capacity_tokens")).cast("int")
    whole = items.where("n_tokens >= capacity_tokens").select("container_id", "capacity_tokens", "doc_id", "__hash", "__row", F.explode(F.sequence(F.lit(0), full - 1)).alias("part_no"))
    whole = whole.select(
        "container_id", "capacity_tokens", F.concat_ws("-", F.lit("f"), F.hex("__hash"), F.col("__row").cast("string"), F.col("part_no").cast("string")).alias("container"), F.lit(0).cast("long").alias("start_at"),
        "doc_id", "part_no", (F.col("part_no") * F.col("capacity_tokens")).cast("long").alias("token_from"), F.col("capacity_tokens").cast("long").alias("n_tokens"),
    )
    rest = items.select("container_id", "capacity_tokens", "doc_id", "__hash", "__row", full.alias("part_no"), (full * F.col("capacity_tokens")).cast("long").alias("token_from"), (F.col("n_tokens") % F.col("capacity_tokens")).cast("long").alias("size"))
    rest = rest.where("size > 0").withColumn("shard", F.pmod(F.xxhash64("__hash", "__row"), F.lit(shards)).cast("int"))
    placed = rest.groupBy("container_id", "shard").applyInPandas(_pack, "container_id int, capacity_tokens int, shard int, slot long, start_at long, doc_id long, part_no int, token_from long, size long")
    placed = placed.select("container_id", "capacity_tokens", F.concat_ws("-", F.lit("s"), F.col("shard").cast("string"), F.col("slot").cast("string")).alias("container"), "start_at", "doc_id", "part_no", "token_from", F.col("size").alias("n_tokens"))
    return whole.unionByName(placed)


def fill(packed: DataFrame, quadratic: float = QUADRATIC) -> DataFrame:
    """(container_id, capacity_tokens, parts, tokens, containers, fill, cost_mean, cost_sd, cost_max): how full the containers are, and how even their costs."""
    n = F.col("n_tokens")
    each = packed.groupBy("container_id", "capacity_tokens", "container").agg(F.sum(n).alias("t"), F.count("*").alias("p"), F.sum(n + n * n * quadratic).alias("c"))
    by = each.groupBy("container_id", "capacity_tokens").agg(
        F.sum("p").alias("parts"), F.sum("t").alias("tokens"), F.count("*").alias("containers"),
        F.round(F.avg("c"), 3).alias("cost_mean"), F.round(F.stddev_pop("c"), 3).alias("cost_sd"), F.round(F.max("c"), 3).alias("cost_max"),
    )
    return by.select("container_id", "capacity_tokens", "parts", "tokens", "containers", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"), "cost_mean", "cost_sd", "cost_max")
