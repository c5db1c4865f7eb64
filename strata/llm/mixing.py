"""Mixing sources to target shares of all tokens by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.tokens import VOCABULARY, count_tokens
from strata.util import cut

#: Documents of one source and length are counted in so many parts, so that no part is more than that share of a hot group.
PARTS = 64
#: Newton iterations end when every source's tokens are this close to its target, as a share of the target.
CLOSE = 1e-7


def solve(cells: DataFrame, goals: list[dict]) -> list[dict]:
    """Adds `tilt` to each goal: distributed Newton iterations on the convex dual of the token constraints.

    cells: (source, n_tokens, n) counts the documents. A document of t tokens has the rate min(repeats, exp(tilt * t / mean)),
    which is the rate nearest in relative entropy to one copy of every document that meets the constraint
    sum(rate * t) = target. The dual, sum over documents of the integral of rate * t less tilt * target, has that
    constraint as its derivative; each round is one aggregation over the cells for all goals at once, and steps that leave
    the bracket found so far are halved into it. Rounds go on until every goal is met, or its bracket is two neighbouring
    numbers. Goals that need all documents at their cap have no finite tilt: null.
    """
    spark = cells.sparkSession
    open_goals = [g for g in goals if g["tilt"] is not None]
    for g in open_goals:
        g.update(low=-math.inf, high=math.inf, done=False)
    while now := [g for g in open_goals if not g["done"]]:
        at = spark.createDataFrame([(g["goal"], g["source"], g["tilt"], float(g["repeats"]), g["mean"]) for g in now], "goal int, source string, tilt double, repeats double, mean double")
        t = F.col("n_tokens").cast("double")
        raw = F.exp(F.least(F.col("tilt") * t / F.col("mean"), F.lit(700.0)))
        rate = F.least(raw, F.col("repeats"))
        both = cells.join(F.broadcast(at), "source")  # a row for each source of each mix, checked in mix()
        sums = both.groupBy("goal").agg(F.sum(F.col("n") * rate * t).alias("tokens"), F.sum(F.when(raw < F.col("repeats"), F.col("n") * raw * t * t / F.col("mean")).otherwise(0.0)).alias("slope"))
        got = {r["goal"]: r for r in sums.collect()}
        for g in now:
            tokens, slope = got[g["goal"]]["tokens"], got[g["goal"]]["slope"]
            off = tokens - g["target"]
            if abs(off) <= CLOSE * g["target"]:
                g["done"] = True
                continue
            g["high" if off > 0 else "low"] = g["tilt"]
            step = g["tilt"] - off / slope if slope > 0 else math.nan
            if not g["low"] < step < g["high"]:
                ends = (g["low"], g["high"])
                step = sum(ends) / 2 if all(map(math.isfinite, ends)) else (g["low"] + 1 + abs(g["low"]) if math.isfinite(g["low"]) else g["high"] - 1 - abs(g["high"]))
            g["done"] = step in (g["low"], g["high"])  # no number lies between
            g["tilt"] = step
    return goals


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of every mix.

    copies: (mix_id, source, doc_id, n_tokens, rate, copies), one row for each document used, copies from 1 to max_repeats.
    shares: (mix_id, source, target_share, max_repeats, source_tokens, target_tokens, tokens, share, documents).

    A mix is as large as its scarcest source allows: the least of max_repeats * tokens / share over the sources that have
    tokens. Sources without tokens get none; the other shares keep their proportions. Rates come from solve(); they are
    rounded into copies along the documents' order of length, each copy falling where the sum of the rates passes a whole
    number, so a source misses its tokens by about one document. A document is of one source; null sources match nothing.
    Targets with a share or cap that is null or not above 0 get nothing. Equal rows of targets count once. Documents without
    tokens are not used. Repeated rows are documents of their own.
    """
    docs = cut(count_tokens(documents.select("doc_id", "source", "text"), vocabulary=vocabulary).where("n_tokens > 0 AND source IS NOT NULL").select("doc_id", "source", "n_tokens", F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)).cast("int").alias("part")))
    cells = cut(docs.groupBy("source", "n_tokens", "part").agg(F.count("*").alias("n")))
    wanted = targets.select("mix_id", "source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).distinct()
    rows = wanted.limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("more than 100000 targets")
    total = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"), F.sum("n").alias("n"))
    have = {r["source"]: r for r in total.join(F.broadcast(wanted.select("source").distinct()), "source", "left_semi").collect()}
    goals = []
    for k, r in enumerate(rows):
        held = have.get(r["source"])
        ok = held is not None and (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) > 0
        goals.append({"goal": k, "mix_id": r["mix_id"], "source": r["source"], "share": r["target_share"], "repeats": r["max_repeats"], "held": held["tokens"] if held else 0, "docs": held["n"] if held else 0, "ok": ok, "target": 0.0, "tilt": None, "mean": 1.0})
    by_mix: dict = {}
    for g in goals:
        if g["ok"]:
            by_mix.setdefault(g["mix_id"], []).append(g)
    for own in by_mix.values():
        shares = sum(g["share"] for g in own)
        size = min((g["repeats"] * g["held"] * shares / g["share"] for g in own), default=0.0)
        for g in own:
            g["target"], g["mean"] = size * g["share"] / shares, g["held"] / g["docs"]
            g["tilt"] = None if g["target"] >= g["repeats"] * g["held"] * (1 - 1e-9) else 0.0
    goals = solve(cells, goals)
    schema = "goal int, mix_id int, source string, target_share double, max_repeats int, source_tokens long, target_tokens double, tilt double, mean double, ok boolean"
    plan = docs.sparkSession.createDataFrame([(g["goal"], g["mix_id"], g["source"], g["share"], g["repeats"], g["held"], g["target"], g["tilt"], g["mean"], g["ok"]) for g in goals], schema)
    cap = F.col("max_repeats").cast("double")
    rate = F.coalesce(F.least(cap, F.exp(F.least(F.col("tilt") * F.col("n_tokens") / F.col("mean"), F.lit(700.0)))), cap)
    use = F.broadcast(plan.where("ok"))  # a row for each source of each mix
    # Rates of cells add up along (n_tokens, part); a source has at most as many cells as lengths times PARTS.
    sums = cells.join(use, "source").withColumn("rate", rate)
    before = Window.partitionBy("goal").orderBy("n_tokens", "part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum(F.col("rate") * F.col("n")).over(before), F.lit(0.0)) + 0.5)
    sums = sums.select("goal", "mix_id", "source", "n_tokens", "part", "rate", "before", "max_repeats")
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "part").orderBy("doc_id"))
    placed = docs.withColumn("k", rank).join(sums, ["source", "n_tokens", "part"])
    near = lambda x: F.floor(x + 1e-6)
    copies = (near(F.col("before") + F.col("rate") * F.col("k")) - near(F.col("before") + F.col("rate") * (F.col("k") - 1))).cast("int")
    placed = placed.withColumn("copies", F.least(copies, F.col("max_repeats"))).where("copies > 0").select("mix_id", "source", "doc_id", "n_tokens", F.round("rate", 9).alias("rate"), "copies")
    used = placed.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"))
    report = plan.select("mix_id", "source", "target_share", "max_repeats", "source_tokens", F.round("target_tokens", 3).alias("target_tokens"))
    report = report.join(used, ["mix_id", "source"], "left").fillna(0, ["tokens", "documents"])
    whole = F.sum("tokens").over(Window.partitionBy("mix_id"))
    report = report.withColumn("share", F.when(whole > 0, F.round(F.col("tokens") / whole, 9)).otherwise(0.0))
    return placed, report
