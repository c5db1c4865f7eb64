"""How much of what is expected of a jurisdiction the lake holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gaps(expected: DataFrame, populated: DataFrame) -> DataFrame:
    """(jurisdiction, code) that are expected and not populated; a code with a count of 0 is populated."""
    return expected.select("jurisdiction", "code").distinct().join(populated.select("jurisdiction", "code").distinct(), ["jurisdiction", "code"], "left_anti")


def scores(expected: DataFrame, populated: DataFrame) -> DataFrame:
    """(jurisdiction, expected, covered, resources, score): the covered share, half to even at two places.

    Each row of `populated` adds one to its code, or the value of a column `n` where there is one; a code with 0 is covered.
    resources adds up those of the expected codes, null if none is covered.
    """
    n = F.col("n") if "n" in populated.columns else F.lit(1)
    have = populated.groupBy("jurisdiction", "code").agg(F.coalesce(F.sum(n), F.lit(0)).alias("__n"))
    by = expected.select("jurisdiction", "code").distinct().join(have, ["jurisdiction", "code"], "left").groupBy("jurisdiction")
    by = by.agg(F.count("*").alias("expected"), F.count("__n").alias("covered"), F.sum("__n").alias("resources"))
    return by.withColumn("score", F.bround(F.col("covered") / F.col("expected"), 2))
