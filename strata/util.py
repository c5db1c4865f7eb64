"""Helpers shared by the operators: lineage cuts, skew-safe joins and skew-safe running totals."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Unicode white space at both ends, as Python's str.strip takes it off.
STRIP = r"(?U)^\s+|\s+\z"


def strip(c: Column | str) -> Column:
    """Both ends without Unicode white space (Spark's trim takes off blanks only)."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, STRIP, "")


def falsy(c: Column | str, *others: Column | str) -> Column:
    """The first value that is neither null nor empty; '' counts as missing, as in `a or b`. The last is taken as it is."""
    cols = [F.col(x) if isinstance(x, str) else x for x in (c, *others)]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in cols[:-1]], cols[-1])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder named in spark.checkpoint.dir. Where none is named a local one is made, if the session runs on this machine only.

    On a cluster that raises: executors would write where no other machine can read.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strata-checkpoint-"))


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, for tables that tasks read by themselves; it goes with that folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/strata-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read from there: later steps don't compute them again.

    Runs at once: an operator that says it cuts runs jobs when it is called. Files go when the session's settings have
    spark.cleaner.referenceTracking.cleanCheckpoints and nothing refers to the rows any more.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def salted_join(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", salts: int = 16, spread: Column | None = None) -> DataFrame:
    """Joins many rows with a table that has few rows for a key, where one key may hold a third of all rows.

    Spark broadcasts `few` if its size is below autoBroadcastJoinThreshold. Otherwise both sides are shuffled, each key
    being spread over `salts` partitions: `few` is repeated once for each salt. Null keys match nothing. `how` is inner or left.
    """
    salt = "__salt"
    left = rows.withColumn(salt, F.pmod(F.xxhash64(spread) if spread is not None else F.xxhash64(*[F.col(c) for c in hashable(rows)]), F.lit(salts)).cast("int"))
    right = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, salt], how).drop(salt)


def sized_join(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", spread: Column | None = None, most: int = 100_000) -> DataFrame:
    """salted_join, but `few` is counted first and broadcast if it has at most `most` rows: then `rows` aren't moved at all."""
    few = cut(few)
    if few.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(few), keys, how)
    return salted_join(rows, few, keys, how, spread=spread)


def previous(df: DataFrame, keys: list[str], order: list[Column], value: Column, block: Column, out: str) -> DataFrame:
    """Adds `out`: the value of the row before among the same keys along `order`, without a single task for a hot key.

    `block` must not decrease along `order` within the keys; a block is the unit of one task. Blocks pass their last value
    on in a small table. Null keys are a key; `order` must tell all rows of a block apart for a defined result.
    """
    b, v, before, at = "__block", "__value", "__before", "__order"
    rows = df.withColumn(b, block).withColumn(v, F.struct(value.alias("v"))).withColumn(at, F.struct(*order))
    ends = rows.groupBy(*keys, b).agg(F.max_by(v, at).alias("__last"))
    ends = ends.select(*keys, b, F.lag("__last").over(Window.partitionBy(*keys).orderBy(b)).alias(before))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, b]]
    joined = rows.alias("l").join(ends.alias("r"), on, "left").select("l.*", F.col(f"r.{before}").alias(before))
    inside = F.lag(v).over(Window.partitionBy(*keys, b).orderBy(at))
    return joined.withColumn(out, F.coalesce(inside, F.col(before))["v"]).drop(b, v, before, at)


def hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def running_total(df: DataFrame, keys: list[str], order: list[Column], value: Column, block: Column, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the earlier rows of the same keys, without a single task for a hot key.

    `block` must not decrease along `order` within the keys; a block is the unit of one task. Sums of the blocks are
    added up first, in a small table; then rows are summed inside their block only.
    """
    b, v, before = "__block", "__value", "__before"
    rows = df.withColumn(b, block).withColumn(v, value)
    sums = rows.groupBy(*keys, b).agg(F.sum(v).alias("__sum"))
    along = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum("__sum").over(along), F.lit(0))).drop("__sum")
    left, right = rows.alias("l"), sums.alias("r")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, b]]
    joined = left.join(right, on, "left").select("l.*", F.col(f"r.{before}").alias(before))
    inside = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(out, F.col(before) + F.coalesce(F.sum(v).over(inside), F.lit(0))).drop(b, v, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a lake folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
