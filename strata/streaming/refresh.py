"""Incremental refresh: new ledger rows as a stream, of which only new or changed content is appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

LEDGER = (
    "resource_id string, jurisdiction string, code string, connector string, dataset string, url string, format string, ckan_modified string, "
    "sha256 string, size_bytes bigint, local_path string, snapshot_date string, fetched_at string"
)


def append_changed(batch: DataFrame, ledger_path: str) -> None:
    """Appends the rows of a batch whose content differs from the resource's fetched before, in the batch or in the ledger.

    A row that comes late is compared with the ledger's rows of that time. Content once left out as unchanged isn't known any
    more if a late row shows a change before it. A hash that is null tells no change, but may be a resource's first.
    """
    spark = batch.sparkSession
    known = spark.read.schema(LEDGER).parquet(ledger_path).join(batch.select("resource_id").distinct(), "resource_id", "left_semi")
    rows = batch.withColumn("__new", F.lit(1)).unionByName(known.withColumn("__new", F.lit(0)))
    order = Window.partitionBy("resource_id").orderBy(F.coalesce("fetched_at", F.lit("")), "sha256", "__new")
    rows = rows.withColumns({"__had": F.last("sha256", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), "__k": F.row_number().over(order)})
    changed = rows.where("__new = 1 AND (__k = 1 OR __had <> sha256 OR (__had IS NULL AND sha256 IS NOT NULL))")
    changed.select(*[c.split()[0] for c in LEDGER.split(", ")]).write.mode("append").parquet(ledger_path)


def refresh(spark: SparkSession, incoming: str, ledger_path: str, checkpoint: str) -> StreamingQuery:
    """Reads what is new in a folder of ledger rows (JSON lines) in one go and ends; run it as often as data arrive."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger_path)
    rows = spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", 1).json(incoming)
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: append_changed(batch, ledger_path)).start()


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Counts and sums by event type and hour of a stream (event_type, ts, value); rows later than `late` are left out."""
    return events.withWatermark("ts", late).groupBy("event_type", F.window("ts", "1 hour")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
