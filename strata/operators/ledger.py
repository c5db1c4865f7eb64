"""The harvest ledger: latest rows, upserts as a view, change detection, provenance and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.columns import CORE_FORMATS, format_norm
from strata.operators.snapshots import iso_date
from strata.util import falsy, previous


def upserted(ledger: DataFrame) -> DataFrame:
    """One row for each (resource_id, sha256): that fetched last; equal times by local_path and url, the greater stands."""
    w = Window.partitionBy("resource_id", "sha256").orderBy(F.desc_nulls_last("fetched_at"), F.desc_nulls_last("local_path"), F.desc_nulls_last("url"))
    return ledger.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def latest(ledger: DataFrame) -> DataFrame:
    """(resource_id, sha256, ckan_modified, fetched_at, local_path) of each resource's row fetched last; equal times by sha256.

    One aggregation with a partial step, so a resource with a third of all rows is no task of its own.
    """
    top = F.max(F.struct(F.coalesce("fetched_at", F.lit("")).alias("t"), F.col("sha256"), F.col("ckan_modified"), F.col("local_path"))).alias("m")
    return ledger.groupBy("resource_id").agg(top).select("resource_id", "m.sha256", "m.ckan_modified", F.nullif(F.col("m.t"), F.lit("")).alias("fetched_at"), "m.local_path")


def allowed() -> Column:
    """Formats of the small harvest; layers and hub items always."""
    return format_norm("format").isin(*CORE_FORMATS) | F.col("connector").isin("arcgis_layer", "arcgis_hub")


def downloadable() -> Column:
    return F.coalesce(F.col("url") != "", F.lit(False))


def select_inventory(inventory: DataFrame, jurisdictions: list[str] | None = None, codes: list[str] | None = None) -> DataFrame:
    """The resources a harvest looks at: those with a url, an allowed format, and of the given jurisdictions and codes, in any case."""
    out = inventory.where(downloadable()).where(allowed())
    if jurisdictions:
        out = out.where(F.col("jurisdiction").isin([j.upper() for j in jurisdictions]))
    if codes:
        out = out.where(F.upper("code").isin([c.upper() for c in codes]))
    return out


def classify(inventory: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """inventory with prev_sha256 and status: pending (no url), excluded (format), new, unchanged (same last_modified) or fetch.

    The key is resource_id, or the url if that is missing. A last_modified that is null or empty never proves a resource
    unchanged. With force nothing is unchanged.
    """
    have = latest(ledger).select(F.col("resource_id").alias("__key"), F.col("sha256").alias("prev_sha256"), F.col("ckan_modified").alias("__seen"))
    rows = inventory.withColumn("__key", falsy("resource_id", F.col("url"))).join(have, "__key", "left")
    same = F.lit(not force) & (F.coalesce(F.col("__seen"), F.lit("")) != "") & (F.col("__seen") == F.col("last_modified"))
    status = F.when(~downloadable(), "pending").when(~allowed(), "excluded").when(F.col("prev_sha256").isNull(), "new").when(F.coalesce(same, F.lit(False)), "unchanged").otherwise("fetch")
    return rows.withColumn("status", status).drop("__key", "__seen")


def counters(outcome: DataFrame) -> DataFrame:
    """(fetched, skipped, failed, pending) of classified or harvested rows; fetched counts what a plan would fetch, too."""
    status = F.col("status")
    return outcome.agg(F.count_if(status.isin("new", "fetch", "fetched")).alias("fetched"), F.count_if(status.isin("unchanged", "skipped")).alias("skipped"), F.count_if(status == "failed").alias("failed"), F.count_if(status == "pending").alias("pending"))


def changed_content(fetched: DataFrame, ledger: DataFrame) -> DataFrame:
    """The fetched rows (resource_id, sha256, ...) whose hash differs from the resource's latest; the rest is skipped."""
    have = latest(ledger).select("resource_id", F.col("sha256").alias("__have"))
    return fetched.join(have, "resource_id", "left").where("__have IS NULL OR __have <> sha256").drop("__have")


def content_history(ledger: DataFrame) -> DataFrame:
    """(resource_id, local_path, sha256, status): whether each download's content differs from the resource's download before.

    status is new (nothing before, or nothing known of it), skipped or changed. Downloads are ordered by time, hash and path;
    a day of a resource is the most that one task orders. A null hash tells no change: its status is null after a known one.
    """
    time = F.coalesce("fetched_at", F.lit(""))
    rows = previous(ledger.select("resource_id", "local_path", "sha256", "fetched_at"), ["resource_id"], [time, F.col("sha256"), F.col("local_path")], F.col("sha256"), F.left(time, F.lit(10)), "__had")
    status = F.when(F.col("__had").isNull(), "new").when(F.col("__had") == F.col("sha256"), "skipped").when(F.col("__had") != F.col("sha256"), "changed")
    return rows.select("resource_id", "local_path", "sha256", status.alias("status"))


def unseen(reports: DataFrame, ledger: DataFrame, code: Column) -> DataFrame:
    """The reports whose id, as code:report_id, is in no row of the ledger; with that id as resource_id."""
    keyed = reports.withColumn("resource_id", F.concat_ws(":", code, F.col("report_id")))
    return keyed.join(ledger.select("resource_id").distinct(), "resource_id", "left_anti")


def dated(ledger: DataFrame) -> DataFrame:
    """The ledger with snapshot_date as yyyy-mm-dd, from the path or as written."""
    return ledger.withColumn("snapshot_date", iso_date(F.col("local_path"), F.col("snapshot_date")))


def latest_snapshot(ledger: DataFrame, per_resource: bool = True) -> DataFrame:
    """Rows of the newest snapshot: of each resource, or (per_resource=False) of each jurisdiction and code."""
    keys = ["jurisdiction", "code", "resource_id"] if per_resource else ["jurisdiction", "code"]
    rows = dated(ledger)
    newest = rows.groupBy(*keys).agg(F.max("snapshot_date").alias("__d"))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("l.snapshot_date") == F.col("r.__d")]
    return rows.alias("l").join(newest.alias("r"), on, "left_semi")


def snapshot_counts(ledger: DataFrame) -> DataFrame:
    """(code, snapshot_date, n, change): files of each code's snapshots and the difference to the snapshot before, null for the first."""
    counts = dated(ledger).groupBy("code", "snapshot_date").agg(F.count("*").alias("n"))
    return counts.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("code").orderBy("snapshot_date")))
