"""Queries of the core operators for training data: schema drift (p4) and snapshot changes (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import drift, snapshots
from strata.util import table

TENURE = ["owner", "status", "area_ha", "commodity", "nts_sheet", "issue_date", "good_to_date"]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    rows, ledger = table(spark, folder, "tenure_snapshot"), table(spark, folder, "harvest")
    return snapshots.snapshot_changes(rows, ledger, "tenure_id", TENURE, numbers=["area_ha"])


def p5_change_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of each kind for each snapshot."""
    return p5_found(spark, folder).groupBy("resource_id", "snapshot_date", "change_kind").agg(F.count("*").alias("n"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.changes(table(spark, folder, "raw_record"), table(spark, folder, "harvest"))


def p4_unified(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of all files, each table under one set of names; the fields as a JSON object."""
    unified = drift.unify(table(spark, folder, "raw_record"), table(spark, folder, "harvest"))
    return unified.withColumn("fields", F.to_json("fields", {"ignoreNullFields": "false"}))


_P5 = r"""
WITH f AS (
  SELECT resource_id, local_path, regexp_extract(local_path, '/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]*$', 1) AS d, max(fetched_at) AS t
  FROM harvest WHERE local_path IN (SELECT local_path FROM tenure_snapshot) GROUP BY ALL),
s AS (SELECT *, lead(d) OVER (PARTITION BY resource_id ORDER BY d) AS nd, min(d) OVER (PARTITION BY resource_id) AS d0
  FROM (SELECT *, row_number() OVER (PARTITION BY resource_id, d ORDER BY t DESC, local_path DESC) AS k FROM f) WHERE k = 1),
r AS (
  SELECT local_path, trim(tenure_id) AS tenure_id, row_no,
    concat_ws('|', coalesce(trim(owner), ''), coalesce(trim(status), ''), coalesce(try_cast(trim(area_ha) AS DOUBLE)::VARCHAR, trim(area_ha), ''),
      coalesce(trim(commodity), ''), coalesce(trim(nts_sheet), ''), coalesce(trim(issue_date), ''), coalesce(trim(good_to_date), '')) AS v
  FROM tenure_snapshot),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY local_path, tenure_id ORDER BY row_no DESC) AS k FROM r) WHERE k = 1),
n AS (SELECT resource_id, d AS snapshot_date, tenure_id, v FROM l JOIN s USING (local_path) WHERE d > d0),
o AS (SELECT resource_id, nd AS snapshot_date, tenure_id, v FROM l JOIN s USING (local_path) WHERE nd IS NOT NULL),
c AS (
  SELECT coalesce(n.resource_id, o.resource_id) AS resource_id, coalesce(n.snapshot_date, o.snapshot_date) AS snapshot_date,
    coalesce(n.tenure_id, o.tenure_id) AS tenure_id,
    CASE WHEN o.v IS NULL THEN 'added' WHEN n.v IS NULL THEN 'removed' WHEN n.v <> o.v THEN 'changed' END AS change_kind
  FROM n FULL JOIN o ON n.resource_id = o.resource_id AND n.snapshot_date = o.snapshot_date AND n.tenure_id = o.tenure_id)
"""

QUERIES = {"p4_found": p4_found, "p4_unified": p4_unified, "p5_found": p5_found, "p5_change_counts": p5_change_counts}

ORACLE = {
    "p5_found": _P5 + "SELECT * FROM c WHERE change_kind IS NOT NULL",
    "p5_change_counts": _P5 + "SELECT resource_id, snapshot_date, change_kind, count(*) AS n FROM c WHERE change_kind IS NOT NULL GROUP BY ALL",
}
