"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.util import sized_join, strip

#: The date folder of a harvested file's path.
PATH_DATE = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"


def iso_date(path: Column, written: Column) -> Column:
    """yyyy-mm-dd: from the path's folder if it shows one, else from a date written with -, / or nothing between; else null."""
    digits = F.regexp_replace(F.coalesce(written, F.lit("")), r"[^0-9]", "")
    from_text = F.when(F.length(digits) >= 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))
    return F.coalesce(F.nullif(F.regexp_extract(path, PATH_DATE, 1), F.lit("")), from_text)


def standing_files(ledger: DataFrame) -> DataFrame:
    """(resource_id, snapshot_date, local_path, next_date): of each resource and date the file fetched last.

    Ledger rows without path, resource or date take no part. Equal times: the greater path stands. next_date is the
    resource's next later date, null for its last.
    """
    files = ledger.select("resource_id", "local_path", "fetched_at", iso_date(F.col("local_path"), F.col("snapshot_date")).alias("snapshot_date"))
    files = files.dropna(subset=["resource_id", "local_path", "snapshot_date"])
    files = files.groupBy("resource_id", "snapshot_date").agg(F.max(F.struct(F.coalesce("fetched_at", F.lit("")).alias("t"), "local_path")).alias("f"))
    following = Window.partitionBy("resource_id").orderBy("snapshot_date")
    return files.select("resource_id", "snapshot_date", F.col("f.local_path").alias("local_path"), F.lead("snapshot_date").over(following).alias("next_date"))


def row_hash(columns: Sequence[str], numbers: Sequence[str] = ()) -> Column:
    """A 64-bit hash of a row's values: trimmed, null as empty, `numbers` by value where they are numbers, case kept."""
    parts = []
    for name in columns:
        text = F.coalesce(strip(F.col(name).cast("string")), F.lit(""))
        if name in numbers:
            number = F.expr(f"try_cast(regexp_replace(`{name}`, '(?U)^\\\\s+|\\\\s+$', '') AS DOUBLE)")
            text = F.coalesce((number + F.lit(0.0)).cast("string"), text)
        parts.append(text)
    return F.xxhash64(F.concat_ws("\u0001", *parts))


def snapshot_changes(rows: DataFrame, ledger: DataFrame, key: str, compared: Sequence[str], numbers: Sequence[str] = (), position: str = "row_no") -> DataFrame:
    """(resource_id, snapshot_date, key, change_kind): records added, removed or changed since the snapshot before.

    rows: (local_path, position, key, compared...), each local_path one full snapshot. Every row is tagged once as the new
    side of its own date and once as the old side of the next; one aggregation by (resource, date, key) takes each side's
    row hash, of the row with the highest position (equal ones: the greater hash), and classifies. That is the one shuffle of
    rows where the list of files is small enough to be broadcast. Rows of files that are not in the ledger, or don't stand
    for their date, take no part. Keys are trimmed; a null key is the empty key. A
    resource's first snapshot yields no rows. A column missing in `rows` raises; other columns are ignored.
    """
    tagged = rows.select("local_path", F.col(position).alias("__at"), F.coalesce(strip(F.col(key).cast("string")), F.lit("")).alias("__key"), row_hash(compared, numbers).alias("__hash"))
    first = Window.partitionBy("resource_id")
    files = standing_files(ledger).withColumn("__first", F.min("snapshot_date").over(first))
    sides = F.array(
        F.when(F.col("snapshot_date") > F.col("__first"), F.struct(F.col("snapshot_date").alias("date"), F.lit(True).alias("new"))),
        F.when(F.col("next_date").isNotNull(), F.struct(F.col("next_date").alias("date"), F.lit(False).alias("new"))),
    )
    files = files.select("resource_id", "local_path", F.filter(sides, lambda s: s.isNotNull()).alias("__sides"))
    # Position and hash in one number of fixed width, so that the aggregation hashes: its greatest is that of the last row.
    packed = F.expr("cast(coalesce(__at, -1) AS decimal(19,0)) * 18446744073709551616BD + cast(__hash AS decimal(19,0)) + 9223372036854775808BD")
    tagged = sized_join(tagged.withColumn("__last", packed).drop("__at", "__hash"), files, ["local_path"], spread=F.col("__key")).select("resource_id", "__key", "__last", F.explode("__sides").alias("__side"))
    last = lambda new: F.max(F.when(F.col("__side.new") == new, F.col("__last")))
    own_hash = lambda c: F.expr(f"pmod({c}, 18446744073709551616BD)")
    both = tagged.groupBy("resource_id", F.col("__side.date").alias("snapshot_date"), "__key").agg(last(True).alias("__n"), last(False).alias("__o"))
    kind = F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "removed").when(own_hash("__n") != own_hash("__o"), "changed")
    return both.select("resource_id", "snapshot_date", F.col("__key").alias(key), kind.alias("change_kind")).where("change_kind IS NOT NULL")
