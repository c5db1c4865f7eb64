"""Fetching what an inventory offers into a lake folder, with a ledger of every download.

A lake folder holds raw/<jurisdiction>/<code>/<day>/<file>, ledger/ (one row for each content that a download brought),
runs/ (the outcome of every run) and provenance/ (what the inventory said of each file). It may lie on any file system that
pyarrow.fs knows, and must be one that all executors reach.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import columns as C
from strata.operators import chunking, ledger
from strata.operators.vectors import Collection, Embedder, embedded
from strata.sources import files, portals, registry
from strata.streaming.refresh import LEDGER

BLOCK = 1 << 16
OUTCOME = LEDGER + ", status string, error string"
_NAMES = [c.split()[0] for c in LEDGER.split(", ")]


def downloaded(url: str, connector: str, target: str) -> tuple[str, int]:
    """(sha256, size_bytes) of what was written to `target`, hashed while it streams; layers are put together from their pages."""
    system, path = files.file_system(target)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    digest, size = hashlib.sha256(), 0

    def blocks() -> Iterator[bytes]:
        if connector == "arcgis_layer":
            yield b'{"type": "FeatureCollection", "features": ['
            for k, feature in enumerate(portals.LayerReader({"base": url}).features()):
                yield (", " if k else "").encode() + json.dumps(feature).encode()
            yield b"]}"
            return
        request = urllib.request.Request(url, headers={"User-Agent": portals.AGENT})
        with urllib.request.urlopen(request, timeout=portals.TIMEOUT) as answer:
            while block := answer.read(BLOCK):
                yield block

    with system.open_output_stream(path) as out:
        for block in blocks():
            out.write(block)
            digest.update(block)
            size += len(block)
    return digest.hexdigest(), size


def harvested(todo: DataFrame, root: str, day: str, now: str, force: bool = False, per_portal: int = 1) -> DataFrame:
    """The outcome of downloading each row of a plan: the ledger's columns, status (fetched, skipped or failed) and error.

    Content equal to the resource's latest is thrown away again and skipped, unless forced. A failing download ends in its
    row. Files appear under their names only when they are whole, so a task that runs again does no harm. A portal is asked
    by `per_portal` tasks, each of which keeps the gap between requests. Of two resources of one code and file name the
    second's file gets a number. Downloads run whenever the result is computed: write it once.
    """
    name = C.raw_filename(F.col("resource_name"), F.col("resource_id"), F.col("format"))
    key = C.falsy("resource_id", F.col("url"))
    same = Window.partitionBy("jurisdiction", "code", "__name").orderBy("__key", "url")
    rows = todo.withColumns({"__name": name, "__key": key}).withColumn("__nth", F.row_number().over(same))
    path = F.concat_ws("/", F.lit(f"{root}/raw"), F.coalesce("jurisdiction", F.lit("none")), F.coalesce("code", F.lit("none")), F.lit(day), F.when(F.col("__nth") == 1, F.col("__name")).otherwise(F.concat(F.col("__nth").cast("string"), F.lit("_"), F.col("__name"))))
    rows = rows.select(
        F.col("__key").alias("resource_id"), "jurisdiction", "code", "connector", "dataset", "url", C.format_norm("format").alias("format"),
        F.coalesce("last_modified", F.lit("")).alias("ckan_modified"), F.col("prev_sha256").alias("sha256"), path.alias("local_path"), F.coalesce("portal", F.lit("")).alias("portal"),
    )
    rows = rows.repartition(F.col("portal"), F.pmod(F.xxhash64("resource_id"), F.lit(per_portal)))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                before, part = r["sha256"], f"{r['local_path']}.{uuid.uuid4().hex}.part"
                system, _ = files.file_system(part)
                try:
                    r["sha256"], r["size_bytes"] = downloaded(r["url"], r["connector"], part)
                    r["status"] = "skipped" if r["sha256"] == before and not force else "fetched"
                    if r["status"] == "skipped":
                        system.delete_file(files.file_system(part)[1])
                    else:
                        system.move(files.file_system(part)[1], files.file_system(r["local_path"])[1])
                except Exception as e:  # noqa: BLE001 - one failing resource must not end the others
                    r.update(status="failed", error=str(e)[:500], sha256=None, size_bytes=None)
                if str(r["url"]).startswith("http"):
                    time.sleep(portals.GAP)
                out.append({**{c: None for c in (*_NAMES, "status", "error")}, **r, "snapshot_date": day, "fetched_at": now})
            yield pd.DataFrame(out, columns=[*_NAMES, "status", "error"])

    return rows.mapInPandas(fetch, OUTCOME)


def ledger_of(spark: SparkSession, root: str) -> DataFrame:
    """The ledger of a lake folder, made if there is none."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{root}/ledger")
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger")


def run(spark: SparkSession, root: str, inventory: DataFrame, day: str, now: str, jurisdictions: list[str] | None = None, codes: list[str] | None = None, force: bool = False) -> DataFrame:
    """Harvests what is new or changed of an inventory; returns its counters (fetched, skipped, failed, pending).

    Rows without url count as pending, of whatever code; formats and codes that aren't wanted count nowhere.
    """
    known = ledger_of(spark, root)
    wanted = inventory.where(F.col("jurisdiction").isin([j.upper() for j in jurisdictions])) if jurisdictions else inventory
    plan = ledger.classify(wanted, known, force)
    if codes:
        plan = plan.where((F.col("status") == "pending") | F.upper("code").isin([c.upper() for c in codes]))
    todo = plan.where("status IN ('new', 'fetch')")
    return _record(spark, root, todo, plan.where("status NOT IN ('new', 'fetch')").select("status"), day, now, force)


def _record(spark: SparkSession, root: str, todo: DataFrame, others: DataFrame, day: str, now: str, force: bool) -> DataFrame:
    target = f"{root}/runs/{uuid.uuid4().hex}"
    others = others.groupBy("status").count().collect()  # a row for each status
    harvested(todo, root, day, now, force).write.parquet(target)
    outcome = spark.read.schema(OUTCOME).parquet(target)
    got = outcome.where("status = 'fetched'")
    told = [c for c in todo.columns if c not in ("status", "prev_sha256", "resource_id", "url")]
    source = todo.withColumn("resource_id", C.falsy("resource_id", F.col("url"))).select("resource_id", "url", F.to_json(F.struct(*told)).alias("source"))
    got.select("resource_id", "url", "local_path", "snapshot_date", "fetched_at").join(source, ["resource_id", "url"]).write.mode("append").parquet(f"{root}/provenance")
    got.select(*_NAMES).write.mode("append").parquet(f"{root}/ledger")
    done = {r["status"]: r["count"] for r in outcome.groupBy("status").count().collect()} | {r["status"]: r["count"] for r in others}
    rows = [(done.get("fetched", 0), done.get("skipped", 0) + done.get("unchanged", 0), done.get("failed", 0), done.get("pending", 0))]
    return spark.createDataFrame(rows, "fetched long, skipped long, failed long, pending long")


def run_reports(spark: SparkSession, root: str, scraper: registry.Scraper, day: str, now: str) -> DataFrame:
    """Downloads the reports of a scraper that the ledger doesn't know; returns the counters. One that isn't ready is pending."""
    known = ledger_of(spark, root)
    reports = ledger.unseen(registry.scraped_reports(spark, scraper), known, F.lit(scraper.code))
    code = F.lit(scraper.code)
    todo = reports.select(
        C.jurisdiction_of(code).alias("jurisdiction"), F.lit("scrape").alias("connector"), code.alias("code"), code.alias("dataset"), "resource_id", F.concat("report_id", F.lit(".pdf")).alias("resource_name"),
        F.lit("pdf").alias("format"), "url", F.lit("").alias("last_modified"), F.lit("").alias("portal"), F.lit(None).cast("string").alias("prev_sha256"),
    )
    pending = spark.createDataFrame([] if scraper.ready() else [("pending",)], "status string")
    return _record(spark, root, todo, pending, day, now, False)


def ingest_reports(spark: SparkSession, root: str, code: str, extractor, embedder: Embedder, collection: Collection, metadata: dict[str, str] | None = None, dry_run: bool = False) -> DataFrame:  # noqa: ANN001
    """Puts the harvested reports of a code into a vector collection; returns total, ingested, failed, skipped and chunks.

    A report whose text can't be read is failed, one without text skipped. `metadata` overrides what is found. A dry run reads
    and stores nothing.
    """
    known = ledger_of(spark, root).where((F.col("code") == code) & (F.col("format") == "pdf"))
    paths = ledger.latest(known).select(F.col("local_path").alias("path")).where("path IS NOT NULL")
    if dry_run:
        return chunking.counters(paths.select(F.col("path").alias("report_id")), None)
    texts = files.report_texts(files.opened(paths), extractor)
    given = F.create_map(*[F.lit(x) for pair in (metadata or {}).items() for x in pair]).cast("map<string,string>")
    docs = texts.select(C.jurisdiction_of(F.lit(code)).alias("jurisdiction"), F.lit(code).alias("source_code"), "report_id", F.col("path").alias("source_url"), "text", "failed", given.alias("given"))
    target = f"{root}/runs/{uuid.uuid4().hex}"
    docs.write.parquet(target)
    docs = spark.read.parquet(target)
    records = chunking.ingest(docs, metadata="given")
    collection.upsert(embedded(records, embedder), [F.col("report_id"), F.col("chunk_index")])
    return chunking.counters(docs, records, failed=F.col("failed"))
