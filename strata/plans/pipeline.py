"""The batch refresh from inventory to catalog, and its command line."""

from __future__ import annotations

import argparse
import datetime
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import session
from strata.functions import columns as C
from strata.operators import ledger, vectors
from strata.plans import harvest, process
from strata.sources import portals, registry
from strata.util import cut


def catalog_inventory(packages: DataFrame, jurisdiction: str, portal: str, match: list[tuple[str, list[str]]]) -> DataFrame:
    """Inventory rows of a portal's packages: one for each resource; with rules, only of packages that one of them labels."""
    title = C.falsy("title", "name", F.lit(""))
    label = C.label(title, match) if match else F.lit(f"{jurisdiction}_MISC")
    rows = packages.withColumn("__code", label).where("__code IS NOT NULL").withColumn("__title", title).select("__code", "__title", "license_title", F.explode("resources").alias("r"))
    return rows.select(
        F.lit(jurisdiction).alias("jurisdiction"), F.lit("ckan").alias("connector"), F.col("__code").alias("code"), F.col("__title").alias("dataset"), F.col("r.id").alias("resource_id"),
        C.falsy(F.col("r.name"), F.col("__title")).alias("resource_name"), C.format_norm(F.col("r.format")).alias("format"), F.col("r.url").alias("url"),
        C.falsy(F.col("r.last_modified"), F.col("r.created")).alias("last_modified"), F.col("r.size").alias("size"), F.col("license_title").alias("license"), F.lit(portal).alias("portal"),
        F.lit(None).cast("int").alias("feature_count"), F.lit(None).cast("string").alias("note"),
    )


def inventory_line() -> Column:
    """An inventory row as it is shown."""
    features = F.when(F.coalesce("feature_count", F.lit(0)) != 0, F.concat(F.lit(" ~"), F.col("feature_count").cast("string"), F.lit(" feats"))).otherwise("")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(C.format_norm("format"), F.lit(" "), C.megabytes(F.col("size")), features, F.lit(" "), text("code"), F.lit(" :: "), text("resource_name"))
    return F.when(ledger.downloadable(), line).otherwise("pending")


def discover(spark: SparkSession, jurisdictions: list[str] | None = None, sources: list[dict] | None = None, counts: bool = True) -> DataFrame:
    """The inventory of all declared sources, or of the named jurisdictions only; sources are pruned before any request.

    With `counts` the servers of declared layers are asked for their features.
    """
    spark.dataSource.register(portals.CatalogSource)
    wanted = {j.upper() for j in jurisdictions or []}
    own = [s for s in (registry.SOURCES if sources is None else sources) if not wanted or s["jurisdiction"] in wanted]
    rows = registry.registry(spark, own)
    out = registry.arcgis_inventory(rows, counts).unionByName(registry.scrape_inventory(rows))
    for s in own:
        if s["type"] == "ckan":
            packages = spark.read.format("portal_catalog").option("base", s["portal"]).option("fq", s.get("fq", "")).load()
            out = out.unionByName(catalog_inventory(packages, s["jurisdiction"], s["portal"], s.get("match", [])))
    return out


def plan(spark: SparkSession, inventory: DataFrame, ledger_path: str, force: bool = False) -> DataFrame:
    """What a harvest does with each resource of an inventory."""
    return ledger.classify(inventory, spark.read.parquet(ledger_path), force)


def collection_of(spark: SparkSession, root: str) -> vectors.Collection:
    return vectors.Collection(spark, f"{root}/vectors")


def embedder_of(name: str = "remote", model: str = "nomic-embed-text") -> vectors.Embedder:
    """The embedder for the command line: a served model, or hashed words; EMBEDDING_BACKEND overrides the name."""
    host = os.environ.get("EMBEDDING_HOST", "http://localhost:11434")
    return vectors.backend({"remote": lambda m: vectors.remote_embedder(host, m), "hash": lambda _: vectors.hash_embedder()}, name, model)


def update(spark: SparkSession, root: str, inventory: DataFrame, day: str, now: str, **options) -> list[DataFrame]:  # noqa: ANN003
    """Harvest, process and index, one after the other; a stage that raises ends the run. Returns the reports of the first two."""
    counted = harvest.run(spark, root, inventory, day, now, **options)
    loaded = process.process(spark, root, harvest.ledger_of(spark, root))
    process.build_index(spark, root)
    return [counted, loaded]


def main(args: list[str] | None = None) -> None:
    """The lake from the command line.

    discover [--json] [--jurisdiction J...] | plan --root DIR [--force] | harvest --root DIR [--jurisdiction J...] [--only CODE...] [--force]
    process --root DIR | index --root DIR | update --root DIR | search --root DIR QUERY [--limit N] | query --root DIR QUERY [--limit N] [--filter JSON]
    """
    p = argparse.ArgumentParser(prog="strata", description=main.__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["discover", "plan", "harvest", "process", "index", "update", "search", "query"])
    p.add_argument("query", nargs="?", default="")
    p.add_argument("--root", default=os.environ.get("STRATA_LAKE", "lake"))
    p.add_argument("--jurisdiction", nargs="*", default=None)
    p.add_argument("--only", nargs="*", default=None)
    p.add_argument("--json", action="store_true")
    p.add_argument("--force", action="store_true")
    p.add_argument("--limit", type=int, default=10)
    p.add_argument("--filter", type=json.loads, default=None)
    p.add_argument("--backend", default="remote")
    a = p.parse_args(args)
    spark = session.build()
    now = datetime.datetime.now()
    day, second = now.date().isoformat(), now.isoformat(timespec="seconds")
    if a.command == "search":
        process.search_lake(spark, a.root, a.query, a.limit).show(a.limit, False)
    elif a.command == "query":
        hits = collection_of(spark, a.root).search(a.query, embedder_of(a.backend), a.limit, a.filter).orderBy("rank")
        hits.select("rank", F.format_string("%.3f", "score").alias("score"), F.left("id", F.lit(16)).alias("source"), F.left("text", F.lit(200)).alias("text")).show(a.limit, False)
    elif a.command == "process":
        process.process(spark, a.root, harvest.ledger_of(spark, a.root)).orderBy("kind", "table_name").show(1000, False)
    elif a.command == "index":
        print("\n".join(process.build_index(spark, a.root)))
    else:
        found = cut(discover(spark, a.jurisdiction))
        if a.command == "discover" and a.json:
            for line in found.toJSON().toLocalIterator():
                print(line)
        elif a.command == "discover":
            found.select("jurisdiction", inventory_line().alias("resource")).orderBy("jurisdiction", "resource").show(10_000, False)
            found.groupBy("jurisdiction").agg(F.count("*").alias("resources"), F.count_if(ledger.downloadable()).alias("downloadable")).orderBy("jurisdiction").show(100, False)
        elif a.command == "plan":
            plan(spark, found, f"{a.root}/ledger", a.force).groupBy("jurisdiction", "status").count().orderBy("jurisdiction", "status").show(1000, False)
        elif a.command == "harvest":
            harvest.run(spark, a.root, found, day, second, a.jurisdiction, a.only, a.force).show()
        else:
            for report in update(spark, a.root, found, day, second, jurisdictions=a.jurisdiction, codes=a.only, force=a.force):
                report.show(1000, False)


if __name__ == "__main__":
    main()
