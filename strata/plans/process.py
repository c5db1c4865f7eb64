"""From harvested files to the tables, layers and indexes of a lake folder.

processed/tables/<name>.parquet, processed/layers/table_name=<name>/ and index/ are made anew by each run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import columns as C
from strata.functions import english
from strata.operators import catalog, ledger, search
from strata.sources import files
from strata.util import cut

TABLES = ("csv", "tsv", "xlsx")
#: Tables that are read beside each other; each is a Spark job of its own, as each has a schema of its own.
BESIDE = 8
REPORT = "table_name string, kind string, path string, n long, status string"


def _suffix(path: str) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def process(spark: SparkSession, root: str, known: DataFrame, readers: dict[str, Callable] | None = None, per_resource: bool = True) -> DataFrame:
    """Loads the newest snapshots of a ledger; returns (table_name, kind, path, n, status): loaded, empty (and skipped) or failed.

    Archives are opened, archives in them too. Vector files become layers with WGS 84 coordinates, .csv, .tsv and .xlsx files
    tables. A file that can't be read fails by itself. Of files with one name, the names of the second and later ones get a
    number. `readers` adds vector formats, see files.features().
    """
    newest = ledger.latest_snapshot(known, per_resource).where("local_path IS NOT NULL").select(F.col("local_path").alias("path")).distinct()
    place = r"/raw/([^/]+)/([^/]+)/\d{4}-\d{2}-\d{2}/"
    expanded = files.expand_archives(files.opened(newest))
    name = lambda extra: C.layer_name(F.regexp_extract("path", place, 1), F.regexp_extract("path", place, 2), extra)
    shapes = files.features(expanded, readers).withColumn("__stem", F.concat_ws("__", C.stem(F.col("path")), F.nullif("layer", F.lit(""))))
    shapes = _numbered(shapes, name(F.col("__stem")), ["path", "layer"])
    layers = f"{root}/processed/layers"
    good = shapes.where("properties IS NOT NULL").drop("__stem")
    good.write.mode("overwrite").partitionBy("table_name").parquet(layers)
    failed = shapes.where("properties IS NULL").select("table_name", F.lit("layer").alias("kind"), "path", F.lit(0).cast("long").alias("n"), F.lit("failed").alias("status"))
    failed = failed.unionAll(expanded.where("content IS NULL").select(F.lit(None).cast("string"), F.lit("file"), "path", F.lit(0).cast("long"), F.lit("failed")))
    done = spark.read.schema(good.schema).parquet(layers).groupBy("table_name").agg(F.min("path").alias("path"), F.count("*").alias("n"))
    done = done.select("table_name", F.lit("layer").alias("kind"), "path", "n", F.lit("loaded").alias("status"))
    tables = _tables(spark, root, _numbered(expanded.where(_suffix("path").isin(*TABLES) & F.col("content").isNotNull()), name(C.stem(F.col("path"))), ["path"]))
    return cut(failed.unionAll(done).unionAll(spark.createDataFrame(tables, REPORT)))


def _numbered(df: DataFrame, name: Column, by: list[str]) -> DataFrame:
    """Adds table_name; different files of one name are told apart by a number."""
    rows = df.withColumn("__name", name)
    which = rows.select("__name", *by).distinct().withColumn("__nth", F.row_number().over(Window.partitionBy("__name").orderBy(*by)))
    rows = rows.join(which, ["__name", *by])
    return rows.withColumn("table_name", F.when(F.col("__nth") == 1, F.col("__name")).otherwise(F.concat_ws("_", "__name", F.col("__nth").cast("string")))).drop("__name", "__nth")


def _tables(spark: SparkSession, root: str, found: DataFrame) -> list[tuple]:
    """Writes each table of its own schema; (table_name, 'table', path, n, status)."""
    work = f"{root}/processed/work"

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for table, path, data in zip(batch.table_name, batch.path, batch.content):
                target = f"{work}/{table}.{path.rsplit('.', 1)[-1].lower()}"
                system, inner = files.file_system(target)
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as f:
                    f.write(data)
                out.append((table, path, target))
            yield pd.DataFrame(out, columns=["table_name", "path", "target"])

    rows = cut(found.select("table_name", "path", "content").mapInPandas(unpack, "table_name string, path string, target string")).collect()  # the catalog's tables

    def load(r) -> tuple:  # noqa: ANN001
        try:
            df = _sheet(spark, r["target"]) if r["target"].endswith(".xlsx") else files.read_table(spark, r["target"])
            target = f"{root}/processed/tables/{r['table_name']}.parquet"
            if df is None or df.isEmpty():
                return r["table_name"], "table", r["path"], 0, "empty"
            df.write.mode("overwrite").parquet(target)
            return r["table_name"], "table", r["path"], spark.read.parquet(target).count(), "loaded"
        except Exception:  # noqa: BLE001 - one unreadable table must not end the others
            return r["table_name"], "table", r["path"], 0, "failed"

    with ThreadPoolExecutor(BESIDE) as pool:
        return list(pool.map(load, rows))


def _sheet(spark: SparkSession, path: str) -> DataFrame | None:
    """A workbook's first sheet as a table of text, its first row being the header; unnamed columns are called by their number."""
    rows = cut(files.sheets(files.opened(spark.createDataFrame([(path,)], "path string"))))
    head = rows.where("row_no = 0").head()
    if head is None:
        return None
    names: list[str] = []
    for k, cell in enumerate(head["cells"]):
        name = (cell or "").strip() or f"column_{k + 1}"
        names.append(name if name.lower() not in {n.lower() for n in names} else f"{name}_{k + 1}")
    return rows.where("row_no > 0").orderBy("row_no").select(*[F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(names)])


def build_index(spark: SparkSession, root: str) -> list[str]:
    """Registers a lake folder's tables, layers (as geo_<name>) and ledger (as resources) as views, and writes the search index.

    index/search_text holds (source_table, rid, text), rid being a row's place in the files of its table; index/terms the
    inverted index over it, of stems without accents and common words. Returns the views' names.
    """
    names = catalog.load(spark, f"{root}/processed/tables")
    tables: dict[str, tuple[DataFrame, str]] = {n: (catalog.with_row_ids(spark.read.parquet(f"{root}/processed/tables/{n}.parquet")), "__rid") for n in names}
    shapes = f"{root}/processed/layers"
    for path in catalog.listed(spark, f"{shapes}/table_name=*"):
        name = path.rsplit("=", 1)[-1]
        layer = spark.read.parquet(path)
        keys = [r["k"] for r in layer.select(F.explode(F.map_keys("properties")).alias("k")).distinct().orderBy("k").collect()]  # the layer's columns
        own = [F.try_element_at("properties", F.lit(k)).alias(k) for k in keys if k.lower() not in ("geometry", "lon", "lat")]
        layer.select(*own, "geometry", "lon", "lat").createOrReplaceTempView(f"geo_{name}")
        tables[f"geo_{name}"] = (catalog.with_row_ids(layer).select("__rid", *own), "__rid")
        names.append(f"geo_{name}")
    spark.read.parquet(f"{root}/ledger").createOrReplaceTempView("resources")
    text = catalog.search_text(tables)
    if text is not None:
        text.write.mode("overwrite").parquet(f"{root}/index/search_text")
        stored = spark.read.parquet(f"{root}/index/search_text")
        stored.createOrReplaceTempView("search_text")
        search.write_index(stored, ["source_table", "rid"], f"{root}/index/terms", analyze=english.terms)
    return [*names, "resources"]


def search_lake(spark: SparkSession, root: str, query: str, limit: int = 50) -> DataFrame:
    """(source_table, rid, text, score): the rows of all tables that rank highest, from the stored index."""
    best = search.ranked(spark, f"{root}/index/terms", query, ["source_table", "rid"], limit, analyze=english.terms)
    text = spark.read.parquet(f"{root}/index/search_text")
    return text.join(F.broadcast(best), ["source_table", "rid"]).select("source_table", "rid", "text", "score").orderBy(F.desc("score"), "source_table", "rid")  # `limit` rows
