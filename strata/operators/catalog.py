"""The catalog: tables of a lake folder as views, their columns, and the unified search text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import layer_name, stem
from strata.util import salted_join

#: Columns that the search text is made of, in this order.
TEXT_COLUMNS = ("COMPANY", "COMPANY_NAME", "TITLE", "COMMODITY", "COMMODITIES", "TOWNSHIP", "NAME", "STATUS", "DEPOSIT", "DEPOSIT_NAME", "AUTHOR", "MINERAL", "OCCURRENCE", "REPORT", "WORK_TYPE")


def load(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Registers every Parquet table of a folder as a view, in the order of their names; returns the views' names."""
    names = []
    for path in listed(spark, f"{folder}/*.parquet"):
        name = prefix + path.rsplit("/", 1)[-1].removesuffix(".parquet")
        spark.read.parquet(path).createOrReplaceTempView(name)
        names.append(name)
    return names


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches on any file system the session knows, in order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def with_row_ids(df: DataFrame) -> DataFrame:
    """Adds __rid, a stored table's row number: the place of its file among the table's files, and its place in the file."""
    order = {path.rsplit("/", 1)[-1]: k for k, path in enumerate(sorted(df.inputFiles()))}
    place = F.create_map(*[F.lit(x) for path, k in order.items() for x in (path, k)]) if order else F.lit(None).cast("map<string,int>")
    return df.withColumn("__rid", F.try_element_at(place, F.col("_metadata.file_name")).cast("long") * F.lit(2**40) + F.col("_metadata.row_index"))


def columns(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, position, column_name, data_type) of the named views."""
    rows = [(t, i, c, kind) for t in names for i, (c, kind) in enumerate(spark.table(t).dtypes)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def text_columns(df: DataFrame, wanted: tuple[str, ...] = TEXT_COLUMNS) -> list[str]:
    """The table's columns of the list, in the list's order and any case; of two that differ in case only the last stands."""
    have = {c.upper(): c for c in df.columns}
    return [have[w] for w in wanted if w in have]


def search_text(tables: dict[str, tuple[DataFrame, str]], wanted: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame | None:
    """(source_table, rid, text) of all tables: name to (table, key column); nulls are empty and leave their blank.

    Tables without such a column have no rows; None if no table has one.
    """
    parts = []
    for name, (df, key) in tables.items():
        present = text_columns(df, wanted)
        if present:
            words = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in present]
            parts.append(df.select(F.lit(name).alias("source_table"), F.col(f"`{key}`").cast("long").alias("rid"), F.concat_ws(" ", *words).alias("text")))
    return reduce(DataFrame.unionAll, parts) if parts else None


def harvested_search_text(unified: DataFrame, wanted: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    """(source_table, rid, text) of the unified lines (source_table, local_path, row_no, fields map) of each table's last file."""
    last = unified.groupBy("source_table").agg(F.max(F.struct(F.regexp_extract("local_path", r"/(\d{4}-\d{2}-\d{2})/", 1).alias("d"), F.col("local_path").alias("p"))).alias("m"))
    rows = salted_join(unified.select("source_table", F.col("local_path").alias("p"), "row_no", "fields"), last.select("source_table", F.col("m.p").alias("p")), ["source_table", "p"], spread=F.col("row_no"))
    here = F.filter(F.array(*[F.lit(w.lower()) for w in wanted]), lambda w: F.map_contains_key("fields", w))
    return rows.select("source_table", F.col("row_no").alias("rid"), F.array_join(F.transform(here, lambda w: F.coalesce(F.try_element_at("fields", w), F.lit(""))), " ").alias("text"))


def layers(ledger: DataFrame) -> DataFrame:
    """(table_name): the spatial layers of the ledger's vector files, named as in the catalog."""
    vector = ledger.where(F.lower(F.regexp_extract("local_path", r"\.([A-Za-z0-9]+)$", 1)).isin("shp", "geojson", "json", "kml", "kmz", "gpkg", "gpx"))
    return vector.select(F.concat(F.lit("geo_"), layer_name(F.col("jurisdiction"), F.col("code"), stem(F.col("local_path")))).alias("table_name")).distinct()


def layers_by_jurisdiction(names: DataFrame) -> DataFrame:
    """(juris, layers) of table names geo_<jurisdiction>__...; other names count under ''."""
    spatial = names.where(F.col("table_name").like("geo_%"))
    return spatial.groupBy(F.regexp_extract("table_name", r"^geo_([A-Z_]+?)__", 1).alias("juris")).agg(F.count("*").alias("layers"))
