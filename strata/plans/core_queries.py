"""One query for each capability of the lake, and the SQL that gives the same rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import catalog, chunking, coverage, extract, ledger, search, spatial, vectors
from strata.plans import pipeline
from strata.sources import registry
from strata.streaming import refresh
from strata.util import falsy, scratch, strip, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Registers a function as a query of its name, with its SQL."""

    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


RULES = [("DRILLING", ["drill", "core"]), ("CLAIMS", ["tenure", "claim"]), ("CHEMISTRY", ["geochem", "assay"]), ("SITES", ["mines", "occur"]), ("BOOKS", ["pub"])]
_LABEL = "CASE WHEN contains(t, 'drill') OR contains(t, 'core') THEN 'DRILLING' WHEN contains(t, 'tenure') OR contains(t, 'claim') THEN 'CLAIMS' WHEN contains(t, 'geochem') OR contains(t, 'assay') THEN 'CHEMISTRY' WHEN contains(t, 'mines') OR contains(t, 'occur') THEN 'SITES' WHEN contains(t, 'pub') THEN 'BOOKS' END"


@query(f"SELECT resource_id, code, label FROM (SELECT resource_id, code, {_LABEL} AS label FROM (SELECT *, lower(coalesce(dataset, '')) AS t FROM inventory)) WHERE label IS NOT NULL")
def q_label_first_match(spark: SparkSession, d: str) -> DataFrame:
    """The first rule that a dataset's title meets labels it; without one it is left out."""
    inv = table(spark, d, "inventory")
    return inv.select("resource_id", "code", C.label(F.col("dataset"), RULES).alias("label")).where("label IS NOT NULL")


def _packages(spark: SparkSession, d: str) -> DataFrame:
    """The inventory as packages of a portal: each row one with its resource, rows without resource_id packages without any."""
    one = F.struct(F.col("resource_id").alias("id"), F.col("resource_name").alias("name"), "format", "url", "last_modified", F.lit("once").alias("created"), "size")
    none = F.array().cast("array<struct<id:string,name:string,format:string,url:string,last_modified:string,created:string,size:bigint>>")
    return table(spark, d, "inventory").select(F.col("dataset").alias("title"), F.col("code").alias("name"), F.col("license").alias("license_title"), F.when(F.col("resource_id").isNotNull(), F.array(one)).otherwise(none).alias("resources"))


@query(
    rf"""SELECT label AS code, t AS dataset, resource_id, coalesce(nullif(resource_name, ''), t) AS resource_name, regexp_replace(lower(trim(coalesce(format, ''))), '^\.+', '') AS format,
    url, coalesce(nullif(last_modified, ''), 'once') AS last_modified, size, license
    FROM (SELECT *, {_LABEL.replace("contains(t,", "contains(lower(t),")} AS label FROM (SELECT *, coalesce(nullif(dataset, ''), nullif(code, ''), '') AS t FROM inventory)) WHERE label IS NOT NULL AND resource_id IS NOT NULL"""
)
def q_unnest_resources(spark: SparkSession, d: str) -> DataFrame:
    """One inventory row for each resource of a package that a rule labels; packages without resources have none."""
    rows = pipeline.catalog_inventory(_packages(spark, d), "X", "portal", RULES)
    return rows.select("code", "dataset", "resource_id", "resource_name", "format", "url", "last_modified", "size", "license")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields out of JSON text by an explicit schema."""
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(r"SELECT resource_id, local_path, regexp_replace(lower(trim(coalesce(format, ''))), '^\.+', '') AS format FROM harvest")
def q_format_norm(spark: SparkSession, d: str) -> DataFrame:
    """Formats as written unevenly, in one form."""
    return table(spark, d, "harvest").select("resource_id", "local_path", C.format_norm("format").alias("format"))


@query("SELECT code, url, coalesce(nullif(resource_name, ''), nullif(resource_id, ''), 'data') AS name, coalesce(nullif(last_modified, ''), nullif(license, ''), '') AS modified FROM inventory")
def q_coalesce_falsy(spark: SparkSession, d: str) -> DataFrame:
    """Fallbacks in which an empty text counts as missing."""
    return table(spark, d, "inventory").select("code", "url", falsy("resource_name", "resource_id", F.lit("data")).alias("name"), falsy("last_modified", "license", F.lit("")).alias("modified"))


@query(
    r"WITH b AS (SELECT resource_id, replace(coalesce(nullif(resource_name, ''), nullif(resource_id, ''), 'data'), '/', '_') AS b, regexp_replace(lower(trim(coalesce(format, ''))), '^\.+', '') AS f FROM inventory) "
    r"SELECT resource_id, CASE WHEN regexp_matches(b, '[^.]\.[^.]+$') OR regexp_matches(b, '^\.+[^.]+\.[^.]+$') THEN b ELSE b || '.' || coalesce(nullif(f, ''), 'dat') END AS filename FROM b"
)
def q_raw_filename(spark: SparkSession, d: str) -> DataFrame:
    """The file that a resource is stored as."""
    return table(spark, d, "inventory").select("resource_id", C.raw_filename(F.col("resource_name"), F.col("resource_id"), F.col("format")).alias("filename"))


_STEM = r"regexp_replace(regexp_extract(local_path, '([^/]*)$', 1), '(.)\.[^.]+$', '\1')"
_LAYER = f"left(translate(jurisdiction || '__' || code || '__' || {_STEM}, ' -', '__'), 62)"


@query(f"SELECT local_path, {_LAYER} AS layer FROM harvest")
def q_layer_name(spark: SparkSession, d: str) -> DataFrame:
    """The catalog name of a file's layer or table."""
    return table(spark, d, "harvest").select("local_path", C.layer_name(F.col("jurisdiction"), F.col("code"), C.stem(F.col("local_path"))).alias("layer"))


_FORMATS = ", ".join(f"'{f}'" for f in C.CORE_FORMATS)
_ALLOWED = rf"(regexp_replace(lower(trim(coalesce(format, ''))), '^\.+', '') IN ({_FORMATS}) OR coalesce(connector, '') IN ('arcgis_layer', 'arcgis_hub'))"


@query(f"SELECT resource_id, jurisdiction, code, url FROM inventory WHERE url <> '' AND {_ALLOWED} AND jurisdiction IN ('ON', 'BC') AND upper(code) IN ('ON_DRILL', 'BC_OCCUR', 'BC_TENURE')")
def q_inventory_filter(spark: SparkSession, d: str) -> DataFrame:
    """What a harvest of some jurisdictions and codes would look at."""
    return ledger.select_inventory(table(spark, d, "inventory"), ["on", "bc"], ["on_drill", "BC_OCCUR", "bc_tenure"]).select("resource_id", "jurisdiction", "code", "url")


@query("SELECT jurisdiction, count(*) AS resources, count(*) FILTER (url <> '') AS downloadable, count(*) FILTER (url IS NULL OR url = '') AS pending FROM inventory GROUP BY 1")
def q_inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    """Resources on offer, downloadable and pending, by jurisdiction."""
    down = ledger.downloadable()
    return table(spark, d, "inventory").groupBy("jurisdiction").agg(F.count("*").alias("resources"), F.count_if(down).alias("downloadable"), F.count_if(~down).alias("pending")).orderBy("jurisdiction")


@query("SELECT count(*) FILTER (url <> '') AS downloadable, count(DISTINCT jurisdiction) AS jurisdictions FROM inventory")
def q_inventory_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals over all jurisdictions."""
    return table(spark, d, "inventory").agg(F.count_if(ledger.downloadable()).alias("downloadable"), F.count_distinct("jurisdiction").alias("jurisdictions"))


@query("SELECT DISTINCT code FROM inventory WHERE code IS NOT NULL AND code NOT IN (SELECT code FROM harvest WHERE code IS NOT NULL)")
def q_pending_sources(spark: SparkSession, d: str) -> DataFrame:
    """Codes on offer of which nothing was ever fetched."""
    return registry.unserved(table(spark, d, "inventory"), table(spark, d, "harvest"))


@query(
    "SELECT DISTINCT report_id, source_code || ':' || report_id AS resource_id FROM rag_chunk c WHERE report_id <> '' AND source_code IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM harvest h WHERE h.resource_id = c.source_code || ':' || c.report_id)"
)
def q_pdf_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Reports that the ledger doesn't know."""
    reports = table(spark, d, "rag_chunk").where("report_id <> '' AND source_code IS NOT NULL").select("source_code", "report_id").distinct()
    return ledger.unseen(reports, table(spark, d, "harvest"), F.col("source_code")).select("report_id", "resource_id")


_LATEST = "SELECT resource_id, sha256, ckan_modified, fetched_at, local_path FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY coalesce(fetched_at, '') DESC, sha256 DESC NULLS LAST, ckan_modified DESC NULLS LAST, local_path DESC NULLS LAST) AS k FROM harvest) WHERE k = 1"


@query(_LATEST)
def q_ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    """Each resource's ledger row fetched last."""
    return ledger.latest(table(spark, d, "harvest"))


@query(
    "SELECT resource_id, sha256, local_path, url, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY resource_id, sha256 ORDER BY fetched_at DESC NULLS LAST, local_path DESC NULLS LAST, url DESC NULLS LAST) AS k FROM harvest) WHERE k = 1"
)
def q_ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after all upserts by resource and hash."""
    return ledger.upserted(table(spark, d, "harvest")).select("resource_id", "sha256", "local_path", "url", "fetched_at")


@query(
    f"WITH l AS ({_LATEST}) SELECT i.resource_id, i.url, l.sha256 AS prev_sha256, CASE WHEN i.url IS NULL OR i.url = '' THEN 'pending' WHEN NOT {_ALLOWED} THEN 'excluded' "
    "WHEN l.sha256 IS NULL THEN 'new' WHEN coalesce(l.ckan_modified, '') <> '' AND l.ckan_modified = i.last_modified THEN 'unchanged' ELSE 'fetch' END AS status "
    "FROM inventory i LEFT JOIN l ON l.resource_id = coalesce(nullif(i.resource_id, ''), i.url)"
)
def q_change_detect(spark: SparkSession, d: str) -> DataFrame:
    """What a harvest would do with every resource on offer."""
    return ledger.classify(table(spark, d, "inventory"), table(spark, d, "harvest")).select("resource_id", "url", "prev_sha256", "status")


@query(
    f"WITH l AS ({_LATEST}) SELECT count(*) FILTER (s IN ('new', 'fetch')) AS fetched, count(*) FILTER (s = 'unchanged') AS skipped, 0::BIGINT AS failed, count(*) FILTER (s = 'pending') AS pending FROM (SELECT CASE WHEN i.url IS NULL OR i.url = '' THEN 'pending' WHEN NOT {_ALLOWED} THEN 'excluded' "
    "WHEN l.sha256 IS NULL THEN 'new' WHEN coalesce(l.ckan_modified, '') <> '' AND l.ckan_modified = i.last_modified THEN 'unchanged' ELSE 'fetch' END AS s "
    "FROM inventory i LEFT JOIN l ON l.resource_id = coalesce(nullif(i.resource_id, ''), i.url))"
)
def q_run_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a harvest in which every download succeeds and brings new content."""
    return ledger.counters(ledger.classify(table(spark, d, "inventory"), table(spark, d, "harvest")))


@query(
    r"SELECT resource_id, CASE WHEN url IS NULL OR url = '' THEN 'pending' ELSE regexp_replace(lower(trim(coalesce(format, ''))), '^\.+', '') || ' ' || CASE WHEN coalesce(size, 0) <> 0 THEN printf('%.1fMB', size / 1e6) ELSE '?' END "
    r"|| CASE WHEN coalesce(feature_count, 0) <> 0 THEN ' ~' || feature_count || ' feats' ELSE '' END || ' ' || coalesce(code, '') || ' :: ' || coalesce(resource_name, '') END AS line FROM inventory"
)
def q_inventory_lines(spark: SparkSession, d: str) -> DataFrame:
    """The inventory as it is shown: format, size, features, code and name of each resource."""
    return table(spark, d, "inventory").select("resource_id", pipeline.inventory_line().alias("line"))


@query("SELECT DISTINCT code, split_part(code, '_', 1) AS jurisdiction FROM harvest WHERE code IS NOT NULL")
def q_jurisdiction_of_code(spark: SparkSession, d: str) -> DataFrame:
    """The jurisdiction that each code begins with."""
    return table(spark, d, "harvest").where("code IS NOT NULL").select("code", C.jurisdiction_of(F.col("code")).alias("jurisdiction")).distinct()


@query(
    "WITH l AS (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY coalesce(fetched_at, ''), sha256, local_path) AS k, lag(sha256) OVER (PARTITION BY resource_id ORDER BY coalesce(fetched_at, ''), sha256, local_path) AS p FROM harvest) "
    "SELECT resource_id, local_path, sha256, CASE WHEN p IS NULL THEN 'new' WHEN p = sha256 THEN 'skipped' ELSE 'changed' END AS status FROM l"
)
def q_content_history(spark: SparkSession, d: str) -> DataFrame:
    """Whether each download's content differs from the resource's download before."""
    return ledger.content_history(table(spark, d, "harvest"))


_DATED = "SELECT * REPLACE (regexp_extract(local_path, '/([0-9]{4}-[0-9]{2}-[0-9]{2})/', 1) AS snapshot_date) FROM harvest"


@query(f"WITH h AS ({_DATED}) SELECT jurisdiction, code, resource_id, local_path, snapshot_date FROM (SELECT *, max(snapshot_date) OVER (PARTITION BY jurisdiction, code, resource_id) AS m FROM h) WHERE snapshot_date = m")
def q_snapshot_latest(spark: SparkSession, d: str) -> DataFrame:
    """The files of each resource's newest snapshot."""
    return ledger.latest_snapshot(table(spark, d, "harvest")).select("jurisdiction", "code", "resource_id", "local_path", "snapshot_date")


@query(f"WITH h AS ({_DATED}) SELECT jurisdiction, code, local_path, snapshot_date FROM (SELECT *, max(snapshot_date) OVER (PARTITION BY jurisdiction, code) AS m FROM h) WHERE snapshot_date = m")
def q_snapshot_latest_of_code(spark: SparkSession, d: str) -> DataFrame:
    """The files of each code's newest snapshot, as a dated directory holds them."""
    return ledger.latest_snapshot(table(spark, d, "harvest"), per_resource=False).select("jurisdiction", "code", "local_path", "snapshot_date")


@query(f"WITH h AS ({_DATED}) SELECT snapshot_date, count(*) AS n FROM h WHERE code = 'BC_TENURE' GROUP BY 1")
def q_point_in_time(spark: SparkSession, d: str) -> DataFrame:
    """Files of one code for each snapshot date."""
    return ledger.dated(table(spark, d, "harvest")).where("code = 'BC_TENURE'").groupBy("snapshot_date").agg(F.count("*").alias("n")).orderBy("snapshot_date")


@query(f"WITH h AS ({_DATED}), c AS (SELECT code, snapshot_date, count(*) AS n FROM h GROUP BY ALL) SELECT code, snapshot_date, n, n - lag(n) OVER (PARTITION BY code ORDER BY snapshot_date) AS change FROM c")
def q_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """How many files each snapshot has more than the one before."""
    return ledger.snapshot_counts(table(spark, d, "harvest"))


@query(f"WITH h AS ({_DATED}) SELECT jurisdiction, code, max(snapshot_date) AS last_snapshot, count(*) AS files, max(url) AS sample_url FROM h GROUP BY 1, 2")
def q_provenance(spark: SparkSession, d: str) -> DataFrame:
    """When each source was last refreshed, and from where."""
    rows = ledger.dated(table(spark, d, "harvest"))
    return rows.groupBy("jurisdiction", "code").agg(F.max("snapshot_date").alias("last_snapshot"), F.count("*").alias("files"), F.max("url").alias("sample_url")).orderBy("jurisdiction", "code")


_TEXT = "SELECT 'rag_chunk' AS source_table, chunk_index::BIGINT AS rid, coalesce(company, '') || ' ' || coalesce(commodity, '') AS text FROM rag_chunk"


@query(
    f"{_TEXT} UNION ALL SELECT 'tenure_snapshot', row_no, coalesce(commodity, '') || ' ' || coalesce(status, '') FROM tenure_snapshot"
)
def q_search_text(spark: SparkSession, d: str) -> DataFrame:
    """The unified search text of all tables that have text columns."""
    tables = {"rag_chunk": (table(spark, d, "rag_chunk"), "chunk_index"), "tenure_snapshot": (table(spark, d, "tenure_snapshot"), "row_no"), "region": (table(spark, d, "region"), "r_regionkey")}
    return catalog.search_text(tables)


def _bm25_sql(rows: str, keys: str, terms: tuple[str, ...]) -> str:
    tf = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    score = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / a))" for i in range(len(terms)))
    hit = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    return (
        rf"WITH t AS (SELECT {keys}, text, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}0-9]+'), lambda x: x <> '') AS w FROM ({rows})), "
        f"c AS (SELECT {keys}, text, len(w) AS dl, {tf} FROM t), s AS (SELECT count(*) AS n, avg(dl) AS a, {df} FROM c) "
        f"SELECT {keys}, text, round({score}, 6) AS score FROM c, s WHERE {hit} ORDER BY score DESC, {keys} LIMIT 50"
    )


@query(_bm25_sql("SELECT doc_id, text FROM documents", "doc_id", ("gold", "porphyry")))
def q_bm25(spark: SparkSession, d: str) -> DataFrame:
    """The fifty documents that rank highest for two terms."""
    return search.bm25(table(spark, d, "documents"), "gold porphyry", ["doc_id"])


@query(_bm25_sql("SELECT doc_id, text FROM documents", "doc_id", ("gold", "porphyry")).replace("SELECT doc_id, text, round(", "SELECT doc_id, round("))
def q_bm25_index(spark: SparkSession, d: str) -> DataFrame:
    """The same ranking from a stored index, of which only the rows of both terms are read; the index is built first."""
    path = scratch(spark)
    search.write_index(table(spark, d, "documents"), ["doc_id"], path)
    return search.ranked(spark, path, "gold porphyry", ["doc_id"])


@query(_bm25_sql("SELECT DISTINCT source_table, rid, text FROM search_text", "source_table, rid", ("creek", "gold")))
def q_bm25_tables(spark: SparkSession, d: str) -> DataFrame:
    """The fifty rows of all tables that rank highest for two terms, keyed by table and row."""
    return search.bm25(table(spark, d, "search_text").distinct(), "gold creek", ["source_table", "rid"])


@query(r"SELECT source_table, term, count(*) AS df, sum(tf)::BIGINT AS tf FROM (SELECT source_table, rid, term, count(*) AS tf FROM (SELECT source_table, rid, unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}0-9]+')) AS term FROM search_text) WHERE term <> '' GROUP BY ALL) GROUP BY ALL")
def q_postings(spark: SparkSession, d: str) -> DataFrame:
    """The inverted index, summed up by table and term."""
    index = search.postings(table(spark, d, "search_text"), ["source_table", "rid"])
    return index.groupBy("source_table", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


_VECTOR = "lower(regexp_extract(local_path, '\\.([A-Za-z0-9]+)$', 1)) IN ('shp', 'geojson', 'json', 'kml', 'kmz', 'gpkg', 'gpx')"


@query(f"SELECT DISTINCT 'geo_' || {_LAYER} AS table_name FROM harvest WHERE {_VECTOR}")
def q_distinct_layers(spark: SparkSession, d: str) -> DataFrame:
    """The spatial layers of the lake."""
    return catalog.layers(table(spark, d, "harvest"))


@query(f"SELECT regexp_extract(table_name, '^geo_([A-Z_]+?)__', 1) AS juris, count(*) AS layers FROM (SELECT DISTINCT 'geo_' || {_LAYER} AS table_name FROM harvest WHERE {_VECTOR}) WHERE table_name LIKE 'geo_%' GROUP BY 1")
def q_layers_by_jurisdiction(spark: SparkSession, d: str) -> DataFrame:
    """Layers loaded for each jurisdiction, the most first."""
    return catalog.layers_by_jurisdiction(catalog.layers(table(spark, d, "harvest"))).orderBy(F.desc("layers"), "juris")


@query("SELECT source_table AS table_name, count(*) AS n, min(rid) AS first, max(rid) AS last FROM search_text GROUP BY 1")
def q_table_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each catalog table, by SQL on a view."""
    table(spark, d, "search_text").createOrReplaceTempView("search_text_view")
    return spark.sql("SELECT source_table AS table_name, count(*) AS n, min(rid) AS first, max(rid) AS last FROM search_text_view GROUP BY 1")


_J = [("ON", "'ON'"), ("BC", "'BC'"), ("SK", "'SK'")]


@query(" UNION ALL ".join(f"SELECT {q} AS j, commodity, count(*) AS n FROM rag_chunk WHERE jurisdiction = {q} GROUP BY commodity" for _, q in _J))
def q_commodity_union(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each commodity, province by province; one scan counts them all."""
    rows = table(spark, d, "rag_chunk").where(F.col("jurisdiction").isin([j for j, _ in _J]))
    return rows.groupBy(F.col("jurisdiction").alias("j"), "commodity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "j", "commodity")


@query("SELECT trim(owner) AS owner, count(*) AS n FROM tenure_snapshot WHERE owner IS NOT NULL GROUP BY 1 ORDER BY n DESC, owner LIMIT 25")
def q_top_owners(spark: SparkSession, d: str) -> DataFrame:
    """The twenty-five owners with most tenure rows."""
    rows = table(spark, d, "tenure_snapshot").where("owner IS NOT NULL").groupBy(strip("owner").alias("owner")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "owner").limit(25)


@query("SELECT local_path, row_no, tenure_id, try_cast(area_ha AS DOUBLE) AS area FROM tenure_snapshot WHERE try_cast(area_ha AS DOUBLE) > 500")
def q_try_cast_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows over a threshold of a number kept as text."""
    return table(spark, d, "tenure_snapshot").withColumn("area", F.col("area_ha").try_cast("double")).where("area > 500").select("local_path", "row_no", "tenure_id", "area")


@query("SELECT id, latitude, longitude FROM rag_chunk WHERE (longitude + 90) * (longitude + 90) + (latitude - 52) * (latitude - 52) <= 625")
def q_within_radius(spark: SparkSession, d: str) -> DataFrame:
    """Chunks whose point lies within twenty-five degrees of a point."""
    return table(spark, d, "rag_chunk").where(spatial.within(F.col("longitude"), F.col("latitude"), (-90.0, 52.0), 25.0)).select("id", "latitude", "longitude")


_POINTS = "SELECT DISTINCT id, doc_type, longitude AS x, latitude AS y FROM rag_chunk WHERE longitude IS NOT NULL AND latitude IS NOT NULL"


@query(f"WITH p AS ({_POINTS}) SELECT a.id AS a, b.id AS b, round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), 9) AS d2 FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 4 WHERE a.doc_type = 'tabular_row' AND b.doc_type <> 'tabular_row'")
def q_spatial_join(spark: SparkSession, d: str) -> DataFrame:
    """Report chunks within two degrees of a single record's point."""
    points = table(spark, d, "rag_chunk").where("longitude IS NOT NULL AND latitude IS NOT NULL").select("id", "doc_type", F.col("longitude").alias("x"), F.col("latitude").alias("y")).distinct()
    left, right = points.where("doc_type = 'tabular_row'").select(F.col("id").alias("a"), "x", "y"), points.where("doc_type <> 'tabular_row'").select(F.col("id").alias("b"), "x", "y")
    return spatial.distance_join(left, right, 2.0).select("a", "b", F.round("distance2", 9).alias("d2"))


@query("SELECT i.jurisdiction, count(*) AS expected, count(h.code) AS covered, sum(h.n)::BIGINT AS resources, round_even(count(h.code) / count(*), 2) AS score FROM (SELECT DISTINCT jurisdiction, code FROM inventory WHERE jurisdiction IS NOT NULL AND code IS NOT NULL) i LEFT JOIN (SELECT jurisdiction, code, count(*) AS n FROM harvest WHERE format IS NOT NULL AND lower(format) LIKE '%csv%' GROUP BY 1, 2) h ON h.jurisdiction = i.jurisdiction AND h.code = i.code GROUP BY 1")
def q_coverage_score(spark: SparkSession, d: str) -> DataFrame:
    """Expected and covered codes of each jurisdiction, the resources that cover them, and the covered share."""
    expected, populated = table(spark, d, "inventory").where("jurisdiction IS NOT NULL AND code IS NOT NULL"), table(spark, d, "harvest").where("lower(format) LIKE '%csv%'")
    return coverage.scores(expected, populated)


@query("SELECT DISTINCT jurisdiction, code FROM inventory i WHERE jurisdiction IS NOT NULL AND code IS NOT NULL AND NOT EXISTS (SELECT 1 FROM harvest h WHERE h.jurisdiction = i.jurisdiction AND h.code = i.code AND lower(format) LIKE '%csv%')")
def q_coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Expected codes that nothing covers."""
    return coverage.gaps(table(spark, d, "inventory").where("jurisdiction IS NOT NULL AND code IS NOT NULL"), table(spark, d, "harvest").where("lower(format) LIKE '%csv%'"))


_TEXTS = r"(SELECT id, 'Submitted by: ' || coalesce(company, '') || '.' || chr(10) || coalesce(chunk_text, '') AS t FROM rag_chunk)"
_PAGE = f"(SELECT id, left(t, 3000) AS t FROM {_TEXTS})"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts put together from chunks, unaltered."""
    text = F.concat(F.lit("Submitted by: "), F.coalesce("company", F.lit("")), F.lit(".\n"), F.coalesce("chunk_text", F.lit("")))
    return table(spark, d, "rag_chunk").select("id", text.alias("t"))


def _re2(pattern: str) -> str:
    """A pattern of the extractors for SQL, whose dialect has no flag for Unicode classes; see _ASCII."""
    return re.sub(r"\(\?([a-zA-Z]+)\)", lambda m: "(?" + "".join(f for f in m[1] if f in "im") + ")" if set(m[1]) & set("im") else "", pattern, count=1)


#: The text for SQL whose \\b knows ASCII only: letters and digits beyond it become underscores, other signs bars.
_ASCII = r"regexp_replace(regexp_replace(regexp_replace(t, '[\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]', ' ', 'g'), '[^\x00-\x7F\p{L}\p{N}\p{M}]', '|', 'g'), '[^\x00-\x7F]', '_', 'g')"
_NTS_SQL = f"regexp_extract({_ASCII}, '{_re2(extract.NTS)}', 1)"


@query(f"SELECT id, {_NTS_SQL} AS nts_sheet FROM {_TEXTS}")
def q_extract_nts(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("id", extract.nts_sheet(F.col("t")).alias("nts_sheet"))


_COMPANY_SQL = (
    f"coalesce(list_filter(list_transform(regexp_extract_all(t, '{_re2(extract.COMPANY)}', 1), "
    r"lambda c: regexp_replace(regexp_replace(c, '^\s+|\s+$', '', 'g'), '\.+$', '')), lambda c: c <> '' AND length(c) < 100)[1], '')"
)


@query(f"SELECT id, {_COMPANY_SQL} AS company FROM {_TEXTS}")
def q_extract_company(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("id", extract.company(F.col("t")).alias("company"))


_METALS_SQL = f"list_sort(list_distinct(list_transform(regexp_extract_all({_ASCII}, '{_re2(extract.COMMODITIES)}', 0), lambda c: lower(c))))"


@query(f"SELECT id, array_to_string({_METALS_SQL}, '|') AS commodities FROM {_TEXTS}")
def q_extract_commodities(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("id", F.array_join(extract.commodities(F.col("t")), "|").alias("commodities"))


_DECIDE = "CASE " + " ".join(f"WHEN contains(m, '{key}') THEN '{kind}'" for key, kind in extract.TYPES.items()) + " END"
_TYPE_SQL = f"coalesce(list_filter(list_transform(regexp_extract_all({_ASCII}, '{_re2(extract.REPORT_TYPE)}', 0), lambda x: list_transform([lower(x)], lambda m: {_DECIDE})[1]), lambda x: x IS NOT NULL)[1], 'assessment_report_general')"


@query(f"SELECT id, {_TYPE_SQL} AS report_type FROM {_TEXTS}")
def q_extract_report_type(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("id", extract.report_type(F.col("t")).alias("report_type"))


@query(f"SELECT id, {_NTS_SQL} AS nts_sheet, {_COMPANY_SQL} AS company, array_to_string({_METALS_SQL}, '|') AS commodities, {_TYPE_SQL} AS report_type FROM {_PAGE}")
def q_extract_metadata(spark: SparkSession, d: str) -> DataFrame:
    return extract.metadata(_texts(spark, d), "t").select("id", "nts_sheet", "company", F.array_join("commodities", "|").alias("commodities"), "report_type")


_CHUNKS = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents),
p AS (SELECT doc_id, t, string_split_regex(t, '\n\s*\n+') AS raw FROM d),
q AS (SELECT doc_id, raw, list_filter(list_transform(raw, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM p WHERE length(t) >= 200),
r AS (
  SELECT doc_id, raw, ps, 1 AS i, []::VARCHAR[] AS cur, 0::BIGINT AS n, []::VARCHAR[] AS got FROM q
  UNION ALL
  SELECT doc_id, raw, ps, i + 1, CASE WHEN f THEN [ps[i]] ELSE list_append(cur, ps[i]) END, CASE WHEN f THEN length(ps[i]) ELSE n + length(ps[i]) END,
    CASE WHEN f AND length(b) >= 200 THEN list_append(got, b) ELSE got END
  FROM (SELECT *, n + length(ps[i]) > 1400 AND len(cur) > 0 AS f, array_to_string(cur, chr(10) || chr(10)) AS b FROM r WHERE i <= len(ps))),
e AS (SELECT doc_id, raw, CASE WHEN len(cur) > 0 AND length(array_to_string(cur, chr(10) || chr(10))) >= 200 THEN list_append(got, array_to_string(cur, chr(10) || chr(10))) ELSE got END AS got FROM r WHERE i = len(ps) + 1),
c AS (SELECT doc_id, CASE WHEN len(got) > 0 THEN got ELSE [raw[1]] END AS cs FROM e UNION ALL SELECT doc_id, [t] FROM p WHERE length(t) < 200),
x AS (SELECT doc_id, unnest(range(len(cs))) AS chunk_index, unnest(list_transform(cs, lambda s: left(s, 1400))) AS chunk FROM c)
"""


@query(_CHUNKS + "SELECT doc_id, chunk_index, chunk FROM x")
def q_chunk(spark: SparkSession, d: str) -> DataFrame:
    """The paragraph chunks of every document."""
    return chunking.chunked(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk")


@query("SELECT id AS stored, left(sha256(coalesce(jurisdiction, '') || ':' || coalesce(source_code, '') || ':' || coalesce(nullif(source_url, ''), report_id, '') || ':' || chunk_index), 32) AS id, chunk_index FROM rag_chunk")
def q_chunk_id(spark: SparkSession, d: str) -> DataFrame:
    """The id that each chunk's place gives it."""
    rows = table(spark, d, "rag_chunk")
    made = chunking.chunk_id(F.col("jurisdiction"), F.col("source_code"), F.col("source_url"), F.col("report_id"), F.col("chunk_index"))
    return rows.select(F.col("id").alias("stored"), made.alias("id"), "chunk_index")


@query(_CHUNKS + "SELECT doc_id, chunk, min(chunk_index) AS chunk_index FROM x GROUP BY ALL")
def q_chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of every document, equal texts once."""
    rows = chunking.without_repeats(chunking.chunked(table(spark, d, "documents").select("doc_id", "text")), ["doc_id"])
    return rows.select("doc_id", "chunk", F.col("chunk_index").cast("long").alias("chunk_index"))


def _reports(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(F.lit("ON").alias("jurisdiction"), F.col("source").alias("source_code"), F.col("doc_id").cast("string").alias("report_id"), F.lit("").alias("source_url"), "text")


@query(
    _CHUNKS
    + f""", m AS (SELECT doc_id, {_NTS_SQL} AS nts_sheet, {_COMPANY_SQL} AS company, '[' || array_to_string(list_transform({_METALS_SQL}, lambda c: '"' || c || '"'), ',') || ']' AS commodity, {_TYPE_SQL} AS doc_type
      FROM (SELECT doc_id, left(coalesce(text, ''), 3000) AS t FROM documents))
    SELECT left(sha256('ON:' || coalesce(source, '') || ':' || x.doc_id || ':' || chunk_index), 32) AS id, chunk AS text, 'ON' AS jurisdiction, source AS source_code, x.doc_id::VARCHAR AS report_id, '' AS source_url,
      doc_type, commodity, company, nts_sheet, chunk_index::INT AS chunk_index
    FROM (SELECT doc_id, chunk, min(chunk_index) AS chunk_index FROM x GROUP BY ALL) x JOIN d ON d.doc_id = x.doc_id JOIN m ON m.doc_id = x.doc_id"""
)
def q_rag_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Documents as they go into a vector collection."""
    return chunking.ingest(_reports(spark, d))


@query(_CHUNKS + ", g AS (SELECT doc_id, count(DISTINCT chunk) AS n FROM x GROUP BY 1) SELECT count(*) AS total, count(*) FILTER (n > 0) AS ingested, 0::BIGINT AS failed, count(*) FILTER (coalesce(n, 0) = 0) AS skipped, sum(n)::BIGINT AS chunks FROM d LEFT JOIN g USING (doc_id)")
def q_ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of an ingestion."""
    docs = _reports(spark, d)
    return chunking.counters(docs, chunking.ingest(docs))


@query("SELECT doc_id, length(left(text, 800)) AS n, left(text, 800) AS shown FROM documents")
def q_truncate_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut to the first length that an embedder's context of 999 characters takes."""
    cut = C.ladder(F.col("text"), 999)
    return table(spark, d, "documents").select("doc_id", F.length(cut).alias("n"), cut.alias("shown"))


def _vector(spark: SparkSession, d: str) -> list[float]:
    return table(spark, d, "embeddings").where("vec_id = 0").head()["embedding"]


_DIST = "list_sum(list_transform(list_zip(e.embedding, q.v), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"


@query(f"WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, round({_DIST}, 6) AS distance, row_number() OVER (ORDER BY {_DIST}, vec_id)::INT AS rank FROM embeddings e, q ORDER BY {_DIST}, vec_id LIMIT 10")
def q_vector_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten vectors nearest to one."""
    return vectors.nearest(table(spark, d, "embeddings"), _vector(spark, d), 10, "vec_id").select("vec_id", F.round("distance", 6).alias("distance"), "rank")


@query(f"WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0) SELECT vec_id, label, round({_DIST}, 6) AS distance FROM embeddings e, q WHERE label = 3 ORDER BY {_DIST}, vec_id LIMIT 10")
def q_vector_filtered(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest of those whose metadata fit."""
    return vectors.nearest(table(spark, d, "embeddings"), _vector(spark, d), 10, "vec_id", where=F.col("label") == 3).select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query(f"SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM (SELECT q.vec_id AS query_id, e.vec_id, {_DIST.replace('q.v)', 'q.embedding)')} AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_DIST.replace('q.v)', 'q.embedding)')}, e.vec_id)::INT AS rank FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0) WHERE rank <= 10")
def q_vector_batch(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest of all vectors to each vector whose id is divisible by 100."""
    rows = table(spark, d, "embeddings")
    return vectors.nearest_of_each(rows.where("vec_id % 100 = 0"), rows, 10, "vec_id").select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "rank")


@query("SELECT vec_id, label + 100 AS label FROM embeddings WHERE vec_id % 3 = 0 UNION ALL SELECT vec_id, label FROM embeddings WHERE vec_id % 3 <> 0")
def q_vector_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A collection after a batch with repeated ids, of which the first stands."""
    rows = table(spark, d, "embeddings")
    new = rows.where("vec_id % 3 = 0").withColumn("label", F.col("label") + 100)
    batch = new.unionByName(new.withColumn("label", F.col("label") + 100))
    return vectors.upsert(rows, batch, "vec_id", [F.col("label")]).select("vec_id", "label")


@query("SELECT vec_id, round(v[1] / n, 6) AS first, round(v[64] / n, 6) AS last FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3) AS v, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 3 * x::DOUBLE * 3))) AS n FROM embeddings)")
def q_normalize_vector(spark: SparkSession, d: str) -> DataFrame:
    """Vectors brought to length one."""
    rows = table(spark, d, "embeddings").select("vec_id", C.l2_normalize(F.transform("embedding", lambda x: x.cast("double") * 3)).alias("v"))
    return rows.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(63)), 6).alias("last"))


@query(f"WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0), n AS (SELECT vec_id, label, {_DIST} AS distance FROM embeddings e, q ORDER BY distance, vec_id LIMIT 20) SELECT vec_id, label, round(distance, 6) AS distance, r_name FROM n JOIN region ON r_regionkey = label % 5")
def q_hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    """Vector hits with what the catalog holds of them."""
    hits = vectors.nearest(table(spark, d, "embeddings"), _vector(spark, d), 20, "vec_id").select("vec_id", "label", F.round("distance", 6).alias("distance"), (F.col("label") % 5).alias("r_regionkey"))
    return hits.join(table(spark, d, "region"), "r_regionkey").select("vec_id", "label", "distance", "r_name")


@query(
    "SELECT id, k, v FROM (SELECT id, unnest(['company', 'latitude', 'chunk_index', 'tags']) AS k, unnest([company, CASE WHEN latitude IS NULL THEN NULL ELSE 'set' END, chunk_index::VARCHAR, '[\"' || coalesce(jurisdiction, '') || '\",\"' || coalesce(source_code, '') || '\"]']) AS v FROM rag_chunk) WHERE v IS NOT NULL"
)
def q_meta_scalarize(spark: SparkSession, d: str) -> DataFrame:
    """Metadata as scalars: nulls left out, lists as JSON."""
    tags = F.array(F.coalesce("jurisdiction", F.lit("")), F.coalesce("source_code", F.lit("")))
    values = {"company": F.col("company"), "latitude": F.when(F.col("latitude").isNotNull(), "set"), "chunk_index": F.col("chunk_index"), "tags": tags}
    return table(spark, d, "rag_chunk").select("id", F.explode(C.scalar_map(values, ["tags"])).alias("k", "v"))


_OWN = ("jurisdiction", "source_code", "doc_type", "chunk_index", "source_url", "report_id", "commodity", "company", "nts_sheet", "feature_type")


@query(
    f"WITH o AS (SELECT id, metadata, unnest([{', '.join(repr(k) for k in _OWN)}]) AS k, unnest([{', '.join(k + '::VARCHAR' for k in _OWN)}]) AS v FROM rag_chunk), "
    "e AS (SELECT id, unnest(map_entries(metadata)) AS e FROM rag_chunk) "
    "SELECT id, k, v FROM o WHERE v IS NOT NULL AND NOT coalesce(list_contains(map_keys(metadata), k), false) UNION ALL SELECT id, e.key AS k, e.value AS v FROM e WHERE e.value IS NOT NULL"
)
def q_to_record(spark: SparkSession, d: str) -> DataFrame:
    """Chunks as flat records; what the metadata name overrides the columns."""
    own = {k: F.col(k) for k in _OWN}
    rows = table(spark, d, "rag_chunk").select(chunking.record(F.col("id"), F.col("chunk_text"), own, F.col("metadata")).alias("r"))
    return rows.select("r.id", F.explode("r.metadata").alias("k", "v"))


@query("SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes FROM documents")
def q_content_hash(spark: SparkSession, d: str) -> DataFrame:
    """Hash and size of contents, as the ledger keeps them."""
    return table(spark, d, "documents").select("doc_id", C.content_hash(F.col("text")).alias("h")).select("doc_id", "h.*")


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def q_events_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hourly sums of events, the batch form of the streaming refresh's counters."""
    return refresh.hourly(table(spark, d, "events")).select("event_type", F.col("window.start").alias("hour"), "n", F.round("total", 4).alias("total"))
