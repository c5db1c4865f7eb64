"""The registry of sources: what is declared here is all that a new source needs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.portals import LayerReader

SCHEMA = (
    "position int, jurisdiction string, key string, type string, portal string, fq string, code string, "
    "match array<struct<code:string,needles:array<string>>>, layers map<string,string>, items map<string,string>"
)

#: Public portals, the filter that scopes each, and the words by which their datasets are told.
SOURCES: list[dict] = [
    {"jurisdiction": "FED", "key": "OPEN_CANADA", "type": "ckan", "portal": "https://open.canada.ca/data/en", "fq": "organization:nrcan-rncan", "match": [
        ("CGMC", ["geological map compilation"]), ("CDoGS", ["geochemical surveys", "canadian database of geochemical"]),
        ("GEOPHYSICS", ["geophysical data repository", "aeromagnetic", "gravity", "radiometric"]), ("NATIONAL_TENURE", ["mineral tenure", "mineral claims"]),
        ("MINERAL_DEPOSITS", ["mineral deposits", "national mineral"])]},
    {"jurisdiction": "ON", "key": "ckan", "type": "ckan", "portal": "https://data.ontario.ca", "fq": "organization:mines", "match": [
        ("ON_ODHD", ["drill hole"]), ("ON_OAFD", ["assessment file"]), ("ON_OMI", ["mineral inventory", "mineral deposit"]), ("ON_AMIS", ["abandoned mines"]), ("ON_PUB", ["publication"]),
        ("ON_GEOL_BEDROCK", ["bedrock geology"]), ("ON_GEOL_SURFICIAL", ["surficial geology"]), ("ON_NOEGTS", ["engineering geology terrain", "noegts"]), ("ON_OSTR", ["surficial terrain"]),
        ("ON_GEOPHYS", ["geophysical", "aeromagnetic", "gravity"]), ("ON_GEOCHEM", ["lake geochemistry", "geochemistry"])]},
    {"jurisdiction": "ON", "key": "scrape", "type": "scrape", "portal": "https://www.geologyontario.mndm.gov.on.ca", "code": "ON_AFRI_PDF"},
    {"jurisdiction": "BC", "key": "ckan", "type": "ckan", "portal": "https://catalogue.data.gov.bc.ca", "fq": "tags:mineral OR tags:geology", "match": [
        ("BC_MTO_CURRENT", ["mineral, placer and coal titles", "current titles"]), ("BC_MTO_HISTORIC", ["historical titles", "historic mineral"]), ("BC_MTA_GRID", ["mineral placer grid", "mta - mineral"]),
        ("BC_MINFILE", ["minfile"]), ("BC_GEOL", ["bedrock geology", "geology of british columbia"]), ("BC_GEOCHEM", ["regional geochemical", "rgs"])]},
    {"jurisdiction": "BC", "key": "scrape", "type": "scrape", "portal": "https://www2.gov.bc.ca/gov/content/industry/mineral-exploration-mining/british-columbia-geological-survey/assessmentreports", "code": "BC_ARIS_PDF"},
    {"jurisdiction": "QC", "key": "arcgis", "type": "arcgis", "portal": "https://sigeom.mines.gouv.qc.ca"},
    {"jurisdiction": "SK", "key": "arcgis_hub", "type": "arcgis", "portal": "https://geohub.saskatchewan.ca", "items": {"SK_SMDI": "2ba80b329aad4018b6eacd56220dc10b"},
     "layers": {"SK_MINERAL_EXPLORATION": "https://gis.saskatchewan.ca/egis/rest/services/Economy/Mineral_Exploration/FeatureServer/1"}},
    {"jurisdiction": "SK", "key": "scrape", "type": "scrape", "portal": "https://gisappl.saskatchewan.ca/geoatlas", "code": "SK_SMAD_PDF"},
    {"jurisdiction": "MB", "key": "scrape", "type": "scrape", "portal": "https://www.gov.mb.ca/iem/geo/gis/databases.html", "code": "MB_MAPGALLERY"},
    {"jurisdiction": "NL", "key": "scrape", "type": "scrape", "portal": "https://www.gov.nl.ca/iet/mines/geoscience/geofiles/", "code": "NL_GEOFILES_PDF"},
    {"jurisdiction": "NS", "key": "scrape", "type": "scrape", "portal": "https://novascotia.ca/natr/meb/geoscience-online/", "code": "NS_DCDH"},
    {"jurisdiction": "AB", "key": "scrape", "type": "scrape", "portal": "https://ags.aer.ca/data-maps-models/digital-data", "code": "AB_AGS"},
    {"jurisdiction": "NB", "key": "scrape", "type": "scrape", "portal": "https://www2.gnb.ca/content/gnb/en/departments/natural_resources/Minerals/content/Geoscience.html", "code": "NB_GEOSCIDB"},
    {"jurisdiction": "YT", "key": "arcgis", "type": "arcgis", "portal": "https://data.geology.gov.yk.ca"},
    {"jurisdiction": "NT_NU", "key": "scrape", "type": "scrape", "portal": "https://www.nwtgeoscience.ca", "code": "NTGS"},
]


def registry(spark: SparkSession, sources: list[dict] | None = None) -> DataFrame:
    """The declared sources in their order; `match` is an array, as its order decides a title's label."""
    rows = []
    for k, s in enumerate(SOURCES if sources is None else sources):
        rows.append((k, s["jurisdiction"], s["key"], s["type"], s.get("portal"), s.get("fq"), s.get("code"), [(c, list(n)) for c, n in s.get("match", [])], s.get("layers", {}), s.get("items", {})))
    return spark.createDataFrame(rows, SCHEMA)


INVENTORY = ("jurisdiction", "connector", "code", "dataset", "resource_id", "resource_name", "format", "url", "last_modified", "size", "license", "portal", "feature_count", "note")


def _inventory(df: DataFrame, **values) -> DataFrame:  # noqa: ANN003
    kinds = {"size": "long", "feature_count": "int"}
    return df.select(*[(values[c] if c in values else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in INVENTORY])


def feature_count(url: str) -> Column:
    """The number of features that the server of each layer tells; null if it doesn't."""

    @F.pandas_udf("int")
    def counted(urls: pd.Series) -> pd.Series:
        return pd.Series([LayerReader({"base": u}).count() if u else None for u in urls], dtype="Int32")

    return counted(url)


def arcgis_inventory(sources: DataFrame, counts: bool = False) -> DataFrame:
    """One inventory row for each declared layer and hub item; with `counts` the servers are asked for the features of their layers."""
    own = sources.where("type = 'arcgis'")
    layers = own.select("jurisdiction", "portal", F.explode("layers").alias("c", "u"))
    base = F.regexp_replace("portal", "/+$", "")
    items = own.select("jurisdiction", "portal", F.explode("items").alias("c", "i"))
    a = _inventory(layers, jurisdiction=F.col("jurisdiction"), connector=F.lit("arcgis_layer"), code=F.col("c"), dataset=F.col("c"), resource_id=F.col("c"), resource_name=F.col("c"), format=F.lit("geojson"), url=F.col("u"), last_modified=F.lit(""), portal=F.col("portal"), feature_count=feature_count("u") if counts else F.lit(None))
    url = F.concat(base, F.lit("/api/download/v1/items/"), F.col("i"), F.lit("/geojson?layers=1"))
    b = _inventory(items, jurisdiction=F.col("jurisdiction"), connector=F.lit("arcgis_hub"), code=F.col("c"), dataset=F.col("c"), resource_id=F.col("i"), resource_name=F.col("c"), format=F.lit("geojson"), url=url, last_modified=F.lit(""), portal=F.col("portal"))
    return a.unionByName(b)


def scrape_inventory(sources: DataFrame) -> DataFrame:
    """One row without url for each source that needs a scraper of its own."""
    own = sources.where("type = 'scrape'")
    return _inventory(own, jurisdiction=F.col("jurisdiction"), connector=F.lit("scrape"), code=F.col("code"), dataset=F.col("code"), resource_id=F.col("code"), format=F.lit("pdf"), portal=F.col("portal"), note=F.lit("needs a scraper"))


def unserved(codes: DataFrame, served: DataFrame) -> DataFrame:
    """(code): the different codes of which `served` has none; null codes are none."""
    return codes.where("code IS NOT NULL").select("code").distinct().join(served.select("code"), "code", "left_anti")


@dataclass
class Scraper:
    """A source of reports without a catalog: `enumerate_ids` names its reports, `pdf_url` gives the address of one."""

    code: str
    enumerate_ids: Callable[[], list[str]] | None = None
    pdf_url: Callable[[str], str] | None = None

    def ready(self) -> bool:
        return callable(self.enumerate_ids) and callable(self.pdf_url)


def pending_scrapers(sources: DataFrame, scrapers: list[Scraper]) -> DataFrame:
    """(code): scrape sources that no scraper serves which has both its functions."""
    ready = sources.sparkSession.createDataFrame([(s.code,) for s in scrapers if s.ready()], "code string")
    return unserved(sources.where("type = 'scrape'"), ready)


def scraped_reports(spark: SparkSession, scraper: Scraper) -> DataFrame:
    """(report_id, url) of all reports of a scraper; addresses are made on the executors. A scraper that isn't ready has none."""
    if not scraper.ready():
        return spark.createDataFrame([], "report_id string, url string")
    address = scraper.pdf_url

    @F.pandas_udf("string")
    def url(ids: pd.Series) -> pd.Series:
        return ids.map(address)

    return spark.createDataFrame([(str(i),) for i in scraper.enumerate_ids()], "report_id string").distinct().select("report_id", url("report_id").alias("url"))
