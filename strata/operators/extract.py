"""Rule-based metadata of report texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.util import strip

#: The patterns that define each piece of metadata, with Unicode classes, and line ends at line feeds only.
NTS = r"(?U)\b(\d{2}[A-Z](?:\/\d{1,2})?(?:\s*[A-Za-z]?\d{0,2})?)\b"
COMPANY = r"(?Uidm)(?:COMPANY|CLIENT|PROPERTY\s+OF|SUBMITTED\s+BY|OWNER|OPERATOR)\s*[:;]?\s*(.+?)(?:\n|$)"
COMMODITIES = (
    r"(?Ui)\b(gold|silver|copper|zinc|lead|nickel|cobalt|lithium|uranium|molybdenum|tungsten|tin|iron|platinum|palladium"
    r"|rare\s*earth|diamond|graphite|phosphate|potash|salt|manganese|vanadium|chromium|antimony|bismuth)\b"
)
REPORT_TYPE = (
    r"(?Ui)\b(diamond\s*drill|drill\s*(hole|log|program|report|result)|geochemical|geochem|soil\s*geochem|lake\s*geochem"
    r"|geophysical|geophys|magnetometer|electromagnetic|EM|IP\s*survey|assay|assessment\s*work|progress\s*report"
    r"|compilation|data\s*compilation|preliminary\s*economic|PEA|feasibility|scoping)\b"
)
#: The word within a keyword that decides the type of a report, in the order in which they are tried.
TYPES = {
    "drill": "assessment_report_drill",
    "assay": "assessment_report_drill",
    "geochem": "assessment_report_geochem",
    "geophysical": "assessment_report_geophys",
    "magnetometer": "assessment_report_geophys",
    "electromagnetic": "assessment_report_geophys",
}
FIRST_PAGE = 3000


def nts_sheet(text: Column) -> Column:
    """The first map sheet of the text, '' if none."""
    return F.regexp_extract(text, NTS, 1)


def company(text: Column) -> Column:
    """What follows the first company keyword with 1 to 99 characters, without trailing dots; '' if none."""
    found = F.transform(F.regexp_extract_all(text, F.lit(COMPANY), F.lit(1)), lambda c: F.regexp_replace(strip(c), r"\.+\z", ""))
    return F.coalesce(F.get(F.filter(found, lambda c: (c != "") & (F.length(c) < 100)), F.lit(0)), F.lit(""))


def commodities(text: Column) -> Column:
    """The different commodities that the text names, in lower case and in order."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(COMMODITIES), F.lit(0)), lambda c: F.lower(c))))


def report_type(text: Column) -> Column:
    """The type that the first deciding keyword tells."""

    def decide(match: Column) -> Column:
        low, out = F.lower(match), F.lit(None).cast("string")
        for key, kind in reversed(TYPES.items()):
            out = F.when(low.contains(key), kind).otherwise(out)
        return out

    decided = F.filter(F.transform(F.regexp_extract_all(text, F.lit(REPORT_TYPE), F.lit(0)), decide), lambda t: t.isNotNull())
    return F.coalesce(F.get(decided, F.lit(0)), F.lit("assessment_report_general"))


def metadata(df: DataFrame, text: str) -> DataFrame:
    """Adds nts_sheet, company, commodities and report_type from the first 3000 characters; a null text has none of them."""
    page = F.left(F.coalesce(F.col(text), F.lit("")), F.lit(FIRST_PAGE))
    return df.withColumns({"nts_sheet": nts_sheet(page), "company": company(page), "commodities": commodities(page), "report_type": report_type(page)})
