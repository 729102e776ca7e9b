"""Connector queries over literal answers, each with the entries that must come out."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.sources import payloads

COLUMNS = ["id", "title", "url", "source", "license", "topic", "format"]

_OAI = (
    '<OAI-PMH><ListRecords><record><header status="deleted"/></record><record><header/><metadata><oai_dc:dc>'
    "<dc:title>Beton &amp; Holz</dc:title><dc:rights>https://creativecommons.org/licenses/by/4.0/</dc:rights>"
    "<dc:identifier>https://publikationen.bibliothek.kit.edu/1</dc:identifier><dc:identifier>https://publikationen.bibliothek.kit.edu/1/2</dc:identifier>"
    "</oai_dc:dc></metadata></record><record><header/><metadata><oai_dc:dc><dc:title>Closed</dc:title><dc:rights>all rights reserved</dc:rights>"
    "<dc:identifier>https://publikationen.bibliothek.kit.edu/3/4</dc:identifier></oai_dc:dc></metadata></record></ListRecords></OAI-PMH>"
)
#: name -> (parser, answer, further columns, expected entries)
CASES: dict[str, tuple[Callable[[DataFrame], DataFrame], object, dict[str, str], list[tuple[str, ...]]]] = {
    "oai_records": (payloads.kitopen, _OAI, {}, [("kit-beton-holz", "Beton & Holz", "https://publikationen.bibliothek.kit.edu/1/2", "kitopen", "cc-by", "materials", "pdf")]),
    "crossref_items": (
        payloads.nist,
        {"message": {"items": [{"title": ["Fire tests"], "resource": {"primary": {"URL": "https://nvlpubs.nist.gov/a.PDF"}}}, {"title": ["Other"], "resource": {"primary": {"URL": "https://other.org/a.pdf"}}}, {"title": [], "resource": None}]}},
        {"topic": "building_energy"},
        [("nst-fire-tests", "Fire tests", "https://nvlpubs.nist.gov/a.PDF", "nist_crossref", "public-domain", "building_energy", "pdf")],
    ),
    "patent_sitemap": (
        lambda df: payloads.patents(df, ["us", "cn"]),
        "<li>US10520091B2 - Concrete &amp;amp; masonry wall :\n<li>CN1A - A toy :\n<li>US1B - Tunnel junction diode :\n<li>CN2A - Heat pump :\n<li>EP3A - Heat pump :",
        {},
        [("pat-us10520091b2", "Concrete & masonry wall", "https://patents.google.com/patent/US10520091B2/en", "google_patents", "public-domain", "materials", "html"), ("pat-cn2a", "Heat pump", "https://patents.google.com/patent/CN2A/en", "google_patents", "open", "equipment_systems", "html")],
    ),
    "map_documents": (
        payloads.worldbank,
        {"documents": {"facets": {}, "D1": {"display_title": "Urban housing", "pdfurl": "http://w.org/1.pdf", "docty": "Report"}, "D2": {"display_title": "A plan", "pdfurl": "http://w.org/2.pdf", "docty": "Notice"}, "D3": {"display_title": "", "pdfurl": "http://w.org/3.pdf"}}},
        {},
        [("wbd-urban-housing", "Urban housing", "https://w.org/1.pdf", "worldbank_wds", "cc-by", "urban", "pdf")],
    ),
    "archive_items": (
        payloads.archive,
        {"response": {"docs": [{"identifier": "x1", "title": ["Concrete", "other"], "year": 1910}, {"identifier": "x2", "title": "Price list"}, {"identifier": "x3", "title": "Timber"}]}},
        {"topic": "materials"},
        [("arc-x1", "Concrete (1910)", "https://archive.org/download/x1/x1_djvu.txt", "internet_archive", "public-domain", "materials", "txt"), ("arc-x3", "Timber", "https://archive.org/download/x3/x3_djvu.txt", "internet_archive", "public-domain", "materials", "txt")],
    ),
    "open_records": (
        payloads.zenodo,
        {"hits": {"hits": [{"metadata": {"title": "A &amp; B", "access_right": "open", "license": {"id": "cc-by-4.0"}}, "files": [{"key": "x.PDF", "links": {"self": "https://z.org/x.pdf"}}]}, {"metadata": {"title": "C", "access_right": "open", "license": {"id": "cc-by-nc-4.0"}}, "files": [{"key": "x.pdf", "links": {"self": "u"}}]}, {"metadata": {"title": "D", "access_right": "closed", "license": {"id": "cc0-1.0"}}, "files": []}]}},
        {"topic": "urban"},
        [("zen-a-b", "A & B", "https://z.org/x.pdf", "zenodo", "cc-by", "urban", "pdf")],
    ),
    "works_locations": (
        payloads.openalex,
        {"results": [{"title": "Heat pumps", "best_oa_location": {"pdf_url": "https://x.com/a.pdf"}, "locations": [{"pdf_url": "https://arxiv.org/pdf/1", "license": "CC-BY"}]}, {"title": "None", "locations": []}]},
        {"topic": "urban"},
        [("ope-heat-pumps", "Heat pumps", "https://arxiv.org/pdf/1", "openalex", "cc-by", "urban", "pdf")],
    ),
    "report_links": (
        payloads.osti,
        [{"osti_id": "12", "title": " A report ", "links": [{"href": "x", "rel": "fulltext"}]}, {"osti_id": "13", "title": "B", "links": [{"href": "y"}]}, {"id": "14", "title": "C", "links": [{"href": "https://o/purl/14"}]}],
        {"topic": "urban"},
        [("ost-a-report", "A report", "https://www.osti.gov/servlets/purl/12", "osti", "public-domain", "urban", "pdf"), ("ost-c", "C", "https://www.osti.gov/servlets/purl/14", "osti", "public-domain", "urban", "pdf")],
    ),
    "atom_entries": (payloads.arxiv, "<entry><id>http://arxiv.org/abs/2101.1v2</id><title>Cool roofs</title></entry><entry><title>No id</title></entry>", {"topic": "urban"}, [("arx-cool-roofs", "Cool roofs", "https://arxiv.org/pdf/2101.1", "arxiv", "open", "urban", "pdf")]),
    "publication_attachments": (
        payloads.govuk,
        {"title": "Building regulations", "details": {"attachments": [{"title": "Part L", "url": "https://g.uk/l.pdf", "content_type": "application/pdf"}, {"title": "Data", "url": "https://g.uk/d.csv", "content_type": "text/csv"}, {"title": "building REGULATIONS", "url": "https://g.uk/b.pdf", "content_type": "application/pdf"}]}},
        {"topic": "standards_protocols"},
        [("guk-building-regulations-part-l", "Building regulations — Part L", "https://g.uk/l.pdf", "gov_uk", "open", "standards_protocols", "pdf"), ("guk-building-regulations", "Building regulations", "https://g.uk/b.pdf", "gov_uk", "open", "standards_protocols", "pdf")],
    ),
}


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    parse, answer, columns, _ = CASES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = answer if isinstance(answer, str) else json.dumps(answer)
        rows = spark.range(1).select(F.lit(text).alias("payload"), *[F.lit(v).alias(k) for k, v in columns.items()])
        return parse(rows).select(*COLUMNS)

    run.__name__ = name
    return run


def _expected(name: str) -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    rows = ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in CASES[name][3])
    return f"SELECT * FROM (VALUES {rows}) AS v({', '.join(COLUMNS)})"


QUERIES = {name: _query(name) for name in CASES}
SQL = {name: _expected(name) for name in CASES}
