import json

import pytest
from pyspark.sql import functions as F

from loamline.functions.text import blocklist_key
from loamline.operators import html
from loamline.operators.registry import FIELDS
from loamline.sources import files, paged, payloads


def one(spark, payload, **columns):
    names = ["payload", *columns]
    return spark.createDataFrame([(payload if isinstance(payload, str) else json.dumps(payload), *columns.values())], ", ".join(f"{n} string" for n in names))


def shown(df):
    return [(r["id"], r["title"], r["url"], r["license"], r["topic"]) for r in df.orderBy("pos").collect()]


def test_json_connectors(spark):
    works = {"results": [{"title": "Heat pumps", "best_oa_location": {"pdf_url": "https://x.com/a.pdf"}, "locations": [{"pdf_url": "https://arxiv.org/pdf/1", "license": "CC-BY"}]}, {"title": "None", "locations": []}]}
    assert shown(payloads.openalex(one(spark, works, topic="urban"))) == [("ope-heat-pumps", "Heat pumps", "https://arxiv.org/pdf/1", "cc-by", "urban")]
    reports = [{"osti_id": "12", "title": " A report ", "links": [{"href": "x", "rel": "fulltext"}]}, {"osti_id": "13", "title": "B", "links": [{"href": "y"}]}]
    assert shown(payloads.osti(one(spark, reports, topic="urban"))) == [("ost-a-report", "A report", "https://www.osti.gov/servlets/purl/12", "public-domain", "urban")]
    nist = {"message": {"items": [{"title": ["T"], "resource": {"primary": {"URL": "https://nvlpubs.nist.gov/x.PDF"}}}, {"title": ["U"], "resource": {"primary": {"URL": "https://other.org/x.pdf"}}}]}}
    assert [x[2] for x in shown(payloads.nist(one(spark, nist, topic="urban")))] == ["https://nvlpubs.nist.gov/x.PDF"]
    bank = {"total": 2, "documents": {"facets": {}, "D1": {"display_title": "Urban housing", "pdfurl": "http://w.org/1.pdf", "docty": "Report"}, "D2": {"display_title": "A notice", "pdfurl": "http://w.org/2.pdf", "docty": "Notice"}}}
    assert shown(payloads.worldbank(one(spark, bank))) == [("wbd-urban-housing", "Urban housing", "https://w.org/1.pdf", "cc-by", "urban")]
    record = {"hits": {"hits": [{"metadata": {"title": "A &amp; B", "access_right": "open", "license": {"id": "cc-by-4.0"}}, "files": [{"key": "x.PDF", "links": {"self": "https://z.org/x.pdf"}}]}, {"metadata": {"title": "C", "access_right": "open", "license": {"id": "cc-by-nc-4.0"}}, "files": [{"key": "x.pdf", "links": {"self": "u"}}]}]}}
    assert shown(payloads.zenodo(one(spark, record, topic="urban"))) == [("zen-a-b", "A & B", "https://z.org/x.pdf", "cc-by", "urban")]
    tree = {"tree": [{"path": p, "type": "blob"} for p in ("README.md", "docs/a.rst", "src/b.md", "tests/docs/c.md", "LICENSE.md", "lib/d.mo")]}
    asked = one(spark, tree, repo="o/n", branch="main", license="open", topic="urban").withColumns({"include": F.lit(None).cast("array<string>"), "code": F.array(F.lit("mo")), "cap": F.lit(None).cast("int")})
    assert sorted(x[0] for x in shown(payloads.github(asked))) == ["gh-n-docs-a", "gh-n-lib-d", "gh-n-readme"]


def test_archive_refuses_an_error_envelope(spark):
    good = {"response": {"docs": [{"identifier": "x1", "title": ["Concrete", "other"], "year": 1910}, {"identifier": "x2", "title": "Price list"}]}}
    assert [x[:2] for x in shown(payloads.archive(one(spark, good, topic="materials")))] == [("arc-x1", "Concrete (1910)")]
    with pytest.raises(Exception, match="no list of documents"):
        payloads.archive(one(spark, {"error": "down"}, topic="materials")).collect()


def test_xml_connectors(spark):
    page = """<OAI-PMH><ListRecords><record><header status="deleted"/></record><record><header/><metadata><oai_dc:dc><dc:title>Beton &amp; Holz</dc:title><dc:rights>https://creativecommons.org/licenses/by/4.0/</dc:rights><dc:identifier>https://publikationen.bibliothek.kit.edu/1</dc:identifier><dc:identifier>https://publikationen.bibliothek.kit.edu/1/2</dc:identifier></oai_dc:dc></metadata></record><resumptionToken>next</resumptionToken></ListRecords></OAI-PMH>"""
    assert shown(payloads.kitopen(one(spark, page))) == [("kit-beton-holz", "Beton & Holz", "https://publikationen.bibliothek.kit.edu/1/2", "cc-by", "materials")]
    assert one(spark, page).select(payloads.resumption_token(F.col("payload"))).first()[0] == "next"
    feed = "<feed><opensearch:totalResults>1</opensearch:totalResults><entry><article_title><ja>耐震</ja><en>Seismic</en></article_title><link href=\"https://j.org/article/a/1/_article/-char/ja\"/></entry></feed>"
    assert shown(payloads.jstage(one(spark, feed, series="kouzou", topic="structures_civil")))[0][1:3] == ("耐震 (Seismic)", "https://j.org/article/a/1/_pdf/-char/ja")
    with pytest.raises(Exception, match="past the end"):
        payloads.jstage(one(spark, "<feed><entry/></feed>", series="k", topic="t")).collect()
    atom = "<entry><id>http://arxiv.org/abs/2101.1v2</id><title>A\n title</title></entry>"
    assert shown(payloads.arxiv(one(spark, atom, topic="urban")))[0][2] == "https://arxiv.org/pdf/2101.1"


def test_html_connectors(spark):
    sitemap = "<li>US10520091B2 - Concrete &amp;amp; masonry wall :\n<li>CN1A - A toy :\n<li>US1B - Tunnel junction diode :"
    assert shown(payloads.patents(one(spark, sitemap), ["us", "cn"])) == [("pat-us10520091b2", "Concrete & masonry wall", "https://patents.google.com/patent/US10520091B2/en", "public-domain", "materials")]
    names = one(spark, "href='2026-W01-p2.html' href='2026-W01-p10.html' href='2026-W01-p2.html'").select(payloads.patent_subpages(F.col("payload"), "2026-W01")).first()[0]
    assert names == ["2026-W01-p2.html", "2026-W01-p10.html"]
    listing = '<h4>Control</h4><table><tr><td><a class="paper_title" href="p">One</a><a href="a.pdf">x</a></td></tr></table><h4>List of topics</h4><table><tr><td><a class="paper_title" href="q">Two</a></td></tr></table>'
    assert [x[1:] for x in shown(payloads.ibpsa(one(spark, listing)))] == [("One", "a.pdf", "open", "controls_bas")]
    report = "<title>Heat – Analysis - IEA</title>Licence: CC BY 4.0 https://iea.blob.core.windows.net/assets/a_Chinese.pdf https://iea.blob.core.windows.net/assets/a.pdf"
    assert shown(payloads.iea(one(spark, report, url="https://www.iea.org/reports/heating")))[0][1:3] == ("Heat", "https://iea.blob.core.windows.net/assets/a.pdf")


def test_page_text(spark):
    page = "<html><body><nav>menu</nav><article><h1>A <b>title</b></h1><script>x</script><p>one<br>two<p class='reference x'>gone</p>\n\n\n<footer>f</footer> three</article></body></html>"
    assert spark.createDataFrame([(page,), (None,)], "html string").transform(html.extracted).collect()[0]["text"].split("\n") == ["A", "title", "one", "two", "", "three"]
    assert html.text_of("") == ""


@pytest.mark.parametrize(("page", "text"), [
    ("<article>x <3 y</article>", "x <3 y"),
    ("<article><p>1 < 2 &lt; 3</p><p>c</p></article>", "1 < 2 < 3\nc"),
    ("<article>a<!-- x -->b</x>c<?y?>d<!z>e</article>", "a\nb\nc\nd\ne"),
    ("x <", "x <"),
    ("<body><noscript><main>no</main></noscript><article>yes</article></body>", "yes"),
])
def test_page_text_nodes(page, text):
    assert html.text_of(page) == text


def test_page_entities():
    # every entity counts, with its semicolon or cut off before it; the SQL of html_extract knows three
    assert html.text_of("<article>a = &quot;b&quot; &#39;c&#39; &amp;lt; and&amp</article>") == "a = \"b\" 'c' &lt; and&"


def test_files(spark, tmp_path):
    (tmp_path / "reg").mkdir()
    (tmp_path / "reg" / "books.yaml").write_text("sources:\n- id: oer-1\n  title: B\n")
    (tmp_path / "reg" / "curated.yaml").write_text("sources:\n- id: a\n  title: T\n  url: https://a.org\n- id: b\n")
    entries = files.read_registry(spark, str(tmp_path / "reg"))
    assert [(r["id"], r["shard"], r["pos"]) for r in entries.orderBy("pos").collect()] == [("a", "curated", 1), ("b", "curated", 2), ("oer-1", "books", 3)]
    assert files.entry_yaml(entries.select(*FIELDS).where("id = 'a'")).first()["yaml"] == "  - id: a\n    title: T\n    url: https://a.org\n"
    block = str(tmp_path / "block")
    urls = spark.createDataFrame([("https://b.org/",), (" https://a.org// ",), ("https://b.org",)], "url string")
    assert files.append_blocklist(spark, block, urls) == 2 and files.append_blocklist(spark, block, urls) == 0
    assert sorted(r[0] for r in files.read_blocklist(spark, block).collect()) == ["https://a.org", "https://b.org"]
    rows = spark.createDataFrame([("oer-1", "t", "ok"), ("hand", "u", "ok")], "id string, topic string, status string")
    files.write_manifest(rows, str(tmp_path / "man"))
    assert files.changed_shards(rows, rows.where("id = 'hand'")).collect()[0]["change"] == "gone"
    files.run_event(spark, str(tmp_path / "ledger"), "r1", "started", step="x")
    assert spark.read.json(str(tmp_path / "ledger")).first()["event"] == "started"
    assert files.folder_usage(spark, str(tmp_path / "reg")).first()["files"] == 2
    assert len(files.signature(spark, str(tmp_path / "reg"))) == 64
    assert spark.range(1).select(blocklist_key(F.lit(None).cast("string"))).first()[0] == ""


def test_paged_source(spark, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    for n in (1, 2):
        (tmp_path / f"page-{n}.json").write_text(json.dumps({"n": n}))
    read = lambda: spark.read.format("paged_answers").option("path", str(tmp_path))
    assert sorted(r["page"] for r in read().load().collect()) == [1, 2]
    assert [r["page"] for r in read().option("start", "2").load().collect()] == [2]
    (tmp_path / "page-3.json").write_text(" ")
    with pytest.raises(Exception, match="empty answer"):
        read().load().collect()
