"""Every parser on answers of several pages, several entries each; entries that must not pass are among them."""

import json

import pytest
from pyspark.sql import functions as F

from loamline.operators.discovery import crawlable, quota_error
from loamline.operators.fetch import arbitrated, plain_text
from loamline.sources import payloads


def pages(spark, some, **columns):
    """Answers, page by page, dealt out so that their order hangs on the page alone."""
    names = ["page", "payload", *columns]
    rows = [(i, p if isinstance(p, str) else json.dumps(p), *columns.values()) for i, p in enumerate(some, 1)]
    return spark.createDataFrame(rows[::-1], "page int, " + ", ".join(f"{n} string" for n in names[1:])).repartition(3)


def shown(df):
    return [(r["id"], r["title"], r["url"], r["license"], r["topic"]) for r in df.orderBy("pos").collect()]


def research(*entries):
    return {"results": [{"mainTitle": t, "bestAccessRight": {"label": a}, "instances": [{"urls": u}]} for t, a, u in entries]}


def test_openaire(spark):
    good = "https://ec.europa.eu/research/participants/documents/downloadPublic?documentIds=1&amp;appId=P"
    got = shown(payloads.openaire(pages(spark, [research(("D1 Heat", "OPEN", ["https://x.org", good]), ("Closed", "RESTRICTED", [good])), research(("No file", "OPEN", ["https://x.org"]), ("D2 Walls", "OPEN", [good]))], topic="building_energy")))
    assert got == [("eud-d1-heat", "D1 Heat", good.replace("&amp;", "&"), "open", "building_energy"), ("eud-d2-walls", "D2 Walls", good.replace("&amp;", "&"), "open", "building_energy")]


def test_jrc(spark):
    handles = [f"https://publications.jrc.ec.europa.eu/repository/handle/JRC{i}" for i in range(3)]
    answers = pages(spark, [research(("Own", "OPEN", ["https://doi.org/1", handles[0]]), ("Journal", "OPEN", [handles[1]])), research(("Without a page", "OPEN", [handles[2]]))], topic="urban")
    html = '<meta name="citation_doi" content="{}"><a href="https://publications.jrc.ec.europa.eu/repository/bitstream/JRC0/report.pdf">'
    there = spark.createDataFrame([(handles[0], html.format("10.2760/123")), (handles[1], html.format("10.1016/x"))], "handle string, html string")
    assert shown(payloads.jrc(answers, there)) == [("jrc-own", "Own", "https://publications.jrc.ec.europa.eu/repository/bitstream/JRC0/report.pdf", "cc-by", "urban")]


def test_modelica(spark):
    item = lambda title, url, kind, *rights: {"title": [title], "link": [{"URL": url, "content-type": kind}], "license": [{"URL": r} for r in rights]}
    got = shown(payloads.modelica(pages(spark, [{"message": {"items": [item("Heat pump library", "http://www.ep.liu.se/a.pdf", "application/pdf", "https://creativecommons.org/licenses/by/4.0/"), item("No file", "https://x.org/a.html", "text/html")]}}, {"message": {"items": [item("An FMI tool", "https://x.org/B.PDF", "unspecified")]}}])))
    assert got == [("mod-heat-pump-library", "Heat pump library", "https://ep.liu.se/a.pdf", "cc-by", "building_energy"), ("mod-an-fmi-tool", "An FMI tool", "https://x.org/B.PDF", "open", "controls_bas")]


def test_books(spark):
    def book(handle, name, kind, *files):
        return {"handle": handle, "name": name, "metadata": [{"key": "dc.type", "value": kind}], "bitstreams": [{"name": n, "mimeType": m, "retrieveLink": u} for n, m, u in files]}

    pdf = ("x.PDF", "application/pdf", "/bitstreams/1/retrieve")
    got = shown(payloads.books(pages(spark, [[book("h1", "A book", "Book", ("x.txt", "text/plain", "/t"), pdf), book("h2", "A chapter", "chapter", pdf)], [book("h3", "No rights", "book", pdf), book("h4", "No file", "book"), book("h5", "Second", "Edited book", pdf)]], topic="architecture"), spark.createDataFrame([("h1", "cc-by"), ("h3", None), ("h4", "cc-by"), ("h5", "cc0")], "handle string, license string")))
    assert got == [("oer-a-book", "A book", "https://library.oapen.org/bitstreams/1/retrieve", "cc-by", "architecture"), ("oer-second", "Second", "https://library.oapen.org/bitstreams/1/retrieve", "cc0", "architecture")]


def test_purdue(spark):
    def record(title, *identifiers):
        return f"<record><header/><metadata><oai_dc:dc><dc:title>{title}</dc:title>" + "".join(f"<dc:identifier>{i}</dc:identifier>" for i in identifiers) + "</oai_dc:dc></metadata></record>"

    page = lambda *r: f"<OAI-PMH><ListRecords>{''.join(r)}</ListRecords></OAI-PMH>"
    pdf = "https://docs.lib.purdue.edu/cgi/viewcontent.cgi?article=1&amp;context=icec"
    got = shown(payloads.purdue(pages(spark, [page(record("Fault detection", "https://docs.lib.purdue.edu/icec/1", pdf), record("No file", "https://docs.lib.purdue.edu/icec/2")), page(record("Scroll compressors", pdf))], pub="icec")))
    assert [(i, t, topic) for i, t, _, _, topic in got] == [("pur-icec-fault-detection", "Fault detection", "commissioning_fdd"), ("pur-icec-scroll-compressors", "Scroll compressors", "equipment_systems")]
    assert {u for _, _, u, _, _ in got} == {pdf.replace("&amp;", "&")} and {x[3] for x in got} == {"open"}


def test_scielo(spark):
    def article(pid, titles, origin, pdfs=None, raw=None):
        return {"fulltexts": {"pdf": pdfs} if pdfs else {}, "article": {"v12": [{"_": t, "l": lang} for lang, t in titles], "v40": [{"_": origin}], "v702": [{"_": raw}] if raw else [], "v880": [{"_": pid}]}}

    some = [
        article("S1", [("en", "Concrete"), ("pt", "Concreto")], "pt", {"en": "http://www.scielo.br/pdf/a/en.pdf", "pt": "http://www.scielo.br/pdf/a/pt.pdf"}),
        article("S2", [("en", "Elsewhere")], "en", {"en": "http://other.org/x.pdf"}),
        article("S3", [("es", "Muros")], "es", None, "X:\\serial\\RIEM\\v1n2\\markup\\03.xml"),
        article("S4", [("en", "No path")], "en", None, "03.xml"),
    ]
    got = shown(payloads.scielo(pages(spark, some, topic="materials")))
    assert got == [("sci-s1", "Concreto", "https://www.scielo.br/pdf/a/pt.pdf", "cc-by", "materials"), ("sci-s3", "Muros", "https://www.scielo.br/pdf/riem/v1n2/03.pdf", "cc-by", "materials")]


def test_wiki(spark):
    page = lambda **links: {"query": {"pages": {"7": {"title": "Heat pump", "langlinks": [{"lang": k, "*": v} for k, v in links.items()]}}}}
    got = [(r["id"], r["title"], r["url"], r["source"], r["license"], r["format"]) for r in payloads.wiki(pages(spark, [page(de="Wärmepumpe", fr=""), page(es="Bomba de calor"), {"query": {"pages": {"-1": {"title": "x"}}}}], topic="equipment_systems")).orderBy("pos").collect()]
    assert got == [("wik-de-w-rmepumpe", "Wärmepumpe", "https://de.wikipedia.org/wiki/W%C3%A4rmepumpe", "wikipedia_de", "cc-by-sa", "html"), ("wik-es-bomba-de-calor", "Bomba de calor", "https://es.wikipedia.org/wiki/Bomba_de_calor", "wikipedia_es", "cc-by-sa", "html")]


def test_ademe(spark):
    page = lambda name, *files: "<div data-product=\"" + json.dumps({"name": name, "attachments": [{"mime": m, "id_attachment": i} for m, i in files]}).replace('"', "&quot;") + "\"></div>"
    got = shown(payloads.ademe(pages(spark, [page(" Isolation des murs ", ("image/png", "1"), ("application/PDF", "2")), page("No file", ("image/png", "3")), "<p>no product</p>", page("La ville", ("application/pdf", "4"))])))
    assert got == [("adm-isolation-des-murs", "Isolation des murs", "https://librairie.ademe.fr/index.php?controller=attachment&id_attachment=2", "open", "building_energy"), ("adm-la-ville", "La ville", "https://librairie.ademe.fr/index.php?controller=attachment&id_attachment=4", "open", "urban")]


def test_sdz(spark):
    block = lambda title, *links: f'<div class="searchresult big"><h3 class="searchresult__header"><a href="/x">{title}</a></h3>' + "".join(f'<a class="searchresult__publication-download-link" href="{u}">pdf</a>' for u in links) + "</div>"
    got = shown(payloads.sdz(pages(spark, ["<p>" + block("Sanierung &amp; <b>mehr</b>", "/a.pdf", "/b.pdf") + block("Ohne Datei"), block("Quartier", "https://other.at/c.pdf") + block("Holz", "d.pdf")], series="1")))
    assert got == [("sdz-sanierung-mehr", "Sanierung & mehr", "https://nachhaltigwirtschaften.at/a.pdf", "open", "building_energy"), ("sdz-quartier", "Quartier", "https://other.at/c.pdf", "open", "urban"), ("sdz-holz", "Holz", "https://nachhaltigwirtschaften.at/d.pdf", "open", "materials")]


def test_boverket(spark):
    rows = [("https://www.boverket.se/1", '<h1 class="x">Brand i <i>byggnader</i></h1><a href="/globalassets/a.pdf">'), ("https://www.boverket.se/2", "<h1>Utan fil</h1>"), ("https://www.boverket.se/3", '<h1>Energi</h1><a HREF="/globalassets/b.PDF">')]
    got = shown(payloads.boverket(spark.createDataFrame(rows, "url string, payload string")))
    assert got == [("bov-brand-i-byggnader", "Brand i byggnader", "https://www.boverket.se/globalassets/a.pdf", "open", "architecture"), ("bov-energi", "Energi", "https://www.boverket.se/globalassets/b.PDF", "open", "building_energy")]


def test_japan_reports(spark):
    url = "https://www.kenken.go.jp/japanese/contents/publications/report/{}/index.html"
    body = "<b>■建築研究報告</b><table><tr><td>\n「建物の耐震」\n</td></tr></table>"
    whole = body + '<a href="all.pdf">全文</a><a href="1.pdf">第1章</a>'
    parts = body.replace("耐震", "火災") + '<a href="ch1.pdf#page=1">第1章</a><a href="ch1.pdf#page=2">again</a><a href="agreement.pdf">x</a><a href="/abs/2.pdf"></a>'
    df = spark.createDataFrame([(url.format(1), whole, "建築研究報告", "jpn-bri-report", 1), (url.format(2), parts, "建築研究報告", "jpn-bri-report", 2)], "url string, payload string, banner string, prefix string, n int")
    got = shown(payloads.japan_report(df))
    assert got[0] == ("jpn-bri-report-1-all", "建築研究報告 No.1 — 建物の耐震", url.format(1).replace("index.html", "all.pdf"), "open", "structures_civil")
    assert got[1][:2] == ("jpn-bri-report-2-ch1", "建築研究報告 No.2 — 建物の火災｜第1章") and got[1][4] == "architecture" and len(got) == 3


def test_japan_years(spark):
    url = "https://www.nilim.go.jp/lab/bcg/siryou/{}report/index.htm"
    rows = [(url.format(2020), '<a href="ar2020hp001.pdf">木造の　材料</a><a href="ar2020hp001.pdf#page=3">again</a><a href="ar2020all.pdf">全ページ</a><a href="https://o.jp/x9.pdf"></a>', 2020), (url.format(2021), '<A HREF="AR2021-7.pdf">都市 <b>計画</b></A>', 2021)]
    got = shown(payloads.japan_year(spark.createDataFrame(rows, "url string, payload string, year int")))
    assert got == [
        ("jpn-nilim-2020-hp001", "国総研資料 2020 — 木造の 材料", url.format(2020).replace("index.htm", "ar2020hp001.pdf"), "open", "materials"),
        ("jpn-nilim-2020-x9", "NILIM annual research report 2020 item 002", "https://o.jp/x9.pdf", "open", "building_energy"),
        ("jpn-nilim-2021-7", "国総研資料 2021 — 都市 計画", url.format(2021).replace("index.htm", "AR2021-7.pdf"), "open", "urban"),
    ]


def test_crawl(spark):
    base = "https://docs.example.org"
    site = {
        f"{base}/guide/": '<a href="b.html#top">b</a> <a class="x" href="../guide/a.html">a</a> <a href="https://other.org/guide/z">z</a> <a href="/about">no</a>',
        f"{base}/guide/a.html": '<a href="sub/c">c</a><a href="file.pdf">f</a><a href="b.html">b</a>',
        f"{base}/guide/b.html": '<a href="?p=2">q</a><a href="//docs.example.org/guide/d">d</a><a href="missing.html">m</a>',
        f"{base}/guide/sub/c": '<a href="../../guide/./a.html">a</a>', f"{base}/guide/d": "", f"{base}/guide/b.html?p=2": "", f"{base}/about": "", f"{base}/guide/island": "",
    }
    fetched = spark.createDataFrame(list(site.items()), "url string, payload string").repartition(4)
    got = payloads.crawl(fetched, f"{base}/guide/#x", "ex", "controls_bas", prefix="/guide").orderBy("pos").collect()
    assert [r["url"].removeprefix(base) for r in got] == ["/guide/", "/guide/b.html", "/guide/a.html", "/guide/b.html?p=2", "/guide/d", "/guide/sub/c"]
    assert [(r["id"], r["title"]) for r in got[:3]] == [("crawl-ex-index", "ex docs: index"), ("crawl-ex-b-html", "ex docs: b.html"), ("crawl-ex-a-html", "ex docs: a.html")]
    assert {(r["source"], r["license"], r["topic"], r["format"]) for r in got} == {("ex", "open", "controls_bas", "html")}
    assert [r["url"].removeprefix(base) for r in payloads.crawl(fetched, f"{base}/guide/", "ex", "t", prefix="/guide", most=4).orderBy("pos").collect()] == ["/guide/", "/guide/b.html", "/guide/a.html", "/guide/b.html?p=2"]
    assert payloads.crawl(fetched, "https://nowhere.org/", "ex", "t").count() == 0


@pytest.mark.parametrize(("page", "href", "target"), [
    ("https://a.org/x/y.html", "z", "https://a.org/x/z"), ("https://a.org/x/y/", "../z", "https://a.org/x/z"), ("https://a.org", "z", "https://a.org/z"), ("https://a.org/x/y?q=1", "?p=2", "https://a.org/x/y?p=2"),
    ("https://a.org/x/", "//b.org/c", "https://b.org/c"), ("https://a.org/x/", "/c/d", "https://a.org/c/d"), ("https://a.org/x/", "mailto:a@b.org", "mailto:a@b.org"), ("https://a.org/a/b/c/d", "../../../../e", "https://a.org/e"), ("https://a.org/a/b/", "./c/../d", "https://a.org/a/b/d"), ("https://a.org/a/b", "", "https://a.org/a/b"),
])
def test_addresses(spark, page, href, target):
    df = spark.createDataFrame([(page, href)], "p string, h string")
    assert df.select(payloads.resolved(F.col("p"), F.col("h"))).first()[0] == target


def test_order_hangs_on_pages_not_on_partitions(spark):
    answers = pages(spark, [research((f"T{i}-{j}", "OPEN", ["https://ec.europa.eu/research/participants/documents/downloadPublic?x"]) ) for i in range(9) for j in (1,)], topic="urban")
    orders = [[r["title"] for r in payloads.openaire(answers.repartition(n)).orderBy("pos").collect()] for n in (1, 4, 7)]
    assert orders == [[f"T{i}-1" for i in range(9)]] * 3


def test_small_predicates(spark):
    df = spark.createDataFrame([(1,)], "n int")
    value = lambda c: df.select(c).first()[0]
    assert value(crawlable(F.lit("https://a.org/x/y"), F.lit("a.org"), F.lit("/x"))) and not value(crawlable(F.lit("https://a.org/x/y.PDF"), F.lit("a.org"), F.lit("")))
    assert value(quota_error(F.lit("Error: quota exceeded"))) in (True, False) and not value(quota_error(F.lit(None).cast("string")))
    assert value(plain_text(F.lit(b" a\xff\xc3\xa9 ").cast("binary"))) == "aé"
    long, glued = "some words of a text that has spaces " * 30, "wordsthatruntogether" * 40
    assert value(arbitrated(F.lit(glued), F.lit(long))) == long and value(arbitrated(F.lit(long), F.lit(glued))) == long and value(arbitrated(F.lit("short"), F.lit("other"))) == "short"
