"""Connectors' answers as candidate registry entries: one parser for each kind of payload.

Every parser takes a frame with payload (one answer a row) and what else it names, and returns
id, title, url, source, license, topic, format and pos (order within all answers). Rows of other
formats, without title or address, or without rights to pass on are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import host, native_id, page_url, slug, strip
from loamline.operators.discovery import (
    composed_title,
    downloadable,
    junk_document,
    crawlable,
    license_of_id,
    license_of_rights,
    permissive_or_open,
    shaped,
    title_relevant,
    topic,
    trade_catalog,
    unescaped,
    wanted_path,
    PURDUE_SERIES,
)


def _place(answers: DataFrame) -> Column:
    """Where an answer stands among all: by its page, if it has that column, and then by its content.

    It says the same however the answers are partitioned, and when a task is run again.
    """
    page = F.col("page").cast("long") if "page" in answers.columns else F.lit(0).cast("long")
    return F.format_string("%015d-%s", F.coalesce(page, F.lit(0).cast("long")), F.substring(F.md5(F.coalesce("payload", F.lit("")).cast("binary")), 1, 12))


def _items(answers: DataFrame, items: Column, *keep: str) -> DataFrame:
    """One row an item, in order: pos, x and the kept columns."""
    rows = answers.select(*keep, _place(answers).alias("_answer"), items.alias("_items"))
    rows = rows.select(*keep, "_answer", F.posexplode("_items").alias("_at", "x"))
    return rows.select(*keep, F.format_string("%s-%09d", "_answer", "_at").alias("pos"), "x")


def _json(schema: str) -> Column:
    return F.from_json("payload", schema)


def _first(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(items, test), 0)


# --- JSON ----------------------------------------------------------------------------------------


def openalex(answers: DataFrame) -> DataFrame:
    """answers: payload, topic."""
    place = "struct<pdf_url:string,license:string>"
    schema = f"struct<results:array<struct<title:string,display_name:string,best_oa_location:{place},locations:array<{place}>>>>"
    rows = _items(answers, _json(schema)["results"], "topic")
    places = F.concat(F.array("x.best_oa_location"), F.coalesce("x.locations", F.expr(f"cast(array() as array<{place}>)")))
    rows = rows.withColumn("pick", _first(places, lambda p: p["pdf_url"].isNotNull() & downloadable(p["pdf_url"]))).where("pick is not null")
    rows = rows.select("topic", "pos", F.coalesce("x.title", "x.display_name").alias("title"), F.col("pick.pdf_url").alias("url"), permissive_or_open(F.col("pick.license")).alias("license"))
    return shaped(rows, "ope-", "openalex", 46)


def osti(answers: DataFrame) -> DataFrame:
    """answers: payload, topic."""
    rows = _items(answers, _json("array<struct<osti_id:string,id:string,title:string,links:array<struct<href:string,rel:string>>>>"), "topic")
    linked = F.exists(F.coalesce("x.links", F.expr("cast(array() as array<struct<href:string,rel:string>>)")), lambda k: F.coalesce(k["href"], F.lit("")).contains("purl") | (F.coalesce(k["rel"], F.lit("")) == "fulltext"))
    ident = F.coalesce("x.osti_id", "x.id")
    rows = rows.where(linked & ident.isNotNull()).select("topic", "pos", F.col("x.title").alias("title"), F.concat(F.lit("https://www.osti.gov/servlets/purl/"), ident).alias("url"), F.lit("public-domain").alias("license"))
    return shaped(rows, "ost-", "osti", 46)


_OPENAIRE = "struct<results:array<struct<mainTitle:string,bestAccessRight:struct<label:string>,instances:array<struct<urls:array<string>>>>>>"


def openaire(answers: DataFrame, fragment: str = "ec.europa.eu/research/participants/documents/downloadPublic") -> DataFrame:
    """answers: payload, topic. Open records with an address that holds the fragment."""
    rows = _items(answers, _json(_OPENAIRE)["results"], "topic").where("x.bestAccessRight.label = 'OPEN'")
    rows = rows.select("topic", "pos", F.col("x.mainTitle").alias("title"), unescaped(_first(F.flatten(F.transform("x.instances", lambda i: i["urls"])), lambda u: u.contains(fragment))).alias("url"), F.lit("open").alias("license"))
    return shaped(rows, "eud-", "openaire_deliverable", 46)


def jrc(answers: DataFrame, pages: DataFrame, handle_host: str = "publications.jrc.ec.europa.eu") -> DataFrame:
    """answers: payload, topic. pages: handle, html of each handle's page."""
    rows = _items(answers, _json(_OPENAIRE)["results"], "topic")
    handle = _first(F.flatten(F.transform("x.instances", lambda i: i["urls"])), lambda u: u.contains(handle_host) & u.contains("/handle/"))
    rows = rows.select("topic", "pos", F.col("x.mainTitle").alias("title"), handle.alias("handle")).join(pages, "handle")
    # DOI beginnings of reports that the Commission itself publishes.
    own = ["10.2760/", "10.2788/", "10.2790/", "10.2789/", "10.2905/"]
    dois = F.regexp_extract_all("html", F.lit(r'<meta[^>]+name="citation_doi"[^>]+content="([^"]+)"'), F.lit(1))
    begins = F.exists(dois, lambda d: F.exists(F.array(*[F.lit(p) for p in own]), lambda p: d.startswith(p)))
    stream = F.regexp_extract("html", r'(?i)href="(https?://publications\.jrc\.ec\.europa\.eu/repository/bitstream/[^"]+\.pdf)"', 1)
    return shaped(rows.where(begins).select("topic", "pos", "title", stream.alias("url"), F.lit("cc-by").alias("license")), "jrc-", "jrc", 46)


_CROSSREF = "struct<message:struct<items:array<struct<title:array<string>,resource:struct<primary:struct<URL:string>>,link:array<struct<URL:string,`content-type`:string>>,license:array<struct<URL:string>>>>>>"


def nist(answers: DataFrame) -> DataFrame:
    """answers: payload, topic."""
    rows = _items(answers, _json(_CROSSREF)["message"]["items"], "topic")
    rows = rows.select("topic", "pos", strip(F.get("x.title", F.lit(0))).alias("title"), F.col("x.resource.primary.URL").alias("url"), F.lit("public-domain").alias("license"))
    return shaped(rows.where(F.lower("url").contains("nvlpubs.nist.gov") & F.lower("url").endswith(".pdf")), "nst-", "nist_crossref", 52)


def modelica(answers: DataFrame) -> DataFrame:
    """answers: payload."""
    rows = _items(answers, _json(_CROSSREF)["message"]["items"])
    link = _first(F.transform("x.link", lambda k: F.struct(strip(F.coalesce(k["URL"], F.lit(""))).alias("u"), k["content-type"].alias("t"))), lambda k: (k["t"] == "application/pdf") | F.lower(k["u"]).endswith(".pdf"))["u"]
    link = F.replace(F.replace(link, F.lit("http://"), F.lit("https://")), F.lit("://www.ep.liu.se/"), F.lit("://ep.liu.se/"))
    free = F.exists(F.coalesce("x.license", F.expr("cast(array() as array<struct<URL:string>>)")), lambda k: F.coalesce(k["URL"], F.lit("")).contains("creativecommons.org/licenses/by/"))
    rows = rows.select("pos", F.get("x.title", F.lit(0)).alias("title"), link.alias("url"), F.when(free, "cc-by").otherwise("open").alias("license"))
    return shaped(rows.withColumn("topic", topic("modelica", F.col("title"))), "mod-", "modelica_conf", 52)


def books(answers: DataFrame, rights: DataFrame) -> DataFrame:
    """answers: payload, topic. rights: handle, license (null: may not be passed on)."""
    schema = "array<struct<handle:string,name:string,metadata:array<struct<key:string,value:string>>,bitstreams:array<struct<name:string,mimeType:string,retrieveLink:string>>>>"
    rows = _items(answers, _json(schema), "topic")
    kind = F.lower(F.array_join(F.transform(F.filter("x.metadata", lambda m: m["key"] == "dc.type"), lambda m: m["value"]), " "))
    pdf = _first(F.col("x.bitstreams"), lambda b: (b["mimeType"] == "application/pdf") & F.lower(b["name"]).endswith(".pdf") & (F.coalesce(b["retrieveLink"], F.lit("")) != ""))
    rows = rows.where(kind.contains("book")).select("topic", "pos", F.col("x.name").alias("title"), F.col("x.handle").alias("handle"), F.concat(F.lit("https://library.oapen.org"), pdf["retrieveLink"]).alias("url"))
    return shaped(rows.join(rights.where("license is not null"), "handle"), "oer-", "oapen", 52)


def archive(answers: DataFrame) -> DataFrame:
    """answers: payload, topic. An answer that is no list of documents is an error."""
    one_or_more = "struct<response:struct<docs:array<struct<identifier:string,title:string,year:string>>>>"
    docs = _json(one_or_more)["response"]["docs"]
    items = F.when(docs.isNull(), F.raise_error(F.concat(F.lit("no list of documents: "), F.substring("payload", 1, 80)))).otherwise(docs)
    rows = _items(answers, items, "topic")
    single = lambda c: F.when(c.startswith("["), F.get(F.from_json(c, "array<string>"), 0)).otherwise(c)
    rows = rows.select("topic", "pos", F.col("x.identifier").alias("ident"), strip(F.coalesce(single(F.col("x.title")), F.lit(""))).alias("title"), single(F.col("x.year")).alias("year"))
    rows = rows.where((F.coalesce("ident", F.lit("")) != "") & ~trade_catalog(F.col("title")))
    title = F.when(F.coalesce("year", F.lit("")) != "", F.concat(F.substring("title", 1, 130), F.lit(" ("), "year", F.lit(")"))).otherwise(F.col("title"))
    rows = rows.where("title <> ''").select("topic", "pos", "ident", title.alias("title"), F.concat(F.lit("https://archive.org/download/"), "ident", F.lit("/"), "ident", F.lit("_djvu.txt")).alias("url"), F.lit("public-domain").alias("license"))
    return shaped(rows, "arc-", "internet_archive", 52, "txt", id_text=F.col("ident"))


def zenodo(answers: DataFrame) -> DataFrame:
    """answers: payload, topic."""
    schema = "struct<hits:struct<hits:array<struct<metadata:struct<title:string,access_right:string,license:struct<id:string>>,files:array<struct<key:string,links:struct<self:string>>>>>>>"
    rows = _items(answers, _json(schema)["hits"]["hits"], "topic").where("x.metadata.access_right = 'open'")
    pdf = _first(F.col("x.files"), lambda f: F.lower(f["key"]).endswith(".pdf"))
    rows = rows.select("topic", "pos", unescaped(strip(F.col("x.metadata.title"))).alias("title"), strip(pdf["links"]["self"]).alias("url"), license_of_id(F.col("x.metadata.license.id")).alias("license"))
    return shaped(rows, "zen-", "zenodo", 52)


def worldbank(answers: DataFrame) -> DataFrame:
    """answers: payload. Documents are a map; its entry facets is no document."""
    schema = "struct<documents:map<string,struct<display_title:string,pdfurl:string,docty:string>>>"
    entries = F.array_sort(F.filter(F.map_entries(_json(schema)["documents"]), lambda e: (e["key"] != "facets") & e["value"].isNotNull()))
    rows = _items(answers, F.transform(entries, lambda e: e["value"]))
    rows = rows.select("pos", strip(F.col("x.display_title")).alias("title"), F.regexp_replace(strip(F.col("x.pdfurl")), r"\Ahttp://", "https://").alias("url"), strip(F.coalesce("x.docty", F.lit(""))).alias("kind"), F.lit("cc-by").alias("license"))
    rows = rows.where(~junk_document(F.col("kind"), F.col("title")))
    return shaped(rows.withColumn("topic", topic("worldbank", F.col("title"))), "wbd-", "worldbank_wds", 52)


def govuk(answers: DataFrame) -> DataFrame:
    """answers: payload of a publication's page, topic."""
    schema = "struct<title:string,details:struct<attachments:array<struct<title:string,url:string,content_type:string>>>>"
    page = answers.withColumn("page", strip(F.coalesce(_json(schema)["title"], F.lit(""))))
    rows = _items(page, _json(schema)["details"]["attachments"], "topic", "page").where("x.content_type = 'application/pdf'")
    rows = rows.select("topic", "pos", composed_title(F.col("page"), strip(F.coalesce("x.title", F.lit("")))).alias("title"), F.col("x.url").alias("url"), F.lit("open").alias("license"))
    return shaped(rows.where(title_relevant(F.col("title"))), "guk-", "gov_uk", 46, title_size=180)


def scielo(answers: DataFrame, hosts: list[str] | None = None) -> DataFrame:
    """answers: payload of an article record, topic."""
    hosts = hosts or ["www.scielo.br"]
    said = "array<struct<_:string,l:string>>"
    schema = f"struct<fulltexts:struct<pdf:map<string,string>>,article:struct<v12:{said},v40:{said},v702:{said},v880:{said}>>"
    rows = answers.select("topic", _place(answers).alias("n"), _json(schema).alias("x"))
    origin = F.get("x.article.v40", F.lit(0))["_"]
    titles = F.filter("x.article.v12", lambda t: F.coalesce(t["_"], F.lit("")) != "")
    by = lambda language: F.get(F.filter(titles, lambda t: t["l"] == language), 0)["_"]
    title = F.coalesce(by(origin), by(F.lit("en")), F.get(titles, 0)["_"])
    pdfs = F.col("x.fulltexts.pdf")
    stated = F.coalesce(*[F.element_at(pdfs, c) for c in (F.coalesce(origin, F.lit("?")), F.lit("en"), F.lit("pt"), F.lit("es"))], F.get(F.map_values(pdfs), 0))
    raw = F.replace(F.coalesce(F.get("x.article.v702", F.lit(0))["_"], F.lit("")), F.lit("\\"), F.lit("/"))
    tail = F.regexp_extract(raw, r"(?i)/serial/(.+)\z", 1)
    path = F.regexp_replace(F.regexp_replace(F.when(tail != "", tail).otherwise(raw), "(?i)/markup/", "/"), r"\.[A-Za-z0-9]+\z", ".pdf")
    path = F.ltrim(path, F.lit("/"))
    good = path.endswith(".pdf") & (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= 2)
    derived = F.when(good, F.concat(F.lit(f"https://{hosts[0]}/pdf/"), F.lower(F.regexp_extract(path, r"\A([^/]*)", 1)), F.regexp_extract(path, r"\A[^/]*(/.*)", 1)))
    url = F.when(F.size(pdfs) > 0, F.replace(stated, F.lit("http://"), F.lit("https://"))).otherwise(derived)
    rows = rows.select("topic", F.col("n").alias("pos"), title.alias("title"), url.alias("url"), F.lit("cc-by").alias("license"), F.get("x.article.v880", F.lit(0))["_"].alias("pid"))
    rows = rows.where(host(F.col("url")).isin(hosts))
    return shaped(rows, "sci-", "scielo", 52, id_text=F.coalesce("pid", "title"))


def github(answers: DataFrame, most: int = 100) -> DataFrame:
    """answers: payload (a tree), repo, branch, license, topic, include, code, cap (null: most)."""
    rows = _items(answers, _json("struct<tree:array<struct<path:string,type:string>>>")["tree"], "repo", "branch", "license", "topic", "include", "code", "cap")
    rows = rows.where("x.type = 'blob'").withColumn("path", F.col("x.path")).where(wanted_path(F.col("path"), F.col("include"), F.col("code")))
    from pyspark.sql import Window

    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("repo").orderBy("path"))).where(F.col("n") <= F.coalesce("cap", F.lit(most)))
    name = F.element_at(F.split("repo", "/"), -1)
    stem = F.regexp_replace("path", r"\.[^.]*\z", "")
    ident = F.substring(F.concat(F.lit("gh-"), slug(name), F.lit("-"), slug(stem)), 1, 63)
    fmt = F.when(F.lower("path").endswith(".rst"), "rst").when(F.lower("path").endswith(".md"), "md").otherwise("txt")
    url = F.concat(F.lit("https://raw.githubusercontent.com/"), "repo", F.lit("/"), "branch", F.lit("/"), "path")
    return rows.select(ident.alias("id"), F.substring(F.concat(name, F.lit(": "), "path"), 1, 150).alias("title"), url.alias("url"), F.concat(F.lit("gh_"), slug(name)).alias("source"), "license", "topic", fmt.alias("format"), "pos")


def wiki(answers: DataFrame) -> DataFrame:
    """answers: payload (pages with links to other languages), topic of the answer's seed."""
    schema = "struct<query:struct<pages:map<string,struct<title:string,langlinks:array<struct<lang:string,`*`:string>>>>>>"
    pages = F.transform(F.array_sort(F.map_entries(_json(schema)["query"]["pages"])), lambda e: e["value"])
    rows = _items(answers, pages, "topic")
    rows = rows.select("topic", "pos", F.posexplode("x.langlinks").alias("n", "link")).select("topic", F.format_string("%s-%06d", "pos", "n").alias("pos"), F.col("link.lang").alias("lang"), F.col("link.`*`").alias("title"))
    rows = rows.where("coalesce(title, '') <> ''")
    url = F.concat(F.lit("https://"), "lang", F.lit(".wikipedia.org/wiki/"), page_url("", F.col("title")))
    return rows.select(F.concat(F.lit("wik-"), "lang", F.lit("-"), native_id(F.col("title"))).alias("id"), F.substring("title", 1, 150).alias("title"), url.alias("url"), F.concat(F.lit("wikipedia_"), "lang").alias("source"), F.lit("cc-by-sa").alias("license"), "topic", F.lit("html").alias("format"), "pos")


def ademe(answers: DataFrame, base: str = "https://librairie.ademe.fr") -> DataFrame:
    """answers: payload (a product's page, with its data as JSON in an attribute)."""
    data = unescaped(F.regexp_extract("payload", r'data-product="([^"]*)"', 1))
    schema = "struct<name:string,attachments:array<struct<mime:string,id_attachment:string>>>"
    rows = answers.select(_place(answers).alias("pos"), F.from_json(data, schema).alias("x"))
    pdf = _first(F.col("x.attachments"), lambda a: F.lower(F.coalesce(a["mime"], F.lit(""))) == "application/pdf")
    rows = rows.select("pos", strip(F.col("x.name")).alias("title"), F.concat(F.lit(f"{base}/index.php?controller=attachment&id_attachment="), pdf["id_attachment"]).alias("url"), F.lit("open").alias("license"))
    return shaped(rows.withColumn("topic", topic("ademe", F.col("title"))), "adm-", "ademe", 52)


# --- XML -----------------------------------------------------------------------------------------


def _records(xml: Column, tag: str) -> Column:
    """The elements of a tag, with any prefix, as strings."""
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?{tag}[\s>].*?</(?:\w+:)?{tag}>"), F.lit(0))


def _texts(xml: Column, tag: str) -> Column:
    found = F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?{tag}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{tag}>"), F.lit(1))
    return F.transform(found, lambda t: strip(unescaped(t)))


def _oai(answers: DataFrame, *keep: str) -> DataFrame:
    """Live records of a harvest's pages; a page that says error is an error."""
    error = F.regexp_extract("payload", r"<(?:\w+:)?error\s[^>]*code=\"([^\"]*)\"", 1)
    items = F.when(error != "", F.raise_error(F.concat(F.lit("harvest error "), error))).otherwise(_records(F.col("payload"), "record"))
    rows = _items(answers, items, *keep).where(~F.col("x").rlike(r"<(?:\w+:)?header\s[^>]*status=\"deleted\""))
    return rows.select(*keep, "pos", F.get(_texts(F.col("x"), "title"), 0).alias("title"), _texts(F.col("x"), "rights").alias("rights"), _texts(F.col("x"), "identifier").alias("identifiers"))


def resumption_token(payload: Column) -> Column:
    """What a harvest's next request must carry; empty at the end."""
    return F.coalesce(F.get(_texts(payload, "resumptionToken"), 0), F.lit(""))


def kitopen(answers: DataFrame, site: str = "publikationen.bibliothek.kit.edu") -> DataFrame:
    """answers: payload (a harvest's page)."""
    rows = _oai(answers)
    deep = lambda u: F.size(F.filter(F.split(F.regexp_extract(u, r"\A[^:]+://[^/?#]*([^?#]*)", 1), "/"), lambda p: p != "")) >= 2
    url = _first(F.col("identifiers"), lambda u: (host(u) == site) & deep(u))
    rows = rows.select("pos", "title", url.alias("url"), license_of_rights(F.col("rights")).alias("license"))
    return shaped(rows.withColumn("topic", topic("kitopen", F.col("title"))), "kit-", "kitopen", 52)


def purdue(answers: DataFrame) -> DataFrame:
    """answers: payload (a harvest's page), pub (the series)."""
    rows = _oai(answers, "pub")
    url = _first(F.col("identifiers"), lambda u: u.rlike(r"\Ahttps?://docs\.lib\.purdue\.edu/cgi/viewcontent\.cgi"))
    series = F.element_at(F.create_map(*[F.lit(x) for kv in PURDUE_SERIES.items() for x in kv]), F.col("pub"))
    rows = rows.select("pub", "pos", "title", url.alias("url"), F.lit("open").alias("license"), F.coalesce(topic("purdue", F.col("title")), series).alias("topic"))
    return shaped(rows, "pur-", "purdue_herrick", 52, id_text=F.concat("pub", F.lit("-"), F.substring(slug(F.col("title")), 1, 46)))


def jstage(answers: DataFrame) -> DataFrame:
    """answers: payload (a feed's page), series, topic. A page without a total is past the end: an error."""
    total = F.regexp_extract("payload", r"<(?:\w+:)?totalResults>\s*(\d+)\s*<", 1)
    items = F.when(total == "", F.raise_error(F.lit("past the end of the results"))).otherwise(_records(F.col("payload"), "entry"))
    rows = _items(answers, items, "series", "topic")
    names = F.get(_records(F.col("x"), "article_title"), 0)
    ja, en = (F.coalesce(F.regexp_extract(F.coalesce(names, F.lit("")), rf"(?s)<(?:\w+:)?{c}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:\w+:)?{c}>", 1), F.lit("")) for c in ("ja", "en"))
    title = F.when((ja != "") & (en != ""), F.concat(strip(ja), F.lit(" ("), F.substring(strip(en), 1, 70), F.lit(")"))).otherwise(strip(F.when(ja != "", ja).otherwise(en)))
    link = F.regexp_extract("x", r'<(?:\w+:)?link\s[^>]*href="([^"]*)"', 1)
    pdf = F.regexp_replace(link, r"/_article\b", "/_pdf")
    pdf = F.when(pdf.contains("/_pdf"), pdf).otherwise(F.concat(F.rtrim(link, F.lit("/")), F.lit("/_pdf")))
    article = F.regexp_extract(link, r"/([^/]+)/_article", 1)
    rows = rows.where(link.contains("/article/")).select("pos", "topic", title.alias("title"), pdf.alias("url"), F.lit("open").alias("license"), F.concat("series", F.lit("-"), article).alias("key"))
    return shaped(rows, "jst-", "jstage_aij", 52, id_text=F.col("key"))


def arxiv(answers: DataFrame) -> DataFrame:
    """answers: payload (an Atom feed), topic."""
    rows = _items(answers, F.regexp_extract_all("payload", F.lit("(?s)<entry>(.*?)</entry>"), F.lit(1)), "topic")
    ident = F.regexp_replace(strip(F.regexp_extract("x", r"<id>https?://arxiv\.org/abs/([^<]+)</id>", 1)), r"v\d+\z", "")
    rows = rows.select("topic", "pos", strip(F.regexp_extract("x", "(?s)<title>(.*?)</title>", 1)).alias("title"), ident.alias("ident"), F.lit("open").alias("license"))
    return shaped(rows.where("ident <> ''").withColumn("url", F.concat(F.lit("https://arxiv.org/pdf/"), "ident")), "arx-", "arxiv", 46)


# --- HTML ----------------------------------------------------------------------------------------


def patents(answers: DataFrame, countries: list[str]) -> DataFrame:
    """answers: payload (a page of a patent sitemap). Titles without a topic are dropped."""
    rows = _items(answers, F.split("payload", "\r\n|[\n\r]", -1))
    shape = rf"<li>((?:{'|'.join(c.strip().upper() for c in countries)})[0-9A-Z]+) - (.*) :\s*\z"
    number = F.regexp_extract("x", shape, 1)
    rows = rows.select("pos", number.alias("number"), strip(unescaped(unescaped(F.regexp_extract("x", shape, 2)))).alias("title")).where("number <> ''")
    from loamline.operators.quality import off_domain_title

    rows = rows.where(~off_domain_title(F.col("title"))).withColumn("topic", topic("patents", F.col("title"))).where("topic is not null")
    url = F.concat(F.lit("https://patents.google.com/patent/"), "number", F.lit("/en"))
    free = F.when(F.col("number").startswith("US"), "public-domain").otherwise("open")
    return rows.select(F.concat(F.lit("pat-"), F.lower("number")).alias("id"), F.substring("title", 1, 150).alias("title"), url.alias("url"), F.lit("google_patents").alias("source"), free.alias("license"), "topic", F.lit("html").alias("format"), "pos")


def patent_subpages(page: Column, bucket: str) -> Column:
    """Names of a bucket's further pages, in order of their numbers."""
    numbers = F.regexp_extract_all(page, F.lit(rf"href='\Q{bucket}\E-p(\d+)\.html'"), F.lit(1))
    return F.transform(F.array_sort(F.array_distinct(F.transform(numbers, lambda n: n.cast("int")))), lambda n: F.concat(F.lit(f"{bucket}-p"), n.cast("string"), F.lit(".html")))


def sdz(answers: DataFrame, base: str = "https://nachhaltigwirtschaften.at") -> DataFrame:
    """answers: payload (a listing), series."""
    blocks = F.slice(F.split("payload", r'<div[^>]*class="[^"]*\bsearchresult\b[^"]*"'), 2, 100_000)
    rows = _items(answers, blocks, "series")
    title = F.regexp_replace(F.regexp_extract("x", r'(?s)class="searchresult__header"[^>]*>.*?<a[^>]*>(.*?)</a>', 1), "<[^>]+>", "")
    link = F.regexp_extract("x", r'(?is)<a(?=[^>]*class="[^"]*searchresult__publication-download-link)[^>]*href="([^"]+\.pdf)"', 1)
    url = F.when(link.rlike("^https?://"), link).when(link != "", F.concat(F.lit(base), F.when(~link.startswith("/"), "/").otherwise(""), link))
    rows = rows.select("series", "pos", strip(unescaped(title)).alias("title"), url.alias("url"), F.lit("open").alias("license"))
    return shaped(rows.withColumn("topic", topic("sdz", F.col("title"))), "sdz-", "sdz_at", 52)


def ibpsa(answers: DataFrame) -> DataFrame:
    """answers: payload (a conference's listing). A heading gives its topic to the tables after it."""
    from pyspark.sql import Window

    parts = F.regexp_extract_all("payload", F.lit(r"(?s)<h4[^>]*>.*?</h4>|<tr[^>]*>.*?</tr>"), F.lit(0))
    rows = answers.select(_place(answers).alias("answer"), parts.alias("parts")).select("answer", F.posexplode("parts").alias("n", "x"))
    heading = strip(F.regexp_replace("x", "<[^>]+>", ""))
    said = F.when(F.col("x").startswith("<h4") & (heading != "") & (F.lower(heading) != "list of topics"), heading)
    carried = F.last(said, ignorenulls=True).over(Window.partitionBy("answer").orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("heading", carried).where(F.col("x").startswith("<tr"))
    title = strip(unescaped(F.regexp_replace(F.regexp_extract("x", r'(?s)<a[^>]*class="paper_title"[^>]*>(.*?)</a>', 1), "<[^>]+>", "")))
    pdf = F.regexp_extract("x", r'(?i)<a[^>]*href="([^"]+\.pdf)"', 1)
    rows = rows.select(F.format_string("%s-%09d", "answer", "n").alias("pos"), title.alias("title"), pdf.alias("url"), F.lit("open").alias("license"), topic("ibpsa", F.col("heading")).alias("topic"))
    return shaped(rows, "ibp-", "ibpsa", 52)


# Report addresses on the subject, and endings of translated editions.
IEA_SUBJECT = r"building|heat-pump|space-heating|space-cooling|\bcooling|\bheating|efficien|retrofit|renovation|envelope|district-heat|district-energy|cement|construction|appliance|lighting|air-condition|\bcooking|cookstove|demand-response|demand-side|smart-grid|electrification|energy-poverty|behaviour-change|\bcity|\bcities|\burban"
IEA_TRANSLATED = r"(?i)_(Chinese|Japanese|Korean|French|German|Spanish|Polish|Italian|Portuguese|Russian|Arabic|Turkish|Ukrainian|Vietnamese|Indonesian|Czech|Norwegian|Swedish|Danish|Traditional|Simplified)[A-Za-z]*\.pdf\z"


def iea_reports(sitemap: DataFrame, offset: int, limit: int) -> DataFrame:
    """url of the reports on the subject: a slice of the sorted distinct list. sitemap: payload."""
    from loamline.functions.text import java

    found = F.regexp_extract_all("payload", F.lit(r"<loc>(https://www\.iea\.org/reports/[a-z0-9-]+)</loc>"), F.lit(1))
    rows = sitemap.select(F.explode(found).alias("url")).distinct()
    return rows.where(F.element_at(F.split("url", "/"), -1).rlike(java(IEA_SUBJECT))).orderBy("url").offset(offset).limit(limit)


def iea(pages: DataFrame) -> DataFrame:
    """pages: url of a report, payload of its page. Only pages that state the license count."""
    pdfs = F.regexp_extract_all("payload", F.lit(r"https://iea\.blob\.core\.windows\.net/assets/[^\"'<>\s]+\.pdf"), F.lit(0))
    name = F.element_at(F.split("url", "/"), -1)
    title = strip(unescaped(F.regexp_replace(F.regexp_extract("payload", "(?s)<title>(.*?)</title>", 1), r"\s+", " ")))
    title = F.regexp_replace(title, r"\s*[–-]\s*Analysis\s*-\s*IEA\s*\z", "")
    rows = pages.where(F.col("payload").rlike(r"Licence:\s*CC BY 4\.0")).select(F.col("url").alias("pos"), name.alias("name"), F.when(title != "", title).otherwise(name).alias("title"), _first(pdfs, lambda p: ~p.rlike(IEA_TRANSLATED)).alias("url"), F.lit("cc-by").alias("license"))
    return shaped(rows.withColumn("topic", topic("iea", F.col("name"))), "iag-", "iea", 50, id_text=F.col("name"))


def boverket(pages: DataFrame, base: str = "https://www.boverket.se") -> DataFrame:
    """pages: url, payload of a publication's page."""
    title = strip(unescaped(F.regexp_replace(F.regexp_extract("payload", "(?s)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", "")))
    pdf = F.regexp_extract("payload", r'(?i)href="(/globalassets/[^"]+\.pdf)"', 1)
    rows = pages.select(F.col("url").alias("pos"), title.alias("title"), F.when(pdf != "", F.concat(F.lit(base), pdf)).alias("url"), F.lit("open").alias("license"))
    return shaped(rows.withColumn("topic", topic("boverket", F.col("title"))), "bov-", "boverket", 50)


def decoded(content: Column) -> Column:
    """Bytes as UTF-8, or as Shift-JIS where they are not that."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "Shift_JIS"))


def japan_report(pages: DataFrame) -> DataFrame:
    """pages: url, payload, banner, prefix, n. The whole document where there is one, else its chapters."""
    after = F.regexp_extract("payload", r"(?s)建築研究(?:報告|資料)</b>(.*)", 1)
    whole = F.when(after != "", after).otherwise(F.col("payload"))
    table = F.regexp_replace(F.regexp_extract(whole, r"(?s)(<table.*?)</table>", 1), "<[^>]+>", "")
    lines = F.filter(F.transform(F.split(table, "[\r\n]+"), strip), lambda s: s != "")
    title = F.coalesce(strip(F.btrim(F.get(lines, 0), F.lit("「」"))), F.concat(F.lit("No."), F.col("n").cast("string")))
    hrefs = F.regexp_extract_all("payload", F.lit(r'(?is)<a[^>]+href="([^"]+\.pdf)[^"]*"[^>]*>(.*?)</a>'), F.lit(1))
    labels = F.regexp_extract_all("payload", F.lit(r'(?is)<a[^>]+href="([^"]+\.pdf)[^"]*"[^>]*>(.*?)</a>'), F.lit(2))
    folder = F.regexp_extract("url", r"\A(.*/)", 1)
    rows = pages.select("url", "banner", "prefix", "n", title.alias("report"), F.arrays_zip(hrefs.alias("href"), labels.alias("label")).alias("found"), folder.alias("folder"))
    clean = lambda t: strip(F.regexp_replace(F.replace(unescaped(F.regexp_replace(t, "<[^>]+>", " ")), F.lit("　"), F.lit(" ")), r"\s+", " "))
    at = lambda h, folder: F.when(h.rlike("^https?://"), h).otherwise(F.concat(folder, h))
    links = F.transform("found", lambda x: F.struct(at(x["href"], F.col("folder")).alias("u"), clean(x["label"]).alias("l")))
    rows = rows.withColumn("links", F.filter(links, lambda x: F.lower(F.regexp_extract(x["u"], r"([^/]*)\.[^./]*\z", 1)) != "agreement"))
    rows = rows.withColumn("links", F.filter("links", lambda x, i: (i == 0) | ~F.exists(F.slice("links", 1, i), lambda y: y["u"] == x["u"])))
    full = F.filter("links", lambda x: x["l"].contains("全文"))
    rows = rows.withColumn("all", F.size(full) > 0).select("banner", "prefix", "n", "report", "url", "all", F.posexplode(F.when(F.size(full) > 0, F.slice(full, 1, 1)).otherwise(F.col("links"))).alias("k", "x"))
    number = F.concat(F.col("prefix"), F.lit("-"), F.col("n").cast("string"), F.lit("-"))
    stem = slug(F.regexp_extract("x.u", r"([^/]*)\.[^./]*\z", 1))
    base = F.concat("banner", F.lit(" No."), F.col("n").cast("string"), F.lit(" — "), "report")
    part = F.when(F.col("x.l") != "", F.concat(base, F.lit("｜"), "x.l")).otherwise(base)
    return rows.select(F.concat(number, F.when(F.col("all"), "all").otherwise(F.when(stem != "", stem).otherwise("pdf"))).alias("id"), F.when(F.col("all"), base).otherwise(part).alias("title"), F.col("x.u").alias("url"), F.lit("bri_jp").alias("source"), F.lit("open").alias("license"), topic("japan", F.col("report")).alias("topic"), F.lit("pdf").alias("format"), F.format_string("%s-%06d", "url", "k").alias("pos"))


def japan_year(pages: DataFrame) -> DataFrame:
    """pages: url, payload (an annual report's list of articles), year. One entry an article; the bundle of all is none."""
    links = F.arrays_zip(_hrefs("payload", 1).alias("href"), _hrefs("payload", 2).alias("label"))
    folder = F.regexp_extract("url", r"\A(.*/)", 1)
    clean = lambda t: strip(F.regexp_replace(F.replace(unescaped(F.regexp_replace(t, "<[^>]+>", " ")), F.lit("　"), F.lit(" ")), r"\s+", " "))
    at = F.transform(links, lambda x: F.struct(F.when(x["href"].rlike("^https?://"), x["href"]).otherwise(F.concat(folder, x["href"])).alias("u"), clean(x["label"]).alias("l")))
    rows = pages.select("year", at.alias("links"))
    once = F.filter("links", lambda x, i: (i == 0) | ~F.exists(F.slice("links", 1, i), lambda y: y["u"] == x["u"]))
    rows = rows.select("year", F.posexplode(F.filter(once, lambda x: ~x["l"].contains("全ページ"))).alias("k", "x"))
    stem = F.regexp_extract("x.u", r"([^/]*)\.[^./]*\z", 1)
    prefix = F.concat(F.lit("ar"), F.col("year").cast("string"))
    tail = slug(F.when(F.lower(stem).startswith(prefix), F.substring(stem, F.length(prefix) + 1, F.length(stem))).otherwise(stem))
    number = F.col("k") + 1
    ident = F.concat(F.lit("jpn-nilim-"), F.col("year").cast("string"), F.lit("-"), F.when(tail != "", tail).otherwise(number.cast("string")))
    title = F.when(F.col("x.l") != "", F.concat(F.lit("国総研資料 "), F.col("year").cast("string"), F.lit(" — "), "x.l")).otherwise(F.format_string("NILIM annual research report %d item %03d", "year", number))
    return rows.select(ident.alias("id"), title.alias("title"), F.col("x.u").alias("url"), F.lit("nilim_jp").alias("source"), F.lit("open").alias("license"), topic("japan", F.col("x.l")).alias("topic"), F.lit("pdf").alias("format"), F.format_string("%06d-%06d", "year", "k").alias("pos"))


def _hrefs(page: str, group: int) -> Column:
    return F.regexp_extract_all(page, F.lit(r'(?is)<a\s+href="([^"]+\.pdf)(?:#[^"]*)?"[^>]*>(.*?)</a>'), F.lit(group))


def crawl_links(pages: DataFrame, site: str, prefix: str = "") -> DataFrame:
    """page, n, target: the links of fetched pages (url, payload) that a crawl of a site follows, in order."""
    page = F.regexp_replace("url", "#.*", "")
    hrefs = F.regexp_extract_all("payload", F.lit(r'(?is)<a\s[^>]*?href\s*=\s*["\']([^"\']*)["\']'), F.lit(1))
    rows = pages.select(page.alias("page"), F.posexplode(hrefs).alias("n", "href")).withColumn("href", F.regexp_replace(strip(F.replace("href", F.lit("&amp;"), F.lit("&"))), "#.*", ""))
    rows = rows.select("page", "n", resolved(F.col("page"), F.col("href")).alias("target"))
    return rows.where(crawlable(F.col("target"), F.lit(site), F.lit(prefix)))


def resolved(base: Column, href: Column) -> Column:
    """The address that a link means on a page: absolute, from the host, from the folder, or the page itself."""
    scheme, site = F.regexp_extract(base, r"\A([^:]+:)", 1), F.regexp_extract(base, r"\A([^:]+://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"\A[^:]+://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"\A(.*/)", 1))
    joined = F.concat(folder, href)
    # dots: each pass takes one folder with the ".." behind it away
    plain = F.regexp_replace(F.regexp_replace(joined, r"/(?:\./)+", "/"), r"/\.\z", "/")
    for _ in range(8):
        plain = F.regexp_replace(plain, r"/(?!\.\./)[^/?]+/\.\.(?:/|\z)", "/")
    plain = F.regexp_replace(plain, r"\A(?:/\.\.)+(?=/)", "")
    return F.when(href.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(site, href)).when(href == "", base).when(href.startswith("?"), F.concat(site, path, href)).otherwise(F.concat(site, plain))


def crawl(pages: DataFrame, seed: str, source: str, topic_: str, prefix: str = "", license_: str = "open", most: int = 80, depth: int = 50) -> DataFrame:
    """Entries for the first pages that a breadth-first walk from a seed meets. pages: url, payload of fetched HTML.

    Pages go by hops, then by the place of the link that leads there first. The walk ends after most
    pages, or where no new page is found.
    """
    from loamline.functions.text import host as host_of
    from loamline.session import checkpoint

    spark = pages.sparkSession
    start = seed.split("#")[0]
    site = spark.range(1).select(host_of(F.lit(start))).first()[0]
    links = checkpoint(crawl_links(pages, site, prefix))
    there = pages.select(F.regexp_replace("url", "#.*", "").alias("page")).distinct()
    level = checkpoint(there.where(F.col("page") == start).select("page", F.lit("").alias("place")))
    found, n = level, level.count()
    for _ in range(depth):
        if n >= most:
            break
        ahead = level.join(links, "page").groupBy(F.col("target").alias("page")).agg(F.min(F.format_string("%s/%06d", "place", "n")).alias("place"))
        ahead = ahead.join(found, "page", "left_anti").join(there, "page", "left_semi")
        # a walk needs no more than the first of a level
        level = checkpoint(ahead.orderBy("place").limit(most - n))
        fresh = level.count()
        if not fresh:
            break
        found, n = found.unionByName(level), n + fresh
    hops = F.length("place") - F.length(F.replace("place", F.lit("/"), F.lit("")))
    path = F.regexp_extract("page", r"\A[^:]+://[^/?#]*([^?#]*)", 1)
    rest = F.when(F.lit(prefix != "") & path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 20)).otherwise(path)
    name = F.when(slug(rest) != "", slug(rest)).otherwise("index")
    shown = F.btrim(rest, F.lit("/"))
    return found.select(
        F.substring(F.concat(F.lit(f"crawl-{source}-"), name), 1, 62).alias("id"), F.substring(F.concat(F.lit(f"{source} docs: "), F.when(shown != "", shown).otherwise("index")), 1, 150).alias("title"),
        F.col("page").alias("url"), F.lit(source).alias("source"), F.lit(license_).alias("license"), F.lit(topic_).alias("topic"), F.lit("html").alias("format"), F.format_string("%06d%s", hops, "place").alias("pos"),
    )


PARSERS: dict[str, Callable] = {f.__name__: f for f in (openalex, osti, openaire, jrc, nist, modelica, books, archive, zenodo, worldbank, govuk, scielo, github, wiki, ademe, kitopen, purdue, jstage, arxiv, patents, sdz, ibpsa, iea, boverket, japan_report, japan_year)}

