"""Planning and checking of fetches: what to get, in which order, what to accept, what drifted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import body, chars_in, host, render_header, sha256, strip
from loamline.operators.registry import fetchable

# Limits for each host.
REQUESTS_AT_ONCE = 2
HOST_REQUESTS = {"www.osti.gov": 4, "library.oapen.org": 4, "patents.google.com": 4, "documents.worldbank.org": 4, "documents1.worldbank.org": 4, "www.scielo.br": 4}
HOST_DELAY = {"www.jstage.jst.go.jp": 2.0, "www.boverket.se": 10.0, "publications.ibpsa.org": 2.5, "bigladdersoftware.com": 10.0}
THROTTLED = ["automated queries", "unusual traffic", "Too many requests", "too many requests"]
TEXT_FORMATS = ["md", "rst", "txt"]


def planned(entries: DataFrame, manifest: DataFrame, only: list[str] | None = None, force: bool = False) -> DataFrame:
    """Entries to fetch: allowed, of a wanted topic, and not already there (manifest: id, status, has_raw)."""
    wanted = entries.where(fetchable(F.col("license")))
    if only:
        wanted = wanted.where(F.col("topic").isin(only))
    if force:
        return wanted
    there = manifest.where("status = 'ok' and has_raw").select("id")
    return wanted.join(there, "id", "left_anti")


def fair_order(entries: DataFrame, position: str) -> DataFrame:
    """The entries with turn and host_place: hosts take turns in order of first appearance."""
    keyed = entries.withColumn("host", host(F.col("url")))
    own = Window.partitionBy("host")
    return keyed.withColumns({"turn": F.row_number().over(own.orderBy(position)), "host_place": F.min(position).over(own)})


def host_limits(url: Column) -> tuple[Column, Column]:
    """Requests at once, and seconds between their starts."""
    at_once, delay = F.lit(REQUESTS_AT_ONCE), F.lit(0.0)
    for name, n in HOST_REQUESTS.items():
        at_once = F.when(host(url) == name, n).otherwise(at_once)
    for name, seconds in HOST_DELAY.items():
        delay = F.when(host(url) == name, seconds).otherwise(delay)
    return at_once, delay


def slots(entries: DataFrame, position: str) -> DataFrame:
    """The entries with slot: host and request lane. Repartitioned by it, a fetch runs one lane a task."""
    at_once, _ = host_limits(F.col("url"))
    order = Window.partitionBy(host(F.col("url"))).orderBy(position)
    return entries.withColumn("slot", F.concat(host(F.col("url")), F.lit("#"), ((F.row_number().over(order) - 1) % at_once).cast("string")))


def acceptable(payload: Column, fmt: Column) -> Column:
    """Whether a second attempt's bytes are the document and no throttling page."""
    start = F.substring(payload, 1, 4000).cast("string")
    calm = ~start.contains(THROTTLED[0])
    for phrase in THROTTLED[1:]:
        calm = calm & ~start.contains(phrase)
    return (F.octet_length(payload) > 512) & F.when(fmt == "pdf", is_pdf(payload)).otherwise(calm)


def is_pdf(payload: Column) -> Column:
    return F.substring(payload, 1, 5) == F.lit("%PDF-").cast("binary")


def rejection(payload: Column, fmt: Column) -> Column:
    """The error of a payload that says it is a PDF and is not; null otherwise."""
    return F.when((fmt == "pdf") & ~is_pdf(payload), F.concat(F.lit("not-a-pdf (got "), F.hex(F.substring(payload, 1, 12)), F.lit(")")))


def new_record(entries: DataFrame) -> DataFrame:
    """Manifest rows before the fetch, with defaults for what an entry lacks."""
    has = lambda c: F.col(c) if c in entries.columns else F.lit(None).cast("string")
    fmt = F.coalesce(has("format"), F.lit("pdf"))
    ext = F.when(fmt.isin("pdf", "html", *TEXT_FORMATS), fmt).otherwise("bin")
    text = {"title": F.coalesce(has("title"), F.col("id")), "url": F.col("url"), "source": F.coalesce(has("source"), F.lit("misc")), "license": F.coalesce(has("license"), F.lit("unknown")), "topic": F.coalesce(has("topic"), F.lit("misc")), "format": fmt}
    return entries.select("id", *[c.alias(n) for n, c in text.items()], F.lit("failed").alias("status"), F.lit(None).cast("int").alias("http_status"), F.lit(None).cast("string").alias("sha256"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("text_chars"), F.lit(0).cast("long").alias("corpus_chars"), F.lit(None).cast("string").alias("error"), ext.alias("ext"))


def verify(manifest: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: match, mismatch, missing, ok_docs. raw: id, sha256 of the bytes that are there."""
    rows = manifest.where("status = 'ok'").join(raw.select("id", F.col("sha256").alias("actual")), "id", "left")
    hashed = F.coalesce(F.col("sha256") != "", F.lit(False))
    count = lambda when, name: F.count(F.when(hashed & when, 1)).alias(name)
    return rows.agg(count(F.col("actual") == F.col("sha256"), "match"), count(F.col("actual") != F.col("sha256"), "mismatch"), count(F.col("actual").isNull(), "missing"), F.count("*").alias("ok_docs"))


def reproduction(fetched: DataFrame, manifest: DataFrame) -> DataFrame:
    """id, tag of ok fetches: reproduced, DRIFTED, or new. fetched: id, status, sha256."""
    expected = manifest.where("sha256 <> ''").select("id", F.col("sha256").alias("expected"))
    rows = fetched.where("status = 'ok'").join(expected, "id", "left")
    tag = F.when(F.col("expected") == F.col("sha256"), "reproduced").when(F.col("expected").isNotNull(), "DRIFTED").otherwise("new")
    return rows.select("id", tag.alias("tag"))


def reused(fetched: DataFrame, manifest: DataFrame) -> DataFrame:
    """id, rendered, text_sha256, text_chars of fetched rows whose bytes are known already.

    fetched: id, title, url, license, topic, sha256. manifest: sha256, status, text, position; of rows
    alike in bytes the last ok one with text serves.
    """
    order = Window.partitionBy("sha256").orderBy(F.col("position").desc())
    templates = manifest.where("status = 'ok' and sha256 <> '' and text is not null").withColumn("_n", F.row_number().over(order)).where("_n = 1").select("sha256", body(F.col("text")).alias("_body")).where("_body <> ''")
    rows = fetched.join(templates, "sha256")
    rendered = F.concat(render_header(F.col("title"), F.col("url"), F.col("license"), F.col("topic")), F.col("_body"))
    return rows.select("id", rendered.alias("rendered"), sha256(rendered).alias("text_sha256"), F.length("_body").cast("long").alias("text_chars"))


def extract_once(fetched: DataFrame, extract) -> DataFrame:
    """Runs extract on one row for each distinct sha256 and hands its text to all rows alike.

    extract takes and returns a frame; it adds a column text.
    """
    texts = extract(fetched.dropDuplicates(["sha256"])).select("sha256", "text")
    return fetched.join(texts, "sha256", "left")


def by_format(fetched: DataFrame, pdf_columns: tuple[str, str] | None = None) -> DataFrame:
    """The frame with text: what its format's extractor makes of payload; other formats give the empty text.

    fetched: format, payload (bytes). A PDF's text is chosen from two extractions that are columns (a
    parser of PDFs is not part of this engine); without them it is empty.
    """
    from loamline.operators import html

    kind = F.lower(F.coalesce("format", F.lit("")))
    page = F.when(kind == "html", F.replace(F.make_valid_utf8(F.col("payload").cast("string")), F.lit("�"), F.lit("")))
    pdf = arbitrated(F.coalesce(pdf_columns[0], F.lit("")), F.coalesce(pdf_columns[1], F.lit(""))) if pdf_columns else F.lit("")
    names = [c for c in fetched.columns if c != "text"]
    read = html.extracted(fetched.select(*names, page.alias("_page")), "_page")
    text = F.when(kind == "html", F.col("text")).when(kind.isin("md", "rst", "txt"), plain_text(F.col("payload"))).when(kind == "pdf", pdf)
    return read.select(*names, F.coalesce(text, F.lit("")).alias("text"))


def extracted_again(manifest: DataFrame, raw: DataFrame, pdf_columns: tuple[str, str] | None = None) -> DataFrame:
    """id, rendered, text_sha256, text_chars, changed: ok rows' texts made anew from the bytes that are there.

    manifest: id, title, url, license, topic, format, status, text_sha256. raw: id, payload (and the PDF
    columns). Equal bytes of a format are read once. A row without bytes, or whose text comes out empty,
    is left out. Rows go by id.
    """
    rows = manifest.where("status = 'ok'").select("id", "title", "url", "license", "topic", "format", F.col("text_sha256").alias("_before")).join(raw, "id")
    rows = rows.withColumn("sha256", F.sha2(F.concat(F.coalesce("format", F.lit("")).cast("binary"), F.lit("\n").cast("binary"), "payload"), 256))
    texts = extract_once(rows, lambda some: by_format(some, pdf_columns)).where("text <> ''")
    rendered = F.concat(render_header(F.col("title"), F.col("url"), F.col("license"), F.col("topic")), F.col("text"))
    out = texts.select("id", rendered.alias("rendered"), sha256(rendered).alias("text_sha256"), F.length("text").cast("long").alias("text_chars"), "_before")
    return out.select("id", "rendered", "text_sha256", "text_chars", (~F.col("text_sha256").eqNullSafe(F.col("_before"))).alias("changed")).orderBy("id")


def plain_text(payload: Column) -> Column:
    """UTF-8 text of bytes, malformed sequences left out, stripped."""
    return strip(F.replace(F.make_valid_utf8(payload.cast("string")), F.lit("�"), F.lit("")))


def word_glued(text: Column) -> Column:
    """Whether words run together, as in a scan without space glyphs."""
    from loamline.functions.patterns import CJK

    start = F.substring(text, 1, 20_000)
    size = F.length(start)
    spaces = size - F.length(F.replace(start, F.lit(" "), F.lit("")))
    return (size > 0) & (chars_in(start, CJK) / size <= 0.10) & (spaces / size < 0.05)


def arbitrated(first: Column, second: Column) -> Column:
    """The better of two extractions of a PDF: the second where the first is short, glued or garbled."""
    from loamline.functions.patterns import CJK

    poor = (F.length(first) < 500) | word_glued(first)
    rescue = (F.length(second) > F.greatest(F.length(first), F.lit(400))) & ~word_glued(second)
    start = F.substring(first, 1, 20_000)
    cjk = chars_in(start, CJK)
    garbled = (cjk > 50) & (chars_in(start, r"\p{L}") / F.greatest(F.length(start), F.lit(1)) < 0.60)
    better = chars_in(F.substring(second, 1, 20_000), CJK) > cjk * 1.3
    return F.when(poor, F.when(rescue, second).otherwise(first)).when(garbled & better, second).otherwise(first)


def pending_repositories(wanted: DataFrame, walked: DataFrame, code_pulled: DataFrame) -> DataFrame:
    """Repositories never walked, or wanted with code whose code is not there (repo, code)."""
    fresh = wanted.join(walked.select("repo").distinct(), "repo", "left_anti")
    partial = wanted.where("code").join(walked.select("repo").distinct(), "repo", "left_semi").join(code_pulled.select("repo").distinct(), "repo", "left_anti")
    return fresh.unionByName(partial)
