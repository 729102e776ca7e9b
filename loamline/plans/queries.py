"""Registered queries of the corpus operators, and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions.text import big_number, blocklist_key, body, entry_id, entry_title, header, host, native_id, norm, page_url, previous_week, render_header, slug, tokens, url_key
from loamline.operators import coverage, fetch, html, lines, merge, prune, quality, registry, report, resolve
from loamline.operators.discovery import license_of_id, permissive_or_open, topic
from loamline.plans import answers, oracle
from loamline.plans.derived import dealt, fixture_documents, line_documents, manifest, table
from loamline.session import remove_folder, shared_folder
from loamline.streaming import rounds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {**answers.QUERIES}
ORACLE_SQL: dict[str, str] = {**oracle.SQL, **answers.SQL}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- quality -------------------------------------------------------------------------------------


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "lang", "text")
    return quality.assessed(docs, "text")


@query
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _assessed(spark, sf_dir)
    return seen.select("doc_id", F.col("quality.total").alias("total"), *[F.col(f"quality.{w}.{m}").alias(f"{w}_{m}") for w in ("w20", "w100") for m in ("chars", "alpha", "words", "cjk", "en", "domain")])


@query
def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(spark, sf_dir).select("doc_id", "verdict")


@query
def quality_verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(spark, sf_dir).groupBy("verdict", "lang").agg(F.count("*").alias("n"))


@query
def off_domain_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = spark.createDataFrame([(i, t) for i, t in enumerate(oracle.TITLES)], "n int, title string")
    return titles.select("n", quality.off_domain_title(F.col("title")).alias("off"))


@query
def word_glue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fetch.word_glued(F.replace("text", F.lit(" "), F.when(F.col("doc_id") % 3 == 0, "").otherwise(" "))).alias("glued"))


# --- cleaning ------------------------------------------------------------------------------------


@query
def clean_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.flagged(line_documents(spark, sf_dir)).where("rule is not null").select("id", "i", "rule")


@query
def clean_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.attribution(line_documents(spark, sf_dir))


@query
def clean_text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.cleaned(line_documents(spark, sf_dir)).select("id", "corpus_chars", "corpus_sha256")


@query
def clean_report_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(line_documents(spark, sf_dir))


def _rule(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lines.flagged(line_documents(spark, sf_dir), rules=[name]).where(F.col(f"is_{name}")).select("id", "i")

    run.__name__ = f"clean_{name}"
    return run


for _name in lines.RULES:
    query(_rule(_name))


def _half_cleaned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Expected rows, and a corpus with holes, strangers and drift."""
    done = lines.cleaned(line_documents(spark, sf_dir)).withColumn("id", F.col("id").cast("string"))
    expected = done.select("id", (F.col("corpus_chars") + F.when(F.col("id").cast("long") % 7 == 0, 1).otherwise(0)).alias("corpus_chars"), F.when(F.col("id").cast("long") % 11 == 0, F.sha2("id", 256)).otherwise(F.col("corpus_sha256")).alias("corpus_sha256"))
    corpus = done.where(F.col("id").cast("long") % 13 != 0).select("id", F.col("cleaned_text").alias("text"))
    strangers = fixture_documents(spark).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("id"), "text")
    return expected, corpus.unionByName(strangers)


@query
def clean_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.check(*_half_cleaned(spark, sf_dir))


@query
def clean_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, corpus = _half_cleaned(spark, sf_dir)
    return lines.orphans(corpus, expected).select("id")


@query
def clean_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select("id", F.col("sha256").alias("text_sha256"), "pos")
    corpus = rows.where("pos % 5 <> 0").select("id", F.when(F.col("pos") % 3 == 0, F.sha2("id", 256)).otherwise(F.col("text_sha256")).alias("text_sha256"), F.when(F.col("pos") % 4 == 0, "none").otherwise("all").alias("ruleset"))
    return lines.stale(rows, corpus, "all")


# --- pruning -------------------------------------------------------------------------------------


@query
def prune_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the real gate."""
    return prune.reasons(manifest(spark, sf_dir, spread=True)).where("reason is not null").select("id", "reason")


def _passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest with metrics under which every text passes, so that duplicates decide."""
    good = F.struct(F.lit(5000).cast("long").alias("chars"), F.lit(0.9).alias("alpha"), F.lit(900).cast("long").alias("words"), F.lit(0).cast("long").alias("cjk"), F.lit(9).cast("long").alias("en"), F.lit(99).cast("long").alias("domain"))
    m = F.struct(F.lit(5000).cast("long").alias("total"), good.alias("w20"), good.alias("w100"))
    return prune.reasons(manifest(spark, sf_dir).withColumn("quality", m))


@query
def dup_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passing(spark, sf_dir).where("reason = 'dup-title'").select("id", "title")


@query
def dup_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).withColumn("title", F.col("id"))  # titles apart, so that bytes decide
    good = _passing(spark, sf_dir).select("id", "quality")
    return prune.reasons(rows.join(good, "id")).where("reason = 'dup-bytes'").select("id", "sha256")


@query
def prune_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune.reason_counts(_passing(spark, sf_dir))


@query
def prune_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prune.ledger(_passing(spark, sf_dir), "2026-01-01T00:00:00Z", "run-1")
    return rows.select("id", "url", "reason", "source", "topic", "license", "http_status", "sha256", "blocklisted", "pruned_at", "run_id")


@query
def blocklist_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = manifest(spark, sf_dir).where("pos % 3 = 0").select(F.concat(F.lit("  "), "url", F.lit("/ ")).alias("url"))
    return prune.blocklist_add(have, prune.blocked_urls(_passing(spark, sf_dir)))


@query
def prune_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune.kept(manifest(spark, sf_dir), _passing(spark, sf_dir)).select("id")


# --- registry ------------------------------------------------------------------------------------


@query
def slug_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).select("id", slug(F.col("title")).alias("slug"), norm(F.col("title")).alias("norm"), url_key(F.col("url")).alias("url_key"), blocklist_key(F.concat(F.lit(" "), "url")).alias("block_key"))


@query
def shard_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select("id", F.regexp_replace(registry.shard(F.col("id")), r"^(patents-[a-z]{2})-\d+$", "$1").alias("route"), registry.discovered(F.col("id")).alias("discovered"))
    return rows


@query
def shard_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).select("id", registry.shard(F.col("id")).alias("shard"))


@query
def known_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    return registry.known_keys(rows.where("pos % 2 = 0"), rows.where("pos % 3 = 0"), rows.where("pos % 5 = 0").select("url"))


@query
def new_candidates_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    known = registry.known_keys(rows.where("pos % 2 = 0"), rows.where("pos % 3 = 0"))
    return registry.new_candidates(rows, known).select("id", "url")


@query
def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).withColumn("id", F.col("source"))
    return registry.index_documents(rows, "pos").select("id", "url", "topic")


@query
def registry_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    return registry.remove(rows, rows.where("pos % 9 = 4")).select("id", "title")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entries with faults of every kind."""
    rows = manifest(spark, sf_dir).where("pos % 10 <> 9").select(*registry.REQUIRED, "pos")
    fault = lambda k, good, bad: F.when(F.col("pos") % 41 == k, bad).otherwise(good)
    return rows.select(
        fault(9, F.col("id"), F.concat(F.lit("hand-"), (F.col("pos") % 3).cast("string"))).alias("id"),
        fault(1, F.col("title"), F.lit("")).alias("title"), fault(2, F.col("url"), F.lit("ftp://x.example.org/1")).alias("url"), "source",
        fault(3, F.col("license"), F.lit("unknown")).alias("license"), fault(4, F.col("topic"), F.lit("gardens")).alias("topic"), fault(5, F.col("format"), F.lit(None).cast("string")).alias("format"),
        F.when(F.col("pos") % 41 == 6, "www.example.org").alias("license_url"), "pos",
    ).withColumn("shard", F.when(F.col("pos") % 41 == 7, "books").otherwise(registry.shard(F.col("id"))))


@query
def lint_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.lint_entries(_entries(spark, sf_dir))


@query
def lint_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).withColumn("license", F.when(F.col("pos") % 29 == 0, "proprietary-internal").otherwise(F.col("license"))).withColumn("sha256", F.when(F.col("pos") % 31 == 0, "zz").otherwise(F.col("sha256")))
    return registry.lint_manifest(rows, _entries(spark, sf_dir))


@query
def backend_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    backends = spark.createDataFrame([("a", "find_a.py", None), ("b", "find_b.py", True), ("c", "find_c.py", False), ("d", "gone.py", False), ("_note", "x", None)], "name string, script string, rotation boolean")
    pointers = spark.createDataFrame([("a",), ("c",), ("e",), ("_comment",)], "name string")
    scripts = spark.createDataFrame([("find_a.py",), ("find_b.py",), ("find_c.py",)], "script string")
    return registry.validate_backends(backends, pointers, scripts)


# --- coverage and reports ------------------------------------------------------------------------


def _cleaned_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).withColumn("corpus_chars", F.when(F.col("pos") % 5 == 0, 0).otherwise(F.col("text_chars") - F.col("pos") % 7))


@query
def stats_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.totals(_cleaned_manifest(spark, sf_dir))


@query
def by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_topic(manifest(spark, sf_dir))


@query
def by_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by_license(manifest(spark, sf_dir))


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.load_report(manifest(spark, sf_dir))


@query
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.duplicate_groups(manifest(spark, sf_dir), "sha256")


@query
def big_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 1234567).cast("double").alias("n"))
    return rows.select("c_custkey", big_number(F.col("n")).alias("shown"))


_SOURCES = ["osti", "gh_a", "wikipedia_de", "oapen", "gov_uk", "gov_x", "kitopen", "arxiv", "zenodo", "sdz_at", "nowhere", "eia", "brick", "unmethours", "patents"]


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(s) for s in _SOURCES])
    return manifest(spark, sf_dir).withColumn("source", F.get(names, (F.col("pos") * F.col("pos") % len(_SOURCES)).cast("int")))


@query
def genre_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.genre_coverage(_sourced(spark, sf_dir))


@query
def uncategorized_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.uncategorized(_sourced(spark, sf_dir))


def _seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ok rows of the manifest with subject words put before the text, of which coverage reads the head."""
    words = F.array(*[F.lit(s) for s in oracle.SUBJECTS])
    rows = _sourced(spark, sf_dir).where("status = 'ok'")
    rows = dealt(rows.select("id", "title", "source", "license", "text_chars", F.substring("body", 1, coverage.HEAD_CHARS + 400).alias("body"), "pos"))
    return rows.withColumn("body", F.concat(F.get(words, (F.col("pos") % len(oracle.SUBJECTS)).cast("int")), F.lit("\n"), "body"))


@query
def facet_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.marginals(_seeded(spark, sf_dir))


@query
def cross_cells_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.cross_cells(_seeded(spark, sf_dir), "lifecycle", list(coverage.LIFECYCLE))


@query
def cross_domain_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.cross_table(_seeded(spark, sf_dir), "lifecycle", list(coverage.LIFECYCLE))


@query
def cross_domain_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.cross_table(_seeded(spark, sf_dir), "region", coverage.REGION_COLUMNS)


@query
def detect_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return docs.select("doc_id", coverage.language(F.col("text")).alias("detected"))


@query
def lang_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select("lang", coverage.language(F.col("text")).alias("detected"))
    return docs.groupBy("lang", "detected").agg(F.count("*").alias("n"))


# --- fetching ------------------------------------------------------------------------------------


@query
def fair_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fair_order(manifest(spark, sf_dir).select("id", "url", "pos"), "pos").select("id", "host", "turn", "host_place")


@query
def host_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select("id", F.when(F.col("pos") % 2 == 0, F.concat(F.lit("https://www.osti.gov/"), "id")).otherwise(F.col("url")).alias("url"), "pos")
    return fetch.slots(rows, "pos").select("id", "slot")


@query
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    entries = rows.withColumn("license", F.when(F.col("pos") % 6 == 5, "proprietary-internal").when(F.col("pos") % 12 == 0, None).otherwise(F.col("license")))
    return fetch.planned(entries, rows.withColumn("has_raw", F.col("pos") % 3 == 0), only=["building_energy", "urban"]).select("id")


@query
def fetch_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.when(F.col("pos") % 4 == 0, "%PDF-1.7").when(F.col("pos") % 4 == 1, "unusual traffic").otherwise(""), "body").cast("binary")
    return manifest(spark, sf_dir).select("id", fetch.acceptable(payload, F.col("format")).alias("accepted"), fetch.rejection(payload, F.col("format")).isNotNull().alias("rejected"))


@query
def verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    raw = rows.where("pos % 7 <> 0").select("id", F.when(F.col("pos") % 5 == 0, F.sha2("id", 256)).otherwise(F.col("sha256")).alias("sha256"))
    return fetch.verify(rows, raw)


@query
def repro_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    before = rows.where("pos % 4 <> 0").withColumn("sha256", F.when(F.col("pos") % 3 == 0, F.sha2("id", 256)).otherwise(F.col("sha256")))
    return fetch.reproduction(rows, before).groupBy("tag").agg(F.count("*").alias("n"))


@query
def extract_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    have = rows.where("pos % 2 = 0").select("sha256", "status", F.concat(render_header(F.col("title"), F.col("url"), F.col("license"), F.col("topic")), "body").alias("text"), F.col("pos").alias("position"))
    return fetch.reused(rows.where("pos % 2 = 1"), have).select("id", "text_sha256", "text_chars")


@query
def header_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    text = F.when(F.col("pos") % 2 == 0, F.concat(render_header(F.col("title"), F.col("url"), F.col("license"), F.col("topic")), "body")).otherwise(F.col("body"))
    return rows.select("id", F.length(header(text)).cast("long").alias("header_chars"), F.sha2(body(text), 256).alias("body_sha256"), tokens(F.length(text)).alias("tokens"))


@query
def new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.new_record(manifest(spark, sf_dir)).select("id", "status", "bytes", "corpus_chars", "ext")


@query
def repos_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select(F.col("id").alias("repo"), "pos")
    wanted = rows.select("repo", (F.col("pos") % 2 == 0).alias("code"))
    return fetch.pending_repositories(wanted, rows.where("pos % 3 <> 0"), rows.where("pos % 5 = 0"))


@query
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extracted(table(spark, sf_dir, "pages", spread=True))
    text = F.when(F.col("html").isNotNull(), F.col("text"))  # a page that is not there has no text, not an empty one
    return pages.select("page_id", F.length(text).cast("long").alias("text_chars"), F.sha2(text, 256).alias("text_sha256"))


@query
def html_main_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links(table(spark, sf_dir, "pages"), "page_id")


@query
def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


# --- discovery -----------------------------------------------------------------------------------


@query
def topic_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = spark.createDataFrame([(i, t) for i, t in enumerate(oracle.SUBJECTS)], "n int, title string")
    return titles.select("n", *[topic(s, F.col("title")).alias(s) for s in ("kitopen", "worldbank", "patents", "sdz", "boverket", "modelica")])


@query
def license_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = spark.createDataFrame([(i,) for i in oracle.LICENSE_IDS], "ident string")
    return ids.select("ident", license_of_id(F.col("ident")).alias("tag"), permissive_or_open(F.col("ident")).alias("open_tag"))


@query
def shaped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    return rows.select("id", entry_id(F.col("source"), F.col("title")).alias("entry_id"), entry_title(F.concat(F.lit("  "), "title")).alias("entry_title"), native_id(F.when(F.col("pos") % 2 == 0, "建筑").otherwise(F.col("title"))).alias("native"))


@query
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir).select("id", page_url("https://x.example.org/wiki/", F.col("title")).alias("page_url"))


@query
def previous_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-W"), F.lpad((F.dayofyear("o_orderdate") % 53 + 1).cast("string"), 2, "0")).alias("week"))
    return rows.select("o_orderkey", previous_week(F.col("week")).alias("before"))


@query
def title_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select("id", "pos")
    normalized = rows.where("pos % 3 = 0").select(F.col("id").alias("from"), F.concat(F.lit("n-"), "id").alias("to"))
    redirects = rows.where("pos % 2 = 0").select(F.when(F.col("pos") % 3 == 0, F.concat(F.lit("n-"), "id")).otherwise(F.col("id")).alias("from"), F.concat(F.lit("r-"), "id").alias("to"))
    return resolve.final_titles(rows.select(F.col("id").alias("raw")), normalized, redirects)


@query
def links_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("page"), F.col("l_suppkey").cast("string").alias("target")).distinct()
    back = orders.select(F.concat(F.lit("s"), "target").alias("page"), F.col("page").alias("target"))
    links = orders.select("page", F.concat(F.lit("s"), "target").alias("target")).unionByName(back)
    return resolve.reached(spark.createDataFrame([("1",)], "page string"), links, 2)


# --- merging and rounds --------------------------------------------------------------------------


def _proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).where("title <> ''")
    backend = (F.col("pos") % 3).cast("int")
    shared = F.when(F.col("pos") % 7 == 0, F.concat(F.lit("https://shared.example.org/"), (F.col("pos") % 50).cast("string"))).otherwise(F.col("url"))
    return rows.select(F.substring("id", 1, 5).alias("id"), "title", shared.alias("url"), "source", "license", "topic", "format", F.concat(F.lit("b"), backend.cast("string")).alias("backend"), backend.alias("index"), "pos")


def _known_tenth(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenth = manifest(spark, sf_dir).where("pos % 10 = 0")
    return registry.known_keys(tenth, tenth.limit(0))


@query
def merge_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposals = _proposals(spark, sf_dir)
    merged = merge.merge_proposals(proposals, _known_tenth(spark, sf_dir), spark.createDataFrame([("ost-1",), ("gh-4-2",)], "id string"))
    return merged.select("id", "url", "backend", "pos")


@query
def uniquify_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir).select(F.substring("id", 1, 6).alias("id"), "pos")
    return merge.unique_ids(rows, spark.createDataFrame([("hand-3",), ("hand-3-2",)], "id string"), ["pos"])


@query
def finder_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.capped(manifest(spark, sf_dir), 3, ["title", "id"], ["source"]).select("id", "source")


@query
def shard_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.sampled(manifest(spark, sf_dir).withColumn("shard", registry.shard(F.col("id"))), 2, "id", ["shard"]).select("shard", "id")


@query
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    kind = F.abs(F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(5))) < 3
    return rounds.breaker(events, "user_id", "event_id", kind).select("event_id", "streak", "open")


@query
def rotation_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    pointers = rows.select(F.col("id").alias("name"), F.lit("--page").alias("flag"), F.when(F.col("pos") % 3 == 0, F.concat(F.lit("2026-W"), F.lpad((F.col("pos") % 52 + 1).cast("string"), 2, "0"))).otherwise(F.col("pos").cast("string")).alias("next"), F.when(F.col("pos") % 2 == 0, 25).alias("step"))
    return rounds.advanced(pointers, rows.where("status = 'ok'").select(F.col("id").alias("name"))).select("name", "next")


_ROUND = "doc_id long, url string, title string"


@query
def round_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round over the documents as a stream of candidates: what it commits, batch by batch."""
    folder = f"{shared_folder(spark)}/round-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.concat(F.lit("https://"), "source", F.lit(".example.org/"), (F.col("doc_id") % 700).cast("string")).alias("url"), F.substring(F.split("text", "\n")[0], 1, 150).alias("title"))
    for k in range(2):  # two files arrive one after the other; the second round sees the first
        rows.where(F.col("doc_id") % 2 == k).coalesce(4).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(_ROUND).parquet(f"{folder}/in")
        rounds.run_available(stream, f"{folder}/out", f"{folder}/checkpoint", _ROUND, ["doc_id"])
    for done in ("in", "checkpoint"):
        remove_folder(spark, f"{folder}/{done}")
    return rounds.committed(spark, f"{folder}/out", _ROUND)
