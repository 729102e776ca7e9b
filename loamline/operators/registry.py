"""Registry rules: routing of ids to shards, known keys, lint, index, removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import blocklist_key, norm, url_key

# Id prefix -> shard, in order; what matches none is hand-curated.
SHARDS = {
    "oer-": "books", "arc-": "archive", "gh-": "github", "crawl-": "crawl", "ost-": "reports",
    "eud-": "deliverables", "nst-": "nist", "pat-": "patents", "wik-": "wiki", "doa-": "doaj",
    "sdz-": "austria", "kit-": "kitopen", "adm-": "ademe", "jpn-": "japan", "ibp-": "ibpsa",
    "mod-": "modelica", "pur-": "purdue", "zen-": "zenodo", "wbd-": "worldbank", "jrc-": "jrc",
    "guk-": "govuk", "jst-": "jstage", "iag-": "iea", "bov-": "nordic", "sci-": "scielo",
    "ope-": "papers", "oa-": "papers", "arx-": "papers",
}
CURATED = "curated"
PATENT_BUCKETS = {"cn": 16, "us": 8}
REQUIRED = ["id", "title", "url", "source", "license", "topic", "format"]
OPTIONAL = ["language", "published_at", "jurisdiction", "document_type", "persistent_id", "license_url", "license_evidence", "rights_verified_at"]
FIELDS = REQUIRED + OPTIONAL
POINTER_ONLY = ["proprietary-internal"]
LICENSES = ["public-domain", "cc-by", "cc-by-sa", "cc0", "open", "proprietary-internal"]
TOPICS = ["controls_bas", "equipment_systems", "building_energy", "commissioning_fdd", "standards_protocols", "structures_civil", "construction", "materials", "architecture", "infrastructure", "urban"]
FORMATS = ["pdf", "html", "md", "rst", "txt"]
ENTRY_SCHEMA = ", ".join(f"{f} string" for f in FIELDS)


def discovered(ident: Column) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, [ident.startswith(p) for p in SHARDS]), F.lit(False))


def fetchable(license_: Column) -> Column:
    """A null license may be fetched."""
    return ~F.coalesce(license_.isin(POINTER_ONLY), F.lit(False))


def shard(ident: Column) -> Column:
    """Shard of an id: by the first prefix that fits; patents by country, large ones by a hash."""
    country = F.regexp_extract(ident, r"\Apat-([a-z]{2})", 1)
    patents = F.when(country == "", "patents")
    for name, buckets in PATENT_BUCKETS.items():
        patents = patents.when(country == name, F.concat(F.lit(f"patents-{name}-"), (F.crc32(ident.cast("binary")) % buckets).cast("string")))
    patents = patents.otherwise(F.concat(F.lit("patents-"), country))
    out = F.lit(CURATED)
    for prefix, stem in reversed(SHARDS.items()):
        out = F.when(ident.startswith(prefix), patents if stem == "patents" else F.lit(stem)).otherwise(out)
    return out


def shard_file(ident: Column) -> Column:
    """Name of the manifest shard, by which manifest order goes."""
    return F.concat(shard(ident), F.lit(".jsonl"))


# --- known keys and new candidates ---------------------------------------------------------------


def known_keys(manifest: DataFrame, entries: DataFrame, blocklist: DataFrame | None = None) -> DataFrame:
    """kind (url, title, id) and value: everything the corpus knows, without empty values."""
    both = manifest.select("id", "title", "url").unionByName(entries.select("id", "title", "url"))
    out = both.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in (("url", url_key(F.col("url"))), ("title", norm(F.col("title"))), ("id", F.coalesce("id", F.lit(""))))])))
    if blocklist is not None:
        out = out.unionByName(blocklist.select(F.lit("url").alias("kind"), blocklist_key(F.col("url")).alias("value")))
    return out.where("value <> ''").distinct()


def new_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates whose url and title are both unknown: two anti-joins, each on one key."""
    keys = lambda kind, name: known.where(F.col("kind") == kind).select(F.col("value").alias(name))
    keyed = candidates.withColumns({"_url_key": url_key(F.col("url")), "_title_key": norm(F.col("title"))})
    return keyed.join(keys("url", "_url_key"), "_url_key", "left_anti").join(keys("title", "_title_key"), "_title_key", "left_anti").drop("_url_key", "_title_key")


def index_documents(rows: DataFrame, position: str) -> DataFrame:
    """The last row of each id by position."""
    order = Window.partitionBy("id").orderBy(F.col(position).desc())
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def remove(entries: DataFrame, ids: DataFrame) -> DataFrame:
    return entries.join(ids.select("id").distinct(), "id", "left_anti")


def append(entries: DataFrame, added: DataFrame) -> DataFrame:
    """Entries and new ones together; an id that would occur twice is an error."""
    out = entries.unionByName(added, allowMissingColumns=True)
    again = added.groupBy("id").count().where("count > 1").select("id").union(added.join(entries, "id", "left_semi").select("id")).limit(5).collect()
    if again:
        raise ValueError("ids already taken: " + ", ".join(sorted(r["id"] for r in again)))
    return out


# --- lint ----------------------------------------------------------------------------------------


def _is_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"\Ahttps?://"), F.lit(False))


def lint_entries(entries: DataFrame) -> DataFrame:
    """check, id, detail: one row a problem. entries may have shard, where each was read from."""
    ident = F.coalesce("id", F.lit("<no id>"))
    shown = lambda c: F.coalesce(F.col(c), F.lit("None"))
    problem = lambda when, check, detail: F.when(when, F.struct(F.lit(check).alias("check"), ident.alias("id"), detail.alias("detail")))
    tests = [problem(F.coalesce(F.col(f), F.lit("")) == "", "missing field", F.lit(f)) for f in REQUIRED]
    for name, allowed in (("license", LICENSES), ("topic", TOPICS), ("format", FORMATS)):
        tests.append(problem(~F.coalesce(F.col(name).isin(allowed), F.lit(False)), f"unknown {name}", shown(name)))
    tests.append(problem(~_is_http(F.col("url")), "url is not http(s)", shown("url")))
    if "license_url" in entries.columns:
        tests.append(problem((F.coalesce("license_url", F.lit("")) != "") & ~_is_http(F.col("license_url")), "license_url is not http(s)", shown("license_url")))
    if "shard" in entries.columns:
        want = shard(ident)
        tests.append(problem(F.col("shard") != want, "wrong shard", F.concat(F.col("shard"), F.lit(" for "), want)))
    rows = entries.select(F.explode(F.array_compact(F.array(*tests))).alias("p")).select("p.*")
    twice = entries.groupBy(ident.alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    return rows.unionByName(twice.select(F.lit("duplicate id").alias("check"), "id", F.col("n").cast("string").alias("detail")))


def lint_manifest(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """check, id, detail of manifest rows against the registry; of entries alike in id the last counts."""
    names = ["url", "source", "license", "topic", "format"]
    if "pos" in entries.columns:
        entries = index_documents(entries, "pos")
    side = entries.select("id", F.lit(True).alias("_in"), *[F.col(n).alias(f"_{n}") for n in names])
    rows = manifest.join(side, "id", "left")
    known = F.col("_in").isNotNull()
    problem = lambda when, check, detail: F.when(when, F.struct(F.lit(check).alias("check"), F.col("id"), detail.alias("detail")))
    tests = [problem(F.col("license").isin(POINTER_ONLY), "pointer-only payload", F.col("license")), problem(~known, "orphan", F.lit(""))]
    tests += [problem(known & ~F.col(n).eqNullSafe(F.col(f"_{n}")), "drift", F.lit(n)) for n in names]
    hashes = [h for h in ("sha256", "text_sha256", "corpus_sha256") if h in manifest.columns]
    tests += [problem(known & (F.coalesce(F.col(h), F.lit("")) != "") & ~F.col(h).rlike(r"\A[0-9a-f]{64}\z"), "invalid hash", F.lit(h)) for h in hashes]
    return rows.select(F.explode(F.array_compact(F.array(*tests))).alias("p")).select("p.*")


def lint_summary(problems: DataFrame, most: int = 50) -> tuple[int, list[str]]:
    """Number of problems and the first lines of a report, in order."""
    total = problems.count()
    head = problems.orderBy("check", "id", "detail").limit(most).collect()
    lines = [f"{r['check']}: {r['id']}: {r['detail']}" for r in head]
    return total, lines + ([f"... and {total - most} more"] if total > most else [])


def validate_backends(backends: DataFrame, rotation: DataFrame, scripts: DataFrame) -> DataFrame:
    """name, problem of finder settings (name, script, rotation), pointers (name) and scripts (script)."""
    own = backends.where("not startswith(name, '_')").withColumn("_b", F.lit(True))
    pointers = rotation.where("not startswith(name, '_')").select("name", F.lit(True).alias("_r"))
    there = scripts.select("script", F.lit(True).alias("_s")).distinct()
    rows = own.join(pointers, "name", "full_outer").join(there, "script", "left")
    turns = F.coalesce("rotation", F.lit(True))
    tests = F.array_compact(F.array(
        F.when(F.col("_b") & F.col("_s").isNull(), "missing script"),
        F.when(F.col("_b") & turns & F.col("_r").isNull(), "missing rotation entry"),
        F.when(F.col("_b") & ~turns & F.col("_r"), "rotation entry exists but is switched off"),
        F.when(F.col("_b").isNull(), "rotation entry has no backend"),
    ))
    return rows.select("name", F.explode(tests).alias("problem"))
