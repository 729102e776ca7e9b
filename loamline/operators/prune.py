"""Pruning a manifest: why a row goes, which address is never tried again, what is kept.

A manifest row has at least: id, title, url, source, topic, license, format, status, http_status,
error, sha256, body (null: no text). Hand-curated rows are never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import blocklist_key, norm
from loamline.operators.quality import is_booklike, metrics, off_domain_title, verdict, whole
from loamline.operators.registry import discovered, shard_file
from loamline.session import checkpoint

# Answers after which an address may be tried again.
TRANSIENT_STATUS = [202, 429, 503]
TRANSIENT_ERRORS = ["timeout", "timed out", "connection", "too many requests"]


def measured(manifest: DataFrame) -> DataFrame:
    """The manifest with verdict, from its quality metrics or, where there are none, from the body."""
    if "quality" not in manifest.columns:
        manifest = manifest.withColumn("quality", metrics(F.col("body")))
    return manifest.withColumn("verdict", F.when(F.col("body").isNotNull(), verdict(whole(F.col("quality")), is_booklike(F.col("id"), F.coalesce("format", F.lit("pdf"))))))


def reviewed(ids: DataFrame, manifest: DataFrame) -> DataFrame:
    """Reviewed ids, checked: at least one, each known and machine-discovered; else an error."""
    ids = ids.select(F.col("id")).distinct()
    joined = ids.join(manifest.select("id", F.lit(True).alias("known")), "id", "left")
    bad = joined.where(F.col("known").isNull() | ~discovered(F.col("id"))).orderBy("id").limit(5).collect()
    if bad:
        raise ValueError("reviewed ids that are unknown or hand-curated: " + ", ".join(r["id"] for r in bad))
    if not ids.limit(1).count():
        raise ValueError("the reviewed list is empty")
    return ids


def reasons(manifest: DataFrame, reviewed_ids: DataFrame | None = None) -> DataFrame:
    """The manifest, without its texts, with reason: null for rows that stay, else why the row goes; first reason wins.

    Titles are claimed in manifest order (shard file, topic, id) by rows that pass everything else;
    equal bytes keep the first row, curated before discovered, then by id. Firsts are minima by key,
    combined before they meet; rows that compete for nothing are not gathered. Ids are unique.
    """
    rows = measured(manifest)
    found = discovered(F.col("id"))
    if reviewed_ids is not None:
        rows = rows.join(F.broadcast(reviewed_ids.select("id", F.lit(True).alias("reviewed"))), "id", "left")
    else:
        rows = rows.withColumn("reviewed", F.lit(None).cast("boolean"))
    own = (
        F.when(~found, None)
        .when(F.col("reviewed"), "off-topic-title")
        .when(F.col("status") != "ok", "failed")
        .when(F.col("id").startswith("pat-") & off_domain_title(F.col("title")), "off-topic-title")
        .when(F.col("body").isNull(), "no-text")
        .when(F.col("verdict") != "ok", F.col("verdict"))
    )
    names = [c for c in rows.columns if c not in ("body", "reviewed")]
    # texts are measured once; what follows carries no text
    rows = checkpoint(rows.select(*names, own.alias("own"), found.alias("found"), norm(F.col("title")).alias("title_key")))
    claims = F.col("found") & F.col("own").isNull() & (F.col("title_key") != "")
    seeds = F.coalesce(F.col("title_key").isNotNull() & ~F.col("found") & (F.col("status") == "ok"), F.lit(False))
    turn = F.struct(shard_file(F.col("id")), F.coalesce("topic", F.lit("")), F.col("id"))
    firsts = rows.where(claims | seeds).groupBy(F.col("title_key").alias("_key")).agg(F.min(F.when(claims, turn)).alias("_first"), F.max(seeds).alias("_seeded"))
    rows = rows.withColumn("_key", _key_or_own(claims, "title_key")).join(firsts, "_key", "left")
    rows = rows.withColumn("dup_title", claims & (F.coalesce("_seeded", F.lit(False)) | (turn != F.col("_first")))).drop("_key", "_first", "_seeded")
    left = F.coalesce((F.col("status") == "ok") & F.col("sha256").isNotNull() & F.col("own").isNull() & ~F.col("dup_title"), F.lit(False))
    keeper = rows.where(left).groupBy(F.col("sha256").alias("_key")).agg(F.min(F.struct("found", "id")).alias("_first"))
    rows = rows.withColumn("_key", _key_or_own(left, "sha256")).join(keeper, "_key", "left")
    dup_bytes = left & F.col("found") & (F.struct("found", "id") != F.col("_first"))
    reason = F.coalesce("own", F.when(F.col("dup_title"), "dup-title"), F.when(dup_bytes, "dup-bytes"))
    return rows.select(*names, reason.alias("reason"))


def _key_or_own(has: Column, key: str) -> Column:
    """A row's join key, or for a row without one something of its own, so that such rows don't meet in one task."""
    return F.when(has, F.col(key)).otherwise(F.concat(F.lit("\u0000"), F.coalesce("id", F.lit(""))))


def same_bytes_kept(judged: DataFrame) -> DataFrame:
    """sha256, id, first_id of curated rows that share bytes with an earlier kept row."""
    left = judged.where("status = 'ok' and sha256 is not null and (reason is null or reason = 'dup-bytes')")
    order = Window.partitionBy("sha256").orderBy(discovered(F.col("id")), "id")
    ranked = left.withColumn("n", F.row_number().over(order)).withColumn("first_id", F.first("id").over(order))
    return ranked.where((F.col("n") > 1) & ~discovered(F.col("id"))).select("sha256", "id", "first_id")


def blocklistable(reason: Column, http_status: Column, error: Column) -> Column:
    """Whether a dropped row's address is never to be tried again."""
    said = F.lower(F.coalesce(error, F.lit("")))
    passing = said.contains(TRANSIENT_ERRORS[0])
    for phrase in TRANSIENT_ERRORS[1:]:
        passing = passing | said.contains(phrase)
    return F.when(reason != "failed", True).when(F.coalesce(http_status.isin(TRANSIENT_STATUS), F.lit(False)), False).when(said.contains("certificate") | said.contains("ssl"), True).otherwise(~passing)


def blocked_urls(judged: DataFrame) -> DataFrame:
    """url keys of dropped rows that the blocklist takes."""
    gone = judged.where(F.col("reason").isNotNull() & blocklistable(F.col("reason"), F.col("http_status"), F.col("error")))
    return gone.select(blocklist_key(F.col("url")).alias("url")).where("url <> ''").distinct()


def blocklist_add(blocklist: DataFrame, urls: DataFrame) -> DataFrame:
    """url keys that are new to the blocklist (both: column url)."""
    key = lambda df: df.select(blocklist_key(F.col("url")).alias("url")).where("url <> ''").distinct()
    return key(urls).join(key(blocklist), "url", "left_anti")


def ledger(judged: DataFrame, pruned_at: str, run_id: str | None = None) -> DataFrame:
    """One row for each dropped document, in the ledger's columns."""
    gone = judged.where("reason is not null")
    blocked = blocked_urls(judged).withColumn("blocklisted", F.lit(True))
    out = gone.withColumn("key", blocklist_key(F.col("url"))).join(blocked.withColumnRenamed("url", "key"), "key", "left")
    return out.select("id", "url", "title", "reason", "source", "topic", "license", "http_status", "error", "sha256", "quality", F.coalesce("blocklisted", F.lit(False)).alias("blocklisted"), F.lit(pruned_at).alias("pruned_at"), F.lit(run_id).alias("run_id"))


def kept(manifest: DataFrame, judged: DataFrame) -> DataFrame:
    """The manifest without dropped ids."""
    return manifest.join(judged.where("reason is not null").select("id"), "id", "left_anti")


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
