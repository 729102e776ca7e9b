"""Corpus statistics for reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The order in which licenses are listed.
LICENSE_ORDER = ["open", "public-domain", "cc-by-sa", "cc-by", "cc0", "proprietary-internal"]


def totals(manifest: DataFrame) -> DataFrame:
    """One row: docs, text_chars, tokens, corpus_chars, corpus_tokens, topics of ok rows.

    Tokens are a quarter of the characters, rounded down after the sum. Without a corpus_chars column
    the text's characters stand in for it.
    """
    ok = manifest.where("status = 'ok'")
    cleaned = "corpus_chars" if "corpus_chars" in manifest.columns else "text_chars"
    sums = ok.agg(F.count("*").alias("docs"), F.coalesce(F.sum("text_chars"), F.lit(0)).cast("long").alias("text_chars"), F.coalesce(F.sum(cleaned), F.lit(0)).cast("long").alias("corpus_chars"), F.count_distinct("topic").alias("topics"))
    return sums.select("docs", "text_chars", F.expr("text_chars div 4").alias("tokens"), "corpus_chars", F.expr("corpus_chars div 4").alias("corpus_tokens"), "topics")


def by_topic(manifest: DataFrame) -> DataFrame:
    """topic, docs, place by count, ties by name."""
    counts = manifest.where("status = 'ok'").groupBy("topic").agg(F.count("*").alias("docs"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("docs"), "topic")))  # a dozen topics


def by_license(manifest: DataFrame) -> DataFrame:
    """license, docs, place in the fixed order, without licenses that do not occur."""
    place = F.array_position(F.array(*[F.lit(x) for x in LICENSE_ORDER]), F.col("license"))
    counts = manifest.where("status = 'ok'").groupBy("license").agg(F.count("*").alias("docs"))
    return counts.withColumn("place", place.cast("int")).where("place > 0")


def load_report(manifest: DataFrame) -> DataFrame:
    """metric, value: rows, ok, failed, and ok rows of each topic."""
    ok = F.col("status") == "ok"
    whole = manifest.agg(F.count("*").alias("rows"), F.count(F.when(ok, 1)).alias("ok"), F.count(F.when(~ok, 1)).alias("failed"))
    flat = whole.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("rows", "ok", "failed")])))
    topics = manifest.where(ok).groupBy("topic").agg(F.count("*").alias("value")).select(F.concat(F.lit("topic:"), "topic").alias("metric"), "value")
    return flat.unionByName(topics)


def duplicate_groups(rows: DataFrame, key: str, ident: str = "id") -> DataFrame:
    """key, n, id: the rows of keys that more than one row has, with how many those are.

    A group is as many rows, so a large one is no large row; counts are combined before they meet.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return rows.select(key, F.col(ident).alias("id")).join(counts, key).select(key, "n", "id")


def yield_counts(accepted: DataFrame, *by: str) -> DataFrame:
    """Accepted entries of a discovery run by any of topic, source, license, format."""
    return accepted.groupBy(*by).agg(F.count("*").alias("n"))


# The steps of a round, in order.
STEPS = ["fetch", "prune", "clean", "check", "stats", "index", "lint", "contracts"]


def shown_chars(chars: int) -> str:
    return f"{chars / 1e9:.3f}B" if chars >= 1e9 else f"{chars / 1e6:.0f}M"


def contracts(manifest: DataFrame, readme: str, steps: list[str], ledger: DataFrame | None = None, large: DataFrame | None = None, scripts: DataFrame | None = None, backends: DataFrame | None = None, most: int = 50) -> list[str]:
    """What the parts of a corpus say about each other that is not so, at most some lines.

    manifest: status, text_chars, topic. readme: its numbers. ledger: value, the ledger's lines. large:
    path, length of files above the cap. scripts: script of the finders there are; backends: script.
    """
    ok = manifest.where("status = 'ok'").agg(F.count("*"), F.coalesce(F.sum("text_chars"), F.lit(0)), F.count_distinct(F.coalesce("topic", F.lit("\u0000")))).first()
    errors = []
    shown = re.search(r"\*\*Documents\*\* \| \*\*([\d,]+)\*\*", readme)
    if not shown or int(shown[1].replace(",", "")) != ok[0]:
        errors.append(f"readme says {shown[1] if shown else 'nothing'} of documents, the manifest {ok[0]:,}")
    if f"~{shown_chars(ok[1])} chars" not in readme:
        errors.append(f"readme's number of characters is not {shown_chars(ok[1])}")
    if f"**Topics** | {ok[2]}" not in readme:
        errors.append(f"readme's number of topics is not {ok[2]}")
    if scripts is not None and backends is not None:
        missing = scripts.join(backends.select("script"), "script", "left_anti").orderBy("script").limit(most).collect()
        errors += [f"{r['script']}: a finder that no backend names" for r in missing]
    if steps != STEPS:
        errors.append(f"steps {steps}, expected {STEPS}")
    if large is not None:
        errors += [f"{r['path']} has {r['length'] / 2**20:.1f} MiB" for r in large.orderBy("path").limit(most).collect()]
    if ledger is not None:
        row = F.from_json("value", "id string, url string, reason string, pruned_at string, _broken string", {"columnNameOfCorruptRecord": "_broken"})
        whole = [F.coalesce(F.col(f"row.{k}"), F.lit("")) != "" for k in ("id", "url", "reason", "pruned_at")]
        bad = ledger.where(F.trim("value") != "").select("value", row.alias("row")).where(F.col("row._broken").isNotNull() | ~(whole[0] & whole[1] & whole[2] & whole[3]))
        errors += [f"a ledger line that is broken or lacks a field: {r['value'][:80]}" for r in bad.orderBy("value").limit(most).collect()]
    return errors[:most]
