"""Lookups with hops: titles through normalisation and redirects, and reachability over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import checkpoint


def final_titles(requested: DataFrame, normalized: DataFrame, redirects: DataFrame) -> DataFrame:
    """raw, final: each requested title after at most one normalisation and one redirect.

    requested: raw. normalized and redirects: from, to.
    """
    first = normalized.select(F.col("from").alias("raw"), F.col("to").alias("step"))
    rows = requested.join(first, "raw", "left").withColumn("step", F.coalesce("step", "raw"))
    second = redirects.select(F.col("from").alias("step"), F.col("to").alias("target"))
    return rows.join(second, "step", "left").select("raw", F.coalesce("target", "step").alias("final"))


def reached(seeds: DataFrame, links: DataFrame, depth: int, budget: int | None = None) -> DataFrame:
    """page, hops: pages within a number of hops of the seeds, each at its fewest; nearest first.

    seeds: page. links: page, target. A budget keeps that many pages, by hops and then name.
    """
    seen = checkpoint(seeds.select("page", F.lit(0).alias("hops")).distinct())
    frontier = seen
    for hop in range(1, depth + 1):
        fresh = frontier.join(links, "page").select(F.col("target").alias("page")).distinct()
        frontier = checkpoint(fresh.join(seen, "page", "left_anti").withColumn("hops", F.lit(hop)))
        if not frontier.limit(1).count():
            break
        seen = checkpoint(seen.unionByName(frontier))
    return seen if budget is None else seen.orderBy("hops", "page").limit(budget)
