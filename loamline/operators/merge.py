"""Merging proposals of several finders: first come, first kept, and ids made distinct."""

from __future__ import annotations

from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import norm, url_key
from loamline.operators.registry import REQUIRED, new_candidates
from loamline.session import checkpoint


def incomplete(proposals: DataFrame) -> DataFrame:
    """Proposals without one of the required fields."""
    lacking = F.lit(False)
    for name in REQUIRED:
        lacking = lacking | (F.coalesce(F.col(name), F.lit("")) == "")
    return proposals.where(lacking)


#: Undecided rows up to which one task finishes a pass; it holds their places and keys only.
ONE_TASK = 200_000


def first_kept(proposals: DataFrame, order: list[str], one_task: int = ONE_TASK) -> DataFrame:
    """What a pass in order keeps that skips rows whose url or title a kept row already has.

    A rejected row blocks nobody, so ranks by url and by title would drop too much. Each round keeps
    the undecided rows that come first for both their keys and drops those that share a key with a
    kept one; when few enough are undecided, one task goes through them in order. Rounds carry the
    order and the keys, not the rows. order must tell rows apart.
    """
    left = checkpoint(proposals.select(F.struct(*order).alias("place"), url_key(F.col("url")).alias("u"), norm(F.col("title")).alias("t")))
    kept = left.limit(0)
    while left.count() > one_task:
        by_url, by_title = (left.groupBy(k).agg(F.min("place").alias(f"first_{k}")) for k in ("u", "t"))
        taken = checkpoint(left.join(by_url, "u").join(by_title, "t").where((F.col("place") == F.col("first_u")) & (F.col("place") == F.col("first_t"))).select(left.columns))
        left = checkpoint(left.join(taken.select("u").distinct(), "u", "left_anti").join(taken.select("t").distinct(), "t", "left_anti").select(left.columns))
        kept = kept.unionByName(taken)

    def passed(batches):
        urls, titles = set(), set()
        for batch in batches:
            take = []
            for url, title in zip(batch.column("u").to_pylist(), batch.column("t").to_pylist(), strict=True):
                take.append(url not in urls and title not in titles)
                if take[-1]:
                    urls.add(url)
                    titles.add(title)
            yield batch.filter(pa.array(take, pa.bool_()))

    last = left.orderBy("place").coalesce(1).mapInArrow(passed, left.schema)
    places = checkpoint(kept.unionByName(last).select("place")).select(*[F.col(f"place.{c}").alias(f"_{c}") for c in order])
    same = [proposals[c].eqNullSafe(places[f"_{c}"]) for c in order]
    return proposals.join(places, reduce(lambda x, y: x & y, same), "left_semi")


FAMILY = "(-[0-9]*)+$"
_NUMBERED = "-[0-9]+$"


def _colliding(ids: DataFrame, reserved: DataFrame) -> DataFrame:
    """id: those that are taken already or twice among the rows, and those that a new name could run into.

    A taken id b becomes b's first 50 characters and a number; an id of that form may so be taken,
    too, and then leads on to others. Few ids do, whatever their number is.
    """
    once = ids.groupBy("id").agg(F.count("*").alias("n"))
    fresh = checkpoint(once.where("n > 1").select("id").union(once.select("id").join(reserved.select("id"), "id", "left_semi")).distinct())
    found = fresh
    while not fresh.isEmpty():
        stems = fresh.select(F.substring("id", 1, 50).alias("stem")).distinct()
        ahead = once.select("id").where(F.col("id").rlike(_NUMBERED)).withColumn("stem", F.regexp_replace("id", _NUMBERED, ""))
        fresh = checkpoint(ahead.join(stems, "stem", "left_semi").select("id").join(found, "id", "left_anti"))
        found = found.union(fresh)
    return found


def unique_ids(rows: DataFrame, reserved: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ids that neither reserved (column id) nor an earlier row has.

    A taken id becomes its first 50 characters and -2, -3, ... Only ids that collide, or that a new
    name could run into, are settled, by families: ids that can meet agree in their first 50 characters
    without trailing numbers.
    """
    family = F.regexp_replace(F.substring("id", 1, 50), FAMILY, "").alias("_family")
    names = rows.columns
    colliding = _colliding(rows.select("id"), reserved)
    theirs = rows.join(colliding, "id", "left_semi")
    own = theirs.select(family, F.struct(*order).alias("_at"), F.col("id").alias("_id"), F.struct(*names).alias("_row"))
    ranked = own.withColumn("_n", F.row_number().over(Window.partitionBy("_family").orderBy("_at")))
    held = reserved.select(family, F.lit(0).cast("long").alias("_n"), F.col("id").alias("_id")).distinct()
    ids = ranked.select("_family", F.col("_n").cast("long"), "_id").unionByName(held.join(colliding.select(family).distinct(), "_family", "left_semi").select("_family", "_n", "_id"))

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        taken = set(group.loc[group["_n"] == 0, "_id"])
        last: dict[str, int] = {}
        out = []
        for row in group[group["_n"] > 0].sort_values("_n").itertuples(index=False):
            ident, stem = row[2], row[2][:50]
            i = last.get(stem, 2)
            while ident in taken:
                ident, i = f"{stem}-{i}", i + 1
            if ident != row[2]:
                last[stem] = i
            taken.add(ident)
            out.append((row[0], row[1], ident))
        return pd.DataFrame(out, columns=["_family", "_n", "_new"])

    settled = ids.groupBy("_family").applyInPandas(settle, "_family string, _n long, _new string")
    joined = ranked.join(settled, ["_family", "_n"]).select(*[(F.col("_new") if n == "id" else F.col(f"_row.{n}")).alias(n) for n in names])
    return rows.join(colliding, "id", "left_anti").select(*names).unionByName(joined)


def merge_proposals(proposals: DataFrame, known: DataFrame, reserved: DataFrame) -> DataFrame:
    """The accepted proposals, ids made distinct. proposals: registry fields, backend, index, pos.

    Backends go by index, and proposals of a backend by pos. A proposal without a required field is
    an error.
    """
    bad = incomplete(proposals).select("backend", "id").limit(5).collect()
    if bad:
        raise ValueError("proposals lack required fields: " + ", ".join(f"{r['backend']}: {r['id']}" for r in bad))
    fresh = checkpoint(new_candidates(proposals, known))  # each step below reads it again
    return unique_ids(checkpoint(first_kept(fresh, ["index", "pos"])), reserved, ["index", "pos"])


def accepted_counts(accepted: DataFrame, backends: DataFrame) -> DataFrame:
    """backend, n: zero for a backend without any."""
    counts = accepted.groupBy("backend").agg(F.count("*").alias("n"))
    return backends.select("backend").distinct().join(counts, "backend", "left").select("backend", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def capped(candidates: DataFrame, most: int, order: list[str], by: list[str] | None = None) -> DataFrame:
    """The first rows in order, in all or of each group."""
    if not by:
        return candidates.orderBy(*order).limit(most)
    ranked = candidates.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("_n") <= most).drop("_n")


def sampled(rows: DataFrame, most: int, ident: str, by: list[str] | None = None) -> DataFrame:
    """A uniform subset of fixed seed, in all or of each group: the smallest hashes of the id."""
    return capped(rows.withColumn("_h", F.md5(F.concat(F.col(ident).cast("string"), F.lit("sample")))), most, ["_h", ident], by).drop("_h")
