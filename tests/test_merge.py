import random

import pytest

from loamline.functions.text import norm, url_key
from loamline.operators import merge, registry
from pyspark.sql import functions as F


def test_greedy_merge_equals_a_pass(spark):
    rng = random.Random(2)
    rows = [(i, f"u{rng.randint(0, 40)}", f"t{rng.randint(0, 40)}") for i in range(120)]
    urls, titles, want = set(), set(), []
    for i, u, t in rows:
        if u not in urls and t not in titles:
            urls.add(u)
            titles.add(t)
            want.append(i)
    df = spark.createDataFrame(rows, "pos int, url string, title string")
    assert sorted(r["pos"] for r in merge.first_kept(df, ["pos"]).collect()) == want


def test_a_rejected_row_blocks_nobody(spark):
    df = spark.createDataFrame([(1, "u1", "t1"), (2, "u1", "t2"), (3, "u2", "t2")], "pos int, url string, title string")
    assert sorted(r["pos"] for r in merge.first_kept(df, ["pos"]).collect()) == [1, 3]


def test_unique_ids_equal_a_pass(spark):
    rng = random.Random(3)
    pool = ["x", "x-2", "x-3", "y", "y-2-2", "y-2", "z" * 55, "z" * 50 + "-2", "a-1-2", "a-1"]
    rows = [(i, rng.choice(pool)) for i in range(80)]
    reserved = {"x", "y-2", "a-1-2"}
    taken, want = set(reserved), {}
    for i, base in rows:
        ident, k = base, 2
        while ident in taken:
            ident, k = f"{base[:50]}-{k}", k + 1
        taken.add(ident)
        want[i] = ident
    df = spark.createDataFrame(rows, "pos int, id string")
    got = merge.unique_ids(df, spark.createDataFrame([(r,) for r in reserved], "id string"), ["pos"])
    assert {r["pos"]: r["id"] for r in got.collect()} == want


def test_proposals_need_their_fields(spark):
    row = spark.createDataFrame([("a", "", "u", "s", "open", "urban", "pdf", "b", 0, 1)], "id string, title string, url string, source string, license string, topic string, format string, backend string, index int, pos int")
    known = spark.createDataFrame([], "kind string, value string")
    with pytest.raises(ValueError):
        merge.merge_proposals(row, known, spark.createDataFrame([], "id string"))


def test_keys(spark):
    row = spark.createDataFrame([("https://a.example.org/x///", "  Über  Beton-Bau_2² ")], "u string, t string").select(url_key(F.col("u")), norm(F.col("t"))).first()
    assert tuple(row) == ("https://a.example.org/x", "über beton bau_2²")


def test_routing(spark):
    rows = [("oer-a", "books"), ("pat-us123", None), ("pat-ep1", "patents-ep"), ("pat-9", "patents"), ("ope-1", "papers"), ("oa-1", "papers"), ("hand", "curated")]
    df = spark.createDataFrame([(a,) for a, _ in rows], "id string").select("id", registry.shard(F.col("id")).alias("s"))
    got = {r["id"]: r["s"] for r in df.collect()}
    assert all(got[a] == b for a, b in rows if b)
    assert got["pat-us123"].startswith("patents-us-") and int(got["pat-us123"].rsplit("-", 1)[1]) < 8
