import numpy as np
import pytest

from loamline.llm import topk as t
from loamline.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare, connect


def rows(seed=0, n=900, size=16):
    rng = np.random.default_rng(seed)
    out = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((n, size)) / 4)]
    out[50:150] = [(i, out[7][1]) for i, _ in out[50:150]]  # ties
    return out


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("block_bytes", [t.BLOCK_BYTES, 600])
def test_equals_brute_force(spark, block_bytes):
    df = spark.createDataFrame(rows(), "vec_id long, embedding array<float>").repartition(5)
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in rows()]
    assert got(t.top_k(df, block_bytes=block_bytes)) == t.brute_force(single)


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    compare(connect(folder), QUERIES["op10_topk"](spark, folder), ORACLE_SQL["op10_topk"])


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    some = [(0, [1.0, 2.0]), (0, [0.5, 9.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0]), (100, [2.0]), (200, []), (7, []), (-100, [0.0, -1.0]), (8, [1e18, 1e18]), (300, [1e18, 0.0]), (9, [1e306, 1.0]), (10, [-1e306, 3.0]), (400, [2.0, 1e306])]
    df = spark.createDataFrame([(i, v, 1.0, 2, "x") for i, v in some], "vec_id long, embedding array<double>, score double, rank int, vector string")
    assert got(t.top_k(df)) == t.brute_force(some)


def test_very_long_vectors(spark):
    rng = np.random.default_rng(4)
    some = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((130, 5000)))]
    assert got(t.top_k(spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(3))) == t.brute_force(some)


def test_pairs_held_together_are_bounded(monkeypatch):
    seen = []
    monkeypatch.setattr(t, "upper_bounds", lambda x, q, level: seen.append((len(x.norm), len(q.norm))) or np.full((len(x.norm), len(q.norm)), np.inf))
    monkeypatch.setattr(t, "MOST_PAIRS", 1000)
    x, q = np.ones((300, 4)), np.ones((90, 4))
    t.scan(t.Best(90, 10), np.arange(300), x, np.arange(90), q, t.Statistics(q))
    assert max(a * b for a, b in seen) <= 1000 and sum(a for a, _ in seen) >= 300


def test_blocks_are_fetched_one_after_the_other(spark, monkeypatch):
    """Each block's rows are written out before the next block is fetched."""
    order = []
    of_block, cut = t._of_block, t.checkpoint
    monkeypatch.setattr(t, "_of_block", lambda *a: order.append("block") or of_block(*a))
    monkeypatch.setattr(t, "checkpoint", lambda df: order.append("written") or cut(df))
    t.top_k(spark.createDataFrame(rows(), "vec_id long, embedding array<float>"), block_bytes=600)
    assert len(order) >= 4 and order == ["block", "written"] * (len(order) // 2)


def test_empty_table(spark):
    assert t.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-900, 900, (200, 64)).astype(float), rng.integers(-900, 900, (50, 64)).astype(float)
    exact, a, b = x @ q.T, t.Statistics(x), t.Statistics(q)
    bounds = [t.upper_bounds(a, b, level) for level in range(len(a.levels))]
    assert all((bound >= exact).all() for bound in bounds)
    assert all((fine <= coarse + 2).all() for coarse, fine in zip(bounds, bounds[1:], strict=False))
