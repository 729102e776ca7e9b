import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loamline.llm import simhash as s
from tests.llm.fixtures import awkward, prose


def near(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def corpus():
    base = [prose(i, 400) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 3]) for i in range(12)]
    rows += [(200 + i, near(base[i % 5], i, 1)) for i in range(40)]
    return rows + [(300, ""), (301, " \n"), (302, None), (303, "One"), (304, "one"), (305, "one two"), (306, "one two three"), (307, "TWO words")]


def test_fingerprint_by_the_definition():
    for text in ("", "One", "a b", "a b c", prose(3, 900), "Ünï CODE words here \x0b and there"):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert s.fingerprint(text.encode()) & (2**64 - 1) == want


def test_hash_is_sparks(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("tile_rows", [1 << 16, 7])
def test_components_equal_brute_force(spark, tile_rows):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in s.report(s.near_duplicates(df, tile_rows=tile_rows)).collect()}
    want = s.brute_force(corpus())
    assert got == want
    assert any(c != i for i, (_, c) in want.items() if 200 <= i < 300)


@pytest.mark.parametrize("split", [0, 500, 999])
def test_links_within_a_task(split):
    rng = np.random.default_rng(split)
    fps = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    fps[100:600] = fps[7] ^ (np.uint64(1) << rng.integers(0, 62, 500).astype(np.uint64))
    fps[600:700] = fps[300:400] ^ np.uint64(0b101 << 20)
    label = s.link_rows(fps, split)
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    if split:
        close[:split, :split] = close[split:, split:] = False
    np.fill_diagonal(close, True)
    want = np.arange(1000)
    while True:
        new = np.array([want[row].min() for row in close])
        if (new == want).all():
            break
        want = new
    assert len(set(zip(label.tolist(), want.tolist(), strict=True))) == len(set(want.tolist())) == len(set(label.tolist()))


def test_tiles_cover_all_close_pairs():
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(300)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps]
    cell = lambda f: tuple((f & m & (2**64 - 1)).bit_count() for m in s.CELL_MASKS)
    counts = {}
    for f in fps:
        counts[cell(f)] = counts.get(cell(f), 0) + 1
    where, pairs = s.plan_tiles(list(counts.items()), 20)
    tile = {c: set(range(first, first + parts)) for c, first, parts in where}
    both = {frozenset(p) for p in pairs}
    for a, b in zip(fps[:300], fps[300:], strict=True):
        assert all(frozenset((i, j)) in both for i in tile[cell(a)] for j in tile[cell(b)])


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in s.components(edges).collect()}
    assert {got[i] for i in range(201)} == {0} and got[501] == 500


@pytest.mark.parametrize("most", [s.BROADCAST_BYTES, 0])
def test_one_document_of_each_group_stays(spark, monkeypatch, most):
    monkeypatch.setattr(s, "BROADCAST_BYTES", most)
    rows = [*corpus(), (0, corpus()[0][1]), (400, prose(77, 300)), (400, prose(77, 300)), (400, prose(78, 300)), (None, prose(79, 300)), (None, prose(79, 300) + " "), (None, corpus()[1][1])]
    documents = awkward(spark, rows)
    kept = s.keep_one(documents)
    want = s.brute_force(corpus())
    assert kept.columns == documents.columns
    got = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect())
    assert got == sorted([-1, *{c for _, c in want.values()}, 400, 400])


def test_awkward_rows_and_empty_tables(spark):
    got = s.near_duplicates(awkward(spark)).collect()
    assert len(got) == 10 and {r["component_id"] for r in got if r["doc_id"] in (2, 3, 6)} == {2}
    assert s.near_duplicates(awkward(spark, [])).count() == 0 and s.keep_one(awkward(spark, [])).count() == 0
