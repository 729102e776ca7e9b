import random

import numpy as np
import pytest

from loamline.llm import pii
from loamline.llm.queries import QUERIES
from tests.llm.fixtures import awkward

CARD = "4111 1111 1111 1111"


@pytest.fixture(scope="module")
def tagger():
    return pii.trained()


def test_base_equals_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(15000):
        text = "".join(rng.choice("0123456789+-. ()@ab.c1 é_%") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == pii.brute_force(text), text


def test_base_cases():
    text = f"a.b+c@x-y.example.org, 10.0.0.255 and 10.0.0.256, {CARD}, 4111111111111112, +1 (743) 555-3824 +12"
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)] == [("email", "a.b+c@x-y.example.org"), ("ip", "10.0.0.255"), ("card", CARD), ("phone", "+1 (743) 555-3824")]
    assert pii.base_spans("9" * 200_000 + "@" + "x" * 100_000) == [] and pii.base_spans("1." * 3 + "0" * 5000 + "7") != []


def test_gradient():
    g = pii.Tagger(hidden=4, embedded=3)
    g.p = {k: v.astype(np.float64) for k, v in g.p.items()}
    rng = np.random.default_rng(0)
    g.p["T"] = rng.standard_normal((5, 5))
    codes, tags, mask = rng.integers(0, pii.SYMBOLS, (7, 3)), rng.integers(0, 5, (7, 3)), np.ones((7, 3))
    mask[5:, 1], tags[5:, 1], codes[5:, 1] = 0, 0, 0
    _, grads = g.step(codes, tags, mask)
    for name, value in g.p.items():
        at = (codes[2, 0], 1) if name == "E" else tuple(rng.integers(0, d) for d in value.shape)
        old, e = value[at], 1e-4
        value[at] = old + e
        high, _ = g.step(codes, tags, mask)
        value[at] = old - e
        low, _ = g.step(codes, tags, mask)
        value[at] = old
        assert (high - low) / 2 / e == pytest.approx(grads[name][at], rel=2e-2, abs=2e-4), name


def test_viterbi_is_the_best_path(tagger):
    import itertools

    text = "a@b.c"
    codes, mask = pii._pad([pii.encode(text)])
    scores = tagger.emissions(codes, mask)[:, 0]
    value = lambda path: scores[range(5), path].sum() + sum(tagger.p["T"][a, b] for a, b in itertools.pairwise(path))
    best = max((list(x) for x in itertools.product(range(5), repeat=5)), key=value)
    want = [(k - 1, i, j) for k, i, j in ((best[i], i, j) for i, j in itertools.combinations(range(6), 2)) if k and len({*best[i:j]}) == 1 and (i == 0 or best[i - 1] != k) and (j == 5 or best[j] != k)]
    assert [(k, a, b) for k, a, b, _ in tagger.decode([text])[0]] == want


def test_held_out_lines(tagger):
    lines = pii.labelled_lines(300, seed=99)
    found = pii.find([t for t, _ in lines], tagger)
    gold = [s for _, spans in lines for s in spans]
    hits = sum(s in both for (_, spans), (_, both) in zip(lines, found, strict=True) for s in spans)
    false = sum(s not in spans for (_, spans), (base, both) in zip(lines, found, strict=True) for s in both)
    assert hits / len(gold) > 0.85 and hits / (hits + false) > 0.95
    assert hits > sum(s in base for (_, spans), (base, _) in zip(lines, found, strict=True) for s in spans)
    assert all(set(base) <= set(both) for base, both in found)


#: Spellings that the rules accept, of every rule and every alternative in it.
SPELLED = [
    *(f"john.smith{at}host{dot}example{dot}org" for at in (" @ ", "@", "[@]", "(at)", " (at) ", " (at)", "(at) ") for dot in (".", " . ")),
    *(mark.join(["10", "0", "200", "7"]) for mark in (".", " . ", "[.]")),
    *(mark.join(["4111", "1111", "1111", "1111"]) for mark in ("", " ", "-", ".", "  ", ". ")),
    *("+1 (743) 555-3824", "(743) 555-3824", "0049 743 555 3824", "743-555-3824", "743.555.3824", "+49  743 555 3824"),
]


def test_passing_over_windows_changes_nothing(tagger):
    for spelled in SPELLED:
        assert any(pii._holds(k, spelled) for k in range(4)) and pii._TRIGGER.search(spelled), spelled
    plain = "please write to {} for all the rest of it and then some more words"
    texts = [t for t, _ in pii.labelled_lines(150, seed=7)] + ["words only " * 50, ""]
    texts += [("some words " * n) + plain.format(s) + " and more words" * 20 for s in SPELLED for n in (0, 4, 7, 9)]
    assert pii.find(texts, tagger) == pii.find(texts, tagger, every=True)
    assert pii.find(["please write to john.smith(at)example.org for the rest of it"], tagger) == [([], [(0, 16, 41)])]


def test_a_long_span_does_not_hang_on_its_offset(tagger):
    long = "verylongname" * 6 + " @ " + "host." * 9 + "example.org"
    lead = "the rest of the words that come before it and after it are words only "
    for offset in range(0, 100, 7):
        text = (lead * 3)[:offset] + " " + long + " and so on " * 30
        assert pii.find([text], tagger)[0][1] == [(0, offset + 1, offset + 1 + len(long))], offset
    pii.find(["1 2 3 4 5 6 7 8 9 0 " * 2000 + "x@" * 3000], tagger)


def test_reconciliation_is_the_best_set():
    import itertools

    rng = random.Random(1)
    for _ in range(200):
        spans = [(rng.randint(0, 3), a, a + rng.randint(1, 6), rng.random() * 5) for a in (rng.randint(0, 15) for _ in range(6))]
        apart = lambda some: all(x[2] <= y[1] or y[2] <= x[1] for x, y in itertools.combinations(some, 2))
        best = max(sum(s[3] for s in some) for n in range(7) for some in itertools.combinations(spans, n) if apart(some))
        got = pii.reconcile(spans)
        margin = {s[:3]: max(x[3] for x in spans if x[:3] == s[:3]) for s in spans}
        assert sum(margin[s] for s in got) == pytest.approx(best)


def test_awkward_rows_and_mask(spark):
    documents = awkward(spark, [(1, f"mail a@b.org and {CARD}."), (2, None), (3, ""), (None, "10.0.0.1"), (1, "clean")])
    masked = pii.mask(documents)
    assert masked.columns == documents.columns
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in masked.collect()]
    assert got == [(1, "mail [EMAIL] and [CARD].", 24), (2, None, None), (3, "", 0), (None, "[IP]", 4), (1, "clean", 5)]
    texts = [f"{i} and a{i} @ b.org" for i in range(40)]
    found = {r["doc_id"]: [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]] for r in pii.scan(awkward(spark, list(enumerate(texts)))).collect()}
    assert found == {i: spans for i, (_, spans) in enumerate(pii.find(texts, pii.trained()))}
    assert pii.scan(awkward(spark)).count() == 10 and pii.scan(awkward(spark, [])).count() == 0 and pii.mask(awkward(spark, [])).count() == 0


def test_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())
    for r in QUERIES["op3_pii"](spark, folder).collect():
        base = pii.brute_force(texts[r["doc_id"]])
        assert r["base_sha256"] == pii.sha(pii.digest(base))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert set(filter(None, pii.digest(base).split(","))) <= set(r["spans"].split(","))
