import random

from loamline.llm import license_scan as l
from loamline.llm.queries import QUERIES
from tests.llm.fixtures import awkward, prose


def texts():
    rng = random.Random(2)
    out = []
    for license_id, name, notice in l.TEMPLATES:
        words = notice.split()
        for k in range(0, len(words) // 12 + 1):  # some words replaced or lost
            changed = [w for i, w in enumerate(words) if i != k * 7 % max(1, len(words))] if k else words
            out.append(f"{prose(k, 12)}. {' '.join(changed)}\n{prose(k + 50, 9)}")
    out += ["Licensed under CC BY-SA 4.0. Then licensed under CC BY 4.0!", "released under the mit", prose(4, 60), "", "Licensed under the Apache License, Version 2.0. " * 3]
    rng.shuffle(out)
    return out


def test_equals_aligning_everywhere():
    index = l.Index(l.TEMPLATES)
    for text in texts():
        assert index.matches(text) == l.brute_force(text), text


def test_short_notices_with_words_put_in_or_replaced():
    short = [t for t in l.TEMPLATES if len(l.words_of(t[2])[0]) <= l.SHORT]
    index = l.Index(short)
    assert [(m[0], m[4]) for m in l.Index(l.TEMPLATES).matches("Licensed under the terms of the MIT License")] == [("MIT", 1.0)]
    for _, _, notice in short:
        words = notice.split()
        for k in range(len(words) + 1):
            for changed in ([*words[:k], "hereby", *words[k:]], [*words[:k], "the", "terms", "of", *words[k:]], [*words[:k], "other", *words[k + 1 :]]):
                text = f"{prose(k, 5)} {' '.join(changed)} {prose(k + 50, 4)}"
                assert index.matches(text) == l.brute_force(text, templates=short), text


def test_spans_and_coverage():
    index = l.Index(l.TEMPLATES)
    text = "Intro. Licensed under CC BY-NC 4.0. Released, under THE mit-License."
    assert [(m[0], text[m[5] : m[6]], m[4]) for m in index.matches(text)] == [("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", 1.0), ("MIT", "Released, under THE mit-License", 1.0)]
    whole = next(t for i, n, t in l.TEMPLATES if n == "permission notice" and i == "MIT")
    found = index.matches(whole.replace("merge", "fuse").replace("sublicense, ", ""))
    assert [m[0] for m in found] == ["MIT"] and 0.95 < found[0][4] < 1.0


def test_winnowing_keeps_one_gram_of_every_window():
    words = prose(6, 80).split()
    kept = {i for i, _ in l.winnow(words)}
    assert all(kept & set(range(a, a + l.WINNOW)) for a in range(len(words) - l.GRAM + 1 - l.WINNOW + 1))


def test_awkward_rows(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "😀 Released under the MIT License."), (2, None), (3, "")]
    got = sorted((r["doc_id"] or -1, r["license"], r["start"], r["end"]) for r in l.scan(awkward(spark, rows)).collect())
    assert got == [(-1, "MIT", 2, 32), (1, "MIT", 0, 30), (1, "MIT", 0, 30)]
    assert l.scan(awkward(spark)).count() == 0 and l.scan(awkward(spark, [])).count() == 0


def test_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    want = [(i, *m) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall() for m in l.Index(l.TEMPLATES).matches(t)]
    assert sorted(map(tuple, QUERIES["op1_license_scan"](spark, folder).collect())) == sorted(want)
