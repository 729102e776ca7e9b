"""The index, the sinks, extraction by format, contracts, the growth loop, and the facade over all."""

import json

import pytest
from pyspark.sql import functions as F

from loamline import control
from loamline.corpus import Corpus
from loamline.operators import fetch, merge, report
from loamline.plans.derived import manifest as derived
from loamline.session import shared_folder
from loamline.sources import files
from loamline.sources.index import CorpusIndex

FOLDER = "/root/testdata/sf0.001"


def manifest_line(**fields):
    return json.dumps({"title": "T", "url": "https://a.org", "topic": "urban", "status": "ok", **fields}) + "\n"


def test_manifest_refuses_broken_lines(spark, tmp_path):
    good = manifest_line(id="oer-1") + "\n  \n" + manifest_line(id="oer-2")
    for n, (bad, said) in enumerate([("", None), ('{"id": "oer-3", "ti', "MALFORMED"), (manifest_line(id="oer-3", bytes="many"), "MALFORMED"), (manifest_line(title="no id"), "without id")]):
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "books.jsonl").write_text(good + bad)
        rows = files.read_manifest(spark, str(folder))
        if said is None:
            assert sorted(r["id"] for r in rows.collect()) == ["oer-1", "oer-2"]
        else:
            with pytest.raises(Exception, match=said):
                rows.collect()


def test_manifest_sink_touches_changed_shards_only(spark, tmp_path):
    folder = str(tmp_path / "man")
    rows = lambda *some: spark.createDataFrame(some, "id string, topic string, status string")
    stamp = lambda: {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "man").glob("shard=*/part-*")}
    first = [("oer-1", "b", "ok"), ("oer-2", "a", "ok"), ("gh-1", "a", "ok"), ("hand", "u", "ok")]
    assert {r["shard"]: r["change"] for r in files.write_manifest(rows(*first), folder).collect()} == {"books.jsonl": "new", "github.jsonl": "new", "curated.jsonl": "new"}
    lines = next((tmp_path / "man" / "shard=books").glob("part-*")).read_text().splitlines()
    assert [json.loads(x)["id"] for x in lines] == ["oer-2", "oer-1"]  # by topic, then id
    before = stamp()
    assert files.write_manifest(rows(*first[::-1]), folder).count() == 0 and stamp() == before
    changes = files.write_manifest(files.read_manifest(spark, folder).where("id <> 'hand'").withColumn("status", F.when(F.col("id") == "gh-1", "failed").otherwise(F.col("status"))), folder)
    assert {r["shard"]: r["change"] for r in changes.collect()} == {"github.jsonl": "changed", "curated.jsonl": "gone"}
    after = stamp()
    assert after["shard=books"] == before["shard=books"] and "shard=curated" not in after
    assert sorted((r["id"], r["status"]) for r in files.read_manifest(spark, folder).collect()) == [("gh-1", "failed"), ("oer-1", "ok"), ("oer-2", "ok")]


def test_index_follows_its_sources(spark, tmp_path):
    reg, man = tmp_path / "reg", tmp_path / "man"
    reg.mkdir(), man.mkdir()
    (reg / "curated.yaml").write_text("sources:\n- id: a\n  title: One  Title!\n  url: https://a.org/\n")
    (man / "books.jsonl").write_text(manifest_line(id="oer-1", title="Book", url="https://b.org"))
    (tmp_path / "block").write_text("https://c.org//\n")
    index = CorpusIndex(spark, str(tmp_path / "index"), str(reg), str(man), str(tmp_path / "block"))
    keys = lambda: {(r["kind"], r["value"]) for r in index.lookup().collect()}
    first = {("id", "a"), ("title", "one title"), ("url", "https://a.org"), ("id", "oer-1"), ("title", "book"), ("url", "https://b.org"), ("url", "https://c.org")}
    assert keys() == first and len(index._meta()["folders"]) == 1
    with pytest.raises(ValueError, match="blocklist"):
        index.lookup(include_blocklist=False)
    # an append is recorded without a rebuild
    prior = index.sources()
    added = spark.createDataFrame([("b", "New", "https://d.org/"), ("c", "Book", "https://a.org")], "id string, title string, url string")
    (reg / "books.yaml").write_text("sources:\n- id: b\n  title: New\n  url: https://d.org/\n- id: c\n  title: Book\n  url: https://a.org\n")
    assert index.record_appended(added, prior)
    want = first | {("id", "b"), ("title", "new"), ("url", "https://d.org"), ("id", "c")}
    assert keys() == want and len(index._meta()["folders"]) == 2 and index.keys().count() == len(want)
    # a change behind the index's back makes an append stale, and the next lookup rebuilds
    (tmp_path / "block").write_text("https://e.org\n")
    assert not index.record_appended(added, "something else")
    assert keys() == (want - {("url", "https://c.org")}) | {("url", "https://e.org")} and len(index._meta()["folders"]) == 1


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("oer-1", "one é"), ("hand", "two"), ("oer-2", None)], "id string, text string")
    files.write_texts(rows, str(tmp_path / "t"))
    files.write_texts(spark.createDataFrame([("hand", "three")], "id string, text string"), str(tmp_path / "t"))
    assert sorted((r["id"], r["text"], r["shard"]) for r in files.read_texts(spark, str(tmp_path / "t")).collect()) == [("hand", "three", "curated"), ("oer-1", "one é", "books")]
    done = files.export_texts(rows, str(tmp_path / "files"))
    assert sorted((r["id"], r["bytes"]) for r in done.collect()) == [("hand", 3), ("oer-1", 6), ("oer-2", 0)]
    assert (tmp_path / "files" / "oer-1.md").read_text() == "one é" and len(list((tmp_path / "files").iterdir())) == 3
    with pytest.raises(Exception, match="no file name"):
        files.export_texts(spark.createDataFrame([("../x", "t")], "id string, text string"), str(tmp_path / "files"))


def test_extraction_by_format_and_again(spark):
    page = b"<html><body><p>A <b>page</b></p></body></html>"
    long = "a text that was read from a document and has spaces " * 30
    some = [("a", "html", page, "", ""), ("b", "txt", b" plain \xff text ", "", ""), ("c", "md", b"# mark", "", ""), ("d", "pdf", b"%PDF-", "gluedwordsonly" * 50, long), ("e", "zip", b"PK", "", ""), ("f", None, None, "", ""), ("g", "HTML", page, "", "")]
    raw = spark.createDataFrame(some, "id string, format string, payload binary, p1 string, p2 string")
    got = {r["id"]: r["text"] for r in fetch.by_format(raw, ("p1", "p2")).collect()}
    assert got == {"a": "A\npage", "b": "plain  text", "c": "# mark", "d": long, "e": "", "f": "", "g": "A\npage"}
    assert {r["id"]: r["text"] for r in fetch.by_format(raw.drop("p1", "p2")).collect()}["d"] == ""
    rows = spark.createDataFrame([(i, f"T {i}", f"https://{i}.org", "open", "urban", f, "failed" if i == "c" else "ok", None) for i, f, *_ in some], "id string, title string, url string, license string, topic string, format string, status string, text_sha256 string")
    out = fetch.extracted_again(rows, raw.drop("format"), ("p1", "p2")).collect()
    assert [r["id"] for r in out] == ["a", "b", "d", "g"] and all(r["changed"] for r in out)
    assert out[0]["rendered"].endswith("---\n\nA\npage") and out[0]["text_chars"] == 6 and out[0]["rendered"] != out[3]["rendered"]
    known = rows.drop("text_sha256").join(spark.createDataFrame([(r["id"], r["text_sha256"]) for r in out], "id string, text_sha256 string"), "id", "left")
    assert not any(r["changed"] for r in fetch.extracted_again(known, raw.drop("format"), ("p1", "p2")).collect())


def test_contracts(spark):
    rows = spark.createDataFrame([("ok", 1_500_000, "urban"), ("ok", 900_000, "materials"), ("failed", 5, "x")], "status string, text_chars long, topic string")
    readme = "| **Documents** | **2** |\n~2M chars\n| **Topics** | 2 |"
    assert report.contracts(rows, readme, report.STEPS) == []
    ledger = spark.createDataFrame([('{"id":"a","url":"u","reason":"r","pruned_at":"t"}',), (" ",), ('{"id":"b","url":"u","reason":"r"}',), ('{"id":',)], "value string")
    large = spark.createDataFrame([("/x/big.jsonl", 100 << 20)], "path string, length long")
    scripts = lambda *names: spark.createDataFrame([(n,) for n in names], "script string")
    errors = report.contracts(rows, "**Documents** | **1,234**", ["fetch"], ledger, large, scripts("a.py", "b.py"), scripts("a.py"))
    assert len(errors) == 8 and sum("ledger" in e for e in errors) == 2 and any("1,234" in e for e in errors) and any(e.startswith("b.py") for e in errors) and any("100.0 MiB" in e for e in errors)
    assert len(report.contracts(rows, "", [], ledger, most=2)) == 2 and report.shown_chars(2_345_678_901) == "2.346B"


def test_bounded_retries():
    slept, answers = [], iter([control.Transient("503"), TimeoutError(), "good"])

    def ask():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert control.retried(ask, sleep=slept.append) == "good" and slept == [2.0, 4.0]

    def fail(error):
        def run():
            raise error

        return run

    with pytest.raises(control.Transient):
        control.retried(fail(control.Transient("down")), sleep=slept.append)
    assert slept[2:] == [2.0, 4.0, 8.0]
    with pytest.raises(KeyError):
        control.retried(fail(KeyError("404")), sleep=slept.append)
    assert len(slept) == 5


def test_growth_loop(tmp_path):
    clock = [0.0]
    settings = {"seconds": 1000, "now": lambda: clock[0], "sleep": lambda s: clock.__setitem__(0, clock[0] + s), "free": lambda: 100 << 30}
    assert control.grow(lambda: None, **settings) == (12, 0, "time is up")
    clock[0], held = 0.0, [0]

    def gain():
        held[0] += 40

    assert control.grow(gain, **settings, target_tokens=100, tokens=lambda: held[0]) == (3, 0, "target reached")
    assert control.grow(gain, **settings, target_tokens=100, tokens=lambda: held[0]) == (0, 0, "target reached")
    stop = tmp_path / "STOP"
    assert control.grow(stop.touch, **settings, stop_file=stop) == (1, 0, "stop file") and not stop.exists()
    assert control.grow(gain, **{**settings, "free": lambda: 1}) == (0, 0, "low disk")
    assert control.grow(gain, **settings, window=lambda: False) == (0, 1, "no window")
    assert control.grow(gain, **settings, blocked=lambda: "disk") == (0, 0, "blocked: disk")
    clock[0], asked, freed = 0.0, iter([True, False, False]), []

    def broken():
        raise RuntimeError

    assert control.grow(broken, **{**settings, "seconds": 200}, maintenance_requested=lambda: next(asked), release=lambda: freed.append(1)) == (2, 2, "time is up") and len(freed) == 3


def test_large_families_are_not_gathered(spark):
    """Ids that differ by trailing numbers only are no group unless they collide."""
    rows = spark.createDataFrame([(f"ost-{i}", i) for i in range(3000)] + [("ost-7", 3000), ("ost-7-2", 3001), ("ost-7-2", 3002)], "id string, pos int")
    held = spark.createDataFrame([("ost-7-3",), ("gh-1",)], "id string")
    assert sorted(r["id"] for r in merge._colliding(rows.select("id"), held).collect()) == ["ost-7", "ost-7-2"]
    new = {r["pos"]: r["id"] for r in merge.unique_ids(rows, held, ["pos"]).collect()}
    assert new[7] == "ost-7" and (new[3000], new[3001], new[3002]) == ("ost-7-2", "ost-7-2-2", "ost-7-2-3") and len(set(new.values())) == 3003 and new[2999] == "ost-2999"


def test_merge_rounds_equal_the_pass_of_one_task(spark):
    rows = spark.createDataFrame([(i, f"u{i * 7 % 23}", f"t{i * 5 % 19}") for i in range(90)], "pos int, url string, title string")
    kept = [sorted(r["pos"] for r in merge.first_kept(rows, ["pos"], one_task=n).collect()) for n in (0, 10, 1000)]
    assert kept[0] == kept[1] == kept[2]


def test_duplicates_of_nothing_do_not_meet(spark):
    """Rows without title or bytes compete for nothing, so none goes as a duplicate."""
    good = "named_struct('chars', 5000L, 'alpha', 0.9D, 'words', 900L, 'cjk', 0L, 'en', 9L, 'domain', 99L)"
    rows = spark.createDataFrame([(f"ost-{i}", "" if i % 2 else None, f"https://a.org/{i}", "ok", None, "x") for i in range(40)] + [("ost-a", "Same", "u", "ok", "h", "x"), ("ost-b", "same!", "v", "ok", "h", "x"), ("gh-c", "c", "w", "ok", "h", "x"), ("hand", "d", "z", "ok", "h", "x")], "id string, title string, url string, status string, sha256 string, body string")
    rows = rows.selectExpr("*", "'osti' source", "'urban' topic", "'open' license", "'pdf' format", "200 http_status", "cast(null as string) error", f"named_struct('total', 5000L, 'w20', {good}, 'w100', {good}) quality")
    from loamline.operators import prune

    assert {r["id"]: r["reason"] for r in prune.reasons(rows).where("reason is not null").collect()} == {"ost-b": "dup-title", "ost-a": "dup-bytes", "gh-c": "dup-bytes"}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = derived(spark, FOLDER)
    entries = rows.where("pos % 10 <> 9").select("id", "title", "url", "source", "license", "topic", "format", "pos").withColumn("shard", F.lit("curated"))
    return Corpus(spark, rows, entries, spark.createDataFrame([("https://blocked.org/",)], "url string"))


def test_facade(spark, corpus):
    n = corpus.manifest.count()
    assert corpus.verdicts().count() == corpus.metrics().count() == corpus.clean().count() < n == corpus.prune().count()
    assert corpus.report().count() == 9 and corpus.coverage().count() == 13 and corpus.totals().count() == 1
    assert {"domain", "language"} <= {r["dimension"] for r in corpus.matrix().select("dimension").distinct().collect()} and corpus.matrix("lifecycle").columns == ["domain", "key", "docs", "gap"]
    assert corpus.lint().where("check = 'orphan'").count() == n - corpus.entries.count() and corpus.index().where("value = 'https://blocked.org'").count() == 1
    done = corpus.clean().select("id", F.col("cleaned_text").alias("text"))
    stated = corpus.manifest.join(corpus.clean().select("id", "corpus_chars", "corpus_sha256"), "id")
    assert Corpus(spark, stated, corpus.entries).check(done).count() == 0 and Corpus(spark, stated, corpus.entries).check(done.where("id <> 'ost-8'")).collect()[0]["problem"] == "missing"
    fresh = spark.createDataFrame([("ost-8", "Nothing like it", "https://n.org", "s", "open", "urban", "pdf", "b", 0, 1), ("x", "Y", "https://blocked.org", "s", "open", "urban", "pdf", "b", 0, 2)], "id string, title string, url string, source string, license string, topic string, format string, backend string, index int, pos int")
    assert [r["id"] for r in corpus.merge(fresh).collect()] == ["ost-8-2"]


def test_facade_in_sql(spark, corpus):
    views = corpus.register()
    assert all(spark.table(v).columns for v in views)
    assert spark.sql("SELECT clean_norm(' Ünder_score, TWO  words!'), clean_slug('A b/C'), url_key('https://a.org//'), corpus_tokens('123456789'), clean_norm(NULL)").first()[:] == ("ünder_score two words", "a-b-c", "https://a.org", 2, "")
    assert spark.sql("SELECT count(*) FROM corpus_reasons WHERE reason IS NULL").first()[0] == corpus.prune().where("reason is null").count()
    with pytest.raises(ValueError):
        corpus.register("x; drop")


def test_local_folder_is_removed_at_the_end(spark):
    import os

    assert os.path.isdir(shared_folder(spark)) and shared_folder(spark) == shared_folder(spark)
