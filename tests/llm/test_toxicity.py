import math
import random

import duckdb
import pytest
import zstandard

from loamline.llm import toxicity as t
from loamline.llm.queries import QUERIES
from tests.llm.fixtures import LONG, awkward, prose

BAD = ["idiot", "worthless", "pathetic", "disgusting"]


def rows(n=200, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(1000 * seed + i, rng.randint(20, 120)).split()
        if i % 3 == 0:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((" ".join(words).encode(), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def model():
    return t.train(rows())


def test_held_out_accuracy(model):
    scorer = t.Scorer(model)
    right = sum((scorer.score(x) >= t.THRESHOLD) == bool(y) for x, y in rows(150, seed=9))
    assert right >= 140


def test_more_toxic_text_costs_less_under_the_toxic_dictionary(model):
    scorer = t.Scorer(model)
    assert scorer.distances(b"you worthless disgusting idiot").max() >= 4 > scorer.distances(prose(4, 30).encode()).mean()
    assert scorer.score(b"") == scorer.score(b" \n") < t.THRESHOLD


def test_one_class_or_none(spark):
    assert t.Scorer(t.train([])).score(b"x") == 0.0
    assert t.Scorer(t.train([(b"a", 1)])).score(b"x") == 1.0
    assert 0 <= t.Scorer(t.train([(b"a", 1), (b"b", 0)])).score(b"x") <= 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = t.report(awkward(spark), none).collect()
    assert len(got) == 10 and {r["score"] for r in got} == {0.0} and not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_training_rows_are_the_allowed_ones(spark):
    import zlib

    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)] + [(3, 1), (None, 1), (4, None), (6, 7)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(9, "other text"), (10, "text 10"), (None, "n")], "doc_id long, text string")
    got = t.training_rows(docs, labels, id_col="doc_id", text_col="text", label_id_col="doc_id", label_col="toxic")
    allowed = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1} - {3, 6, 9}
    assert sorted(got) == sorted((f"text {i}".encode(), int(i % 5 == 0)) for i in allowed)


def test_filter_keeps_all_columns(spark, model, monkeypatch):
    monkeypatch.setattr(t, "fit", lambda *a, **k: model)
    documents = awkward(spark, [(1, "you worthless disgusting idiot, pathetic"), (2, None), (3, prose(5, 50)), (4, LONG)])
    kept = t.drop_toxic(documents, None)
    assert kept.columns == documents.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    assert t.drop_toxic(documents.limit(0), None).count() == 0


def by_hand(model, text):
    """The score, window by window, from the model's two dictionaries and numbers alone."""
    text = b" ".join(text.lower().split())
    sizes = zstandard.ZstdCompressionParameters.from_level(6, min_match=6, strategy=zstandard.STRATEGY_LAZY, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)

    def size(window, content):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=sizes).compress(window))

    saved, at = [], 0
    while text and (at == 0 or at + 14 < len(text)):
        window = model.ordinary[-24:] + text[at : at + 48]
        saved.append(size(window, model.ordinary) - size(window, model.toxic))
        at += 34
    pairs = [0] * 1021
    for a, b in zip(text, text[1:], strict=False):
        pairs[(a * 256 + b) % 1021] += 1
    near = max(range(len(model.centers)), key=lambda k: sum(c * math.sqrt(n) for c, n in zip(model.centers[k], pairs, strict=True)))
    middle, spread, share = model.usual[near]
    n, mean, large = len(saved), sum(saved) / max(1, len(saved)), sum(x >= 2 for x in saved)
    above = max((mean - middle) / (spread + 0.04), -2)
    more = max((large - n * share) / math.sqrt(n * share + 0.5), -2)
    features = [min(above, 6), min(more, 6), min(above, 3), min(more, 3), min(large, 2), min(large, 4), max(saved, default=0), math.log1p(n)]
    z = sum(w * (f - c) / s for w, f, c, s in zip(model.weights, features, model.center, model.spread, strict=False)) + model.weights[-1]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_score_equals_one_worked_out_by_hand(model):
    scorer = t.Scorer(model)
    for text in [b"", b" ", b"a", b"you worthless idiot", *(x for x, _ in rows(25, seed=3)), prose(8, 900).encode()]:
        assert scorer.score(text) == pytest.approx(by_hand(model, text), abs=1e-9)


def test_report_with_a_trained_model(spark):
    texts = [(i, x.decode()) for i, (x, _) in enumerate(rows(240, seed=2))]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows(240, seed=2))], "doc_id long, toxic int")
    extra = [(1000, None), (1001, ""), (1002, LONG), (1003, "you worthless pathetic idiot. " * 3 + prose(6, 20)), (None, prose(7, 30)), (1004, prose(7, 30)), (1004, prose(7, 30))]
    got = t.report(awkward(spark, texts + extra), labels).collect()
    assert len(got) == len(texts) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert by_id[1000] == by_id[1001] and by_id[1004][0] == by_id[1004][1] == by_id[None][0]
    assert by_id[1003][0] >= 0.7 > max(by_id[1000] + by_id[1002] + by_id[1004])


def test_whole_texts_are_learned_from(spark):
    tail = "x" * 9000 + " end"
    docs = spark.createDataFrame([(i, f"{i} {tail}") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    got = t.training_rows(docs, labels, id_col="doc_id", text_col="text", label_id_col="doc_id", label_col="toxic")
    assert got and all(x.endswith(b" end") for x, _ in got)


@pytest.fixture(scope="module")
def on_held_out_rows(spark):
    """(lang, label, score, predicted) of the labelled rows that nothing was learned from."""
    folder = "/root/testdata/sf0.1"
    labels = {i: (lang, toxic) for i, lang, toxic in duckdb.sql(f"SELECT doc_id, lang, toxic FROM '{folder}/labels.parquet' JOIN '{folder}/documents.parquet' USING (doc_id)").fetchall()}
    return [(*labels[r["doc_id"]], r["score"], r["predicted"]) for r in QUERIES["op6_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]


def test_query_on_held_out_rows_of_all_languages(on_held_out_rows):
    toxic, clean = ([g for g in on_held_out_rows if g[1] == label] for label in (1, 0))
    assert sum(g[3] for g in toxic) / len(toxic) > 0.75 and sum(g[3] for g in clean) / len(clean) < 0.02
    above = sum((a[2] > b[2]) + 0.5 * (a[2] == b[2]) for a in toxic for b in clean)
    assert above / (len(toxic) * len(clean)) > 0.93


def test_query_on_held_out_rows_of_each_language(on_held_out_rows):
    for lang in ("de", "en", "es", "fr"):
        toxic, clean = ([g[3] for g in on_held_out_rows if g[0] == lang and g[1] == label] for label in (1, 0))
        assert sum(toxic) / len(toxic) > 0.5 and sum(clean) / len(clean) < 0.04, lang
