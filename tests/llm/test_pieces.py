import random

import pytest
import sentencepiece

from loamline.llm import pieces as p
from loamline.llm.queries import QUERIES
from tests.llm.fixtures import awkward, prose


@pytest.fixture(scope="module")
def model():
    return p.load()


def samples():
    rng = random.Random(1)
    letters = "abcdeth in\n\té漢字😀 .,_0123  the ing"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    out += [" ".join(rng.choice(["hello", "internationalization", "def", "  ", "\n\n", "return", "x" * 20, "。", "end.", "(a)", "don't"]) for _ in range(8)) for _ in range(200)]
    return [*out, prose(1, 300), "", " ", "▁"[:0], "a" * 3000, "\u0000", "Ωmega"]


def test_merge_model_equals_the_library(model):
    mine = p.Pieces(model)
    library = sentencepiece.SentencePieceProcessor(model_file=p.MODEL)
    for text in samples():
        assert mine.encode(text).tolist() == library.encode(text), text


def test_round_trip_is_exact(model):
    mine, back = p.Pieces(model, memory=50), p.Decoder(model)
    for text in [*samples(), "a▁b", "▁", "▁ ▁▁x", " lead", "trail "]:
        assert back.decode(mine.encode(text).tolist()) == text


def test_score_model_equals_brute_force():
    rng = random.Random(5)
    words = ["a", "b", "c", "▁", "ab", "bc", "abc", "▁a", "▁ab", "cab", "bb", "aa", "▁▁"]
    bytes_ = [(f"<0x{i:02X}>", 0.0, p.BYTE) for i in range(256)]
    model = {"pieces": [("<unk>", 0.0, p.UNKNOWN), *[(w, -rng.random() * 5, p.NORMAL) for w in words], *bytes_], "kind": p.UNIGRAM, "prefix": True}
    mine = p.Pieces(model)
    scores = {w: s for w, s, k in model["pieces"] if k == p.NORMAL}

    def best(text):
        table = [0.0] + [None] * len(text)
        for e in range(1, len(text) + 1):
            ways = [table[e - len(w)] + s for w, s in scores.items() if len(w) <= e and text[e - len(w) : e] == w and table[e - len(w)] is not None]
            table[e] = max(ways, default=None)
        return table[-1]

    for _ in range(500):
        text = "▁" + "".join(rng.choice("abc▁") for _ in range(rng.randint(0, 12)))
        found = mine.segment(text)
        assert "".join(model["pieces"][i][0] for i in found) == text
        assert sum(model["pieces"][i][1] for i in found) == pytest.approx(best(text))
    assert p.Decoder(model).decode(mine.encode("ab z é").tolist()) == "ab z é"


def test_awkward_rows(spark):
    documents = awkward(spark)
    coded = p.encode(documents, ids_col="ids2")
    assert coded.columns == [*documents.columns, "ids2"]
    back = p.decode(p.encode(documents, ids_col="ids2", keep=["doc_id", "text"]), ids_col="ids2", text_col="back").collect()
    assert all((r["text"] or "") == r["back"] for r in back) and len(back) == 10
    assert p.encode(awkward(spark, [])).count() == 0
    odd = spark.createDataFrame([([None, -5, 10**6, 0, 1],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in p.decode(odd).collect()] == ["", None, ""]


def test_query_gives_every_text_back(spark):
    rows = QUERIES["op4_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r["round_trip"] for r in rows)
