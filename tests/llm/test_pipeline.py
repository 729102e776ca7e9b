import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from loamline.llm import decontaminate, pieces, pii, simhash, toxicity
from loamline.session import shared_folder
from tests.llm.fixtures import LONG, awkward

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_their_brute_forms(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    scored = toxicity.report(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    calm = {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    docs = [d for d in docs if d[0] in calm]
    groups = simhash.brute_force(docs)
    docs = [d for d in docs if groups[d[0]][1] == d[0]]
    dirty = decontaminate.brute_force(docs, items)
    docs = [d for d in docs if not dirty[d[0]][4]]
    texts = [t for _, t in docs]
    masked = [pii.redact(t, spans) for t, (_, spans) in zip(texts, pii.find(texts, pii.trained()), strict=True)]
    encoder = pieces.Pieces(pieces.load())
    want = {i: encoder.encode(t).tolist() for (i, _), t in zip(docs, masked, strict=True)}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want and 0 < len(got) < 200


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for rows in (docs.limit(5), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, FOLDER).columns == docs.columns
    assert corpus_pipeline.as_pieces(spark, awkward(spark), FOLDER).count() == 10


def folder_of(spark, path, documents, labels, items):
    """Tables for a run: documents with columns whose names the operators use themselves."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, spans string, row string, c0 string"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "x", "y", "z", "c") for i, t in documents], kinds).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_run_on_awkward_tables(spark, tmp_path):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, "plain text here of a few words"), (2, None), (3, ""), (4, LONG), (5, "plain text here of a few words"), (5, "plain text here of a few words"), (None, "quite another text by nobody known"), (6, " \n\t"), (7, passage), (8, "mail a@b.org now or never my friend")]
    got = corpus_pipeline.run(spark, folder_of(spark, tmp_path / "a", rows, [], [(1, passage), (2, None), (None, "x")])).collect()
    # texts without words are near-duplicates of each other; 5 is a copy of 1; 7 is contaminated
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 1, 2, 4, 8]
    encoder = pieces.Pieces(pieces.load())
    assert {r["doc_id"]: r["ids"] for r in got}[8] == encoder.encode("mail [EMAIL] now or never my friend").tolist()
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_run_on_empty_tables(spark, tmp_path):
    empty = corpus_pipeline.run(spark, folder_of(spark, tmp_path / "b", [], [], []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path / "c", [(1, "a text")], [(1, 1, 0), (None, None, None)], [])).count() == 1


def test_only_the_last_stage_is_left_behind(spark):
    import os

    folder = corpus_pipeline.run(spark, FOLDER).inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert os.listdir(folder) == [str(len(corpus_pipeline.STAGES) - 1)]


def test_a_cluster_must_name_the_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_entry_without_the_operators():
    """Where a library that the operators need is missing, the other queries are still there."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert 'known_keys' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q) and 'ahocorasick' in str(e.LLM_MISSING)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(corpus_pipeline.__file__).parent)
