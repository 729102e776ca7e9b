"""The training-data pipeline: documents in, piece ids out, stage by stage.

Each stage is a function of (spark, docs, sf_dir); a runner writes its result as Parquet and hands
what it reads back to the next stage. All stages but the last return the columns of documents.

Defined results: a null text is kept like an empty one by every filter, stays null under masking and
has no piece ids (near-duplicate removal keeps one of all texts without words); a null doc_id is a
document like any other; of exact and near copies the one with the smallest doc_id stays, one of
rows that are alike in everything; an empty documents table gives no rows, empty labels or benchmark
remove none; further columns are carried along, whatever their names.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import decontaminate, pieces, pii, simhash, toxicity
from loamline.llm.common import table
from loamline.session import remove_folder, shared_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens; decoding the ids gives the stage's text back."""
    coded = pieces.encode(docs, keep=["doc_id", "lang", "source"])
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("sentencepiece", as_pieces),
]

#: The stages hold trained models and fingerprints that SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; what lies between them is written to the shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    return docs
