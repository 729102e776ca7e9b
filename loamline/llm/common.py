"""Shared pieces of the training-data operators.

Every operator reads its columns through :func:`pick`, which addresses columns by position, so
unrelated columns of the input may carry any name, the operator's own output names included, and
names that differ in case only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def position(names: list[str], wanted: str) -> int:
    """Index of a column: exact spelling first, then any case; ValueError if there is none."""
    if wanted in names:
        return names.index(wanted)
    folded = [n.lower() for n in names]
    if wanted.lower() in folded:
        return folded.index(wanted.lower())
    raise ValueError(f"no column {wanted!r} among {names}")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the asked-for columns, under the keyword's name."""
    names = df.columns
    at = {new: position(names, old) for new, old in columns.items()}
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


def numbered(df: DataFrame) -> tuple[DataFrame, list[str], Callable[[str], Column]]:
    """The frame with columns c0, c1, ...; its old names; and a lookup from old name to column."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain, names, lambda name: F.col(f"c{position(names, name)}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def over_batches(df: DataFrame, step: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow of a function that turns one record batch into any number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: pa.Array, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about so many bytes of a string or list column, and a row at least."""
    sizes = (pc.binary_length(column) if pa.types.is_string(column.type) else pc.multiply(pc.list_value_length(column), 4)).fill_null(0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held + size > most_bytes and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    """Python strings of a string column; null reads as empty."""
    return [x or "" for x in column.to_pylist()]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row_key(doc_id: Column, text: Column) -> Column:
    """A join key of a document row that is never null: rows alike in id and text share it."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("\u0000"), F.coalesce(text, F.lit(""))))
