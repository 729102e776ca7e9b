"""SimHash near-duplicates: fingerprints, exact links within a Hamming radius, components.

Fingerprint: A-Z lower-cased, words by ASCII white space, 3-word shingles with repeats (a shorter
text is one shingle, a text without words has fingerprint zero), XXH64 with seed 42 of each; a bit
is set if more than half the hashes have it.

Method: the distinct fingerprints are dealt into tiles of bounded size by the population counts of
their words of 21, 21 and 22 bits. Two fingerprints within the radius differ by no more than the
radius in the sum of those counts' differences, so pairs of tiles whose counts lie further apart are
skipped, and the others are compared exactly with exclusive-or and bit counts; a task skips blocks
within its pair of tiles in the same way, by the counts of four 16-bit words. A task keeps what it
finds as a spanning forest, one row a fingerprint at most, however many copies link to each other.
Components then come from alternating large-star and small-star steps.

Nothing of the documents reaches the driver but the number of fingerprints in each cell of counts,
of which there are at most 22 * 22 * 23.

Defined results: a null text counts as empty; texts without words share fingerprint zero and are
linked like any other; repeated rows are copies; a null doc_id is never a component's smallest id
and gets one only from its group; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import as_bytes, numbered, over_batches, pick
from loamline.session import checkpoint

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Distinct fingerprints in a tile; a task holds two tiles.
TILE_ROWS = 1 << 16
MOST_PARTITIONS = 20_000
#: Rows of a block within a tile, and blocks compared with one at once (what fits a core's cache).
BLOCK = 64
GROUP = 16
#: Winners are broadcast if they take no more bytes than this, and joined by a shuffle beyond it.
BROADCAST_BYTES = 32 << 20

CELL_MASKS = (0x1FFFFF, 0x1FFFFF << 21, (0x3FFFFF << 42) - (1 << 64))


def fingerprint(text: bytes) -> int:
    """The 64 bits of a text as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, SEED) for s in shingles])
    n = len(hashes) // 8
    counts = np.zeros(64, dtype=np.int64)
    step = 255 * 64
    for a in range(0, n, step):
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8, count=8 * min(step, n - a), offset=8 * a)).reshape(-1, 64)
        for b in range(0, len(bits), 255):
            counts += np.add.reduce(bits[b : b + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, same (a hash of the text), fp; one row a document."""
    docs = pick(documents, doc_id=id_col, text=text_col).withColumn("same", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp = pa.array([fingerprint(t) for t in as_bytes(batch.column("text"))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("same"), fp], ["doc_id", "same", "fp"])

    return over_batches(docs, step, f"doc_id {kind}, same long, fp long")


# --- tiles ---------------------------------------------------------------------------------------


def cells_of(fp):
    return [F.bit_count(fp.bitwiseAND(F.lit(m).cast("long"))) for m in CELL_MASKS]


def plan_tiles(cells: list[tuple[tuple[int, int, int], int]], tile_rows: int) -> tuple[list[tuple[tuple[int, int, int], int, int]], list[tuple[int, int]]]:
    """For each cell its first tile and number of tiles, and the pairs of tiles to compare.

    Cells in order fill tiles; a cell of more rows than a tile gets several, dealt by a hash.
    """
    where: list[tuple[tuple[int, int, int], int, int]] = []
    boxes: list[list[tuple[int, int]]] = []
    held = tile_rows
    for counts, rows in sorted(cells):
        if rows > tile_rows:
            parts = -(-rows // tile_rows)
            where.append((counts, len(boxes), parts))
            boxes += [[(c, c) for c in counts] for _ in range(parts)]
            held = tile_rows
            continue
        if held + rows > tile_rows:
            boxes.append([(c, c) for c in counts])
            held = 0
        held += rows
        boxes[-1] = [(min(a, c), max(b, c)) for (a, b), c in zip(boxes[-1], counts, strict=True)]
        where.append((counts, len(boxes) - 1, 1))
    low, high = (np.array([[x[side] for x in box] for box in boxes]).reshape(-1, 3) for side in (0, 1))
    pairs = []
    for i in range(len(boxes)):
        gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i])).sum(axis=1)
        pairs += [(i, i + int(j)) for j in np.flatnonzero(gap <= RADIUS)]
    return where, pairs


def link_rows(fps: np.ndarray, split: int, radius: int = RADIUS) -> np.ndarray:
    """For each row the index of the row that stands for its group.

    Compares rows before ``split`` with those from it on; all with all if split is 0.
    """
    n = len(fps)
    label = np.arange(n)

    def blocks(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        counts = np.bitwise_count(np.ascontiguousarray(fps[rows]).view(np.uint16).reshape(-1, 4)).astype(np.int16)
        order = np.lexsort(counts.T[::-1])
        rows, counts = rows[order], counts[order]
        return [(rows[a : a + BLOCK], counts[a : a + BLOCK].min(axis=0), counts[a : a + BLOCK].max(axis=0)) for a in range(0, len(rows), BLOCK)]

    left = blocks(np.arange(split or n))
    right = blocks(np.arange(split, n)) if split else left
    if not left or not right:
        return label
    low, high = (np.array([b[k] for b in right]) for k in (1, 2))
    xors, bits = np.empty((BLOCK, BLOCK * GROUP), np.uint64), np.empty((BLOCK, BLOCK * GROUP), np.uint8)
    for i, (rows, lo, hi) in enumerate(left):
        gap = np.maximum(0, np.maximum(lo - high, low - hi)).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if not split:
            near = near[near >= i]
        mine = fps[rows][:, None]
        for k in range(0, len(near), GROUP):
            others = np.concatenate([right[j][0] for j in near[k : k + GROUP]])
            a, b = label[rows], label[others]
            if a[0] == b[0] and (a == a[0]).all() and (b == b[0]).all():
                continue
            x, n = xors[: len(a), : len(b)], bits[: len(a), : len(b)]
            np.bitwise_count(np.bitwise_xor(mine, fps[others][None, :], out=x), out=n)
            close = n <= radius
            if not close.any():
                continue
            x, y = np.nonzero(close)
            apart = a[x] != b[y]
            if apart.any():
                merge(label, np.unique(np.stack([a[x[apart]], b[y[apart]]], axis=1), axis=0))
    return label


def merge(label: np.ndarray, pairs: np.ndarray) -> None:
    """Unites the groups that stand for each pair, in place."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs.tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    to = np.arange(len(label))
    for x in parent:
        to[x] = root(x)
    label[:] = to[label]


def links(distinct: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """u, v: a spanning forest of the links between distinct fingerprints (column fp)."""
    spark = distinct.sparkSession
    names = ["c0", "c1", "c2"]
    cells = distinct.select(F.col("fp"), *[c.alias(n) for c, n in zip(cells_of(F.col("fp")), names, strict=True)])
    counted = [((r[0], r[1], r[2]), r[3]) for r in cells.groupBy(*names).count().collect()]
    where, pairs = plan_tiles(counted, tile_rows)
    member: dict[int, list[tuple[int, bool]]] = {}
    for p, (i, j) in enumerate(pairs):
        member.setdefault(i, []).append((p, False))
        if j != i:
            member.setdefault(j, []).append((p, True))
    of_cell = F.broadcast(spark.createDataFrame([(*c, first, parts) for c, first, parts in where], "c0 int, c1 int, c2 int, first long, parts long").coalesce(1))
    of_tile = spark.createDataFrame([(t, p, r) for t, some in member.items() for p, r in some], "tile long, pair long, right boolean").coalesce(1)
    tile = (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("parts"))).alias("tile")
    dealt = cells.join(of_cell, names).select("fp", tile).join(F.broadcast(of_tile) if len(pairs) <= 100_000 else of_tile, "tile")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["right", "fp"])
        split = int((~rows["right"]).sum())
        fps = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
        label = link_rows(fps, split if split < len(rows) else 0)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": fps[moved].view(np.int64), "v": fps[label[moved]].view(np.int64)})

    dealt = dealt.select("pair", "right", "fp").repartition(max(1, min(2 * len(pairs), MOST_PARTITIONS)), "pair")
    return dealt.groupBy("pair").applyInPandas(compare, "u long, v long")


# --- components ----------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (u, v), by alternating large-star and small-star.

    root is the smallest node of the component. Each step cuts its lineage with a checkpoint. A
    star's centre may hold most edges: its minimum is combined before the shuffle, and the join back
    is a sort-merge join, whose large partitions Spark splits.
    """
    edges = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = checkpoint(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, same, fp, root (a fingerprint of the component), component_id (its smallest doc_id)."""
    docs = checkpoint(fingerprints(documents, id_col=id_col, text_col=text_col))
    groups = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(groups.select("fp"), tile_rows))
    joined = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = joined.join(named, "root").select("fp", "root", "component_id")
    return docs.join(of_fp, "fp").select("doc_id", "same", "fp", "root", "component_id")


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns.

    It is the one with the component's smallest id; among rows alike in id, the one with the smallest
    hash of its text; of rows alike in both, any one.
    """
    plain, names, of = numbered(documents)
    found = near_duplicates(documents, id_col=id_col, text_col=text_col)
    rank = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id"), F.col("same"))
    winners = found.groupBy("root").agg(F.min(rank).alias("w"))
    winners = checkpoint(winners.select(F.col("w.doc_id").alias("w_id"), F.col("w.same").alias("w_same")))
    n = winners.count()
    if n * 24 <= BROADCAST_BYTES:
        winners = F.broadcast(winners)
    same = F.xxhash64(of(text_col))
    kept = plain.withColumn("w_same", same).join(winners.withColumnRenamed("w_same", "to_same"), of(id_col).eqNullSafe(F.col("w_id")) & (F.col("w_same") == F.col("to_same")), "left_semi")
    return _once(kept, found, of(id_col)).drop("w_same").toDF(*names)


def _once(kept: DataFrame, found: DataFrame, ident) -> DataFrame:
    """Rows alike in id and text once; only where there are such rows does it take a shuffle."""
    again = found.groupBy("doc_id", "same").count().where("count > 1")
    if again.limit(1).count() == 0:
        return kept
    again = again.select(F.col("doc_id").alias("r_id"), F.col("same").alias("r_same"))
    named = kept.withColumn("i", ident)
    on = F.col("i").eqNullSafe(F.col("r_id")) & (F.col("w_same") == F.col("r_same"))
    return named.join(again, on, "left_anti").unionAll(named.join(again, on, "left_semi").dropDuplicates(["i", "w_same"])).drop("i")


def brute_force(rows: list[tuple], radius: int = RADIUS) -> dict[int, tuple[str, int]]:
    """doc_id -> (fingerprint, component_id) by comparing all pairs; for small fixtures."""
    fps = [(i, fingerprint((t or "").encode()) & (2**64 - 1)) for i, t in rows]
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= radius:
                x, y = label[a], label[b]
                label = [min(x, y) if z in (x, y) else z for z in label]
    least: dict[int, int] = {}
    for (i, _), z in zip(fps, label, strict=True):
        least[z] = min(least.get(z, i), i)
    return {i: (f"{f:016x}", least[z]) for (i, f), z in zip(fps, label, strict=True)}
