"""Exact top-k search by inner product over quantised vectors.

Each component x becomes floor(1024 * x), x as a double; scores are integer inner products.

Method: multi-resolution segment statistics. A vector is cut into 1, then 4, then 16 segments. With
mean m and deviation s of a segment of length L, the squared distance of two vectors is at least the
sum of L * ((m - m')**2 + (s - s')**2), and the more segments, the closer the bound. From the
norms, a lower bound on the distance is an upper bound on the inner product. Candidates are
dropped coarse to fine where the bound cannot reach the k-th best score found so far; survivors
get their exact score, so the result is exact.

The queries are taken in blocks of bounded bytes, one after the other: a block is fetched and sent out,
all rows are scanned against it in one narrow pass, in which a task keeps k rows a query, the
tasks' rows are merged a query at a time, and the k rows of each are written out before the next
block is fetched. So the driver and the workers hold one block, however large the table. As every
hundredth row is a query, exact search takes a number of pairs that grows with the square of the
table, and a scan of the table for every ``BLOCK_BYTES`` of queries: 1 GB of queries (100 GB of
vectors) takes 250 scans.

Defined results: vectors that are null, or hold null or non-finite components, and rows of a null id
take no part; a row's own id is never among its results; a repeated query id is asked once, with
its smallest vector; repeated candidate rows each count; ties go to the smaller id; vectors of
different lengths are not compared; with fewer than k candidates all are returned; an empty table
gives no rows. A component whose product with 1024 is beyond a double counts as the greatest double of
its sign. Scores beyond the range of a long are clipped to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.common import pick
from loamline.session import checkpoint

K = 10
SCALE = 1024.0
LEVELS = (1, 4, 16)
#: Bytes of query vectors, as doubles, that one pass holds.
BLOCK_BYTES = 4 << 20
#: Rows that are brought before a block's queries together, and pairs of them at most.
CHUNK = 2048
MOST_PAIRS = 1 << 23
#: Share of a chunk's pairs from which on the survivors are scored by one matrix product.
DENSE = 0.02
#: Up to this magnitude doubles add integer products of up to 2**11 components exactly.
SAFE = float(1 << 20)


def quantised(values: np.ndarray) -> np.ndarray:
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values.astype(np.float64))
    return np.where(np.isfinite(values), np.clip(scaled, -most, most), scaled)


def vectors_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, quantised matrix) for each vector length; rows that take no part are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array([-1 if x is None else x for x in column.value_lengths().to_pylist()], dtype=np.int64)
    flat = column.flatten()
    values = quantised(np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64))
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    out = []
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = values[starts[rows][:, None] + np.arange(length)[None, :]]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            out.append((rows[good], matrix[good]))
    return out


class Statistics:
    """Means and deviations of the segments at each level, scaled by the root of their length."""

    def __init__(self, matrix: np.ndarray):
        n, size = matrix.shape
        self.norm = np.einsum("ij,ij->i", matrix, matrix)
        self.levels = []
        for count in dict.fromkeys(min(c, max(size, 1)) for c in LEVELS):
            edges = [(size * i) // count for i in range(count + 1)]
            parts = [matrix[:, a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]
            means = [np.sqrt(p.shape[1]) * p.mean(axis=1) for p in parts]
            spread = [np.sqrt(p.shape[1]) * p.std(axis=1) for p in parts]
            self.levels.append(np.stack(means + spread, axis=1) if parts else np.zeros((n, 1)))

    def take(self, rows: np.ndarray) -> Statistics:
        out = object.__new__(Statistics)
        out.norm, out.levels = self.norm[rows], [x[rows] for x in self.levels]
        return out


def upper_bounds(candidates: Statistics, queries: Statistics, level: int) -> np.ndarray:
    """Highest inner product that the distance bound allows, with room for rounding."""
    x, q = candidates.levels[level], queries.levels[level]
    least = np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2.0 * (x @ q.T))
    most = candidates.norm[:, None] + queries.norm[None, :]
    return (most - least) / 2.0 + 1e-9 * most + 1.0


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise inner products as longs; beyond the safe range by Python integers, clipped."""
    size = max(1, x.shape[1])
    if size <= 2048 and max(np.abs(x).max(initial=0), np.abs(q).max(initial=0)) <= SAFE:
        return np.einsum("ij,ij->i", x, q).astype(np.int64)
    limit = 1 << 63
    return np.array([max(-limit, min(limit - 1, sum(int(a) * int(b) for a, b in zip(u, v, strict=True)))) for u, v in zip(x, q, strict=True)], dtype=np.int64)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.query = k, np.zeros(0, np.int64)
        self.score, self.ident = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.reach = np.full(n, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        query, score, ident = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.ident, ident)))
        order = np.lexsort((ident, ~score, query))
        query, score, ident = query[order], score[order], ident[order]
        first = np.searchsorted(query, query, side="left")
        rank = np.arange(len(query)) - first
        keep = rank < self.k
        self.query, self.score, self.ident = query[keep], score[keep], ident[keep]
        full = rank[keep] == self.k - 1
        self.reach[self.query[full]] = self.score[full]


def scan(best: Best, ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, statistics: Statistics) -> None:
    """Brings rows of one length before the queries of that length."""
    size = max(1, min(CHUNK, MOST_PAIRS // max(1, len(query_ids))))
    for a in range(0, len(ids), size):
        chunk, own = matrix[a : a + size], ids[a : a + size]
        with np.errstate(over="ignore", invalid="ignore"):
            seen = Statistics(chunk)
        rows, cols = np.arange(len(own)), np.arange(len(query_ids))
        alive = np.ones((len(rows), len(cols)), dtype=bool)
        for level in range(len(seen.levels)):
            with np.errstate(over="ignore", invalid="ignore"):  # a bound that overflows drops nothing
                alive &= ~(upper_bounds(seen.take(rows), statistics.take(cols), level) < best.reach[cols][None, :])
            r, c = alive.any(axis=1), alive.any(axis=0)
            alive, rows, cols = alive[np.ix_(r, c)], rows[r], cols[c]
            if not len(rows):
                break
        if len(rows):
            survivors(best, alive, own, chunk, rows, query_ids, queries, cols)


def survivors(best: Best, alive: np.ndarray, ids: np.ndarray, matrix: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, cols: np.ndarray) -> None:
    """Exact scores of the pairs that are left: by one product where they are many, else pair by pair."""
    safe = matrix.shape[1] <= 2048 and max(np.abs(matrix).max(initial=0), np.abs(queries).max(initial=0)) <= SAFE
    if safe and alive.mean() > DENSE:
        scores = matrix[rows] @ queries[cols].T  # whole numbers below 2**53, hence exact
        r, c = np.nonzero(alive & (scores >= best.reach[cols][None, :]) & (ids[rows][:, None] != query_ids[cols][None, :]))
        best.add(cols[c], scores[r, c].astype(np.int64), ids[rows[r]])
        return
    r, c = np.nonzero(alive & (ids[rows][:, None] != query_ids[cols][None, :]))
    r, c = rows[r], cols[c]
    for b in range(0, len(r), 1 << 17):
        at, to = r[b : b + (1 << 17)], c[b : b + (1 << 17)]
        scores = exact_scores(matrix[at], queries[to])
        good = scores >= best.reach[to]
        best.add(to[good], scores[good], ids[at[good]])


def top_k(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest score for every query.

    The queries are the rows whose id is divisible by ``every``.
    """
    rows = pick(table, vec_id=id_col, vector=vector_col).where("vec_id is not null and vector is not null")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    asked = rows.where((F.col("vec_id") % every == 0) & ~bad).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    total = asked.agg(F.sum(F.size("vector") * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    found = None
    for i in range(blocks):
        best = _of_block(rows, asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i), k)
        if blocks == 1:
            return best
        best = checkpoint(best)
        found = best if found is None else found.unionAll(best)
    return found


def _of_block(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The result for the queries of one block."""
    by_length: dict[int, list] = {}
    for ident, vector in asked.orderBy("vec_id").collect():
        by_length.setdefault(len(vector), []).append((ident, vector))
    packed = {n: (np.array([x[0] for x in some], dtype=np.int64), quantised(np.array([x[1] for x in some], dtype=np.float64).reshape(len(some), n))) for n, some in by_length.items()}
    found = _local(rows, rows.sparkSession.sparkContext.broadcast(packed), k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _local(rows: DataFrame, packed, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore", invalid="ignore"):
            asked = {n: (ids, matrix, Statistics(matrix)) for n, (ids, matrix) in packed.value.items()}
        best = {n: Best(len(ids), k) for n, (ids, _, _) in asked.items()}
        for batch in batches:
            ids = np.asarray(batch.column("vec_id").to_numpy(zero_copy_only=False), dtype=np.int64)
            for at, matrix in vectors_of(batch.column("vector")):
                if matrix.shape[1] in asked:
                    query_ids, queries, statistics = asked[matrix.shape[1]]
                    scan(best[matrix.shape[1]], ids[at], matrix, query_ids, queries, statistics)
        for n, kept in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(asked[n][0][kept.query], pa.int64()), pa.array(kept.ident, pa.int64()), pa.array(kept.score, pa.int64())], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def brute_force(rows: list[tuple], every: int = 100, k: int = K) -> list[tuple]:
    """The same by scoring every pair; for small fixtures."""
    raw = [(i, list(v)) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    whole = lambda v: [int(c) for c in quantised(np.array(v, dtype=np.float64))]
    good = [(i, whole(v)) for i, v in raw]
    asked: dict[int, list] = {}
    for i, v in raw:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in sorted((i, whole(v)) for i, v in asked.items()):
        clipped = lambda s: max(-(2**63), min(2**63 - 1, s))
        scored = sorted((-clipped(sum(a * b for a, b in zip(v, x, strict=True))), i) for i, x in good if i != q and len(x) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out
