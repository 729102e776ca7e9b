"""Benchmark decontamination: which document words lie inside a benchmark passage.

Method: Wu-Manber multi-pattern search with words as the alphabet. For each pattern length a
shift table maps a block of words to how far the search may move on (past a word that no pattern
holds, in any case); a block of shift zero opens a suffix bucket, in which the pattern's leading word
selects the strings to compare with directly. Words are numbered, and the items' words are kept once.

A worker holds the tables of ``PASS_BYTES`` of benchmark text at most (some 40 times as many bytes; a
test measures it), and the driver no more than that text. A larger benchmark takes a pass over the
documents for each part: a pass is run and what it hit is written out before the next part is
fetched, and the last pass meets the earlier ones' hits by a key of id and text.

Words: A-Z lower-cased, then runs of anything but ASCII non-alphanumerics. A window is 13
consecutive words of an item; an item with fewer words, but not none, is one window.

Defined results: null and empty texts have no words, so nothing hits; an item without words has no
window; a null item_id takes no part; repeated items count once, repeated documents give repeated
rows; an empty benchmark leaves every document clean; an empty documents table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import as_bytes, numbered, pick, position, row_key, slices
from loamline.session import checkpoint

WINDOW = 13
BLOCK = 3
#: Benchmark text that one pass over the documents searches for; more is searched in further passes.
PASS_BYTES = 6 << 20
#: Document text that a worker looks at together; a longer text is looked at alone.
PART_BYTES = 4 << 20

_ALNUM = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_FOLD = bytes(c if c in _ALNUM else (c + 32 if 65 <= c <= 90 else 32) for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """Search for windows of one length; a window is a place in the items' word numbers."""

    def __init__(self, flat: array, items: list[tuple[int, int]], length: int):
        """items: (start, number of words) in flat; every run of length words in one is a window."""
        self.flat, self.length, self.block = flat, length, min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}
        for start, n in items:
            for end in range(self.block, n + 1):
                key = self._key(flat[start + end - self.block : start + end])
                # in a window further right the block stands further left; behind the first window it ends one
                self.shift[key] = min(self.shift.get(key, self.default), max(0, length - end))
                if end >= length:
                    self.buckets.setdefault(key, []).append(start + end - length)

    @staticmethod
    def _key(numbers: array) -> int:
        key = 0
        for n in numbers:
            key = key << 32 | n
        return key

    def occurrences(self, words: list[bytes], number: dict[bytes, int]) -> Iterator[tuple[int, int]]:
        """(index of the first word, place of the window) of every occurrence, from left to right."""
        length, block, default, shift, of = self.length, self.block, self.default, self.shift, number.get
        end, n = length, len(words)
        while end <= n:
            key, strange = 0, 0
            for i in range(end - block, end):
                x = of(words[i], 0)
                key = key << 32 | x
                if not x:
                    strange = i + 1
            move = strange + length - end if strange else shift.get(key, default)
            if move:
                end += move
                continue
            start = end - length
            first = of(words[start], 0)
            said = None
            for at in self.buckets[key]:
                if self.flat[at] == first:
                    said = said or array("I", [of(w, 0) for w in words[start:end]])
                    if self.flat[at : at + length] == said:
                        yield start, at
            end += 1


class Searcher:
    """All windows of some benchmark items, one Wu-Manber search for each window length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        flat, lengths = array("I"), defaultdict(list)
        self.starts, self.items = [], []
        for item_id, text in items:
            words = words_of(text)
            size = min(window, len(words))
            self.starts.append(len(flat))
            self.items.append(item_id)
            if size:
                lengths[size].append((len(flat), len(words)))
            flat.extend(self.number.setdefault(w, len(self.number) + 1) for w in words)
        self.searches = [WuManber(flat, some, size) for size, some in sorted(lengths.items())]

    def mark(self, words: list[bytes], hit: bytearray, found: set[str]) -> None:
        for search in self.searches:
            size = search.length
            for start, at in search.occurrences(words, self.number):
                hit[start : start + size] = b"\x01" * size
                found.add(self.items[bisect_right(self.starts, at) - 1])


def _runs(hit: bytearray) -> list[tuple[int, int]]:
    out, i = [], hit.find(1)
    while i >= 0:
        j = hit.find(0, i)
        j = len(hit) if j < 0 else j
        out.append((i, j))
        i = hit.find(1, j)
    return out


@lru_cache(maxsize=1)
def _of_worker(name: str, window: int) -> list[Searcher]:
    return []


def _searcher(name: str, items: list[tuple[str, bytes]], window: int) -> Searcher:
    """The tables of a pass, which a worker makes once and keeps until it sees another pass."""
    held = _of_worker(name, window)
    if not held:
        held.append(Searcher(items, window))
    return held[0]


def contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, n_words, spans (hit word ranges, end exclusive), items (sorted item ids as strings)."""
    rows = pick(documents, doc_id=id_col, text=text_col)
    items = pick(benchmark, item_id=item_col, text=item_text_col)
    return _search(rows, "doc_id", "text", items, window, pass_bytes, ["doc_id"])


def _search(rows: DataFrame, ident: str, text: str, items: DataFrame, window: int, pass_bytes: int, keep: list[str]) -> DataFrame:
    """The columns in keep, n_words, spans, items.

    Documents stay where they are: a pass is a narrow map over them. Only a benchmark that takes
    several passes makes them meet the hits of other passes, by a join.
    """
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // pass_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    context = rows.sparkSession.sparkContext
    before: DataFrame | None = None
    for k in range(parts):
        chosen = items if parts == 1 else items.where(part == k)
        shared = context.broadcast((uuid4().hex, [(r[0], r[1].encode()) for r in chosen.collect()]))
        if k + 1 == parts:
            break
        hits = _scan(rows.select(row_key(F.col(ident), F.col(text)).alias("key"), F.col(text).alias("text")), "text", shared, window, ["key"])
        hits = checkpoint(hits.where(F.size("spans") > 0).dropDuplicates(["key"]).select("key", "spans", "items"))
        shared.unpersist()
        before = hits if before is None else before.unionByName(hits)
    if before is None:
        return _scan(rows, text, shared, window, keep)
    keyed = rows.withColumn("_key", row_key(F.col(ident), F.col(text)))
    last = _scan(keyed, text, shared, window, [*keep, "_key"])
    before = before.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans_before"), F.flatten(F.collect_list("items")).alias("items_before"))
    both = last.join(before, last["_key"] == before["key"], "left")
    spans = merged(F.when(F.col("key").isNull(), F.col("spans")).otherwise(F.concat("spans", "spans_before")))
    found = F.when(F.col("key").isNull(), F.col("items")).otherwise(F.array_sort(F.array_distinct(F.concat("items", "items_before"))))
    return both.select(*keep, "n_words", spans.alias("spans"), found.alias("items"))


def merged(spans: Column) -> Column:
    """Ranges that touch or overlap as one, by start."""
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(F.size(acc) == 0, F.array(s)).when(s["start"] <= last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), longer)).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), none, step)


def _scan(rows: DataFrame, text: str, part, window: int, keep: list[str]) -> DataFrame:
    """The columns in keep, n_words, spans, items of one pass."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    at, kept = rows.columns.index(text), [rows.columns.index(name) for name in keep]
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(*part.value, window)
        for whole in batches:
            for batch in slices(whole, whole.column(at), PART_BYTES):
                n_words, spans, items = [], [], []
                for document in as_bytes(batch.column(at)):
                    words = words_of(document)
                    hit, found = bytearray(len(words)), set()
                    searcher.mark(words, hit, found)
                    n_words.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in _runs(hit)])
                    items.append(sorted(found))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(n_words, pa.int64()), pa.array(spans, ranges), pa.array(items, pa.list_(pa.string()))], [*keep, "n_words", "spans", "items"])

    return rows.mapInArrow(run, ", ".join([*(f"{name} {fields[name]}" for name in keep), "n_words long, spans array<struct<start:bigint,end:bigint>>, items array<string>"]))


def report(found: DataFrame) -> DataFrame:
    """The contract's columns of what :func:`contamination` found."""
    out = found.select("doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The documents that the rule does not call contaminated, with all their columns, unchanged."""
    plain, names, _ = numbered(documents)
    items = pick(benchmark, item_id=item_col, text=item_text_col)
    found = _search(plain, f"c{position(names, id_col)}", f"c{position(names, text_col)}", items, WINDOW, pass_bytes, plain.columns)
    return found.where(~contaminated(hit_words(), F.col("n_words"))).select(*plain.columns).toDF(*names)


def brute_force(documents: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """The same by comparing every window at every position; for small fixtures."""
    grams: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        words = words_of((text or "").encode())
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            grams[tuple(words[i : i + size])].add(str(item_id))
    out = {}
    for doc_id, text in documents:
        words = words_of((text or "").encode())
        hit, found = set(), set()
        for i in range(len(words)):
            for size in {len(g) for g in grams}:
                if i + size <= len(words) and (items_at := grams.get(tuple(words[i : i + size]))):
                    hit |= set(range(i, i + size))
                    found |= items_at
        joined = ",".join(sorted(found))
        out[doc_id] = (len(words), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))
    return out
