"""SentencePiece encoding and decoding with the vocabulary of a given model file.

Method: an Aho-Corasick automaton over the pieces reports, in a single pass and through its output
links, every piece that ends at each position; a Viterbi table holds the best way to each position
and is relaxed with those pieces. What "best" means is the model's: for a unigram model the highest
sum of piece scores; for a merge model (BPE) scores rank merges and do not add up, so there a
piece relaxes a position if it stays apart from the piece before it when the two are merged anew.
Exactly one piece does, and the result is the library's own segmentation.

No piece holds a space mark behind another character (checked on loading), so words are encoded
apart and a bounded table remembers them; a model that breaks this is encoded text by text.

Characters without a piece of their own become byte pieces. A space mark that the text itself holds becomes byte
pieces too, so that decoding gives every text back exactly.

Defined results: null and empty texts give no ids; decoding null gives null, decoding no ids the
empty text; ids outside the vocabulary, control pieces and null ids decode to nothing; repeated rows
and extra columns pass through; an empty table gives no rows. Texts are encoded whole at any length.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import numbered, pick, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words whose pieces a worker remembers, in each of two generations.
MEMORY = 220_000
#: Text or ids that a worker turns over at once.
PART_BYTES = 2 << 20


def load(path: str = MODEL) -> dict:
    """Pieces, scores, types and model type of a .model file, as plain values that can be broadcast."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return {"pieces": [(p.piece, p.score, p.type) for p in model.pieces], "kind": model.trainer_spec.model_type, "prefix": model.normalizer_spec.add_dummy_prefix}


class Pieces:
    """Encoder for a model as :func:`load` gives it."""

    def __init__(self, model: dict, memory: int = MEMORY):
        self.kind, self.prefix, self.memory = model["kind"], model["prefix"], memory
        self.pieces = model["pieces"]
        self.rank = {piece: (score, i) for i, (piece, score, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)}
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), 0)
        self.singles = {piece for piece in self.rank if len(piece) == 1}
        self.strange = re.compile("([^" + "".join(map(re.escape, sorted(self.singles))) + "])" if self.singles else r"([\s\S])")
        self.automaton = ahocorasick.Automaton()
        for piece, (score, i) in self.rank.items():
            if self.kind != BPE or self._merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i, score, {}))
        self.automaton.make_automaton()
        by_word = not any(SPACE in piece.lstrip(SPACE) for piece in self.rank)
        newline = "" if any("\n" in piece for piece in self.rank) else "\n"
        whole = f"{SPACE}*[^{SPACE}{newline}]+|{SPACE}+" + (f"|{newline}" if newline else "")
        # a mark that no piece has behind a Latin letter is cut off a word, which is then met more often
        apart = "".join(re.escape(c) for c in ".,;:!?)" if not any(re.search(rf"[{LATIN}]{re.escape(c)}", piece) for piece in self.rank))
        first = rf"{SPACE}*[{LATIN}]++(?=[{apart}])|" if apart else ""
        self.words = re.compile(first + whole if by_word else r"[\s\S]+")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs = 0  # of pieces, that are known to stay apart or not

    # -- encoding ---------------------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as int32."""
        if not text:
            return np.zeros(0, np.int32)
        if len(self.known) > self.memory:
            self.known, self.older = {}, self.known
        head, *rest = text.split(SPACE)
        parts = [self._plain((SPACE if self.prefix else "") + head.replace(" ", SPACE))]
        for part in rest:
            parts += [self._spell(SPACE), self._plain(part.replace(" ", SPACE))]
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def _plain(self, text: str) -> bytes:
        known, words = self.known, self.words.findall(text)
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = self.older.get(w) or array("i", self.segment(w)).tobytes()
            return b"".join([known[w] for w in words])

    def _spell(self, char: str) -> bytes:
        return array("i", self._fallback(char)).tobytes()

    def _fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def segment(self, text: str) -> list[int]:
        """Ids of a text in which spaces are marks."""
        if self.singles.issuperset(text):
            return self._search(text)
        out: list[int] = []
        for run in self.strange.split(text):  # what has no piece of its own stands alone
            if len(run) == 1 and run not in self.singles:
                out += self._fallback(run)
            elif run:
                out += self._search(run)
        return out

    def _search(self, text: str) -> list[int]:
        """One pass over a text of known characters; best[e] is the last piece of the best way to e."""
        n = len(text)
        best, start = [-1] * (n + 1), [0] * (n + 1)
        best[0] = -2
        (self._relax_merges if self.kind == BPE else self._relax_scores)(text, best, start)
        out: list[int] = []
        while n:
            out.append(best[n])
            n = start[n]
        return out[::-1]

    def _relax_scores(self, text: str, best: list[int], start: list[int]) -> None:
        score = [0.0] * len(best)
        for last, (size, i, own, _) in self.automaton.iter(text):
            end = last + 1
            begin = end - size
            if best[begin] != -1 and (best[end] == -1 or score[begin] + own > score[end]):
                best[end], start[end], score[end] = i, begin, score[begin] + own

    def _relax_merges(self, text: str, best: list[int], start: list[int]) -> None:
        for last, (size, i, _, apart) in self.automaton.iter(text):
            end = last + 1
            if best[end] != -1:
                continue  # exactly one piece fits, and it is found
            begin = end - size
            before = best[begin]
            if before == -1:
                continue
            if begin:
                together = apart.get(before)
                if together is None:
                    together = apart[before] = self._stay_apart(before, i)
                if not together:
                    continue
            best[end], start[end] = i, begin

    def _stay_apart(self, left: int, right: int) -> bool:
        self.pairs += 1
        if self.pairs > self.memory:
            self.pairs = 0
            for _, _, _, apart in self.automaton.values():
                apart.clear()
        a, b = self.pieces[left][0], self.pieces[right][0]
        return self._merged(a + b) == [a, b]

    def _merged(self, text: str) -> list[str]:
        """Merges by best score, leftmost first; only ever asked for one piece or two."""
        parts = list(text)
        while len(parts) > 1:
            score, _, i = max(((self.rank[a + b][0], -i, i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank), default=(0, 0, -1))
            if i < 0:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


class Decoder:
    def __init__(self, model: dict):
        self.prefix = model["prefix"]
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() if k in (NORMAL, USER) else b"" for p, _, k in model["pieces"]]

    def decode(self, ids: list[int]) -> str:
        raw, n = self.raw, len(self.raw)
        try:
            out = b"".join([raw[i] for i in ids]) if not ids or min(ids) >= 0 else None
        except (IndexError, TypeError):
            out = None
        if out is None:
            out = b"".join([raw[i] for i in ids if i is not None and 0 <= i < n])
        if self.prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")


_encoders: dict[str, Pieces] = {}


def _encoder(shared, name: str) -> Pieces:
    """The worker's own encoder, kept with what it remembers from task to task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Pieces(shared.value)
    return _encoders[name]


# --- DataFrame operators -------------------------------------------------------------------------


def encode(documents: DataFrame, *, text_col: str = "text", ids_col: str = "ids", model_path: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """The frame's columns (or those in keep) and ids_col, an array of piece ids."""
    plain, names, of = numbered(documents)
    kept = names if keep is None else keep
    work = plain.select(of(text_col).alias("work"), *[of(n).alias(f"k{i}") for i, n in enumerate(kept)])
    model = load(model_path)
    shared, carried = documents.sparkSession.sparkContext.broadcast(model), work.columns[1:]
    name = hashlib.sha256(repr(model).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(shared, name)
        for batch in batches:
            for part in slices(batch, batch.column("work"), PART_BYTES):
                got = [pieces.encode(t or "") for t in part.column("work").to_pylist()]
                offsets = np.zeros(len(got) + 1, dtype=np.int32)
                np.cumsum([len(g) for g in got], out=offsets[1:])
                values = pa.array(np.concatenate(got) if got else np.zeros(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.ListArray.from_arrays(pa.array(offsets), values)], [*carried, "ids"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in work.schema.fields[1:]), "ids array<int>"])
    return work.mapInArrow(run, schema).toDF(*kept, ids_col)


def _lists(column: pa.ListArray) -> Iterator[list[int | None] | None]:
    if column.values.null_count:
        yield from column.to_pylist()
        return
    starts, flat = column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)
    for a, b, ok in zip(starts[:-1], starts[1:], column.is_valid().to_pylist(), strict=True):
        yield flat[a:b].tolist() if ok else None


def decode(rows: DataFrame, *, ids_col: str = "ids", text_col: str = "decoded", model_path: str = MODEL) -> DataFrame:
    """The frame's columns and text_col, the text of the ids."""
    plain, names, of = numbered(rows)
    work = plain.select(of(ids_col).cast("array<int>").alias("work"), *plain.columns)
    shared, carried = rows.sparkSession.sparkContext.broadcast(load(model_path)), work.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Decoder(shared.value)
        for batch in batches:
            for part in slices(batch, batch.column("work"), PART_BYTES):
                texts = [None if ids is None else pieces.decode(ids) for ids in _lists(part.column("work"))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())], [*carried, "decoded"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in work.schema.fields[1:]), "decoded string"])
    return work.mapInArrow(run, schema).toDF(*names, text_col)


def report(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids_sha256 and round_trip: whether decoding gives the text back.

    The text goes to Python once; what comes back from decoding is held against its hash.
    """
    docs = pick(documents, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
    coded = encode(docs, model_path=model_path, keep=["doc_id", "n_chars", "text_sha256"])
    back = decode(coded, model_path=model_path)
    return back.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))
