"""Toxicity: classification by compression distance with two zstandard dictionaries.

Method: one dictionary is trained on toxic text, one on ordinary text. A text is cut into overlapping
windows; each window is compressed with either dictionary, and how many bytes fewer the toxic one
needs is its distance. A few statistics of a text's distances (the largest, the share and number
of large ones) go into a logistic calibration that gives a score from 0 to 1.

The dictionaries share a part, trained by zstandard on ordinary text, so that plain prose costs the same
under both; their own parts hold what sets a class apart: pieces of words whose short byte sequences
stand once, or twice, in far more of that class's training texts than of the other's. The comparison
is made within groups of texts alike in their byte pairs (in practice: languages), and added up over
them, so that a language with few toxic texts counts by its own texts only. A piece stands in
``LEAST_TEXTS`` training texts at least; all such pieces are taken. Every window starts with a phrase
that both dictionaries hold, since zstandard stores a short text as it is unless much of it matches.

Labels are learned from a bounded sample: at most ``MOST_TOXIC`` and ``MOST_ORDINARY`` labelled
rows, chosen by a hash of their id, each with its whole text. A part of each
group trains the dictionaries and the rest the calibration. The score is a function of the text alone.

Defined results: null and empty texts are scored like a text without windows; a row without doc_id
is scored and never trained on; a doc_id with labels that disagree, or repeated in the documents, is
not trained on unless all agree; without any toxic or any ordinary training row the score is the
toxic share of the training rows (0 if there are none); repeated rows give repeated rows. Texts are
scored whole at any length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import as_bytes, numbered, pick, position

THRESHOLD = 0.7
MOST_TOXIC = 1500
MOST_ORDINARY = 3000
#: Share of the training texts that the dictionaries are trained on; the others calibrate.
DICTIONARY_SHARE = 0.6

WINDOW = 48
STRIDE = 34
LEVEL = 6
LEAST_MATCH = 6
SHARED_BYTES = 4096
#: Texts are cut into samples of so many bytes for zstandard's trainer.
SAMPLE = 512
#: Bytes of the shared part that every window starts with.
ANCHOR = 24
#: Lengths of the byte sequences that are counted, and how often they stand in a text at least.
GRAMS = (5, 7)
TIMES = (1, 2)
LEAST_TEXTS = 3
#: Groups of texts alike, and hashed byte pairs by which they are told.
GROUPS = 6
LEAST_GROUP = 20
PAIRS = 1021
#: A dictionary's own part: how much more usual (natural logarithm), and by how many standard
#: errors beyond the most that chance would reach among so many sequences.
CONTRAST = 2.0
ERRORS = 0.75
FEATURES = 8


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float
    #: Centers of the groups; mean and deviation of the distance, and share of large ones, in ordinary texts of each.
    centers: np.ndarray = np.zeros((1, PAIRS))
    usual: np.ndarray = np.zeros((1, 3))


def _squeezed(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    # a window's literals are too few to be coded, so sizes differ by matches only
    parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=LEAST_MATCH, strategy=zstandard.STRATEGY_LAZY, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    shared = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=parameters)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.ready = bool(model.toxic)
        if self.ready:
            self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)
            self.anchor = model.ordinary[-ANCHOR:]

    def distances(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        return self._distances(_squeezed(text))

    def _distances(self, text: bytes) -> np.ndarray:
        if not text:
            return np.zeros(0)
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        out = []
        for a in range(0, max(1, len(text) - (WINDOW - STRIDE)), STRIDE):
            window = self.anchor + text[a : a + WINDOW]
            out.append(len(ordinary(window)) - len(toxic(window)))
        return np.array(out, dtype=np.float64)

    def features(self, text: bytes) -> np.ndarray:
        """How far a text's distances lie above those of ordinary texts of its group, and how many are large."""
        text = _squeezed(text)
        d = -np.sort(-self._distances(text))
        n, most, mean, large = len(d), d[0] if len(d) else 0.0, d.mean() if len(d) else 0.0, float((d >= 2).sum())
        usual, spread, share = self.model.usual[int((self.model.centers @ _profile(text)).argmax())]
        above = max((mean - usual) / (spread + 0.04), -2.0)
        more = max((large - n * share) / np.sqrt(n * share + 0.5), -2.0)
        return np.array([min(above, 6.0), min(more, 6.0), min(above, 3.0), min(more, 3.0), min(large, 2.0), min(large, 4.0), most, np.log1p(n)])

    def score(self, text: bytes) -> float:
        m = self.model
        if not self.ready:
            return m.prior
        x = np.append((self.features(text) - m.center) / m.spread, 1.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(x @ m.weights, -30, 30))))


# --- training ------------------------------------------------------------------------------------


def _grams(word: bytes) -> Iterator[tuple[int, bytes]]:
    """(start, byte sequence) in a word between blanks."""
    return ((i, word[i : i + n]) for n in GRAMS for i in range(len(word) - n + 1))


def _profile(text: bytes) -> np.ndarray:
    """Roots of the frequencies of a text's byte pairs, hashed, of length 1."""
    b = np.frombuffer(text, np.uint8).astype(np.int64)
    pairs = np.sqrt(np.bincount((b[:-1] * 256 + b[1:]) % PAIRS, minlength=PAIRS))
    return pairs / max(np.linalg.norm(pairs), 1e-9)


def _centers(plain: np.ndarray) -> np.ndarray:
    """Groups of the ordinary texts' profiles, by k-means from a seeded start.

    Toxic texts join the nearest group: what sets them apart makes no group of its own.
    """
    rng = np.random.RandomState(3)
    centers = plain[[rng.randint(len(plain))]]
    while len(centers) < GROUPS:
        far = np.maximum(1 - (plain @ centers.T).max(axis=1), 1e-9) ** 2
        centers = np.vstack([centers, plain[rng.choice(len(plain), p=far / far.sum())]])
    for _ in range(15):
        group = (plain @ centers.T).argmax(axis=1)
        for k in set(group.tolist()):
            mean = plain[group == k].mean(axis=0)
            centers[k] = mean / max(np.linalg.norm(mean), 1e-9)
    return centers


def _of_group(scorer: Scorer, texts: list[bytes]) -> np.ndarray:
    """Mean and deviation of the distance and share of large ones, by group; of all where a group has few texts."""
    group = np.array([int((scorer.model.centers @ _profile(t)).argmax()) for t in texts])
    found = [scorer.distances(t) for t in texts]
    rows = np.array([[d.mean(), (d >= 2).mean()] if len(d) else [0.0, 0.0] for d in found])
    out = []
    for k in range(GROUPS):
        some = rows[group == k] if (group == k).sum() >= LEAST_GROUP else rows
        out.append([some[:, 0].mean(), some[:, 0].std(), some[:, 1].mean()])
    return np.array(out)


def _keys(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte sequences inside a text's words, as numbers that start with their length; and how often each stands."""
    b = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint64)
    blank = b == ord(" ")
    out = []
    for n in GRAMS:
        last = len(b) - n + 1
        if last > 0:
            key, within = np.full(last, n, np.uint64), np.ones(last, bool)
            for i in range(n):
                key = (key << np.uint64(8)) | b[i : i + last]
                within &= ~blank[i : i + last] if 0 < i < n - 1 else True
            out.append(key[within])
    return np.unique(np.concatenate(out), return_counts=True) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _usual(texts: list[bytes], labels: np.ndarray, centers: np.ndarray) -> dict[int, set[bytes]]:
    """Byte sequences that set each class apart, by a test within groups that is added up over them."""
    of_text = labels * GROUPS + np.array([int((centers @ _profile(t)).argmax()) for t in texts])
    counted = [_keys(text) for text in texts]
    n = np.bincount(of_text, minlength=2 * GROUPS).reshape(2, GROUPS).astype(np.float64)
    out: dict[int, set[bytes]] = {0: set(), 1: set()}
    for least in TIMES:
        stands = [key[count >= least] for key, count in counted]
        names, at = np.unique(np.concatenate(stands), return_inverse=True)
        cell = np.repeat(of_text, [len(x) for x in stands])
        kept = np.flatnonzero(np.bincount(at, minlength=len(names)) >= LEAST_TEXTS)
        new = np.full(len(names), -1)
        new[kept] = np.arange(len(kept))
        at = new[at]
        seen = np.bincount(at[at >= 0] * 2 * GROUPS + cell[at >= 0], minlength=len(kept) * 2 * GROUPS).reshape(-1, 2, GROUPS)
        for label, apart in _apart(seen.astype(np.float64), n).items():
            out[label] |= {int(x).to_bytes(8, "big").lstrip(b"\0")[1:] for x in names[kept[apart]]}
    return out


def _apart(seen: np.ndarray, n: np.ndarray) -> dict[int, np.ndarray]:
    """For each class, which events set it apart: texts with the event and all texts, by class and group."""
    every = np.maximum(n.sum(axis=0), 1)
    total = seen.sum(axis=1)
    error = np.sqrt((total * (every - total) * n[0] * n[1] / (every**2 * np.maximum(every - 1, 1))).sum(axis=1) + 0.25)
    errors = (seen[:, 1] - total * n[1] / every).sum(axis=1) / error
    least = np.sqrt(2 * np.log(max(len(seen), 2))) + ERRORS
    half = 0.5 * (n[0] * n[1] / every).sum()
    more = np.log((seen[:, 1] * n[0] / every).sum(axis=1) + half / n[1].sum()) - np.log((seen[:, 0] * n[1] / every).sum(axis=1) + half / n[0].sum())
    return {label: (sign * more > CONTRAST) & (sign * errors > least) & (seen[:, label].sum(axis=1) >= LEAST_TEXTS) for label, sign in ((0, -1), (1, 1))}


def _pieces(texts: list[bytes], usual: set[bytes]) -> list[bytes]:
    """The longest pieces of words covered by the given byte sequences, the most usual first."""
    of_word: dict[bytes, list[bytes]] = {}

    def covered(word: bytes) -> list[bytes]:
        marks = bytearray(len(word))
        for i, g in _grams(word):
            if g in usual:
                marks[i : i + len(g)] = b"\1" * len(g)
        out, start = [], None
        for i, mark in enumerate(bytes(marks) + b"\0"):
            if mark and start is None:
                start = i
            elif not mark and start is not None:
                out.append(word[start:i])
                start = None
        return out

    pieces: Counter = Counter()
    for text in texts:
        found = set()
        for word in set(text.split()):
            if word not in of_word:
                of_word[word] = covered(b" " + word + b" ")
            found.update(of_word[word])
        pieces.update(found)
    out: list[bytes] = []
    for piece, count in sorted(pieces.items(), key=lambda x: (-x[1], x[0])):
        if count >= LEAST_TEXTS and len(piece) >= LEAST_MATCH and not any(piece in have for have in out):
            out.append(piece)
    return out


def _content(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary that zstandard trains; too few samples are taken as they are."""
    try:
        trained = zstandard.train_dictionary(size + 256, samples, k=64, d=8)
    except zstandard.ZstdError:
        return b"".join(samples)[:size]
    return trained.as_bytes()[256:]  # the first 256 bytes at most are entropy tables


def train(rows: list[tuple[bytes, int]]) -> Model:
    """Dictionaries and calibration from (text, toxic 0 or 1), taken in the given order."""
    empty = Model(b"", b"", np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), 0.0)
    texts = {label: [_squeezed(t) for t, y in rows if y == label] for label in (0, 1)}
    total = len(texts[0]) + len(texts[1])
    if not texts[0] or not texts[1]:
        return empty._replace(prior=len(texts[1]) / total if total else 0.0)
    centers = _centers(np.array([_profile(t) for t in texts[0]]))
    learn, held = {}, {}
    for label, some in texts.items():
        learn[label], held[label] = _dealt(some, centers)
    base = _content([t[a : a + SAMPLE] for t in learn[0] for a in range(0, len(t), SAMPLE)], SHARED_BYTES)
    usual = _usual(learn[0] + learn[1], np.array([label for label in (0, 1) for _ in learn[label]]), centers)
    own = {label: b"".join(reversed(_pieces(learn[label], usual[label]))) for label in (0, 1)}
    model = empty._replace(toxic=own[1] + base, ordinary=own[0] + base, prior=len(texts[1]) / total, centers=centers)
    if not model.toxic or not model.ordinary:
        return empty._replace(prior=model.prior)
    model = model._replace(usual=_of_group(Scorer(model), held[0]))
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for label in (0, 1) for t in held[label]])
    y = np.array([label for label in (0, 1) for _ in held[label]], dtype=np.float64)
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    return model._replace(center=center, spread=spread, weights=_logistic((x - center) / spread, y))


def _dealt(texts: list[bytes], centers: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """The texts that train dictionaries, and those that calibrate: the same share of each group."""
    group = np.array([int((centers @ _profile(t)).argmax()) for t in texts])
    place = np.zeros(len(texts))
    for k in range(GROUPS):
        place[group == k] = (np.arange((group == k).sum()) + 0.5) / max(1, (group == k).sum())
    first = place < DICTIONARY_SHARE
    learn, held = ([t for t, x in zip(texts, first, strict=True) if x == side] for side in (True, False))
    return learn or texts, held or texts


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge on all weights but the last, the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_id_col: str, label_col: str) -> list[tuple[bytes, int]]:
    """The bounded sample of labelled rows, in the order of a hash of their ids."""
    known = pick(labels, doc_id=label_id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("y"), F.max("toxic").alias("z")).where("y = z and y in (0, 1)").select("doc_id", F.col("y").cast("int").alias("y"))
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.col("doc_id")]
    chosen = known.where("y = 1").orderBy(*order).limit(MOST_TOXIC).unionAll(known.where("y = 0").orderBy(*order).limit(MOST_ORDINARY))
    ids = [(r[0], r[1]) for r in chosen.collect()]
    if not ids:
        return []
    wanted = documents.sparkSession.createDataFrame(ids, chosen.schema).coalesce(1)
    docs = pick(documents, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    found = docs.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"), F.max("text").alias("last")).where("text = last")
    rows = {r[0]: (r[1].encode(), r[2]) for r in found.select("doc_id", "text", "y").collect()}
    return [rows[i] for i, _ in ids if i in rows]


def fit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    return train(training_rows(documents, labels, id_col=id_col, text_col=text_col, label_id_col=label_id_col, label_col=label_col))


def scored(documents: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The frame's columns (or those in keep) as c0, c1, ..., and score."""
    plain, names, _ = numbered(documents)
    at = position(names, text_col)
    kept = list(range(len(names))) if keep is None else [position(names, n) for n in keep]
    if at not in kept:
        plain = plain.select(*[f"c{i}" for i in kept], f"c{at}")
        at = len(kept)
    else:
        plain = plain.select(*[f"c{i}" for i in kept])
        at = kept.index(at)
    fields = plain.schema.fields[: len(kept)]
    shared, out_names = documents.sparkSession.sparkContext.broadcast(model), [*(f.name for f in fields), "score"]
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = [scorer.score(t) for t in as_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(scores, pa.float64())], out_names)

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), "score double"])
    return plain.mapInArrow(run, schema)


def report(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns."""
    model = fit(documents, labels, id_col=id_col, text_col=text_col)
    out = scored(documents, model, text_col=text_col, keep=[id_col]).toDF("doc_id", "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns, unchanged."""
    model = fit(documents, labels, id_col=id_col, text_col=text_col)
    return scored(documents, model, text_col=text_col).where(F.col("score") < threshold).drop("score").toDF(*documents.columns)
