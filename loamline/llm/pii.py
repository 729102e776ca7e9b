"""Personal data: exact base patterns, and a character model that adds spans they miss.

Base, leftmost and non-overlapping for each kind: e-mail addresses, IPv4 addresses, card numbers
(Luhn) and phone numbers. Method: a character-level bidirectional LSTM gives each character a score
for each tag (outside, or one of the kinds); CRF transitions join them. It is trained here in numpy,
by the exact gradient of the CRF likelihood, from labelled spans. Texts are cut into overlapping
windows, each is decoded by Viterbi, and all windows' spans of a text are reconciled together: the
set of spans without overlap that has the greatest total margin over "outside". A span that a window
cuts off is left to the next window. Added spans must hold up against their kind's rules, and none
touches a base span; base spans always stay.

A span that the rules accept holds a digit, an @ or "(at)", so windows without any of them are
passed over; windows are independent, hence this changes nothing in the result (the tests compare, on
spellings of every rule).

A span of fewer than ``WINDOW - STRIDE`` characters lies whole in some window. Where a window's edge
cuts off one of that length or more, the place is read again in windows of ``WIDE`` characters, half
of which they overlap; so added spans have ``WIDE / 2 - 1`` characters at most (an address may have 254,
and no other rule accepts more than 70). Base spans have no such bound.

Defined results: null reads as empty; empty texts have no span; texts are read whole at any length;
repeated rows give repeated rows; an empty table gives no rows. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import as_text, numbered, over_batches, pick, position, slices

KINDS = ["email", "ip", "card", "phone"]
WINDOW = 96
STRIDE = 48
WIDE = 1024
#: Bytes of text that a worker looks at together; a longer text is looked at alone.
PART_BYTES = 1 << 20
#: Labelled lines that the model is trained on, and passes over them.
TRAINING_LINES = 1500
EPOCHS = 16
HIDDEN = 16
EMBEDDED = 12

# The base patterns. Their guards keep a failing start from being read again and again.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _is_card(text: str, least: int = 14) -> bool:
    digits = _digits(text)
    return least <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches, found from each @ to both sides, so that no run is read twice."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and m.start() >= done:
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if _is_card(m.group())]
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# --- the character model -------------------------------------------------------------------------

_PUNCTUATION = " \n\t.,:;-_+()[]{}<>@/\\'\"#*%&=|!?$~"
SYMBOLS = 26 + 1 + 1 + len(_PUNCTUATION) + 1


def _code(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 97
    if "A" <= char <= "Z":
        return 26
    if "0" <= char <= "9":
        return 27
    at = _PUNCTUATION.find(char)
    return 28 + at if at >= 0 else SYMBOLS - 1


_CODES = np.array([_code(chr(c)) for c in range(256)], dtype=np.int64)


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _CODES[np.where(points < 256, points, 255)]


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer, CRF transitions."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN, embedded: int = EMBEDDED):
        rng = np.random.default_rng(seed)
        tags = len(KINDS) + 1
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"E": draw(SYMBOLS, embedded) * 3, "O": draw(2 * hidden, tags), "b": np.zeros(tags, np.float32), "T": np.zeros((tags, tags), np.float32)}
        for side in "fr":
            self.p[f"W{side}"] = draw(embedded, 4 * hidden)
            self.p[f"U{side}"] = draw(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1.0  # gates: input, forget, output, cell
            self.p[f"B{side}"] = bias

    # Both directions run as one, side by side: index 0 reads forwards, index 1 backwards.
    def _run(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states (time, 2, batch, hidden) of x (time, 2, batch, embedded), and what the way back needs."""
        size, (steps, _, batch, _) = self.hidden, x.shape
        h, c = np.zeros((2, batch, size), np.float32), np.zeros((2, batch, size), np.float32)
        u = np.stack([self.p["Uf"], self.p["Ur"]])
        ahead = np.stack([x[:, k] @ self.p[f"W{side}"] + self.p[f"B{side}"] for k, side in enumerate("fr")], axis=1)
        half = np.repeat(np.array([0.5, 1.0], np.float32), [3 * size, size])
        out, kept = np.empty((steps, 2, batch, size), np.float32), []
        for t in range(steps):
            squeezed = np.tanh((ahead[t] + h @ u) * half)  # a gate's sigmoid is a tanh of half, moved
            gates, cell = 0.5 + 0.5 * squeezed[..., : 3 * size], squeezed[..., 3 * size :]
            i, f, o = gates[..., :size], gates[..., size : 2 * size], gates[..., 2 * size :]
            new_c = f * c + i * cell
            squashed = np.tanh(new_c)
            m = mask[t][..., None]
            kept.append((h, c, i, f, o, cell, squashed, m))
            h, c = m * (o * squashed) + (1 - m) * h, m * new_c + (1 - m) * c
            out[t] = h
        return out, kept

    def _back(self, x: np.ndarray, kept: list, grad_out: np.ndarray, grads: dict) -> np.ndarray:
        size, (steps, _, batch, _) = self.hidden, x.shape
        dh, dc = np.zeros((2, batch, size), np.float32), np.zeros((2, batch, size), np.float32)
        dz_all, h_all = np.empty((steps, 2, batch, 4 * size), np.float32), np.empty((steps, 2, batch, size), np.float32)
        u = np.stack([self.p["Uf"].T, self.p["Ur"].T])
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, cell, squashed, m = kept[t]
            dh = dh + grad_out[t]
            d_h, d_c = m * dh, m * dc
            do = d_h * squashed
            d_c = d_c + d_h * o * (1 - squashed * squashed)
            dz = np.concatenate([d_c * cell * i * (1 - i), d_c * c * f * (1 - f), do * o * (1 - o), d_c * i * (1 - cell * cell)], axis=2)
            dz_all[t], h_all[t] = dz, h
            dh, dc = (1 - m) * dh + dz @ u, (1 - m) * dc + d_c * f
        out = np.empty_like(x)
        for k, side in enumerate("fr"):
            flat = dz_all[:, k].reshape(-1, 4 * size)
            grads[f"U{side}"] += h_all[:, k].reshape(-1, size).T @ flat
            grads[f"W{side}"] += x[:, k].reshape(-1, x.shape[3]).T @ flat
            grads[f"B{side}"] += flat.sum(axis=0)
            out[:, k] = dz_all[:, k] @ self.p[f"W{side}"].T
        return out

    def emissions(self, codes: np.ndarray, mask: np.ndarray, keep: bool = False):
        """(time, batch, tags) scores of codes (time, batch)."""
        x = self.p["E"][codes]
        x = np.stack([x, x[::-1]], axis=1)
        states, kept = self._run(x, np.stack([mask, mask[::-1]], axis=1))
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        scores = both @ self.p["O"] + self.p["b"]
        return (scores, x, both, kept) if keep else scores

    def step(self, codes: np.ndarray, tags: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the CRF, and its gradient, by scaled forward and backward sums."""
        scores, x, both, kept = self.emissions(codes, mask, keep=True)
        steps, batch, size = scores.shape
        trans = self.p["T"].astype(np.float64)
        ways = np.exp(trans)
        top = scores.max(axis=2, keepdims=True).astype(np.float64)
        likes = np.exp(scores - top)
        alpha, beta, scale = np.empty((steps, batch, size)), np.ones((steps, batch, size)), np.ones((steps, batch, 1))
        alpha[0] = likes[0]
        for t in range(steps):
            if t:
                on = mask[t][:, None] > 0
                alpha[t] = np.where(on, (alpha[t - 1] @ ways) * likes[t], alpha[t - 1])
            scale[t] = alpha[t].sum(axis=1, keepdims=True)
            alpha[t] /= scale[t]
        for t in range(steps - 2, -1, -1):
            on = mask[t + 1][:, None] > 0
            beta[t] = np.where(on, ((beta[t + 1] * likes[t + 1]) @ ways.T) / scale[t + 1], beta[t + 1])
        total = ((np.log(scale) + top)[:, :, 0] * mask).sum(axis=0)
        after = beta[1:] * likes[1:] / scale[1:] * mask[1:, :, None]
        d_trans = (alpha[:-1].reshape(-1, size).T @ after.reshape(-1, size)) * ways
        gold = np.eye(size)[tags] * mask[:, :, None]
        moved = mask[1:].astype(np.float64)
        np.add.at(d_trans, (tags[:-1], tags[1:]), -moved)
        likely = (scores * gold).sum(axis=(0, 2)) + (trans[tags[:-1], tags[1:]] * moved).sum(axis=0)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_scores = ((alpha * beta * mask[:, :, None] - gold) / batch).astype(np.float32)
        grads["T"] = (d_trans / batch).astype(np.float32)
        grads["b"] = d_scores.sum(axis=(0, 1))
        grads["O"] = both.reshape(-1, both.shape[2]).T @ d_scores.reshape(-1, size)
        d_both = d_scores @ self.p["O"].T
        h = self.hidden
        dx = self._back(x, kept, np.stack([d_both[:, :, :h], d_both[::-1, :, h:]], axis=1), grads)
        dx = dx[:, 0] + dx[::-1, 1]
        np.add.at(grads["E"], codes.reshape(-1), dx.reshape(-1, dx.shape[2]))
        return float((total - likely).mean()), grads

    def fit(self, lines: list[tuple[str, list[Span]]], epochs: int = EPOCHS, batch: int = 96, rate: float = 0.04, seed: int = 11) -> list[float]:
        """Adam over windows of the labelled lines; returns each epoch's mean loss."""
        windows = []
        for text, spans in lines:
            codes, tags = encode(text), np.zeros(len(text), np.int64)
            for kind, a, b in spans:
                tags[a:b] = kind + 1
            windows += [(codes[a : a + WINDOW], tags[a : a + WINDOW]) for a in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE) if len(text)]
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, n = [], 0
        for epoch in range(epochs):
            order, loss = rng.permutation(len(windows)), []
            for a in range(0, len(order), batch):
                part = [windows[i] for i in order[a : a + batch]]
                codes, mask = _pad([c for c, _ in part])
                tags, _ = _pad([t for _, t in part])
                value, grads = self.step(codes, tags, mask)
                loss.append(value)
                n += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (0.5 ** (epoch // max(1, epochs // 3))) * min(1.0, 5.0 / (size + 1e-9))
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(loss)))
        return losses

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, margin) of each window text, by Viterbi."""
        out: list[list[tuple[int, int, int, float]]] = []
        for a in range(0, len(texts), 256):
            part = texts[a : a + 256]
            codes, mask = _pad([encode(t) for t in part])
            scores = self.emissions(codes, mask)
            best, back = scores[0], []
            for t in range(1, len(scores)):
                ways = best[:, :, None] + self.p["T"]
                back.append(ways.argmax(axis=1))
                new = ways.max(axis=1) + scores[t]
                best = np.where(mask[t][:, None] > 0, new, best)
            tag = best.argmax(axis=1)
            path = np.zeros(scores.shape[:2], np.int64)
            path[-1] = tag
            for t in range(len(scores) - 2, -1, -1):
                before = back[t][np.arange(len(part)), tag]
                tag = np.where(mask[t + 1] > 0, before, tag)
                path[t] = tag
            for i, text in enumerate(part):
                tags, spans, t = path[: len(text), i], [], 0
                while t < len(text):
                    if tags[t]:
                        end = t
                        while end < len(text) and tags[end] == tags[t]:
                            end += 1
                        margin = float((scores[t:end, i, tags[t]] - scores[t:end, i, 0]).sum())
                        spans.append((int(tags[t]) - 1, t, end, margin))
                        t = end
                    else:
                        t += 1
                out.append(spans)
        return out


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    out, mask = np.zeros((steps, len(rows)), np.int64), np.zeros((steps, len(rows)), np.float32)
    for i, r in enumerate(rows):
        out[: len(r), i], mask[: len(r), i] = r, 1.0
    return out, mask


# --- labelled lines ------------------------------------------------------------------------------


def labelled_lines(n: int = TRAINING_LINES, seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Lines of invented words with personal data of many spellings, and numbers that are none."""
    rng = np.random.default_rng(seed)
    pick_one = lambda options: options[int(rng.integers(len(options)))]
    number = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    syllables = "an the er in on re st ou ha ti en ch ie la co que ment ung ci ar es to mo vi ra be no".split()
    word = lambda: "".join(pick_one(syllables) for _ in range(int(rng.integers(1, 4))))

    def card() -> str:
        digits = number(15)
        last = next(c for c in "0123456789" if luhn(digits + c))
        mark = pick_one(["", " ", "-", ".", "  "])
        digits += last
        return mark.join(digits[i : i + 4] for i in range(0, 16, 4))

    def make(kind: int) -> str:
        if kind == 0:
            user = word() + pick_one(["", ".", "_"]) + pick_one([word(), number(2), ""])
            user = user.rstrip("._")
            at, dot = pick_one([("@", "."), ("@", "."), (" @ ", "."), (" @ ", " . "), ("[@]", "."), ("(at)", "."), (" (at) ", ".")])
            return user + at + pick_one([word(), "mail" + number(1)]) + dot + pick_one(["com", "org", "net", "example.com"])
        if kind == 1:
            mark = pick_one([".", ".", " . ", "[.]"])
            return mark.join(str(int(x)) for x in rng.integers(0, 256, 4))
        if kind == 2:
            return card()
        area, mid, end = number(3), number(3), number(4)
        return pick_one([f"+1 ({area}) {mid}-{end}", f"({area}) {mid}-{end}", f"+{number(2)} {area} {mid} {end}", f"00{number(2)} {area} {mid} {end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}"])

    def other() -> str:
        return pick_one([number(int(rng.integers(1, 7))), f"{number(1)}.{number(1)}", f"v{number(1)}.{number(1)}.{number(2)}", f"20{number(2)}-0{number(1)}-1{number(1)}", f"{number(2)}:{number(2)}", f"${number(3)}.{number(2)}", number(22), "".join(pick_one("0123456789abcdef") for _ in range(32)), f"#{number(3)}", f"({number(1)})", f"{number(2)} | {number(3)} | {number(2)}"])

    lines = []
    for _ in range(n):
        parts, spans, at = [], [], 0
        for _ in range(int(rng.integers(8, 18))):
            draw = rng.random()
            kind = int(rng.integers(4)) if draw < 0.12 else None
            piece = make(kind) if kind is not None else other() if draw < 0.24 else word()
            if kind is not None:
                spans.append((kind, at, at + len(piece)))
            elif draw > 0.9:
                piece = piece.capitalize()
            glue = pick_one([" ", " ", " ", " ", ", ", ". ", "\n", "### ", " (", ": "])
            parts += [piece, glue]
            at += len(piece) + len(glue)
        lines.append(("".join(parts), spans))
    return lines


@lru_cache(maxsize=4)
def trained(lines: int = TRAINING_LINES, epochs: int = EPOCHS) -> Tagger:
    tagger = Tagger()
    tagger.fit(labelled_lines(lines), epochs)
    return tagger


# --- windows, rules, reconciliation --------------------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]|\(at\)")
# Rules for the spans that the model adds.
_RULES = [
    re.compile(r"[A-Za-z0-9._%+-]+(?: @ |@|\[@\]| ?\(at\) ?)[A-Za-z0-9-]+(?:(?: \. |\.)[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]{1,3}(?:(?: \. |\[\.\]|\.)[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ .-]{0,2}[0-9])+"),
    re.compile(r"(?:\+|00)?[ (]{0,2}[0-9](?:[ ().-]{0,2}[0-9])+"),
]


def _holds(kind: int, text: str) -> bool:
    if not _RULES[kind].fullmatch(text):
        return False
    if kind == 1:
        return all(_byte(p) for p in re.findall("[0-9]+", text))
    if kind == 2:
        return _is_card(text, 13)
    return kind != 3 or (10 <= len(_digits(text)) <= 15 and any(c in "+-(). " for c in text))


def windows_of(text: str, every: bool = False) -> list[int]:
    """Starts of the windows that hold what a rule asks for (or of all)."""
    if every:
        return list(range(0, max(1, len(text)), STRIDE))
    out: list[int] = []
    for m in _TRIGGER.finditer(text):
        last = m.start() // STRIDE
        for k in range(max(0, (m.start() - WINDOW) // STRIDE + 1), last + 1):
            if not out or k * STRIDE > out[-1]:
                out.append(k * STRIDE)
    return out


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[Span]:
    """The spans without overlap of greatest total margin, from all windows of a text."""
    unique: dict[Span, float] = {}
    for kind, a, b, margin in spans:
        unique[kind, a, b] = max(margin, unique.get((kind, a, b), margin))
    order = sorted(unique, key=lambda s: (s[2], s[1], s[0]))
    best: list[tuple[float, int, int]] = [(0.0, -1, 0)]  # total, span taken, how many spans before it
    ends: list[int] = []
    for n, s in enumerate(order):
        low, high = 0, len(ends)
        while low < high:  # spans that end by this one's start
            mid = (low + high) // 2
            low, high = (mid + 1, high) if ends[mid] <= s[1] else (low, mid)
        taken = best[low][0] + max(unique[s], 1e-6)
        best.append((taken, n, low) if taken > best[-1][0] else (best[-1][0], -1, n))
        ends.append(s[2])
    out, at = [], len(order)
    while at:
        _, n, before = best[at]
        if n >= 0:
            out.append(order[n])
        at = before
    return out[::-1]


def find(texts: list[str], tagger: Tagger, every: bool = False) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    seen: dict[int, list[tuple[int, int, int, float]]] = {}
    cut = _read(texts, [(i, a) for i, text in enumerate(texts) for a in windows_of(text, every)], WINDOW, tagger, seen)
    half = WIDE // 2
    again = {(i, k * half) for i, a, b in cut if b - a >= WINDOW - STRIDE - 1 for k in range(max(0, a // half - 1), b // half + 1)}
    _read(texts, sorted(again), WIDE, tagger, seen)
    out = []
    for i, spans in enumerate(base):
        added = [s for s in reconcile(seen.get(i, [])) if not any(s[1] < b and a < s[2] for _, a, b in spans)] if i in seen else []
        out.append((spans, sorted(spans + added, key=lambda s: (s[1], s[0], s[2]))))
    return out


def _read(texts: list[str], places: list[tuple[int, int]], size: int, tagger: Tagger, seen: dict[int, list]) -> list[tuple[int, int, int]]:
    """Adds what holds up in the windows at (text, start) to seen; returns (text, start, end) of what an edge cuts off."""
    cut = []
    for at in range(0, len(places), 256):
        part = places[at : at + 256]
        for (i, a), spans in zip(part, tagger.decode([texts[i][a : a + size] for i, a in part]), strict=True):
            for kind, b, e, margin in spans:
                b, e = _trim(texts[i], a + b, a + e)
                if (b == a and a > 0) or (e == a + size and e < len(texts[i])):
                    cut.append((i, b, e))
                elif b < e and e - b < WIDE // 2 and _holds(kind, texts[i][b:e]):
                    seen.setdefault(i, []).append((kind, b, e, margin))
    return cut


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a].isspace():
        a += 1
    while a < b and text[b - 1].isspace():
        b -= 1
    return a, b


# --- DataFrame operators -------------------------------------------------------------------------


def _shared(df: DataFrame):
    return df.sparkSession.sparkContext.broadcast(trained().p)


def _tagger(weights: dict) -> Tagger:
    out = object.__new__(Tagger)
    out.p, out.hidden = weights, weights["Uf"].shape[0]
    return out


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end)."""
    docs = pick(documents, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = _shared(documents)
    listed = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def step(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices(whole, whole.column("text"), PART_BYTES):
            found = find(as_text(batch.column("text")), _tagger(shared.value))
            columns = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in f[side]] for f in found], listed) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return over_batches(docs, step, f"doc_id {kind}, base {spans}, spans {spans}")


def mask(documents: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with each span replaced by its kind in brackets; all columns stay.

    Where spans overlap, they are replaced together by the first one's kind. A null text stays null.
    length_col, where there is such a column, becomes the new text's length.
    """
    plain, names, _ = numbered(documents)
    at = position(names, text_col)
    lower = [n.lower() for n in names]
    counted = lower.index(length_col.lower()) if length_col and length_col.lower() in lower else None
    kinds = [f.dataType.simpleString() for f in plain.schema.fields]
    shared, carried = _shared(documents), plain.columns

    def step(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices(whole, whole.column(at), PART_BYTES):
            texts = batch.column(at).to_pylist()
            masked = [t if t is None else redact(t, spans) for t, (_, spans) in zip(texts, find([t or "" for t in texts], _tagger(shared.value)), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(masked, pa.string())
            if counted is not None:
                columns[counted] = pa.array([None if t is None else len(t) for t in masked]).cast(batch.column(counted).type)
            yield pa.RecordBatch.from_arrays(columns, carried)

    schema = ", ".join(f"{c} {k}" for c, k in zip(plain.columns, kinds, strict=True))
    return over_batches(plain, step, schema).toDF(*names)


def redact(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def report(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns, from what :func:`scan` found."""
    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = scan(documents, id_col=id_col, text_col=text_col)
    return found.select("doc_id", *map(counted, KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def brute_force(text: str) -> list[Span]:
    """Base spans by the patterns as the contract states them; for small fixtures."""
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    tests = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: _is_card(m), lambda m: 10 <= len(_digits(m)) <= 15]
    out = [(k, *m.span()) for k, p in enumerate(patterns) for m in re.finditer(p, text) if tests[k](m.group())]
    return sorted(out, key=lambda s: (s[1], s[0]))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
