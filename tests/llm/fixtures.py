"""Awkward documents: nulls, empties, ties, repeats, a very long text, columns that clash."""

import random

LONG = "long text of many words and a number 12 " * 20_000
CLASH = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, spans string, fp string, TEXT string, c0 string, row string"


def awkward(spark, rows=None):
    texts = rows if rows is not None else [(1, "plain text here"), (2, None), (3, ""), (4, LONG), (5, "plain text here"), (5, "plain text here"), (None, "plain text here"), (None, None), (6, " \n\t"), (7, "a😀b▁c  é\u0000x")]
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 4}", len(t or ""), 0.5, "x", "y", "z", "other", "c", "r") for i, t in texts], CLASH)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["an", "the", "er", "in", "on", "re", "st", "ou", "ha", "ti", "en", "ch"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
