"""Text quality: windowed metrics, keep/drop verdict, off-subject titles.

Null text is measured as empty. Windows are the first 20,000 and 100,000 characters of the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.patterns import CJK, ENGLISH_WORDS, TITLE_GUARD, TITLE_KILL, TITLE_KILL_HARD, subject_pattern, words_pattern
from loamline.functions.text import body, chars_in, count, fold, java, let, strip

# The gate's thresholds.
SHORT_WINDOW, LONG_WINDOW = 20_000, 100_000
BOOK_MIN_CHARS = 120_000
BOOK_MIN_DENSITY = 8.0
SHORT_MIN_HITS = 10
MIN_CHARS = 2000
MIN_WORDS = 200
MIN_ALPHA, MIN_ALPHA_CJK, CJK_ALPHA_MIN_CHARS = 0.55, 0.45, 300


def window(text: Column, stems: list[str] | None = None) -> Column:
    """chars, alpha, words, cjk, en and domain of one window."""
    return let(F.struct(text.alias("text"), fold(text).alias("folded")), lambda x: _window(x["text"], x["folded"], stems))


def _window(text: Column, folded: Column, stems: list[str] | None) -> Column:
    letters = chars_in(text, r"\p{L}")
    return F.struct(
        F.length(strip(text)).cast("long").alias("chars"),
        F.when(F.length(text) > 0, F.bround(letters / F.length(text), 6)).otherwise(0.0).alias("alpha"),
        count(text, "[A-Za-z]{2,}").alias("words"),
        chars_in(text, CJK).alias("cjk"),
        count(folded, words_pattern(ENGLISH_WORDS)).alias("en"),
        count(folded, subject_pattern(stems)).alias("domain"),
    )


def metrics(text: Column, stems: list[str] | None = None) -> Column:
    """total, w20 and w100 of a body; a body within the short window is measured once."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.length(text).cast("long").alias("total"), window(F.substring(text, 1, SHORT_WINDOW), stems).alias("w20"), F.when(F.length(text) > SHORT_WINDOW, window(F.substring(text, 1, LONG_WINDOW), stems)).alias("w100"))


def whole(m: Column) -> Column:
    """Metrics with w100 filled in where it equals w20."""
    return F.struct(m["total"].alias("total"), m["w20"].alias("w20"), F.coalesce(m["w100"], m["w20"]).alias("w100"))


def is_booklike(ident: Column, fmt: Column) -> Column:
    return F.coalesce(fmt == "pdf", F.lit(False)) | F.coalesce(ident.startswith("arc-"), F.lit(False))


def verdict(m: Column, book: Column) -> Column:
    """ok, thin, garbage or off-topic; the first test that fails decides."""
    is_book = book & (m["total"] > BOOK_MIN_CHARS)
    pick = lambda name: F.when(is_book, m["w100"][name]).otherwise(m["w20"][name])
    words = pick("words") + F.floor(pick("cjk") / 2)
    floor = F.when(pick("cjk") >= CJK_ALPHA_MIN_CHARS, MIN_ALPHA_CJK).otherwise(MIN_ALPHA)
    off = F.when(is_book, 1000 * pick("domain") / words < BOOK_MIN_DENSITY).otherwise(pick("domain") < SHORT_MIN_HITS)
    return F.when(pick("chars") < MIN_CHARS, "thin").when(pick("alpha") < floor, "garbage").when(words < MIN_WORDS, "thin").when(off, "off-topic").otherwise("ok")


def assessed(docs: DataFrame, text_col: str, id_col: str | None = None, format_col: str | None = None) -> DataFrame:
    """The frame with quality (metrics of the body) and verdict."""
    ident = F.col(id_col) if id_col else F.lit("")
    fmt = F.col(format_col) if format_col else F.lit("pdf")
    measured = docs.withColumn("quality", metrics(body(F.col(text_col)))).withColumn("quality", whole(F.col("quality")))
    return measured.withColumn("verdict", verdict(F.col("quality"), is_booklike(ident, fmt)))


def off_domain_title(title: Column) -> Column:
    """Whether a patent's title alone shows it off the subject."""
    folded = fold(F.coalesce(title, F.lit("")))
    return folded.rlike("(?d)" + java(TITLE_KILL_HARD)) | (folded.rlike("(?d)" + java(TITLE_KILL)) & ~folded.rlike("(?d)" + java(TITLE_GUARD)))
