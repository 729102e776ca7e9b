"""Text normal forms as column expressions: all JVM-side, code-point based."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at a string's ends.
WHITE_SPACE = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
#: What a word boundary sees as part of a word.
WORD = r"[\p{L}\p{N}_]"
HEADER_END = "\n---\n\n"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def fold(text: Column) -> Column:
    """Lower case such that matching lower-case patterns equals matching without regard to case."""
    return F.lower(F.translate(text, "İıſ", "iis"))


def slug(text: Column) -> Column:
    dashed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def norm(text: Column) -> Column:
    """Title key: lower case, runs of non-word characters as one space, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+", " "), F.lit(" "))


def url_key(url: Column) -> Column:
    """All trailing slashes removed; null is empty."""
    return F.rtrim(F.coalesce(url, F.lit("")), F.lit("/"))


def blocklist_key(url: Column) -> Column:
    return F.rtrim(strip(F.coalesce(url, F.lit(""))), F.lit("/"))


def body(text: Column) -> Column:
    """What follows the first header separator, or everything where there is none."""
    at = F.locate(HEADER_END, text)
    return F.when(at > 0, F.substring(text, at + len(HEADER_END), F.length(text))).otherwise(text)


def header(text: Column) -> Column:
    at = F.locate(HEADER_END, text)
    return F.when(at > 0, F.substring(text, F.lit(1), at + len(HEADER_END) - 1)).otherwise("")


def render_header(title: Column, url: Column, license_: Column, topic: Column) -> Column:
    return F.concat(F.lit("# "), title, F.lit("\n\nsource: "), url, F.lit("\nlicense: "), license_, F.lit("\ntopic: "), topic, F.lit("\n\n---\n\n"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def tokens(chars: Column) -> Column:
    return F.floor(chars / 4).cast("long")


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def chars_in(text: Column, members: str) -> Column:
    """Number of characters of a class; members is the inside of a bracket expression."""
    return F.length(F.regexp_replace(text, f"[^{members}]+", "")).cast("long")


def native_id(title: Column) -> Column:
    """Slug of 40 characters, with a hash behind it where fewer than three are left."""
    short = F.rtrim(F.substring(slug(title), 1, 40), F.lit("-"))
    return F.when(F.length(short) < 3, F.btrim(F.concat(short, F.lit("-"), F.substring(F.sha1(title), 1, 10)), F.lit("-"))).otherwise(short)


def page_url(base: str, title: Column) -> Column:
    """Percent-encoded page address; slash and hash stay."""
    coded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%23", "#"), ("*", "%2A"), ("%7E", "~")):
        coded = F.replace(coded, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), coded)


def entry_id(source: Column, title: Column, size: int = 46) -> Column:
    return F.concat(F.substring(source, 1, 3), F.lit("-"), F.substring(slug(title), 1, size))


def entry_title(title: Column) -> Column:
    return F.substring(strip(title), 1, 150)


def previous_week(bucket: Column) -> Column:
    """YYYY-Wnn one week back; the first week of a year leads to week 52. Null for other strings."""
    year = F.regexp_extract(bucket, r"\A(\d{4})-W(\d{2})\z", 1)
    week = F.regexp_extract(bucket, r"\A(\d{4})-W(\d{2})\z", 2)
    back = F.when(week.cast("int") > 1, F.concat(year, F.lit("-W"), F.lpad((week.cast("int") - 1).cast("string"), 2, "0")))
    return F.when(year != "", F.coalesce(back, F.concat((year.cast("int") - 1).cast("string"), F.lit("-W52"))))


def big_number(n: Column) -> Column:
    return F.when(n >= 1e9, F.format_string("%.3fB", n / 1e9)).otherwise(F.concat(F.format_string("%.0f", F.bround(n / 1e6, 0)), F.lit("M")))


def host(url: Column) -> Column:
    """Lower-cased network location."""
    return F.lower(F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def java(pattern: str) -> str:
    """A pattern's word boundaries as look-arounds on Unicode letters and digits.

    A boundary at the beginning of an alternative looks back, any other looks ahead.
    """
    ahead = re.sub(r"(^|[|(])\\b", lambda m: f"{m[1]}(?<!{WORD})", pattern)
    return ahead.replace(r"\b", f"(?!{WORD})")
