"""Cleaning by line rules, with every dropped line attributed to the first rule that claims it.

A document's lines are an array within its row, so cleaning is a narrow map: nothing is shuffled, and
rows that share an id do not meet. The shape of a line is a column expression; what depends on other
lines looks at neighbours in sorted arrays, so a document of n lines takes about n log n steps. A
document without a claimed line keeps its text unchanged; one with claims has its remaining blank
runs collapsed to a single blank line.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import body, chars_in, header, let, sha256, strip

# The rules in canonical order, and what each is for.
RULES = {
    "repeated_boilerplate": "lines that recur four times or more within a document",
    "toc_leaders": "contents entries with dot leaders",
    "page_markers": "lines that are a page number only",
    "orphan_chars": "lines of one or two characters",
    "patent_id_soup": "runs of patent numbers in several spellings",
    "patent_furniture": "labels and codes of patent pages",
    "site_chrome": "navigation and footer labels of crawled sites",
    "ocr_debris": "lines of punctuation only",
    "code_annotations": "diagram geometry and bare markup tags",
}
REPEATS, REPEAT_LENGTH = 4, 12

# Shapes of lines.
TOC_LEADER = r"\.{4,}\s*[ivxlcdm\d]{1,7}\s*$"
PAGE_MARKER = r"^[\s\-—–—]*(?:page\s+)?[ivxlcdm\d]{1,6}[\s\-—–—.]*$"
PATENT_ID = r"^[A-Z]{2}\s?[\d/,.]{6,18}\s?[A-Z]?\d?$"
MONEY = r"^[A-Z]{2}\s?\d{1,3}(?:,\d{3})+$"
CATALOG = r"^[A-Z]{2}\d*(?:\.\d+){2,}$"
SUBSTANCE = r"^\d{12}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ANNOTATION = r"^\s*(?:(?:extent|fillColor|lineColor|origin|points)=\{|(?:pattern|fillPattern)=(?:Line|Fill)Pattern|rotation=-?\d|textString=|(?:Rectangle|Polygon|Ellipse|Text|Line)\()"
COORDINATES = r"^\s*[\[{(]?\s*[-\d]+\s*,[\s\-\d,.{}\[\]()]*[}\])]?\s*,?\s*$"
TAG = r"(?:br|p|li|ul|ol|dl|dt|dd|td|tr|th|thead|tbody|table|div|span|pre|code|em|i|b|u|strong|small|hr|img|sub|sup|figure|figcaption|section|article|h[1-6])"
TAG_ONLY = rf"^\s*</?{TAG}(?:\s[^<>]*)?/?>\s*(?:[\d.,%\s]*)\s*(?:</{TAG}\s*>)?\s*$"

# Labels that stand alone on a line of a patent page.
PATENT_LABELS = [
    "Download PDF", "Global Dossier", "Espacenet", "Similar Documents", "Legal Events",
    "Prior art keywords", "Prior art date", "Original Assignee", "legal-status", "not_active",
    "Anticipated expiration", "Adjusted expiration", "Discuss", "Landscapes", "Classifications",
    "Other languages", "Other versions", "Also Published As", "USPTO", "USPTO PatentCenter",
    "USPTO Assignment", "Year of fee payment", "Fee payment procedure", "Maintenance fee payment",
    "- Google Patents", "* Cited by examiner, † Cited by third party",
    "Chemical & Material Sciences", "Engineering & Computer Science", "Physics & Mathematics",
    "General Engineering & Computer Science", "Life Sciences & Earth Sciences",
    "Information on status: patent grant", "PATENTED CASE",
    "Entry into force of request for substantive examination",
    "Entry into substantive examination",
    "ASSIGNMENT OF ASSIGNORS INTEREST (SEE DOCUMENT FOR DETAILS).",
    "Legal status (The legal status is an assumption and is not a legal conclusion. Google has not performed a legal analysis and makes no representation as to the accuracy of the status listed.)",
    "Current Assignee (The listed assignees may be inaccurate. Google has not performed a legal analysis and makes no representation or warranty as to the accuracy of the list.)",
    "Priority date (The priority date is an assumption and is not a legal conclusion. Google has not performed a legal analysis and makes no representation as to the accuracy of the date listed.)",
    "GR01", "PB01", "SE01", "STCF", "MAFP", "FEPP", "TA01", "CB02", "C06", "C10", "C14",
]
# Labels of crawled question-and-answer and documentation sites.
SITE_LABELS = [
    "Site design and logo: Copyright © 2015 Big Ladder Software LLC. All rights reserved.",
    "names and logos are trademarks of Big Ladder Software LLC.",
    "Question-and-Answer Resource for the Building Energy Modeling Community",
    "Hi there! Please sign in", "First time here? Check out the",
    "Get started with the Help page", "Ask Your Question", "Sort by »", "UNANSWERED",
    "User contributions licensed under the", "Powered by",
    "Creative Commons Attribution Share Alike 3.0 License",
]


def shape(pattern: str, case: bool = True) -> str:
    """A pattern as the JVM needs it: Unicode classes, the wider white space, a line's true end."""
    out, inside = [], False
    for part in re.findall(r"\\.|.", pattern):
        if part == r"\s":
            part = r"\s\x1c-\x1f" if inside else r"[\s\x1c-\x1f]"
        elif part in "[]":
            inside = part == "["
        out.append(part)
    text = "".join(out)
    return ("(?dU)" if case else "(?diuU)") + (text[:-1] + r"\z" if text.endswith("$") else text)


def parse_rules(spec: str) -> list[str]:
    """none, all or a comma-separated list, in any order, as rules in canonical order."""
    wanted = [w.strip() for w in (spec or "").split(",") if w.strip()]
    if wanted in ([], ["none"]):
        return []
    if wanted == ["all"]:
        return list(RULES)
    if unknown := [w for w in wanted if w not in RULES]:
        raise ValueError(f"unknown rules: {', '.join(unknown)}; known: {', '.join(RULES)}")
    return [r for r in RULES if r in wanted]


def shapes(line: Column, s: Column) -> dict[str, Column]:
    """What a line's own characters say, by rule (or part of a rule); what is cheap to test comes first."""
    dense = F.replace(s, F.lit(" "), F.lit(""))
    digits = chars_in(dense, r"\p{Nd}")
    letter = s.rlike(r"\p{L}")
    # a word character that is no digit and no underscore counts as a letter
    other = s.rlike(r"[\p{Nl}\p{No}]")
    few_digits = (F.length(dense) == 0) | (digits / F.length(dense) < 0.10)
    marks = F.length(F.regexp_replace(s, r"(?U)[\p{L}\p{N}_\s\x1c-\x1f]+", ""))
    size = F.length(s)
    return {
        "toc_leaders": s.contains("....") & s.rlike(shape(TOC_LEADER, case=False)),
        "page_markers": (s != "") & s.rlike(shape(PAGE_MARKER, case=False)) & s.rlike(r"[\p{L}\p{N}]"),
        "orphan_chars": size.between(1, 2),
        "identifier": size.between(8, 24) & s.rlike(shape(PATENT_ID)) & ~s.rlike(shape(MONEY)) & ~s.rlike(shape(CATALOG)),
        "patent_furniture": s.isin(PATENT_LABELS) | ((size == 12) & s.rlike(shape(SUBSTANCE))) | ((size == 10) & s.rlike(shape(ISO_DATE))),
        "site_chrome": s.isin(SITE_LABELS),
        "ocr_debris": (size >= 2) & ~letter & ~other & few_digits & (marks >= 2),
        "annotation": (s != "") & (line.rlike(shape(ANNOTATION)) | (s.startswith("<") & s.rlike(shape(TAG_ONLY, case=False)))),
        "coordinates": (size > 6) & s.contains(",") & s.rlike(shape(COORDINATES)) & (size - F.length(F.replace(s, F.lit(","), F.lit(""))) >= 2),
    }


def _repeated(lines: Column) -> Column:
    """For each line whether its text stands in the document REPEATS times: equal texts are neighbours when sorted."""
    order = F.array_sort(F.transform(lines, lambda x: F.struct(x["s"].alias("s"), x["i"].alias("i"))))

    def in_run(texts: Column) -> Column:
        run = lambda k: reduce(lambda a, b: a | b, [F.coalesce((k >= j) & (F.get(texts, k - j)["s"] == F.get(texts, k - j + REPEATS - 1)["s"]), F.lit(False)) for j in range(REPEATS)])
        return F.array_sort(F.transform(texts, lambda x, k: F.struct(x["i"].alias("i"), run(k).alias("on"))))

    return let(order, in_run)


def _near(lines: Column) -> Column:
    """For each line whether a neighbour among the lines that are not blank is an identifier."""
    full, blank = F.filter(lines, lambda x: x["s"] != ""), F.filter(lines, lambda x: x["s"] == "")

    def beside(some: Column) -> Column:
        at = lambda k: F.coalesce((k >= 0) & F.get(some, k)["identifier"], F.lit(False))
        return F.array_sort(F.concat(F.transform(some, lambda x, k: F.struct(x["i"].alias("i"), (at(k - 1) | at(k + 1)).alias("on"))), F.transform(blank, lambda x: F.struct(x["i"].alias("i"), F.lit(False).alias("on")))))

    return F.when(F.exists(lines, lambda x: x["identifier"]), let(full, beside))


def _chained(lines: Column) -> Column:
    """For each line a letter: M for a coordinate line that lines without a gap lead back from to an annotation."""
    letters = F.array_join(F.transform(lines, lambda x: F.when(x["annotation"], "A").when(x["coordinates"], "C").otherwise("x")), "")
    return F.when(F.exists(lines, lambda x: x["coordinates"]), F.split(F.regexp_replace(letters, r"(?:(?<=A)|(?!^)\G)C", "M"), ""))


def marks(text: Column, rules: list[str] | None = None) -> Column:
    """The body's lines: array of i, line, s (stripped), one boolean for each rule, and rule: the first that claims the line."""
    rules = list(RULES) if rules is None else rules
    each = F.transform(F.split(text, "\n", -1), lambda line, i: let(strip(line), lambda s: F.struct(i.alias("i"), line.alias("line"), s.alias("s"), *[value.alias(name) for name, value in shapes(line, s).items()])))

    def flagged_line(x: Column, seen: Column) -> Column:
        on = {name: x[name] for name in RULES if name not in ("repeated_boilerplate", "patent_id_soup", "code_annotations")}
        on["repeated_boilerplate"] = (F.length(x["s"]) > REPEAT_LENGTH) & F.get(seen["repeated"], x["i"])["on"]
        on["patent_id_soup"] = x["identifier"] & F.coalesce(F.get(seen["near"], x["i"])["on"], F.lit(False))
        on["code_annotations"] = x["annotation"] | (x["coordinates"] & F.coalesce(F.get(seen["chained"], x["i"]) == "M", F.lit(False)))
        first = reduce(lambda rest, name: F.when(on[name], name).otherwise(rest), reversed(rules), F.lit(None).cast("string"))
        return F.struct(x["i"].alias("i"), x["line"].alias("line"), x["s"].alias("s"), *[on[name].alias(f"is_{name}") for name in RULES], first.alias("rule"))

    def together(lines: Column) -> Column:
        seen = F.struct(_repeated(lines).alias("repeated"), _near(lines).alias("near"), _chained(lines).alias("chained"))
        return let(seen, lambda known: F.transform(lines, lambda x: flagged_line(x, known)))

    return let(each, together)


def marked(docs: DataFrame, id_col: str = "id", text_col: str = "text", rules: list[str] | None = None) -> DataFrame:
    """id, head (the header), marks of each document, row by row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), header(text).alias("head"), marks(body(text), rules).alias("marks"))


def flagged(docs: DataFrame, id_col: str = "id", text_col: str = "text", rules: list[str] | None = None) -> DataFrame:
    """One row a line: id, i, line, s, one boolean column for each rule, and rule."""
    return marked(docs, id_col, text_col, rules).select("id", F.inline("marks"))


def _dropped(found: Column) -> Column:
    """Characters that each rule claims, as an array in the rules' order: a line counts with its line feed, unstripped."""
    sums = lambda name: F.aggregate(found, F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["rule"] == name, F.length(x["line"]) + 1).otherwise(0))
    some = F.exists(found, lambda x: x["rule"].isNotNull())
    return F.when(some, F.array(*[F.struct(F.lit(name).alias("rule"), sums(name).alias("dropped_chars")) for name in RULES]))


def attribution(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, rule, dropped_chars, for each document and rule that claims a line of it."""
    found = marked(docs, id_col, text_col).select("id", _dropped(F.col("marks")).alias("dropped"))
    return found.select("id", F.inline("dropped")).where("dropped_chars > 0")


def kept_text(found: Column) -> Column:
    """What remains of the marked lines; where some are claimed, with blank runs collapsed."""
    left = F.filter(found, lambda x: x["rule"].isNull())

    def joined(some: Column) -> Column:
        blank = lambda k: (k >= 0) & (F.get(some, k)["s"] == "")
        once = F.filter(some, lambda x, k: (x["s"] != "") | ~blank(k - 1))
        chosen = F.when(F.size(some) == F.size(found), some).otherwise(once)
        return F.array_join(F.transform(chosen, lambda x: x["line"]), "\n")

    return let(left, joined)


def cleaned(docs: DataFrame, id_col: str = "id", text_col: str = "text", rules: list[str] | None = None) -> DataFrame:
    """id, cleaned_text (header kept), corpus_chars (of the body), corpus_sha256: a row for each document."""
    rest = marked(docs, id_col, text_col, rules).select("id", "head", kept_text(F.col("marks")).alias("kept"))
    whole = rest.select("id", F.concat("head", "kept").alias("cleaned_text"), F.length("kept").cast("long").alias("corpus_chars"))
    return whole.withColumn("corpus_sha256", sha256(F.col("cleaned_text")))


def report(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """rule, place, dropped_chars and its share of all body characters, in per cent; every rule has a row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.length(body(text)).cast("long").alias("size"), _dropped(marks(body(text))).alias("dropped"))
    chars = lambda k: F.coalesce(F.sum(F.get("dropped", F.lit(k))["dropped_chars"]), F.lit(0)).cast("long")
    sums = found.agg(F.sum("size").alias("total"), *[chars(k).alias(name) for k, name in enumerate(RULES)])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(k).alias("place"), F.col(name).alias("dropped_chars"), F.bround(100 * F.col(name) / F.col("total"), 4).alias("pct")) for k, name in enumerate(RULES)])
    return sums.select(F.inline(rows))


def stale(manifest: DataFrame, corpus: DataFrame, ruleset: str) -> DataFrame:
    """ids whose cleaned text must be made: none yet, another ruleset's, or made from other text.

    manifest: id, text_sha256. corpus: id, text_sha256 (that it was made from), ruleset.
    """
    have = corpus.where(F.col("ruleset") == ruleset).select("id", "text_sha256")
    return manifest.select("id", "text_sha256").join(have, ["id", "text_sha256"], "left_anti").select("id")


def check(manifest: DataFrame, corpus: DataFrame, stamp: str | None = None) -> DataFrame:
    """problem, id: where cleaned texts and manifest disagree.

    manifest: id, corpus_chars, corpus_sha256 of ok rows; corpus: id, text (with header).
    """
    actual = corpus.select("id", F.length(body(F.col("text"))).alias("chars"), sha256(F.col("text")).alias("sha"), F.lit(True).alias("here"))
    both = manifest.select("id", "corpus_chars", "corpus_sha256", F.lit(True).alias("expected")).join(actual, "id", "full_outer")
    problems = F.array_compact(F.array(
        F.when(F.col("here").isNull(), "missing"),
        F.when(F.col("expected").isNull(), "unprovenanced"),
        F.when(F.col("here") & F.col("expected") & ~F.col("chars").eqNullSafe(F.col("corpus_chars")), "corpus_chars drift"),
        F.when(F.col("here") & F.col("expected") & (F.col("corpus_sha256") != "") & (F.col("sha") != F.col("corpus_sha256")), "corpus_sha256 drift"),
    ))
    out = both.select(F.explode(problems).alias("problem"), "id")
    if stamp and stamp.startswith("IN-PROGRESS"):
        out = out.unionByName(out.sparkSession.createDataFrame([("unfinished run", stamp)], "problem string, id string"))
    return out


def orphans(corpus: DataFrame, manifest: DataFrame) -> DataFrame:
    """Cleaned texts that the manifest does not know."""
    return corpus.join(manifest.select("id"), "id", "left_anti")
