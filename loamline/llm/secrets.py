"""Secret scans: base patterns with positions, and corpus-wide ownership of what looks like a key.

Base, leftmost and non-overlapping for each kind: assignments to a name like password or token,
access keys, and long runs of hexadecimal digits. Positions come from cutting the text at the
matches and adding up the lengths of what lies between them.

Method: every candidate (the value of a base span, or a bare run of 20 or more key-like characters
with letters and digits) is hashed, and its hash is counted over the corpus by distinct
repositories and distinct owners. A value that ``EXAMPLE_OWNERS`` owners or more hold, or that stands
in ``EXAMPLE_REPOS`` repositories or more whoever owns them, is a widely copied example; any other whose
characters are varied enough is a live-looking credential of its owner. Bare runs found live are added
as spans of kind ``live`` where they touch no base span; base spans always stay. Everything is a
DataFrame expression.

The documents of the contract's query name one place only, their source; the query takes it for the
repository and for the owner, so that the two counts are equal there.

Counts are combined before the shuffle; documents meet their added spans by a key of id and text.
What is written between steps holds hashes of values, never a value.

Defined results: null reads as empty; a null repository or owner is one of its own, "unknown";
repeated rows count once for ownership and give repeated rows; texts are scanned whole at any
length; an empty table gives no rows. Offsets are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import pick, row_key
from loamline.session import checkpoint

KINDS = ["assign", "access", "hex", "live"]
#: Owners from which on a value counts as a copied example.
EXAMPLE_OWNERS = 3
#: Repositories from which on it is one even if fewer own them.
EXAMPLE_REPOS = 10
#: Distinct characters, as a share of the length up to 32, that make a value look live.
VARIED = 0.3

# The base patterns. hex and access take their least length into the pattern, which
# changes nothing: a run that is too short has no match at a later start either.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
BARE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"

SPAN = "struct<start:bigint,k:int,end:bigint,value:string>"
#: What is kept of a span: the value's hash, and whether its characters are mixed.
SEEN = "struct<start:bigint,k:int,end:bigint,hash:string,varied:boolean>"
_CHUNK = 256


def matches(text: Column, pattern: str, k: int, gate: Column) -> Column:
    """array<SPAN> of a pattern's matches, in order; value is the matched text.

    Positions are running sums, kept in chunks so that a text of n matches takes about n steps.
    """
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<array<{SPAN}>>)").alias("full"), none.alias("last"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.array(F.struct(begin.alias("start"), F.lit(k).alias("k"), end.alias("end"), x["hit"].alias("value")))
        whole = F.size(acc["last"]) >= _CHUNK
        moved = F.struct(end.alias("at"), F.when(whole, F.concat(acc["full"], F.array(acc["last"]))).otherwise(acc["full"]).alias("full"), F.when(whole, span).otherwise(F.concat(acc["last"], span)).alias("last"))
        return F.when(x["hit"].isNull(), acc).otherwise(moved)

    found = F.aggregate(zipped, start, step, lambda acc: F.flatten(F.concat(acc["full"], F.array(acc["last"]))))
    return F.when(gate, found).otherwise(none)


def base_spans(text: Column) -> Column:
    """array<SPAN> of all base spans by start, then kind; value is the secret itself."""
    assign = F.transform(matches(text, ASSIGN, 0, text.rlike(ASSIGN)), lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), F.regexp_extract(s["value"], ASSIGN, 2).alias("value")))
    assign = F.filter(assign, lambda s: F.length(s["value"]) >= 6)
    access = matches(text, ACCESS, 1, text.contains("AKIA"))
    hexes = matches(text, HEX, 2, text.rlike(HEX))
    return F.array_sort(F.concat(assign, access, hexes))


def varied(value: Column) -> Column:
    """Whether a value's characters are as mixed as a generated key's."""
    size = F.length(value)
    return (size >= 12) & (F.size(F.array_distinct(F.split(value, ""))) >= VARIED * F.least(size, F.lit(32))) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _hashed(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"), varied(s["value"]).alias("varied")))


def candidates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source") -> DataFrame:
    """doc_id, key, repo, owner, base and bare spans (arrays of SEEN); texts and values are left behind."""
    docs = pick(documents, doc_id=id_col, text=text_col, repo=repo_col, owner=owner_col)
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), known("repo"), known("owner"))
    bare = matches(F.col("text"), BARE, 3, F.col("text").rlike(BARE))
    found = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "repo", "owner", base_spans(F.col("text")).alias("base"), bare.alias("bare"))
    apart = F.filter("bare", lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return found.withColumns({"base": _hashed(F.col("base")), "bare": _hashed(apart)})


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, n_docs, n_repos, n_owners and verdict (example, live or weak) of each candidate."""
    each = found.select("key", "repo", "owner", F.explode(F.concat("base", "bare")).alias("s"))
    each = each.select("key", "repo", "owner", F.col("s.hash").alias("value_hash"), "s.varied")
    # distinct values are counted from rows that are distinct already, so a copied value is combined early
    by_doc = each.groupBy("value_hash", "key").agg(F.first("varied").alias("varied")).groupBy("value_hash").agg(F.count("*").alias("n_docs"), F.first("varied").alias("varied"))
    by_owner = each.groupBy("value_hash", "repo", "owner").agg(F.count("*").alias("n")).groupBy("value_hash").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))
    verdict = F.when((F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS), "example").when(F.col("varied"), "live").otherwise("weak")
    return by_doc.join(by_owner, "value_hash").select("value_hash", "n_docs", "n_repos", "n_owners", verdict.alias("verdict"))


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source") -> DataFrame:
    """doc_id, base, spans (base and added, by start then kind), n_live, n_example of each document."""
    found = checkpoint(candidates(documents, id_col=id_col, text_col=text_col, repo_col=repo_col, owner_col=owner_col))
    holding = found.where((F.size("base") > 0) | (F.size("bare") > 0))
    each = holding.dropDuplicates(["key"]).select("key", F.explode(F.concat("base", "bare")).alias("s"))
    each = each.withColumn("value_hash", F.col("s.hash")).join(ownership(holding).select("value_hash", "verdict"), "value_hash")
    count = lambda v: F.count(F.when(F.col("verdict") == v, 1)).alias(f"n_{v}")
    added = F.collect_list(F.when((F.col("verdict") == "live") & (F.col("s.k") == 3), F.col("s")))
    of_doc = each.groupBy("key").agg(added.alias("added"), count("live"), count("example"))
    joined = found.select("doc_id", "key", "base").join(of_doc, "key", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.expr(f"cast(array() as array<{SEEN}>)"))))
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "base", spans.alias("spans"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"))


def joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame) -> DataFrame:
    """The contract's columns, with n_live and n_example behind them."""

    def counted(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    found = scan(documents)
    return found.select("doc_id", *map(counted, range(3)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "n_live", "n_example")


# The same for DuckDB: matches by the contract's patterns, positions from the gaps between them.
ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, 'unknown') AS source FROM documents),
kinds AS (SELECT * FROM (VALUES
  (0, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'AKIA[A-Z0-9]+'), (2, '[0-9a-f]+'), (3, '[A-Za-z0-9+/_=-]+')) AS v(k, pattern)),
split AS (SELECT r, doc_id, source, k, pattern, regexp_extract_all(text, pattern, 0) AS hits, string_split_regex(text, pattern) AS gaps FROM docs, kinds),
each AS (SELECT r, doc_id, source, k, pattern, generate_subscripts(hits, 1) AS n, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap FROM split),
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY n) AS stop FROM each),
found AS (SELECT r, doc_id, source, k, CAST(stop AS BIGINT) - length(hit) AS start, CAST(stop AS BIGINT) AS stop,
    CASE WHEN k = 0 THEN regexp_extract(hit, pattern, 2) ELSE hit END AS value FROM placed),
held AS (SELECT * FROM found WHERE (k = 0 AND length(value) >= 6) OR (k = 1 AND length(value) >= 20) OR (k = 2 AND length(value) >= 24)
    OR (k = 3 AND length(value) >= 20 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]'))),
spans AS (SELECT * FROM held h WHERE k < 3 OR NOT EXISTS (SELECT 1 FROM held b WHERE b.r = h.r AND b.k < 3 AND h.start < b.stop AND b.start < h.stop)),
judged AS (SELECT value, CASE WHEN count(DISTINCT source) >= 3 THEN 'example'
    WHEN length(value) >= 12 AND len(list_distinct(string_split(value, ''))) >= 0.3 * least(length(value), 32)
      AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') THEN 'live' ELSE 'weak' END AS verdict
  FROM spans GROUP BY value),
known AS (SELECT s.*, verdict, (['assign', 'access', 'hex', 'live'])[k + 1] || ':' || start || ':' || stop AS shown FROM spans s JOIN judged USING (value)),
sums AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(shown, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(shown, ',' ORDER BY start, k) FILTER (k < 3 OR verdict = 'live') AS spans,
    count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example FROM known GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN sums USING (r)
"""
