"""URL filters: listed rules first, and gradient-boosted trees on lexical features for the rest.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end. A rule names a host and a path's beginning; it fits the host
and all its subdomains, and the longest fitting rule decides.

Method: boosting of depth-two trees on the logistic loss over length, depth, digit ratio, entropy,
parameter counts and suffix statistics, trained from labelled URLs. Each level's histogram of
gradients is one aggregation over the labelled rows; the driver sees only (leaf, feature, bin)
sums. The trees become one column expression, so that judging URLs is a projection.

At most ``MOST_LABELLED`` labelled rows are learned from, chosen by a hash of the URL.

Defined results: null, and URLs without ``://``, have empty host and path, no rule fits, and the trees
judge them; equal longest rules: the first in order of spelling; labels other than 0 and 1 are not
learned from; without labelled rows of both classes every URL without a rule is allowed; repeated
rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import pick

# The contract's rules, as (verdict, host and beginning of the path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

ROUNDS = 8
BINS = 12
RATE = 0.4
RIDGE = 1.0
LEAST_ROWS = 5
MOST_LABELLED = 4000
THRESHOLD = 0.5
FEATURES = ["length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "labels", "suffix_rate", "longest_label"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*+([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):  # the last wins
        name, slash, begin = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + begin)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need no statistics, as doubles; zeros for an unreadable URL."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.greatest(F.length(host), F.lit(1)).cast("double")

    def spread(acc: Column, c: Column) -> Column:
        share = (F.length(host) - F.length(F.replace(host, c, F.lit("")))) / size
        return acc - F.when(share > 0, share * F.log(share)).otherwise(0.0)

    labels = F.split(host, r"\.")
    out = {
        "length": F.length(url),
        "host_length": F.length(host),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": F.aggregate(F.array_distinct(F.split(host, "")), F.lit(0.0), spread),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "hyphens": F.regexp_count(host, F.lit("-")),
        "labels": F.when(host == "", 0).otherwise(F.size(labels)),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))),
    }
    return {name: F.round(value.cast("double"), 6) for name, value in out.items()}


def suffix_of(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


class Model:
    """Suffix statistics, and trees as (feature, threshold, then, else); a leaf is a number."""

    def __init__(self, prior: float, suffixes: dict[str, float], usual: float, trees: list):
        self.prior, self.suffixes, self.usual, self.trees = prior, suffixes, usual, trees

    def features(self, url: Column) -> list[Column]:
        host, path = host_and_path(url)
        return [c.alias(n) for n, c in {**lexical(url, host, path), "suffix_rate": self.suffix_rate(host)}.items()]

    def suffix_rate(self, host: Column) -> Column:
        pairs = [F.lit(x) for kv in sorted(self.suffixes.items()) for x in kv]
        known = F.element_at(F.create_map(*pairs), suffix_of(host)) if pairs else F.lit(None).cast("double")
        return F.coalesce(known, F.lit(self.usual))

    def margin(self) -> Column:
        return reduce(lambda a, b: a + b, [_value(t) for t in self.trees], F.lit(self.prior))

    def block_probability(self) -> Column:
        """Over columns named as in FEATURES."""
        return 1.0 / (1.0 + F.exp(-self.margin()))


def _value(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, at, low, high = tree
    return F.when(F.col(name) <= at, _value(low)).otherwise(_value(high))


def fit(labelled: DataFrame, *, url_col: str = "url", label_col: str = "label", rounds: int = ROUNDS) -> Model:
    """Boosted trees from labelled URLs: 1 for URLs to block, 0 for others.

    The sample is bounded, so its rows are kept in one partition and no step shuffles.
    """
    rows = pick(labelled, url=url_col, label=label_col).where("url is not null and label in (0, 1)").select("url", F.col("label").cast("double").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(MOST_LABELLED)
    host, path = host_and_path(F.col("url"))
    rows = rows.select("label", suffix_of(host).alias("suffix"), *[c.alias(n) for n, c in lexical(F.col("url"), host, path).items()]).coalesce(1).cache()
    try:
        return _boost(rows, rounds)
    finally:
        rows.unpersist()


def _boost(rows: DataFrame, rounds: int) -> Model:
    n, bad = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or not bad or bad == n:
        return Model(-10.0, {}, 0.0, [])
    usual = bad / n
    by_suffix = rows.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("bad")).collect()  # no more than labelled rows
    suffixes = {r["suffix"]: round((r["bad"] + 10 * usual) / (r["n"] + 10), 6) for r in by_suffix}
    model = Model(math.log(usual / (1 - usual)), suffixes, round(usual, 6), [])
    pairs = [F.lit(x) for kv in sorted(suffixes.items()) for x in kv]
    rows = rows.withColumn("suffix_rate", F.coalesce(F.element_at(F.create_map(*pairs), F.col("suffix")), F.lit(model.usual)))
    shares = [i / BINS for i in range(1, BINS)]
    got = rows.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(got[f])) for f in FEATURES}
    bins = [F.struct(F.lit(i).alias("f"), reduce(lambda a, c, f=f: a + (F.col(f) > c).cast("int"), cuts[f], F.lit(0)).alias("bin")) for i, f in enumerate(FEATURES)]
    rows = rows.select("label", *FEATURES, F.array(*bins).alias("bins")).cache()
    try:
        for _ in range(rounds):
            model.trees.append(_tree(rows, model, cuts))
    finally:
        rows.unpersist()
    return model


def _tree(rows: DataFrame, model: Model, cuts: dict[str, list[float]]) -> tuple | float:
    """A tree of depth two by two histogram passes."""
    now = rows.withColumn("p", model.block_probability())
    root = _splits(now.withColumn("leaf", F.lit(0)), cuts).get(0)
    if root is None:
        return 0.0
    name, at, low, high = root
    halves = _splits(now.withColumn("leaf", F.when(F.col(name) <= at, 0).otherwise(1)), cuts)
    sides = [halves.get(leaf) or value for leaf, value in ((0, low), (1, high))]
    return (name, at, *sides)


def _splits(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[int, tuple]:
    """For each leaf the best (feature, threshold, value below, value above), if any gains."""
    each = rows.select("leaf", (F.col("label") - F.col("p")).alias("g"), (F.col("p") * (1 - F.col("p"))).alias("h"), F.explode("bins").alias("at"))
    sums = each.groupBy("leaf", "at.f", "at.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).collect()
    table: dict[int, dict[int, dict[int, tuple]]] = {}
    for r in sums:
        table.setdefault(r["leaf"], {}).setdefault(r["f"], {})[r["bin"]] = (r["g"], r["h"], r["n"])
    out = {}
    for leaf, features in table.items():
        best = None
        for f, name in enumerate(FEATURES):
            bins_of = features.get(f, {})
            total = [math.fsum(x[k] for _, x in sorted(bins_of.items())) for k in range(3)]
            left = [0.0, 0.0, 0]
            for b, at in enumerate(cuts[name]):
                left = [a + x for a, x in zip(left, bins_of.get(b, (0.0, 0.0, 0)), strict=True)]
                right = [t - a for t, a in zip(total, left, strict=True)]
                if min(left[2], right[2]) < LEAST_ROWS:
                    continue
                gain = left[0] ** 2 / (left[1] + RIDGE) + right[0] ** 2 / (right[1] + RIDGE) - total[0] ** 2 / (total[1] + RIDGE)
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, name, at, round(RATE * left[0] / (left[1] + RIDGE), 9), round(RATE * right[0] / (right[1] + RIDGE), 9))
        if best:
            out[leaf] = best[1:]
    return out


def seed_urls(spark: SparkSession, n: int = 2000) -> DataFrame:
    """Labelled URLs to start from where no others are given: plain pages, and link-farm spellings.

    A deterministic mix drawn by a hash of the row's number; half of it is labelled 1.
    """
    draw = lambda name, options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64("id", F.lit(name)), F.lit(len(options))) + 1).cast("int"))
    number = lambda name, most: F.pmod(F.xxhash64("id", F.lit(name)), F.lit(most)).cast("string")
    # Word parts of invented hosts.
    plain = ["the", "tion", "ing", "er", "an", "re", "on", "st", "en", "her", "or", "ble", "in", "at", "ed", "ou"]
    shady = ["cheap", "pills", "spam", "farm", "casino", "win", "bonus", "free", "loans", "deal", "viagra", "bet"]
    suffix = ["example.com", "example.net", "example.org"]
    good = F.concat(draw("p", ["http://", "https://"]), draw("w", ["www.", "blog.", "m.", "", ""]), draw("a", plain), draw("b", plain), draw("c", plain + [""]), F.lit("."), draw("s", suffix), F.lit("/"), draw("l", ["en", "fr", "de", "es"]), F.lit("/"), number("n", 1000), draw("t", ["", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"]))
    bad = F.concat(draw("p", ["http://", "https://"]), draw("w", ["www.", "", ""]), draw("a", shady), F.lit("-"), draw("b", shady), draw("c", ["", "", "-", "24-"]), draw("d", ["", "", *shady]), F.lit("."), draw("s", [*suffix, "example.com", "xyz", "top"]), F.lit("/"), draw("l", ["en", "fr", "de", "es", "go/now/buy"]), F.lit("/"), number("n", 1000), draw("t", ["", "/", ".html", "?page=2&ref=x", "?utm_source=feed", "?id=77&aff=12&src=9&cl=3"]))
    rows = spark.range(0, n, 1, 1)
    return rows.select(F.when(F.col("id") % 2 == 0, good).otherwise(bad).alias("url"), (F.col("id") % 2).cast("int").alias("label"))


def judge(pages: DataFrame, model: Model, *, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, and the trees' probability of block."""
    rows = pick(pages, page_id=id_col, url=url_col)
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), *model.features(F.col("url")))
    listed = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.select("page_id", "host", "path", listed.alias("listed"), F.round(model.block_probability(), 6).alias("p_block"))
    verdict = F.coalesce("listed.verdict", F.when(F.col("p_block") >= THRESHOLD, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), "p_block")
