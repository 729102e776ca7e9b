"""One object over a corpus: its operators as methods that return DataFrames, and as temporary views for SQL.

    corpus = Corpus(spark, manifest, entries, blocklist)
    corpus.prune().groupBy("reason").count().show()
    corpus.register()
    spark.sql("SELECT title, clean_norm(title), verdict FROM corpus_verdicts JOIN corpus_manifest USING (id)")
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from loamline.operators import coverage, lines, merge, prune, registry, report
from loamline.operators.quality import assessed

#: Scalar functions for SQL, over one argument x, as the expressions that the operators use.
SQL_FUNCTIONS = {
    "clean_norm": "btrim(regexp_replace(lower(coalesce(x, '')), '[^\\\\p{L}\\\\p{N}_]+', ' '), ' ')",
    "clean_slug": "btrim(regexp_replace(lower(coalesce(x, '')), '[^a-z0-9]+', '-'), '-')",
    "url_key": "trim(TRAILING '/' FROM coalesce(x, ''))",
    "corpus_tokens": "cast(floor(length(x) / 4) as bigint)",
}


class Corpus:
    """manifest: its rows with body; entries: the registry; blocklist: url. Everything is lazy but prune and merge."""

    def __init__(self, spark: SparkSession, manifest: DataFrame, entries: DataFrame | None = None, blocklist: DataFrame | None = None):
        self.spark, self.manifest, self.blocklist = spark, manifest, blocklist
        self.entries = entries if entries is not None else spark.createDataFrame([], registry.ENTRY_SCHEMA)

    @property
    def _ok(self) -> DataFrame:
        return self.manifest.where("status = 'ok' and body is not null")

    def metrics(self) -> DataFrame:
        """id, quality."""
        return assessed(self._ok, "body").select("id", "quality")

    def verdicts(self) -> DataFrame:
        """id, verdict."""
        return prune.measured(self._ok).select("id", "verdict")

    @cached_property
    def _judged(self) -> DataFrame:
        return prune.reasons(self.manifest)

    def prune(self) -> DataFrame:
        """The manifest with reason; see prune.reasons."""
        return self._judged

    def clean(self, rules: str = "all") -> DataFrame:
        """id, cleaned_text, corpus_chars, corpus_sha256."""
        return lines.cleaned(self._ok, "id", "body", lines.parse_rules(rules))

    def report(self) -> DataFrame:
        """rule, place, dropped_chars, pct of what cleaning takes away."""
        return lines.report(self._ok, "id", "body")

    def check(self, cleaned: DataFrame, stamp: str | None = None) -> DataFrame:
        """problem, id: where cleaned texts (id, text) and the manifest disagree."""
        return lines.check(self.manifest.where("status = 'ok'"), cleaned, stamp)

    def coverage(self) -> DataFrame:
        """genre, docs, status, place."""
        return coverage.genre_coverage(self.manifest)

    def matrix(self, other: str | None = None) -> DataFrame:
        """Marginals of every dimension, or the cells of domain by lifecycle or region."""
        if other is None:
            return coverage.marginals(self._ok)
        keys = {"lifecycle": list(coverage.LIFECYCLE), "region": coverage.REGION_COLUMNS}
        return coverage.cross_cells(self._ok, other, keys[other])

    def lint(self) -> DataFrame:
        """check, id, detail of the registry's and the manifest's problems."""
        return registry.lint_entries(self.entries).unionByName(registry.lint_manifest(self.manifest, self.entries))

    def index(self) -> DataFrame:
        """kind, value of everything known."""
        return registry.known_keys(self.manifest, self.entries, self.blocklist)

    def merge(self, proposals: DataFrame) -> DataFrame:
        """The proposals that are new, first come first kept, with ids of their own."""
        reserved = self.manifest.select("id").unionByName(self.entries.select("id"))
        return merge.merge_proposals(proposals, self.index(), reserved)

    def totals(self) -> DataFrame:
        return report.totals(self.manifest)

    def register(self, prefix: str = "corpus") -> list[str]:
        """Temporary views of manifest, entries and the results above, and SQL functions; returns the views' names."""
        if not re.fullmatch(r"[A-Za-z_]\w*", prefix):
            raise ValueError(f"no name for views: {prefix!r}")
        views = {"manifest": self.manifest, "entries": self.entries, "verdicts": self.verdicts(), "reasons": self.prune(), "clean": self.clean(), "coverage": self.coverage(), "matrix": self.matrix(), "lint": self.lint(), "known": self.index(), "totals": self.totals()}
        for name, frame in views.items():
            frame.createOrReplaceTempView(f"{prefix}_{name}")
        for name, body in SQL_FUNCTIONS.items():
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {'BIGINT' if name == 'corpus_tokens' else 'STRING'} RETURN {body}")
        return [f"{prefix}_{name}" for name in views]
