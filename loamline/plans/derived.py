"""The manifest that test tables stand in for, and literal fixtures, for Spark and SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SQL = """
SELECT
  CASE CAST(doc_id % 8 AS INT) WHEN 0 THEN 'ost-' WHEN 1 THEN 'pat-us' WHEN 2 THEN 'pat-cn'
       WHEN 3 THEN 'hand-' WHEN 4 THEN 'gh-' WHEN 5 THEN 'arc-' WHEN 6 THEN 'wik-' ELSE 'pat-ep' END
    || CAST(doc_id AS STRING)                                              AS id,
  substr(split_part(text, chr(10), 1), 1, 150)                             AS title,
  'https://' || source || '.example.org/' || CAST(doc_id AS STRING)
    || CASE WHEN doc_id % 2 = 0 THEN '/' ELSE '' END                       AS url,
  source,
  CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN 'open' WHEN 1 THEN 'public-domain' WHEN 2 THEN 'cc-by'
       WHEN 3 THEN 'cc-by-sa' WHEN 4 THEN 'cc0' ELSE 'open' END            AS license,
  CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN 'building_energy' WHEN 1 THEN 'construction'
       WHEN 2 THEN 'materials' ELSE 'urban' END                            AS topic,
  CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN 'pdf' WHEN 1 THEN 'html' ELSE 'txt' END AS format,
  CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'ok' END                    AS status,
  CASE WHEN doc_id % 17 <> 0 THEN 200 WHEN doc_id % 34 = 0 THEN 404 ELSE 503 END AS http_status,
  lang AS language, n_chars AS text_chars, text AS body, doc_id AS pos
FROM documents
"""


#: Inputs below so many bytes a core may come in fewer parts than there are cores.
SMALL = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A table; spread deals a small one out to all cores, for work that is heavy a row.

    Large tables come in enough parts by themselves and are never shuffled for this.
    """
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return dealt(rows) if spread else rows


def dealt(rows: DataFrame) -> DataFrame:
    """A small table dealt out to all cores; a large one as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size < SMALL * cores else rows


def manifest(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread)
    return spark.sql(MANIFEST_SQL.replace("FROM documents", "FROM {docs}"), docs=docs).withColumns({"sha256": F.sha2("body", 256), "error": F.lit(None).cast("string")})


def sql_manifest() -> str:
    """The same as a DuckDB subquery, with the content hash."""
    return f"(SELECT *, sha256(body) AS sha256, CAST(NULL AS VARCHAR) AS error FROM ({MANIFEST_SQL}))"


#: Documents of single lines, or few, that exercise every cleaning rule; ids are negative.
LINE_FIXTURES = {
    -1: ["Introduction ........ 3", "3.2 Aims ......... xiv", "and so on ... the next part", "Four dots .... end of it"],
    -2: ["7", "xiv", "Page 12", "- 186 -", "Figure 3", "12 kW", "", "Page twelve"],
    -3: ["a", "ab", "abc", " z ", ""],
    -4: ["US20150157190A1", "", "US 20150157190 A1", "plain words between", "EP1234567B1", "words again", "LS 700,000", "HB2.16.1"],
    -5: ["Download PDF", "238000000034", "23800000003", "2020-01-31", "on 2020-01-31 it rained", "GR01", "Powered by", "Ask Your Question"],
    -6: ["; . ,", "} . )", "1845", "0.5 1.25 0.75", "(1)", "2019;48(21):5310-49.", "...", "-"],
    -7: ["extent={{-50,48},{50,-42}},", "{-100,100,-20},{100,-100,20}", "  -10,20,30,40", "points = 7, and more words", "75, 1543-1545, 2004.", "<td>0.33</td>", "<br/>", "<https://example.org>", "<mn>3</mn>", "Text(", "rotation=-90"],
    -8: ["A header that recurs"] * 4 + ["Twelve chars"] * 5 + ["A line three times"] * 3 + ["body", "", "", "", "end"],
    -9: ["a", "", "", "b words", "", "", "", "c words", ""],
    -10: ["nothing here is claimed", "", "", "so blank runs stay"],
    -11: [""],
}


def fixture_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, "\n".join(lines)) for i, lines in LINE_FIXTURES.items()]
    return spark.createDataFrame(rows, "id long, text string")


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select(F.col("doc_id").alias("id"), "text")
    return docs.unionByName(fixture_documents(spark))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def sql_line_documents() -> str:
    values = ", ".join(f"(CAST({i} AS BIGINT), {_quoted(chr(10).join(lines))})" for i, lines in LINE_FIXTURES.items())
    return f"(SELECT doc_id AS id, text FROM documents UNION ALL SELECT * FROM (VALUES {values}) AS f(id, text))"
