import duckdb
import pytest

from loamline.plans import queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    compare(con, queries.QUERIES[name](spark, FOLDER), queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() >= 0


def test_html_extract_of_odd_pages(spark, tmp_path):
    pages = [None, "", "<article>x <3 y</article>", "<noscript><main>no</main></noscript><article>yes</article>", "<article>a<!-- b -->c\n\n\nd</article>"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    compare(con, queries.QUERIES["html_extract"](spark, str(tmp_path)), queries.ORACLE_SQL["html_extract"])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
