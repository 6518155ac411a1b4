"""assembled_articles on tables with more parts than five digits tell, and its joins."""

import duckdb
import pytest

import __spark_entry__


@pytest.fixture
def made(spark, tmp_path):
    keys = [1, 2, 50, 51, 9_999, 99_999, 100_000, 100_001, 100_050, 119_999, 999_999, 1_000_000, 7_200_000, 3_000_000_000]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    return __spark_entry__.queries()["assembled_articles"](spark, str(tmp_path)), f"{tmp_path}/part.parquet/*.parquet"


def test_keys_beyond_five_digits(made):
    got, path = made
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{path}'")
    found = con.execute(__spark_entry__.oracle_sql()["assembled_articles"])
    names = [d[0] for d in found.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(found.fetchall())


def test_no_row_for_each_document_is_broadcast(spark, made):
    """Bodies, citations and licenses are as many as the documents, whatever Spark takes their size to be; journals are few."""
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastHashJoin") <= 1, plan
