"""Queries with heavy work on narrow tables: many tasks share it, however few partitions the files make."""

import inspect
import re

import duckdb
import pytest

import __spark_entry__
from folioframe.functions.columns import dealt
from folioframe.operators import article, body, citations
from folioframe.operators.trees import _Builder, parse, write


def _same_as_sql(got, name, table, path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    found = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(found.fetchall())


def test_every_core_has_customers_of_one_small_file(spark, tmp_path):
    spark.range(1, 201, numPartitions=1).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    got = __spark_entry__.queries()["article_fronts"](spark, str(tmp_path))
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    _same_as_sql(got, "article_fronts", "customer", tmp_path)


def test_tasks_have_few_rows_each(spark):
    df = spark.range(0, 1000, numPartitions=1)
    assert dealt(df, rows=100).rdd.getNumPartitions() == 10
    assert dealt(df.filter("id < 0")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    met = dealt(df.selectExpr("id % 7 AS k"), "k", rows=100)
    assert all(len(p) % 142 in (0, 1, 2, 3, 4, 5, 6) for p in met.rdd.glom().collect()) and met.count() == 1000


@pytest.mark.parametrize("html", ["", "a b", "On <i>x</i>", "<p>a<p>b</i></p>c", "x<br>y</br>", "<td>1<td>2</tr>", "<title>a<b>c</title>d", "<script>a<b>c</script>d", "1 < 2 <i>x</i>", "<I>x</I>", "\x00<b>￾</b>\x7f"])
def test_bare_tags_are_read_as_by_the_whole_parser(html):
    whole = _Builder()
    whole.feed(html.replace("￾", "?"))
    whole.close()
    assert write(parse(html)) == write(whole.root)


def test_a_failed_step_leaves_the_tree_before_it(monkeypatch):
    def spoil(xml, ctx):
        xml.children.clear()
        raise ValueError("no")

    parts = {"before": "<h1>One</h1><p>two <i>three</i></p>", "references": [{"text": "<p>ref</p>"}]}
    want = write(body.convert(parts)[0])
    monkeypatch.setattr(body, "STEPS", [*body.STEPS[:3], ("spoiled", [spoil]), *body.STEPS[3:]])
    xml, _, errors = body.convert(parts)
    assert write(xml) == want and [e["action"] for e in errors] == ["spoiled"]


def test_parts_are_dealt_out_as_keys_and_only_read_attributes_are_made(spark, tmp_path):
    spark.range(1, 41, numPartitions=1).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = __spark_entry__.queries()["assembled_articles"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "complete_publication_date" not in plan and "first_author" not in plan
    _same_as_sql(got, "assembled_articles", "part", tmp_path)


def test_read_attributes_are_those_that_the_rules_name():
    source = inspect.getsource(article)
    named = set(re.findall(r"""\bd(?:\.get\(|\[)"(\w+)\"""", source)) | set(re.findall(r'\("(\w+_date_iso)", "', source)) | {"pid_v1", "pid_v2", "pid_v3"}
    assert named - {"detector"} <= article.READ and all(f'"{x}"' in source or x.startswith("pid_v") for x in article.READ)
    source = inspect.getsource(citations)
    named = set(re.findall(r"""\bc(?:\.get\(|\[)"(\w+)\"""", source)) | set(re.findall(r'_simple\("[\w-]+", "(\w+)"', source))
    assert named <= citations.READ
