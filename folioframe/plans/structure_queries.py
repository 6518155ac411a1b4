"""Registered queries of structural joins over the nodes of every page, with sections, tables, names and labelled links planted behind its own markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions.columns import spread
from folioframe.operators import nodes, structure
from folioframe.plans.catalogue import _pages, query
from folioframe.sources.scratch import stored

_PLANTED = (
    '<section id="s1"><p><a href="#t1">one</a></p><section id="s2"><p><a href="#s1">two</a></p><table id="t1"><tr><td><a href="#none">three</a></td><td><b id="n1">n</b></td></tr></table><p><a href="#n1">four</a></p></section>'
    '<p><a href="#t1">five</a></p></section><p><a href="#s2">six</a></p><section id="s3"><table id="t2"><tr><td><table id="t3"><tr><td><a href="#t3">seven</a></td></tr></table></td><td><a href="#t2">eight</a></td></tr></table></section>'
)


@query(rf"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS html FROM pages),
a AS (SELECT page_id, unnest(string_split(regexp_replace(html, '(?i)<a\s+(?:[^>]*\s)?href="([^"]*)"', chr(1) || '\1' || chr(2), 'g'), chr(1))) AS part,
             generate_subscripts(string_split(regexp_replace(html, '(?i)<a\s+(?:[^>]*\s)?href="([^"]*)"', chr(1) || '\1' || chr(2), 'g'), chr(1)), 1) - 1 AS n FROM p),
c AS (
    SELECT page_id, n, string_split(part, chr(2))[1] AS href, sum(len(regexp_extract_all(part, '(?i)<nav[\s>]')) - len(regexp_extract_all(part, '(?i)</nav>'))) OVER w AS navs,
           sum(len(regexp_extract_all(part, '(?i)<article[\s>]')) - len(regexp_extract_all(part, '(?i)</article>'))) OVER w AS articles
    FROM a WINDOW w AS (PARTITION BY page_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
own AS (SELECT page_id, n, href, CASE WHEN navs > 0 THEN 'nav' WHEN articles > 0 THEN 'article' END AS holder FROM c WHERE n > 0),
v AS (SELECT * FROM (VALUES (1, '#t1', 'section s1', 's1', NULL, 'table'), (2, '#s1', 'section s2', 's2', NULL, 'section'), (3, '#none', 'table t1', 's2', 't1', NULL), (4, '#n1', 'section s2', 's2', NULL, 'b'),
    (5, '#t1', 'section s1', 's1', NULL, 'table'), (6, '#s2', NULL, NULL, NULL, 'section'), (7, '#t3', 'table t3', 's3', 't3', 'table'), (8, '#t2', 'table t2', 's3', 't2', 'table')) v(k, href, holder, section, tab, target)),
m AS (SELECT page_id, count(*) FILTER (n > 0) AS most FROM c GROUP BY page_id)
SELECT page_id, CAST(n AS BIGINT) AS n, href, holder, CAST(NULL AS VARCHAR) AS section, CAST(NULL AS VARCHAR) AS tab, CAST(NULL AS VARCHAR) AS target FROM own
UNION ALL SELECT page_id, most + k, href, holder, section, tab, target FROM m, v
""")
def link_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each link of every page, in order, with the nearest of nav, article, section and table that holds it, its section, its table, and the tag that its address names."""
    pages = spread(_pages(spark, sf_dir)).select("page_id", F.concat("html", F.lit(_PLANTED)).alias("html"))
    table = nodes.node_table(pages, "page_id", "html").select("page_id", "node", "post", "depth", "tag", "attrs")
    tag, id_ = F.col("tag"), F.col("attrs")["id"]
    for name, tags in (("_holder", ["nav", "article", "section", "table"]), ("_section", ["section"]), ("_tab", ["table"])):
        table = structure.enclosing(table, "page_id", tag.isin(tags), name)
    table = stored(table.select("page_id", "node", "tag", "attrs", "_holder", "_section", "_tab"))  # read several times
    href = F.col("attrs")["href"]
    links = table.filter((tag == "a") & href.isNotNull())
    named = structure.referred(table, "page_id", F.when(tag == "a", F.regexp_extract(href, "^#(.+)$", 1)), id_).select(F.col("page_id").alias("_p"), F.col("node").alias("_n"), "target_tag")
    links = links.join(named, (F.col("page_id") == F.col("_p")) & (F.col("node") == F.col("_n")), "left").drop("_p", "_n")
    shown = table.filter(tag.isin("nav", "article", "section", "table")).select(F.col("page_id").alias("_p"), F.col("node").alias("_n"), F.concat_ws(" ", tag, id_).alias("_shown"), id_.alias("_id"))
    for name, what, column in (("_holder", "_shown", "holder"), ("_section", "_id", "section"), ("_tab", "_id", "tab")):
        one = shown.select(F.col("_p").alias(f"_p{column}"), F.col("_n").alias(f"_n{column}"), F.col(what).alias(column))
        links = links.join(one, (F.col("page_id") == F.col(f"_p{column}")) & (F.col(name) == F.col(f"_n{column}")), "left")
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("page_id").orderBy("node")).cast("long")
    return links.select("page_id", n.alias("n"), href.alias("href"), "holder", "section", "tab", F.col("target_tag").alias("target"))


_IMAGES = '<p id="q"><a class="i" href="/img/a.gif">Figure 1</a>, <a class="i" href="/img/b.gif">2</a> <a class="i"> </a><i>and</i> <a class="i">3a</a></p><p><a class="i">4</a><a class="i">Table  5</a><a class="i">6</a><a class="i">Map</a><a class="i">7</a><a class="i">see the Map 8</a></p><fig></fig><p></p><hr><graphic id="g"></graphic>'


@query("""
SELECT page_id, v.k, v.label FROM pages, (VALUES (1, 'Figure 1'), (2, 'Figure 2'), (3, NULL), (4, 'Figure 3a'), (5, '4'), (6, 'Table 5'), (7, 'Table 6'), (8, 'Map'), (9, 'Map 7'), (10, 'see'), (11, 'graphic')) v(k, label)
""")
def label_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of links to images, carried on within their paragraph, and the target that an empty figure finds among the next three siblings; in every page."""
    pages = spread(_pages(spark, sf_dir)).select("page_id", F.concat(F.lit(_IMAGES), "html").alias("html"))
    table = nodes.node_table(pages, "page_id", "html")
    labelled = structure.carried_labels(table, "page_id", (F.col("tag") == "a") & (F.col("attrs")["class"] == "i"), F.col("text"))
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("page_id").orderBy("node"))
    labels = labelled.select("page_id", k.alias("k"), "label")
    found = structure.next_sibling(table, "page_id", F.col("tag").isin("graphic", "media"), 3, "found").filter("tag = 'fig'")
    target = table.select(F.col("page_id").alias("_p"), F.col("node").alias("_n"), F.col("tag").alias("label"))
    return labels.unionByName(found.join(target, (F.col("page_id") == F.col("_p")) & (F.col("found") == F.col("_n"))).select("page_id", F.lit(11).alias("k"), "label"))
