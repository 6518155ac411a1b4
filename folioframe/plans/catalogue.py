"""The registered queries over the record engine, with their SQL.

The driver's tables hold no dumps, so a query first spells records, dates, ids or markup from their columns,
and then applies the engine's operator; the SQL does both by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import fields, lookups, patterns
from folioframe.functions import text as tx
from folioframe.functions.columns import spread
from folioframe.operators import body, entities
from folioframe.sources import isis

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from folioframe.plans import dump_queries, entity_queries, function_queries, structure_queries, title_queries, tree_queries  # noqa: F401  they register their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


# ---- dump lines and records --------------------------------------------------------------------


def _field_line() -> Column:
    return F.concat(F.lit("!v"), F.lpad((F.col("o_orderkey") % 900).cast("string"), 3, "0"), F.lit("!"), F.col("o_orderstatus"), F.lit("^p"), F.col("o_orderpriority"))


@query("""
SELECT o_orderkey, 'v' || lpad(CAST(o_orderkey % 900 AS VARCHAR), 3, '0') AS tag, o_orderstatus || '^p' || o_orderpriority AS content FROM orders
""")
def id_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _field_line()
    return _table(spark, sf_dir, "orders").select("o_orderkey", isis.field_tag(line).alias("tag"), isis.field_content(line).alias("content"))


@query("""
WITH p AS (
    SELECT o_orderkey, '_' AS code, o_orderstatus AS value FROM orders
    UNION ALL SELECT o_orderkey, 'p', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'd', CAST(o_orderkey % 7 AS VARCHAR) FROM orders WHERE o_orderkey % 7 > 0)
SELECT o_orderkey, code, value FROM p WHERE value <> ''
""")
def subfield_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.concat("o_orderstatus", F.lit("^dlost^p"), "o_orderpriority", F.lit("^d"), F.when(F.col("o_orderkey") % 7 > 0, (F.col("o_orderkey") % 7).cast("string")).otherwise(F.lit("")))
    # the later of two equal codes wins, but an empty value is no value
    content = F.when(F.col("o_orderkey") % 7 > 0, content).otherwise(F.concat("o_orderstatus", F.lit("^p"), "o_orderpriority", F.lit("^d")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.explode(isis.subfields(content)).alias("code", "value"))


@query(r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, sum(CASE WHEN n = 1 OR regexp_matches(line, '^[A-M]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS field FROM l),
j AS (SELECT doc_id, field, string_agg(trim(line), ' ' ORDER BY n) FILTER (trim(line) <> '' OR n = 1) AS joined FROM k GROUP BY 1, 2)
SELECT doc_id, CAST(field AS BIGINT) AS field, md5(joined) AS joined_md5 FROM j
""")
def continuation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as dumps: a line that begins with A to M starts a field, others continue it."""
    lines = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    starts = (F.col("n") == 0) | F.col("line").rlike("^[A-M]")
    lines = lines.withColumn("line", F.concat(F.when(starts, "!v010!").otherwise(""), F.trim("line")))
    joined = isis.join_continuations(isis.number_records(lines))
    return joined.select(F.col("path").alias("doc_id"), "field", F.md5(isis.field_content(F.col("line"))).alias("joined_md5"))


@query("""
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY event_id % 16 ORDER BY event_id) IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS s, event_id % 16 AS path FROM events),
g AS (SELECT *, sum(s) OVER (PARTITION BY path ORDER BY event_id) AS grp FROM m)
SELECT path, CAST(grp AS BIGINT) AS grp, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_id FROM g GROUP BY 1, 2
""")
def run_length_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn("path", F.col("event_id") % 16)
    grouped = isis.run_length_groups(events, "event_type", "event_id")
    return grouped.groupBy("path", "grp").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of two fields, with a pid of 23 characters."""
    orders = _table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", "o").when(F.col("o_orderstatus") == "F", "i").otherwise("x")
    one = lambda v: F.array(F.create_map(F.lit("_"), v))
    pid = F.concat(F.lit("S"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.year("o_orderdate").cast("string"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 9, "0"))
    record = F.create_map(
        F.lit("v706"), one(kind), F.lit("v880"), one(pid), F.lit("v035"), one(F.lpad(F.col("o_custkey").cast("string"), 9, "0")), F.lit("v036"), one(F.concat(F.year("o_orderdate").cast("string"), (F.col("o_orderkey") % 100).cast("string")))
    )
    return orders.select("o_orderkey", record.alias("record"))


@query("""
WITH p AS (
    SELECT o_orderkey, o_orderstatus, 'S' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || year(o_orderdate) || lpad(CAST(o_orderkey % 100 AS VARCHAR), 9, '0') AS d,
           lpad(CAST(o_custkey AS VARCHAR), 9, '0') || year(o_orderdate) || lpad(CAST(o_orderkey % 100 AS VARCHAR), 4, '0') AS i FROM orders)
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN i ELSE d END AS pid, CASE o_orderstatus WHEN 'F' THEN 'issue' WHEN 'O' THEN 'doc' ELSE 'invalid' END AS kind,
       CASE o_orderstatus WHEN 'O' THEN substr(d, 2, 17) END AS i_id FROM p
""")
def record_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _spelled(spark, sf_dir).select("o_orderkey", isis.article_id("record").alias("pid"), F.array("record").alias("records"))
    return isis.route_groups(groups).select("o_orderkey", "pid", "kind", "i_id")


@query("""
SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 9, '0') || year(o_orderdate) || lpad(CAST(o_orderkey % 100 AS VARCHAR), 4, '0') AS issue_id FROM orders
""")
def issue_id_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelled(spark, sf_dir).select("o_orderkey", isis.issue_id("record").alias("issue_id"))


@query("""
WITH p AS (SELECT DISTINCT 'S' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || year(l_shipdate) || lpad(CAST(l_suppkey % 10000 AS VARCHAR), 4, '0') || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') AS pid FROM lineitem)
SELECT pid, substr(pid, 2, 9) || '/' || substr(pid, 11, 4) || '/' || substr(pid, 15, 4) || '/' || substr(pid, 19, 5) || '.id' AS path FROM p
""")
def pid_partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.concat(F.lit("S"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.year("l_shipdate").cast("string"), F.lpad((F.col("l_suppkey") % 10000).cast("string"), 4, "0"), F.lpad(F.col("l_linenumber").cast("string"), 5, "0"))
    return _table(spark, sf_dir, "lineitem").select(pid.alias("pid")).distinct().select("pid", isis.paragraphs_path(F.col("pid")).alias("path"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records spelled as dump lines, parsed back, typed and counted by their issue."""
    orders = _table(spark, sf_dir, "orders")
    lines = orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.array(F.concat(F.lit("!v706!"), F.lower("o_orderstatus")), F.concat(F.lit("!v012!"), "o_orderpriority", F.lit("^len"))).alias("lines"))
    parsed = lines.select("o_orderkey", "y", F.explode("lines").alias("line")).select("o_orderkey", "y", isis.field_tag(F.col("line")).alias("tag"), isis.subfields(isis.field_content(F.col("line"))).alias("occ"))
    records = parsed.groupBy("o_orderkey", "y").agg(F.map_from_entries(F.collect_list(F.struct("tag", F.array("occ")))).alias("record"))
    typed = records.select("y", fields.record_type("record").alias("rec_type"), fields.field("record", "v12", single=True, simple=True).alias("title"))
    return typed.groupBy("y", "rec_type").agg(F.count("*").alias("n"), F.count_distinct("title").alias("n_titles"))


query("""
SELECT year(o_orderdate) AS y, lower(o_orderstatus) AS rec_type, count(*) AS n, count(DISTINCT o_orderpriority) AS n_titles FROM orders GROUP BY 1, 2
""")(flagship)


@query("""
SELECT o_orderkey, o_orderstatus AS first_simple, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 2 END AS INTEGER) AS n_all_simple,
       o_orderpriority AS renamed_first, CAST(0 AS INTEGER) AS n_absent FROM orders
""")
def field_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.create_map(F.lit("_"), F.col("o_orderstatus"), F.lit("p"), F.col("o_orderpriority"))
    second = F.when(F.col("o_orderkey") % 3 == 0, F.create_map(F.lit("p"), F.lit("x"))).otherwise(F.create_map(F.lit("_"), F.lit("y")))
    record = F.create_map(F.lit("v010"), F.array(first, second))
    return (
        _table(spark, sf_dir, "orders")
        .withColumn("record", record)
        .select(
            "o_orderkey",
            fields.field("record", "v10", single=True, simple=True).alias("first_simple"),
            F.size(fields.field("record", "v010", simple=True)).alias("n_all_simple"),
            fields.field("record", "v010", {"p": "priority"}, single=True)["priority"].alias("renamed_first"),
            F.size(fields.field("record", "v999")).alias("n_absent"),
        )
    )


# ---- attributes of journals, issues and documents ----------------------------------------------


@query("SELECT p_brand, p_type AS code, arg_max(p_name, p_partkey) AS en, arg_max(CAST(p_size AS VARCHAR), p_partkey) AS es FROM part GROUP BY 1, 2")
def collect_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of issues (brands) by code (types) with their titles by language."""
    parts = _table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.max_by("p_name", "p_partkey").alias("en"), F.max_by(F.col("p_size").cast("string"), "p_partkey").alias("es"))
    titles = F.explode(F.create_map(F.lit("en"), "en", F.lit("es"), "es")).alias("language", "text")
    by_code = entities.sections_by_code(parts.select(F.col("p_brand").alias("pid"), F.col("p_type").alias("code"), titles))
    return by_code.select(F.col("pid").alias("p_brand"), "code", F.col("titles")["en"].alias("en"), F.col("titles")["es"].alias("es"))


@query("SELECT user_id, event_id // 64 AS rec, event_type, arg_max(CAST(event_id AS VARCHAR), event_id) AS last_id FROM events WHERE event_id % 5 > 0 GROUP BY 1, 2, 3")
def last_wins_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user, 64 ids at a time, as items with a language and a text, every fifth text empty: the last text of each language."""
    item = F.create_map(F.lit("language"), F.col("event_type"), F.lit("text"), F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("event_id").cast("string")))
    users = _table(spark, sf_dir, "events").groupBy("user_id", F.shiftright("event_id", 6).alias("rec")).agg(F.array_sort(F.collect_list(F.struct("event_id", F.map_entries(item).alias("item")))).alias("items"))
    items = F.transform("items", lambda x: F.map_from_entries(x["item"]))
    return users.select("user_id", "rec", F.explode(entities.last_by(items, "language", "text")).alias("event_type", "last_id"))


_STATUS_CTE = """
WITH u AS (
    SELECT o_custkey, strftime(o_orderdate, '%Y%m%d') AS day, o_orderstatus AS status FROM orders
    UNION ALL SELECT o_custkey, strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d'), CASE o_orderpriority WHEN '1-URGENT' THEN 'C' ELSE substr(o_orderpriority, 1, 1) END FROM orders
    WHERE o_orderpriority <> '2-HIGH')
"""


def _status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as entries and exits of a journal; some have no exit."""
    later = F.when(F.col("o_orderpriority") == "1-URGENT", "C").otherwise(F.substring("o_orderpriority", 1, 1))
    day = lambda c: F.date_format(c, "yyyyMMdd")
    entry = [F.lit("in_date"), day(F.col("o_orderdate")), F.lit("in_status"), F.col("o_orderstatus")]
    leave = [F.lit("out_date"), day(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")), F.lit("out_status"), later]
    item = F.when(F.col("o_orderpriority") == "2-HIGH", F.create_map(*entry)).otherwise(F.create_map(*entry, *leave))
    items = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(item).alias("items"))
    return items.select("o_custkey", entities.status_history("items").alias("events"))


@query(_STATUS_CTE + "SELECT o_custkey, day, status, count(*) AS n FROM u GROUP BY 1, 2, 3")
def status_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _status_events(spark, sf_dir).select("o_custkey", F.explode("events").alias("e"))
    return events.groupBy("o_custkey", F.col("e.date").alias("day"), F.col("e.status").alias("status")).agg(F.count("*").alias("n"))


@query(_STATUS_CTE + "SELECT o_custkey, nullif(max(day || status)[9:], 'C') AS reason FROM u GROUP BY 1")
def unpublish_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_events(spark, sf_dir).select("o_custkey", entities.unpublish_reason(F.col("events")).alias("reason"))


def _day(suffix: str) -> Column:
    """Dates as text, some with a zero month or day."""
    text = F.date_format("o_orderdate", "yyyyMMdd")
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, F.concat(F.substring(text, 1, 6), F.lit("00"))).when(k == 1, F.concat(F.substring(text, 1, 4), F.lit("0000"))).otherwise(text)
    return F.when(F.col("o_orderkey") % 4 == 0, F.lit("")).otherwise(text) if suffix else text


_DAY_CTE = """
WITH b AS (
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS t FROM orders),
d AS (
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN substr(t, 1, 6) || '00' WHEN 1 THEN substr(t, 1, 4) || '0000' ELSE t END AS d FROM b)
"""


@query(_DAY_CTE + """
, f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '20010229' ELSE d END AS t FROM d),
g AS (SELECT o_orderkey, substr(t, 1, 4) || '-' || CASE substr(t, 5, 2) WHEN '00' THEN '06' ELSE substr(t, 5, 2) END || '-' || CASE substr(t, 7, 2) WHEN '00' THEN '15' ELSE substr(t, 7, 2) END AS t FROM f)
SELECT o_orderkey, CAST(TRY_CAST(t AS DATE) AS VARCHAR) AS complete FROM g
""")
def date_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", tx.complete_date([_day("x"), F.lit(None).cast("string"), F.lit("20010229")]).alias("complete"))


@query(_DAY_CTE + """
SELECT o_orderkey, substr(d, 1, 4) AS year, nullif(substr(d, 5, 2), '00') AS month, nullif(substr(d, 7, 2), '00') AS day FROM d
""")
def date_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tx.date_parts(_day(""))
    return _table(spark, sf_dir, "orders").select("o_orderkey", parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"))


@query(_DAY_CTE + """
SELECT o_orderkey, CAST(CAST(substr(d, 1, 4) AS INT) AS VARCHAR) || CASE WHEN substr(d, 5, 2) = '00' THEN '' ELSE '-' || CAST(substr(d, 5, 2) AS INT) ||
       CASE WHEN substr(d, 7, 2) = '00' THEN '' ELSE '-' || CAST(substr(d, 7, 2) AS INT) END END AS iso FROM d
""")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", tx.iso_date(_day("")).alias("iso"))


@query("""
WITH c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'oa' WHEN 1 THEN 'ra' WHEN 2 THEN 'dissertation' ELSE 'qq' END AS code, CASE c_custkey % 3 WHEN 0 THEN 'TR' WHEN 1 THEN 'ed' ELSE 'zz' END AS role FROM customer)
SELECT c_custkey, CASE code WHEN 'oa' THEN 'research-article' WHEN 'ra' THEN 'review-article' ELSE code END AS article_type,
       CASE role WHEN 'TR' THEN 'translator' WHEN 'ed' THEN 'editor' ELSE 'author' END AS contrib_type FROM c
""")
def dim_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    code = F.when(k % 4 == 0, "oa").when(k % 4 == 1, "ra").when(k % 4 == 2, "dissertation").otherwise("qq")
    role = F.when(k % 3 == 0, "TR").when(k % 3 == 1, "ed").otherwise("zz")
    return _table(spark, sf_dir, "customer").select("c_custkey", lookups.article_type(code).alias("article_type"), lookups.contrib_type(role).alias("contrib_type"))


@query("""
WITH n AS (SELECT n_name, substr(n_name, 1, 2) AS a2, min(n_nationkey) OVER (PARTITION BY substr(n_name, 1, 2)) AS f, n_nationkey FROM nation)
SELECT s_suppkey, n.n_name AS country_name, n.a2 AS country_code FROM supplier LEFT JOIN nation m ON s_nationkey = m.n_nationkey LEFT JOIN n ON n.n_name = m.n_name AND s_suppkey % 3 > 0
""")
def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    # codes of two letters that two nations share are left to the names
    countries = n.select(F.substring("n_name", 1, 2).alias("alpha_2_code"), F.lit("").alias("short_name_en"), F.col("n_name").alias("short_name_pt"), F.lit("").alias("short_name_es"))
    s = _table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").withColumn("code", F.when(F.col("s_suppkey") % 3 > 0, F.col("n_name")))
    return lookups.with_country(s, countries, "code").select("s_suppkey", "country_name", "country_code")


@query("""
SELECT DISTINCT l_orderkey, CAST(l_linenumber - 1 AS INTEGER) AS n, l_partkey, s_name, s_nationkey
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber AS line, l_suppkey, l_partkey FROM lineitem)) l JOIN supplier ON l_suppkey = s_suppkey
""".replace("ORDER BY l_linenumber", "ORDER BY line, l_suppkey, l_partkey"))
def author_aff_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as authors of a document, their suppliers as its affiliations."""
    line, s = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "supplier")
    text = lambda c: F.col(c).cast("string")
    author = F.struct("l_linenumber", "l_suppkey", "l_partkey")
    met = line.join(s, line["l_suppkey"] == s["s_suppkey"])
    both = met.groupBy("l_orderkey").agg(F.array_sort(F.collect_set(author)).alias("lines"), F.collect_set(F.struct("s_suppkey", "s_name", "s_nationkey")).alias("affs"))
    docs = both.select(
        F.lit("").alias("path"), F.col("l_orderkey").alias("grp"), text("l_orderkey").alias("pid"),
        F.transform("lines", lambda x: F.create_map(F.lit("xref"), x["l_suppkey"].cast("string"), F.lit("surname"), x["l_partkey"].cast("string"))).alias("authors"),
        F.transform("affs", lambda x: F.create_map(F.lit("id"), x["s_suppkey"].cast("string"), F.lit("orgname"), x["s_name"], F.lit("country"), x["s_nationkey"].cast("string"))).alias("affiliations"),
    )
    met = entities.authors_with_affiliations(docs)
    return met.select(
        F.col("pid").cast("long").alias("l_orderkey"), F.col("n").cast("int").alias("n"), F.col("author")["surname"].cast("long").alias("l_partkey"),
        F.col("affiliation")["orgname"].alias("s_name"), F.col("affiliation")["country"].cast("int").alias("s_nationkey"),
    )


@query("""
WITH o AS (SELECT o_custkey AS path, o_orderkey AS grp, o_orderpriority AS pid, o_orderstatus FROM orders)
SELECT d.path, d.grp, d.pid, max(i.grp) AS issue_grp FROM o d LEFT JOIN o i ON i.path = d.path AND i.pid = d.pid AND i.grp < d.grp AND i.o_orderstatus = 'F'
WHERE d.o_orderstatus <> 'F' GROUP BY 1, 2, 3
""")
def issue_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("grp"), F.col("o_orderpriority").alias("pid"), "o_orderstatus")
    kind = F.when(F.col("o_orderstatus") == "F", "issue").otherwise("doc")
    empty = F.array().cast(f"array<{isis.RECORD_TYPE}>")
    own = F.when(F.col("o_orderstatus") == "F", F.array(F.create_map(F.lit("v000"), F.array(F.create_map(F.lit("_"), F.col("grp").cast("string")))))).otherwise(empty)
    routed = o.select("path", "grp", "pid", own.alias("records"), kind.alias("kind"), F.col("pid").alias("i_id"))
    joined = isis.join_issues_seen(routed)
    return joined.select("path", "grp", "pid", F.try_element_at(joined["issue_records"], F.lit(1))["v000"][0]["_"].cast("long").alias("issue_grp"))


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)")
def semi_ref_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as citations, good labels as the references that the text has."""
    same = [F.lit("pid").alias("pid"), F.col("doc_id").alias("ref_id")]
    good = _table(spark, sf_dir, "labels").filter("quality = 1").select(*same)
    return entities.merge_citations(_table(spark, sf_dir, "documents").select("doc_id", "lang", *same), good).select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "lang").join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT l_orderkey, CAST(max(l_linenumber) - min(l_linenumber) + 1 AS BIGINT) AS pages, count(*) AS n FROM lineitem GROUP BY 1")
def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.max("l_linenumber") - F.min("l_linenumber") + 1).cast("long").alias("pages"), F.count("*").alias("n"))


# ---- markup ------------------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages")


@query("SELECT page_id, md5(regexp_replace(html, '<!--.*?-->', '', 'gs')) AS clean_md5 FROM pages")
def strip_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", F.md5(tx.remove_comments(F.col("html"))).alias("clean_md5"))


_TAGLESS = r"regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')"


@query(f"SELECT page_id, length(regexp_replace({_TAGLESS}, ' ', '', 'g')) AS n_text, md5(regexp_replace({_TAGLESS}, '[ <>]|&lt;|&gt;', '', 'g')) AS text_md5 FROM (SELECT page_id, html FROM pages)")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("html", "<[^>]*>", ""), r"\s+", " ")
    kept = F.regexp_replace(tx.remove_tags(F.col("html")), "[ <>]|&lt;|&gt;", "")
    return _pages(spark, sf_dir).select("page_id", F.length(F.regexp_replace(bare, " ", "")).cast("long").alias("n_text"), F.md5(kept).alias("text_md5"))


@query(r"SELECT page_id, md5(trim(regexp_replace(html, '\s+', ' ', 'g'))) AS md5 FROM pages")
def collapse_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", F.md5(tx.collapse_space(F.col("html"))).alias("md5"))


@query("""
SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(html, '<b>', '<span style="bold">'), '<B>', '<span style="bold">'), '</b>', '</span>'), '</B>', '</span>'),
    '<i>', '<span style="italic">'), '<I>', '<span style="italic">'), '</i>', '</span>'), '</I>', '</span>')) AS md5 FROM pages
""")
def style_to_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", F.md5(tx.avoid_mismatched_styles(F.col("html"), {"b": "bold", "i": "italic"})).alias("md5"))


@query(r"""
SELECT DISTINCT page_id, entity FROM (SELECT page_id, unnest(regexp_extract_all(html, '&[^\s;&#]+;')) AS entity FROM pages) WHERE entity NOT IN ('&amp;', '&lt;', '&gt;', '&quot;', '&apos;')
""")
def entity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", F.explode(tx.entities(F.col("html"))).alias("entity"))


_LINKS = r"""
WITH x AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)\b((?:src|href)\s*=\s*(?:"[^"]*"|''[^'']*''))', 1)) AS x, generate_subscripts(regexp_extract_all(html, '(?i)\b((?:src|href)\s*=\s*(?:"[^"]*"|''[^'']*''))', 1), 1) AS pos FROM pages),
l AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, lower(regexp_extract(x, '^(\w+)', 1)) AS attribute, regexp_extract(x, '=\s*["''](.*)["'']$', 1) AS link FROM x)
"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pages(spark, sf_dir).select("page_id", F.posexplode(tx.links(F.col("html"))).alias("pos", "l"))
    return found.select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), "l.attribute", "l.link")


@query(_LINKS + "SELECT page_id, pos, attribute, link FROM l")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir)


#: What is put before links, so that each kind is there.
_BEFORE = ["", "mailto:x@y.org?subject=", "#", "/img/revistas/aa", "https://h.org", "www.h.org/", "h.org/", "../"]


@query(_LINKS + r"""
, p AS (SELECT page_id, pos, (['', 'mailto:x@y.org?subject=', '#', '/img/revistas/aa', 'https://h.org', 'www.h.org/', 'h.org/', '../'])[1 + (page_id + pos) % 8] || link AS link FROM l)
SELECT page_id, pos, CASE WHEN link = '' THEN 'none' WHEN link LIKE '%mailto%' OR link LIKE '%@%' THEN 'email' WHEN link LIKE '#%' THEN 'internal'
    WHEN link LIKE '%img/revistas/%' OR link LIKE '%..%' THEN 'asset' WHEN link LIKE '%:%' THEN 'external' WHEN link LIKE '%www%' THEN 'external' WHEN link LIKE 'http%' THEN 'external'
    WHEN regexp_matches(string_split(link, '/')[1], '[^.]') AND string_split(link, '/')[1] LIKE '%.%' THEN 'external' ELSE 'other' END AS kind FROM p
""")
def link_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links as they are, and behind beginnings that make them of another kind, by their place."""
    before = F.element_at(F.array(*[F.lit(b) for b in _BEFORE]), ((F.col("page_id") + F.col("pos")) % len(_BEFORE) + 1).cast("int"))
    links = _links(spark, sf_dir).withColumn("link", F.concat(before, "link"))
    kind = F.when(F.col("link") == "", "none").otherwise(body.link_kind_of(F.col("link")))
    return links.select("page_id", "pos", kind.alias("kind"))


@query(_LINKS + "SELECT page_id, link, min(pos) AS pos FROM l GROUP BY 1, 2")
def dedupe_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.first_of_each(_links(spark, sf_dir), ["page_id", "link"], "pos").select("page_id", "link", "pos")


@query(r"SELECT page_id, n_h, n_p, n_a, n_img, n_table FROM (SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<h[1-6][\s>]')) AS BIGINT) AS n_h, CAST(len(regexp_extract_all(html, '(?i)<p[\s>]')) AS BIGINT) AS n_p, CAST(len(regexp_extract_all(html, '(?i)<a[\s>]')) AS BIGINT) AS n_a, CAST(len(regexp_extract_all(html, '(?i)<img[\s>]')) AS BIGINT) AS n_img, CAST(len(regexp_extract_all(html, '(?i)<table[\s>]')) AS BIGINT) AS n_table FROM pages)")
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda tag: F.regexp_count("html", F.lit(rf"(?i)<{tag}[\s>]")).cast("long")
    return _pages(spark, sf_dir).select("page_id", n("h[1-6]").alias("n_h"), n("p").alias("n_p"), n("a").alias("n_a"), n("img").alias("n_img"), n("table").alias("n_table"))


_HEADINGS = r"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)) AS t, generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1), 1) AS pos FROM pages)
"""


@query(_HEADINGS + r"SELECT page_id, CAST(pos AS BIGINT) AS pos, trim(regexp_replace(regexp_replace(t, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS title FROM h")
def heading_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"), F.lit(1))
    return _pages(spark, sf_dir).select("page_id", F.posexplode(found).alias("pos", "t")).select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), tx.collapse_space(F.regexp_replace("t", "<[^>]*>", "")).alias("title"))


# ---- titles and labels -------------------------------------------------------------------------

# Titles and labels whose types are known, for the queries below.
_TITLES = ["Introduction", "2.1 Metodologia", "Results and Discussion", "Resultados e Conclusões", "CONCLUSÃO", "References", "Agradecimentos", "Anexo", "Material suplementar", "Unknown words"]
_LABELS = ["Fig. 1", "Tabla 2", "[3]", "Eq. 4", "Anexo A", "12", "a", "*", "Box 7", "ver também"]


def _with_text(spark: SparkSession, sf_dir: str, texts: list[str], table: str, key: str) -> DataFrame:
    each = F.array(*[F.lit(t) for t in texts])
    return _table(spark, sf_dir, table).select(key, F.element_at(each, (F.col(key) % len(texts) + 1).cast("int")).alias("title"))


def _titles_sql(texts: list[str], answers: dict[str, list[str | None]], table: str, key: str) -> str:
    lit = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    rows = ", ".join("(" + ", ".join([str(i), lit(t), *[lit(a[i]) for a in answers.values()]]) + ")" for i, t in enumerate(texts))
    return f"SELECT {key}, t.title, {', '.join('CAST(t.' + c + ' AS VARCHAR) AS ' + c for c in answers)} FROM {table} JOIN (VALUES {rows}) t(i, title, {', '.join(answers)}) ON {key} % {len(texts)} = t.i"


@query(_titles_sql(_TITLES, {"sec_type": ["intro", "methods", "results|discussion", "results|conclusions", "conclusions", None, None, None, "materials", None], "number": [None, "2.1", *[None] * 8]}, "customer", "c_custkey"))
def sec_type_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = patterns.section_type_and_number(F.col("title"))
    return _with_text(spark, sf_dir, _TITLES, "customer", "c_custkey").select("c_custkey", "title", s["sec_type"].alias("sec_type"), s["number"].alias("number"))


@query(_titles_sql(_LABELS, {"ref_type": ["fig", "table", "bibr", "disp-formula", "app", "number", "letter", "symbol", "boxed-text", "related-article"], "element": ["fig", "table-wrap", "ref", "disp-formula", "app", None, None, None, "boxed-text", "related-article"], "number": ["1", "2", "3", "4", "A", "12", "a", "*", "7", "r"]}, "part", "p_partkey"))
def label_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = patterns.type_from_label(F.col("title"))
    return _with_text(spark, sf_dir, _LABELS, "part", "p_partkey").select("p_partkey", "title", x["ref_type"].alias("ref_type"), x["element"].alias("element"), x["number"].alias("number"))


_NOTES = ["*x", "† y", "‡", "1. §", "1 conflict of interest", "funding"]


@query(_titles_sql(_NOTES, {"fn_type": ["corresp", "deceased", "equal", None, "coi-statement", None], "fn_id": ["fnast", "fndag", "fnddag", "fn1", "fn1", "fnf"]}, "supplier", "s_suppkey"))
def fn_type_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return _with_text(spark, sf_dir, _NOTES, "supplier", "s_suppkey").select("s_suppkey", "title", patterns.footnote_type(t).alias("fn_type"), patterns.footnote_id(patterns.footnote_number(t)).alias("fn_id"))


@query(_titles_sql(_TITLES, {"parent": ["sec", "sec", "sec", "sec", "sec", "ref-list", "ack", "app", "supplementary-material", None]}, "supplier", "s_suppkey"))
def title_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_text(spark, sf_dir, _TITLES, "supplier", "s_suppkey").select("s_suppkey", "title", patterns.title_parent(F.col("title")).alias("parent"))


@query(_titles_sql(_TITLES, {"element_type": ["sec", "sec", "sec", "sec", "sec", "ref-list", "ack", None, "sec", None], "confidence": ["high", "high", "high", "high", "high", None, None, "none", "high", "none"]}, "customer", "c_custkey"))
def element_type_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = patterns.element_type(F.col("title"))
    return _with_text(spark, sf_dir, _TITLES, "customer", "c_custkey").select("c_custkey", "title", e["element_type"].alias("element_type"), e["confidence"].alias("confidence"))


# ---- paths and files ---------------------------------------------------------------------------


@query(r"SELECT page_id, CASE WHEN position('/' IN host_path) > 0 THEN substr(host_path, position('/' IN host_path)) END AS path FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS host_path FROM pages)")
def site_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", tx.site_path(F.col("url")).alias("path"))


_PATHS = "'/var/www/' || CASE p_partkey % 3 WHEN 0 THEN 'bases/pdf/' WHEN 1 THEN 'htdocs/img/' ELSE 'other/' END || lower(p_brand) || '/' || p_partkey"


def _part_path(end: str) -> Column:
    k = F.col("p_partkey")
    root = F.when(k % 3 == 0, "bases/pdf/").when(k % 3 == 1, "htdocs/img/").otherwise("other/")
    return F.concat(F.lit("/var/www/"), root, F.lower("p_brand"), F.lit("/"), k.cast("string"), F.lit(end))


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN substr({_PATHS}, 15) WHEN 1 THEN substr({_PATHS}, 16) END AS rel_path FROM part")
def rel_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", tx.relative_path(_part_path("")).alias("rel_path"))


@query("SELECT p_partkey, replace('c:\\\\' || p_brand || '\\\\' || p_partkey, '\\\\', '/') AS path FROM part".replace("\\\\", "\\"))
def win_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("c:\\"), "p_brand", F.lit("\\"), F.col("p_partkey").cast("string"))
    return _table(spark, sf_dir, "part").select("p_partkey", tx.windows_path(path).alias("path"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'xml' WHEN 1 THEN 'renditions' WHEN 2 THEN 'renditions' ELSE 'assets' END AS role FROM part")
def file_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, _part_path(".xml")).when(k % 4 == 1, _part_path(".pdf")).when(k % 4 == 2, _part_path("-en.pdf")).otherwise(_part_path("-f1.pdf"))
    return _table(spark, sf_dir, "part").select("p_partkey", tx.file_role(name, k.cast("string"), F.array(F.lit("en"), F.lit("es"))).alias("role"))


# Names with every extension that has a type, and some that have none; asset type, mime type and subtype.
_NAMED = [
    ("a.b/c.pdf", "pdf", "application", "pdf"),
    ("a.b/C.GIF", "image", "image", "gif"),
    ("a.b/c.jpg", "image", "image", "jpeg"),
    ("a.b/C.JPEG", "image", "image", "jpeg"),
    ("a.b/c.png", "image", "image", "png"),
    ("a.b/C.TIFF", "image", "image", "tiff"),
    ("a.b/c.bmp", "image", "image", "bmp"),
    ("a.b/C.SVG", "image", "image", "svg+xml"),
    ("a.b/c.mp4", "video", "video", "mp4"),
    ("a.b/C.AVI", "video", "video", "x-msvideo"),
    ("a.b/c.mov", "video", "video", "quicktime"),
    ("a.b/C.WMV", "video", "video", "x-ms-wmv"),
    ("a.b/c.flv", "video", "video", "x-flv"),
    ("a.b/C.MKV", "video", "video", "x-matroska"),
    ("a.b/c.mp3", "audio", "audio", "mpeg"),
    ("a.b/C.WAV", "audio", "audio", "wav"),
    ("a.b/c.ogg", "audio", "audio", "ogg"),
    ("a.b/C.FLAC", "audio", "audio", "flac"),
    ("a.b/c.htm", "html", "text", "html"),
    ("a.b/C.HTML", "html", "text", "html"),
    ("a.b/c.xls", "spreadsheet", "application", "vnd.ms-excel"),
    ("a.b/C.XLSX", "spreadsheet", "application", "vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("a.b/c.xlsm", "spreadsheet", "application", "vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("a.b/C.DOC", "document", "application", "msword"),
    ("a.b/c.docx", "document", "application", "vnd.openxmlformats-officedocument.wordprocessingml.document"),
    ("a.b/C.PPT", "presentation", "application", "vnd.ms-powerpoint"),
    ("a.b/c.pptx", "presentation", "application", "vnd.openxmlformats-officedocument.presentationml.presentation"),
    ("a.b/C.ZIP", "compressed", "application", "zip"),
    ("a.b/c.rar", "compressed", "application", "x-rar-compressed"),
    ("a.b/C.7Z", "compressed", "application", "x-7z-compressed"),
    ("a.b/c.tar", "compressed", "application", "x-tar"),
    ("a.b/C.GZ", "compressed", "application", "x-tar"),
    ("d.e/f", "other", "application", "octet-stream"),
    ("x.unknown", "other", "application", "octet-stream"),
    ("g.gz/h", "other", "application", "octet-stream"),
]
_NAMES = [row[0] for row in _NAMED]
_NAME_ROWS = ", ".join(f"({k}, " + ", ".join(f"'{v}'" for v in row) + ")" for k, row in enumerate(_NAMED))


@query(f"SELECT p_partkey, t.asset_type, t.mimetype, t.mime_subtype FROM part JOIN (VALUES {_NAME_ROWS}) t(i, name, asset_type, mimetype, mime_subtype) ON p_partkey % {len(_NAMES)} = t.i")
def asset_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = patterns.asset_type(F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("p_partkey") % len(_NAMES) + 1).cast("int")))
    return _table(spark, sf_dir, "part").select("p_partkey", *[a[c].alias(c) for c in ("asset_type", "mimetype", "mime_subtype")])


# ---- paragraphs and references -----------------------------------------------------------------


@query("""
WITH b AS (SELECT conv_id, min(turn) FILTER (role = 'assistant' AND turn > 0) AS a, max(turn) FILTER (role = 'assistant' AND turn > 0) AS z FROM conversations GROUP BY 1)
SELECT c.conv_id, CASE WHEN a IS NULL OR turn < a THEN 'before references' WHEN turn <= z THEN 'references' ELSE 'after references' END AS part, count(*) AS n, md5(string_agg(text, '' ORDER BY turn)) AS text_md5
FROM conversations c JOIN b ON b.conv_id = c.conv_id GROUP BY 1, 2
""")
def ref_range_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioframe.operators import paragraphs

    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pid"), F.col("turn").alias("pos"), "text", F.when(F.col("role") == "assistant", F.col("turn").cast("string")).alias("reference_index"))
    parts = paragraphs.split_parts(rows)
    return parts.groupBy(F.col("pid").alias("conv_id"), "part").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("t")).select(
        "conv_id", "part", "n", F.md5(F.array_join(F.transform("t", lambda x: x["text"]), "")).alias("text_md5")
    )


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS guessed_index FROM conversations WHERE trim(regexp_replace(text, '<[^>]*>', '', 'g')) <> ''")
def guessed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioframe.operators import paragraphs

    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pid"), F.col("turn").alias("pos"), "text")
    return paragraphs.guessed_indexes(rows).select(F.col("pid").alias("conv_id"), F.col("pos").alias("turn"), F.col("guessed_index").cast("long").alias("guessed_index"))


@query("SELECT o_custkey, lower(o_orderstatus) AS rec_type, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY 1, 2")
def record_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as the records of a group, typed by their status."""
    record = F.create_map(F.lit("v706"), F.array(F.create_map(F.lit("_"), F.lower("o_orderstatus"))))
    groups = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(record).alias("records"))
    typed = entities.typed_records(groups.select(F.lit("").alias("path"), F.col("o_custkey").alias("grp"), F.col("o_custkey").cast("string").alias("pid"), "records"))
    return entities.record_stats(typed).select(F.col("grp").alias("o_custkey"), "rec_type", "n")


# ---- trees (no SQL: invariants are tested) -----------------------------------------------------


@query()
def html_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of every page by tag and depth, from the tolerant parser."""
    from folioframe.operators import nodes

    return nodes.node_table(spread(_pages(spark, sf_dir)), "page_id", "html").groupBy("page_id", "tag").agg(F.count("*").alias("n"), F.max("depth").alias("max_depth"))


@query()
def body_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.to_json(F.struct(F.col("html").alias("before")))
    made = spread(_pages(spark, sf_dir)).select("page_id", body.convert_body(parts).alias("b"))
    return made.select("page_id", F.col("b.xml").alias("xml"), F.size("b.errors").cast("long").alias("n_errors"))


@query()
def article_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as articles with a title, an author, a language and the converted body."""
    from folioframe.operators import article

    rows = spread(_pages(spark, sf_dir)).select(
        "page_id",
        body.convert_body(F.to_json(F.struct(F.col("html").alias("before"))))["xml"].alias("xml_body"),
        F.col("url").alias("original_title"),
        F.lit("oa").alias("document_type"),
        F.lit("en").alias("original_language"),
        F.array(F.create_map(F.lit("surname"), F.concat(F.lit("Author"), F.col("page_id").cast("string")))).alias("authors"),
        F.lit("1").alias("start_page"),
        F.lit("9").alias("end_page"),
    )
    made = rows.select("page_id", article.article_xml(F.to_json(F.struct(*[c for c in rows.columns if c != "page_id"]))).alias("a"))
    return made.select("page_id", F.col("a.xml").alias("xml"), F.size("a.errors").cast("long").alias("n_errors"))
