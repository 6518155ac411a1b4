"""Queries over dumps: conversations are written as text dumps in the shared folder, and read as any site's dumps are.

Fifty turns of a conversation are a document: a record of its own (type o) and one for each turn (type c), with one pid. Its journal, its year and its
month are digits of the conversation's number. Every twentieth conversation is an issue's record alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.plans.catalogue import _table, query
from folioframe.sources import isis
from folioframe.sources.dump_index import DumpIndex, write_index
from folioframe.sources.dump_source import read_dump_records
from folioframe.sources.precedence import documents_by_issue, issue_sources
from folioframe.sources.scratch import new_folder, stored
from folioframe.sources.sinks import write_dumps
from folioframe.streaming.merged import MergedTable


def _texts(*values: Column) -> Column:
    return F.array(*[F.create_map(F.lit("_"), v) for v in values])


def _record(**tags: Column) -> Column:
    """A record of (tag, occurrences)."""
    return F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(t).alias("tag"), c.alias("occs")) for t, c in tags.items()]), lambda x: x["occs"].isNotNull()))


def dump_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, line, conv_id, issn, year, issue, record): the records of all conversations; ``doc`` orders the documents."""
    turns = _table(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL AND turn IS NOT NULL").withColumn("doc", F.expr("conv_id * 1000 + turn div 50"))
    turns = turns.withColumn("issn", F.concat(F.lit("0000-000"), F.col("conv_id") % 10))
    turns = turns.withColumns({"year": F.expr("CAST(1990 + conv_id div 120 % 20 AS STRING)"), "month": F.expr("1 + conv_id div 10 % 12")})
    turns = turns.withColumn("issue", F.lpad(F.col("month").cast("string"), 4, "0")).withColumn("pid", F.concat(F.lit("S"), "issn", "year", "issue", F.lpad((F.col("doc") % 100_003).cast("string"), 5, "0")))
    keys, is_issue = ["doc", "conv_id", "issn", "year", "issue", "month", "pid"], F.col("conv_id") % 20 == 0
    documents = turns.groupBy(*keys).agg(F.min("turn").alias("first"), F.min("role").alias("role"))
    day = F.concat("year", F.lpad(F.col("month").cast("string"), 2, "0"), F.lpad((1 + F.col("conv_id") % 28).cast("string"), 2, "0"))
    head = _record(
        v706=_texts(F.when(is_issue, "i").otherwise("o")), v880=F.when(~is_issue, _texts(F.col("pid"))), v004=_texts(F.concat(F.lit("v"), "year", F.lit("n"), "month")), v091=_texts(day),
        v035=_texts(F.col("issn")), v036=_texts(F.concat("year", "month")),
        v010=F.array(F.create_map(F.lit("_"), F.coalesce("role", F.lit("none")), F.lit("s"), F.col("first").cast("string")), F.create_map(F.lit("n"), F.col("conv_id").cast("string"))),
    )
    citation = _record(
        v706=_texts(F.lit("c")), v880=_texts(F.col("pid")), v701=_texts(F.col("turn").cast("string")), v031=_texts(F.length(F.coalesce("text", F.lit(""))).cast("string")),
        v012=F.array(F.create_map(F.lit("_"), F.coalesce("text", F.lit("")), F.lit("l"), F.coalesce("role", F.lit("none")))),
    )
    shown = ["doc", "conv_id", "issn", "year", "issue"]
    cited = turns.filter(~is_issue).select(*shown, (F.col("turn") + 1).alias("line"), citation.alias("record"))
    return documents.select(*shown, F.lit(0).cast("long").alias("line"), head.alias("record")).unionByName(cited)


def _facts(groups: DataFrame) -> list[Column]:
    """What the SQL says of a group of records: its first record's fields, and of its citations the sum of a field and a digest of texts and roles."""
    first = F.col("records")[0]
    citations = F.filter("records", lambda r: isis.value(r, "706") == "c")
    size = F.aggregate(citations, F.lit(0).cast("long"), lambda n, r: n + isis.value(r, "031").cast("long"))
    said = lambda r: F.concat(F.coalesce(isis.value(r, "012"), F.lit("")), F.lit("|"), F.try_element_at(isis.values_of(r, "012")[0], F.lit("l")))
    author = isis.values_of(first, "010")
    return [
        F.size("records").cast("long").alias("n_records"), F.try_element_at(author[0], F.lit("s")).alias("first"), F.try_element_at(author[1], F.lit("n")).alias("conversation"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.md5(F.array_join(F.transform(citations, said), ",")).alias("said_md5"),
    ]


_GROUPS_SQL = r"""
t AS (
    SELECT conv_id * 1000 + turn // 50 AS doc, conv_id, turn, role, coalesce(text, '') AS text, '0000-000' || conv_id % 10 AS issn, CAST(1990 + (conv_id // 120) % 20 AS VARCHAR) AS year,
           1 + (conv_id // 10) % 12 AS month FROM conversations),
d AS (
    SELECT doc, conv_id, issn, year, month, lpad(CAST(month AS VARCHAR), 4, '0') AS issue, conv_id % 20 = 0 AS is_issue, count(*) AS n, CAST(min(turn) AS VARCHAR) AS first, min(role) AS role, sum(length(text)) AS size,
           string_agg(replace(regexp_replace(text, '[\r\n]+', ' ', 'g'), '^', 'ESCAPECIRC') || '|' || coalesce(role, 'none'), ',' ORDER BY turn) AS said
    FROM t GROUP BY ALL),
g AS (
    SELECT doc, CASE WHEN is_issue THEN issn || year || issue ELSE 'S' || issn || year || issue || lpad(CAST(doc % 100003 AS VARCHAR), 5, '0') END AS pid, is_issue, role,
           conv_id, issn, year, issue, issn || year || issue AS issue_pid, 'v' || year || 'n' || month AS folder, month,
           year || lpad(CAST(month AS VARCHAR), 2, '0') || lpad(CAST(1 + conv_id % 28 AS VARCHAR), 2, '0') AS updated,
           CASE WHEN is_issue THEN 1 ELSE 1 + n END AS n_records, first, CAST(conv_id AS VARCHAR) AS conversation,
           CAST(CASE WHEN is_issue THEN 0 ELSE size END AS BIGINT) AS size, md5(CASE WHEN is_issue THEN '' ELSE said END) AS said_md5
    FROM d)"""


@query(f"""
WITH {_GROUPS_SQL}
SELECT pid, CASE WHEN is_issue THEN 'issue' ELSE 'doc' END AS kind, CASE WHEN NOT is_issue THEN issue_pid END AS i_id, n_records, first, conversation, size, said_md5 FROM g
""")
def dump_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as dumps, read by Spark's text reader, grouped and routed."""
    folder = new_folder(spark)
    write_dumps(dump_records(spark, sf_dir).withColumn("part", F.col("conv_id") % 4), folder, ["part"], ["doc", "line"], encoding="UTF-8")
    routed = isis.route_groups(isis.read_isis(spark, folder, encoding="UTF-8"))
    return routed.select("pid", "kind", "i_id", *_facts(routed))


@query(f"""
WITH {_GROUPS_SQL},
k AS (
    SELECT 'journal and year' AS sought, * FROM g WHERE NOT is_issue AND issn = '0000-0007' AND year = '1990'
    UNION ALL SELECT 'issues', * FROM g WHERE NOT is_issue AND issn IN ('0000-0001', '0000-0003') AND issue = '0006'
    UNION ALL SELECT 'pid prefix', * FROM g WHERE NOT is_issue AND issn = '0000-0002' AND year LIKE '199%' AND issue < '0010')
SELECT sought, pid, n_records, first, conversation, size, said_md5 FROM k
""")
def dump_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps in folders of journal, year and issue, read by the data source: what is sought chooses the folders that are listed and the files that are opened."""
    folder = new_folder(spark)
    write_dumps(dump_records(spark, sf_dir), folder, ["issn", "year", "issue"], ["doc", "line"], encoding="UTF-8")
    sought = {
        "journal and year": ({"issn": ["0000-0007"], "year": ["1990"]}, None),
        "issues": ({"issn": ["0000-0001", "0000-0003"], "issue": ["0006"]}, None),
        "pid prefix": ({"issn": ["0000-0002"]}, {"year": ["199"], "issue": ["000"]}),
    }
    parts = [read_dump_records(spark, folder, *wanted, suffix=".txt", encoding="UTF-8").withColumn("path", F.concat(F.lit(name + "|"), "path")) for name, wanted in sought.items()]
    groups = isis.group_records(reduce(DataFrame.unionByName, parts)).filter(F.col("pid").startswith("S"))
    return groups.select(F.split("path", r"\|")[0].alias("sought"), "pid", *_facts(groups))


@query(f"""
WITH {_GROUPS_SQL},
k AS (
    SELECT 'pids' AS sought, * FROM g WHERE pid IN (SELECT pid FROM g WHERE NOT is_issue AND role = 'assistant')
    UNION ALL SELECT 'prefix', * FROM g WHERE NOT is_issue AND issn = '0000-0007' AND year = '1990'
    UNION ALL SELECT 'changed', * FROM g WHERE updated BETWEEN '19900301' AND '19900515'
    UNION ALL SELECT 'folder', * FROM g WHERE folder = 'v1990n3')
SELECT sought, pid, n_records, first, conversation, size, said_md5 FROM k
""")
def dump_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps with an index beside them, and four lookups that read only the bytes of the groups they find: pids of a table, a prefix, dates, an issue folder."""
    folder, target = new_folder(spark), new_folder(spark)
    write_dumps(dump_records(spark, sf_dir).withColumn("part", F.col("conv_id") % 4), folder, ["part"], ["doc", "line"], encoding="UTF-8")
    write_index(read_dump_records(spark, folder, suffix=".txt", encoding="UTF-8"), target)
    index = DumpIndex(spark, target, "UTF-8")
    answered = dump_records(spark, sf_dir).filter((F.col("line") == 0) & (isis.value("record", "010") == "assistant")).select(isis.value("record", "880").alias("pid"))
    sought = {"pids": index.pids(answered), "prefix": index.prefix("S0000-00071990"), "changed": index.changed("19900301", "19900515"), "folder": index.issue_folder("v1990n3")}
    found = stored(reduce(DataFrame.unionByName, [rows.withColumn("sought", F.lit(name)) for name, rows in sought.items()]))
    groups = index.groups(found)  # what several ask for is read once
    return groups.join(found.select("path", "grp", "sought"), ["path", "grp"]).select("sought", "pid", *_facts(groups))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations)
SELECT conv_id, turn, role, md5(coalesce(text, '')) AS text_md5 FROM r WHERE k = 1 AND conv_id % 7 + turn % 3 <> 2
""")
def merged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as changes of their conversation, in five batches that come out of order, one of them twice; some turns remove it until a later one."""
    turns = _table(spark, sf_dir, "conversations").withColumn("gone", F.col("conv_id") % 7 + F.col("turn") % 3 == 2)
    table = MergedTable(spark, new_folder(spark), turns.schema, key="conv_id", order=["turn"], deleted="gone", buckets=16)
    for number, part in enumerate([3, 1, 4, 1, 0, 2]):
        table.upsert(turns.filter(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == part), number)
    return table.read().select("conv_id", "turn", "role", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query(f"""
WITH {_GROUPS_SQL},
j AS (SELECT *, 'j' || right(issn, 1) AS acronym FROM g WHERE NOT is_issue),
c AS (
    SELECT 0 AS rank, * FROM j WHERE month % 5 = 0 AND conv_id % 3 > 0
    UNION ALL SELECT 1, * FROM j WHERE acronym NOT IN ('j3', 'j5')
    UNION ALL SELECT 2, * FROM j WHERE month % 3 = 0 AND conv_id % 2 = 1
    UNION ALL SELECT 3, * FROM j WHERE acronym <> 'j3'),
b AS (SELECT acronym, folder, min(rank) AS rank FROM c GROUP BY acronym, folder)
SELECT c.acronym, c.folder, c.issue_pid, c.rank, pid, n_records, first, conversation, size, said_md5
FROM c JOIN b ON b.acronym = c.acronym AND b.folder = c.folder AND b.rank = c.rank
""")
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of a site at once: some have dumps of their own, some a database's, the journal's dump lacks some journals (j3) or tells no issue folders (j5)."""
    folder, target = new_folder(spark), new_folder(spark)
    rows = stored(dump_records(spark, sf_dir).filter("conv_id % 20 <> 0").withColumn("acronym", F.concat(F.lit("j"), F.right("issn", F.lit(1)))))
    rows = rows.withColumn("month", F.col("issue").cast("int")).withColumn("folder", F.concat(F.lit("v"), "year", F.lit("n"), "month"))
    untold = F.when((F.col("acronym") == "j5") & (F.col("line") == 0), F.map_filter("record", lambda k, v: k != "v004")).otherwise(F.col("record"))
    copies = [
        rows.filter("month % 5 = 0 AND conv_id % 3 > 0").withColumn("dump", F.concat_ws(" ", F.lit("xml"), "acronym", "folder")),
        rows.filter("month % 3 = 0 AND conv_id % 2 = 1").withColumn("dump", F.concat_ws(" ", F.lit("base"), "acronym", "folder")),
        rows.filter("acronym <> 'j3'").withColumn("record", untold).withColumn("dump", F.concat_ws(" ", F.lit("journal"), "acronym")),
    ]
    write_dumps(copies[0].unionByName(copies[1]).unionByName(copies[2]), folder, ["dump"], ["doc", "line"], encoding="UTF-8")
    write_index(read_dump_records(spark, folder, suffix=".txt", encoding="UTF-8"), target)
    issues = rows.select("acronym", "folder", F.concat("issn", "year", "issue").alias("issue_pid")).distinct()
    dump = F.replace(F.url_decode(F.regexp_extract("path", "/dump=([^/]+)/", 1)), F.lit(" "), F.lit("/"))
    found = documents_by_issue(DumpIndex(spark, target, "UTF-8"), issue_sources(issues), dump)
    return found.select("acronym", "folder", "issue_pid", "rank", "pid", *_facts(found))
