"""Reading dumps of tagged-field records (``.id`` text, ISO-8859-1) as DataFrames.

A dump line is ``!ID nnnnnn`` (a record starts), ``!vTTT!content`` (a field) or the continuation of the
field above. Content has ``^x`` subfields. The steps are DataFrame operators, each usable by itself:

    lines  -> records -> fields -> parsed records -> groups

Only the line and record numbering needs an order, and only within one file. It is made of prefix sums over blocks
of a file, so a dump of any size is read and numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.functions.columns import last_of_each
from folioframe.operators.runs import run_length_groups, running_totals

#: Codes that may follow ``^``; ``_`` is the part before the first one.
SUBFIELD_CODES = "_abcdefghijklmnopqrstuvwxyz123456789"
#: What an escaped ``\^`` becomes.
ESCAPED = "ESCAPECIRC"
RECORD_TYPE = "map<string,array<map<string,string>>>"

_SPACE = r"[\s\x1c-\x1f\x85\xa0]"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"^{_SPACE}+|{_SPACE}+$", "")


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, n, line): stripped lines of every file, numbered from 0; lines that are empty stay.

    Files are read in blocks; a line's number is its place in its block and the number of lines in the blocks before.
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    return numbered_lines(raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"), encoding)


def numbered_lines(rows: DataFrame, encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, n, line) of raw lines (path, block, value) as Spark's text reader gives them."""
    rows = rows.select("path", "block", F.monotonically_increasing_id().alias("id"), "value")
    counts = rows.groupBy("path", "block").agg(F.count("*").alias("lines"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("path", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    numbered = rows.withColumn("k", F.row_number().over(Window.partitionBy("path", "block").orderBy("id")) - 1).join(offsets, ["path", "block"])
    return numbered.select("path", (F.col("before") + F.col("k")).alias("n"), strip(F.decode(F.col("value").cast("binary"), encoding)).alias("line"))


def number_records(lines: DataFrame) -> DataFrame:
    """Adds ``rec`` (0 before the first record mark) and ``field`` (running number of field lines, 0 before the first)."""
    starts = F.col("line").startswith("!ID ")
    return running_totals(lines, {"rec": starts, "field": F.col("line").startswith("!v") | starts}, ["path"], "n")


def join_continuations(numbered: DataFrame) -> DataFrame:
    """(path, rec, field, line): one row for each field; continuation lines follow with one blank."""
    fields = numbered.filter((F.col("line") != "") & ~F.col("line").startswith("!ID "))
    joined = fields.groupBy("path", "rec", "field").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("parts"))
    joined = joined.select("path", "rec", "field", F.array_join(F.transform("parts", lambda p: p["line"]), " ").alias("line"))
    return joined.filter(F.col("line").startswith("!v"))


def field_tag(line: Column) -> Column:
    """``v012`` of ``!v012!content``."""
    return F.regexp_extract(line, r"(?s)^!([^!]*)!(.*)$", 1)


def field_content(line: Column) -> Column:
    return F.regexp_extract(line, r"(?s)^!([^!]*)!(.*)$", 2)


def subfields(content: Column, restore_escaped: bool = False) -> Column:
    """``a^bB^cC`` as a map {_: a, b: B, c: C}.

    The last of equal codes wins, empty values are dropped, a chunk with an invalid code is part
    of the value before it. ``\\^`` becomes a fixed word unless it is to be restored. Empty content is null.
    """
    text = F.replace(content, F.lit("\\^"), F.lit(ESCAPED))
    text = F.when(text.startswith("^"), text).otherwise(F.concat(F.lit("^_"), text))
    chunks = F.filter(F.split(text, r"\^"), lambda x: x != "")
    pairs = F.transform(chunks, lambda x: F.struct(F.substring(x, 1, 1).alias("code"), F.substr(x, F.lit(2)).alias("value")))
    valid = lambda c: F.lit(SUBFIELD_CODES).contains(c)
    none = F.array().cast("array<struct<code:string,value:string>>")

    def glue(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        glued = F.struct(last["code"].alias("code"), F.concat(last["value"], F.lit("\\^"), x["code"], x["value"]).alias("value"))
        return F.when(valid(x["code"]), F.concat(done, F.array(x))).when(F.size(done) == 0, done).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(glued)))

    items = F.filter(F.aggregate(pairs, none, glue), lambda p: p["value"] != "")
    found = F.map_from_entries(last_of_each(items, lambda p: p["code"]))
    if restore_escaped:
        found = F.transform_values(found, lambda k, v: F.replace(v, F.lit(ESCAPED), F.lit("^")))
    return F.when(content.isNull() | (content == ""), None).otherwise(found)


def build_records(fields: DataFrame) -> DataFrame:
    """(path, rec, record): each record's occurrences by tag, in source order; fields without tag or content are dropped."""
    parsed = fields.select("path", "rec", "field", field_tag(F.col("line")).alias("tag"), subfields(field_content(F.col("line"))).alias("occ"))
    parsed = parsed.filter((F.col("tag") != "") & F.col("occ").isNotNull() & (F.size("occ") > 0))
    tags = parsed.groupBy("path", "rec", "tag").agg(F.array_sort(F.collect_list(F.struct("field", F.map_entries("occ").alias("occ")))).alias("occs"))
    tags = tags.withColumn("occs", F.transform("occs", lambda o: F.map_from_entries(o["occ"])))
    return tags.groupBy("path", "rec").agg(F.map_from_entries(F.collect_list(F.struct("tag", "occs"))).alias("record"))


def value(record: Column | str, tag: str) -> Column:
    """Text of the first occurrence of a tag (``880``, ``v880``), null on a miss."""
    return F.try_element_at(F.try_element_at(values_of(record, tag), F.lit(1)), F.lit("_"))


def values_of(record: Column | str, tag: str) -> Column:
    record = F.col(record) if isinstance(record, str) else record
    return F.try_element_at(record, F.lit("v" + tag.removeprefix("v").zfill(3)))


def items(record: Column | str, tag: str) -> Column:
    """Texts of all occurrences of a tag."""
    return F.transform(values_of(record, tag), lambda x: F.try_element_at(x, F.lit("_")))


def journal_id(record: Column | str) -> Column:
    return value(record, "400")


def issue_order(year_and_order: Column) -> Column:
    """Year and, to four digits, order: ``20193`` as ``20190003``."""
    order = F.substr(year_and_order, F.lit(5))
    return F.concat(F.substring(year_and_order, 1, 4), F.when(F.length(order) >= 4, order).otherwise(F.lpad(order, 4, "0")))


def issue_id(record: Column | str) -> Column:
    return F.concat(value(record, "035"), issue_order(value(record, "036")))


def article_id(record: Column | str) -> Column:
    kind = value(record, "706")
    pid = F.substring(value(record, "880"), 1, 23)
    return F.when(kind.isNull(), None).when(kind == "i", issue_id(record)).otherwise(F.coalesce(F.when(pid != "", pid), value(record, "702")))


def id_function(kind: str) -> Callable[[Column | str], Column]:
    """The identity of a record by the database it is from: title, issue or any other."""
    return {"title": journal_id, "issue": issue_id}.get(kind, article_id)


def group_records(records: DataFrame, kind: str = "artigo") -> DataFrame:
    """(path, grp, pid, records): consecutive records of one identity, in order."""
    keyed = records.withColumn("pid", id_function(kind)("record"))
    grouped = run_length_groups(keyed, "pid", "rec")
    by_place = lambda a, b: F.when(a["rec"] < b["rec"], -1).when(a["rec"] > b["rec"], 1).otherwise(0)
    packed = F.array_sort(F.collect_list(F.struct("rec", "record")), by_place)
    out = grouped.groupBy("path", "grp").agg(F.first("pid").alias("pid"), packed.alias("records"))
    return out.withColumn("records", F.transform("records", lambda r: r["record"]))


def read_records(spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, rec, record) of all dumps under the path."""
    return build_records(join_continuations(number_records(read_lines(spark, path, encoding))))


def read_isis(spark: SparkSession, path: str | list[str] | None, kind: str = "artigo", encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, grp, pid, records) of all dumps under the path; no path gives an empty table."""
    if not path:
        return spark.createDataFrame([], f"path string, grp long, pid string, records array<{RECORD_TYPE}>")
    return group_records(read_records(spark, path, encoding), kind)


def route_groups(groups: DataFrame) -> DataFrame:
    """Adds ``kind`` (issue, doc or invalid) and, for documents, ``i_id``, the issue they belong to."""
    first = value(F.col("records")[0], "706")
    kind = F.when(first == "i", "issue").when((first == "o") & (F.length("pid") == 23), "doc").otherwise("invalid")
    return groups.withColumn("kind", kind).withColumn("i_id", F.when(F.col("kind") == "doc", F.substring("pid", 2, 17)))


def join_issues_seen(routed: DataFrame) -> DataFrame:
    """Documents with the records of their issue, if it came before them in the same dump; of several, the latest.

    One pass over each issue's documents and records, in order: a repeated issue costs no more than its rows.
    """
    is_issue = F.col("kind") == "issue"
    # what belongs to no issue has a place of its own
    issue = F.coalesce(F.when(is_issue, F.col("pid")).otherwise(F.col("i_id")), F.concat(F.lit("\x1f"), F.col("grp").cast("string")))
    w = Window.partitionBy("path", "_issue").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(is_issue & F.col("pid").isNotNull(), F.struct("pid", "records")), ignorenulls=True).over(w)
    out = routed.withColumn("_issue", issue).withColumn("_seen", seen).filter(~is_issue)
    return out.select("*", F.col("_seen.pid").alias("issue_pid"), F.col("_seen.records").alias("issue_records")).drop("_issue", "_seen")


# Lookups that the dumps' own tools do by index


def by_pid_prefix(df: DataFrame, pid: str) -> DataFrame:
    return df.filter(F.col("pid").startswith(pid))


def by_issue_folder(df: DataFrame, folder: str) -> DataFrame:
    return df.filter(F.col("issue_folder") == folder)


def changed_pids(lines: DataFrame, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """(updated, pid) of index lines ``...OAITS=yyyymmdd...=pid`` between two dates."""
    parts = F.split("line", "=")
    out = lines.select(F.regexp_extract(parts[1], "([0-9]{8})", 1).alias("updated"), F.concat(F.lit("S"), F.element_at(parts, -1)).alias("pid"))
    return out.filter(F.col("updated").between(from_date or "00000000", to_date or "99999999"))


def paragraphs_path(pid: Column) -> Column:
    """``issn/year/order/last5.id`` of a 23-character pid; other lengths are null."""
    part = lambda a, n: F.substring(pid, a, n)
    return F.when(F.length(pid) == 23, F.concat_ws("/", part(2, 9), part(11, 4), part(15, 4), F.concat(part(19, 5), F.lit(".id"))))


def first_existing(candidates: Iterable[Callable[[], list[str]]]) -> list[str]:
    """The paths of the first candidate source that has any; sources that fail are skipped."""
    for candidate in candidates:
        try:
            found = candidate()
        except OSError:
            continue
        if found:
            return found
    return []
