"""Writing results: texts by path, code tables, XML and archives."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Parquet, by partition columns: what later reads prune by."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_xml(articles: DataFrame, path: str) -> None:
    """One line of JSON (pid, xml) for each article, partitioned by journal, year and issue order of the pid."""
    part = lambda a, n: F.substring("pid", a, n)
    rows = articles.select("pid", "xml", part(2, 9).alias("issn"), part(11, 4).alias("year"), part(15, 4).alias("issue_order"))
    rows.write.mode("overwrite").partitionBy("issn", "year", "issue_order").json(path)


def write_errors(articles: DataFrame, path: str) -> None:
    articles.select("pid", F.explode("errors").alias("e")).select("pid", "e.*").write.mode("overwrite").json(path)


def zip_files(files: Iterable[str | Path], target: str | Path) -> Path:
    """A zip archive of local files by their base names."""
    target = Path(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for f in files:
            archive.write(f, Path(f).name)
    return target


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Removes a folder of any store that Spark reaches; false if there was none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def dated_name(now: datetime | None = None) -> str:
    """A folder name of the time (UTC), without colons."""
    return (now or datetime.now(UTC).replace(tzinfo=None)).isoformat().replace(":", "")


def temporary_file(name: str, content: str | bytes = b"") -> Path:
    """A new file of that name in a folder of its own, on the machine that asks for it."""
    path = Path(tempfile.mkdtemp()) / name
    path.write_bytes(content.encode("utf-8") if isinstance(content, str) else content)
    return path


def record_text(record: Column, number: Column) -> Column:
    """A record as the lines of a dump: its mark, then a line for each occurrence of each tag; the reader gives the same record again.

    Line ends in values become blanks, as the reader would take what follows for a line of its own.
    """
    one = lambda v: F.replace(F.regexp_replace(v, r"[\r\n]+", " "), F.lit("^"), F.lit("\\^"))
    rest = lambda occ: F.map_filter(occ, lambda k, v: k != "_")
    subfields = lambda occ: F.array_join(F.transform(F.map_entries(rest(occ)), lambda e: F.concat(F.lit("^"), e["key"], one(e["value"]))), "")
    content = lambda occ: F.concat(F.coalesce(one(F.try_element_at(occ, F.lit("_"))), F.lit("")), subfields(occ))
    tags = F.flatten(F.transform(F.map_entries(record), lambda e: F.transform(e["value"], lambda occ: F.concat(F.lit("!"), e["key"], F.lit("!"), content(occ)))))
    return F.concat(F.lit("!ID "), F.format_string("%06d", number.cast("long")), F.lit("\n"), F.array_join(tags, "\n"))


def write_dumps(records: DataFrame, folder: str, parts: list[str], order: list[str], together: int = 1, encoding: str = "ISO-8859-1") -> None:
    """Write records (``record`` and the columns named) as text dumps: a folder ``part=value`` for each value of ``parts``, records in the given order.

    Tasks write ranges of the order, so a part of any size is the work of many, each with a dump of its own; records that agree in the
    first ``together`` columns of the order stay in one dump. Characters that ISO-8859-1 lacks become ``?``. A record is one row, however many lines it has; they are numbered by the order's first column.
    """
    rows = records.repartitionByRange(*parts, *order[:together]).sortWithinPartitions(*parts, *order)
    text = record_text(F.col("record"), F.col(order[0]))
    if encoding.upper() in ("ISO-8859-1", "LATIN1"):
        text = F.regexp_replace(text, r"[^\u0000-\u00FF]", "?")
    rows.select(*parts, F.encode(text, encoding).cast("string").alias("value")).write.partitionBy(*parts).text(folder)  # the writer takes a string's bytes as they are
