"""An index kept beside dumps: from keys of record groups to the bytes that hold them.

``write_index`` reads the dumps once, without numbering lines, and writes a row for each group of records (pid, kind, issue, folder, updated, path, grp, start, stop,
n_records), three times: sorted by pid, by date of update and by issue folder. A lookup reads the rows of its keys only (they lie together, so the
others are skipped by the statistics of Parquet's row groups) and then, of the dumps, only the bytes of the groups it found: ranges are
dealt to tasks in the order of file and place, and each task seeks them. Nothing passes through the driver, so a lookup may be of
one pid or of a table of millions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators.runs import run_length_groups
from folioframe.sources import isis
from folioframe.sources.dump_source import block_records, open_store, read_dump_records, records_of
from folioframe.sources.scratch import stored

#: What the index is sorted by, each a copy of its own.
ORDERS = ("pid", "updated", "folder")
#: Rows of an index file, and bytes of a row group.
ROWS, GROUP_BYTES = 4_000_000, 1 << 20
SCHEMA = "pid string, kind string, issue string, folder string, updated string, path string, grp long, start long, stop long, n_records long"


def group_extents(records: DataFrame, kind: str = "artigo") -> DataFrame:
    """The index's rows, from records with their start and stop in bytes: runs of consecutive records of one identity, and where they lie.

    A record without a pid makes a group without one.
    """
    keyed = records.select("path", "rec", "start", "stop", "record", isis.id_function(kind)("record").alias("pid"))
    told = {"type": "706", "folder": "004", "updated": "091"}
    records = stored(keyed.select("path", "rec", "start", "stop", "pid", *[isis.value("record", tag).alias(c) for c, tag in told.items()]))
    grouped = run_length_groups(records, "pid", "rec")
    first = lambda c: F.min_by(c, "rec")
    groups = grouped.groupBy("path", "grp").agg(
        first("pid").alias("pid"), first("type").alias("type"), first("folder").alias("folder"), F.max("updated").alias("updated"),
         F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_records"),
    )
    kinds = F.when(F.col("type") == "i", "issue").when((F.col("type") == "o") | (F.col("type") == "h"), "doc").otherwise("other")
    issue = F.when(kinds == "issue", F.col("pid")).when(F.length("pid") == 23, F.substring("pid", 2, 17))
    return groups.select("pid", kinds.alias("kind"), issue.alias("issue"), "folder", "updated", "path", "grp", "start", "stop", "n_records")


def write_index(records: DataFrame, target: str, kind: str = "artigo") -> None:
    """Write the index of all dumps that the records (``read_dump_records``) are from; an index that is there is replaced."""
    spark = records.sparkSession
    group_extents(records, kind).write.mode("overwrite").parquet(f"{target}/groups")
    groups = spark.read.schema(SCHEMA).parquet(f"{target}/groups")
    files = max(1, -(-groups.count() // ROWS))
    for key in ORDERS:
        ordered = groups.repartitionByRange(files, key, "path", "start").sortWithinPartitions(key, "path", "start")
        ordered.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(f"{target}/{key}")


class DumpIndex:
    """Lookups of record groups; each gives rows of the index, which ``groups`` reads from the dumps."""

    def __init__(self, spark: SparkSession, target: str, encoding: str = "ISO-8859-1"):
        self.spark, self.target, self.encoding = spark, target, encoding

    def by(self, key: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.target}/{key}")

    def pid(self, pid: str) -> DataFrame:
        return self.by("pid").filter(F.col("pid") == pid)

    def prefix(self, pid: str) -> DataFrame:
        """All pids that begin so: those of a journal, of a journal's year, or of an issue."""
        return self.by("pid").filter(F.col("pid").startswith(pid))

    def pids(self, wanted: DataFrame) -> DataFrame:
        """Those of a table with a column pid."""
        return self.by("pid").join(wanted.select("pid").distinct(), "pid", "left_semi")

    def changed(self, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
        """Groups last updated between two dates (yyyymmdd), both included; those without a date are never found."""
        return self.by("updated").filter(F.col("updated").between(from_date or "00000000", to_date or "99999999"))

    def issue_folder(self, folder: str) -> DataFrame:
        return self.by("folder").filter(F.col("folder") == folder)

    def records(self, found: DataFrame) -> DataFrame:
        """(path, grp, rec, record): the records of the groups; rec is their offset."""
        spots = stored(found.select("path", "start", "stop", "grp").distinct())  # ranges of the order are sampled first
        dealt = spots.repartitionByRange(F.col("path"), F.col("start")).sortWithinPartitions("path", "start")
        raw = dealt.mapInArrow(_read(self.encoding), "path string, start long, stop long, line string")
        parts = F.split("path", "\x1f")
        return records_of(raw).select(parts[0].alias("path"), parts[1].cast("long").alias("grp"), "rec", "record")

    def groups(self, found: DataFrame, kind: str = "artigo") -> DataFrame:
        """(path, grp, pid, records), as ``read_isis`` gives them, of the groups found."""
        keyed = self.records(found).withColumn("pid", isis.id_function(kind)("record"))
        by_place = lambda a, b: F.when(a["rec"] < b["rec"], -1).when(a["rec"] > b["rec"], 1).otherwise(0)
        packed = F.array_sort(F.collect_list(F.struct("rec", "record")), by_place)
        out = keyed.groupBy("path", "grp").agg(F.first("pid").alias("pid"), packed.alias("records"))
        return out.withColumn("records", F.transform("records", lambda r: r["record"]))


def _read(encoding: str):
    """The records of byte ranges, which come in the order of file and place; the path is that of the file with the group's number."""

    def work(batches):
        name, file = None, None
        for batch in batches:
            for path, start, stop, grp in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop", "grp")), strict=True):
                if path != name:
                    if file:
                        file.close()
                    store, where = open_store(path)
                    name, file = path, store.open_input_file(where)
                at, to, lines = zip(*block_records(file, start, stop, beyond=False), strict=True)
                named = pa.array([f"{path}\x1f{grp}"] * len(at), pa.string())
                text = pa.array([x.decode(encoding) for x in lines], pa.string())
                yield pa.RecordBatch.from_arrays([named, pa.array(at, pa.int64()), pa.array(to, pa.int64()), text], ["path", "start", "stop", "line"])
        if file:
            file.close()

    return work


def indexed(spark: SparkSession, root: str, target: str, kind: str = "artigo", **options) -> DumpIndex:
    """Index the dumps below root and open the index."""
    write_index(read_dump_records(spark, root, **options), target, kind)
    return DumpIndex(spark, target, options.get("encoding", "ISO-8859-1"))
