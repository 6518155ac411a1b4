"""Dumps that arrive in a folder, as a stream of record groups kept up to date in a table.

A file is one unit: it is read whole, so records and groups never cross batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioframe.sources import isis

_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    return spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", per_batch).option("pathGlobFilter", "*.id").load(folder)


def groups_of_files(files: DataFrame, kind: str = "artigo", encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, grp, pid, records) of a batch of files with their contents."""
    lines = files.select("path", F.posexplode(F.split(F.decode("content", encoding), "\r\n|\r|\n")).alias("n", "line")).select("path", "n", isis.strip(F.col("line")).alias("line"))
    return isis.group_records(isis.build_records(isis.join_continuations(isis.number_records(lines))), kind)


def latest(groups: DataFrame) -> DataFrame:
    """The last group of each pid, by arrival, then by place."""
    last = F.max_by(F.struct(*groups.columns), F.struct("arrived", "path", "grp"))
    return groups.groupBy("pid").agg(last.alias("last")).select("last.*")


def run(spark: SparkSession, folder: str, target: str, checkpoint: str, kind: str = "artigo", available_now: bool = True) -> StreamingQuery:
    """Appends the groups of new files to a Parquet table, each batch to its own partition, so a batch that runs again replaces itself."""

    def sink(files: DataFrame, batch: int) -> None:
        times = files.select("path", F.col("modificationTime").alias("arrived"))
        rows = groups_of_files(files, kind).join(times, "path")
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    writer = stream_files(spark, folder).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
