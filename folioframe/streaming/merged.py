"""A table that is kept up to date by key from a feed of changes, batch by batch.

The table is cut into buckets by a hash of the key, and each bucket lies in the version of the batch that last changed it. A batch
is reduced to the last change of each key, merged with what its buckets hold, and written as a new version of these buckets alone; then a
manifest of the whole table (a row for each bucket, so of a fixed size) is written. Readers take the last complete
manifest, so they see a batch whole or not at all, and an earlier state can still be read.

Of a key's changes the one with the largest value of ``order`` counts, whatever batch brings it. So batches may come late, in any order and more than once: the
table is the same as that of all changes at once. A batch that runs again after a failure writes its version anew from the
manifest before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from folioframe.sources import isis
from folioframe.sources.sinks import delete_folder

_MANIFEST = "bucket int, version long"


class MergedTable:
    """``key``: what a row is a state of; ``order``: columns by whose values the last change is told; ``deleted``: a boolean column of changes that remove their key.

    * a null key is a key like any other; null values of ``order`` come before all others;
    * removed keys stay in the files, so that an older change that comes later does not bring them back, but ``read`` leaves them out;
    * changes that agree in key and order are taken for the same; of those that differ all the same, one is kept;
    * a batch without rows changes nothing but the manifest; a key with a third of a batch's rows is reduced where the rows are read.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | StructType, key: str = "pid", order: Sequence[str] = ("arrived", "path", "grp"), deleted: str | None = None, buckets: int = 64):
        self.spark, self.root, self.key, self.order, self.deleted, self.buckets = spark, root.rstrip("/"), key, list(order), deleted, buckets
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    # where things lie

    def _exists(self, path: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def _names(self, path: str) -> list[str]:
        if not self._exists(path):
            return []
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return [f.getPath().getName() for f in where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)]

    def batches(self) -> list[int]:
        """The batches with a complete manifest, in order."""
        found = [n for n in self._names(f"{self.root}/manifest") if n.startswith("batch=")]
        return sorted(int(n.split("=")[1]) for n in found if self._exists(f"{self.root}/manifest/{n}/_SUCCESS"))

    def versions(self, batch: int | None) -> dict[int, int]:
        """The version of each bucket that has one, after a batch."""
        if batch is None:
            return {}
        return {r["bucket"]: r["version"] for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/batch={batch}").collect()}  # a row a bucket

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last change of each key."""
        whole = F.max_by(F.struct(*[F.col(f) for f in self.schema.names]), F.struct(*self.order))
        return rows.groupBy(F.col(self.key).alias("_key")).agg(whole.alias("last")).select("last.*")

    def _stored(self, versions: dict[int, int], buckets: Sequence[int]) -> DataFrame:
        paths = [f"{self.root}/data/version={versions[b]}/bucket={b}" for b in buckets if b in versions]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    # what is done with them

    def upsert(self, changes: DataFrame, batch: int) -> int:
        """Merge a batch of changes; returns how many buckets it wrote. Batches have growing numbers; that of a batch that runs again is its own."""
        before = [b for b in self.batches() if b < batch]
        versions = self.versions(before[-1] if before else None)
        last = self._last(changes.select(*self.schema.names)).withColumn("_bucket", self._bucket())
        touched = [r[0] for r in last.select("_bucket").distinct().collect()]  # at most as many as there are buckets
        if touched:
            merged = self._last(last.drop("_bucket").unionByName(self._stored(versions, touched)))
            out = merged.withColumn("bucket", self._bucket()).repartition(min(self.buckets, len(touched)), "bucket")
            out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/version={batch}")
        rows = [(b, v) for b, v in {**versions, **dict.fromkeys(touched, batch)}.items()]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/batch={batch}")
        return len(touched)

    def read(self, batch: int | None = None, removed: bool = False) -> DataFrame:
        """The table after the last batch, or after one of those before; with ``removed`` also the keys that are deleted."""
        done = [b for b in self.batches() if batch is None or b <= batch]
        versions = self.versions(done[-1] if done else None)
        rows = self._stored(versions, list(versions))
        return rows if removed or not self.deleted else rows.filter(~F.coalesce(F.col(self.deleted), F.lit(False)))

    def vacuum(self, keep: int = 1) -> list[int]:
        """Remove the manifests but for the last ``keep``, and the versions that none of these names; returns the versions."""
        done = self.batches()
        for b in done[:-keep]:
            delete_folder(self.spark, f"{self.root}/manifest/batch={b}")
        used = {v for b in done[-keep:] for v in self.versions(b).values()}
        gone = [int(n.split("=")[1]) for n in self._names(f"{self.root}/data") if n.startswith("version=")]
        gone = sorted(v for v in gone if v not in used and done and v <= done[-1])
        for v in gone:
            delete_folder(self.spark, f"{self.root}/data/version={v}")
        return gone


GROUPS = f"pid string, path string, grp long, records array<{isis.RECORD_TYPE}>, arrived timestamp"


def keep_up(spark: SparkSession, folder: str, target: str, checkpoint: str, kind: str = "artigo", per_batch: int = 100, encoding: str = "ISO-8859-1", available_now: bool = True) -> StreamingQuery:
    """Merge the record groups of dumps that arrive in a folder into a table of the last group of each pid.

    Dumps are streamed as lines, in blocks, so one may be of any size; a batch has whole files, so records and groups never cross batches. A file that
    arrives late, or a batch that is repeated, changes nothing that a later file has said.
    """
    table = MergedTable(spark, target, GROUPS)

    def sink(lines: DataFrame, batch: int) -> None:
        times = lines.groupBy("path").agg(F.max("arrived").alias("arrived"))
        numbered = isis.numbered_lines(lines, encoding)
        groups = isis.group_records(isis.build_records(isis.join_continuations(isis.number_records(numbered))), kind)
        table.upsert(groups.join(times, "path"), batch)

    raw = spark.readStream.format("text").option("maxFilesPerTrigger", per_batch).option("maxFileAge", "36500d").option("pathGlobFilter", "*.id").load(folder)
    meta = F.col("_metadata")
    rows = raw.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), meta["file_modification_time"].alias("arrived"), "value")
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
