"""What several operators need of Spark: shared tables and skew-safe lookups."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: So many ids, 8 bytes each, are broadcast (some 100 MB as a hash table).
FEW = 2_000_000
#: A key with more than this share of the rows is looked up in a broadcast table, which
#: so has at most the reciprocal number of rows.
HEAVY_SHARE = 1 / 500


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where unset one of our own if there is but one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="folioframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The same rows, written once as Parquet in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioframe/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove the tables of written() that these read and nothing will read again; other files are never touched."""
    plain = lambda path: re.sub(r"^[a-z0-9]+:/+", "/", path)
    own = f"{plain(shared_dir(spark))}/folioframe/"
    for path in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        if plain(path).startswith(own):
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bounded(ids: DataFrame) -> DataFrame:
    """Distinct ids, to join with: broadcast if they are at most FEW, else left to a shuffle."""
    ids = written(ids.distinct())
    return F.broadcast(ids) if ids.count() <= FEW else ids


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """docs but for the rows whose id is in gone (a column of that name); null ids stay. Texts move only if more than FEW ids go."""
    gone = bounded(gone.select(F.col(id_col).alias("_gone")))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")


def heavy_keys(facts: DataFrame, key: str) -> list:
    """The keys with more than HEAVY_SHARE of the rows, at most 1 / HEAVY_SHARE of them."""
    n = facts.count()
    heavy = facts.groupBy(key).count().filter(F.col("count") > max(1000, int(n * HEAVY_SHARE))).select(key)
    return [r[0] for r in heavy.limit(int(1 / HEAVY_SHARE) + 1).collect()]


def lookup(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", on: list[str] | None = None, heavy: list | None = None) -> DataFrame:
    """facts joined to dim, which has each key once; no task gets all rows of a heavy key.

    Keys with more than HEAVY_SHARE of the facts are at most 1 / HEAVY_SHARE, so their
    part of dim may be broadcast whatever the size of the input; the rest meets in a shuffle.
    ``on`` names the columns that join where they are more than ``key``, by which weight is judged (dim has
    few rows then for a value of ``key``); ``heavy`` are heavy keys that are already known.
    """
    keys, on = heavy_keys(facts, key) if heavy is None else heavy, on or [key]
    if not keys:
        return facts.join(dim, on, how)
    is_heavy = F.coalesce(F.col(key).isin(keys), F.lit(False))
    return (
        facts.filter(is_heavy)
        .join(F.broadcast(dim.filter(is_heavy)), on, how)
        .unionByName(facts.filter(~is_heavy).join(dim.filter(~is_heavy), on, how))
    )
