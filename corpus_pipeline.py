"""A corpus pipeline of the training-data operators: quality, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and returns a
DataFrame; all but the last return the columns of ``docs``. In every stage

* null and empty texts stay: quality scores them by their site, they are near duplicates of nothing, hold no leak and no
  personal data, and pack as an end id alone; very long texts are worked on whole;
* rows that repeat an id are scored each; near_dedup keeps one of those with the same text; decontamination takes all rows of an id that
  has a leak; null ids stay, since no other row can name them;
* ties: the smallest id stays; nulls in source or lang are the site '';
* an empty table gives an empty table, and columns beyond those of documents come through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.decontaminate import contaminated
from folioframe.llm.near_dedup import without_near_duplicates
from folioframe.llm.packing import pack_documents
from folioframe.llm.pii import redact_pii
from folioframe.llm.quality import keep_good
from folioframe.llm.shared import dropped, without_ids, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays, that with the smallest id; of repeated rows one."""
    return without_near_duplicates(docs, threshold=80).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    gone = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id")
    return without_ids(docs, gone, "doc_id").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return redact_pii(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as tokens, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir))
        dropped(spark, before)  # of tables written here; the given ones stay
    return STAGES[-1][1](spark, docs, sf_dir)
