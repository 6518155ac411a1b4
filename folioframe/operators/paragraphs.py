"""Paragraph records of a document: parts around the references, and reference numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_parts(rows: DataFrame) -> DataFrame:
    """Adds ``part`` to rows (pid, pos, text, reference_index), pos from 0.

    The references run from the first to the last paragraph that has a reference index, what lies between included; a
    reference in the very first paragraph does not count. Without any, all is before the references.
    """
    own = Window.partitionBy("pid")
    is_ref = F.when((F.coalesce("reference_index", F.lit("")) != "") & (F.col("pos") > 0), F.col("pos"))
    rows = rows.withColumn("_first", F.min(is_ref).over(own)).withColumn("_last", F.max(is_ref).over(own))
    part = F.when(F.col("_first").isNull() | (F.col("pos") < F.col("_first")), "before references").when(F.col("pos") <= F.col("_last"), "references").otherwise("after references")
    return rows.withColumn("part", part).drop("_first", "_last")


def part_texts(rows: DataFrame) -> DataFrame:
    """(pid, before, refs, after): texts before and after in one, and the reference paragraphs in order."""
    parts = split_parts(rows)
    own = lambda p: F.array_sort(F.collect_list(F.when(F.col("part") == p, F.struct("pos", "text", "reference_index"))))
    g = parts.groupBy("pid").agg(own("before references").alias("b"), own("references").alias("r"), own("after references").alias("a"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["text"]), "")
    return g.select("pid", joined("b").alias("before"), F.col("r").alias("refs"), joined("a").alias("after"))


def guessed_indexes(rows: DataFrame) -> DataFrame:
    """Numbers the paragraphs that have text, from 1; others are dropped."""
    kept = rows.filter(F.length(F.trim(F.regexp_replace("text", "<[^>]*>", ""))) > 0)
    return kept.withColumn("guessed_index", F.row_number().over(Window.partitionBy("pid").orderBy("pos")))


def reference_ids(rows: DataFrame) -> DataFrame:
    """Adds ``ref_id``: B and the reference's index, or else its place among the references."""
    place = F.row_number().over(Window.partitionBy("pid").orderBy("pos"))
    return rows.withColumn("ref_id", F.concat(F.lit("B"), F.coalesce(F.nullif(F.col("reference_index"), F.lit("")), place.cast("string"))))
