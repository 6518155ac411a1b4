"""Data dictionaries: CSV tables that say which tag and subfields make up which field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the two layouts.
COLUMNS = "record, tag, subfield, subfield_name, multi_val, composite, field_name, name, description"
OLD_COLUMNS = "record, tag, field_name, single, subfield, subfield_name, description"


def _read(spark: SparkSession, path: str, columns: str) -> DataFrame:
    names = columns.split(", ")
    rows = spark.read.csv(path, schema=", ".join(f"{c} string" for c in names), header=False, quote='"', escape='"')
    return rows.fillna("").withColumn("row", F.monotonically_increasing_id())


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The nine-column layout; the header row is data like any other."""
    return _read(spark, path, COLUMNS)


def read_old_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, OLD_COLUMNS)


def _tag(number: Column) -> Column:
    return F.concat(F.lit("v"), F.when(F.length(number) >= 3, number).otherwise(F.lpad(number, 3, "0")))


def group_fields(rows: DataFrame) -> DataFrame:
    """(record, field_name, tag, subfields, is_multi_val, is_composite, name, description), flags from a field's last row."""
    named = F.filter(F.array_sort(F.collect_list(F.struct("row", F.col("subfield").alias("key"), F.col("subfield_name").alias("value")))), lambda e: e["key"] != "")
    last = lambda c: F.max_by(c, "row")
    g = rows.groupBy("record", "field_name").agg(
        F.min("row").alias("first"),
        last("tag").alias("number"),
        F.transform(named, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))).alias("pairs"),
        last("multi_val").alias("multi_val"),
        last("composite").alias("composite"),
        last("name").alias("name"),
        last("description").alias("description"),
    )
    flag = lambda c: (F.lower(c) != "false") & ((F.size("pairs") > 0) | (F.col(c) != ""))
    return g.select(
        "record",
        "field_name",
        _tag(F.col("number")).alias("tag"),
        F.map_from_entries(F.filter("pairs", lambda e, i: ~F.exists(F.slice("pairs", i + 2, F.greatest(F.size("pairs") - i - 1, F.lit(0))), lambda q: q["key"] == e["key"]))).alias("subfields"),
        flag("multi_val").alias("is_multi_val"),
        flag("composite").alias("is_composite"),
        "name",
        "description",
        "first",
    )


def group_tags(rows: DataFrame) -> DataFrame:
    """The older layout by (record, tag): single if flagged so, or if the name does not end in ``s``."""
    last = lambda c: F.max_by(c, "row")
    g = rows.groupBy("record", "tag").agg(last("field_name").alias("field_name"), last("single").alias("single"), F.sum((F.col("subfield") != "").cast("long")).alias("n"), last("description").alias("description"))
    single = F.when(F.col("single") != "", F.lower("single").isin("true", "1", "yes")).otherwise(~F.col("field_name").endswith("s"))
    return g.select("record", _tag(F.col("tag")).alias("tag"), "field_name", single.alias("is_single"), (F.col("n") > 0).alias("is_composite"), "description")


def record_dictionary(fields: DataFrame, record: str) -> dict[str, Mapping]:
    """A record type's fields by name, in tag order: what projection() takes. A dictionary is as small as its CSV file."""
    rows = fields.filter(F.col("record") == record).orderBy("tag", "first").collect()
    return {r["field_name"]: r.asDict(recursive=True) for r in rows}


def save_dictionary(fields: DataFrame, path: str) -> None:
    """The dictionary as JSON lines."""
    fields.drop("first").write.mode("overwrite").json(path)


def field_order(fields: DataFrame, record: str) -> DataFrame:
    """Field names of a record type ordered by tag."""
    return fields.filter(F.col("record") == record).orderBy("tag", "first").select("field_name", "tag")


def main(args: list[str] | None = None) -> None:
    """``python -m folioframe.plans.dictionary table.csv folder``: a dictionary as JSON lines."""
    import argparse

    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("csv")
    parser.add_argument("folder")
    found = parser.parse_args(args)
    save_dictionary(group_fields(read_dictionary(SparkSession.builder.getOrCreate(), found.csv)), found.folder)


if __name__ == "__main__":
    main()
