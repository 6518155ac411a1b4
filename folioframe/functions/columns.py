"""Helpers for Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body or its lambdas use it; also keeps generated code small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def last_of_each(items: Column, key: Callable[[Column], Column]) -> Column:
    """Without the items that a later one has the key of."""

    def kept(found: Column) -> Column:
        later = lambda x, i: F.exists(F.slice(found, i + 2, F.greatest(F.size(found) - i - 1, F.lit(0))), lambda y: key(y) == key(x))
        return F.filter(found, lambda x, i: ~later(x, i))

    return let(items, kept)


def spread(df: DataFrame) -> DataFrame:
    """For work that is heavy for each row: rows of fewer partitions than there are cores are dealt out; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *by: str, rows: int = 25_000) -> DataFrame:
    """For work that is heavy for each of many narrow rows, which files hold in few partitions, however these are cut: every core
    has rows, and no task many more than ``rows``; with columns ``by``, equal ones meet in a task. Rows are counted for it, so give few columns."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(n, *by)
