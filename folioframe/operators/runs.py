"""Running totals and runs of equal keys, in an order that is too long for one task.

The order is cut into chunks of ``CHUNK`` consecutive values. A window goes through one chunk; what lies before it
comes from the totals of the chunks, of which there are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 17


def _chunked(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn("_chunk", F.shiftright(F.col(order).cast("long"), CHUNK_BITS))


def _joined(df: DataFrame, chunks: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of its chunk; null keys meet each other."""
    renamed = chunks.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return df.join(renamed, on).drop(*[f"_r{i}" for i in range(len(keys))])


def running_totals(df: DataFrame, totals: dict[str, Column], partition: list[str], order: str) -> DataFrame:
    """Adds for each name the total of its column from the partition's first row to this one, by the integer ``order``."""
    own = [f"_own{i}" for i in range(len(totals))]
    df = _chunked(df, order).select("*", *[c.cast("long").alias(o) for c, o in zip(totals.values(), own, strict=True)])
    keys = [*partition, "_chunk"]
    sums = df.groupBy(*keys).agg(*[F.sum(o).alias(o) for o in own])
    before = Window.partitionBy(*partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, *[F.coalesce(F.sum(o).over(before), F.lit(0)).alias(f"{o}_before") for o in own])
    within = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = _joined(df.select("*", *[F.sum(o).over(within).alias(f"{o}_in") for o in own]), offsets, keys)
    out = out.select("*", *[(F.col(f"{o}_in") + F.col(f"{o}_before")).alias(name) for o, name in zip(own, totals, strict=True)])
    return out.drop("_chunk", *[f"{o}{x}" for o in own for x in ("", "_in", "_before")])


def run_length_groups(df: DataFrame, key: str, order: str, partition: list[str] | str = "path", group: str = "grp") -> DataFrame:
    """Adds the number of the run of consecutive rows with equal keys, from 1; a key that comes again starts another run."""
    partition = [partition] if isinstance(partition, str) else list(partition)
    keys, whole = [*partition, "_chunk"], F.struct(F.col(key).alias("k"))  # wrapped, so that a null key is not taken for none
    w = Window.partitionBy(*keys).orderBy(order)
    rows = _chunked(df, order).withColumn("_ahead", F.lag(whole).over(w))
    rows = rows.withColumn("_start", (F.col("_ahead").isNotNull() & ~F.col("_ahead.k").eqNullSafe(F.col(key))).cast("long"))
    rows = rows.withColumn("_in", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a chunk's first row starts a run if the chunk before ends with another key
    chunks = rows.groupBy(*keys).agg(F.sum("_start").alias("n"), F.min_by(whole, order).alias("first"), F.max_by(whole, order).alias("last"))
    by_chunk = Window.partitionBy(*partition).orderBy("_chunk")
    chunks = chunks.withColumn("ahead", F.lag("last").over(by_chunk))
    chunks = chunks.withColumn("n_first", (F.col("ahead").isNull() | ~F.col("ahead.k").eqNullSafe(F.col("first.k"))).cast("long"))
    until = F.sum(F.col("n") + F.col("n_first")).over(by_chunk.rowsBetween(Window.unboundedPreceding, 0))
    out = _joined(rows, chunks.select(*keys, (until - F.col("n")).alias("_before")), keys)
    return out.withColumn(group, F.col("_in") + F.col("_before")).drop("_chunk", "_ahead", "_start", "_in", "_before")
