"""Contiguous shards of near-equal bytes from global prefix sums.

The documents' order (by id, then by text hash and size) is cut into ranges with fixed bounds. One pass
gives each range's total of bytes and rows; the running totals of the ranges, a few thousand
rows, are each range's base. Inside a range a window adds its own running sums. A document
goes to the shard in which its first byte falls when all bytes are cut at equal targets, so
shards are contiguous and each differs from the target by less than the longest document.

Texts are read once and never shuffled: only id, size and checksum move.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from folioframe.llm.shared import written

#: Rows of one range, and at most so many ranges: their totals are what the driver sees.
RANGE_ROWS, MAX_RANGES = 50_000, 20_000


def _running(batches):
    """Adds the range's number and, for each row of it, the bytes and rows before."""
    number, n_bytes, n_rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        total = np.cumsum(size)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(len(size), number, dtype=np.int32)),
                pa.array(n_bytes + total - size),
                pa.array(n_rows + np.arange(len(size), dtype=np.int64)),
            ],
            [*batch.schema.names, "range", "bytes_before", "rows_before"],
        )
        n_bytes, n_rows = n_bytes + int(total[-1]) if len(size) else n_bytes, n_rows + len(size)


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot of each row.

    ``slot`` counts from 0 in each shard, without gaps, in the shard's order.

    * null text: no bytes, size 1, the checksum of nothing (0); empty text likewise;
    * a null id comes first; rows with equal ids follow each other by size and checksum; rows equal
      in these too are interchangeable, and each gets a slot of its own;
    * very long texts count in full, so one can fill a shard and leave the next one short or empty;
    * other columns are ignored; an empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sizes = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
        )
    )
    n = sizes.count()
    ranges = min(MAX_RANGES, max(1, math.ceil(n / RANGE_ROWS), min(64, n // 256)))
    order = ["id", "size", "crc"]
    id_type = sizes.schema["id"].dataType.simpleString()
    cut = sizes.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    cut = written(cut.mapInArrow(_running, f"id {id_type}, size long, crc long, range int, bytes_before long, rows_before long"))
    totals = cut.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("r")).orderBy("range").collect()
    total, rows, bases = 0, 0, []
    for t in totals:
        bases.append((t["range"], total, rows))
        total, rows = total + t["b"], rows + t["r"]
    base = cut.sparkSession.createDataFrame(bases, "range int, base_bytes long, base_rows long")
    # as many rows as ranges, at most MAX_RANGES: broadcast
    placed = cut.join(F.broadcast(base), "range").select(
        "id",
        "size",
        "crc",
        F.expr(f"least({shards - 1}, (base_bytes + bytes_before) * {shards} div {max(1, total)})").cast("int").alias("shard"),
        (F.col("base_rows") + F.col("rows_before")).alias("row"),
    )
    heads = placed.groupBy("shard").agg(F.min("row").alias("head"))  # a row for each shard
    return placed.join(F.broadcast(heads), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("head")).alias("slot")
    )
