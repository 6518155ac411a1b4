"""HTML as a table of nodes: (key, node, post, parent, depth, pos, tag, attrs, text, tail) in document order.

A node's descendants are those with a greater ``node`` and a smaller ``post``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators.trees import Node, parse

_COLUMNS = "node int, post int, parent int, depth int, pos int, tag string, attrs map<string,string>, text string, tail string"
_TYPES = {"node": pa.int32(), "post": pa.int32(), "parent": pa.int32(), "depth": pa.int32(), "pos": pa.int32(), "tag": pa.string(), "attrs": pa.map_(pa.string(), pa.string()), "text": pa.string(), "tail": pa.string()}


def rows_of(html: str | None) -> list[tuple]:
    out: list[list] = []
    counter = [0]

    def visit(node: Node, parent: int, depth: int, pos: int) -> None:
        number = len(out)
        out.append([number, 0, parent, depth, pos, node.tag, list(node.attrs.items()), node.text, node.tail])
        for i, c in enumerate(node.children):
            visit(c, number, depth + 1, i)
        out[number][1] = counter[0]
        counter[0] += 1

    for i, c in enumerate(parse(html or "").children):
        visit(c, -1, 0, i)
    return [tuple(r) for r in out]


def node_table(df: DataFrame, key: str, html: str) -> DataFrame:
    """The nodes of every row's HTML; null or empty HTML has none."""
    kind = df.schema[key].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [rows_of(h) for h in part.column(1).to_pylist()]
                index = [i for i, rows in enumerate(found) for _ in rows]
                flat = [r for rows in found for r in rows]
                columns = [pa.array([r[j] for r in flat], t) for j, t in enumerate(_TYPES.values())]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(index, pa.int64())), *columns], ["key", *_TYPES])

    return df.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(work, f"key {kind}, {_COLUMNS}").withColumnRenamed("key", key)
