"""Structural joins over the node table (``nodes.node_table``): what holds a node, what a reference names, what stands beside it, and what is carried on from before.

A node and its descendants are the interval [node, last] of the document order. Intervals nest, so what encloses a node needs no comparison of pairs: beginnings and
ends of containers are events on the document's line, their running sum is the number of containers that are open, and of the containers opened at that
level the last one is the nearest. All windows go through one document at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_node() -> Column:
    """The number of a node's last descendant, or its own: as many follow it as its place in post order is ahead of what ended before it began."""
    return F.col("post") + F.col("depth")


def enclosing(nodes: DataFrame, key: str, container: Column, name: str) -> DataFrame:
    """Adds ``name``, the number of the nearest node above that meets the condition, or null. A container is not its own.

    * null conditions are false; nodes of different keys never meet; a null key is a key like any other;
    * nested containers count each: the innermost encloses.
    """
    is_one = F.coalesce(container, F.lit(False))
    marked = nodes.withColumn("_is", is_one)
    begin = F.struct((2 * F.col("node")).alias("_at"), F.col("_is").cast("int").alias("_step"), F.lit(False).alias("_end"))
    end = F.struct((2 * last_node() + 1).alias("_at"), F.lit(-1).alias("_step"), F.lit(True).alias("_end"))
    # one row for each event, so that the nodes are read once
    line = marked.select("*", F.inline(F.filter(F.array(begin, end), lambda e: ~e["_end"] | F.col("_is"))))
    # ends of nested containers may share a place; their order does not matter
    w = Window.partitionBy(key).orderBy("_at")
    line = line.withColumn("_open", F.sum("_step").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    # a container is itself open at its place; what encloses it is one level up
    line = line.filter("NOT _end").withColumn("_level", F.col("_open") - F.col("_is").cast("int"))
    containers = F.when(F.col("_is"), F.struct(F.col("_open").alias("level"), "node"))
    rows = F.array(F.struct(F.col("_level").alias("l"), F.lit(False).alias("c")), F.struct(F.when(F.col("_is"), F.col("_open")).alias("l"), F.lit(True).alias("c")))
    each = line.withColumn("_c", containers).select("*", F.inline(F.filter(rows, lambda r: r["l"].isNotNull())))
    # at one place the question comes before the container that begins there
    by_level = Window.partitionBy(key, "l").orderBy("_at", "c").rowsBetween(Window.unboundedPreceding, -1)
    found = each.withColumn(name, F.when(F.col("l") > 0, F.last(F.when(F.col("c"), F.col("node")), ignorenulls=True).over(by_level)))
    return found.filter("NOT c").select(*nodes.columns, name)


def referred(nodes: DataFrame, key: str, reference: Column, names: Column) -> DataFrame:
    """(key, node, reference, target, target_tag): nodes that refer, and the first node of the same document whose name that is; target is null if there is none.

    Empty and null references and names are none. Of nodes with one name the first in document order counts. An equi-join of the table with itself.
    """
    from_ = nodes.select(F.col(key), "node", reference.alias("reference")).filter("reference <> ''")
    named = nodes.select(F.col(key).alias("_key"), F.col("node").alias("target"), F.col("tag").alias("target_tag"), names.alias("_name")).filter("_name <> ''")
    first = named.groupBy("_key", "_name").agg(F.min_by(F.struct("target", "target_tag"), "target").alias("t"))
    met = from_.join(first, F.col(key).eqNullSafe(F.col("_key")) & (F.col("reference") == F.col("_name")), "left")
    return met.select(key, "node", "reference", F.col("t.target").alias("target"), F.col("t.target_tag").alias("target_tag"))


def next_sibling(nodes: DataFrame, key: str, wanted: Column, within: int, name: str) -> DataFrame:
    """Adds ``name``, the number of the nearest of the next ``within`` siblings that meets the condition, or null."""
    w = Window.partitionBy(key, "parent").orderBy("pos").rowsBetween(1, within)
    return nodes.withColumn(name, F.first(F.when(F.coalesce(wanted, F.lit(False)), F.col("node")), ignorenulls=True).over(w))


def carried_labels(nodes: DataFrame, key: str, labelled: Column, text: Column, name: str = "label") -> DataFrame:
    """Of the nodes that meet the condition, with ``name``: a word with a number is a label, a number alone takes the word of the sibling before it, other texts are their first word.

    Nodes without text have no label and carry the word on; a number before which there is no word is a label by itself.
    """
    rows = nodes.filter(F.coalesce(labelled, F.lit(False))).withColumn("_parts", F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda p: p != ""))
    n, last = F.size("_parts"), F.element_at("_parts", -1)
    numbered = (n > 0) & F.coalesce(F.try_element_at("_parts", F.lit(-1)).rlike("^[0-9]"), F.lit(False)) & (n <= 2)
    own = F.when(n == 0, None).when(numbered & (n == 1), None).otherwise(F.try_element_at("_parts", F.lit(1)))
    w = Window.partitionBy(key, "parent").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    word = F.last("_own", ignorenulls=True).over(w)
    label = F.when(n > 0, F.when(numbered, F.concat_ws(" ", word, last)).otherwise(F.col("_own")))
    return rows.withColumn("_own", own).withColumn(name, label).drop("_own", "_parts")
