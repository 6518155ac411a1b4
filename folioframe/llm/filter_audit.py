"""Filter interaction audit: what each filter removes after which others, in every order.

The orders of n filters form a trie of n! paths, but what is left after some filters does not depend on their order. So the
trie is walked depth first over *survivor* DataFrames, one for each set of filters, 2**n instead of n!: a state that was reached by another
order is taken from the memo. A state's survivors are the parent's survivors that pass one filter more; they are persisted while
their own edges are counted and their children made, so at most n + 1 of them are held at once. On each edge (state, filter)
the rows that the filter removes from these survivors are counted. An order's steps are then n edges, looked up.
"""

from __future__ import annotations

import itertools
import math
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import lookup, shared_dir, written

_WORDS = r"[^\x20\x09-\x0D]+"


def _edges(rows: DataFrame, filters: dict[str, Column], marks: list[str]) -> DataFrame:
    """For each part and edge of the trie: removed, kept, and how many of the removed have each mark. rows: part, fails_<name>, marks."""
    names, spark = list(filters), rows.sparkSession
    path = f"{shared_dir(spark)}/folioframe/{uuid.uuid4().hex}"
    lost = ", ".join(f"{m}_lost bigint" for m in marks)
    schema = f"part string, state string, filter string, removed long, kept long{', ' * bool(marks)}{lost}"
    memo: set[frozenset] = set()

    def visit(state: frozenset, survivors: DataFrame) -> None:
        memo.add(state)
        left = [f for f in names if f not in state]
        if not left:
            return
        survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        edges = []
        for f in left:
            removed = F.count_if(f"fails_{f}")
            lost = [F.count_if(F.col(f"fails_{f}") & F.col(m)).alias(f"{m}_lost") for m in marks]
            edges.append(F.struct(F.lit(f).alias("filter"), removed.alias("removed"), (F.count("*") - removed).alias("kept"), *lost))
        counted = survivors.groupBy("part").agg(F.array(*edges).alias("edges"))
        counted.select("part", F.lit("".join(sorted(state))).alias("state"), F.inline("edges")).write.mode("append").parquet(path)
        for f in left:
            if state | {f} not in memo:
                visit(state | {f}, survivors.filter(~F.col(f"fails_{f}")).drop(f"fails_{f}"))
        survivors.unpersist()

    visit(frozenset(), rows)
    return spark.read.schema(schema).parquet(path)


def audit(rows: DataFrame, filters: dict[str, Column], part: Column, marks: dict[str, Column]) -> DataFrame:
    """Rows for each part and order of the filters, one for each step.

    ``filters``: a letter to the condition that fails a row; ``marks``: conditions whose rows one would not, or would, like to lose.
    All are conditions on ``rows``; null is false. ``part`` groups the rows; null is the empty string.
    Returns part, filter_order, step (from 1) and, all long, within the part: kept (after the step), removed (by it), redundant (rows that fail its
    filter but went before), unique_fails (rows that fail no other filter), <mark>_lost (removed rows with the mark) and
    shapley (what its filter removes, summed over all orders).

    * every part has all orders and steps, with zeros where no row is left;
    * repeated rows count each; rows that fail nothing are kept to the end;
    * no filters, or an empty table: no rows;
    * other columns, whatever their names, are ignored.

    The survivors hold the part and a truth value for each filter and mark, not the rows' texts, and derive from a written table, so a lost
    executor's share of them is made again. Counts are partial sums; a part with a third of all rows is no heavier for a task than others.
    """
    names = list(filters)
    if any(len(f) != 1 for f in names):
        raise ValueError("filters are named by one character")
    true = lambda c: F.coalesce(c.cast("boolean"), F.lit(False))
    flags = [true(c).alias(f"fails_{f}") for f, c in filters.items()]
    rows = written(rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), *flags, *[true(c).alias(m) for m, c in marks.items()]))
    edges = _edges(rows, filters, list(marks))
    n = len(names)
    only = {f: F.lit(True) for f in names}
    for f, g in itertools.permutations(names, 2):
        only[f] = only[f] & ~F.col(f"fails_{g}")
    alone = [F.struct(F.lit(f).alias("filter"), F.count_if(F.col(f"fails_{f}")).alias("fails"), F.count_if(F.col(f"fails_{f}") & only[f]).alias("unique_fails")) for f in names]
    whole = rows.groupBy("part").agg(F.array(*alone).alias("whole")).select("part", F.inline("whole"))
    # an edge lies on |state|! (n - 1 - |state|)! orders
    weights = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.length("state") + 1)
    shapley = edges.groupBy("part", "filter").agg(F.sum(F.col("removed") * weights).alias("shapley"))
    steps = [("".join(order), k + 1, order[k], "".join(sorted(order[:k]))) for order in itertools.permutations(names) for k in range(n)]
    every = whole.join(shapley, ["part", "filter"], "left")
    plan = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, state string")  # n * n! rows, whatever the input
    counts = every.join(F.broadcast(plan), "filter").join(edges, ["part", "state", "filter"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    removed = F.coalesce(F.col("removed"), F.lit(0))
    return counts.select(
        "part", "filter_order", "step", zero("kept"), zero("removed"), (F.col("fails") - removed).cast("long").alias("redundant"), zero("unique_fails"),
        *[zero(f"{m}_lost") for m in marks], zero("shapley"),
    )


def text_measures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What the standard filters need of each document, without its text: part, n_words, n_distinct, n_upper, n_chars, symbols, copy, good, toxic.

    Words are maximal runs of other than blanks, told apart by case. ``copy``: a smaller id has the same text, table-wide (by SHA-256); a null id has
    no smaller one and is none. ``good`` / ``toxic``: some label of the id says quality = 1 / toxic = 1. Null texts are empty;
    rows with equal ids are no copies of each other.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), F.col(part_col).alias("part"), text.alias("text"), words.alias("words"))
    rows = written(
        rows.select(
            "id", "part", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"), F.length("text").alias("n_chars"),
            (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))).alias("n_upper"), F.col("text").rlike(r"[#$%&*|]").alias("symbols"), F.unhex(F.sha2("text", 256)).alias("digest"),
        )
    )
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("digest", "first")
    rows = lookup(rows, first, "digest", how="left").withColumn("copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    said = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    return lookup(rows.drop("digest", "first"), said, "id", how="left")


def standard_filters() -> dict[str, Column]:
    """The conditions that fail a document, on the columns of text_measures()."""
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 3 * F.col("n_chars"),
        "D": F.col("symbols"),
        "E": F.col("copy"),
    }


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The standard filters over documents, by language, with the labels' good and toxic documents as marks."""
    return audit(text_measures(docs, labels), standard_filters(), F.col("part"), {"good": F.col("good"), "toxic": F.col("toxic")})
