"""Quotation linking: conversations in reply order, without the quotes.

DataFrame functions only. Each message's lines are split by their quote marks (``>``, also nested and
spaced) into runs of one level: level 0 is the message's own text, the others are quoted
passages. Passages are normalised (case, white space) and hashed, and so are the own texts
of all messages, whole and line by line; a passage links to the first message of its conversation that has it as own
text. Where only single lines of it are found, the earliest such message counts.

A reply belongs to the thread of the message it quotes; threads follow from pointer jumping,
whose rounds grow with the logarithm of the longest chain of replies. In the order (conv_id, thread, turn)
every reply follows what it answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import dropped, lookup, written

_MARK = r"^[ \t]*(?:>[ \t]?)+"
#: A line that only announces a quote, as mail programs write it.
_LEAD = r"(?i)^.{0,200}\b(wrote|writes|écrit|schrieb|escribió|escreveu)[ \t]*:[ \t]*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parse_quotes(messages: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``own``: the text without quotes and their announcements, and ``passages``: array of (level, body) in order."""
    lines = F.transform(
        F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?", "\n"), "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, _MARK, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, _MARK, "").alias("body"),
        ),
    )

    # where a run of one level starts: first line, or another level than the line before
    def starts(lines: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == 1) | (lines[i - 1]["level"] != F.get(lines, i - 2)["level"]))

    def runs(lines: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, k: F.struct(
                lines[s - 1]["level"].alias("level"),
                F.transform(F.slice(lines, s, F.coalesce(F.get(starts, k + 1), F.size(lines) + 1) - s), lambda x: x["body"]).alias("body"),
            ),
        )

    def parts(runs: Column) -> Column:
        plain = F.transform(
            runs,
            lambda r, k: F.when(
                r["level"] == 0,
                F.when(
                    (F.coalesce(F.get(runs, k + 1)["level"], F.lit(0)) > 0) & F.element_at(r["body"], -1).rlike(_LEAD),
                    F.slice(r["body"], 1, F.size(r["body"]) - 1),
                ).otherwise(r["body"]),
            ),
        )
        own = F.regexp_replace(F.array_join(F.flatten(F.array_compact(plain)), "\n"), r"^\s+|\s+$", "")
        passages = F.transform(F.filter(runs, lambda r: r["level"] > 0), lambda r: F.struct(r["level"].alias("level"), F.array_join(r["body"], "\n").alias("body")))
        return F.struct(own.alias("own"), F.filter(passages, lambda p: F.length(_normal(p["body"])) > 0).alias("passages"))

    found = _let(lines, lambda x: _let(starts(x), lambda s: _let(runs(x, s), parts)))
    return messages.withColumn("parsed", found).select(*messages.columns, F.col("parsed.own").alias("own"), F.col("parsed.passages").alias("passages"))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a column that lambdas refer to would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _units(text: Column, min_words: int) -> Column:
    """Hashes by which a text is found: of the whole (rank 0) and of its longer lines (rank 1)."""
    whole = F.array(F.struct(F.lit(0).alias("rank"), F.md5(_normal(text)).alias("hash")))
    lines = F.filter(F.transform(F.split(text, "\n"), _normal), lambda x: F.size(F.split(x, " ")) >= min_words)
    return F.when(F.length(_normal(text)) > 0, F.concat(whole, F.transform(lines, lambda x: F.struct(F.lit(1).alias("rank"), F.md5(x).alias("hash"))))).otherwise(F.slice(whole, 1, 0))


def link_quotes(parsed: DataFrame, min_words: int = 4) -> DataFrame:
    """(conv, turn, passage, level, origin): each quoted passage with the turn it was taken from."""
    key = F.md5(F.concat_ws("\x1f", F.col("conv").cast("string"), F.col("u.hash")))
    quotes = (
        parsed.select("conv", "turn", F.posexplode("passages").alias("passage", "p"))
        .select("conv", "turn", "passage", F.col("p.level").alias("level"), F.explode(_units(F.col("p.body"), min_words)).alias("u"))
        .select("conv", "turn", "passage", "level", F.col("u.rank").alias("rank"), key.alias("key"))
    )
    quotes = written(quotes)
    if quotes.isEmpty():
        return quotes.select("conv", "turn", "passage", "level", F.col("turn").alias("origin"))
    originals = parsed.select("conv", "turn", F.explode(_units(F.col("own"), min_words)).alias("u")).groupBy(key.alias("key")).agg(F.min("turn").alias("origin"))
    found = lookup(quotes, originals, "key").filter("origin < turn")
    first = F.min(F.struct("rank", "origin"))
    return found.groupBy("conv", "turn", "passage", "level").agg(first.alias("f")).select("conv", "turn", "passage", "level", F.col("f.origin").alias("origin"))


def _threads(replies: DataFrame) -> DataFrame:
    """Pointer jumping over (conv, turn, up), one row for each replying message: adds nothing but moves ``up`` to the root."""
    spark = replies.sparkSession
    spot = lambda turn: F.concat_ws(":", F.col("conv").cast("string"), F.col(turn).cast("string"))
    now = written(replies)
    while True:
        above = now.select(spot("turn").alias("key"), F.col("up").alias("further"))
        moved = lookup(now.withColumn("key", spot("up")), above, "key", "left").select("conv", "turn", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved"))
        after = written(moved)
        done = after.filter("moved").isEmpty()
        dropped(spark, now)
        now = after.drop("moved")
        if done:
            return now


def reply_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", min_words: int = 4) -> DataFrame:
    """Every message without its quotes, with what it answers and its thread.

    Returns conv_id, turn, role, thread (turn of the thread's first message), reply_to (turn of the message
    quoted at the lowest linked level, of several the latest; null if nothing quoted is found), quote_depth,
    n_quotes, n_linked and text. Ordered by (conv_id, thread, turn), replies follow their originals.

    * null or empty text is a message without own text or quotes; null conversation or turn: the
      message comes back and links to nothing, with its turn as thread;
    * a passage that several messages have: the earliest is the original; passages that no earlier
      message of the conversation has stay unlinked (and are removed all the same);
    * rows that repeat a conversation and turn come back each; replies among them share the
      latest original; lines of fewer than ``min_words`` words link only as whole passages;
    * very long texts are parsed whole; other columns are ignored; an empty table gives an empty one.
    """
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    parsed = parse_quotes(rows)
    known = parsed.filter("conv IS NOT NULL AND turn IS NOT NULL")
    links = written(link_quotes(known, min_words))
    out = parsed.withColumn("n_quotes", F.size("passages").cast("long")).withColumn(
        "quote_depth", F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0)).cast("long")
    )
    empty = links.isEmpty()
    if empty:
        out = out.withColumn("reply_to", F.lit(None).cast(rows.schema["turn"].dataType)).withColumn("n_linked", F.lit(0).cast("long")).withColumn("thread", F.col("turn"))
    else:
        best = F.min(F.struct("level", F.negative("origin").alias("o")))
        replies = links.groupBy("conv", "turn").agg(best.alias("b"), F.count_distinct("passage").alias("n_linked"))
        replies = replies.select("conv", "turn", F.negative(F.col("b.o")).cast(rows.schema["turn"].dataType).alias("up"), F.col("n_linked"))
        replies = written(replies)
        roots = _threads(replies.select("conv", "turn", "up"))
        dim = replies.join(roots.withColumnRenamed("up", "root"), ["conv", "turn"]).select(
            F.concat_ws(":", F.col("conv").cast("string"), F.col("turn").cast("string")).alias("key"), F.col("up").alias("reply_to"), "n_linked", "root"
        )
        spot = F.when(F.col("conv").isNotNull() & F.col("turn").isNotNull(), F.concat_ws(":", F.col("conv").cast("string"), F.col("turn").cast("string")))
        out = lookup(out.withColumn("key", spot), dim, "key", "left")
        out = out.withColumn("n_linked", F.coalesce("n_linked", F.lit(0)).cast("long")).withColumn("thread", F.coalesce("root", "turn"))
    return out.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "thread", "reply_to", "quote_depth", "n_quotes", "n_linked", F.col("own").alias(text_col)
    )
