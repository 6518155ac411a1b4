"""Line deduplication with two Bloom filters, for lines seen once and lines seen twice.

1. *Filters.* Each task hashes its lines' keys, each key once for a document, and publishes the bits of its own two filters: those
   that one key has set and those that a second one has. Filters add up with saturation (a bit is in the second filter if either
   has it there, or both have it in the first), so they are merged slice by slice, in any order, and the answer does not
   depend on how tasks were cut.
2. *Suspects.* A key may be in two documents only if all its bits are in the second filter. Lines of other keys, most of a
   corpus, never move. Suspects are published as (id, key), a long key by its SHA-256.
3. *Exact confirmation.* Suspects are grouped by key, with the smallest and largest id as partial aggregates; false
   suspects fall out here. The smallest id is the one that keeps its lines.
4. The keys that a document loses go back to it, and the texts are written without those lines.

The second filter is the only one that is broadcast: 12 bits for each line, at most ``MOST`` bits (64 MB). Where that is too
little for the input, fewer hashes are used and more lines are suspected; the result is the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import lookup, written
from folioframe.llm.words import STEP_BYTES, U64, mix64, released

#: Bits of a filter for each line, and at most.
BITS, MOST = 12, 1 << 29
#: Bits of a slice, the unit that filters are merged by.
SLICE = 1 << 19
#: So many bits are gathered in a task before they are published.
GATHERED = 1 << 20
#: Keys of more bytes are told apart by their SHA-256, after a byte that UTF-8 has not.
LONG = 40
#: Bytes of keys to drop, over all documents, that are sent to the texts; beyond, texts and keys meet in a shuffle.
SENT = 32 << 20
_BLANK = b" \t\n\x0b\x0c\r"


def _keys(text: bytes, least: int) -> list[bytes | None]:
    """The key of each line: without blanks at its ends, A-Z lower-cased; None if shorter than ``least`` code points."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(_BLANK)
        if len(key) < least or not key.isascii() and len(key.decode()) < least:
            out.append(None)
        else:
            out.append(key.lower())
    return out


def _name(key: bytes) -> bytes:
    return key if len(key) <= LONG else b"\xff" + hashlib.sha256(key).digest()


def _steps(batch: pa.RecordBatch, text: int):
    """Slices of a batch with some STEP_BYTES of text, texts as bytes (None for null)."""
    rows = batch.num_rows
    step = max(1, min(rows, rows * STEP_BYTES // max(1, batch.column(text).nbytes)))
    for at in range(0, rows, step):
        part = batch.slice(at, step)
        yield part, part.column(text).cast(pa.binary()).to_pylist()


class Filters:
    """The sizes of both filters, and the bits of a key."""

    def __init__(self, lines: int):
        self.bits = min(MOST, max(SLICE, 1 << max(0, BITS * lines - 1).bit_length()))
        self.hashes = max(1, min(3, round(0.69 * self.bits / max(1, lines))))
        self.slices = self.bits // SLICE

    def places(self, keys: list[bytes]) -> np.ndarray:
        """A row of bits for each key."""
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=U64, count=len(keys))
        step = mix64(h ^ U64(0xA0761D6478BD642F))
        return np.stack([(h + U64(i) * step) & U64(self.bits - 1) for i in range(self.hashes)], axis=1).astype(np.int64)

    def publish(self, least: int):
        """Of a task's texts, for each slice, the bits that were set and whether a second key set them."""

        def rows(held: list[np.ndarray]):
            bits, n = np.unique(np.concatenate(held), return_counts=True)
            codes = ((bits % SLICE) * 2 + (n > 1)).astype(np.uint32)
            own = bits // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
            full = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([int(own[a]) for a, _ in full], pa.int32()), pa.array([codes[a:b].tobytes() for a, b in full], pa.binary())], ["slice", "bits"])

        def work(batches):
            held, n = [], 0
            for batch in batches:
                for _, texts in _steps(batch, 0):
                    keys = [k for text in texts if text for k in {*_keys(text, least)} if k is not None]
                    if keys:
                        held.append(self.places(keys).ravel())
                        n += len(held[-1])
                    if n >= GATHERED:
                        yield rows(held)
                        held, n = [], 0
            if held:
                yield rows(held)

        return released(work)

    def merge(self):
        """Saturated sums of published bits; from each slice what is left is the second filter, packed."""

        def work(batches):
            once, twice = {}, {}
            for batch in batches:
                for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    codes = np.frombuffer(raw, dtype=np.uint32)
                    at, again = codes >> 1, (codes & 1).astype(bool)
                    if number not in once:
                        once[number], twice[number] = np.zeros(SLICE, dtype=bool), np.zeros(SLICE, dtype=bool)
                    twice[number][at] |= once[number][at] | again
                    once[number][at] = True
            for number in once:
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([np.packbits(twice[number]).tobytes()], pa.binary())], ["slice", "bits"])

        return released(work)

    def twice(self, texts: DataFrame, least: int):
        """The second filter over all texts, as a broadcast of packed bits."""
        published = texts.mapInArrow(self.publish(least), "slice int, bits binary")
        merged = published.repartition(max(1, self.slices // 8), "slice").mapInArrow(self.merge(), "slice int, bits binary")
        packed = np.zeros(self.bits // 8, dtype=np.uint8)
        for r in merged.collect():  # at most MOST bits
            packed[r["slice"] * SLICE // 8 : (r["slice"] + 1) * SLICE // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
        return texts.sparkSession.sparkContext.broadcast(packed)

    def suspects(self, twice, least: int):
        """(id, key) of the lines whose bits are all in the second filter, each key once for a document."""

        def work(batches):
            for batch in batches:
                for part, texts in _steps(batch, 1):
                    found = [(i, k) for i, text in enumerate(texts) if text for k in dict.fromkeys(_keys(text, least)) if k is not None]
                    if not found:
                        continue
                    places = self.places([k for _, k in found])
                    hit = ((twice.value[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1)
                    kept = [x for x, ok in zip(found, hit, strict=True) if ok]
                    ids = part.column(0).take(pa.array([i for i, _ in kept], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([_name(k) for _, k in kept], pa.binary())], ["id", "key"])

        return released(work)


def _without(least: int):
    """Texts without the lines whose keys go."""

    def work(batches):
        for batch in batches:
            for part, texts in _steps(batch, 1):
                lines, dropped, kept = [], [], []
                for text, gone in zip(texts, part.column(2).to_pylist(), strict=True):
                    text = text or b""
                    lines.append(text.count(b"\n") + 1)
                    stay = None
                    if gone:
                        gone = set(gone)
                        stay = [line for line, key in zip(text.split(b"\n"), _keys(text, least), strict=True) if key is None or _name(key) not in gone]
                    dropped.append(0 if stay is None else lines[-1] - len(stay))
                    kept.append(text if stay is None else b"\n".join(stay))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_lines", "n_dropped", "kept"]
                )

    return released(work)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10) -> DataFrame:
    """Of lines that several documents have, keep those of the document with the smallest id.

    A line's key is the line without blanks (space, tab to carriage return) at its ends, A-Z lower-cased. Keys of at least
    ``least`` code points that at least two documents have lose all their lines but for those in the smallest id that has them.
    Returns a row for each input row: ``id_col``, ``n_lines`` (before), ``n_dropped`` and ``kept`` (the other lines as they were, joined by \\n).

    * null or empty text: one empty line, which stays;
    * a text of which all lines go is empty;
    * rows with equal ids are one document, so lines that they share with each other stay; repeated rows come out repeated;
    * a null id is an id like any other and comes after all others, so it loses lines to them;
    * a line that a document repeats stays as often as it is there, or goes each time;
    * very long lines and texts are read whole; other columns, whatever their names, are ignored; an empty table gives an empty table.

    Nothing depends on the size of a group of copies: a line that a third of all documents have is one entry for each of them,
    summed where it is read, and meets them in a broadcast of the few such lines. Filters are bounded and
    the steps between are tables or pure functions of the input, so lost executors' work is done again with the same result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    n = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    filters = Filters(n)
    twice = filters.twice(rows.select("text"), least)
    suspects = written(rows.mapInArrow(filters.suspects(twice, least), f"id {id_type}, key binary"))
    twice.unpersist()
    shared = (
        suspects.groupBy("key")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("nulls"))
        .filter((F.col("first") < F.col("last")) | (F.col("nulls") & F.col("first").isNotNull()))
        .select("key", "first")
    )
    losing = lookup(suspects, shared, "key").filter(~F.col("id").eqNullSafe(F.col("first")))
    gone = written(losing.groupBy(F.col("id").alias("of")).agg(F.collect_set("key").alias("gone")))
    size = gone.agg(F.sum(F.expr("aggregate(gone, 64L, (n, k) -> n + length(k) + 16)"))).first()[0] or 0
    joined = rows.join(F.broadcast(gone) if size <= SENT else gone, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "text", "gone")
    return joined.mapInArrow(_without(least), f"id {id_type}, n_lines long, n_dropped long, kept string").withColumnRenamed("id", id_col)
