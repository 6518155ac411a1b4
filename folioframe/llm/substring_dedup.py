"""Substring deduplication by relative Lempel-Ziv parsing.

The corpus is its own reference: it is cut into reference blocks of about
``block_bytes`` of text and *every* block is indexed with the places of its words. A document is then factored
greedily against all blocks. From a word on, the phrase of ``window`` words that starts there is looked up; if
another place has it, a factor begins, with that place as its source, and is extended word by word as long as
the source goes on with the same words. Where it no longer does, the factor ends. A word whose phrase is unknown is a literal.

*Boundaries.* A factor's source is the first block that has its first phrase, so it may end where another source goes on. The phrases that
straddle its end are therefore looked up as well, and the next factor begins at the first one known, inside this one if need
be. So every factor has at least ``window`` words, no repeated phrase falls between two factors, and the union of all factors,
the duplicate spans, holds exactly the words of repeated phrases.

The index is in two levels so that little is moved:

1. *Seeds.* The smallest hash among the 18-word grams of a 35-word phrase is a function
   of the phrase, so equal phrases have equal seeds. A block publishes its distinct
   seeds (about one for nine words); a seed that only one block has cannot carry a
   phrase into another block.
2. *Phrases.* Only phrases with a shared seed are published, as 96-bit fingerprints with the place where the block
   has them first, each once for each block, however often it occurs there.

Both levels go to hash buckets, packed to one binary row for each block and bucket. The answer is one bit for each entry, and
at the second level the source (block and place) of each entry that has one. A passage that a third of all documents share is one entry
for each block, so no bucket is hot. Sources inside the block are found without any exchange.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.words import U64, Words, gram_hashes, gram_starts, sliding_min

SEEDS, PHRASES = 0, 1
#: Rows that repeat more often are counted rather than held.
MANY = 64
#: The most tasks of a stage; beyond, a task has more blocks.
MOST_TASKS = 100_000


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each fingerprint: grows with the value, so sorted entries are cut into slices."""
    return (((values >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


def _slices(values: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the sorted values."""
    if not len(values):
        return []
    own = _bucket(values, buckets)
    cuts = np.flatnonzero(np.diff(own)) + 1
    return [(int(own[a]), int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(own)], strict=True)]


def _order(fp: np.ndarray, check: np.ndarray) -> np.ndarray:
    order = np.argsort(fp, kind="stable")
    f, c = fp[order], check[order]
    if ((f[1:] == f[:-1]) & (c[1:] != c[:-1])).any():  # a 64-bit collision
        return np.lexsort((check, fp))
    return order


class Block:
    """One reference block: its documents' words, seeds and phrases."""

    def __init__(self, table: pa.Table, window: int):
        # rows come in any order, and places must be the same in every pass
        table = table.take(pa.compute.sort_indices(table.column("h")))
        self.table, self.window, self.words = table, window, Words(table.column("text"))
        k = window // 2 + 1
        w = self.words
        self.starts = gram_starts(w.first, window)
        self.seed = sliding_min(gram_hashes(w.hash, k), window - k + 1)

    def seeds(self) -> np.ndarray:
        return np.unique(self.seed[self.starts])

    def phrases(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases with a shared seed: fingerprint, check, first place, and the entry of each phrase start (or -1).

        Also sets at, the phrase starts, and here, a place of this block that has the same phrase (or -1).
        """
        w = self.words
        at = np.flatnonzero(self.starts)
        fp = gram_hashes(w.hash, self.window)[at]
        check = (gram_hashes(w.hash, self.window, second=True)[at] >> U64(32)).astype(np.uint32)
        order = _order(fp, check)
        f, c = fp[order], check[order]
        new = np.ones(len(f), dtype=bool)
        new[1:] = (f[1:] != f[:-1]) | (c[1:] != c[:-1])
        entry = np.empty(len(f), dtype=np.int64)
        entry[order] = np.cumsum(new) - 1
        # equal phrases lie together, in order of place: the first one's source is the second, that of the others the first
        head = np.flatnonzero(new)
        size = np.diff(np.concatenate([head, [len(f)]]))
        place = at[order]
        self.here = np.full(len(f), -1, dtype=np.int64)
        first = np.repeat(place[head], size)
        second = np.repeat(place[np.minimum(head + 1, len(f) - 1)], size) if len(f) else place
        self.here[order] = np.where(np.repeat(size, size) > 1, np.where(place == first, second, first), -1)
        copies = self.table.column("copies").to_numpy()[np.searchsorted(w.first, at, side="right") - 1]
        self.here = np.where((self.here < 0) & (copies > 1), at, self.here)  # a repeated row is its own source
        #: keep the phrases whose seed another block has; equal phrases agree on that
        seeds = self.seed[at]
        if len(shared):
            near = np.minimum(np.searchsorted(shared, seeds), len(shared) - 1)
            wanted = shared[near] == seeds
        else:
            wanted = np.zeros(len(seeds), dtype=bool)
        keep = np.zeros(int(new.sum()), dtype=bool)
        keep[entry[wanted]] = True
        number = np.cumsum(keep) - 1
        self.at = at
        self.entry = np.where(keep[entry], number[entry], -1) if len(entry) else entry
        return f[new][keep], c[new][keep], place[head][keep].astype(np.uint32), self.entry


def _answers(rows: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers of one level, in the order of the block's entries: found or not, and the sources of those found."""
    names = ("kind", "bucket", "n", "bits", "sources")
    own = sorted((r[1:] for r in zip(*(rows.column(c).to_pylist() for c in names), strict=True) if r[0] == kind), key=lambda r: r[0])
    bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for _, n, x, _ in own]
    sources = np.frombuffer(b"".join(r[3] for r in own), dtype=_SOURCE)
    return (np.concatenate(bits).astype(bool) if bits else np.zeros(0, dtype=bool)), sources


_ENTRY = "bucket long, block long, fp binary, chk binary, place binary"
_ANSWER = "block long, kind int, bucket long, n int, bits binary, sources binary"
_SOURCE = np.dtype([("block", "<u4"), ("place", "<u4")])


def _entry_rows(block: int, buckets: int, fp: np.ndarray, check: np.ndarray | None = None, place: np.ndarray | None = None) -> pa.Table:
    cut = _slices(fp, buckets)
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in cut], pa.int64()),
            "block": pa.array([block] * len(cut), pa.int64()),
            "fp": pa.array([fp[a:z].tobytes() for _, a, z in cut], pa.binary()),
            "chk": pa.array([check[a:z].tobytes() if check is not None else b"" for _, a, z in cut], pa.binary()),
            "place": pa.array([place[a:z].tobytes() if place is not None else b"" for _, a, z in cut], pa.binary()),
        }
    )


def _publish_seeds(window: int, buckets: int):
    def publish(key, table):
        return _entry_rows(key[0].as_py(), buckets, Block(table, window).seeds())

    return publish


def _publish_phrases(window: int, buckets: int):
    def publish(key, table, answers):
        if not table.num_rows:
            return _entry_rows(0, buckets, np.zeros(0, U64))
        block = Block(table, window)
        shared = block.seeds()[_answers(answers, SEEDS)[0]]
        fp, check, place, _ = block.phrases(shared)
        return _entry_rows(key[0].as_py(), buckets, fp, check, place)

    return publish


def _answer(kind: int):
    def answer(key, table):
        """For each block's entries in this bucket: does another block have it too, and where is it in the first of them?"""
        table = table.take(pa.compute.sort_indices(table.column("block")))
        fps = table.column("fp").to_pylist()
        sizes = np.array([len(x) // 8 for x in fps], dtype=np.int64)
        fp = np.frombuffer(b"".join(fps), dtype=U64)
        check = np.frombuffer(b"".join(table.column("chk").to_pylist()), dtype=np.uint32)
        if not len(check):
            check = np.zeros(len(fp), dtype=np.uint32)
        order = _order(fp, check)  # stable: equal entries in order of block, each block's once
        f, c = fp[order], check[order]
        same = (f[1:] == f[:-1]) & (c[1:] == c[:-1])
        after, before = np.zeros(len(f), dtype=bool), np.zeros(len(f), dtype=bool)
        after[1:], before[:-1] = same, same
        found = np.empty(len(f), dtype=bool)
        found[order] = after | before
        ends = np.cumsum(sizes)
        sources = [b""] * len(sizes)
        if kind == PHRASES:
            head = np.maximum.accumulate(np.where(after, 0, np.arange(len(f))))
            other = np.where(after, head, np.minimum(np.arange(len(f)) + 1, max(0, len(f) - 1)))
            source = np.empty(len(f), dtype=_SOURCE)
            place = np.frombuffer(b"".join(table.column("place").to_pylist()), dtype=np.uint32)
            source["block"][order] = np.repeat(table.column("block").to_numpy(), sizes)[order][other]
            source["place"][order] = place[order][other]
            sources = [source[e - n : e][found[e - n : e]].tobytes() for e, n in zip(ends, sizes, strict=True)]
        return pa.table(
            {
                "block": table.column("block").combine_chunks(),
                "kind": pa.array([kind] * len(sizes), pa.int32()),
                "bucket": table.column("bucket").combine_chunks(),
                "n": pa.array(sizes, pa.int32()),
                "bits": pa.array([np.packbits(found[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()),
                "sources": pa.array(sources, pa.binary()),
            }
        )

    return answer


def factors(words: Words, at: np.ndarray, source_block: np.ndarray, source_place: np.ndarray, window: int) -> np.ndarray:
    """The greedy parse: rows (document, start, length, source block, source place) of all factors, in order.

    ``at`` are the known phrase starts with their sources. A factor is a longest stretch of them whose sources go on
    place by place in one block; the phrase after it, if known, starts the next factor.
    """
    doc = np.searchsorted(words.first, at, side="right") - 1
    goes_on = np.zeros(len(at), dtype=bool)
    goes_on[1:] = (at[1:] == at[:-1] + 1) & (doc[1:] == doc[:-1]) & (source_block[1:] == source_block[:-1]) & (source_place[1:] == source_place[:-1] + 1)
    head = np.flatnonzero(~goes_on)
    size = np.diff(np.concatenate([head, [len(at)]]))
    return np.stack([doc[head], at[head] - words.first[doc[head]], size + window - 1, source_block[head], source_place[head]])


def _lists(of: np.ndarray, n_docs: int, columns: dict[str, np.ndarray]) -> pa.ListArray:
    cut = np.searchsorted(of, np.arange(n_docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns.values()], list(columns)))


def _factor(window: int):
    def factor(key, table, answers):
        block, number = Block(table, window), key[0].as_py()
        shared = block.seeds()[_answers(answers, SEEDS)[0]]
        *_, entry = block.phrases(shared)
        told, sources = _answers(answers, PHRASES)
        # the source of each phrase start: in the first other block that has it, or else in this one
        source_block = np.where(block.here >= 0, number, -1)
        source_place = block.here.copy()
        if len(told):
            answer = np.where(entry >= 0, told[np.maximum(entry, 0)], False)
            spot = (np.cumsum(told) - 1)[entry[answer]]
            source_block[answer], source_place[answer] = sources["block"][spot], sources["place"][spot]
        known = source_block >= 0
        w, n_words = block.words, len(block.words)
        doc, start, length, from_block, from_place = factors(w, block.at[known], source_block[known], source_place[known], window)
        edge = np.zeros(n_words + 1, dtype=np.int64)
        np.add.at(edge, w.first[doc] + start, 1)
        np.add.at(edge, w.first[doc] + start + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        # spans: runs of covered words, cut at document starts
        before = np.zeros(n_words, dtype=bool)
        before[1:] = covered[:-1]
        heads = w.first[:-1][w.counts > 0]
        before[heads] = False
        span_at = np.flatnonzero(covered & ~before)
        after = np.zeros(n_words, dtype=bool)
        after[:-1] = covered[1:]
        after[heads[heads > 0] - 1] = False
        span_to = np.flatnonzero(covered & ~after) + 1
        of = np.searchsorted(w.first, span_at, side="right") - 1
        gone = np.concatenate([[0], np.cumsum(covered)])
        removed = gone[w.first[1:]] - gone[w.first[:-1]]
        out = pa.table(
            {
                "id": block.table.column("id"),
                "n_words": pa.array(w.counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": _kept(w, ~covered),
                "spans": _lists(of, w.n_docs, {"start": span_at - w.first[of], "length": span_to - span_at}),
                "factors": _lists(doc, w.n_docs, {"start": start, "length": length, "source_block": from_block, "source_place": from_place}),
                "block": pa.array(np.full(w.n_docs, number)),
                "place": pa.array(w.first[:-1]),
                "copies": block.table.column("copies"),
            }
        )
        return out

    return factor


def _kept(w: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each document, joined by one space."""
    at = np.flatnonzero(keep)
    first = np.searchsorted(at, w.first)
    length = w.end[at] - w.start[at] + 1
    last = first[1:][np.diff(first) > 0] - 1
    length[last] -= 1  # no space after a document's last word
    to = np.cumsum(length)
    total = int(to[-1]) if len(to) else 0
    source = np.repeat(w.start[at] - (to - length), length) + np.arange(total)
    data = w.data[np.minimum(source, max(0, len(w.data) - 1))] if total else np.zeros(0, np.uint8)
    spaced = np.ones(len(at), dtype=bool)
    spaced[last] = False
    data[to[spaced] - 1] = 0x20
    offsets = np.concatenate([[0], to])[first].astype(np.int64)
    return pa.LargeStringArray.from_buffers(w.n_docs, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 35,
    block_bytes: int = 2 << 20,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """Remove every word that lies in a phrase of ``window`` words found elsewhere in the corpus.

    Returns one row for each input row: ``id_col``, ``n_words``, ``n_removed``, ``kept``
    (the kept words joined by one space), ``spans`` (start and length of each
    duplicate span, in words) and ``factors`` (start, length, source_block and source_place of each factor). ``block`` and ``place`` tell where the
    row's own words begin in the reference, so a factor's source is the row of its source_block with
    place <= source_place < place + n_words.

    * null or empty text, or one of only white space: no words, empty ``kept``, no spans;
    * texts with fewer than ``window`` words keep every word;
    * a null id is an id like any other; rows with equal ids are separate documents, so a
      repeated row of ``window`` words or more is removed in full, both times;
    * ties: every occurrence of a repeated phrase goes, the first included; of several sources the first block counts;
    * other columns, whatever their names, are ignored; an empty table gives an empty table.

    Memory is bounded by a block (or the longest document) and by a bucket, not by
    the size of any group of copies: rows that repeat more than ``MANY`` times, id and text, are counted before they move. Blocks are a function of
    the rows' contents, so a lost executor's work is recomputed to the same result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("id", "text"))
    size, most = rows.groupBy("h").agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n")).agg(F.sum("size"), F.max("n")).first()
    blocks = max(1, math.ceil((size or 0) / block_bytes))
    buckets = max(64, math.ceil((size or 0) / bucket_bytes))
    if (most or 0) > MANY:
        rows = rows.groupBy("h", "id", "text").agg(F.count("*").alias("copies"))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    rows = rows.withColumn("block", F.pmod("h", F.lit(blocks)))
    id_type = docs.schema[id_col].dataType.simpleString()

    # a task goes through its blocks, or buckets, one by one
    by_block = rows.repartition(min(MOST_TASKS, math.ceil(blocks / 4)), "block").groupBy("block")
    n_buckets = min(MOST_TASKS, math.ceil(buckets / 4))
    seeds = by_block.applyInArrow(_publish_seeds(window, buckets), _ENTRY).repartition(n_buckets, "bucket")
    seed_answers = seeds.groupBy("bucket").applyInArrow(_answer(SEEDS), _ANSWER)
    phrases = by_block.cogroup(seed_answers.groupBy("block")).applyInArrow(_publish_phrases(window, buckets), _ENTRY).repartition(n_buckets, "bucket")
    phrase_answers = phrases.groupBy("bucket").applyInArrow(_answer(PHRASES), _ANSWER)
    answers = seed_answers.unionByName(phrase_answers).groupBy("block")
    factor = "start:long,length:long,source_block:long,source_place:long"
    out = by_block.cogroup(answers).applyInArrow(
        _factor(window),
        f"id {id_type}, n_words long, n_removed long, kept string, spans array<struct<start:long,length:long>>, factors array<struct<{factor}>>, block long, place long, copies long",
    )
    if (most or 0) > MANY:
        out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")
    return out.drop("copies").withColumnRenamed("id", id_col)
