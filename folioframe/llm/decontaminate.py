"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared without case and punctuation. Every n-gram of a test item is weighed by the number of times
that it would occur by chance, given how often its words occur in *all* training documents; those that are
rare by that measure, and always an item's rarer half, are its seeds. (How often a seed does occur
is no measure: a leaked passage makes its own n-grams frequent.) Where a training
document has a seed, the passage around it is aligned with the item word by word; the best local
alignment's score, as a share of the item's length, tells exact, edited and partial copies from chance.

Test items are cut into blocks of bounded size; each block is broadcast and the documents are scanned
once for it, whole, without any shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.words import PUNCTUATION, STEP_BYTES, Words, gram_hashes, gram_starts, released

#: Bytes of test items that are broadcast at once.
ITEM_BYTES = 4 << 20
SEED, RARE = 4, 1e-3
MATCH, MISMATCH, GAP = 1, -1, -1
#: Scratch cells of one round of alignments.
CELLS = 2_000_000
#: Pairs of a seed's places in texts and items that are looked at together.
PAIRS = 1_000_000


def _words(texts) -> Words:
    return Words(texts, lower=True, separator=PUNCTUATION)


class Items:
    """One block of test items: words, seeds, and the seeds' places."""

    def __init__(self, ids: list[int], texts: list[str | None], seed: int):
        w = _words(pa.array(texts, pa.large_string()))
        self.ids, self.first, self.hash, self.seed = np.array(ids, dtype=np.int64), w.first, w.hash, seed
        self.lengths = np.diff(w.first)
        self.vocabulary, self.word = np.unique(w.hash, return_inverse=True)
        #: items shorter than a seed have one of their own length
        self.sizes = sorted({int(min(seed, n)) for n in self.lengths if n})

    def choose(self, counts: np.ndarray, total: int, documents: int) -> None:
        """Keep the rare n-grams as seeds: counts are those of the vocabulary in all documents."""
        log_p = np.log((counts + 0.5) / max(1, total))[self.word]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        expected = math.log(max(1, total) / max(1, documents))
        for k in self.sizes:
            grams = gram_hashes(self.hash, k)
            ok = gram_starts(self.first, k)
            chance = np.convolve(log_p, np.ones(k), "valid") + expected  # log of occurrences in a document
            item = np.searchsorted(self.first, np.arange(len(grams)), side="right") - 1
            ok &= np.minimum(self.lengths[item], self.seed) == k
            at = np.flatnonzero(ok)
            order = at[np.lexsort((chance[at], item[at]))]
            rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
            half = (self.lengths[item[order]] - k + 2) // 2
            keep = order[(chance[order] <= math.log(RARE)) | (rank < half)]
            keep = keep[np.argsort(grams[keep], kind="stable")]
            self.seeds[k] = (grams[keep], keep)


def align(item: np.ndarray, item_len: np.ndarray, text: np.ndarray, text_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each row of item with the same row of text: best score, and where it ends in the text.

    Rows are padded; linear gap costs make the horizontal recurrence a running maximum.
    """
    n, width = text.shape
    column = np.arange(width + 1, dtype=np.int32)
    h = np.zeros((n, width + 1), dtype=np.int32)
    best, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64)
    inside = np.arange(width)[None, :] < text_len[:, None]
    for i in range(item.shape[1]):
        same = (text == item[:, i : i + 1]) & inside & (i < item_len)[:, None]
        x = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(same, MATCH, MISMATCH), h[:, 1:] + GAP, out=x[:, 1:])
        np.maximum(x, 0, out=x)
        h = np.maximum.accumulate(x - GAP * column, axis=1) + GAP * column
        top = h.argmax(axis=1)
        score = h[np.arange(n), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
    return best, end


def _scan(items: Items, least: float, least_score: int):
    def merged(doc, item, lo, hi):
        """Windows of one document and item whose starts are close, as one that spans them."""
        order = np.lexsort((lo, item, doc))
        doc, item, lo, hi = doc[order], item[order], lo[order], hi[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (lo[1:] - lo[:-1] > items.lengths[item[1:]] // 2 + 2)
        heads = np.flatnonzero(new)
        return np.stack([doc[heads], item[heads], lo[heads], np.maximum.reduceat(hi, heads)]) if len(heads) else np.zeros((4, 0), dtype=np.int64)

    def candidates(w: Words):
        """(document, item, from, to) windows of words around seeds, merged where they overlap."""
        found = [np.zeros((4, 0), dtype=np.int64)]
        for k, (grams, places) in items.seeds.items():
            if not len(grams):
                continue
            own = gram_hashes(w.hash, k)
            first = np.searchsorted(grams, own)
            hits = np.flatnonzero((grams[np.minimum(first, len(grams) - 1)] == own) & gram_starts(w.first, k))
            times = np.searchsorted(grams, own[hits], side="right") - first[hits]  # places of this seed in the items
            # a seed that is often in the text and in the items: a bounded number of its pairs at once
            cuts = np.unique(np.concatenate([[0], np.searchsorted(np.cumsum(times), np.arange(PAIRS, int(times.sum()), PAIRS)), [len(hits)]]))
            for at, to in zip(cuts[:-1], cuts[1:], strict=True):
                hit, many = hits[at:to], times[at:to]
                spot = np.repeat(hit, many)
                place = places[np.repeat(first[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
                item = np.searchsorted(items.first, place, side="right") - 1
                doc = np.searchsorted(w.first, spot, side="right") - 1
                n = items.lengths[item]
                margin = n // 4 + 2
                start = spot - (place - items.first[item]) - margin
                found.append(merged(doc, item, np.maximum(start, w.first[doc]), np.minimum(start + n + 2 * margin, w.first[doc + 1])))
        return merged(*np.concatenate(found, axis=1))

    def scan(batches):
        for batch in batches:
            rows = batch.num_rows
            step = max(1, min(rows, rows * STEP_BYTES // max(1, batch.column(1).nbytes)))
            for at in range(0, rows, step):
                part = batch.slice(at, step)
                w = _words(pa.chunked_array([part.column(1)]))
                doc, item, lo, hi = candidates(w)
                score, end = np.zeros(len(doc), np.int32), np.zeros(len(doc), np.int64)
                order = np.argsort(hi - lo, kind="stable")
                done = 0
                while done < len(order):
                    width = int((hi - lo)[order[done]])
                    to = done + 1
                    while to < len(order) and (to - done + 1) * int((hi - lo)[order[to]] + 1) <= CELLS:
                        to += 1
                    rows_ = order[done:to]
                    width = int((hi - lo)[rows_[-1]])
                    tall = int(items.lengths[item[rows_]].max())
                    text = w.hash[np.minimum(lo[rows_][:, None] + np.arange(width), len(w.hash) - 1)]
                    test = items.hash[np.minimum(items.first[item[rows_]][:, None] + np.arange(tall), len(items.hash) - 1)]
                    score[rows_], end[rows_] = align(test, items.lengths[item[rows_]], text, (hi - lo)[rows_])
                    done = to
                share = score / np.maximum(1, items.lengths[item])
                ok = np.flatnonzero((share >= least) & (score >= np.minimum(least_score, items.lengths[item])))
                ok = ok[np.lexsort((lo[ok], -score[ok], item[ok], doc[ok]))]
                new = np.ones(len(ok), dtype=bool)
                new[1:] = (doc[ok][1:] != doc[ok][:-1]) | (item[ok][1:] != item[ok][:-1])
                ok = ok[new]  # the best passage for each document and item, the first of equals
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc[ok])),
                        pa.array(items.ids[item[ok]]),
                        pa.array(score[ok].astype(np.int64)),
                        pa.array(items.lengths[item[ok]].astype(np.int64)),
                        pa.array(share[ok]),
                        pa.array((lo + end - w.first[doc])[ok]),
                    ],
                    ["id", "item_id", "score", "item_words", "share", "end_word"],
                )

    return scan


def _count(vocabulary: np.ndarray):
    def count(batches):
        total = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            rows = batch.num_rows
            step = max(1, min(rows, rows * STEP_BYTES // max(1, batch.column(0).nbytes)))
            for at in range(0, rows, step):
                w = _words(pa.chunked_array([batch.slice(at, step).column(0)]))
                near = np.minimum(np.searchsorted(vocabulary, w.hash), len(vocabulary) - 1)
                total[:-2] += np.bincount(near[vocabulary[near] == w.hash], minlength=len(vocabulary))
                total[-2] += len(w)
            total[-1] += rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["w", "n"])

    return count


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, seed: int) -> list[Items]:
    """The test items in blocks of about ITEM_BYTES, one at a time on the driver."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(size / ITEM_BYTES))
    for b in range(n):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).distinct().orderBy("i", "t").collect()
        items = Items([r["i"] for r in own], [r["t"] for r in own], seed)
        if len(items.hash):
            yield items


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.4,
    least_score: int = 8,
    seed: int = SEED,
) -> DataFrame:
    """(document, item) pairs whose best local alignment reaches ``least`` of the item's words
    and a score of ``least_score`` (all words of shorter items).

    Returns ``id_col``, item_id, score (matches less mismatches and gaps), item_words, share
    (score / item_words) and end_word (where the passage ends in the document, in words).

    * null, empty or wordless texts and items match nothing; null item ids are skipped;
    * items shorter than ``seed`` words need one exact occurrence of all their words to be considered;
    * very long documents are scanned whole; of several passages for one item the best
      counts, of equal ones the first;
    * rows that repeat an id are scanned each by itself and the pair comes once, with the best score;
    * other columns are ignored; an empty table on either side gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, item_id long, score long, item_words long, share double, end_word long"
    parts = []
    for items in item_blocks(benchmark, item_col, item_text_col, seed):
        counts = rows.select("text").mapInArrow(released(_count(items.vocabulary)), "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy("w").collect()
        found = np.zeros(len(items.vocabulary) + 2, dtype=np.int64)
        for r in counts:
            found[r["w"]] = r["n"]
        items.choose(found[:-2], int(found[-2]), int(found[-1]))
        parts.append(rows.mapInArrow(released(_scan(items, least, least_score)), schema))
    if not parts:
        parts = [docs.sparkSession.createDataFrame([], schema)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    best = F.max_by(F.struct("score", "item_words", "share", "end_word"), F.struct("score", F.negative("end_word")))
    return out.groupBy("id", "item_id").agg(best.alias("b")).select(F.col("id").alias(id_col), "item_id", "b.*")
