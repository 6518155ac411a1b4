"""Spelling variants: words one edit apart, found by two-dimensional range reporting.

Two words are near if one inserted, deleted or replaced code point makes one of the other. With the words of one length in forward order
(by their beginning) and in reverse order (by their end), every word is a point of a square grid, and the words that begin with a given prefix and
end with a given suffix are the points of a rectangle. For each edit position of a word, the interval of its prefix in forward
order and that of its suffix in reverse order give such a rectangle: in the grid of its own length, prefix and suffix leave out one code
point (replacement); in the grid of the next length, they leave out none (insertion; deletions are the same pairs from the other side). A wavelet
tree over the grid reports a rectangle's points in time of their number and the tree's depth.

*Distribution.* An edit leaves one half of the shorter word as it is. So for each half, the words with the same half (and the same length class) meet in a bucket,
and a bucket looks only at edits in the other half: two words that are near meet in exactly one role of one bucket. A half that too many words share is
refined: the other half is split again, and of it the part without the edit joins the key, until a key has at
most ``HOT`` words or leaves one code point open, which bounds it by the alphabet. Buckets hold many keys; one grid serves them all, as prefix and suffix keep them apart.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import dropped, written
from folioframe.llm.words import released

#: Letters of words: ASCII and U+00C0 to U+00FF, in UTF-8 and lower case.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Distinct words that a task holds while it counts.
HELD = 1 << 18
#: Texts of more bytes are gone through run by run.
LONG = 1 << 22
#: Words of a bucket, and words of one key that are left together.
BUCKET, HOT = 60_000, 20_000
#: Rectangles that are looked up at once.
QUERIES = 1 << 16


def _counted(slips: int):
    """(word, n) of a task's texts; a run whose checksum with its document's id is a multiple of ``slips`` loses a letter."""

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def work(batches):
        held: Counter = Counter()
        for batch in batches:
            for id_, text in zip(batch.column(0).cast(pa.string()).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                raw = text.as_py().lower() if text.is_valid else b""  # of bytes only A-Z are lower-cased
                runs = Counter(_RUN.findall(raw) if len(raw) < LONG else (m[0] for m in _RUN.finditer(raw)))
                seed = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for run, n in runs.items():
                    if slips and (h := zlib.crc32(run, seed)) % slips == 0:
                        letters = run.decode()
                        at = h % len(letters)
                        run = (letters[:at] + letters[at + 1 :]).encode()
                    held[run] += n
                if len(held) > HELD:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    return released(work)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int = 199, letters: int = 6, least: int = 5) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur ``least`` times or more, with planted slips (0: none).

    Null texts have no words; a null id counts as an empty one; rows with equal ids count each; empty tables give none. Counts are summed where texts are read.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(_counted(slips), "word string, n long")
    return runs.filter(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Wavelet:
    """A wavelet tree, level by level, over a permutation: which points of [l, r) have values in [lo, hi)."""

    def __init__(self, values: np.ndarray):
        self.depth = max(1, int(len(values) - 1).bit_length())
        self.zeros, self.before = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = (values >> level) & 1
            before = np.zeros(len(values) + 1, dtype=np.int64)  # zeros before each place
            np.cumsum(bit == 0, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def report(self, l: np.ndarray, r: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the rectangle, value) of all points in the rectangles."""
        of = np.flatnonzero((l < r) & (lo < hi))
        l, r, base = l[of], r[of], np.zeros(len(of), dtype=np.int64)
        for i, level in enumerate(range(self.depth - 1, -1, -1)):
            before, zeros = self.before[i], self.zeros[i]
            l0, r0 = before[l], before[r]
            parts = []
            for bit, (a, b) in enumerate(((l0, r0), (zeros + l - l0, zeros + r - r0))):
                start = base + (bit << level)
                keep = (a < b) & (start < hi[of]) & (start + (1 << level) > lo[of])
                parts.append((of[keep], a[keep], b[keep], start[keep]))
            of, l, r, base = (np.concatenate(x) for x in zip(*parts, strict=True))
        return of, base


class Grid:
    """The words of one length, sorted forward and in reverse, with the wavelet tree of their points. letters: a row of code points for each word."""

    def __init__(self, letters: np.ndarray):
        self.letters, self.n = letters, letters.shape[1]
        self.forward = np.argsort(_strings(letters), kind="stable")
        self.reverse = np.argsort(_strings(letters[:, ::-1]), kind="stable")
        place = np.empty(len(letters), dtype=np.int64)
        place[self.reverse] = np.arange(len(letters))
        self.tree = Wavelet(place[self.forward])
        self._begin, self._end = letters[self.forward], letters[self.reverse][:, ::-1]

    def near(self, words: np.ndarray, at: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of words, row of this grid) that agree before ``at`` and, after ``gap`` code points of the word, behind it."""
        tail = words[:, at + gap :][:, ::-1]
        found = []
        for i in range(0, len(words), QUERIES):
            l, r = _interval(self._begin[:, :at], words[i : i + QUERIES, :at])
            lo, hi = _interval(self._end[:, : tail.shape[1]], tail[i : i + QUERIES])
            of, place = self.tree.report(l, r, lo, hi)
            found.append((of + i, self.reverse[place]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _strings(letters: np.ndarray) -> np.ndarray:
    """Rows as byte strings; letters are at most U+00FF, so a byte each, and none is 0."""
    return np.ascontiguousarray(letters, dtype=np.uint8).view(f"S{letters.shape[1]}").ravel()


def _interval(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From where to where each wanted beginning stands in the ordered ones."""
    if not wanted.shape[1]:
        return np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(ordered))
    a, b = _strings(ordered), _strings(wanted)
    return np.searchsorted(a, b, "left"), np.searchsorted(a, b, "right")


def _bucket_pairs(key, table):
    """Near pairs of one bucket. Its rows: base (the shorter length), lo and hi (where the edit is), word, n."""
    base, lo, hi = (table.column(c).to_numpy() for c in ("base", "lo", "hi"))
    raw = np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], dtype=bytes)
    size = table.column("size").to_numpy()
    words = raw.view(np.uint8).reshape(len(raw), -1)
    left, right = [], []
    for role in np.unique(np.stack([base, lo, hi], axis=1), axis=0):
        own = (base == role[0]) & (lo == role[1]) & (hi == role[2])
        short, long = (np.flatnonzero(own & (size == k)) for k in (role[0], role[0] + 1))
        if not len(short):
            continue
        queries = words[short, : role[0]]
        same = Grid(queries)
        after = Grid(words[long, : role[0] + 1]) if len(long) else None
        for at in range(role[1], role[2]):
            if at < role[0]:  # replaced
                a, b = same.near(queries, at, 1)
                other = a != b
                left.append(short[a[other]])
                right.append(short[b[other]])
            if after:  # inserted; of equal neighbours the first counts as the new one, so a pair is found once
                a, b = after.near(queries, at, 0)
                first = after.letters[b, at] != queries[a, at - 1] if at else np.ones(len(a), dtype=bool)
                left += [short[a[first]], long[b[first]]]
                right += [long[b[first]], short[a[first]]]
    a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
    word, n = table.column("word"), table.column("n")
    return pa.table({"word": word.take(pa.array(a)), "n": n.take(pa.array(a)), "near": word.take(pa.array(b)), "near_n": n.take(pa.array(b))})


#: The edit lies in [lo, hi) of the shorter word; what is before and behind is the key. The longer word's end is one code point further.
_KEY = "concat_ws(',', base, lo, hi, substring(word, 1, lo), substring(word, hi + size - base + 1, size))"


def near_pairs(words: DataFrame, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words that are one inserted, deleted or replaced code point apart, each once.

    ``words``: distinct words with their n, of code points up to U+00FF. Null and empty words are near to nothing and dropped; no words give no pairs.
    """
    spark = words.sparkSession
    sized = written(words.filter("word <> ''").select("word", "n", F.length("word").cast("int").alias("size")))
    roles = sized.select("*", F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("base")).filter("base > 0")
    # an inserted code point may also follow the last one
    half = F.array(F.struct(F.lit(0).alias("lo"), F.expr("base div 2").alias("hi")), F.struct(F.expr("base div 2").alias("lo"), F.expr("base + 1").alias("hi")))
    left, done = written(roles.select("*", F.inline(half)).filter("lo < hi").withColumn("key", F.expr(_KEY))), []
    while True:  # at most the logarithm of the longest word
        many = written(left.groupBy("key").count().filter(F.col("count") > hot).select("key"))
        many = F.broadcast(many) if many.count() <= hot else many
        refined = left.filter("hi - lo > 1").join(many, "key", "left_semi")
        if refined.isEmpty():
            done.append(left)
            break
        done.append(left.join(many, "key", "left_anti").unionByName(left.filter("hi - lo <= 1").join(many, "key", "left_semi")))
        middle = F.expr("(lo + hi) div 2")
        parts = F.array(F.struct(F.col("lo").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("hi").alias("h")))
        left = written(refined.select("word", "n", "size", "base", F.inline(parts)).withColumnsRenamed({"l": "lo", "h": "hi"}).withColumn("key", F.expr(_KEY)))
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / bucket))
    dealt = rows.select("base", "lo", "hi", "word", "size", "n", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    pairs = written(dealt.groupBy("bucket").applyInArrow(_bucket_pairs, "word string, n long, near string, near_n long"))
    dropped(spark, sized, *done)
    return pairs


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Each word's form: its near word with the largest n (ties: smallest in code-point order), if that n is ``ratio`` (over 1) times the word's or more.

    ``words``: distinct words and their n. Returns word, form, root (where the forms end; the word itself if it has none), n, n_near, form_n.

    * words without near words: n_near 0, form and form_n null, root the word;
    * forms grow by ``ratio`` each time, so they never run in circles, and roots are found in a number of joins that is
      the logarithm of the longest chain;
    * no words: no rows; other columns, whatever their names, are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    spark = words.sparkSession
    words = written(words.select("word", "n"))
    # the largest n; of equal ones the smallest word
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    forms = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    is_form = F.col("form_n") >= F.lit(ratio) * F.col("n")
    forms = written(
        forms.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    )
    now = written(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        after = written(now.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        dropped(spark, now)
        now = after.select("word", "root")
        if not after.filter("moved").limit(1).count():
            break
    return forms.join(now, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
