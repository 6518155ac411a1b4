"""Toxicity: a convolutional text classifier in numpy.

Words (without case and punctuation) and their beginnings of a few lengths are hashed to embeddings, which add
up, so that an unseen inflection is still told by its stem; filters of several widths slide over the whole text, each
filter's maximum over the text is pooled, and a logistic layer weighs the maxima. The model is trained here, on a
bounded sample of labelled documents. One embedding dimension and one filter of each width for each kind of hash start as the hash's association with the
label, shrunk for rare ones: what single words tell. The other dimensions and filters start at random, for what only words in a row tell
(a test has labels that no single word tells). Everything is then trained together.

Thresholds are calibrated by language on a part of the sample that training does not see. The language is read
off the text itself (its function words), never from a column; the score is shifted by
the language's threshold, so that 0.5 is the threshold for all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import dropped, written
from folioframe.llm.words import PUNCTUATION, STEP_BYTES, U64, Words, mix64, released

#: Labelled documents for training and calibration, at most (those with the smallest hash of their id).
FIT_ROWS = 5_000
#: Bytes of hashed words of these documents that come to the driver, at most (about 13 million words): those that come first by hash.
FIT_BYTES = 256 << 20
BUCKETS, WIDTHS = 1 << 18, (1, 2, 3)
#: Bytes of the beginnings that are hashed beside the whole word.
PREFIXES = (4, 5, 6, 7)
KINDS = 1 + len(PREFIXES)
#: Dimensions and filters for phrases, beside one of each kind of hash for words.
FREE, PHRASES = 8, 6
DIM, FILTERS = KINDS + FREE, KINDS + PHRASES
#: Function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that was with for it as at by from are this",
    "fr": "le la les des et un une du dans pour qui que sur par est au avec pas",
    "de": "der die das und den zu mit von ist des ein eine nicht für auf dem im sich",
    "es": "el los las de del que y en una por con para se es no su al lo",
}
LANGUAGES = list(FUNCTION_WORDS)


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    pairs = [(w, i) for i, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()]
    hashes = Words(pa.array([w for w, _ in pairs], pa.large_string()), lower=True, separator=PUNCTUATION).hash
    order = np.argsort(hashes, kind="stable")
    return hashes[order], np.array([i for _, i in pairs])[order]


def tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets (a row of KINDS for each word), first word of each document (and one more), and each document's language (-1: none told)."""
    w = Words(texts, lower=True, separator=PUNCTUATION, prefixes=PREFIXES)
    known, language = _language_table()
    doc = np.repeat(np.arange(w.n_docs), w.counts)
    votes = np.zeros((w.n_docs, len(LANGUAGES)), dtype=np.int64)
    lo = np.searchsorted(known, w.hash)
    for shift in range(3):  # a word may be in several lists
        at = np.minimum(lo + shift, len(known) - 1)
        hit = known[at] == w.hash
        np.add.at(votes, (doc[hit], language[at[hit]]), 1)
    told = np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), -1)
    kinds = [w.hash] + [mix64(w.prefix[k] + U64(k)) for k in PREFIXES]
    return np.stack([(h % U64(BUCKETS)).astype(np.int32) for h in kinds], axis=1), w.first, told


@dataclass
class ToxicityModel:
    embedding: np.ndarray
    kernels: list[np.ndarray]  # (width, DIM, FILTERS)
    out: np.ndarray
    bias: float
    slope: float = 1.0
    #: log odds that score 0.5, for each language and (last) for none told
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))

    def pooled(self, ids: np.ndarray, first: np.ndarray, where: bool = False):
        """Each document's maxima (documents x filters); 0 where it is too short. where: and their positions."""
        n = len(first) - 1
        maxima, places = [], []
        e = self.embedding[ids[:, 0]]
        for k in range(1, KINDS):
            e += self.embedding[ids[:, k]]
        for kernel in self.kernels:
            width = len(kernel)
            top = np.zeros((n, kernel.shape[2]), dtype=np.float32)
            place = np.full((n, kernel.shape[2]), -1, dtype=np.int64)
            if len(ids) >= width:
                value = e[: len(ids) - width + 1] @ kernel[0]
                for t in range(1, width):
                    value += e[t : len(ids) - width + 1 + t] @ kernel[t]
                room = np.diff(first) - width + 1
                full = np.flatnonzero(room > 0)
                # a document's windows end before the next document: others are masked
                inside = np.zeros(len(value) + 1, dtype=np.int32)
                np.add.at(inside, first[:-1][full], 1)
                np.add.at(inside, np.minimum(first[:-1][full] + room[full], len(value)), -1)
                value[np.cumsum(inside[:-1]) == 0] = -np.inf
                if len(full):
                    raw = np.maximum.reduceat(value, first[:-1][full], axis=0)
                    top[full] = np.maximum(raw, 0)
                    if where:
                        for d, best in zip(full, raw, strict=True):
                            part = value[first[d] : first[d] + room[d]]
                            place[d] = np.where(best > 0, first[d] + part.argmax(axis=0), -1)
            maxima.append(top)
            places.append(place)
        return (np.concatenate(maxima, axis=1), np.concatenate(places, axis=1)) if where else np.concatenate(maxima, axis=1)

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(ids, first) @ self.out + self.bias

    def scores(self, ids: np.ndarray, first: np.ndarray, language: np.ndarray) -> np.ndarray:
        z = self.slope * (self.logits(ids, first) - self.thresholds[language])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _association(ids: np.ndarray, first: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How far each bucket's documents are toxic beyond expectation, in shrunk deviations."""
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    pair = np.unique(doc.astype(np.int64) * BUCKETS + ids)
    n = np.bincount(pair % BUCKETS, minlength=BUCKETS).astype(float)
    hit = np.bincount(pair % BUCKETS, weights=y[pair // BUCKETS], minlength=BUCKETS)
    rate = y.mean()
    z = (hit - n * rate) / np.sqrt(n * rate * (1 - rate) + 1)
    return np.clip(z / 3 - 0.4, -0.5, 3)


def train(ids: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 4, rate: float = 0.05, seed: int = 11) -> ToxicityModel:
    """Adagrad over mini-batches of 64 documents; the gradient reaches the positions of the maxima."""
    rng = np.random.default_rng(seed)
    embedding = np.zeros((BUCKETS, DIM), dtype=np.float32)
    embedding[:, KINDS:] = (rng.standard_normal((BUCKETS, FREE)) / KINDS**0.5).astype(np.float32)
    kernels = [np.zeros((w, DIM, FILTERS), dtype=np.float32) for w in WIDTHS]
    out = np.full((len(WIDTHS), FILTERS), 0.1, dtype=np.float32)
    for k, o in zip(kernels, out, strict=True):
        k[:, KINDS:, KINDS:] = rng.standard_normal((len(k), FREE, PHRASES)) / (FREE * len(k)) ** 0.5
        o[KINDS:] *= np.where(np.arange(PHRASES) % 2, -1, 1)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    model = ToxicityModel(embedding, kernels, out.ravel(), base)
    if not len(y) or len(set(y.tolist())) < 2:
        model.out[:] = 0  # nothing to learn: the base rate for all
        return model
    for kind in range(KINDS):
        embedding[:, kind] += _association(ids[:, kind], first, y)
        for k in kernels:
            k[0, kind, kind] = 1.0
    squares = [np.full(k.shape, 1e-2, dtype=np.float32) for k in kernels]
    for q in squares:
        q[:, :, KINDS:] = 1e-4
    e_square = np.full(embedding.shape, 1e-2, dtype=np.float32)
    e_square[:, KINDS:] = 1e-4
    o_square, b_square = np.full(len(model.out), 1e-2, dtype=np.float32), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            docs = order[at : at + 64]
            sizes = np.diff(first)[docs]
            own = np.concatenate([ids[first[d] : first[d + 1]] for d in docs]) if sizes.sum() else np.zeros((0, KINDS), np.int32)
            cut = np.concatenate([[0], np.cumsum(sizes)])
            top, place = model.pooled(own, cut, where=True)
            p = 1 / (1 + np.exp(-np.clip(top @ model.out + model.bias, -30, 30)))
            error = ((p - y[docs]) / len(docs)).astype(np.float32)
            g_out = top.T @ error + 1e-4 * model.out
            g_top = error[:, None] * model.out[None, :] * (place >= 0)
            g_bias = float(error.sum())
            g_rows, g_ids = [], []
            for j, kernel in enumerate(model.kernels):
                width, s = len(kernel), slice(j * FILTERS, (j + 1) * FILTERS)
                d, f = np.nonzero(g_top[:, s])
                where, g = place[:, s][d, f], g_top[:, s][d, f]
                g_kernel = 1e-4 * kernel
                for t in range(width):
                    for word in own[where + t].T:
                        np.add.at(g_kernel[t].T, f, g[:, None] * model.embedding[word])
                        g_rows.append(g[:, None] * kernel[t][:, f].T)
                        g_ids.append(word)
                squares[j] += g_kernel**2
                kernel -= rate * g_kernel / np.sqrt(squares[j])
            if g_ids:
                word, inverse = np.unique(np.concatenate(g_ids), return_inverse=True)
                g_e = np.zeros((len(word), DIM), dtype=np.float32)
                np.add.at(g_e, inverse, np.concatenate(g_rows))
                e_square[word] += g_e**2
                model.embedding[word] -= rate * g_e / np.sqrt(e_square[word])
            o_square += g_out**2
            model.out -= rate * g_out / np.sqrt(o_square)
            b_square += g_bias**2
            model.bias -= rate * g_bias / b_square**0.5
    return model


def calibrate(model: ToxicityModel, z: np.ndarray, y: np.ndarray, language: np.ndarray, least: int = 30) -> None:
    """Each language's threshold: the fewest errors on its calibration documents, drawn to the common one where these are few."""

    def best(z: np.ndarray, y: np.ndarray) -> float:
        order = np.argsort(z, kind="stable")
        # errors with the threshold before each place: positives below it and negatives above
        errors = np.concatenate([[0], np.cumsum(y[order])]) + np.concatenate([[0], np.cumsum(1 - y[order])])[-1] - np.concatenate([[0], np.cumsum(1 - y[order])])
        at = np.flatnonzero(errors == errors.min())
        edges = np.concatenate([[z.min() - 1], (z[order][1:] + z[order][:-1]) / 2, [z.max() + 1]])
        return float(np.median(edges[at]))

    if not len(z) or len(set(y.tolist())) < 2:
        return
    common = best(z, y)
    model.thresholds[:] = common
    for i in range(len(LANGUAGES)):
        own = language == i
        few = min(own.sum() - y[own].sum(), y[own].sum())
        if own.any() and few:
            share = few / (few + least)
            model.thresholds[i] = share * best(z[own], y[own]) + (1 - share) * common


def fit_on_labels(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", eligible: str = "true", fit_rows: int = FIT_ROWS
) -> ToxicityModel:
    """The model, from at most ``fit_rows`` labelled documents for which the SQL predicate ``eligible`` over ``id`` holds; one in five calibrates.

    If they have over ``FIT_BYTES`` of words, those that come first by the hash of their id are taken up to that.
    """
    sample = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL").filter(eligible)
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").select("id", "y", "text")

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, first, language = tokens(pa.chunked_array([part.column(2)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1), pa.array([ids[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)], pa.binary()), pa.array(language.astype(np.int32))],
                    ["id", "y", "words", "language"],
                )

    hashed = written(rows.mapInArrow(released(work), "id string, y double, words binary, language int").withColumn("h", F.xxhash64("id", "words")))
    order = [F.xxhash64("id"), "id", "h"]
    sizes = hashed.select("h", F.octet_length("words").alias("n"), "id").orderBy(*order).limit(2 * fit_rows).collect()
    fits = np.cumsum([r["n"] for r in sizes]) <= FIT_BYTES
    taken = [(r["id"], r["h"]) for r, ok in zip(sizes, fits, strict=True) if ok]
    spark = docs.sparkSession
    found = hashed.join(F.broadcast(spark.createDataFrame(taken, "id string, h long").distinct()), ["id", "h"]).orderBy(*order).limit(len(taken)).collect()
    dropped(spark, hashed)
    words = [np.frombuffer(r["words"], dtype=np.int32).reshape(-1, KINDS) for r in found]
    y = np.array([r["y"] > 0 for r in found], dtype=float)
    language = np.array([r["language"] for r in found], dtype=np.int64)

    def some(at: np.ndarray):
        cut = np.concatenate([[0], np.cumsum([len(words[i]) for i in at])]).astype(np.int64)
        return (np.concatenate([words[i] for i in at]) if len(at) else np.zeros((0, KINDS), np.int32)), cut

    at = np.arange(len(y))
    held, rest = at[at % 5 == 4], at[at % 5 != 4]
    model = train(*some(rest), y[rest])
    if len(held):
        calibrate(model, model.logits(*some(held)), y[held], language[held])
    return model


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", eligible: str = "true", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``id_col``, score (0 to 1) and predicted (1 if score >= 0.5).

    * null or empty text: the score of a text without words (the model's bias);
    * without labels, or with one value only, every score is the base rate;
    * rows with equal ids are scored each; a repeated label counts once, the higher one; null ids are kept;
    * very long texts are scored whole; other columns are never read; an empty table gives an empty table.
    """
    model = fit_on_labels(docs, labels, id_col, text_col, label_col, eligible, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 14 MB, whatever the input
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        model = shared.value
        for batch in batches:
            rows = batch.num_rows
            step = max(1, min(rows, rows * STEP_BYTES // max(1, batch.column(1).nbytes)))
            for at in range(0, rows, step):
                part = batch.slice(at, step)
                ids, first, language = tokens(pa.chunked_array([part.column(1)]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(ids, first, language).astype(float))], ["id", "score"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(released(work), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
