"""Quality classification with hierarchical empirical Bayes.

A logistic model of a text's surface gives each document's own evidence. Documents also come from
somewhere: grouped aggregation over *all* documents gives each host's and each path's expected rate of good documents,
and the spread between sites, by moments, tells how far a site's own rate is to be trusted. A path's rate is
shrunk to its host's, a host's to the global one: sparse sites end near the prior of the level above. A
document's posterior log odds are its evidence plus its path's prior log odds, with the document itself
left out of both rates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import HEAVY_SHARE, lookup, written
from folioframe.llm.words import STEP_BYTES, Words, released

#: Labelled documents that the model is fitted on, at most (those with the smallest hash of their id).
FIT_ROWS = 20_000
#: Documents below this posterior go: clear cases only, as a good document lost costs more than a poor one kept.
LEAST = 0.25
#: Site tables up to so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SITES = 100_000

_CLASSES = {
    "symbol": b"#$%&*|^~<>=@_{}[]\\/+",
    "bang": b"!?",
    "upper": bytes(range(0x41, 0x5B)),
    "lower": bytes(range(0x61, 0x7B)),
    "digit": b"0123456789",
    "stop": b".,;:",
    "line": b"\n",
}
FEATURES = ["bias", "words", "length", "symbol", "bang", "upper", "digit", "stop", "line", "high", "repeat"]


def surface(texts) -> np.ndarray:
    """A row of features for each text; an empty or null one has the bias alone."""
    w = Words(texts)
    n_bytes = np.diff(w.offsets).astype(float)
    out = np.zeros((w.n_docs, len(FEATURES)))
    out[:, 0] = 1
    full = np.flatnonzero(w.counts > 0)
    if not len(full):
        return out

    def per_byte(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[w.offsets[1:]] - total[w.offsets[:-1]])[full].astype(float)

    table = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
    counts = {k: per_byte(t[w.data]) for k, t in table.items()}
    n, words = n_bytes[full], w.counts[full].astype(float)
    letters = counts["upper"] + counts["lower"]
    same = np.zeros(len(w), dtype=bool)
    order = np.lexsort((w.hash, np.searchsorted(w.first, np.arange(len(w)), side="right")))
    doc = np.searchsorted(w.first, order, side="right")
    same[1:] = (w.hash[order][1:] == w.hash[order][:-1]) & (doc[1:] == doc[:-1])
    repeats = np.bincount(doc[same] - 1, minlength=w.n_docs)[full]
    out[full, 1] = np.log1p(words) / 5
    out[full, 2] = n / words / 10
    out[full, 3] = 10 * counts["symbol"] / n
    out[full, 4] = 10 * counts["bang"] / n
    out[full, 5] = counts["upper"] / np.maximum(1, letters)
    out[full, 6] = 10 * counts["digit"] / n
    out[full, 7] = 10 * counts["stop"] / n
    out[full, 8] = 10 * counts["line"] / n
    out[full, 9] = per_byte(w.data >= 0x80) / n
    out[full, 10] = repeats / words
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    #: log odds of a good document in the fitted sample
    base: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good to bad."""
        return np.clip(x @ self.weights, -30, 30) - self.base


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> QualityModel:
    """Ridge logistic regression by Newton steps; without both labels, a model without evidence."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    w = np.zeros(x.shape[1])
    w[0] = base
    if len(set(y.tolist())) < 2:
        return QualityModel(w, base)
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        size = np.abs(step).max()
        w = w + step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-6:
            break
    return QualityModel(w, base)


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> QualityModel:
    """The model, fitted on at most ``fit_rows`` labelled documents; the sample is broadcast, texts stay where they are read."""
    sample = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.select("y", "text", F.xxhash64("id", "text").alias("h"))

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = surface(pa.chunked_array([part.column(1)]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x.tolist(), pa.list_(pa.float64())), part.column(2)], ["y", "x", "h"])

    # in one order, so that repeated ids and the order of tasks make no other model
    found = rows.mapInArrow(released(work), "y double, x array<double>, h long").orderBy("h").limit(2 * fit_rows).collect()
    x = np.array([r["x"] for r in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in found]))


def _sites(source: Column, section: Column) -> tuple[Column, Column]:
    """Host and path of a source: its authority, and that with its first path segment (or else the section)."""
    s = F.coalesce(source, F.lit(""))
    host = F.lower(F.regexp_extract(s, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?([^/?#]*)", 1))
    segment = F.regexp_extract(s, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?[^/?#]*/([^/?#]+)", 1)
    return host, F.concat_ws("/", host, F.when(segment != "", segment).otherwise(F.coalesce(section, F.lit(""))))


def _evidence(model: QualityModel, text_at: int, names: list[str]):
    def work(batches):
        for batch in batches:
            rows = batch.num_rows
            step = max(1, min(rows, rows * STEP_BYTES // max(1, batch.column(text_at).nbytes)))
            for at in range(0, rows, step):
                part = batch.slice(at, step)
                llr = model.evidence(surface(pa.chunked_array([part.column(text_at)])))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(llr)], [*names, "_llr"])

    return work


def _with_evidence(df: DataFrame, model: QualityModel, text: str) -> DataFrame:
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema) + ", _llr double"
    return df.mapInArrow(released(_evidence(model, df.columns.index(text), df.columns)), schema)


def _concentration(sites: DataFrame, mean: Column, total_rate: float | None) -> float:
    """Prior strength by moments: how many documents the level above counts for."""
    own = sites.filter("n > 1").select(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("s") / F.col("n") - mean) ** 2).alias("between"),
        F.sum((F.col("q") - F.col("s") ** 2 / F.col("n")) / (F.col("n") - 1)).alias("noise"),
        F.count("*").alias("k"),
        F.avg(mean).alias("mean"),
    ).first()
    if not own["n"] or own["k"] < 2:
        return 10.0
    spread = max(0.0, (own["between"] - own["noise"]) / own["n"])
    rate = min(0.999, max(0.001, own["mean"]))
    return float(min(1e6, max(2.0, rate * (1 - rate) / max(spread, 1e-9) - 1)))


@dataclass
class Sites:
    """Rates of all paths: path, host sums and path sums; the global rate and the prior strengths."""

    table: DataFrame
    rate: float
    host_strength: float
    path_strength: float
    rows: int


def site_rates(evidence: DataFrame, base: float) -> Sites:
    """evidence: (host, path, _llr) of all documents."""
    p = 1 / (1 + F.exp(-(F.col("_llr") + F.lit(base))))
    paths = written(evidence.withColumn("p", p).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")))
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = min(0.999, max(0.001, (total["s"] or 0.0) / total["n"])) if total["n"] else 0.5
    host_strength = _concentration(hosts, F.lit(rate), rate)
    joined = lookup(paths, hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs")), "host")
    path_strength = _concentration(joined, F.col("hs") / F.col("hn"), None)
    table = written(joined.select("path", "n", "s", "hn", "hs"))
    return Sites(table, rate, host_strength, path_strength, table.count())


def _posterior(df: DataFrame, sites: Sites, base: float) -> DataFrame:
    """Adds host_rate, path_rate (both without the document) and score."""
    p = 1 / (1 + F.exp(-(F.col("_llr") + F.lit(base))))
    host = (F.col("hs") - p + sites.host_strength * sites.rate) / (F.col("hn") - 1 + sites.host_strength)
    df = df.withColumn("host_rate", F.least(F.lit(0.9999), F.greatest(F.lit(0.0001), host)))
    path = (F.col("s") - p + sites.path_strength * F.col("host_rate")) / (F.col("n") - 1 + sites.path_strength)
    df = df.withColumn("path_rate", F.least(F.lit(0.9999), F.greatest(F.lit(0.0001), path)))
    odds = F.col("_llr") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    return df.withColumn("score", 1 / (1 + F.exp(-odds)))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", section_col: str = "lang", least: float = LEAST) -> DataFrame:
    """``id_col``, host_rate, path_rate, score (posterior that the document is good) and kept (score >= ``least``).

    * null or empty text: no evidence but its emptiness, as the model weighs it;
    * null sources and sections are the site ''; null ids are kept; rows with equal ids are scored each;
    * without labels, or with labels of one value, documents are scored by their sites alone;
    * very long texts count whole; other columns are ignored; an empty table gives an empty table.
    """
    model = fit_on_labels(docs, labels, id_col, text_col)
    host, path = _sites(F.col(source_col), F.col(section_col))
    rows = docs.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(text_col).alias("text"))
    evidence = written(_with_evidence(rows, model, "text").drop("text"))
    sites = site_rates(evidence, model.base)
    out = _posterior(lookup(evidence, sites.table, "path"), sites, model.base)
    return out.select(F.col("id").alias(id_col), "host_rate", "path_rate", "score", (F.col("score") >= least).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", section_col: str = "lang", least: float = LEAST) -> DataFrame:
    """The documents, with all their columns, whose score reaches ``least``. Texts are read again rather than shuffled.

    Nulls, empty and long texts, repeated rows, missing labels and empty tables are as in score_quality(); columns may have any name.
    """
    model = fit_on_labels(docs, labels, id_col, text_col)
    host, path = _sites(F.col(source_col), F.col(section_col))
    narrow = docs.select(host.alias("host"), path.alias("path"), F.col(text_col).alias("text"))
    sites = site_rates(_with_evidence(narrow, model, "text").drop("text"), model.base)
    wide = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], path.alias("path"))
    wide = _with_evidence(wide, model, f"c{docs.columns.index(text_col)}")
    if sites.rows <= BROADCAST_SITES:
        joined = wide.join(F.broadcast(sites.table), "path")
    else:  # the sites tell which of them are heavy: texts are not scored to find out
        total = sites.table.agg(F.sum("n")).first()[0]
        heavy = [r["path"] for r in sites.table.filter(F.col("n") > max(1000, int(total * HEAVY_SHARE))).select("path").collect()]
        joined = lookup(wide, sites.table, "path", heavy=heavy)
    kept = _posterior(joined, sites, model.base).filter(F.col("score") >= least)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
