"""op3, op8 and op9 over whole tables against plain versions that share none of their code, but for the fitted weights."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from folioframe.llm import quality, toxicity
from folioframe.llm.decontaminate import SEED
from folioframe.llm.queries import op3_quality, op8_toxicity, op9_decontamination

ASCII = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def documents(spark, sf):
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def features(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return [1] + [0] * 10
    many = lambda chars: sum(raw.count(bytes([c])) for c in chars)
    n, upper, lower = len(raw), many(range(65, 91)), many(range(97, 123))
    return [
        1, math.log1p(len(words)) / 5, n / len(words) / 10, 10 * many(b"#$%&*|^~<>=@_{}[]\\/+") / n, 10 * many(b"!?") / n, upper / max(1, upper + lower), 10 * many(b"0123456789") / n,
        10 * many(b".,;:") / n, 10 * many(b"\n") / n, sum(c >= 0x80 for c in raw) / n, (len(words) - len(set(words))) / len(words),
    ]


def concentration(groups, means, rate_of):
    """Moments over the groups (lists of probabilities) with more than one member."""
    own = [(g, m) for g, m in zip(groups, means, strict=True) if len(g) > 1]
    if len(own) < 2:
        return 10.0
    n = sum(len(g) for g, _ in own)
    between = sum(len(g) * (np.mean(g) - m) ** 2 for g, m in own)
    noise = sum(np.var(g, ddof=1) for g, _ in own)
    spread = max(0.0, (between - noise) / n)
    rate = min(0.999, max(0.001, rate_of(own)))
    return min(1e6, max(2.0, rate * (1 - rate) / max(spread, 1e-9) - 1))


def test_quality_of_every_document(spark, sf):
    docs = documents(spark, sf)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    x = {i: np.array(features(t), dtype=float) for i, t, _, _ in docs}
    fitted = [i for i in x if i in labels]
    model = quality.fit(np.array([x[i] for i in fitted]), np.array([float(labels[i]) for i in fitted]))
    llr = {i: float(np.clip(x[i] @ model.weights, -30, 30)) - model.base for i in x}
    p = {i: 1 / (1 + math.exp(-(llr[i] + model.base))) for i in x}
    hosts, paths, site = {}, {}, {}
    for i, _, lang, source in docs:
        rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*://", "", source or "")
        host = re.match(r"[^/?#]*", rest)[0].lower()
        segment = re.match(r"[^/?#]*/([^/?#]+)", rest)
        site[i] = host, f"{host}/{segment[1] if segment else lang or ''}"
        hosts.setdefault(host, []).append(p[i])
        paths.setdefault(site[i], []).append(p[i])
    rate = min(0.999, max(0.001, np.mean(list(p.values()))))
    strong_host = concentration(list(hosts.values()), [rate] * len(hosts), lambda own: rate)
    strong_path = concentration(list(paths.values()), [np.mean(hosts[h]) for h, _ in paths], lambda own: np.mean([m for _, m in own]))
    clip = lambda v: min(0.9999, max(0.0001, v))
    got = {r.doc_id: r for r in op3_quality(spark, sf).collect()}
    assert len(got) == len(docs)
    for i in x:
        host, path = hosts[site[i][0]], paths[site[i]]
        host_rate = clip((sum(host) - p[i] + strong_host * rate) / (len(host) - 1 + strong_host))
        path_rate = clip((sum(path) - p[i] + strong_path * host_rate) / (len(path) - 1 + strong_path))
        score = 1 / (1 + math.exp(-(llr[i] + math.log(path_rate / (1 - path_rate)))))
        assert (got[i].host_rate, got[i].path_rate, got[i].score) == pytest.approx((host_rate, path_rate, score), abs=1e-6), i
        assert got[i].kept == (got[i].score >= quality.LEAST)


def test_toxicity_score_of_every_document(spark, sf):
    """The trained network applied document by document, filter by filter."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_on_labels(docs, labels, eligible="crc32(cast(id AS string)) % 5 <> 0")
    got = {r.doc_id: r for r in op8_toxicity(spark, sf).collect()}
    for i, text, *_ in documents(spark, sf):
        ids, first, language = toxicity.tokens(pa.chunked_array([pa.array([text], pa.large_string())]))
        assert len(ids) == first[1] == len(ASCII.findall((text or "").encode()))
        e = [sum(model.embedding[b].astype(float) for b in word) for word in ids]
        z = model.bias
        for j, kernel in enumerate(model.kernels):
            for f in range(toxicity.FILTERS):
                values = [sum(float(e[at + t] @ kernel[t][:, f]) for t in range(len(kernel))) for at in range(max(0, min(len(e), 400) - len(kernel) + 1))]
                if len(e) > 400:
                    values += list(sum(np.array(e[399 - len(kernel) + 1 + t : len(e) - len(kernel) + 1 + t]) @ kernel[t][:, f] for t in range(len(kernel))))
                z += float(model.out[j * toxicity.FILTERS + f]) * max([0.0, *values])
        score = 1 / (1 + math.exp(-max(-30, min(30, model.slope * (z - model.thresholds[language[0]])))))
        assert got[i].score == pytest.approx(score, abs=1e-4) and got[i].predicted == (got[i].score >= 0.5), i
    assert len(got) == docs.count()


def best_alignment(item, text):
    """Smith-Waterman of an item and a whole text, row by row."""
    h, best = np.zeros(len(text) + 1, dtype=np.int64), 0
    step = np.arange(len(text) + 1)
    for word in item:
        x = np.zeros(len(text) + 1, dtype=np.int64)
        x[1:] = np.maximum(0, np.maximum(h[:-1] + np.where(text == word, 1, -1), h[1:] - 1))
        h = np.maximum.accumulate(x + step) - step
        best = max(best, int(h.max()))
    return best


def test_leaks_same_as_all_alignments(spark, sf):
    """Every document against every item: all found pairs have the best score, and a pair that is missed shares no seed."""
    number = {}
    code = lambda text: [number.setdefault(w.lower(), len(number)) for w in ASCII.findall((text or "").encode())]
    docs = {i: code(t) for i, t, *_ in documents(spark, sf)}
    items = {r.item_id: code(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in op9_decontamination(spark, sf).collect()}
    missed = 0
    for i, text in docs.items():
        array, grams = np.array(text), {tuple(text[a : a + SEED]) for a in range(len(text) - SEED + 1)}
        for j, item in items.items():
            score = best_alignment(item, array) if text and item else 0
            if (i, j) in got:
                assert (got[i, j].score, got[i, j].item_words) == (score, len(item))
            elif item and score >= 0.4 * len(item) and score >= min(8, len(item)):
                missed += 1
                shared = sum(tuple(item[a : a + SEED]) in grams for a in range(len(item) - SEED + 1))
                assert shared <= (len(item) - SEED + 1) / 2, (i, j, score)
    assert got and missed <= len(got) / 20
