import random
import zlib

import numpy as np
import pyarrow as pa

from folioframe.llm import quality, toxicity
from folioframe.llm.quality import keep_good, score_quality
from folioframe.llm.toxicity import score_toxicity
from helpers import difficult, prose, table, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def documents(n=240, seed=2):
    """Good prose and symbol junk over a large host and sparse ones."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, 80) + "." if good else " ".join(f"{w}{rng.choice(['###', '%%%', '&&&'])}" for w in prose(rng, 80).split())
        rows.append((i, text, "en", "https://big.example/a/b" if i % 3 else f"https://h{i}.example/x", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, labels


def test_junk_goes_and_clean_documents_stay(spark):
    rows, labels = documents()
    got = {r.doc_id: r.kept for r in score_quality(with_clashes(table(spark, rows)), spark.createDataFrame(labels, LABELS)).collect()}
    assert got == {r[0]: "###" not in r[1] and "%%%" not in r[1] and "&&&" not in r[1] for r in rows}


def test_sparse_sites_end_near_the_prior(spark):
    rows, labels = documents()
    got = score_quality(table(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    sparse = [r.path_rate for r in got if r.doc_id % 3 == 0]
    assert max(sparse) - min(sparse) < 0.05


def test_rates_same_as_by_hand(spark):
    """Without the document itself, shrunk to the level above."""
    llr = {0: [4.0, 4.0, -4.0], 1: [4.0]}
    rows = [(f"h{h}", f"h{h}/p{h}", x) for h, xs in llr.items() for x in xs]
    df = spark.createDataFrame(rows, "host string, path string, _llr double")
    sites = quality.site_rates(df, 0.5)
    p = lambda x: 1 / (1 + np.exp(-(x + 0.5)))
    rate = np.mean([p(x) for xs in llr.values() for x in xs])
    assert abs(sites.rate - rate) < 1e-9
    got = quality._posterior(df.join(sites.table, "path"), sites, 0.5).filter("host = 'h1'").first()
    assert abs(got.host_rate - rate) < 1e-9 and abs(got.path_rate - rate) < 1e-9


def test_difficult_tables(spark):
    docs = with_clashes(table(spark, difficult() + difficult()[3:5] + [(None, "x", None, None, 1)]))
    for labels in ([], [(3, 1, 1)], [(0, 1, 0), (3, 0, 1), (9, None, None), (None, 1, 1), (3, 0, 1)]):
        label_table = spark.createDataFrame(labels, LABELS)
        scores = score_quality(docs, label_table).collect()
        assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
        kept = keep_good(docs, label_table)
        assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in scores)
        scores = score_toxicity(docs, label_table).collect()
        assert len(scores) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scores)
    empty = table(spark, [])
    none = spark.createDataFrame([], LABELS)
    assert score_quality(empty, none).count() == keep_good(empty, none).count() == score_toxicity(empty, none).count() == 0


def test_toxic_words_and_their_inflections(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(rng, 60).split(), i % 5 == 0
        if toxic:
            words[rng.randrange(60)] = f"vileword{rng.choice('abcdefghij')}{rng.choice('xyz')}"
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    got = score_toxicity(table(spark, rows), spark.createDataFrame(labels, LABELS), eligible="crc32(cast(id AS string)) % 5 <> 0").collect()
    wrong = [r.doc_id for r in got if held(r.doc_id) and r.predicted != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 2


def test_held_out_accuracy(spark, sf):
    path = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    got = score_toxicity(docs, labels, eligible="crc32(cast(id AS string)) % 5 <> 0").join(labels, "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits / sum(r.toxic for r in held) > 0.8 and hits / max(1, sum(r.predicted for r in held)) > 0.9


def test_other_columns_are_no_input(spark):
    rows = difficult()
    labels = spark.createDataFrame([(3 * i, 1, i % 2) for i in range(40)], LABELS)
    one = {r.doc_id: r.score for r in score_toxicity(table(spark, rows), labels).collect()}
    two = {r.doc_id: r.score for r in score_toxicity(table(spark, [(i, t, "zz", "other", 0) for i, t, *_ in rows]), labels).collect()}
    assert one == two


def test_thresholds_are_calibrated_by_language():
    model = toxicity.ToxicityModel(np.zeros((1, 1)), [], np.zeros(0), 0.0)
    z = np.concatenate([np.linspace(-1, 1, 200), np.linspace(1, 3, 200)])
    y = (z > np.where(np.arange(400) < 200, 0, 2)).astype(float)
    toxicity.calibrate(model, z, y, np.repeat([0, 1], 200))
    assert model.thresholds[0] < model.thresholds[1]


def test_phrases_are_learned_that_no_word_tells():
    """Both words are as frequent in clean documents, but there never in a row: a lexicon can't tell, the trained filters do."""
    rng = random.Random(3)

    def make(n):
        texts, y = [], []
        for i in range(n):
            words, toxic = [f"w{rng.randrange(300)}" for _ in range(40)], i % 3 == 0
            a, b = rng.sample(range(0, 38, 2), 2)
            words[a], words[a + 1 if toxic else b] = "bad", "thing"
            texts.append(" ".join(words))
            y.append(float(toxic))
        return toxicity.tokens(pa.chunked_array([pa.array(texts, pa.large_string())])), np.array(y)

    (ids, first, _), y = make(2000)
    (held, held_first, _), wanted = make(600)
    order = lambda model: np.argsort(np.argsort(model.logits(held, held_first)))
    auc = lambda rank: (rank[wanted == 1].mean() - (wanted.sum() - 1) / 2) / (wanted == 0).sum()
    assert auc(order(toxicity.train(ids, first, y))) > 0.95
    assert abs(auc(order(toxicity.train(ids, first, y, epochs=0))) - 0.5) < 0.1


def test_without_both_labels_all_scores_are_the_base_rate(spark):
    docs = table(spark, difficult())
    for labels, low, high in (([], 0.4, 0.6), ([(3 * i, 1, 1) for i in range(20)], 0.9, 1), ([(3 * i, 1, 0) for i in range(20)], 0, 0.1)):
        scores = {round(r.score, 9) for r in score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
        assert len(scores) == 1 and low <= scores.pop() <= high
