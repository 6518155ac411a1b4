import difflib
import random
import time

from pyspark.sql import functions as F

from folioframe.functions import text as tx


def test_words_after_the_first_5000_count(spark):
    rng = random.Random(7)
    words = [f"w{int(rng.random() ** 2 * 3000)}" for _ in range(12_000)]
    original, lost, garbled = " ".join(words), " ".join(words[:5_500]), " ".join(words[:5_500] + [w[::-1] + "?" for w in words[5_500:]])
    edited = " ".join(w + "x" if i % 1_000 == 999 else w for i, w in enumerate(words))
    df = spark.createDataFrame([(1, original, original), (2, original, lost), (3, original, garbled), (4, original, edited)], "k int, o string, f string")
    began = time.time()
    rows = {r.k: r for r in df.select("k", "o", "f", tx.similarity("o", "f").alias("r"), tx.best_choice(tx.similarity("o", "f"), F.col("o"), F.col("f")).alias("c")).collect()}
    took = time.time() - began
    for r in rows.values():
        assert r.r == difflib.SequenceMatcher(None, r.o.split(), r.f.split(), autojunk=False).ratio()
    assert rows[1].r == 1 and rows[2].c == rows[3].c == original and rows[4].c == edited and took < 120
