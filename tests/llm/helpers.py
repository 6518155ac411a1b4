"""Plain versions of what the operators do, and small difficult tables."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.translate(LOWER) if lower else raw)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def difficult(seed=1):
    """Nulls, empty and blank texts, one very long text, exact copies, near copies, shared passages, repeated rows and odd characters."""
    rng = random.Random(seed)
    texts = [None, "", "  \t\n ", "one", "a b c d", "ünïcødé ✓ 日本 words  nbsp", prose(rng, 20_000)]
    texts += [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    base = [prose(rng, 150) for _ in range(4)]
    texts += base + base[:2] * 6
    for b in base:
        for _ in range(5):
            w = b.split()
            w[rng.randrange(len(w))] = "edited"
            texts.append(" ".join(w))
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(8)]
    texts += ["x " * 100, "x " * 101 + "y"]
    rows = [(i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", None]), len(t or "")) for i, t in enumerate(texts)]
    return rows


def table(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(difficult() if rows is None else rows, schema)


def with_clashes(df):
    """Extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    for name in ("id", "block", "key", "n", "family", "size", "score", "row"):
        df = df.withColumn(name, F.lit("clash"))
    return df
