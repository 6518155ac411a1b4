import hashlib
import random
from collections import Counter

from folioframe.llm.substring_dedup import substring_dedup
from helpers import difficult, table, with_clashes, words


def brute(rows, window):
    texts = [words(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((r[0], len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in rows)
    return sorted(((r[0], r.n_words, r.n_removed, r.kept) for r in rows), key=repr)


def test_same_as_brute_force(spark):
    rows = difficult() + difficult()[40:44] + [(None, "a b c", None, None, 5)]
    df = with_clashes(table(spark, rows))
    for block in (2 << 20, 2_000):  # one block, and many
        assert got(substring_dedup(df, block_bytes=block)) == brute(rows, 35)


def test_other_windows(spark):
    rows = difficult(2)
    for window in (1, 2, 5):
        assert got(substring_dedup(table(spark, rows), window=window, block_bytes=3_000)) == brute(rows, window)


def test_empty_table(spark):
    assert substring_dedup(table(spark, [])).count() == 0


def test_query(spark, sf):
    from folioframe.llm.queries import op1_substring_dedup

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    wanted = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(docs, 35)]
    assert sorted(map(tuple, op1_substring_dedup(spark, sf).collect())) == sorted(wanted)


def resolved(out):
    """Every factor with the words of its source, looked up by block and place."""
    blocks = {}
    for r in out:
        blocks.setdefault(r.block, {}).update({r.place + i: w for i, w in enumerate(words(r.text))})
    for r in out:
        own = words(r.text)
        for f in r.factors:
            source = [blocks[f.source_block].get(f.source_place + i) for i in range(f.length)]
            yield r, f, own[f.start : f.start + f.length], source, blocks[f.source_block].get(f.source_place + f.length)


def test_factors_have_sources(spark):
    """Each factor's words stand at its source; factors cover just the spans; none is shorter than the window."""
    for block in (2 << 20, 2_000):
        for window in (5, 35):
            df = table(spark, difficult(5)).filter("text IS NOT NULL")
            out = substring_dedup(df, window=window, block_bytes=block).join(df.select("doc_id", "text"), "doc_id").collect()
            n = 0
            for r, f, own, source, _ in resolved(out):
                assert own == source and f.length >= window and (r.block, r.place + f.start) != (f.source_block, f.source_place)
                n += 1
            assert n > 20
            for r in out:
                covered = {i for f in r.factors for i in range(f.start, f.start + f.length)}
                assert covered == {i for s in r.spans for i in range(s.start, s.start + s.length)}


def test_factors_are_longest_along_their_source(spark):
    """With one other place for each passage a factor ends only where its source does."""
    rng = random.Random(3)
    passages = [" ".join(f"p{k}x{rng.randrange(10**6)}" for _ in range(60)) for k in range(5)]
    rows = [(i, f"{' '.join(f'l{i}x{j}' for j in range(20))} {p} {' '.join(f'r{i}x{j}' for j in range(20))}") for i, p in enumerate(passages)]
    rows.append((100, " ".join(passages)))  # seams: no literal between two factors
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring_dedup(df, block_bytes=900).join(df, "doc_id").collect()
    by_id = {r.doc_id: r for r in out}
    assert [(f.start, f.length) for f in by_id[100].factors] == [(60 * k, 60) for k in range(5)]
    assert all([(f.start, f.length) for f in by_id[i].factors] == [(20, 60)] for i in range(5))
    assert all(own == source for _, _, own, source, _ in resolved(out))


def test_a_row_repeated_very_often(spark):
    rows = [(7, " ".join(f"w{i}" for i in range(50))), (8, "short text"), (None, " ".join(f"n{i}" for i in range(40)))]
    often = spark.range(20_000).selectExpr("7L AS doc_id", f"'{rows[0][1]}' AS text")
    df = spark.createDataFrame(rows[1:] * 2, "doc_id long, text string").unionByName(often)
    out = substring_dedup(df).groupBy("doc_id", "n_words", "n_removed", "kept").count().collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(7, 50, 50, "", 20_000), (8, 2, 0, "short text", 2), (None, 40, 40, "", 2)], key=repr)
