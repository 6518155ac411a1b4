import random

import numpy as np
import pyarrow as pa

from folioframe.llm import near_dedup
from folioframe.llm.near_dedup import near_duplicates, shingle_sets
from helpers import difficult, prose, table, with_clashes, words


def shingles(text):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows, threshold=85):
    sets = [(r[0], shingles(r[1])) for r in rows]
    up = {i: i for i, _ in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and None not in (i, j) and i != j:
                both = len(s & t)
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    x, y = find(i), find(j)
                    up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_same_as_brute_force(spark):
    rows = difficult() + [(None, "a b c", None, None, 5)]
    assert got(near_duplicates(with_clashes(table(spark, rows)))) == brute(rows)


def test_repeated_rows_and_case(spark):
    rows = [(5, "A b C d E f", None, None, 0), (5, "A b C d E f", None, None, 0), (2, "a B c D e F", None, None, 0), (9, "short one", None, None, 0), (8, "SHORT ONE", None, None, 0)]
    assert got(near_duplicates(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).count() == 0


def star(n=90):
    """An original and edited copies that are close to it but not to each other, two such families, and loners."""
    rng = random.Random(5)
    rows = []
    for f in range(2):
        base = prose(rng, 400, 100_000).split()
        rows.append((1000 * f + 500, " ".join(base), None, None, 0))
        for k in range(n):
            w = list(base)
            for p in rng.sample(range(0, 400, 8), 5):
                w[p] = f"edit{f}x{k}x{p}"
            rows.append((1000 * f + k, " ".join(w), None, None, 0))
    return rows + [(5000 + k, prose(rng, 300, 100_000), None, None, 0) for k in range(10)]


def test_dense_runs_and_large_families(spark, monkeypatch):
    """Families beyond a block: hubs find the original, and what they leave is compared block by block."""
    rows = star()
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 4_000)
    monkeypatch.setattr(near_dedup, "FULL_RUN", 8)
    assert got(near_duplicates(table(spark, rows))) == brute(rows)
    monkeypatch.setattr(near_dedup, "FAMILY_HUBS", 1)
    no_center = [r for r in rows if r[0] % 1000 != 500]
    assert got(near_duplicates(table(spark, no_center))) == brute(no_center)


def test_sets_are_exact():
    texts = [r[1] for r in difficult()]
    grams, first = shingle_sets(pa.chunked_array([pa.array(texts, pa.large_string())]))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
