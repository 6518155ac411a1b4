import random

from folioframe.llm.near_dedup import DEPTH, MISS, trees_for
from helpers import difficult, prose, table
from test_near_dedup import shingles


def test_near_copies_from_80_on_go(spark, sf):
    """Pairs from 0.70 to 0.95, so also between 0.80 and 0.85: what stays is that of brute force at 80."""
    import corpus_pipeline as p

    rng, rows = random.Random(80), difficult()
    for k in range(40):
        words = prose(rng, 204, 100_000).split()
        rows.append((10_000 + 2 * k, " ".join(words), None, None, 0))
        for at in rng.sample(range(4, 200, 6), 1 + k % 8):
            words[at] = f"edit{k}x{at}"
        rows.append((10_001 + 2 * k, " ".join(words), None, None, 0))
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    low = {i: i for i, _ in sets}
    between = 0
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                between += 100 * both < 85 * (len(s) + len(t) - both)
                x, y = low[i], low[j]
                low = {k: min(x, y) if v in (x, y) else v for k, v in low.items()}
    kept = {r.doc_id for r in p.near_dedup(spark, table(spark, rows), sf).collect()}
    assert between >= 5 and kept == {i for i, v in low.items() if i == v}


def test_forest_misses_as_little_at_80():
    assert trees_for(85) == 16 and all((1 - (t / 100) ** DEPTH) ** trees_for(t) <= MISS for t in (70, 80, 85, 90))
