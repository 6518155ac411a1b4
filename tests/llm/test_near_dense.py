"""Dense families, ids with several texts, long components: what the forest and its blocks must not lose."""

import random

import numpy as np
import pytest

from folioframe.llm import graphs, near_dedup
from folioframe.llm.graphs import components
from folioframe.llm.near_dedup import DEPTH, candidate_pairs, linked, near_duplicates, trees_for
from helpers import table
from test_near_dedup import got, shingles


def templated(n, seed=7, slots=10):
    """Short texts from one template: most pairs are far below 0.85, many single edits are above it."""
    rng = random.Random(seed)
    fixed = [f"t{k}" for k in range(60)]
    rows = []
    while len(rows) < n:
        words = list(fixed)
        for s in range(slots):
            words[6 * s] = f"v{s}x{rng.randrange(50)}"
        rows.append(words)
        if rng.random() < 0.3 and len(rows) < n:
            near = list(words)
            near[rng.choice((0, 1, 2, 57, 58, 59))] = f"e{len(rows)}"
            rows.append(near)
    rng.shuffle(rows)
    return [(i, " ".join(w), None, None, 0) for i, w in enumerate(rows)]


def by_matrix(rows, threshold=85):
    """Brute force over all pairs, as a product of 0/1 matrices."""
    sets = [shingles(r[1]) for r in rows]
    column = {}
    for s in sets:
        for g in s:
            column.setdefault(g, len(column))
    m = np.zeros((len(sets), len(column)), dtype=np.float32)
    for i, s in enumerate(sets):
        m[i, [column[g] for g in s]] = 1
    n = m.sum(axis=1)
    low = graphs.Sets(len(sets))
    links = 0
    for at in range(0, len(sets), 500):
        both = m[at : at + 500] @ m.T
        a, b = np.nonzero(100 * both >= threshold * (n[at : at + 500, None] + n[None, :] - both))
        links += int((a + at < b).sum())
        low.join(a + at, b)
    return [(r[0], len(s), int(c)) for r, s, c in zip(rows, sets, low.flatten(), strict=True)], links


@pytest.mark.parametrize("n", [500, 4_000])
def test_dense_families_same_as_brute_force(spark, n):
    rows = templated(n)
    wanted, links = by_matrix(rows)
    assert links > n // 10 and got(near_duplicates(table(spark, rows))) == sorted(wanted, key=repr)


def test_candidates_of_a_dense_run():
    """Signatures of a boilerplate crowd with planted pairs at 0.86, in one run far over FULL_RUN."""
    rng = np.random.default_rng(11)
    width, n, pairs = trees_for(85) * DEPTH, 60_000, 300
    crowd = rng.integers(0, 256, width, dtype=np.uint8)
    sig = np.where(rng.random((n, width)) < 0.45, crowd, rng.integers(0, 256, (n, width), dtype=np.uint8)).astype(np.uint8)
    twin = np.arange(pairs)
    sig[n - pairs + twin] = np.where(rng.random((pairs, width)) < 0.86, sig[twin], rng.integers(0, 256, (pairs, width), dtype=np.uint8))
    least, found = 42, np.zeros(pairs, dtype=bool)
    alike = (sig[twin] == sig[n - pairs + twin]).sum(axis=1) >= least
    for t in range(trees_for(85)):
        path = np.concatenate([np.full((n, 1), t, np.uint8), np.roll(sig, -t * DEPTH, axis=1)], axis=1)
        order = np.lexsort(path.T[::-1])
        a, b, _ = candidate_pairs(path[order], least, 256)
        a, b = order[a], order[b]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        hit = lo[(hi - lo == n - pairs) & (lo < pairs)]
        found[hit] = True
    assert alike.sum() >= pairs - 2 and found[alike].all()


def test_one_id_with_several_texts(spark):
    rng = random.Random(2)
    a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "ab")
    edited = {x: " ".join([*w[:-1], "edited"]) for x, w in (("a", a), ("b", b))}
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, edited["a"]), (3, edited["b"]), (3, edited["b"]), (0, ""), (1, None)]
    out = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, 0, 0, True), (1, 0, 1, True), (1, 56, 1, True), (1, 56, 1, True), (2, 56, 1, False), (3, 56, 1, False), (3, 56, 1, False)]


def test_links_between_two_sides():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, 25)).astype(np.uint64) for _ in range(40)]
    a, b = linked(sets[:15], sets[15:], 60)
    wanted = {(i, j) for i in range(15) for j in range(25) if 100 * len(np.intersect1d(sets[i], sets[15 + j])) >= 60 * len(np.union1d(sets[i], sets[15 + j]))}
    assert wanted and set(zip(a.tolist(), b.tolist(), strict=True)) == wanted


@pytest.mark.parametrize("local", [0, 1_000_000])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graphs, "LOCAL_EDGES", local)
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(1_000, 1_060)]
    star = [(2_000, 2_000 + k) for k in range(200)]
    some = [(rng.randrange(3_000, 3_300), rng.randrange(3_000, 3_300)) for _ in range(250)]
    low = {x: x for e in chain + star + some for x in e}
    for u, v in chain + star + some:
        x, y = sorted((low[u], low[v]))
        low = {k: x if c == y else c for k, c in low.items()}
    linked_nodes = {x for u, v in chain + star + some if u != v for x in (u, v)}
    got_rows = components(spark.createDataFrame(chain + star + some, "u long, v long")).collect()
    assert sorted(map(tuple, got_rows)) == sorted((k, c) for k, c in low.items() if k in linked_nodes)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
