import math

import numpy as np

from folioframe.llm.topk_search import search_block, top_k
from helpers import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i: v for i, v in reversed(ok) if i % 20 == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(q[1], v, strict=True)), i) for i, v in ok if i != q[0] and len(v) == len(q[1]))[:k]
        out += [(q[0], r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def rows(n=300, d=24):
    rng = np.random.default_rng(3)
    out = [(i, [float(x) for x in rng.normal(size=d) * 0.3], 0) for i in range(n)]
    out[41:60] = [(i, out[40][1], 0) for i in range(41, 60)]  # ties
    out += [(900, None, 0), (901, [float("nan")] * d, 0), (902, [float("inf")] * d, 0), (903, [None] * d, 0), (905, [1.0] * 3, 0), (920, [0.5] * 3, 0), (None, [0.1] * d, 0)]
    return out


def test_same_as_brute_force(spark):
    data = rows()
    got = top_k(with_clashes(spark.createDataFrame(data, SCHEMA)))
    assert sorted(map(tuple, got.collect())) == brute(data)


def test_few_candidates_and_empty(spark):
    data = [(0, [1.0, 2.0], 0), (1, [1.0, 1.0], 0)]
    assert sorted(map(tuple, top_k(spark.createDataFrame(data, SCHEMA)).collect())) == brute(data)
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_prune_without_loss():
    rng = np.random.default_rng(8)
    q = rng.integers(-60, 60, (64, 5)).astype(float)
    c = rng.integers(-60, 60, (64, 500)).astype(float)
    c[:, :50] = q[:, [0]]
    found = search_block(np.arange(5), q, np.arange(100, 600), c, 7, np.full(5, -np.inf))
    for i, (ids, score) in enumerate(found):
        exact = q[:, i] @ c
        order = np.lexsort((np.arange(500), -exact))[:7]
        assert ids.tolist() == (order + 100).tolist() and score.tolist() == exact[order].tolist()


def test_large_components_have_whole_scores(spark):
    """Beyond doubles: products up to the largest long are exact, larger ones are cut off there."""
    rng = np.random.default_rng(4)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * 10.0 ** rng.integers(0, 6)], 0) for i in range(80)]
    data += [(200, [float(2**30), 1.0] + [0.0] * 4, 0), (201, [float(2**30), -3.0] + [0.0] * 4, 0), (203, [1e15] * 6, 0), (240, [-1e15] * 6, 0), (205, [3e38] * 6, 0)]
    top = (1 << 63) - 1
    data += [(207, [float(2**57), 1.0, 0.0, 0.0, 0.0, 0.0], 0)]  # takes part, however large
    wanted = []
    for q, v, _ in data:
        if q % 20 == 0:
            a = [math.floor(64 * x) for x in v]
            scores = [(-max(-top, min(top, sum(x * math.floor(64 * y) for x, y in zip(a, w, strict=True)))), i) for i, w, _ in data if i != q]
            wanted += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:20], 1)]
    got = top_k(spark.createDataFrame([(i, v, n) for i, v, n in data], "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, got.collect())) == sorted(wanted)


def test_many_blocks_and_stripes(spark, monkeypatch):
    import folioframe.llm.topk_search as t

    monkeypatch.setattr(t, "CANDIDATES", 16)
    monkeypatch.setattr(t, "QUERIES", 4)
    monkeypatch.setattr(t, "STRIPE_BYTES", 500)
    data = rows()
    assert sorted(map(tuple, top_k(spark.createDataFrame(data, SCHEMA)).collect())) == brute(data)


def test_traffic_is_by_bytes_not_by_queries():
    """A thousand million vectors of 64 small components: some hundred blocks of queries, some thousand stripes."""
    from folioframe.llm.topk_search import grid

    n, size = 10**9, 64
    q_blocks, stripes, n_blocks = grid(n, n * size, n // 20, 100)
    assert q_blocks <= 800 and stripes <= 2_000 and n_blocks > stripes
    assert grid(2_000, 2_000 * 64, 100, 100)[0] == 1 and grid(0, 0, 0, 0) == (1, 1, 1)
    assert grid(10**7, 10**7 * 64, 500_000, 1 << 40)[1] == 153  # eight bytes a component
