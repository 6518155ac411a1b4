"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors lie in candidate blocks in vertical layout, one row of the block's matrix for
each dimension. A task takes a query block and goes through the candidate blocks:

* the dimensions, in an order of falling mass, are taken block by block: the first block's part of all scores
  is one small matrix product, later blocks add only the columns of surviving candidates;
* after each dimension block, a candidate survives where its partial score plus the most that
  the remaining dimensions can add (the product of the remaining masses, by Cauchy-Schwarz)
  reaches the query's threshold; survivors are compacted;
* the threshold is the k-th best full score so far, or the k-th best lower bound.

Where the masses of query and candidate are below 2**26, scores are sums of integers below 2**53, so they are exact in doubles, and bounds
are widened by one so that rounding of the masses can't lose a candidate. Pairs with a larger vector are scored in full, in
parts of 21 bits that add up to whole numbers of any size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of one block of candidates (as long integers); packed bytes of the stripe of them, and of the block of queries, that a task holds.
BLOCK_BYTES, STRIPE_BYTES, QUERY_BYTES = 4 << 20, 32 << 20, 32 << 20
#: Candidates of a block, and queries of a block, at most; queries and dimensions taken at once.
CANDIDATES, QUERIES, LANES, DIMENSIONS = 4096, 1 << 16, 1024, 16
#: At least so many tasks, if there are as many blocks.
TASKS = 96
#: Vectors of a smaller mass have exact products in doubles.
EXACT_MASS = float(1 << 26)
LONGEST = (1 << 63) - 1


def _packed(matrix: np.ndarray) -> tuple[str, bytes]:
    """The matrix in the smallest type that holds it, and the type's name."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    kind = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return kind, np.ascontiguousarray(matrix, dtype=kind).tobytes()


def _blocks(name: str):
    """Rows (id, vector) of one group -> one row with the packed block."""

    def pack(key, table):
        ids = table.column("id").to_numpy()
        lists = table.column("v").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(lists.offsets.to_numpy())
        order = np.argsort(ids, kind="stable")
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        # vectors of one length go together; another length has no product with these
        out = []
        for size in np.unique(sizes):
            at = order[sizes[order] == size]
            matrix = flat[starts[at][:, None] + np.arange(size)[None, :]].astype(np.int64)
            out.append((key[0].as_py(), int(size), ids[at].tobytes(), *_packed(matrix.T)))
        return pa.table(
            {
                name: pa.array([r[0] for r in out], pa.int64()),
                "size": pa.array([r[1] for r in out], pa.int32()),
                "ids": pa.array([r[2] for r in out], pa.binary()),
                "kind": pa.array([r[3] for r in out], pa.string()),
                "columns": pa.array([r[4] for r in out], pa.binary()),
            }
        )

    return pack


def _masses(columns: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Euclidean mass of each vector from each cut on, rounded up."""
    squares = columns * columns
    return np.sqrt(np.array([squares[c:].sum(axis=0) for c in cuts])) * (1 + 1e-12)


def search_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (columns of q) its k best candidates (columns of c), none below its floor.

    Returns (candidate ids, scores), best first, ties to the smaller id; raises the floors.
    """
    size = len(q)
    if not size:
        return [_best(c_ids[c_ids != i], np.zeros(int((c_ids != i).sum())), k) for i in q_ids]
    order = np.argsort(-(q * q).sum(axis=1), kind="stable")
    q, c = q[order], c[order]
    cuts = [*range(DIMENSIONS, size, DIMENSIONS), size]
    q_mass, c_mass = _masses(q, cuts), _masses(c, cuts)
    first = q[: cuts[0]].T @ c[: cuts[0]]
    found = []
    for i, own in enumerate(q_ids):
        alive = np.flatnonzero(c_ids != own)
        score = first[i, alive]
        at = cuts[0]
        for step, cut in enumerate(cuts):
            if cut > at:
                score = score + q[at:cut, i] @ c[at:cut, alive]
                at = cut
            slack = q_mass[step, i] * c_mass[step, alive] + (cut < size)
            if len(alive) > k:
                lower = score - slack
                floor[i] = max(floor[i], np.partition(lower, len(lower) - k)[len(lower) - k])
            keep = score + slack >= floor[i]
            if not keep.all():
                alive, score = alive[keep], score[keep]
        found.append(_best(c_ids[alive], score, k))
    return found


def whole_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the integer vector q with the columns of c, as whole numbers that are cut off at the largest long."""
    mask = (1 << 21) - 1
    out = np.zeros(c.shape[1], dtype=object)
    for at in range(0, len(q), 512):  # 512 products of 21 bits each are exact in doubles
        parts = [[(x[at : at + 512] >> s) & mask if s < 42 else x[at : at + 512] >> s for s in (0, 21, 42)] for x in (q, c)]
        for i, a in enumerate(parts[0]):
            for j, b in enumerate(parts[1]):
                out += (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64).astype(object) << 21 * (i + j)
    return np.minimum(np.maximum(out, -LONGEST), LONGEST)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if score.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k], dtype=np.int64)
    else:
        order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _merged(one: tuple, two: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both; whole numbers as soon as one of them has some."""
    a, b = one[1], two[1]
    if a.dtype != b.dtype:
        a, b = (x if x.dtype == object else np.array([int(v) for v in x], dtype=object) for x in (a, b))
    return _best(np.concatenate([one[0], two[0]]), np.concatenate([a, b]), k)


def _read(rows: pa.Table):
    for size, ids, kind, columns in zip(*(rows.column(c).to_pylist() for c in ("size", "ids", "kind", "columns")), strict=True):
        ids = np.frombuffer(ids, dtype=np.int64)
        matrix = np.frombuffer(columns, dtype=kind).reshape(size, len(ids)).astype(np.int64)
        yield ids, matrix, np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=0)) < EXACT_MASS


def _search(k: int):
    def search(key, queries, candidates):
        """One query block against the candidate blocks of one stripe."""
        out = []
        for q_ids, q, q_fine in _read(queries):
            floor = np.full(len(q_ids), -np.inf)
            best = [(np.zeros(0, np.int64), np.zeros(0))] * len(q_ids)
            fine = np.flatnonzero(q_fine)
            for c_ids, c, c_fine in _read(candidates):
                if len(c) != len(q):
                    continue
                fine_ids, rough_ids, c_double = c_ids[c_fine], c_ids[~c_fine], c[:, c_fine].astype(np.float64)
                for at in range(0, len(fine), LANES):
                    lane = fine[at : at + LANES]
                    own = floor[lane]
                    for i, found in zip(lane, search_block(q_ids[lane], q[:, lane].astype(np.float64), fine_ids, c_double, k, own), strict=True):
                        best[i] = _merged(best[i], found, k)
                for i in range(len(q_ids)):
                    rough = slice(None) if not q_fine[i] else ~c_fine
                    ids = c_ids if not q_fine[i] else rough_ids
                    if len(ids):
                        other = ids != q_ids[i]
                        best[i] = _merged(best[i], (ids[other], whole_scores(q[:, i], c[:, rough][:, other])), k)
                    if len(best[i][1]) == k:
                        floor[i] = max(floor[i], np.nextafter(float(best[i][1][-1]), -np.inf))
            out += [(q_ids[i], ids, score) for i, (ids, score) in enumerate(best)]
        ids = np.concatenate([x[1] for x in out]) if out else np.zeros(0, np.int64)
        score = [int(v) for x in out for v in x[2]]
        query = np.repeat(np.array([x[0] for x in out], dtype=np.int64), [len(x[1]) for x in out])
        return pa.table({"query_id": pa.array(query), "vec_id": pa.array(ids), "score": pa.array(score, pa.int64())})

    return search


def grid(n: int, components: int, n_queries: int, largest: int) -> tuple[int, int, int]:
    """Blocks of queries, stripes and blocks of candidates for n vectors of so many components in all, none beyond ``largest``.

    Every stripe meets every block of queries, so each side moves as often as the other is cut: by what fits in a task's memory, packed.
    """
    width = next(w for w in (1, 2, 4, 8) if largest < 1 << 8 * w - 1 or w == 8)
    n_blocks = max(1, math.ceil(n / CANDIDATES), math.ceil(8 * components / BLOCK_BYTES))
    q_blocks = max(1, math.ceil(n_queries / QUERIES), math.ceil(width * components * n_queries / max(1, n) / QUERY_BYTES))
    return q_blocks, min(n_blocks, max(math.ceil(TASKS / q_blocks), math.ceil(width * components / STRIPE_BYTES))), n_blocks


def top_k(
    vectors: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    queries: str = "id % 20 = 0",
    scale: float = 64.0,
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each query, exactly.

    ``queries`` is a SQL predicate over ``id``; every other row is a candidate. Components become
    floor(``scale`` * x). Returns (query_id, rank from 1, vec_id, score); ties go to the smaller id.

    * null vectors, and those with a null, NaN or infinite component, take no part; nor do rows with a null id;
    * vectors of another length than the query's are no candidates for it; empty vectors score 0 with each other;
    * rows that repeat an id are each a candidate, but never for a query with that id; a repeated
      query gives its rows once;
    * scores are exact whole numbers; those beyond 64 bits are cut off at the largest long (and rank so), as are components;
    * fewer than ``k`` candidates: all of them; other columns are ignored; an empty table gives an empty one.

    Queries grow with the table, so they are not broadcast: both sides are cut into blocks of bounded
    size, and a grid of (query block, stripe of candidate blocks) is dealt over the executors. A stripe has at most
    about ``STRIPE_BYTES``, a block of queries ``QUERY_BYTES``.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = F.col("x").isNotNull() & F.forall("x", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    scaled = F.transform("x", lambda y: F.floor(y * scale))
    v = v.filter(F.col("id").isNotNull()).withColumn("v", F.when(fine, scaled.cast("array<long>"))).filter("v IS NOT NULL").select("id", "v")
    largest = F.max(F.greatest(F.array_max("v"), -1 - F.array_min("v")))
    q_blocks, stripes, n_blocks = grid(*(x or 0 for x in v.agg(F.count("*"), F.sum(F.size("v")), F.count_if(F.expr(queries)), largest).first()))
    # rows are dealt by a hash of everything, so that one very common id or vector spreads
    c = v.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)))
    c = c.groupBy("block").applyInArrow(_blocks("block"), "block long, size int, ids binary, kind string, columns binary")
    q = v.filter(queries).dropDuplicates(["id"]).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(q_blocks)))
    q = q.groupBy("qb").applyInArrow(_blocks("qb"), "qb long, size int, ids binary, kind string, columns binary")
    c = c.withColumn("stripe", F.pmod("block", F.lit(stripes))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>")))
    q = q.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)).cast("array<long>")))
    found = q.groupBy("qb", "stripe").cogroup(c.groupBy("qb", "stripe")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    # the k best of each stripe are cut to the k best of all before and after they move
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
