"""Near-duplicate detection with an LSH forest, links confirmed on full shingle sets.

1. *Sketch.* Each text becomes its set of 5-word shingles and a MinHash signature of
   ``trees * depth`` values. Texts with equal sets form a class; one of each goes on.
2. *Forest.* Tree t orders all classes by the signature read from position ``t * depth``
   on, around the end; a range partitioning lays each order out sorted. Neighbours of longest common prefix are
   candidates, however short the prefix; where ``depth`` values agree, all of such a run are. Two sets of similarity s meet
   in some tree but for (1 - s**depth)**trees. In a dense region the depth adapts: a run
   of over ``FULL_RUN`` classes is compared with the members nearest to its consensus, the hubs around which
   copies of one original lie, and falls into runs of twice the depth. Comparisons here are of signatures, with a margin
   below the threshold: they only gather *families*, which nothing is lost by joining.
3. *Confirm.* Each family's full sets meet once and every pair in it is compared exactly.
   Families too large for a task are split into blocks, every block together with the
   family's hubs; the members that this leaves outside the family's largest component are then compared with
   all of the family, block by block. So no link within a family is lost. A star of copies
   around an original costs one pass; a family without such a centre costs a comparison of all its blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.bloom import Bloom
from folioframe.llm.graphs import Sets, components
from folioframe.llm.shared import bounded, dropped, heavy_keys, lookup, without_ids, written
from folioframe.llm.words import STEP_BYTES, U64, Words, gram_hashes, gram_starts, mix64, released

DEPTH, SHINGLE = 4, 5
#: The most that two sets at the threshold may miss each other in all trees.
MISS = 7.5e-6
#: A run up to this size is compared in full; beyond it, neighbours, hubs and deeper runs are.
FULL_RUN, NEIGHBOURS, HUBS = 256, 4, 8
#: Shingles, and sets, of a family or block that one task holds at once.
BLOCK_SHINGLES, BLOCK_SETS = 200_000, 512
FAMILY_HUBS = 32


def trees_for(threshold: int) -> int:
    """So many trees that two sets at the threshold meet in one but for ``MISS``: 16 at 85, 23 at 80."""
    same = min(threshold, 99) / 100
    return max(1, math.ceil(math.log(MISS) / math.log1p(-(same**DEPTH))))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240517)
    a = rng.integers(1, 1 << 63, n, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    b = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(U64)
    return a, b


def shingle_sets(texts, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, first index of each document's and one more)."""
    w = Words(texts, lower=True)
    ok = gram_starts(w.first, k)
    at = np.flatnonzero(ok)
    grams = gram_hashes(w.hash, k)[at]
    doc = np.searchsorted(w.first, at, side="right") - 1
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):  # the whole sequence is the one shingle
        extra = np.empty(len(short), dtype=U64)
        for j, i in enumerate(short):
            h = np.array([w.counts[i]], dtype=U64)
            for x in range(w.first[i], w.first[i + 1]):
                h = mix64(h * U64(0x9E3779B97F4A7C15) + w.hash[x : x + 1])
            extra[j] = h[0]
        grams, doc = np.concatenate([grams, extra]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(w.n_docs + 1)).astype(np.int64)


def signatures(grams: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """MinHash values of every set, one row for each (all ones for an empty set)."""
    out = np.full((len(first) - 1, n), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        a, b = _seeds(n)
        starts = first[:-1][full]
        for j in range(n):
            out[full, j] = np.minimum.reduceat(((grams * a[j] + b[j]) >> U64(32)).astype(np.uint32), starts)
    return out


def _sketch(shingle: int, trees: int):
    def sketch(batches):
        for batch in batches:
            n_rows = batch.num_rows
            size = max(1, batch.column(2).nbytes)
            step = max(1, min(n_rows, n_rows * STEP_BYTES // size))
            for at in range(0, n_rows, step):
                part = batch.slice(at, step)
                grams, first = shingle_sets(pa.chunked_array([part.column(2)]), shingle)
                sizes = np.diff(first)
                sums = [np.zeros(len(grams) + 1, dtype=U64) for _ in range(2)]
                np.cumsum(mix64(grams), out=sums[0][1:])
                np.cumsum(mix64(grams ^ U64(0xC2B2AE3D27D4EB4F)), out=sums[1][1:])
                h = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
                sig = signatures(grams, first, trees * DEPTH)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(h[0]), pa.array(h[1]), pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["id", "text_hash", "n", "h1", "h2", "sig"],
                )

    return sketch


def _plant(trees: int):
    """A row for each class and tree: the tree's number and the signature's low bytes read from the tree's place on."""

    def plant(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, trees * DEPTH)
            low = mix64(sig.astype(U64)).astype(np.uint8)
            for t in range(trees):
                path = np.concatenate([np.full((len(sig), 1), t, dtype=np.uint8), np.roll(low, -t * DEPTH, axis=1)], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in path], pa.binary())], ["node", "path"])

    return plant


def _equal(path: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values the rows a and b have alike, the tree's number among them."""
    out = np.empty(len(a), dtype=np.int64)
    for at in range(0, len(a), 100_000):
        s = slice(at, at + 100_000)
        out[s] = (path[a[s]] == path[b[s]]).sum(axis=1)
    return out


def _cuts(path: np.ndarray, depth: int) -> np.ndarray:
    """First rows of the runs that agree on the tree and ``depth`` values, and the number of rows."""
    new = (path[1:, : depth + 1] != path[:-1, : depth + 1]).any(axis=1)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(path)]])


def _dense(path: np.ndarray):
    """(pairs a, b, agreement with the consensus) of a run too long for a comparison of all."""
    m = len(path)
    agree = np.zeros(m, dtype=np.int64)
    for j in range(path.shape[1]):
        agree += path[:, j] == np.bincount(path[:, j], minlength=256).argmax()
    hubs = np.argsort(-agree, kind="stable")[:HUBS]
    return np.repeat(hubs, m), np.tile(np.arange(m), len(hubs)), agree


def candidate_pairs(path: np.ndarray, least: int, full_run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the sorted rows that agree on ``least`` values, and each row's agreement with its run's consensus.

    Neighbours of longest common prefix are compared everywhere, however short that is. Runs that agree on
    DEPTH values are compared in full; where one has over ``full_run`` rows, its rows are compared with the run's hubs, and
    the runs in it that agree on twice the depth take its place, and so on.
    """
    n, width = path.shape
    agree = np.zeros(n, dtype=np.int64)
    pairs = []

    def compare(a, b):
        ok = (a != b) & (path[a, 0] == path[b, 0])
        a, b = a[ok], b[ok]
        ok = _equal(path, a, b) > least
        pairs.append((a[ok], b[ok]))

    for d in range(1, min(NEIGHBOURS, n - 1) + 1):
        compare(np.arange(n - d), np.arange(d, n))
    todo = [(0, n, DEPTH)]
    while todo:
        lo, hi, depth = todo.pop()
        cuts = _cuts(path[lo:hi], depth) + lo
        long = np.diff(cuts) > NEIGHBOURS + 1  # neighbours are all there is in shorter ones
        for at, to in zip(cuts[:-1][long], cuts[1:][long], strict=True):
            rows = path[at:to]
            if to - at <= full_run:
                alike = np.zeros((to - at, to - at), dtype=np.uint16)
                for j in range(width):
                    alike += rows[:, j][:, None] == rows[:, j]
                a, b = np.nonzero(np.triu(alike > least, 1))
                pairs.append((a + at, b + at))
            else:
                a, b, agree[at:to] = _dense(rows)
                compare(a + at, b + at)
                if depth < width - 1:
                    todo.append((at, to, min(2 * depth, width - 1)))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    return a, b, agree


def _gather(least: int, full_run: int, batch_rows: int = 200_000):
    """Sorted rows of one partition -> (member, smallest member of its group, its agreement).

    Rows are held until a run ends; of a run too long for that, ``full_run`` rows are held over, so nothing within reach of each other is cut apart.
    """

    def gather(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= batch_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                path = _paths(table)
                last = int(_cuts(path, DEPTH)[-2])
                yield from work(table, path)
                table = table.slice(max(0, last - NEIGHBOURS) if last else rows - full_run)
                held, rows = table.to_batches(), table.num_rows
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from work(table, _paths(table))

    def work(table, path):
        nodes = table.column("node").to_numpy()
        n = len(nodes)
        a, b, agree = candidate_pairs(path, least, full_run)
        sets = Sets(n)
        sets.join(a, b)
        root = sets.flatten()
        at = np.flatnonzero(np.bincount(root, minlength=n)[root] > 1)
        if len(at):
            low = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(low, root[at], nodes[at])
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(low[root[at]]), pa.array(agree[at])], ["u", "v", "agree"])

    return gather


def _paths(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("path").to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)


def intersections(grams: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set with every other set."""
    a, b = np.concatenate(grams), np.concatenate(others)
    of_a = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    of_b = np.repeat(np.arange(len(others)), [len(g) for g in others])
    # a shingle that only one side has is in no intersection
    in_a, in_b = np.isin(a, b), np.isin(b, a)
    a, b, of_a, of_b = a[in_a], b[in_b], of_a[in_a], of_b[in_b]
    out = np.zeros((len(grams), len(others)), dtype=np.float32)
    if not len(a):
        return out.astype(np.int64)
    values = np.unique(a)
    # shingles that the same sets have are alike in large groups: such a group is one weighted column
    mark = np.zeros((2, len(values)), dtype=U64)
    at_a, at_b = np.searchsorted(values, a), np.searchsorted(values, b)
    np.add.at(mark[0], at_a, mix64(of_a.astype(U64) + U64(1)))
    np.add.at(mark[1], at_b, mix64(of_b.astype(U64) + U64(1)))
    _, one, weight = np.unique(mix64(mark[0]) + mark[1], return_index=True, return_counts=True)
    place = np.full(len(values), -1, dtype=np.int64)
    place[one] = np.arange(len(one))

    def entries(at, of):
        column = place[at]
        kept = column >= 0
        column, of = column[kept], of[kept]
        order = np.argsort(column, kind="stable")
        return column[order], of[order]

    a, b = entries(at_a, of_a), entries(at_b, of_b)
    width = max(256, (8 << 20) // (4 * max(len(grams), len(others))))
    for lo in range(0, len(one), width):
        part = []
        for (column, of), n in ((a, len(grams)), (b, len(others))):
            s = slice(*np.searchsorted(column, [lo, lo + width]))
            dense = np.zeros((n, min(width, len(one) - lo)), dtype=np.float32)
            dense[of[s], column[s] - lo] = 1
            part.append(dense)
        out += (part[0] * weight[lo : lo + width].astype(np.float32)) @ part[1].T
    return out.astype(np.int64)


def linked(grams: list[np.ndarray], others: list[np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index in grams, index in others) with 100 * intersection >= threshold * union."""
    if len(grams) == len(others) == 1:
        both = np.array([[np.intersect1d(grams[0], others[0], assume_unique=True).size]])
    else:
        both = intersections(grams, others)
    n, m = (np.array([len(g) for g in x], dtype=np.int64) for x in (grams, others))
    return np.nonzero((both > 0) & (100 * both >= threshold * (n[:, None] + m[None, :] - both)))


def _confirm(threshold: int):
    def confirm(key, table):
        """Exact links of the families in this group, or of a family's block with its hubs; with ``side``, only between its two sides."""
        nodes = table.column("node").to_numpy()
        group = np.where(table.column("side").to_numpy() > 0, -1, table.column("family").to_numpy())
        side = table.column("side").to_numpy()
        sets = table.column("grams").to_pylist()
        order = np.lexsort((nodes, group))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
        us, vs = [], []
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            rows = order[at:to]
            if group[rows[0]] >= 0:
                rows = rows[np.concatenate([[True], nodes[rows[1:]] != nodes[rows[:-1]]])]  # a hub can come twice
                left = right = rows
            else:
                left, right = rows[side[rows] == 1], rows[side[rows] == 2]
            if not len(left) or not len(right):
                continue
            one = [np.frombuffer(sets[i], dtype=U64) for i in left]
            two = one if left is right else [np.frombuffer(sets[i], dtype=U64) for i in right]
            if left is right and len(left) == 2:
                a, b = linked(one[:1], one[1:], threshold)
                b = b + 1
            else:
                a, b = linked(one, two, threshold)
            # no more links than hold the components together
            found, place = np.unique(np.concatenate([nodes[left], nodes[right]]), return_inverse=True)
            joined = Sets(len(found))
            joined.join(place[: len(left)][a], place[len(left) :][b])
            root = joined.flatten()
            far = np.flatnonzero(root != np.arange(len(found)))
            us.append(found[far]), vs.append(found[root[far]])
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": pa.array(np.concatenate(us or none)), "v": pa.array(np.concatenate(vs or none))})

    return confirm


def _sets_of(shingle: int, may_hold):
    """Full sets of the texts that the filter may hold."""

    def sets_of(batches):
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(batch.column("h"))))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                grams, first = shingle_sets(pa.chunked_array([part.column("text")]), shingle)
                sets = pa.array([grams[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), sets], ["id", "text_hash", "grams"])

    return sets_of


def _families(classes: DataFrame, threshold: int, trees: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Step 2: (node, family) of every class with a candidate, its agreement (node, agree), and the table behind it."""
    # 4.5 standard deviations below the threshold, and low bytes that agree by chance
    t, s = trees * DEPTH, threshold / 100
    least = max(DEPTH, math.floor(t * (s - 4.5 * math.sqrt(s * (1 - s) / t))))
    forest = classes.select("node", "sig").mapInArrow(released(_plant(trees)), "node long, path binary")
    runs = forest.repartitionByRange("path").sortWithinPartitions("path", "node")
    edges = written(runs.mapInArrow(released(_gather(least, FULL_RUN)), "u long, v long, agree long"))
    family = components(edges.select("u", "v")).select(F.col("id").alias("node"), F.col("component").alias("family"))
    agree = edges.groupBy(F.col("u").alias("node")).agg(F.sum("agree").alias("agree"))
    return written(family), agree, edges


def _plan(family: DataFrame, agree: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, id, text_hash, family, block, blocks, agree): where each class of a family is compared."""
    sized = family.join(classes.select("node", "id", "text_hash", "n"), "node")
    weight = sized.groupBy("family").agg(F.sum("n").alias("weight"), F.count("*").alias("members"))
    total, members = weight.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("members"), F.lit(0))).first()
    packs = max(32, math.ceil(total / BLOCK_SHINGLES), math.ceil(members / BLOCK_SETS))
    blocks = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_SETS))
    placed = lookup(sized, weight, "family").withColumn("blocks", blocks).join(agree, "node", "left")
    # whole families are packed together; a large one has blocks of its own
    pack = F.concat(F.lit("p"), F.pmod(F.xxhash64("family"), F.lit(packs)))
    own = _block(F.col("family"), F.pmod(F.xxhash64("node"), F.col("blocks")))
    return written(placed.select("node", "id", "text_hash", "family", F.when(F.col("blocks") == 1, pack).otherwise(own).alias("block"), "blocks", F.coalesce("agree", F.lit(0)).alias("agree")))


def _block(family, number):
    return F.concat(F.lit("b"), family, F.lit(":"), number)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked where 100 * intersection >= ``threshold`` * union of their sets of
    ``shingle``-word shingles (A-Z lower-cased; with fewer words the whole sequence is the one
    shingle). ``component_id`` is the smallest id that links reach; ``kept`` marks that row.

    * null or empty text, or only white space: an empty set, linked with nothing (not even with other rows of its id), kept;
    * ids must be integers; a null id gives a row of its own that links to nothing (component null, kept);
    * rows with equal ids are one document, which has the links of all its texts; each comes back as a row, and every row of the component's id is kept;
    * ties: the smallest id; other columns are ignored; an empty table gives an empty one;
    * very long texts are hashed whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    trees = trees_for(threshold)
    sketch = written(rows.mapInArrow(released(_sketch(shingle, trees)), "id long, text_hash long, n long, h1 long, h2 long, sig binary"))
    known = sketch.filter("n > 0 AND id IS NOT NULL")
    classes = known.groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.first("sig").alias("sig"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "n", "first.id", "first.text_hash", "sig"))
    repeated, differing = _ids(known)

    family, agree, edges = _families(classes, threshold, trees)
    plan = _plan(family, agree, classes)
    # few texts are in a family: of the others no set is made or moved
    key, on = F.xxhash64("id", "text_hash"), ["id", "text_hash"]
    may_hold = Bloom(plan, key).test()
    placed = plan.select("id", "text_hash", "node", "family", "block")

    def sets_in(part: DataFrame) -> DataFrame:
        return part.withColumn("h", key).mapInArrow(released(_sets_of(shingle, may_hold)), "id long, text_hash long, grams binary")

    if heavy := heavy_keys(known, "text_hash"):  # a text that many ids have: its few rows in the plan go to it
        often = F.coalesce(F.col("text_hash").isin(heavy), F.lit(False))
        grams = sets_in(rows.filter(often)).join(F.broadcast(placed.filter(often)), on).unionByName(sets_in(rows.filter(~often)).join(placed.filter(~often), on))
    else:
        grams = sets_in(rows).join(placed, on)
    grams = grams.select("node", "family", "block", "grams")
    if repeated:
        grams = grams.dropDuplicates(["node"])
    large = plan.filter("blocks > 1")
    has_large = not large.isEmpty()
    if has_large:
        grams = written(grams)
    near = grams.select("node", "family", "block", "grams", F.lit(0).alias("side"))
    if has_large:
        sets = grams.join(large.select("node"), "node", "left_semi").select("node", "family", "grams")
        near = near.unionByName(_placed(_hubs(large), sets).withColumn("side", F.lit(0)))
    links = _linked(near, threshold)
    if differing:
        links = written(links.unionByName(_same_id(known, classes)))
    found = written(components(links))
    if has_large:
        found = _rest(large, sets, links, found, threshold)
        dropped(rows.sparkSession, grams)
    dropped(rows.sparkSession, edges, family, plan, links)

    # components of classes are named by their smallest id; then back to every row
    named = lookup(classes.select("node", "id", "h1", "h2", "n"), found.select(F.col("id").alias("node"), "component"), "node", "left", heavy=[])
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    named = lookup(written(named), least, "component").withColumn("class", F.xxhash64("h1", "h2", "n")).select("class", "h1", "h2", "n", "least")
    members = known.select("id", "n", "h1", "h2", F.xxhash64("h1", "h2", "n").alias("class"))
    many = lookup(members, named, "class", on=["class", "h1", "h2", "n"]).select("id", "n", F.col("least").alias("component"))
    out = many.unionByName(sketch.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component")))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """The documents, with all their columns, of which near_duplicates() keeps the id; of rows equal in id and text one stays.

    * null and empty texts, and null ids, are linked with nothing and stay;
    * rows that share a kept id but not their text all stay: they are one document;
    * which of the rows equal in id and text stays is open where their other columns differ; an empty table gives an empty one.
    """
    result = near_duplicates(docs, id_col, text_col, threshold, shingle)
    found = written(result.select(id_col, "kept"))
    dropped(docs.sparkSession, result)
    kept = without_ids(docs, found.filter(~F.col("kept")), id_col)
    again = found.filter(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1").select(F.col(id_col).alias("_again"))
    if again.isEmpty():
        return kept
    again = bounded(again)
    same = kept[id_col] == again["_again"]
    # copies are put together where they are read, before they move
    one = kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, same, "left_anti").unionByName(one)


def _ids(known: DataFrame) -> tuple[bool, bool]:
    """Are there ids with several rows, and with several sets?"""
    key = F.struct("h1", "h2", "n")
    by_id = known.groupBy("id").agg(F.count("*").alias("rows"), F.min(key).alias("a"), F.max(key).alias("z"))
    rows, sets = by_id.agg(F.max("rows"), F.max(F.col("a") != F.col("z"))).first()
    return (rows or 0) > 1, bool(sets)


def _same_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    key = F.struct("h1", "h2", "n")
    several = known.groupBy("id").agg(F.min(key).alias("a"), F.max(key).alias("z")).filter("a <> z").select("id")
    own = known.select("id", "h1", "h2", "n").join(several, "id", "left_semi").distinct()
    own = own.join(classes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"]).select("id", "node")
    return lookup(own, own.groupBy("id").agg(F.min("node").alias("v")), "id").select(F.col("node").alias("u"), "v").filter("u <> v")


def _linked(sets: DataFrame, threshold: int) -> DataFrame:
    return written(sets.groupBy("block").applyInArrow(_confirm(threshold), "u long, v long"))


def _placed(places: DataFrame, sets: DataFrame) -> DataFrame:
    """Copies of the sets (node, family, grams) for each of their places (node, block, ...)."""
    return lookup(places, sets, "node")


def _hubs(large: DataFrame) -> DataFrame:
    """(node, block): the members of each large family that are nearest to its consensus, in every block of it."""
    salt = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(FAMILY_HUBS)).alias("salt")
    hubs = large.groupBy("family", "blocks", salt).agg(F.max_by("node", F.struct("agree", F.negative("node"))).alias("node"))
    return hubs.select("node", "family", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b")).select("node", _block(F.col("family"), F.col("b")).alias("block"))


def _rest(large: DataFrame, sets: DataFrame, links: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """Large families that are still in several components: all but the largest one's members against every block."""
    now = large.select("node", "family", "block", "blocks").join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    now = written(now)
    sizes = now.groupBy("family", "component").count()
    top = sizes.groupBy("family").agg(F.max_by("component", F.struct("count", F.negative("component"))).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    top = written(top.select("family", "main"))
    if top.isEmpty():
        return found
    rest = written(lookup(now, top, "family"))
    # the others, in groups like the blocks; each group meets each block of its family once
    minor = rest.filter("component <> main")
    share = minor.groupBy("family").agg(F.count("*").alias("minor")).join(rest.groupBy("family").agg(F.count("*").alias("members")), "family")
    rest = lookup(rest, share, "family").withColumn("groups", F.ceil(F.col("blocks") * F.col("minor") / F.col("members")))
    rest = rest.withColumn("g", F.pmod(F.xxhash64("node", F.lit(3)), F.col("groups")))
    one = rest.filter("component <> main").select("node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "g", "family")
    one = one.select("node", F.concat(_block(F.col("family"), F.col("b")), F.lit("/"), "g").alias("block"), F.lit(1).alias("side"))
    two = rest.select("node", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    two = two.select("node", F.concat("block", F.lit("/"), "g").alias("block"), F.lit(2).alias("side"))
    more = _linked(_placed(one.unionByName(two), sets), threshold)
    out = written(components(links.unionByName(more)))
    dropped(sets.sparkSession, now, top, rest, more)
    return out
