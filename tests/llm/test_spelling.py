import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from folioframe.llm.queries import OP11_SQL
from folioframe.llm.spelling import Grid, Wavelet, count_words, group_variants, near_pairs
from helpers import SCHEMA, table, with_clashes


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_wavelet_reports_rectangles():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = Wavelet(values)
        l, r, lo, hi = (rng.integers(0, n + 1, 200) for _ in range(4))
        of, found = tree.report(l, r, lo, hi)
        got = {(int(i), int(v)) for i, v in zip(of, found, strict=True)}
        assert len(got) == len(of)
        assert got == {(i, int(v)) for i in range(200) for v in values[l[i] : r[i]] if lo[i] <= v < hi[i]}


def test_grid_finds_prefix_and_suffix():
    words = ["abcd", "abed", "xbcd", "abcz", "zzzz"]
    grid = Grid(np.array([[ord(c) for c in w] for w in words], dtype=np.uint8))
    a, b = grid.near(grid.letters, 2, 1)
    assert {(words[i], words[j]) for i, j in zip(a, b, strict=True) if i != j} == {("abcd", "abed"), ("abed", "abcd")}


def vocabulary(seed, n):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abÿé") for _ in range(rng.randint(1, 9))) for _ in range(n)}
    words |= {"prefixed" + "".join(rng.choice("ab") for _ in range(7)) for _ in range(100)} | {"a" * k for k in range(1, 30)}
    return [(w, rng.randint(1, 300)) for w in sorted(words)]


@pytest.mark.parametrize("hot", [20_000, 12, 2])
def test_pairs_same_as_brute_force(spark, hot):
    """Also where a key is hot and refined down to single code points."""
    words = vocabulary(3, 400)
    got = [(r.word, r.n, r.near, r.near_n) for r in near_pairs(spark.createDataFrame(words, "word string, n long"), hot=hot, bucket=50).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, n, b, m) for a, n in words for b, m in words if near(a, b)}


def test_forms_and_roots(spark):
    words = [("colour", 1000), ("color", 20), ("colr", 4), ("colours", 1000), ("coloud", 200), ("colorr", 100), ("alone", 7), ("even", 10), ("ever", 50), ("evet", 50), ("évén", 1)]
    got = {r.word: r for r in group_variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert len(got) == len(words)
    freq = dict(words)
    for w, n in words:
        others = sorted((x for x in freq if near(w, x)), key=lambda x: (-freq[x], x))
        form = others[0] if others and freq[others[0]] >= 5 * n else None
        assert (got[w].n, got[w].n_near, got[w].form, got[w].form_n) == (n, len(others), form, freq[form] if form else None)
        root = w
        while got[root].form:
            root = got[root].form
        assert got[w].root == root
    assert got["colr"].root == "colour" and got["even"].form == "ever" and got["coloud"].form == "colour"


TEXTS = [
    None, "", " \t\n", "naïve NAÏVE Naïve naïves", "ÀÉÎÕÜ×÷ÿ ÀÉÎÕÜ×÷ÿ", "one-two_three4four", "letters Letters LETTERS lettres " * 40, "İstanbul straße STRASSE ſtraße",
    "words and wordy worded " * 300, "x" * 5000, "aaaaaa aaaaaaa aaaaaaaa " * 9, "日本 letters✓letters",
]


def rows():
    out = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS * 3)]
    return [*out, out[6], out[6], (None, "letters wordy " * 30, None, None, None)]


def counted(rows_):
    total = Counter()
    for i, text, *_ in rows_:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def test_words_same_as_brute_force(spark):
    got = {r.word: r.n for r in count_words(with_clashes(table(spark, rows()))).collect()}
    assert got == counted(rows())
    many = [(i, "letters wordless wordlessly", None, None, 0) for i in range(3000)]  # some of them slip
    assert {r.word: r.n for r in count_words(table(spark, many)).collect()} == counted(many) and len(counted(many)) > 3


def test_same_as_sql(spark):
    many = rows() + [(100 + i, "letters wordless wordlessly", None, None, 0) for i in range(3000)] + [(9000, "letterz " * 6 + "wordles " * 9 + "wordler " * 60, None, None, 0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in many])
    wanted = con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({OP11_SQL})").fetchall()
    got = [tuple(r) for r in group_variants(count_words(table(spark, many))).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr) and any(r[1] for r in got)


def test_empty(spark):
    assert count_words(spark.createDataFrame([], SCHEMA)).count() == 0
    assert group_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert near_pairs(spark.createDataFrame([("", 3), (None, 4), ("a", 1)], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        group_variants(spark.createDataFrame([], "word string, n long"), ratio=1)
