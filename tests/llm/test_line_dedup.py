import re
from collections import defaultdict

import duckdb
import pytest

from folioframe.llm import line_dedup as module
from folioframe.llm.line_dedup import Filters, line_dedup
from folioframe.llm.queries import OP13_SQL
from helpers import difficult, table, with_clashes

SHARED = "This line stands in many documents"
LONG = "a very long line indeed " * 40


def rows():
    lines = [
        [SHARED, "own line of the first", "", SHARED], ["  this LINE stands in many documents\r", "short", "short", SHARED + "\t"], [SHARED], ["", "", ""], ["ÀÉÎ line of ten", "Àéî LINE of ten"],
        ["àéî line of ten", "123456789", "1234567890"], ["123456789", "1234567890\x0b", "tail"], [LONG, "x"], [LONG.upper(), "y" * 9 + "é"], ["y" * 9 + "É", "twice in here only", "twice in here only"], ["日本語日本語日本語日", "z"],
        ["日本語日本語日本語日"], ["日本語日本語日本語"], ["日本語日本語日本語"],
    ]
    out = [(i * 2 - 3, "\n".join(x), "en", "s", 0) for i, x in enumerate(lines)]
    out += [(500 + r[0], r[1], *r[2:]) for r in difficult()]
    out += [(2000 + i, f"{SHARED}\nline number {i} alone here", None, None, 0) for i in range(2500)]
    return [*out, out[0], (out[2][0], "another text under the same id\n" + SHARED, None, None, 0)]


def brute(rows_):
    """Rows of one id are one document; null ids come last, as one document."""
    strip = "\x20\t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(strip))
    rank = lambda i: (i is None, i or 0)
    found = defaultdict(set)
    for i, text, *_ in rows_:
        for line in (text or "").split("\n"):
            found[key(line)].add(rank(i))
    out = []
    for i, text, *_ in rows_:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(found[key(x)]) > 1 and rank(i) != min(found[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def collected(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most", [1 << 29, 1 << 10])
@pytest.mark.parametrize("sent", [32 << 20, 0])
def test_same_as_brute_force(spark, monkeypatch, most, sent):
    """Also with filters that are much too small, and where keys meet texts in a shuffle."""
    monkeypatch.setattr(module, "MOST", most)
    monkeypatch.setattr(module, "SLICE", min(module.SLICE, most // 4))
    monkeypatch.setattr(module, "SENT", sent)
    null = [(None, f"{SHARED}\nnull ids too\nnull ids too", None, None, 0), (None, "null ids too", None, None, 0)]
    got = collected(line_dedup(with_clashes(table(spark, rows() + null).repartition(7))))
    assert got == brute(rows() + null)


def test_same_as_sql(spark):
    unique = {r[0]: r for r in rows()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in unique.values()])
    wanted = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({OP13_SQL})").fetchall()
    from pyspark.sql import functions as F

    got = line_dedup(table(spark, list(unique.values()))).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(wanted)


def test_empty(spark):
    assert line_dedup(table(spark, [])).count() == 0


def test_lines_of_one_document_are_no_suspects(spark):
    """Only lines that several documents have may move, but for a few."""
    df = spark.createDataFrame([(i, f"line {i} of many lines here\nline {i} of many lines here\n{SHARED}") for i in range(3000)], "id long, text string")
    filters = Filters(9000)
    twice = filters.twice(df.select("text"), 10)
    found = [bytes(r.key) for r in df.mapInArrow(filters.suspects(twice, 10), "id long, key binary").collect()]
    assert found.count(SHARED.lower().encode()) == 3000 and len(found) < 3300
