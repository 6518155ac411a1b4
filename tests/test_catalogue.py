"""Every registered query of the record engine against its SQL in DuckDB."""

import datetime

import duckdb
import pytest

from folioframe.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(v):
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, (datetime.datetime, datetime.date)) else v


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, sf, con, name):
    df = catalogue.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(normal(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = catalogue.oracle_sql().get(name)
    if not sql:
        assert got
        return
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(normal(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)


@pytest.mark.parametrize("name", list(catalogue.oracle_sql()))
def test_no_column_is_empty(con, name):
    """An answer that is null on every row proves nothing."""
    found = con.execute(catalogue.oracle_sql()[name])
    names, rows = [d[0] for d in found.description], found.fetchall()
    assert rows
    for i, column in enumerate(names):
        assert any(r[i] is not None for r in rows), column


@pytest.mark.parametrize("name", ["line_parents", "line_footnotes", "line_labels", "heading_sections", "link_classify"])
def test_classes_are_all_there(con, name):
    """Each class has at least a hundredth of the rows, and at least a third of the rows have one."""
    found = con.execute(catalogue.oracle_sql()[name])
    names, rows = [d[0] for d in found.description], found.fetchall()
    classes = [i for i, c in enumerate(names) if c in ("parent", "fn_type", "ref_type", "id_type", "sec_type", "kind")]
    for i in classes:
        counts = {}
        for r in rows:
            counts[r[i]] = counts.get(r[i], 0) + 1
        assert len(counts) > 3 and min(counts.values()) * 100 >= len(rows) and counts.get(None, 0) * 3 <= 2 * len(rows), counts


def test_headings_keep_their_words(spark, sf, con):
    """The words of every heading are part of its title; where they hold no connector, its type is the literal of the title before them."""
    from folioframe.plans.title_queries import _HEADINGS, SECTIONS

    words = {(page, pos): t for page, pos, t in con.execute(_HEADINGS + "SELECT page_id, pos, t FROM l").fetchall()}
    got = {(r.page_id, r.pos): r for r in catalogue.queries()["heading_sections"](spark, sf).collect()}
    assert got.keys() == words.keys() and len({r.title for r in got.values()}) > len(got) / 2
    for (page, pos), r in got.items():
        title, kind = SECTIONS[(page + pos) % len(SECTIONS)]
        assert r.title == f"{title} {words[page, pos]}"
        if not {"and", "&", "e", "y", "et", "und", "en", "com", "avec", "mit", "met"} & set(words[page, pos].lower().split()):
            assert r.sec_type == kind, r
