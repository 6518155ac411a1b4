import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from folioframe.llm.filter_audit import audit, audit_documents
from folioframe.llm.queries import OP12_SQL
from helpers import difficult, table, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def rows():
    out = [(i, t, lang, s, n) for i, t, lang, s, n in difficult()]
    out += [(1000 + i, t, "", "x", 0) for i, t in enumerate(["SHOUT " * 250, "w1 w2 $" * 90, "a b " * 210, "É" * 300, " ".join(map(str, range(400)))])]
    return [*out, out[3], (None, "one", "en", None, 3), (None, "one", "en", None, 3), (-5, "one", None, None, 3)]


def labels(rows_):
    rng = random.Random(4)
    found = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows_ if rng.random() < 0.6]
    return [*found, found[0], (found[1][0], 1, 1), (None, 1, 1), (987654, 1, 1)]


def wanted(rows_, labels_):
    """Every order walked by itself over the documents."""
    texts = {}
    for r in rows_:
        if r[0] is not None:
            texts[r[1] or ""] = min(r[0], texts.get(r[1] or "", r[0]))
    good, toxic = ({i for i, *v in labels_ if i is not None and v[k] == 1} for k in (0, 1))
    docs = []
    for i, text, lang, *_ in rows_:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and texts[text] < i,
        }
        docs.append((lang or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return out


def test_same_as_every_order_by_itself_and_sql(spark):
    r, lab = rows(), labels(rows())
    docs, said = with_clashes(table(spark, r)), spark.createDataFrame(lab, LABELS).withColumn("part", F.lit("clash"))
    got = {tuple(x[:3]): list(x[3:]) for x in audit_documents(docs, said).collect()}
    assert got == wanted(r, lab) and len(got) % 600 == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [x[:3] for x in r])
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", lab)
    assert got == {tuple(x[:3]): list(x[3:]) for x in con.execute(OP12_SQL).fetchall()}


def test_general_filters(spark):
    df = spark.range(100).withColumn("removed", F.lit("clash"))
    got = {(r.filter_order, r.step): r for r in audit(df, {"x": F.col("id") % 2 == 0, "y": F.col("id") < 50, "n": F.lit(None)}, F.lit(None), {"low": F.col("id") < 10}).collect()}
    assert len(got) == 18 and {r.part for r in got.values()} == {""}
    assert got["xyn", 2].removed == 25 and got["xyn", 2].redundant == 25 and got["xyn", 2].kept == 25 and got["xyn", 2].low_lost == 5
    assert got["nxy", 1].removed == 0 and got["yxn", 1].unique_fails == 25 and got["yxn", 1].shapley == 3 * 50 + 3 * 25
    assert audit(df, {"x": F.col("id") < 0}, F.lit("p"), {}).collect()[0].kept == 100
    with pytest.raises(ValueError):
        audit(df, {"long": F.lit(True)}, F.lit(""), {})


def test_empty(spark):
    assert audit_documents(table(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_states_are_shared(spark, monkeypatch):
    """32 states for 120 orders: each survivor set is made once, and none stays persisted."""
    from pyspark.sql import DataFrame

    made = []
    plain = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: made.append(1) or plain(self, *a))
    df = spark.range(64)
    audit(df, {f: F.col("id").bitwiseAND(1 << i) > 0 for i, f in enumerate("ABCDE")}, F.lit(""), {})
    assert len(made) == 31 and isinstance(df, DataFrame)
    assert not spark.sparkContext._jsc.getPersistentRDDs()
