import random
import re
from collections import Counter

from pyspark.sql import functions as F

from folioframe.llm.decontaminate import contaminated
from folioframe.llm.queries import queries
from helpers import difficult, prose, table
from test_near_dedup import brute as components
from test_near_dedup import shingles
from test_sharding_packing import check_packing


def test_stages(spark, sf):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in p.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = p.written(stage(spark, docs, sf))
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_dedup":
            assert set(kept[name]) == {i for i, _, c in components(list(before.items()), 80) if i == c}
        if name == "decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert contaminated(docs, bench).count() == 0 and len(kept[name]) < len(before)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    wrong = Counter(labels[i] == 1 for i in labels if (i in kept["quality"]) != (labels[i] == 1))
    assert sum(wrong.values()) <= 2
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w+", t) for t in kept["pii"].values())
    check_packing([(i, t) for i, t in kept["pii"].items()], p.STAGES[-1][1](spark, docs, sf).collect())


def test_run_and_queries(spark, sf):
    """Every query returns all that its contract names: a row for each document, message, query, piece, word or step."""
    import corpus_pipeline as p

    n = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "conversations")}
    ids = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in p.run(spark, sf).collect()} < ids
    wanted = {"op1": n["documents"], "op3": n["documents"], "op5": n["documents"], "op6": n["documents"], "op7": n["documents"], "op8": n["documents"], "op10": n["conversations"], "op2": 25 * 20, "op13": n["documents"]}
    wanted["op12"] = 600 * spark.read.parquet(f"{sf}/documents.parquet").selectExpr("coalesce(lang, '') AS part").distinct().count()
    for name, query in queries().items():
        rows = query(spark, sf).collect()
        if (op := name.split("_")[0]) in wanted:
            assert len(rows) == wanted[op], name
        elif op == "op11":  # a row for each frequent word
            assert rows and len({r.word for r in rows}) == len(rows)
        else:
            assert rows and {r.doc_id for r in rows} <= ids, name


def write(spark, folder, docs, labels, items):
    table(spark, docs).withColumn("extra", F.lit(7)).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_difficult_table(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, copies, leaks and personal data through every stage."""
    import corpus_pipeline as p

    rng = random.Random(12)
    item = prose(rng, 40, 5_000)
    rows = difficult() + [(None, "null id one", None, None, 1), (None, "null id two", None, None, 1)]
    rows += [(500, "the same row twice and nothing else here", None, None, 1)] * 2 + [(501, f"{prose(rng, 50, 9_000)} {item} {prose(rng, 50, 9_000)}", "en", "s", 1)]
    rows += [(502, f"{prose(rng, 60, 9_000)} write to user@mail.example.com or call +1 (437) 555-0689 soon", "en", "s", 1), (503, None, None, None, None)]
    write(spark, tmp_path, rows, [], [(1, item), (None, "x"), (2, None)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = p.written(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"] and docs.filter("extra <> 7").isEmpty()
        kept = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "near_dedup":
            wanted = {(i, s) for i, s, c in components([(r[0], r[1]) for r in rows], 80) if i == c}
            assert {(i, len(shingles(t))) for i, t in kept} == wanted and len(kept) == len(set(kept))
    ids = [i for i, _ in kept]
    assert 501 not in ids and ids.count(500) == 1 and ids.count(None) == 2 and (503, None) in kept
    assert dict(kept)[502].endswith("write to <EMAIL> or call <PHONE> soon")
    packed = p.STAGES[-1][1](spark, docs.filter("doc_id IS NOT NULL"), str(tmp_path)).collect()
    check_packing([(i, t) for i, t in kept if i is not None], packed)


def test_empty_table(spark, tmp_path):
    import corpus_pipeline as p

    write(spark, tmp_path, [], [], [])
    assert p.run(spark, str(tmp_path)).count() == 0
