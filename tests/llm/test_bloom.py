import pyarrow as pa
from pyspark.sql import functions as F

from folioframe.llm import bloom


def test_no_key_is_lost_and_few_others_pass(spark, monkeypatch):
    key = F.xxhash64("id")

    def passed(held, rows):
        test = bloom.Bloom(held, key).test()

        def work(batches):
            for batch in batches:
                yield batch.filter(pa.array(test(batch.column(1)))).select([0])

        return {r.id for r in rows.select("id", key.alias("h")).mapInArrow(work, "id long").collect()}

    for most, others in ((1 << 29, 100), (1 << 19, 20_000)):
        monkeypatch.setattr(bloom, "MOST", most)
        kept = passed(spark.range(0, 200_000, 4), spark.range(200_000))
        assert kept >= set(range(0, 200_000, 4)) and len(kept) - 50_000 < others * 10
    assert not passed(spark.range(0), spark.range(9))


def test_only_own_tables_are_dropped(spark, tmp_path):
    from folioframe.llm.shared import dropped, written

    given = f"{tmp_path}/folioframe/docs.parquet"
    spark.range(5).write.parquet(given)
    docs = spark.read.parquet(given)
    own = written(docs)
    dropped(spark, docs, own)
    assert spark.read.parquet(given).count() == 5
    try:
        gone = not spark.read.schema("id long").parquet(own.inputFiles()[0].rsplit("/", 1)[0]).count()
    except Exception:  # noqa: BLE001  the folder is no more
        gone = True
    assert gone


def test_ids_go_with_and_without_a_broadcast(spark, monkeypatch):
    from folioframe.llm import shared

    docs = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(70)], "doc_id long, n int")
    gone = spark.createDataFrame([(3,), (3,), (5,), (None,)], "doc_id long")
    for few in (2_000_000, 0):
        monkeypatch.setattr(shared, "FEW", few)
        left = shared.without_ids(docs, gone, "doc_id")
        assert sorted(r.n for r in left.collect()) == [i for i in range(70) if not i % 5 or i % 7 not in (3, 5)]
        assert ("BroadcastHashJoin" in left._jdf.queryExecution().executedPlan().toString()) >= (few > 0)
