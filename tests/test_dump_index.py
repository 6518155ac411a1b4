"""Dumps read by the data source, by the index and by precedence, and tables kept up from feeds."""

import io
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from folioframe.sources import dump_source, files, isis, precedence, sinks
from folioframe.sources.dump_index import DumpIndex, indexed
from folioframe.sources.dump_source import DumpReader, Wanted, block_lines, numbered_lines, read_dump_lines, read_dump_records
from folioframe.streaming.merged import MergedTable, keep_up


def record(kind, pid, *more):
    return "\n".join(["!ID 000001", f"!v706!{kind}", *([f"!v880!{pid}"] if pid else []), *more, ""])


def document(pid, *more, citations=1):
    return record("o", pid, *more) + "".join(record("c", pid, f"!v701!{i}", "!v012!Cited^len\ncontinued") for i in range(citations))


def test_blocks_have_each_line_once():
    rng = random.Random(5)
    for _ in range(300):
        data = "".join(rng.choice(["a", "bc", "\n", "\r\n", "\r", "é"]) for _ in range(rng.randint(0, 40))).encode("latin-1")
        whole = [(m.start(), m[0]) for m in re.finditer(rb"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+$", data)]
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(4))})
        got = [x for a, b in zip(cuts, cuts[1:], strict=False) for x in block_lines(io.BytesIO(data), a, b)]
        assert [(start, data[start:stop]) for start, stop, _ in got] == whole
        assert [line for *_, line in got] == [re.sub(rb"[\r\n]+$", b"", x) for _, x in whole]


@pytest.fixture(scope="module")
def site(tmp_path_factory):
    """Paragraph dumps in folders of journal, year and issue, and files elsewhere."""
    root = tmp_path_factory.mktemp("p")
    for issn in ("0000-0001", "0000-0002"):
        for year in ("2001", "2002"):
            for issue in ("0001", "0002"):
                for n in (1, 2):
                    where = root / (f"issn={issn}/year={year}/issue={issue}" if issn.endswith("2") else f"{issn}/{year}/{issue}")
                    where.mkdir(parents=True, exist_ok=True)
                    (where / f"{n:05}.id").write_text(document(f"S{issn}{year}{issue}{n:05}", "!v010!^nÉva^sSá"), "ISO-8859-1")
    (root / "loose.id").write_text(document("S9999"))
    (root / "other.txt").write_text("no dump")
    (root / "_hidden").mkdir()
    (root / "_hidden/x.id").write_text(document("S1"))
    return root


PID = "S0000-000120010002" + "00001"


def opened(root, **options):
    reader = DumpReader({"path": str(root), **options})
    return [p[0] for b in reader.partitions() for p in b.parts]


def test_one_pid_opens_one_file(site, monkeypatch):
    listed = []
    real = dump_source.pa.fs.FileSelector
    monkeypatch.setattr(dump_source.pa.fs, "FileSelector", lambda path, **k: listed.append(path) or real(path, **k))
    assert len(opened(site)) == 17
    listed.clear()
    assert opened(site, equal=json.dumps({"pid": [PID]})) == [f"{site}/0000-0001/2001/0002/00001.id"] and len(listed) == 4
    assert len(opened(site, prefix=json.dumps({"pid": ["S0000-00022002"]}))) == 4
    assert len(opened(site, equal=json.dumps({"issn": ["0000-0002"], "issue": ["0001"]}))) == 4
    assert opened(site, equal=json.dumps({"pid": ["short"]})) == [] and opened(site, equal=json.dumps({"pid": []})) == []


def test_filters_of_sql_choose_files(spark, site):
    """With the option pushdown, of a table that is loaded for one query."""
    lines = read_dump_lines(spark, str(site), pushdown=True)
    assert lines.filter(F.col("pid") == PID).select("path").distinct().count() == 1
    plan = read_dump_lines(spark, str(site), pushdown=True).filter(F.col("pid") == PID)
    assert plan.rdd.getNumPartitions() == 1
    wanted = Wanted()
    wanted.push(dump_source.EqualTo(("year",), "2001"))
    wanted.push(dump_source.StringStartsWith(("pid",), "S0000-0002"))
    wanted.push(dump_source.EqualTo(("line",), "x"))
    assert wanted.fits(0, "issn=0000-0002") and not wanted.fits(0, "0000-0001") and wanted.fits(1, "2001") and not wanted.fits(1, "2002")


def test_a_table_filtered_twice_keeps_all_rows(spark, site):
    lines = read_dump_lines(spark, str(site))
    both = lines.filter("year = '2001'").unionByName(lines.filter("year = '2002'"))
    assert both.select("path").distinct().count() == 16 and lines.filter("pid IS NULL").select("path").distinct().count() == 1


def test_same_records_as_the_text_reader(spark, site):
    rows = lambda df: sorted((r.path.split("/")[-1] + str(r.path.count("=")), r.rec, json.dumps(r.record, sort_keys=True)) for r in df.collect())
    lines = read_dump_lines(spark, str(site), block=64)  # blocks much smaller than a file
    got = isis.build_records(isis.join_continuations(isis.number_records(numbered_lines(lines))))
    whole = rows(isis.read_records(spark, [str(p) for p in site.rglob("*.id") if "_hidden" not in str(p)]))
    assert rows(got) == whole
    records = read_dump_records(spark, str(site), block=64)  # records numbered by their offsets
    assert [(k, v) for k, _, v in rows(records)] == [(k, v) for k, _, v in whole]
    assert read_dump_lines(spark, str(site / "loose.id")).count() == 9


ODD = "before any mark\n!v706!x\n!ID 1\n\n  !v010!^nA^sB\nthat goes on \n !v010!second\n!v012!\n!!empty tag\n!v!x\n!ID 2\n!ID 3\nno field\n!v999!a^^b^?c\\^d!v1!x\n\n!ID 4\n!v001!last"


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_odd_records_are_those_of_the_text_reader(spark, tmp_path, end):
    (tmp_path / "odd.id").write_bytes(end.join(ODD.split("\n")).encode())
    rows = lambda df: [json.dumps(r.record, sort_keys=True) for r in df.orderBy("rec").collect()]
    wanted = rows(isis.read_records(spark, str(tmp_path)))
    for block in (5, 16, 1 << 20):
        assert rows(read_dump_records(spark, str(tmp_path), block=block)) == wanted and len(wanted) == 4


def test_records_need_no_shuffle(spark, site):
    assert "Exchange" not in read_dump_records(spark, str(site))._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dumps(tmp_path):
    """Two dumps of several issues; in the second a document comes again, apart from the first."""
    pid = lambda year, n, issn="0000-0001": f"S{issn}{year}0001{n:05}"
    a = [record("i", None, "!v035!0000-0001", "!v036!20011"), *[document(pid(2001, n), f"!v091!200101{n:02}", "!v004!v1n1", citations=n) for n in range(1, 6)], "\n", record("x", None)]
    b = [*[document(pid(2002, n), f"!v091!200201{n:02}", "!v004!v2n1") for n in range(1, 4)], document(pid(2001, 1), "!v091!20030101"), "!v999!tail of the last\n"]
    folder = tmp_path / "dumps"
    folder.mkdir()
    (folder / "a.id").write_text("!v706!o\n!v880!before any mark\n" + "".join(a), "ISO-8859-1")
    (folder / "b.id").write_text("\r\n".join("".join(b).split("\n")), "ISO-8859-1", newline="")
    return folder


def plain(groups):
    return sorted((os.path.basename(r.path), r.grp, r.pid, json.dumps(r.records, sort_keys=True)) for r in groups.collect())


def test_index_gives_the_groups_of_the_reader(spark, dumps, tmp_path):
    index = indexed(spark, str(dumps), str(tmp_path / "index"))
    whole = plain(isis.read_isis(spark, str(dumps)))
    assert plain(index.groups(index.by("pid"))) == whole and len(whole) > 9
    by = lambda found: sorted({r.pid for r in index.groups(found).collect()})
    assert by(index.pid("S0000-0001200100010000" + "3")) == ["S0000-000120010001" + "00003"]
    assert len(index.groups(index.pid("S0000-000120010001" + "00001")).collect()) == 2
    assert len(by(index.prefix("S0000-00012002"))) == 3 and by(index.prefix("nothing")) == []
    assert by(index.changed("20010102", "20010104")) == [f"S0000-000120010001{n:05}" for n in (2, 3, 4)]
    assert len(by(index.changed(from_date="20020101"))) == 4 and len(by(index.issue_folder("v2n1"))) == 3
    wanted = spark.createDataFrame([("S0000-000120010001" + "00005",), ("S0000-000120010001" + "00005",), ("none",), (None,)], "pid string")
    assert by(index.pids(wanted)) == ["S0000-000120010001" + "00005"]


def test_only_the_bytes_of_a_group_are_read(spark, dumps, tmp_path):
    """All other bytes are overwritten, and the other dump is gone, yet the lookup gives the same."""
    index = indexed(spark, str(dumps), str(tmp_path / "index"))
    found = index.pid("S0000-000120010001" + "00004")
    before, spot = plain(index.groups(found)), found.first()
    data = bytearray((dumps / "a.id").read_bytes())
    data[: spot.start] = b"\n" * spot.start
    data[spot.stop :] = b"!" * (len(data) - spot.stop)
    (dumps / "a.id").write_bytes(data)
    (dumps / "b.id").unlink()
    assert plain(index.groups(found)) == before and spot.n_records == 5


def test_rows_of_other_keys_are_skipped(spark, tmp_path):
    """A lookup scans few of the index's rows, by the row groups' statistics."""
    rows = spark.range(200_000).select(F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 22, "0")).alias("pid"), *[F.md5(F.col("id").cast("string")).alias(c) for c in ("kind", "issue", "folder", "updated", "path")], *[F.col("id").alias(c) for c in ("grp", "start", "stop", "n_records")])
    rows.repartitionByRange(1, "pid").sortWithinPartitions("pid").write.option("parquet.block.size", 1 << 18).parquet(str(tmp_path / "pid"))
    found = DumpIndex(spark, str(tmp_path)).prefix("S" + "0" * 16 + "01234")
    assert found.count() == 10
    query = found._jdf.queryExecution()
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    scans = [plan]
    read = None
    while scans:
        node = scans.pop()
        if "Scan parquet" in node.nodeName():
            node.executeColumnar().count() if node.supportsColumnar() else node.execute().count()
            read = node.metrics().apply("numOutputRows").value()
        scans += [node.children().apply(i) for i in range(node.children().size())]
    assert query and read is not None and 10 <= read < 100_000


def test_empty_dumps(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/e.id").write_text("")
    index = indexed(spark, str(tmp_path / "d"), str(tmp_path / "index"))
    assert index.groups(index.by("pid")).count() == 0 and read_dump_lines(spark, str(tmp_path / "d")).count() == 0


def test_dumps_come_back_as_written(spark, tmp_path):
    rows = [
        (1, 0, {"v706": [{"_": "o"}], "v012": [{"_": "Título", "l": "pt"}, {"l": "en", "_": "a^b"}], "v010": [{"n": "só"}]}),
        (1, 1, {"v706": [{"_": "c"}], "v031": [{"_": "line\nbreak"}]}),
        (2, 0, {"v706": [{"_": "i"}]}),
    ]
    df = spark.createDataFrame(rows, f"id long, line int, record {isis.RECORD_TYPE}").withColumn("part", F.lit("x"))
    sinks.write_dumps(df, str(tmp_path / "d"), ["part"], ["id", "line"])
    got = [r.record for r in isis.read_records(spark, str(tmp_path / "d")).orderBy("path", "rec").collect()]
    order = lambda r: json.dumps(r, sort_keys=True)
    escaped = {"v706": [{"_": "o"}], "v012": [{"_": "Título", "l": "pt"}, {"l": "en", "_": f"a{isis.ESCAPED}b"}], "v010": [{"n": "só"}]}
    assert sorted(got, key=order) == sorted([escaped, {"v706": [{"_": "c"}], "v031": [{"_": "line break"}]}, rows[2][2]], key=order)


# ---- precedence --------------------------------------------------------------------------------


def tree(root, layout):
    for path, pids in layout.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text("".join(document(p, f"!v004!{f}") if f else document(p) for p, f in pids))


def pid(n, issue="0001", issn="0000-0001"):
    return f"S{issn}2001{issue}{n:05}"


def test_first_sources_of_all_issues(spark, tmp_path):
    tree(
        tmp_path,
        {
            "serial/aa/v1n1/base_xml/id/i.id": [], "serial/aa/v1n1/base_xml/id/d1.id": [(pid(1), None)], "serial/aa/v1n1/base/v1n1.id": [(pid(2), None)],
            "serial/aa/v1n2/base/v1n2.id": [(pid(3, "0002"), None)], "serial/aa/v1n3/base/v1n3.id": [(pid(5, "0003"), None)], "serial/aa/v1n4/base_xml/id/i.id": [],
            "bases-work/aa/aa.id": [(pid(1), "v1n1"), (pid(4, "0002"), "v1n2"), (pid(6, "0004"), None), (pid(7, "0005"), "other")], "bases-work/bb/bb.id": [(pid(8, "0001", "0000-0002"), None)],
        },
    )
    issues = spark.createDataFrame([("aa", f"v1n{n}", f"0000-00012001000{n}") for n in (1, 2, 3, 4, 6)] + [("bb", None, "0000-000220010001"), ("cc", "v1n1", "x"), ("aa", "v9", None)], "acronym string, folder string, issue_pid string")
    index = indexed(spark, str(tmp_path), str(tmp_path / "index"))
    got = precedence.documents_by_issue(index, precedence.issue_sources(issues), precedence.site_dump(F.col("path"))).collect()
    assert sorted((r.acronym, r.folder or "", r["rank"], r.pid) for r in got) == [
        ("aa", "v1n1", 0, pid(1)), ("aa", "v1n2", 1, pid(4, "0002")), ("aa", "v1n3", 2, pid(5, "0003")), ("aa", "v1n4", 3, pid(6, "0004")), ("bb", "", 3, pid(8, "0001", "0000-0002")),
    ]
    assert all(r.records[0]["v706"][0]["_"] == "o" and len(r.records) == 2 for r in got)
    other = precedence.documents_by_issue(index, precedence.issue_sources(issues, precedence.FILES_RANKS), precedence.site_dump(F.col("path"))).collect()
    assert sorted((r.folder or "", r["rank"], r.pid) for r in other if r.acronym == "aa") == [("v1n1", 0, pid(1)), ("v1n2", 1, pid(4, "0002")), ("v1n3", 2, pid(5, "0003")), ("v1n4", 1, pid(6, "0004"))]


def test_same_as_trying_one_issue_after_the_other(spark, tmp_path):
    """read_first, which goes through the sources of one issue in a loop, where both can be asked."""
    tree(tmp_path, {"serial/aa/v1n1/base_xml/id/x.id": [(pid(1), None)], "serial/aa/v1n2/base/v1n2.id": [(pid(3, "0002"), None)], "bases-work/aa/aa.id": [(pid(9), None)]})
    index = indexed(spark, str(tmp_path), str(tmp_path / "index"))
    paths = files.SitePaths(f"{tmp_path}/bases", f"{tmp_path}/bases-work", f"{tmp_path}/serial")
    for n in (1, 2):
        issues = spark.createDataFrame([("aa", f"v1n{n}", f"0000-00012001000{n}")], "acronym string, folder string, issue_pid string")
        got = precedence.documents_by_issue(index, precedence.issue_sources(issues), precedence.site_dump(F.col("path")))
        assert [r.pid for r in got.collect()] == [r.pid for r in files.read_first(spark, paths.document_sources("aa", f"v1n{n}")).collect()]


def test_many_issues_are_one_plan(spark, tmp_path):
    groups = spark.range(20_000).select(
        F.concat(F.lit("journal/j"), F.col("id") % 10).alias("dump"), F.concat(F.lit("S0000-000"), F.col("id") % 10, F.lpad((F.col("id") % 1000).cast("string"), 8, "0"), F.lpad((F.col("id") % 99999).cast("string"), 5, "0")).alias("pid"), F.lit(None).cast("string").alias("folder"), "id"
    )
    issues = spark.range(1000).select(F.concat(F.lit("j"), F.col("id") % 10).alias("acronym"), F.col("id").cast("string").alias("folder"), F.concat(F.lit("0000-000"), F.col("id") % 10, F.lpad(F.col("id").cast("string"), 8, "0")).alias("issue_pid"))
    got = precedence.first_sources(groups, precedence.issue_sources(issues))
    assert got.count() == 20_000 and got.select("issue_pid").distinct().count() == 1000 and set(got.columns) >= {"id", "group_folder", "rank"}
    assert "Nested" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()


# ---- tables kept up ----------------------------------------------------------------------------

CHANGES = "pid string, arrived long, path string, grp long, value string, gone boolean"


def changes(seed=2):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", "d", None]), rng.choice([None, *range(9)]), rng.choice("xyz"), n, f"v{n}", rng.random() < 0.2) for n in range(120)]


def test_any_order_of_batches_gives_the_same_table(spark, tmp_path):
    rows, first = changes(), lambda v: (v is not None, v or 0)
    last = {}
    for r in sorted(rows, key=lambda r: (first(r[1]), r[2], r[3])):
        last[r[0]] = r
    batches = [rows[i::4] for i in range(4)]
    for k, order in enumerate([(0, 1, 2, 3), (3, 1, 0, 3, 2, 1)]):
        table = MergedTable(spark, str(tmp_path / str(k)), CHANGES, deleted="gone", buckets=3)
        for n, b in enumerate(order):
            table.upsert(spark.createDataFrame(batches[b], CHANGES).withColumn("extra", F.lit(1)), n)
        assert {tuple(r) for r in table.read(removed=True).collect()} == set(last.values())
        assert {tuple(r) for r in table.read().collect()} == {r for r in last.values() if not r[-1]}


def test_versions(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), CHANGES, buckets=8)
    assert table.read().count() == 0 and table.batches() == []
    one = [(f"k{i}", 1, "p", 0, "old", False) for i in range(40)]
    assert table.upsert(spark.createDataFrame(one, CHANGES), 0) > 4
    assert table.upsert(spark.createDataFrame([("k1", 2, "p", 0, "new", False)], CHANGES), 1) == 1  # one bucket alone is written anew
    assert table.upsert(spark.createDataFrame([], CHANGES), 2) == 0
    assert table.read().filter("value = 'new'").count() == 1 and table.read(batch=0).filter("value = 'new'").count() == 0 and table.read().count() == 40
    # a batch that failed before its manifest was written is not seen, and runs again
    (tmp_path / "t/manifest/batch=2/_SUCCESS").unlink()
    assert table.batches() == [0, 1] and table.read().count() == 40
    table.upsert(spark.createDataFrame([("k2", 3, "p", 0, "newer", False)], CHANGES), 2)
    table.upsert(spark.createDataFrame([("k2", 3, "p", 0, "newer", False)], CHANGES), 2)
    assert table.read().filter("value = 'newer'").count() == 1
    table.upsert(spark.createDataFrame([(f"k{i}", 4, "p", 0, "last", False) for i in range(40)], CHANGES), 3)
    assert table.vacuum() == [0, 1, 2] and table.read().filter("value = 'last'").count() == 40 and table.batches() == [3]


def test_dumps_that_arrive_are_merged(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()

    def arrive(name, at, *pids):
        (folder / name).write_text("".join(document(p, f"!v012!{name}") for p in pids), "ISO-8859-1")
        os.utime(folder / name, (at, at))
        keep_up(spark, str(folder), target, str(tmp_path / "state")).awaitTermination(120)

    arrive("a.id", 2_000_000, "S1", "S2")
    arrive("b.id", 3_000_000, "S2", "S3")
    arrive("late.id", 1_000_000, "S3", "S4")
    table = MergedTable(spark, target, "pid string, path string, grp long, records array<map<string,array<map<string,string>>>>, arrived timestamp")
    got = {r.pid: (r.path.rsplit("/", 1)[1], r.records[0]["v012"][0]["_"], len(r.records)) for r in table.read().collect()}
    assert got == {"S1": ("a.id", "a.id", 2), "S2": ("b.id", "b.id", 2), "S3": ("b.id", "b.id", 2), "S4": ("late.id", "late.id", 2)}
