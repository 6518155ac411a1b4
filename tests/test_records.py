"""Dumps, records, projections and dictionaries."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.functions.fields import field, full_record, projection, raw_field
from folioframe.operators import entities
from folioframe.plans import dictionary
from folioframe.sources import files, isis, sinks
from folioframe.streaming import dumps

DUMP = """!ID 1
!v706!i
!v035!0044-5967
!v036!20193
!ID 2
!v706!o
!v880!S0044-59672019000300242
!v012!Título
que continua
!ID 3
!v706!f
!v880!S0044-59672019000300242
!v010!^nAna^sSilva^1aff1 aff2
!v010!^nBo^sCruz
!v070!Univ^iaff1^pBrasil
!v012!First^len
!v012!Segundo^lpt
!v014!^f10^l20
!v065!20190300
!ID 4
!v706!c
!v880!S0044-59672019000300242
!v701!1
!v012!Cited^len
!v030!Source
!v065!20010000
!v014!5-9
!ID 5
!v706!o
!v880!S0044-59672019000300999
!ID 6
!v706!o
!v880!S0044-59672019000300242
"""


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    (folder / "a.id").write_bytes(DUMP.encode("latin-1"))
    return folder


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "content, found",
    [
        ("bla^ssurname^nname^oxxx", {"_": "bla", "s": "surname", "n": "name", "o": "xxx"}),
        ("^v49^n3", {"v": "49", "n": "3"}),
        ("plain", {"_": "plain"}),
        ("a^bx^by^c", {"_": "a", "b": "y"}),
        ("a\\^b", {"_": "aESCAPECIRCb"}),
        ("a^bx^Zy", {"_": "a", "b": "x\\^Zy"}),
        ("", None),
    ],
)
def test_subfields(spark, content, found):
    assert one(spark, isis.subfields(F.col("c")), c=content) == found


def test_groups_run_by_consecutive_ids(spark, dump):
    groups = isis.read_isis(spark, str(dump)).orderBy("grp").collect()
    assert [(g.pid, len(g.records)) for g in groups] == [("0044-596720190003", 1), ("S0044-59672019000300242", 3), ("S0044-59672019000300999", 1), ("S0044-59672019000300242", 1)]
    assert groups[1].records[0]["v012"] == [{"_": "Título que continua"}]
    assert isis.read_isis(spark, None).count() == 0


def test_documents_meet_the_issue_before_them(spark, dump):
    rows = isis.join_issues_seen(isis.route_groups(isis.read_isis(spark, str(dump)))).orderBy("grp").collect()
    assert [r.kind for r in rows] == ["doc"] * 3 and all(r.issue_pid == "0044-596720190003" for r in rows)


RECORD = {"v010": [{"_": "x", "n": "A"}, {"n": "B"}], "v012": [{"_": "t1"}, {"_": "t2"}], "v706": [{"_": "o"}]}


@pytest.mark.parametrize(
    "how, found",
    [
        (dict(tag="v012", single=True, simple=True), "t1"),
        (dict(tag="v12", simple=True), ["t1", "t2"]),
        (dict(tag="v010", simple=True), []),
        (dict(tag="v010", subfields={"n": "name"}, single=True), {"_": "x", "name": "A"}),
        (dict(tag="v010", subfields={"n": "name"}), [{"_": "x", "name": "A"}, {"name": "B"}]),
        (dict(tag="v999", single=True, simple=True), None),
        (dict(tag="v999", single=True), {}),
        (dict(tag="v999", simple=True), []),
        (dict(tag="v012", single=True, simple=True, multi_val_tags={"v012"}), ["t1", "t2"]),
    ],
)
def test_field_shapes(spark, how, found):
    df = spark.createDataFrame([(RECORD,)], f"record {isis.RECORD_TYPE}")
    assert df.select(field("record", **how).alias("x")).first().x == found


def test_of_equal_names_the_last_wins(spark):
    df = spark.sql("SELECT map('v010', array(map('_', 'x', 'n', 'A'))) AS record")
    assert df.select(field("record", "v010", {"n": "name", "_": "name"}, single=True).alias("x")).first().x == {"name": "A"}


def test_raw_fields(spark):
    df = spark.createDataFrame([(RECORD,)], f"record {isis.RECORD_TYPE}")
    get = lambda c: df.select(c.alias("x")).first().x
    assert get(raw_field("record", "v012", single=True)) == "t1" and get(raw_field("record", "v999", single=True)) is None
    assert get(raw_field("record", "v012", fix=F.upper)) == ["T1", "T2"]
    assert [n.name for n in get(full_record("record", {"title": {"tag": "v012"}}))] == ["v010", "title", "v706"]


def test_dictionary(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("record,tag,subfield,subfield_name,multi_val,composite,field_name,name,description\nh,12,_,text,,,titles,Titles,x\nh,12,l,language,,,titles,Titles,x\nh,31,,,false,false,volume,Volume,\nh,,,,,,nothing,,\n")
    fields = dictionary.group_fields(dictionary.read_dictionary(spark, str(path)))
    own = dictionary.record_dictionary(fields, "h")
    assert own["titles"]["subfields"] == {"_": "text", "l": "language"} and own["titles"]["is_multi_val"] and own["volume"]["tag"] == "v031" and own["nothing"]["tag"] == "v000"
    assert fields.filter("record = 'record'").count() == 1
    df = spark.createDataFrame([({"v012": [{"_": "t", "l": "en"}], "v031": [{"_": "7"}]},)], f"record {isis.RECORD_TYPE}")
    row = df.select(*projection("record", own)).first()
    assert row.titles == [{"text": "t", "language": "en"}] and row.volume == "7" and row.nothing is None


def test_entities(spark, dump):
    docs = entities.documents(isis.read_isis(spark, str(dump)).filter("grp = 2"))
    d = docs.first()
    assert d.original_title == "First" and d.title_by_language == {"pt": "Segundo"} and d.complete_publication_date == "2019-03-15" and d.start_page == "10"
    c = entities.citations(docs).first()
    assert (c.publication_type, c.source, c.start_page, c.end_page, c.iso_date, c.ref_id) == ("journal", "Source", "5", "9", "2001", "B1")
    assert [(r.n, r.affiliation["orgname"]) for r in entities.authors_with_affiliations(docs).collect()] == [(0, "Univ")]


def test_stream_of_dumps(spark, dump, tmp_path):
    query = dumps.run(spark, str(dump), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 4 and dumps.latest(rows).count() == 3


def test_file_scans(spark, tmp_path):
    for name in ("translation/aa/v1n1/en_a01.htm", "translation/aa/v1n1/en_ba01.htm", "pdf/aa/v1n1/a01.pdf", "pdf/aa/v1n1/es_a01.pdf"):
        p = tmp_path / "bases" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes("<p>é <o:p>x</o:p></p>".encode("latin-1"))
    folder = files.IssueFolder(spark, str(tmp_path / "bases"), str(tmp_path / "htdocs"), "aa", "v1n1")
    found = {(r.type, r.name, r.key, r.lang, r.part) for r in folder.files().filter("error IS NULL").collect()}
    assert found == {("html", "en_a01.htm", "a01", "en", "before"), ("html", "en_ba01.htm", "a01", "en", "after"), ("pdf", "a01.pdf", "a01", None, None), ("pdf", "es_a01.pdf", "a01", "es", None)}
    assert folder.files().filter("error IS NOT NULL").count() == 2 and "é" in folder.translations().first().html
    archive = sinks.zip_files([tmp_path / "bases/pdf/aa/v1n1/a01.pdf"], tmp_path / "z/x.zip")
    assert archive.stat().st_size > 0
    with pytest.raises(ValueError):
        files.SitePaths("b", "w", "s").paragraphs("short")


def test_embedding_closure_ends_on_cycles(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "page string, linked string")
    assert {(r.page, r.embedded, r.depth) for r in files.embedding_closure(df).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("b", "a", 2), ("c", "a", 1), ("c", "b", 2)}


def numbered(spark, lines, chunk_bits, monkeypatch):
    from folioframe.operators import runs

    monkeypatch.setattr(runs, "CHUNK_BITS", chunk_bits)
    df = spark.createDataFrame([("a", n, x) for n, x in enumerate(lines)] + [("b", n, x) for n, x in enumerate(lines[7:])], "path string, n int, line string")
    return isis.number_records(df)


@pytest.mark.parametrize("chunk_bits", [0, 1, 3, 17])
def test_totals_and_runs_over_chunks(spark, monkeypatch, chunk_bits):
    """Numbering is the same however the order is cut into chunks."""
    rng = random.Random(chunk_bits)
    lines = [rng.choice(["!ID 1", "!v010!x", "more", ""]) for _ in range(60)]
    for path, own in (("a", lines), ("b", lines[7:])):
        rec = field = 0
        wanted = []
        for n, x in enumerate(own):
            rec += x.startswith("!ID ")
            field += x.startswith(("!v", "!ID "))
            wanted.append((n, rec, field))
        got = numbered(spark, lines, chunk_bits, monkeypatch).filter(F.col("path") == path).select("n", "rec", "field").collect()
        assert sorted(map(tuple, got)) == wanted
    keys = [rng.choice(["x", "y", None]) for _ in range(60)]
    runs_of = isis.run_length_groups(spark.createDataFrame([("a", n, k) for n, k in enumerate(keys)], "path string, rec int, k string"), "k", "rec")
    grp, wanted = 0, []
    for n, k in enumerate(keys):
        grp += n == 0 or keys[n - 1] != k
        wanted.append((n, grp))
    assert sorted((r.rec, r.grp) for r in runs_of.collect()) == wanted


def test_a_large_dump_is_read_in_blocks(spark, tmp_path):
    text = "".join(f"!ID {i}\r\n!v706!o\n!v012!é{i}\n\nmore\n" for i in range(3000))
    (tmp_path / "big.id").write_bytes(text.encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = isis.read_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = [r.line for r in rows.orderBy("n").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == text.replace("\r\n", "\n").split("\n")[:-1]
    assert [r.n for r in rows.select("n").orderBy("n").collect()] == list(range(len(got)))


def test_only_the_latest_issue_before_a_document(spark):
    one = lambda v: [{"v000": [{"_": v}]}]
    rows = [("d", 1, "i1", "issue", None, one("1")), ("d", 2, "x", "doc", "i1", one("x")), ("d", 3, "i1", "issue", None, one("3")), ("d", 4, "y", "doc", "i1", one("y")), ("d", 5, "z", "doc", "i2", one("z")), ("d", 6, "i2", "issue", None, one("6")), ("d", 7, "w", "invalid", None, one("w")), ("e", 1, "q", "doc", "i1", one("q"))]
    df = spark.createDataFrame(rows, f"path string, grp long, pid string, kind string, i_id string, records array<{isis.RECORD_TYPE}>")
    got = {r.pid: (r.issue_pid, r.issue_records and r.issue_records[0]["v000"][0]["_"]) for r in isis.join_issues_seen(df).collect()}
    assert got == {"x": ("i1", "1"), "y": ("i1", "3"), "z": (None, None), "w": (None, None), "q": (None, None)}


def test_the_first_source_with_rows(spark, dump, tmp_path):
    (tmp_path / "empty.id").write_bytes(b"")
    found = files.read_first(spark, [str(tmp_path / "none.id"), str(tmp_path / "empty.id"), str(dump / "a.id")])
    assert found.count() == 4 and files.read_first(spark, [str(tmp_path / "none.id")]).count() == 0
    site = files.SitePaths("b", "w", "s")
    assert site.document_sources("aa", "v1") == ["s/aa/v1/base_xml/id/i.id", "s/aa/v1/base_xml/id/*.id", "w/aa/aa_v1.id", "s/aa/v1/base/v1.id", "w/aa/aa.id"]
    assert site.document_sources("aa", "v1", order=files.FILES_ORDER)[2] == "w/aa/aa.id" and site.document_sources("aa") == ["w/aa/aa.id"]


def test_closure_of_a_dense_graph(spark):
    """Every page links to the next five of sixty in a ring: paths are without number, pairs are not."""
    df = spark.createDataFrame([(f"p{i}", f"p{(i + d) % 60}") for i in range(60) for d in range(1, 6)], "page string, linked string")
    got = {(r.page, r.embedded): r.depth for r in files.embedding_closure(df).collect()}
    assert got == {(f"p{i}", f"p{(i + d) % 60}"): -(-d // 5) for i in range(60) for d in range(1, 60)}


def test_zip_contents_and_alternative_assets(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a.xml", "<a/>")
        z.writestr("b.txt", "b")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    spark.udtf.register("zip_contents", files.ZipContents)
    spark.read.format("binaryFile").load(str(tmp_path)).createOrReplaceTempView("_zips")
    assert [(r.member, bytes(r.content)) for r in spark.sql("SELECT t.* FROM _zips, LATERAL zip_contents(content, 'a.xml') t").collect()] == [("a.xml", b"<a/>")]
    assert spark.sql("SELECT t.* FROM _zips, LATERAL zip_contents(content) t").count() == 2
    for name in ("img/fbpe/x/aa/v1/f.gif", "fbpe/aa/v1/sub/g.gif", "fbpe/aa/v2/h.gif", "other/aa/v1/i.gif"):
        p = tmp_path / "site" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    assert {r.name for r in files.alternative_assets(spark, str(tmp_path / "site"), "aa", "v1").collect()} == {"f.gif", "g.gif"}


def test_small_sinks(spark, tmp_path):
    from datetime import datetime

    assert sinks.dated_name(datetime(2021, 8, 11, 17, 54, 50, 556715)) == "2021-08-11T175450.556715"
    made = sinks.temporary_file("x.txt", "é")
    assert made.name == "x.txt" and made.read_text("utf-8") == "é"
    (tmp_path / "f/g").mkdir(parents=True)
    assert sinks.delete_folder(spark, str(tmp_path / "f")) and not (tmp_path / "f").exists() and not sinks.delete_folder(spark, str(tmp_path / "f"))
    (tmp_path / "d.csv").write_text("h,12,_,text,,,titles,Titles,x\n")
    dictionary.main([str(tmp_path / "d.csv"), str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out")).first().field_name == "titles"
