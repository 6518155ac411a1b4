"""Registered queries over the typed views of records: whole journals, issues, documents and citations, field by field.

A record is spelled from a key of the driver's tables: most fields hold their tag and the key, so the SQL can say what every
attribute of the entity must be. Fields that others derive from are spelled by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import fields, lookups
from folioframe.functions import text as tx
from folioframe.operators import entities, paragraphs
from folioframe.plans.catalogue import _pages, _table, query
from folioframe.plans.dictionary import group_tags
from folioframe.sources import isis

Occurrences = list[dict[str, Column]]


def _listed(names: str) -> list[tuple[str, str, bool]]:
    """(name, tag, many) of ``name=tag`` and, for repeated fields, ``name=tag*``."""
    pairs = (x.split("=") for x in names.split())
    return [(name, tag.rstrip("*"), tag.endswith("*")) for name, tag in pairs]


def _texts(names: str, key: Column) -> dict[str, Column]:
    """Occurrences with the text ``tag-key``; repeated fields have a second one that ends in b."""
    one = lambda v: F.create_map(F.lit("_"), v)
    out = {}
    for _, tag, many in _listed(names):
        text = F.concat(F.lit(f"{tag}-"), key)
        out[tag] = F.array(one(text), one(F.concat(text, F.lit("b")))) if many else F.array(one(text))
    return out


def _occ(*items: dict[str, Column | str]) -> Column:
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.array(*[F.create_map(*[x for k, v in item.items() for x in (F.lit(k), value(v))]) for item in items])


def _record(occurrences: dict[str, Column]) -> Column:
    return F.create_map(*[x for tag, occ in occurrences.items() for x in (F.lit(f"v{tag}"), occ)])


def _shown(names: str) -> list[Column]:
    return [F.array_join(name, "|").alias(name) if many else F.col(name) for name, _, many in _listed(names)]


def _shown_sql(names: str, key: str) -> str:
    return ", ".join(f"'{tag}-' || {key}" + (f" || '|{tag}-' || {key} || 'b'" if many else "") + f" AS {name}" for name, tag, many in _listed(names))


# ---- journals ----------------------------------------------------------------------------------

# Attributes of a journal that are the text of a field, and their tags.
JOURNAL_TEXTS = """
cnn_code=020 secs_code=037 current_status=050 copyright_holder=062 publisher_address=063* publisher_email=064 acronym=068 institutional_url=069
controlled_vocabulary=085 title=100 subtitle=110 editorial_standard=117 sponsors=140* abbreviated_title=150 abbreviated_iso_title=151 parallel_titles=230*
other_titles=240* first_year=301 first_volume=302 first_number=303 last_year=304 last_volume=305 last_number=306 publisher_country=310 publisher_state=320
publication_level=330 languages=350* abstract_languages=360* periodicity=380 issn_id=400 title_nlm=421 subject_descriptors=440* subject_areas=441*
index_coverage=450* publisher_name=480* publisher_city=490 license_code=541 previous_title=610 domain=690 submission_url=692 publishing_model=699 next_title=710
is_indexed_in_ssci=852 is_indexed_in_ahci=853 wos_subject_areas=854* current_issn=935 creation_date=940 update_date=941 collection_acronym=992
"""


@query(f"""
WITH c AS (SELECT c_custkey AS key, CAST(c_custkey AS VARCHAR) AS k FROM customer)
SELECT key, {_shown_sql(JOURNAL_TEXTS, 'k')},
    CASE WHEN key % 2 = 0 THEN 'p' || k WHEN key % 3 = 0 THEN '935-' || k END AS print_issn, CASE WHEN key % 2 = 0 THEN 'e' || k END AS electronic_issn,
    CAST(CASE key % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS INTEGER) AS n_events, CASE key % 3 WHEN 1 THEN 'D' END AS unpublish_reason,
    '480-' || k || '; 480-' || k || 'b' AS publisher_names, '490-' || k || ', 320-' || k AS publisher_loc,
    'one ' || k || chr(10) || 'two' AS mission_en, 'drei' || chr(10) || 'last' AS mission_de FROM c
""")
def journal_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as journals: each field, the ISSNs, the status history, publisher and mission."""
    key, k = F.col("c_custkey"), F.col("c_custkey").cast("string")
    history = (
        F.when(key % 3 == 0, _occ({"a": "20000101", "b": "C"}))
        .when(key % 3 == 1, _occ({"a": "20000101", "b": "C", "c": "20100101", "d": "D"}))
        .otherwise(_occ({"a": "20020101", "b": "C"}, {"a": "19990101", "b": "C", "c": "20010101", "d": "S"}))
    )
    more = {
        "035": _occ({"_": F.when(key % 3 == 0, "PRINT").otherwise("OTHER")}),
        "051": history,
        "435": F.when(key % 2 == 0, _occ({"_": F.concat(F.lit("p"), k), "t": "PRINT"}, {"_": F.concat(F.lit("e"), k), "t": "ONLIN"})).otherwise(F.array().cast("array<map<string,string>>")),
        "901": _occ({"_": F.concat(F.lit("one "), k)}, {"_": "two", "l": "en"}, {"_": "drei", "l": "de"}, {"_": "last"}),
    }
    rows = _table(spark, sf_dir, "customer").select(key.alias("key"), _record(_texts(JOURNAL_TEXTS, k) | more).alias("record"))
    j = entities.journals(rows)
    return j.select(
        "key", *_shown(JOURNAL_TEXTS), "print_issn", "electronic_issn", F.size("status_events").alias("n_events"), "unpublish_reason", "publisher_names", "publisher_loc",
        F.col("mission")["en"].alias("mission_en"), F.col("mission")["de"].alias("mission_de"),
    )


# ---- issues ------------------------------------------------------------------------------------

# Attributes of an issue that are the text of a field, and their tags.
ISSUE_TEXTS = """
journal=035 assets_code=004 titles=033 bibliographic_legends=043 controlled_vocabulary=085 update_date=091 creation_date=093 editorial_standard=117
total_documents=122 is_marked_up=200 license_code=541 domain=690 publisher_id=880 collection_acronym=992
"""


def _issue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, k = F.col("p_partkey"), F.col("p_partkey").cast("string")
    own = lambda when, value: F.when(when, _occ({"_": value})).otherwise(F.array().cast("array<map<string,string>>"))
    more = {
        "031": own(key % 7 > 0, (key % 7).cast("string")),
        "032": own(key % 5 < 4, F.when(key % 5 == 0, "ahead").when(key % 5 == 1, "review").otherwise(k)),
        "036": _occ({"_": F.concat(F.lit("2019"), (key % 20000).cast("string"))}),
        "041": own(key % 11 == 0, F.lit("yes")),
        "043": _occ({"_": F.concat(F.lit("043-"), k), "m": "jan/mar", "l": "en"}, {"m": "ene/mar", "l": "es"}),
        "049": _occ({"l": "en", "c": F.concat(F.lit("c"), (key % 3).cast("string")), "t": F.concat(F.lit("en"), k)}, {"l": "es", "c": F.concat(F.lit("c"), (key % 3).cast("string")), "t": F.concat(F.lit("es"), k)}),
        "065": _occ({"_": "20190300"}),
        "131": own(key % 3 == 0, F.lit("1")),
        "132": own(key % 4 == 0, F.lit("2")),
        "540": _occ({"t": "<p>first</p>", "l": "en"}, {"t": F.concat(F.lit("<p>"), k, F.lit("</p>")), "l": "en"}, {"t": "", "l": "es"}, {"l": "pt"}),
    }
    return _table(spark, sf_dir, "part").select(key.alias("key"), _record(_texts(ISSUE_TEXTS.replace("bibliographic_legends=043", ""), k) | more).alias("record"))


_ISSUES = """
WITH p AS (SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) AS k, CAST(p_partkey % 20000 AS VARCHAR) AS o FROM part),
i AS (
    SELECT *, CASE WHEN key % 7 > 0 THEN CAST(key % 7 AS VARCHAR) END AS volume, CASE key % 5 WHEN 0 THEN 'ahead' WHEN 1 THEN 'review' WHEN 4 THEN NULL ELSE k END AS number,
        CASE WHEN key % 3 = 0 THEN '1' END AS sv, CASE WHEN key % 4 = 0 THEN '2' END AS sn, CASE WHEN key % 11 = 0 THEN 'pr' ELSE '' END AS pr,
        '2019' || CASE WHEN length(o) < 4 THEN lpad(o, 4, '0') ELSE o END AS issue_order FROM p)
"""


@query(f"""{_ISSUES}
SELECT key, {_shown_sql(ISSUE_TEXTS, 'k')}, volume, number, coalesce(sv, sn) AS supplement, '2019' AS publication_year, issue_order, '035-' || k || issue_order AS pid,
    CASE WHEN key % 5 < 2 THEN '2019n' || number || pr ELSE coalesce('v' || volume, '') || coalesce('n' || number, '') || coalesce('s' || coalesce(sv, sn), '') || pr END AS issue_label,
    'jan' AS start_month_text, 'mar' AS end_month_text, 'en' AS license_languages, '<p>' || k || '</p>' AS license_en FROM i
""")
def issue_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as issues: each field, the label, the pid, months and licenses."""
    i = entities.issues(_issue_records(spark, sf_dir))
    return i.select(
        "key", *_shown(ISSUE_TEXTS), "volume", "number", "supplement", "publication_year", "issue_order", "pid", "issue_label", "start_month_text", "end_month_text",
        F.array_join(F.map_keys("license_by_language"), ",").alias("license_languages"), F.col("license_by_language")["en"].alias("license_en"),
    )


@query(f"""{_ISSUES}
SELECT l_orderkey, l_linenumber, l_partkey, 'en' || l_partkey AS en, 'es' || l_partkey AS es FROM lineitem LEFT JOIN i ON l_partkey = key WHERE l_linenumber % 4 = l_partkey % 3
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, NULL, NULL FROM lineitem WHERE l_linenumber % 4 <> l_partkey % 3
""")
def section_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as documents of issues: the titles of their section in their issue, if it has that section."""
    sections = entities.sections_by_code(entities.issue_sections(entities.issues(_issue_records(spark, sf_dir)).withColumn("pid", F.lpad(F.col("key").cast("string"), 17, "0"))))
    docs = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("S"), F.lpad(F.col("l_partkey").cast("string"), 17, "0"), F.lit("00001")).alias("pid"),
        F.concat(F.lit("c"), (F.col("l_linenumber") % 4).cast("string")).alias("section_code"),
    )
    met = entities.with_section_titles(docs, sections)
    return met.select("l_orderkey", "l_linenumber", "l_partkey", F.col("section_titles")["en"].alias("en"), F.col("section_titles")["es"].alias("es"))


# ---- documents and citations -------------------------------------------------------------------

# Attributes of a document that are the text of a field, and their tags.
DOCUMENT_TEXTS = """
assets_code=004 corporative_authors=011* journal_id=035 illustrative_material=038* original_language=040 section_code=049 thesis_degree=051
thesis_organization=052 project_sponsor=058* project_name=059* contract=060* document_type=071 update_date=091 creation_date=093 receive_date_iso=112
acceptance_date_iso=114 review_date_iso=116 data_model_version=120 internal_sequence_id=121 doi=237 license_code=541 languages=601* domain=690 pid_v2=880 aop_pid=881
pid_v3=885 collection_acronym=992
"""

# Attributes of a citation that are the text of a field, and their tags.
CITATION_TEXTS = """
tome=022 issue_title=033 issue_part=034 issn=035 thesis_date=044 thesis_country=047 thesis_degree=051 conference_date=054 conference_country=057
project_name=059 project_number=060 notes=061* publisher_name=062 edition=063 year=064 publisher_country=067 isbn=069 version=095 access_date=109 label=118 doi=237
pmid=238 pmcid=239 index_number=701 paragraph_text=704 etal=810
"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_groups(_table(spark, sf_dir, "part"), F.col("p_partkey").cast("string"))


def _document_groups(parts: DataFrame, pid: Column) -> DataFrame:
    """Parts as document groups: a record of type o, one of type f, two citations and three paragraphs."""
    key, k = F.col("p_partkey"), F.col("p_partkey").cast("string")
    kind = lambda t: {"706": _occ({"_": t})}
    with_key = lambda t: F.concat(F.lit(t), k)
    front = kind("f") | _texts(DOCUMENT_TEXTS, k) | {
        "002": _occ({"_": F.lpad(k, 23, "0")}),
        "010": _occ({"n": "Ana", "s": with_key("Silva"), "1": "a1 a2", "r": "ed"}, {"n": "Bo", "s": "Cruz"}),
        "012": _occ({"_": with_key("title "), "l": "en"}, {"_": "titulo", "l": "es"}, {"_": with_key("titulo "), "l": "es"}),
        "014": _occ({"f": F.when(key % 2 == 0, k).otherwise(""), "l": "99", "e": with_key("e")}),
        "031": _occ({"_": "7"}),
        "032": _occ({"_": "2"}),
        "065": _occ({"_": "20190300"}),
        "070": _occ({"i": "a1", "_": with_key("Univ "), "d": "Div", "p": "Brasil"}, {"i": "a3", "o": "Other"}),
        "083": _occ({"a": with_key("abstract "), "l": "en"}, {"a": with_key("resumen "), "l": "es"}),
        "085": _occ({"k": "one", "l": "en"}, {"k": "two", "s": k, "l": "en"}, {"k": "lost"}, {"k": "tres", "l": "es"}),
        "132": _occ({"_": "3"}),
        "223": _occ({"_": F.when(key % 3 == 0, "20180000").otherwise("")}),
        "702": _occ({"_": F.concat(F.lit("c:\\dir\\"), k, F.when(key % 2 == 0, ".xml").otherwise(".htm"))}),
    }
    front["091"], front["093"] = _occ({"_": "20200510"}), F.when(key % 4 == 0, _occ({"_": "20170230"})).otherwise(_occ({"_": ""}))
    cited = kind("c") | _texts(CITATION_TEXTS, k)
    journal = cited | {
        "010": _occ({"n": "Eva", "s": with_key("Lopes")}),
        "011": _occ({"_": "Org", "d": k}),
        "012": _occ({"_": with_key("cited "), "l": "en"}),
        "014": _occ({"_": F.when(key % 2 == 0, "5-9").otherwise("7"), "e": "e1"}),
        "030": _occ({"_": with_key("journal ")}),
        "031": F.when(key % 2 == 0, _occ({"_": "8"})).otherwise(_occ({"_": ""})),
        "032": _occ({"n": "4", "s": "1"}),
        "065": _occ({"_": F.when(key % 2 == 0, "20010300").otherwise("20011341")}),
    }
    thesis = cited | {
        "018": _occ({"_": with_key("monograph ")}),
        "045": _occ({"_": "19991231"}),
        "050": _occ({"_": "Univ", "d": k}),
        "066": _occ({"_": "City", "e": "State"}),
        "514": _occ({"f": "11", "l": "12"}),
    }
    paragraph = lambda text, ref: kind("p") | {"704": _occ({"_": text}), "888": _occ({"_": ref})}
    records = [kind("o") | {"091": _occ({"_": "20210101"})}, front, journal, thesis, paragraph("before", F.lit("")), paragraph(with_key("ref "), k), paragraph("after", F.lit("")), kind("x")]
    return parts.select(F.lit("dump").alias("path"), key.alias("grp"), pid.alias("pid"), F.array(*[_record(r) for r in records]).alias("records"))


def _without(names: str, *gone: str) -> str:
    return " ".join(x for x in names.split() if x.split("=")[0] not in gone)


_DOCUMENT_SHOWN = _without(DOCUMENT_TEXTS, "update_date", "creation_date")
_CITATION_SHOWN = _without(CITATION_TEXTS, "notes")


@query(f"""
WITH p AS (SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) AS k FROM part)
SELECT key, {_shown_sql(_DOCUMENT_SHOWN, 'k')}, '20210101' AS processing_date, '3' AS supplement, lpad(k, 23, '0') AS pid_v1, 'title ' || k AS original_title, 'titulo ' || k AS title_es,
    CAST(2 AS INTEGER) AS n_translated, 'abstract ' || k AS original_abstract, 'resumen ' || k AS abstract_es, 'one|two, ' || k AS keywords_en, 'tres' AS keywords_es,
    'v7n2s3' AS issue_folder, 'c:/dir/' || k || CASE WHEN key % 2 = 0 THEN '.xml' ELSE '.htm' END AS file_path, k || CASE WHEN key % 2 = 0 THEN '.xml' ELSE '.htm' END AS filename,
    CASE WHEN key % 2 = 0 THEN 'xml' ELSE 'html' END AS file_type, k AS filename_without_extension, CASE WHEN key % 2 = 0 THEN k END AS start_page, '99' AS end_page, 'e' || k AS elocation,
    CASE WHEN key % 3 = 0 THEN '2018-06-15' WHEN key % 4 = 0 THEN NULL ELSE '2020-05-10' END AS complete_publication_date, 'Silva' || k AS surname, 'Univ ' || k AS orgname, 'Div' AS div1 FROM p
""")
def document_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents: each field, titles, abstracts and keywords by language, file, pages, date."""
    d = entities.documents(_documents(spark, sf_dir))
    plain = ["original_title", "original_abstract", "issue_folder", "file_path", "filename", "file_type", "filename_without_extension", "start_page", "end_page", "elocation", "complete_publication_date"]
    return d.select(
        F.col("grp").alias("key"), *_shown(_DOCUMENT_SHOWN), "processing_date", "supplement", "pid_v1", *plain, F.col("title_by_language")["es"].alias("title_es"),
        F.size("translated_titles").alias("n_translated"), F.col("abstract_by_language")["es"].alias("abstract_es"), F.array_join(F.col("keyword_groups")["en"], "|").alias("keywords_en"),
        F.array_join(F.col("keyword_groups")["es"], "|").alias("keywords_es"), F.col("authors")[0]["surname"].alias("surname"), F.col("affiliations")[0]["orgname"].alias("orgname"),
        F.col("affiliations")[0]["div1"].alias("div1"),
    )


@query(f"""
WITH p AS (SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) AS k FROM part),
j AS (
    SELECT key, CAST(0 AS INTEGER) AS n, {_shown_sql(_CITATION_SHOWN, 'k')}, '061-' || k || ' | 061-' || k || 'b' AS comment, 'B701-' || k AS ref_id, '022-' || k AS v, 'thesis' AS publication_type,
        'journal ' || k AS source, 'cited ' || k AS article_title_text, CASE WHEN key % 2 = 0 THEN '20010300' ELSE '20011341' END AS publication_date, CASE WHEN key % 2 = 0 THEN '5' ELSE '7' END AS start_page,
        CASE WHEN key % 2 = 0 THEN '9' END AS end_page, 'e1' AS elocation, CASE WHEN key % 2 = 0 THEN '5-9' ELSE '7' END AS page_range, '4' AS issue_number, '1' AS supplement,
        CASE WHEN key % 2 = 0 THEN '8' ELSE '022-' || k END AS volume_text, NULL AS thesis_institution, '067-' || k AS publisher_address, CASE WHEN key % 2 = 0 THEN '2001-3' ELSE '2001' END AS iso_date,
        'Org, ' || k AS institutions, 'Lopes' || k AS first_surname FROM p),
t AS (
    SELECT key, CAST(1 AS INTEGER) AS n, {_shown_sql(_CITATION_SHOWN, 'k')}, '061-' || k || ' | 061-' || k || 'b' AS comment, 'B701-' || k AS ref_id, '022-' || k AS v, 'thesis' AS publication_type,
        'monograph ' || k AS source, NULL AS article_title_text, '19991231' AS publication_date, '11' AS start_page, '12' AS end_page, NULL AS elocation, NULL AS page_range, NULL AS issue_number,
        NULL AS supplement, '022-' || k AS volume_text, 'Univ, ' || k AS thesis_institution, 'City, State, 067-' || k AS publisher_address, '1999-12-31' AS iso_date, 'Univ, ' || k AS institutions,
        NULL AS first_surname FROM p)
SELECT * EXCLUDE (v) FROM j UNION ALL SELECT * EXCLUDE (v) FROM t
""")
def citation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The citations of the documents: each field, and what derives from them."""
    c = entities.citations(entities.documents(_documents(spark, sf_dir)))
    plain = [
        "comment", "ref_id", "publication_type", "source", "article_title_text", "publication_date", "start_page", "end_page", "elocation", "page_range", "issue_number", "supplement", "volume_text",
        "thesis_institution", "publisher_address", "iso_date",
    ]
    first = F.from_json("first_author", "map<string,string>")["surname"]
    return c.select(F.col("grp").alias("key"), "n", *_shown(_CITATION_SHOWN), *plain, F.array_join("institutions", "; ").alias("institutions"), first.alias("first_surname"))


@query("""
SELECT p_partkey AS key, 'before' AS before, 'ref ' || p_partkey AS refs, 'after' AS after, 'B' || p_partkey AS ref_ids FROM part
""")
def paragraph_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraphs of the documents: the texts around the references, and the references with their ids."""
    rows = entities.paragraphs(entities.documents(_documents(spark, sf_dir)))
    parts = paragraphs.part_texts(rows).select("pid", "before", F.array_join(F.transform("refs", lambda r: r["text"]), "|").alias("refs"), "after")
    ids = paragraphs.reference_ids(paragraphs.split_parts(rows).filter("part = 'references'")).groupBy("pid").agg(F.array_join(F.array_sort(F.collect_list("ref_id")), "|").alias("ref_ids"))
    return parts.join(ids, "pid").select(F.col("pid").cast("long").alias("key"), "before", "refs", "after", "ref_ids")


@query("""
WITH d AS (SELECT p_partkey AS key, p_size, lpad(CAST(p_partkey AS VARCHAR), 17, '0') AS issue FROM part),
own AS (SELECT key, 'en' AS language, 'http://l/' || key AS url, 'text ' || key AS text FROM d WHERE key % 3 = 0),
coded AS (SELECT key, unnest(['en', 'es', 'pt']), 'https://creativecommons.org/licenses/by-nc/4.0/', NULL FROM d WHERE key % 3 = 1),
inherited AS (SELECT key, unnest(['en', 'es']), 'https://creativecommons.org/licenses/by', unnest(['open ' || key, 'abierto']) FROM d WHERE key % 3 = 2 AND key % 2 = 0)
SELECT * FROM own UNION ALL SELECT * FROM coded UNION ALL SELECT * FROM inherited
""")
def license_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents with a license text, with a license code, or with neither: those have their issue's, if it has any."""
    key, k = F.col("p_partkey"), F.col("p_partkey").cast("string")
    none = F.array().cast("array<map<string,string>>")
    html = F.concat(F.lit('<a href="http://l/'), k, F.lit('">text</a>  '), k)
    docs = _table(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), F.lpad(k, 17, "0"), F.lit("00001")).alias("pid"),
        F.when(key % 3 == 0, F.array(F.create_map(F.lit("language"), F.lit("en"), F.lit("html"), html))).otherwise(none).alias("license_html"),
        F.when(key % 3 == 1, "BY-NC").alias("license_code"),
    )
    issues = _table(spark, sf_dir, "part").filter(key % 2 == 0).select(
        F.lpad(k, 17, "0").alias("pid"), F.lit("BY").alias("license_code"),
        F.create_map(F.lit("en"), F.concat(F.lit("<p>open <i>"), k, F.lit("</i></p>")), F.lit("es"), F.lit("<p>abierto</p>")).alias("license_by_language"),
    )
    found = entities.license_texts(docs, issues)
    return found.select(F.substring("pid", 2, 17).cast("long").alias("key"), "language", "url", "text")


# ---- fields, dictionaries, pids ----------------------------------------------------------------


@query("""
SELECT n_nationkey, 'v' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS tag, n_name || CASE WHEN n_nationkey % 2 = 0 THEN 's' ELSE '' END AS field_name,
    CASE n_nationkey % 3 WHEN 0 THEN n_nationkey % 2 = 1 WHEN 1 THEN true ELSE false END AS is_single, n_nationkey % 4 = 0 AS is_composite FROM nation
""")
def dictionary_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as rows of the older data dictionary: single by flag, or by the field's name."""
    k = F.col("n_nationkey")
    rows = _table(spark, sf_dir, "nation").select(
        F.lit("h").alias("record"), k.cast("string").alias("tag"), F.concat(F.col("n_name"), F.when(k % 2 == 0, "s").otherwise("")).alias("field_name"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "True").otherwise("False").alias("single"), F.when(k % 4 == 0, "l").otherwise("").alias("subfield"), F.lit("").alias("subfield_name"),
        F.lit("").alias("description"), F.monotonically_increasing_id().alias("row"),
    )
    out = group_tags(rows)
    return out.select(F.substr("tag", F.lit(2)).cast("int").alias("n_nationkey"), "tag", "field_name", "is_single", "is_composite")


@query("""
SELECT o_orderkey, o_orderpriority AS title, o_orderstatus AS language, CAST(2 AS INTEGER) AS n_raw, lower(o_orderpriority) AS raw_first, 'v012,v706' AS tags FROM orders
""")
def raw_and_full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record by a data dictionary, raw with a hook that cleans, and whole."""
    own = {"titles": {"tag": "v012", "subfields": {"_": "text", "l": "language"}, "is_multi_val": True, "is_composite": True}}
    record = _record({"012": _occ({"_": F.col("o_orderpriority"), "l": F.col("o_orderstatus")}, {"_": "second"}), "706": _occ({"_": "f"})})
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", record.alias("record"))
    raw = fields.raw_field("record", "v012", fix=F.lower)
    title = fields.projection("record", own)[0]
    return rows.select("o_orderkey", title[0]["text"].alias("title"), title[0]["language"].alias("language"), F.size(raw).alias("n_raw"), raw[0].alias("raw_first"), F.array_join(F.transform(fields.full_record("record"), lambda x: x["name"]), ",").alias("tags"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS updated, 'S' || lpad(CAST(o_orderkey AS VARCHAR), 22, '0') AS pid FROM orders WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19940101' AND '19961231'
""")
def changed_pids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of an index of changes: those between two dates."""
    pid = F.lpad(F.col("o_orderkey").cast("string"), 22, "0")
    lines = _table(spark, sf_dir, "orders").select(F.concat(F.lit("x OAITS="), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("^y="), pid).alias("line"))
    found = isis.changed_pids(lines, "19940101", "19961231")
    return found.select(F.substr("pid", F.lit(2)).cast("long").alias("o_orderkey"), "updated", "pid")


# ---- text --------------------------------------------------------------------------------------


@query(r"""
SELECT page_id, md5(regexp_replace(html, '[^0-9]', '', 'g')) AS digits_md5, md5(html) AS wrapped_md5, regexp_extract(url, '([^/]*)$', 1) AS base,
    CASE WHEN regexp_matches(regexp_extract(url, '([^/]*)$', 1), '.\.[^.]*$') THEN regexp_extract(url, '(\.[^.]*)$', 1) ELSE '' END AS extension FROM pages
""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits alone, pages that are HTML already left as they are, names and extensions of addresses."""
    html, url = F.col("html"), F.col("url")
    wrapped = F.when(F.lower(html).contains("<html"), tx.wrap_html(html)).otherwise(html)
    return _pages(spark, sf_dir).select("page_id", F.md5(tx.digits_only(html)).alias("digits_md5"), F.md5(wrapped).alias("wrapped_md5"), tx.base_name(url).alias("base"), tx.extension(url).alias("extension"))


@query("""
WITH b AS (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS b FROM pages),
c AS (SELECT *, b NOT LIKE '%<![%' AND b NOT LIKE '%<xml%' AND b NOT LIKE '%<?xml%' AND b NOT LIKE '%<o:%' AND b NOT LIKE '%<w:%' AND b NOT LIKE '%--%' AS clean FROM b)
SELECT page_id, CASE WHEN clean THEN md5(b) END AS comments_md5, CASE WHEN clean THEN md5('a' || b) END AS office_md5, md5(b || 'z') AS plain_md5,
       CASE WHEN clean THEN md5(b || '<!-- fine -->') END AS kept_md5 FROM c
""")
def comment_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without their own comments: invalid comments and office conditionals that are put around them go, valid comments stay until all go, and nothing else does."""
    base = tx.remove_comments(F.col("html"))
    clean = ~(base.contains("<![") | base.contains("<xml") | base.contains("<?xml") | base.contains("<o:") | base.contains("<w:") | base.contains("--"))
    invalid = tx.remove_invalid_comments(F.concat(F.lit("<!-- a -- b -->"), base, F.lit("<!-- x--y\nz -->")))
    office = tx.remove_office_conditionals(F.concat(F.lit("<!--[if gte mso 9]><xml>q</xml><![endif]-->a"), base, F.lit("<o:p></o:p><![if !vml]><![endif]>")))
    plain = tx.remove_comments(F.concat(F.lit("<!-- first -->"), F.col("html"), F.lit("<!-- fine\n-->z")))
    kept = tx.remove_invalid_comments(F.concat(base, F.lit("<!-- fine -->")))
    own = lambda c: F.when(clean, F.md5(c))
    return _pages(spark, sf_dir).select("page_id", own(invalid).alias("comments_md5"), own(office).alias("office_md5"), F.md5(plain).alias("plain_md5"), own(kept).alias("kept_md5"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '1234-567X' END AS issn, 'https://h/x/a.htm' AS link, 'x/' || doc_id || '.htm#p' AS swapped FROM documents
""")
def link_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISSN in an address, the link of a tag, and links replaced by a table of file names."""
    k = F.col("doc_id").cast("string")
    uri = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("http://h/1234-567X/"), k)).otherwise(F.concat(F.lit("http://h/12-567X/"), k))
    tag = F.lit('<a class="z" HREF=\'https://h/x/a.htm\'>')
    swapped = tx.replace_links(F.concat(F.lit('<a href="b/c.htm#p">'), k), F.create_map(F.lit("c.htm"), F.concat(F.lit("x/"), k, F.lit(".htm"))))
    return _table(spark, sf_dir, "documents").select("doc_id", tx.issn_of(uri).alias("issn"), tx.links(tag)[0]["link"].alias("link"), F.regexp_extract(swapped, 'href="([^"]*)"', 1).alias("swapped"))


@query(r"""
SELECT doc_id, md5(regexp_replace(strip_accents(lower(text)), '[^\p{L} ]', '', 'g')) AS letters_md5,
    md5(CASE WHEN regexp_matches(x, '^[A-Za-z_]') THEN x WHEN x = '' THEN 'id1' ELSE '_' || x END) AS id_md5, md5(replace(text, '&', '&amp;')) AS entities_md5
FROM (SELECT *, regexp_replace(strip_accents(text), '[^A-Za-z0-9_.\-]', '', 'g') AS x FROM documents WHERE text IS NOT NULL)
""")
def character_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as letters alone, as ids, and with their ampersands spelled and read back but for what stands for markup."""
    docs = _table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    text = F.col("text")
    back = tx.safe_unescape(F.replace(text, F.lit("&"), F.lit("&amp;")))
    return docs.select("doc_id", F.md5(tx.letters_only(text)).alias("letters_md5"), F.md5(tx.valid_id(text)).alias("id_md5"), F.md5(back).alias("entities_md5"))


@query(r"""
SELECT page_id, md5(replace(replace(trim(regexp_replace(html, '\s+', ' ', 'g')), '> ', '>'), ' <', '<')) AS md5 FROM pages
""")
def namespaced_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with a namespace, put around each page and into it, go; all others and all texts stay."""
    html = F.concat(F.lit("<o:p class='x'>"), "html", F.lit("</o:p><w:sdt/>"))
    bare = tx.remove_namespaced_tags(html)
    return _pages(spark, sf_dir).select("page_id", F.md5(F.replace(F.replace(tx.collapse_space(bare), F.lit("> "), F.lit(">")), F.lit(" <"), F.lit("<"))).alias("md5"))


@query("""
SELECT page_id, n_open, n_close, md5('x') AS rest_md5 FROM (
    SELECT page_id, count(*) FILTER (k = 0) AS n_open, count(*) FILTER (k = 1) AS n_close FROM (SELECT page_id, unnest([0, 1, 2]) AS k FROM pages) WHERE k < 2 OR page_id < 0 GROUP BY 1)
""")
def unpaired_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a line that opens a paragraph, one that closes one and one that does both, the first two are marked."""
    lines = F.lit("<p class='a'>one\ntwo</p>\n<p>three</p>")
    fixed = tx.avoid_mismatched_tags(lines)
    n = lambda kind: F.regexp_count(fixed, F.lit(f'<p type="{kind}"/>')).cast("long")
    rest = F.when(F.split(fixed, "\n")[2] == "<p>three</p>", "x")
    return _pages(spark, sf_dir).select("page_id", n("open").alias("n_open"), n("close").alias("n_close"), F.md5(rest).alias("rest_md5"))


@query("""
SELECT n_nationkey, n_name AS by_code, n_name AS by_name, substr(n_name, 1, 3) || n_nationkey AS code FROM nation
""")
def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as countries, looked up by code and by name, in a language and in none."""
    n = _table(spark, sf_dir, "nation")
    code = F.concat(F.substring("n_name", 1, 3), F.col("n_nationkey").cast("string"))
    table = n.select(code.alias("alpha_2_code"), F.lit("").alias("short_name_en"), F.col("n_name").alias("short_name_pt"), F.concat(F.lit("es "), "n_name").alias("short_name_es"))
    by_code = lookups.with_country(n.withColumn("c", code), table, "c").withColumnRenamed("country_name", "by_code").withColumnRenamed("country_code", "code")
    by_name = lookups.with_country(by_code.withColumn("c", F.concat(F.lit("es "), "n_name")), table, "c", "pt")
    return by_name.select("n_nationkey", "by_code", F.col("country_name").alias("by_name"), "code")


@query("""
WITH d AS (SELECT doc_id AS key, CAST(doc_id AS VARCHAR) AS k, doc_id % 9 AS v FROM documents)
SELECT key, CASE v WHEN 0 THEN 'patent' WHEN 1 THEN 'confproc' WHEN 2 THEN 'book' WHEN 3 THEN 'journal' WHEN 4 THEN 'webpage' WHEN 5 THEN 'data' WHEN 6 THEN 'thesis' WHEN 7 THEN 'book' END AS publication_type,
       CASE WHEN v IN (1, 3, 5, 0) THEN 'cited ' || k END AS article_title_text, CASE WHEN v = 2 THEN 'cited ' || k END AS chapter_title, CASE WHEN v = 5 THEN 'cited ' || k END AS data_title,
       CASE WHEN v IN (0, 2, 7) THEN 'monograph ' || k WHEN v = 3 THEN 'journal ' || k END AS source, CASE v WHEN 1 THEN '7 Meeting ' || k || '; Second' END AS conference_name,
       CASE WHEN v = 1 THEN 'Sponsor, Div' END AS conference_sponsor, CASE WHEN v = 0 THEN 'P' || k END AS patent_id, CASE WHEN v = 0 AND key % 2 = 0 THEN 'Brasil' END AS patent_country,
       CASE WHEN v = 0 THEN 'Office' END AS patent_organization, CASE v WHEN 0 THEN '20010203' WHEN 1 THEN '19980000' WHEN 4 THEN '20200510' WHEN 6 THEN '19991200' WHEN 3 THEN '2005' END AS publication_date,
       CASE v WHEN 0 THEN '2001-2-3' WHEN 1 THEN '1998' WHEN 4 THEN '2020-5-10' WHEN 6 THEN '1999-12' WHEN 3 THEN '2005' END AS iso_date, CASE WHEN v = 6 THEN 'Univ, ' || k END AS thesis_institution,
       CASE v WHEN 1 THEN 'Sponsor, Div' WHEN 6 THEN 'Univ, ' || k WHEN 7 THEN 'Group, West; Fund' ELSE '' END AS institutions FROM d
""")
def citation_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a citation of one of eight kinds, or of none: its type and the fields that depend on it."""
    key, k = F.col("doc_id"), F.col("doc_id").cast("string")
    with_key = lambda text: F.concat(F.lit(text), k)
    title, monograph = {"012": _occ({"_": with_key("cited ")})}, {"018": _occ({"_": with_key("monograph ")})}
    country = F.when(key % 2 == 0, "Brasil").otherwise("nd")
    variants = [
        title | monograph | {"150": _occ({"_": country, "a": with_key("P"), "b": "20010101", "c": "20010203", "d": "Office"})},
        title | {"053": _occ({"_": with_key("Meeting "), "n": "7"}, {"_": "Second"}), "052": _occ({"_": "Sponsor", "d": "Div"}), "055": _occ({"_": "19980000"})},
        title | monograph,
        title | {"030": _occ({"_": with_key("journal ")}), "065": _occ({"_": "2005"})},
        {"037": _occ({"_": with_key("http://h/")}), "110": _occ({"_": "20200510"})},
        title | {"071": _occ({"_": "data"})},
        {"051": _occ({"_": "Dr"}), "050": _occ({"_": "Univ", "d": k}), "045": _occ({"_": "19991200"})},
        monograph | {"017": _occ({"_": "Group", "d": "West"}), "058": _occ({"_": "Fund"})},
        {"706": _occ({"_": "c"})},
    ]
    record = F.coalesce(*[F.when(key % len(variants) == i, _record(v)) for i, v in enumerate(variants)])
    docs = _table(spark, sf_dir, "documents").select(F.lit("dump").alias("path"), key.alias("grp"), k.alias("pid"), F.array(record).alias("citations"))
    shown = ["publication_type", "article_title_text", "chapter_title", "data_title", "source", "conference_name", "conference_sponsor", "patent_id", "patent_country", "patent_organization", "publication_date", "iso_date", "thesis_institution"]
    return entities.citations(docs).select(F.col("grp").alias("key"), *shown, F.array_join("institutions", "; ").alias("institutions"))
