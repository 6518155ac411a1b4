"""Registered queries that classify every heading of the pages and every line of the documents.

The given texts hold hardly any words that tell a type, so each is put behind a beginning that does, or tells none, by its place. What each beginning is
stands here as a literal, in the tables that the SQL joins; no pattern of the library is part of an answer. Headings are the exception: their own words can
change the type, so their SQL tries the fixed patterns on the whole title, one by one, in DuckDB's own expression engine, and a test holds the literals against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import pattern_tables as T
from folioframe.functions import patterns
from folioframe.plans.catalogue import _pages, _table, query

#: Beginnings of titles, and where such a title stands.
PARENTS = [
    ("Abstract of", "abstract"), ("RESUMEN:", "abstract"), ("Tradução do", "trans-abstract"), ("Introducción a", "sec"), ("Materials and methods of", "sec"), ("Resultados:", "sec"), ("Referências:", "ref-list"),
    ("Citation:", "ref-list"), ("Acknowledgments,", "ack"), ("Apêndice", "app"), ("Material suplementar", "supplementary-material"), ("Notas", "fn-group"), ("Footnote", "fn-group"), ("Author notes", "author-notes"),
    ("Biografia", "bio"), ("Palavras-chave:", "kwd-group"), ("Glossary", "glossary"), ("Definição", "def-list"), ("Figure", "caption"), ("Tabela", "caption"), ("Leyenda", "legend"), ("2.1 Zone", "sec"), ("Zone", None),
]
#: Beginnings of footnotes and their types. A single letter at the beginning counts as a number, so words without a number lose theirs, also behind a symbol.
FOOTNOTES = [
    ("1. Conflict of interest", "coi-statement"), ("* Corresponding author", "corresp"), ("† zone", "deceased"), ("[2] Funded by", "supported-by"), ("(a) Submitted by", "com"), ("3 Eingereicht durch", "com"),
    ("4. Abbreviations", "abbr"), ("5 Current address", "current-aff"), ("(b) Presented at", "presented-at"), ("6 Équipe de recherche", "participating-researchers"), ("#Equal contribution", "equal"),
    ("[7] Grupo de estudio", "study-group-members"), ("8. Zusätzliche Information", "supplementary-material"), ("9 Editor", "edited-by"), ("10. Sabbatical", "on-leave"), ("11 Formerly", "previously-at"),
    ("12. Divulgação financeira", "financial-disclosure"), ("(c) Author contributions", "con"), ("13 No conflict", "conflict"), ("§ zone", "present-address"), ("¶ zone", "other"), ("‡Presented by", "equal"), ("16 Presented by", "presented-by"), ("§ 17 Falecido", "deceased"),
    ("14 Jetzt bei", "present-address"), ("Abbreviations", None), ("15 Zone", None),
]
#: Words, their types as labels and as ids.
LABELS = [
    ("Figure", "fig", None), ("Figs.", "fig", None), ("Tabela", "table", None), ("Eq.", "disp-formula", None), ("Footnote", "fn", None), ("Section", "sec", None), ("Appendix", "app", None), ("Box", "boxed-text", None),
    ("Affiliation", "aff", None), ("Corresp.", "corresp", None), ("Author", "contrib", None), ("Lista", "list", None), ("Image", "graphic", None), ("Video", "media", None), ("f1", None, "fig"), ("T12", None, "table"),
    ("B3", None, "bibr"), ("aff2", "aff", "aff"), ("app1", "app", "app"), ("c4", None, "corresp"), ("e5", None, "disp-formula"), ("gf6", None, "graphic"), ("suppl7", "supplementary-material", "supplementary-material"),
    ("m8", None, "math"), ("fnA", None, "fn"), ("anf1", None, "author-notes-fn"), ("TFN2", None, "table-fn"), ("md3", None, "media"), ("r4", None, "related-article"), ("vs5", None, "visual-abstract"), ("sec6", "sec", "sec"),
    ("S8", "supplementary-material", "sub-article"), ("box9", "boxed-text", "boxed-text"), ("contrib1", None, "contrib"), ("cuadro3", "table", "table"), ("3", "number", None), ("zone", None, None),
]
#: Section titles and their types.
SECTIONS = [
    ("Introduction", "intro"), ("Materials and methods", "materials|methods"), ("Métodos", "methods"), ("Resultados e discussão", "results|discussion"), ("Ergebnisse und Diskussion", "results|discussion"),
    ("Conclusions and future perspectives", "conclusions"), ("Case reports", "cases"), ("Cases and results", "cases|results"), ("Participants", "subjects"), ("Data availability", "data-availability"),
    ("Supplementary material", "supplementary-material"), ("Transcript of zone", "transcript"), ("Methods and findings", "methods|results"), ("Discussion and conclusions", "discussion|conclusions"),
    ("Interpretation", "discussion"), ("Findings", "results"), ("Zone", None),
]


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    one = lambda v: "CAST(NULL AS VARCHAR)" if v is None else _lit(v)
    return "(VALUES " + ", ".join(f"({i}, {', '.join(map(one, row))})" for i, row in enumerate(rows)) + ")"


def _planted(rows: list[tuple], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(row[0]) for row in rows]), (F.pmod(place, F.lit(len(rows))) + 1).cast("int"))


_LINES = """
WITH x AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, CAST(n AS BIGINT) AS n FROM x)
"""


def _lines(spark: SparkSession, sf_dir: str, rows: list[tuple]) -> DataFrame:
    """Every line of every document behind a beginning."""
    each = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    n = (F.col("n") + 1).cast("long")
    return each.select("doc_id", n.alias("n"), F.concat(_planted(rows, F.col("doc_id") + n), F.lit(" "), "line").alias("t"))


@query(_LINES + f"SELECT doc_id, n, v.parent FROM l JOIN {_values(PARENTS)} v(i, t, parent) ON v.i = (doc_id + n) % {len(PARENTS)}")
def line_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, PARENTS).select("doc_id", "n", patterns.title_parent(F.col("t")).alias("parent"))


@query(_LINES + f"SELECT doc_id, n, v.fn_type FROM l JOIN {_values(FOOTNOTES)} v(i, t, fn_type) ON v.i = (doc_id + n) % {len(FOOTNOTES)}")
def line_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, FOOTNOTES).select("doc_id", "n", patterns.footnote_type(F.col("t")).alias("fn_type"))


@query(_LINES + f"SELECT doc_id, n, v.ref_type, v.id_type FROM l JOIN {_values(LABELS)} v(i, t, ref_type, id_type) ON v.i = (doc_id + n) % {len(LABELS)}")
def line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first word of each line as a label and as an id."""
    word = F.split(F.trim("t"), " ")[0]
    return _lines(spark, sf_dir, LABELS).select("doc_id", "n", patterns.type_from_label(word)["ref_type"].alias("ref_type"), patterns.type_from_id(word)["ref_type"].alias("id_type"))


_HEADINGS = r"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)) AS t, generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1), 1) AS pos FROM pages),
l AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, trim(regexp_replace(regexp_replace(t, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS t FROM h)
"""




def _case(table: patterns.Table, text: str) -> str:
    """The first row of a pattern table that matches."""
    tests = [(("(?i)" if loose else "") + (f"^(?:{p})" if table.anchored else p), kind) for p, loose, kind in table.rows]
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {_lit(p)}) THEN {_lit(kind)}" for p, kind in tests) + " END"


_KINDS = "[" + ", ".join(f"CASE WHEN regexp_matches(trim(p), {_lit('(?i)' + x)}) THEN {_lit(kind)} END" for x, _, kind in patterns.SECTION_PARTS.rows) + "]"


@query(_HEADINGS + f"""
, whole AS (SELECT page_id, pos, v.t || ' ' || l.t AS title, trim(v.t || ' ' || l.t) AS t FROM l JOIN {_values(SECTIONS)} v(i, t, sec_type) ON v.i = (page_id + pos) % {len(SECTIONS)}),
parts AS (SELECT *, regexp_split_to_array(lower(t), {_lit(T.CONNECTORS)}) AS p FROM whole),
found AS (SELECT *, list_filter(flatten(list_transform(p, lambda p: {_KINDS})), lambda k: k IS NOT NULL) AS f FROM parts),
one AS (SELECT *, list_filter(f, lambda k, i: list_position(f, k) = i) AS kinds FROM found)
SELECT page_id, pos, title, coalesce({_case(patterns.COMBINED, 'lower(t)')}, CASE WHEN len(p) > 1 AND len(kinds) > 1 THEN array_to_string(kinds, '|') END, {_case(patterns.SECTIONS, 't')}) AS sec_type FROM one
""")
def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every heading of the pages, with all its words, behind a title; an "and" among the words can make another type of it."""
    found = F.regexp_extract_all("html", F.lit("(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"), F.lit(1))
    titles = _pages(spark, sf_dir).select("page_id", F.posexplode(found).alias("pos", "t")).withColumn("pos", (F.col("pos") + 1).cast("long"))
    heading = F.trim(F.regexp_replace(F.regexp_replace("t", "<[^>]*>", ""), r"\s+", " "))
    titles = titles.select("page_id", "pos", F.concat(_planted(SECTIONS, F.col("page_id") + F.col("pos")), F.lit(" "), heading).alias("title"))
    return titles.select("page_id", "pos", "title", patterns.section_type(F.col("title")).alias("sec_type"))
