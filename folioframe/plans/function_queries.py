"""Registered queries of text functions by value: over every document and page, with what each function is for planted by place and told by literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import lookups, patterns
from folioframe.functions import text as tx
from folioframe.functions.columns import spread
from folioframe.plans.catalogue import _pages, _table, query
from folioframe.plans.title_queries import _values


@query(r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^a-zA-Z \n]', '', 'g') AS t, doc_id % 3 AS k FROM documents)
SELECT doc_id, md5('é<&' || replace(t, chr(10), '')) AS decoded_md5, md5('abc' || replace(t, chr(10), '')) AS controls_md5, md5('a?b' || chr(9) || '?' || t) AS xml_md5,
       md5(CASE WHEN k = 0 THEN 'reader@host.org' WHEN k = 1 THEN 'mail ' || replace(t, chr(10), ' ') ELSE replace(t, chr(10), ' ') END) AS email_md5, md5('ñ' || t) AS name_md5
FROM d
""")
def character_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities decoded, control characters gone, forbidden characters marked, addresses out of mail anchors, names without lone surrogates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"[^a-zA-Z \n]", "").alias("t"))
    k, flat = F.col("doc_id") % 3, F.replace("t", F.lit("\n"), F.lit(" "))
    mail = F.when(k == 0, F.concat(F.lit('<a href="mailto:x">reader@host.org</a>'), flat)).when(k == 1, F.concat(F.lit('<A HREF="">mail '), flat, F.lit("</A>"))).otherwise(flat)
    md5 = lambda c, name: F.md5(c).alias(name)
    return docs.select(
        "doc_id", md5(tx.decode_html(F.concat(F.lit("&eacute;\x07&lt;&#38;"), "t")), "decoded_md5"), md5(tx.remove_control(F.concat(F.lit("a\x07b​c"), "t")), "controls_md5"),
        md5(tx.xml_characters(F.concat(F.lit("a\x01b\t￾"), "t")), "xml_md5"), md5(tx.email_of_anchor(mail), "email_md5"), md5(tx.without_surrogates(F.concat(F.lit("ñ"), "t")), "name_md5"),
    )


#: Texts and ids of cross references; the type they make, what told it, whether both agree, and the number in the text. Where only the first word is a label,
#: the number is sought in that word, and a single letter at its end is one.
XREFS = [
    ("Figure 12", "f12", "fig", "both", "true", "12"), ("Table 3", "f3", "table", "text", "false", "3"), ("Fig. 4b", None, "fig", "text", None, None), ("see there", "B7", "bibr", "id", None, None),
    ("Tabela 5 and more", "t5", "table", "both", "true", "a"), ("", "aff2", "aff", "id", None, None), ("nothing", "nothing", None, None, None, None), ("Equation 9", "e9", "disp-formula", "both", "true", "9"),
]
#: Codes, their article types and contributor types.
CODES = [("oa", "research-article", "author"), ("ed", "editorial", "editor"), ("tr", "tr", "translator"), ("rn", "brief-report", "author"), ("ND", "ND", "author"), ("new", "new", "author")]
#: Titles and the section types that they are like.
LIKE = [
    ("method", "methods"), ("result", "results"), ("discusion", "discussion"), ("materials and methods", "materials|methods"), ("literatura citada", ""), ("four words are many", None), ("resumen", ""), ("xqz", ""),
]


def _by(rows: list[tuple], column: int):
    """The planted value of a row's place."""
    return F.element_at(F.array(*[F.lit(r[column]).cast("string") for r in rows]), (F.pmod(F.col("doc_id"), F.lit(len(rows))) + 1).cast("int"))


@query(f"""
SELECT doc_id, x.kind AS ref_type, x.source, x.same, x.number, c.article, c.contributor, l.section
FROM documents JOIN {_values(XREFS)} x(i, t, rid, kind, source, same, number) ON x.i = doc_id % {len(XREFS)}
JOIN {_values(CODES)} c(i, code, article, contributor) ON c.i = doc_id % {len(CODES)} JOIN {_values(LIKE)} l(i, t, section) ON l.i = doc_id % {len(LIKE)}
""")
def reference_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross references by text and id, code lookups by an attribute's name, and section types by likeness, for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", patterns.analyze_xref(_by(XREFS, 0), _by(XREFS, 1)).alias("x"), _by(CODES, 0).alias("code"), _by(LIKE, 0).alias("title"))
    return docs.select(
        "doc_id", F.col("x.ref_type").alias("ref_type"), F.col("x.source").alias("source"), F.col("x.consistent").cast("string").alias("same"), F.col("x.number").alias("number"),
        lookups.attribute_value("article-type", F.col("code")).alias("article"), lookups.attribute_value("contrib-type", F.col("code")).alias("contributor"), patterns.fuzzy_section_type(F.col("title")).alias("section"),
    )


@query(r"""
WITH p AS (SELECT page_id, len(regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\S+')) AS n, CASE page_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 5 ELSE 8000 END AS m FROM pages),
s AS (SELECT *, round(2.0 * n / (2 * n + m), 6) AS score FROM p)
SELECT page_id, score, score > 0.7 AS repaired FROM s
""")
def repair_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with an office block of no, few or many words before them: the repair, how much of the words it keeps, and which of both is taken."""
    words = F.when(F.col("page_id") % 3 == 0, 0).when(F.col("page_id") % 3 == 1, 5).otherwise(8000)
    pages = spread(_pages(spark, sf_dir)).select("page_id", F.concat(F.lit("<xml>"), F.repeat(F.lit("zqx "), words), F.lit("</xml>"), "html").alias("original"))
    fixed = pages.withColumn("fixed", tx.repair(F.col("original"))).withColumn("score", tx.similarity("original", "fixed"))
    chosen = tx.best_choice(F.col("score"), F.col("original"), F.col("fixed"))
    return fixed.select("page_id", F.round("score", 6).alias("score"), (chosen == F.col("fixed")).alias("repaired"))
