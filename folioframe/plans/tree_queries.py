"""Registered queries over trees: converted bodies by what must survive, article fronts and references by their whole XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions.columns import dealt, spread
from folioframe.operators import article, body, citations, entities
from folioframe.plans.catalogue import _pages, _table, query
from folioframe.plans.entity_queries import _document_groups

# Markup that each page is given after its own: two headings, emphasis, an image, a table, a list, a link.
_MORE = (
    "<h2>Extra</h2><p>see <i>it</i> <em>em</em> <sup>1</sup> <sub>2</sub> <img src=\"/img/revistas/aa/f1.gif\"/></p><table><tr><td>cell</td><td>two</td></tr></table>"
    "<ol><li>one</li></ol><p><strong>strong</strong> <a href=\"#top\">up</a></p><!-- a note -->"
)
_LETTERS = r"[^\p{L}\p{N}]"


def _counted(text: str, tag: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '(?i)<{tag}[\\s>/]')) AS BIGINT)"


@query(rf"""
WITH p AS (SELECT page_id, html || '{_MORE}' AS html FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?i)<head>.*?</head>', '', 'gs'), '(?i)<script[^>]*>.*?</script>', '', 'gs'), '(?i)<style[^>]*>.*?</style>', '', 'gs') AS html FROM p)
SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&[^\s;&]+;', '', 'g'), '[^\p{{L}}\p{{N}}]', '', 'g')) AS letters_md5,
    {_counted('html', 'ul')} + {_counted('html', 'ol')} AS n_list, {_counted('html', 'li')} AS n_item, {_counted('html', 'td')} AS n_td, {_counted('html', 'img')} AS n_graphic,
    {_counted('html', 'i')} + {_counted('html', 'em')} AS n_italic, {_counted('html', 'sup')} AS n_sup, {_counted('html', 'sub')} AS n_sub, CAST(0 AS BIGINT) AS n_errors,
    true AS ids_differ, true AS comments_gone FROM b
""")
def body_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted bodies keep every letter and digit, and lists, tables, images and emphasis under their new names; ids are unique."""
    html = F.concat("html", F.lit(_MORE))
    made = spread(_pages(spark, sf_dir)).select("page_id", body.convert_body(F.to_json(F.struct(html.alias("before")))).alias("b"))
    xml = F.col("b.xml")
    n = lambda tags: F.regexp_count(xml, F.lit(rf"<(?:{tags})[\s>/]")).cast("long")
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(xml, "<[^>]*>", ""), r"&[^\s;&]+;", ""), _LETTERS, "")
    ids = F.regexp_extract_all(xml, F.lit(r"\bid=\"([^\"]*)\""), F.lit(1))
    return made.select(
        "page_id", F.md5(text).alias("letters_md5"), n("list").alias("n_list"), n("list-item").alias("n_item"), n("td").alias("n_td"), n("graphic|inline-graphic").alias("n_graphic"), n("italic").alias("n_italic"),
        n("sup").alias("n_sup"), n("sub").alias("n_sub"), F.size("b.errors").cast("long").alias("n_errors"),
        (F.size(ids) == F.size(F.array_distinct(ids))).alias("ids_differ"), (~xml.contains("<!--")).alias("comments_gone"),
    )


# ---- article fronts ----------------------------------------------------------------------------

# What the front of each document below must be; {k} is its key, {e} and {o} what only even or odd keys have.
_FRONT = """<?xml version="1.0" encoding="utf-8"?>
<!DOCTYPE article PUBLIC "-//NLM//DTD JATS (Z39.96) Journal Publishing DTD v1.3 20210610//EN" "JATS-journalpublishing1-3.dtd">
<article xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:mml="http://www.w3.org/1998/Math/MathML" specific-use="sps-1.10" dtd-version="1.3" xml:lang="en" article-type="{kind}"><front>\
<journal-meta><journal-id journal-id-type="publisher-id">ac{k}</journal-id><journal-title-group><journal-title>Title {k} &amp; more</journal-title>\
<abbrev-journal-title abbrev-type="publisher">T. {k}</abbrev-journal-title></journal-title-group>{print}<issn pub-type="epub">2222-{k}</issn>\
<publisher><publisher-name>One; Two {k}</publisher-name><publisher-loc>City, State, Brasil</publisher-loc></publisher></journal-meta>\
<article-meta><article-id pub-id-type="publisher-id" specific-use="pid-v1">one{k}</article-id><article-id pub-id-type="publisher-id" specific-use="pid-v2">two{k}</article-id>\
<article-id pub-id-type="other">7</article-id><article-id pub-id-type="doi">10.1/{k}</article-id>\
<article-categories><subj-group subj-group-type="heading"><subject>Section {k}</subject></subj-group></article-categories>\
<title-group><article-title>On <italic>{k}</italic></article-title><trans-title-group xml:lang="es"><trans-title>Sobre {k}</trans-title></trans-title-group></title-group>\
<contrib-group><contrib contrib-type="{role}"><contrib-id contrib-id-type="orcid">0000-{k}</contrib-id><name><surname>Silva {k}</surname><given-names>Ana</given-names></name>\
<xref ref-type="aff" rid="a1"/><xref ref-type="aff" rid="a2"/></contrib></contrib-group>\
<aff id="a1"><institution content-type="orgname">Univ {k}</institution><institution content-type="orgdiv1">Div</institution><addr-line><named-content content-type="city">Town</named-content></addr-line>\
<country country="BR">Brasil</country><email>a{k}@x.y</email></aff>\
<pub-date publication-format="electronic" date-type="pub"><day>15</day><month>03</month><year>2019</year></pub-date>\
<pub-date publication-format="electronic" date-type="collection"><year>2018</year></pub-date><volume>{k}</volume>{issue}{pages}\
<history><date date-type="received"><day>02</day><month>01</month><year>2017</year></date><date date-type="accepted"><month>05</month><year>2018</year></date></history>\
<permissions><license license-type="open-access" xlink:href="http://l/{k}" xml:lang="en"><license-p>Open {k}</license-p></license></permissions>\
<abstract><p>Abstract {k}</p></abstract><trans-abstract xml:lang="es"><p>Resumen {k}</p></trans-abstract>\
<kwd-group xml:lang="en" kwd-group-type="author-generated"><kwd>one</kwd><kwd>two {k}</kwd></kwd-group>\
<self-uri xlink:href="http://u/{k}" xml:lang="en">text {k}</self-uri>\
<counts><ref-count count="0"/>{count}</counts></article-meta></front></article>
"""


def _sql_text(template: str, **parts: str) -> str:
    """A template as an SQL expression; the parts are expressions."""
    out = "'" + template.replace("'", "''") + "'"
    for name, expression in parts.items():
        out = out.replace("{" + name + "}", f"' || {expression} || '")
    return out


_EVEN = "key % 2 = 0"


@query(f"""
WITH c AS (SELECT c_custkey AS key, CAST(c_custkey AS VARCHAR) AS k FROM customer)
SELECT key, md5({_sql_text(_FRONT, k='k', kind=f"CASE WHEN {_EVEN} THEN 'research-article' ELSE 'review-article' END", role="CASE key % 3 WHEN 0 THEN 'editor' WHEN 1 THEN 'translator' ELSE 'author' END",
    print=f"CASE WHEN {_EVEN} THEN '<issn pub-type=\"ppub\">1111-' || k || '</issn>' ELSE '' END", issue=f"CASE WHEN {_EVEN} THEN '<issue>' || k || '</issue>' ELSE '' END",
    pages=f"CASE WHEN {_EVEN} THEN '<fpage seq=\"a\">1</fpage><lpage>9</lpage>' ELSE '<elocation-id>e' || k || '</elocation-id>' END", count=f"CASE WHEN {_EVEN} THEN '<page-count count=\"9\"/>' ELSE '' END")}) AS md5,
    CAST(1 AS BIGINT) AS n_errors, 'abstracts' AS failed FROM c
""")
def article_fronts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as documents with every attribute that an article's front has: the whole XML, and the error row of an abstract without a language."""
    key, k = F.col("c_custkey"), F.col("c_custkey").cast("string")
    even = key % 2 == 0
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    struct = lambda **values: F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in values.items()])
    d = struct(
        document_type=F.when(even, "oa").otherwise("ra"), original_language="en",
        journal=struct(
            acronym=text("ac", k), title=text("Title ", k, " & more"), abbreviated_title=text("T. ", k), print_issn=F.when(even, text("1111-", k)), electronic_issn=text("2222-", k),
            publisher_name=F.array(F.lit("One"), text("Two ", k)), publisher_country="BR", publisher_country_name="Brasil", publisher_city="City", publisher_state="State",
        ),
        pid_v1=text("one", k), pid_v2=text("two", k), internal_sequence_id="7", doi=text("10.1/", k), section_code="S1", section_titles=struct(en=text("Section ", k)),
        original_title=text("On <i>", k, "</i>"), translated_titles=F.array(struct(language="es", text=text("Sobre ", k))),
        authors=F.array(struct(surname=text("Silva ", k), given_names="Ana", role=F.when(key % 3 == 0, "ed").when(key % 3 == 1, "TR").otherwise("nd"), orcid=text("0000-", k), xref="a1 a2")),
        affiliations=F.array(struct(id="a1", orgname=text("Univ ", k), div1="Div", city="Town", country="Brasil", email=text("a", k, "@x.y"))), countries=struct(Brasil="BR"),
        processing_date="20190315", issue_publication_date="20180000", volume=k, issue_number=F.when(even, k).otherwise("ahead"),
        elocation=F.when(~even, text("e", k)), start_page=F.when(even, "1"), end_page="9", start_page_sequence="a",
        receive_date_iso="20170102", acceptance_date_iso="20180500", licenses=F.array(struct(url=text("http://l/", k), language="en", text=text("Open ", k))),
        original_abstract=text("Abstract ", k), translated_abstracts=F.array(struct(language=F.lit("es"), text=text("Resumen ", k)), struct(language=F.lit(None).cast("string"), text=F.lit("lost"))),
        keyword_groups=struct(en=F.array(F.lit("one"), text("two ", k))), fulltexts=F.array(struct(uri=text("http://u/", k), lang="en", uri_text=text("text ", k))),
    )
    made = dealt(_table(spark, sf_dir, "customer").select("c_custkey")).select(key.alias("key"), article.article_xml(F.to_json(d)).alias("a"))
    return made.select("key", F.md5("a.xml").alias("md5"), F.size("a.errors").cast("long").alias("n_errors"), F.col("a.errors")[0]["action"].alias("failed"))


# ---- references --------------------------------------------------------------------------------

# The XML of the references below, by kind; {k} is the key.
_REFS = {
    "journal": """<ref id="B{k}"><mixed-citation>Lopes E. <italic>On {k}</italic>.</mixed-citation><element-citation publication-type="journal"><person-group person-group-type="authors">\
<name><surname>Lopes</surname><given-names>Eva</given-names></name><name><surname>Cruz</surname></name></person-group><article-title>On {k}</article-title><source>Journal {k}</source><volume>8</volume><issue>4</issue>\
<supplement>1</supplement><elocation-id>e{k}</elocation-id><page-range>5-9</page-range><fpage>5</fpage><lpage>9</lpage><issn>1234-{k}</issn><pub-id pub-id-type="pmid">p{k}</pub-id>\
<pub-id pub-id-type="doi">10.1/{k}</pub-id><date><year>2001</year><month>03</month></date><year>2001</year></element-citation></ref>""",
    "book": """<ref id="B{k}"><element-citation publication-type="book"><person-group person-group-type="authors"><collab>Org, Div</collab></person-group><chapter-title>Chapter {k}</chapter-title><source>Book {k}</source>\
<publisher-name>House</publisher-name><publisher-loc><city>City</city><state>State</state><country>Country</country></publisher-loc><size units="p">{k}</size><edition>2nd</edition><isbn>978-{k}</isbn>\
<version>1.0</version><series>Series</series><comment>note {k}</comment></element-citation></ref>""",
    "thesis": """<ref id="B{k}"><element-citation publication-type="thesis"><source>Thesis {k}</source><publisher-name>Univ</publisher-name><publisher-loc><city>Town</city><country>BR</country></publisher-loc>\
<comment content-type="degree">PhD</comment><date><year>1999</year><month>12</month><day>31</day></date><year>1999</year></element-citation></ref>""",
    "confproc": """<ref id="B{k}"><element-citation publication-type="confproc"><source>Proc {k}</source><conf-name>1 Conf {k}</conf-name><conf-date iso-8601-date="2003-7">July {k}</conf-date>\
<conf-loc><city>Rome</city><country>IT</country></conf-loc><conf-sponsor>Sponsor</conf-sponsor></element-citation></ref>""",
    "patent": """<ref id="B{k}"><element-citation publication-type="patent"><patent country="US">US Office {k}</patent>\
<date-in-citation content-type="access-date" iso-8601-date="2010-1-2">2 Jan</date-in-citation></element-citation></ref>""",
    "webpage": """<ref id="B{k}"><element-citation publication-type="webpage"><source>Site {k}</source><comment>seen<ext-link ext-link-type="uri" xlink:href="http://h/{k}">h/{k}</ext-link></comment>\
<comment content-type="project-name">Project</comment><comment content-type="project-number">{k}</comment><comment content-type="project-sponsor">Fund</comment></element-citation></ref>""",
}


@query(f"""
WITH p AS (SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) AS k FROM part)
SELECT key, md5(CASE key % 6 {' '.join(f"WHEN {i} THEN {_sql_text(template, k='k')}" for i, template in enumerate(_REFS.values()))} END) AS md5 FROM p
""")
def references_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as citations of six kinds: the whole XML of each reference."""
    key, k = F.col("p_partkey"), F.col("p_partkey").cast("string")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    struct = lambda **values: F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in values.items()])
    place = lambda **values: struct(**values)
    kinds = [
        struct(
            publication_type="journal", index_number=k, paragraph_text=text("<p>Lopes E. <i>On ", k, "</i>.</p>"), article_title_text=text("On ", k), source=text("Journal ", k), volume_text="8",
            analytic_person_authors=F.array(struct(surname="Lopes", given_names=F.lit("Eva"), role="nd"), struct(surname="Cruz", given_names=F.lit(None).cast("string"), role="ND")), issue_number="4", supplement="1",
            elocation=text("e", k), page_range="5-9", start_page="5", end_page="9", issn=text("1234-", k), pmid=text("p", k), doi=text("10.1/", k), publication_date="2001-03-00",
        ),
        struct(
            publication_type="book", index_number=k, chapter_title=text("Chapter ", k), source=text("Book ", k), monographic_corporative_authors=F.array(struct(name="Org", division="Div")), publisher_name="House",
            publisher_location=place(city="City", state="State"), publisher_country="Country", size=struct(size=k, unit="p"), edition="2nd", isbn=text("978-", k), version="1.0", serie="Series", comment=text("note ", k),
        ),
        struct(publication_type="thesis", index_number=k, source=text("Thesis ", k), thesis_institution="Univ", thesis_location=place(city="Town"), thesis_country="BR", thesis_degree="PhD", publication_date="1999-12-31"),
        struct(
            publication_type="confproc", index_number=k, source=text("Proc ", k), conference_name=text("1 Conf ", k), conference_date_iso="20030700", conference_date=text("July ", k), conference_location=place(city="Rome"),
            conference_country="IT", conference_sponsor="Sponsor",
        ),
        struct(
            publication_type="patent", index_number=k, patent=struct(id=k), patent_country="US", patent_organization="Office", patent_id=k, access_date="2 Jan", access_date_iso="20100102", patent_application_date="1 Jan",
        ),
        struct(publication_type="webpage", index_number=k, source=text("Site ", k), ext_link=text("h/", k), comment="seen", project_name="Project", project_number=k, sponsor="Fund"),
    ]
    cited = F.lit(None).cast("string")
    for i, c in enumerate(kinds):
        cited = F.when(key % 6 == i, F.to_json(c)).otherwise(cited)
    made = _table(spark, sf_dir, "part").select(key.alias("key"), cited.alias("c"))
    return made.select("key", citations.ref_xml("c").alias("xml")).select("key", F.md5("xml").alias("md5"))


# ---- whole articles ----------------------------------------------------------------------------

#: Year, issue and place of the document with key 0, 13 digits in all; keys beyond 99999 go on in the next issue.
_FIRST_PID = 2019_0001_00000


def _between(xml: Column, tag: str) -> Column:
    return F.regexp_extract(xml, rf"<{tag}(?: [^>]*)?>([^<]*)</{tag}>", 1)


@query("""
WITH p AS (SELECT p_partkey AS key, CAST(p_partkey AS VARCHAR) AS k, lpad(CAST(p_partkey % 50 AS VARCHAR), 9, '0') AS issn FROM part)
SELECT key, 'Journal ' || issn AS journal_title, 'title ' || k AS article_title, 'Silva' || k AS surname, CAST(1 AS BIGINT) AS n_refs, '2' AS ref_count, '701-' || k AS ref_label, 'journal ' || k AS ref_source,
    'http://l/' || k AS license, 'Body of ' || k AS body, '7' AS volume, '10.1/' || k AS doi, CAST(0 AS BIGINT) AS n_errors FROM p
""")
def assembled_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents, joined to fifty journals, to their citations, bodies and licenses: what of each comes through into the article."""
    issn = F.lpad((F.col("p_partkey") % 50).cast("string"), 9, "0")
    pid = F.concat(F.lit("S"), issn, (F.lit(_FIRST_PID) + F.col("p_partkey")).cast("string"))
    # dealt out by pid while they are keys alone: what is made of them stays where it is joined
    parts = dealt(_table(spark, sf_dir, "part").select("p_partkey", pid.alias("pid")), "pid")
    docs = entities.documents(_document_groups(parts, F.col("pid"))).withColumn("doi", F.concat(F.lit("10.1/"), F.col("grp").cast("string")))
    journals = spark.range(50).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("i"))
    one = lambda v: F.array(F.create_map(F.lit("_"), v))
    journals = entities.journals(journals.select(F.create_map(F.lit("v400"), one(F.col("i")), F.lit("v100"), one(F.concat(F.lit("Journal "), "i"))).alias("record")))
    key = F.col("grp").cast("string")
    before = F.concat(F.lit("<p>Body of "), key, F.lit("</p>")).alias("before")
    refs = F.array(F.struct(F.concat(F.lit("<p>Reference "), key, F.lit("</p>")).alias("text"), F.concat(F.lit("701-"), key).alias("reference_index"))).alias("references")
    bodies = docs.select("pid", body.convert_body(F.to_json(F.struct(before, refs)))["xml"].alias("xml_body"))
    licenses = docs.select("pid", F.lit("en").alias("language"), F.concat(F.lit("http://l/"), key).alias("url"), F.lit("open").alias("text"))
    made = article.assemble_articles(docs, journals, entities.citations(docs), bodies, licenses)
    xml = F.col("xml")
    return made.select(
        (F.substring("pid", 11, 13).cast("long") - _FIRST_PID).alias("key"), _between(xml, "journal-title").alias("journal_title"), _between(xml, "article-title").alias("article_title"), _between(xml, "surname").alias("surname"),
        F.regexp_count(xml, F.lit("<ref id=")).cast("long").alias("n_refs"), F.regexp_extract(xml, 'ref-count count="([0-9]*)"', 1).alias("ref_count"), F.regexp_extract(xml, '<ref id="B([^"]*)"', 1).alias("ref_label"),
        _between(xml, "source").alias("ref_source"), F.regexp_extract(xml, 'license-type="open-access" xlink:href="([^"]*)"', 1).alias("license"), F.regexp_extract(xml, "<p>(Body of [^<]*)</p>", 1).alias("body"),
        _between(xml, "volume").alias("volume"), F.regexp_extract(xml, '<article-id pub-id-type="doi">([^<]*)<', 1).alias("doi"), F.size("errors").cast("long").alias("n_errors"),
    )
