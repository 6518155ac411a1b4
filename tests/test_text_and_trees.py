"""Text functions, pattern tables, trees, body conversion and article assembly."""

import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from folioframe.functions import patterns as p
from folioframe.functions import text as tx
from folioframe.operators import article, body, citations, nodes, paragraphs
from folioframe.operators.trees import Node, inner, parse, write


def values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column.alias("x")).collect()
    return [r.x for r in sorted(rows, key=lambda r: r.i)]


def test_repairs(spark):
    t = F.col("t")
    assert values(spark, tx.remove_invalid_comments(t), ["a<!-- ok -->b", "a<!-- x -- y -->b", "a<!--[if x]>--\n-->b"]) == ["a<!-- ok -->b", "ab", "ab"]
    assert values(spark, tx.avoid_mismatched_tags(t), ["<p>a\nb</p>\n<p>c</p>"]) == ['<p type="open"/>a\nb<p type="close"/>\n<p>c</p>']
    assert values(spark, tx.remove_namespaced_tags(t), ['<o:p>x</o:p> <a href="http://y">z</a>']) == ['x <a href="http://y">z</a>']
    assert values(spark, tx.remove_tags(t), ["<p>1 > 2</p> <a href=x>y</a>"]) == ["1 &gt; 2 y"]
    assert values(spark, tx.avoid_mismatched_styles(t), ["<b>x</b> <B>y</B> <b class='z'>"]) == ['<span style="bold">x</span> <span style="bold">y</span> <b class=\'z\'>']
    assert values(spark, tx.numeric_entities(t), ["&eacute;&amp;&foo;", None]) == ["&#233;&amp;&amp;foo;", None]
    assert values(spark, tx.safe_unescape(t), ["&lt;b&gt; &eacute; &amp; &#60;"]) == ["&lt;b&gt; é &amp; &#60;"]
    assert values(spark, tx.valid_id(t), ["é 1", "1a", "***"]) == ["e1", "_1a", "id1"]
    assert values(spark, tx.letters_only(t), ["Ação 1"]) == ["acao "]


def test_similarity_chooses(spark):
    df = spark.createDataFrame([("<p>a b c d</p>", "<p>a b c d", 1.0), ("a b", "x y", 0.0)], "o string, f string, s double")
    rows = df.select("s", tx.similarity("o", "f").alias("r"), tx.best_choice(tx.similarity("o", "f"), F.col("o"), F.col("f")).alias("c"), "o", "f").collect()
    assert all(r.r == r.s for r in rows) and rows[0].c == rows[0].f and rows[1].c == rows[1].o


def test_links_and_paths(spark):
    t = F.col("t")
    assert values(spark, tx.replace_links(t, F.create_map(F.lit("a.gif"), F.lit("http://new/a.gif"))), ['<img src="/x/a.gif"><a href="b.htm#c">']) == ['<img src="http://new/a.gif"><a href="b.htm#c">']
    assert values(spark, tx.windows_path(t), ["c:\\x\\y", "c:\x07b"]) == ["c:/x/y", "c:/ab"]
    assert values(spark, tx.site_path(t, "s.org"), ["http://s.org/a/b.htm#c", "http://t.org/a", "/x/y", "#z", "mailto:a@b"]) == ["/a/b.htm", None, "/x/y", None, None]
    assert values(spark, tx.issn_of(t), ["http://x/1234-567X/a.zip", "y"]) == ["1234-567X", None]
    assert values(spark, tx.iso_date(t), ["20190300", "20191301", "20190230", "0000", "20190228"]) == ["2019-3", "2019", "2019-2", None, "2019-2-28"]


LABELS = {"Fig. 1": "fig", "Tabla 2": "table", "Silva et al., 2001": "bibr", "silva et al., 2001": None, "[1]": "bibr", "(2)": "disp-formula", "12": "number", "b": "letter", "**": "symbol", "Anexo B": "app", "S2": "supplementary-material", "no label": None}


def test_labels_alike_in_columns_and_trees(spark):
    assert values(spark, p.type_from_label(F.col("t"))["ref_type"], list(LABELS)) == list(LABELS.values())
    assert [p.LABELS.match(t) for t in LABELS] == list(LABELS.values())


TITLES = ["Introdução", "2 Methods", "Results and Discussion", "Materials and Methods", "*Corresponding author", "References", "Conclusión", "Appendix A", "zzz", "", "Agradecimientos", "1. conflict of interest"]


def test_titles_alike_in_columns_and_trees(spark):
    got = values(spark, p.element_type(F.col("t")), TITLES)
    assert [(g.element_type, g.type_attribute) for g in got] == [p.py_element_type(t) for t in TITLES]
    assert values(spark, p.title_parent(F.col("t")), TITLES) == [p.py_title_parent(t) for t in TITLES]
    assert values(spark, p.section_type(F.col("t")), TITLES[:4]) == ["intro", None, "results|discussion", "materials|methods"]


def test_xref_agreement(spark):
    df = spark.createDataFrame([("Fig. 1", "f1"), ("Fig. 1", "t1"), (None, "B3"), ("zzz", None)], "t string, r string")
    rows = [r.x for r in df.select(p.analyze_xref(F.col("t"), F.col("r")).alias("x")).collect()]
    assert [(x.ref_type, x.source, x.consistent, x.rid) for x in rows] == [("fig", "both", True, "f1"), ("fig", "text", False, None), ("bibr", "id", None, "B3"), (None, None, None, None)]


def test_tree_edits_keep_text():
    root = parse("a<b>c<i>d</i>e</b>f<p>g<p>h<br>i")
    assert write(root) == "<root>a<b>c<i>d</i>e</b>f<p>g</p><p>h<br/>i</p></root>"
    text = root.content()
    root.first("b").unwrap()
    assert root.content() == text and inner(root) == "ac<i>d</i>ef<p>g</p><p>h<br/>i</p>"
    root.first("i").put_after(Node("x"))
    assert root.content() == text
    root.first("x").remove()
    assert "ef" not in root.content()


HTML = """<html><head><title>T</title></head><body><p>front</p><p><b>Introduction</b></p><p>See <a href="#fig1">Fig. 1</a>, <a href="/img/revistas/acta/t01.jpg">Table 1</a>
<a href="/img/revistas/acta/t02.jpg">2</a>, <a href="mailto:a@b.c">mail</a>.</p><p><a name="fig1"></a><img src="/x/f1.gif"></p><p><b>Methods</b></p><ul><li>one<li>two</ul>
<p><b>Unknown words here</b></p><p>para <a href="http://x.org">x</a></p><p><b>Agradecimentos</b></p><p>thanks</p><!-- c --></body></html>"""


def converted():
    return body.convert({"before": HTML, "references": [{"text": "1 Silva", "reference_index": "1"}, {"text": " "}], "after": "<p>end</p>", "translations": {"en": {"before": "<p>hello</p>"}}}, body.Context("acta"), True)


def test_body_conversion():
    xml, steps, errors = converted()
    assert errors == [] and len(steps) == len(body.STEPS)
    root = ET.fromstring(write(xml).replace("xlink:href", "href").replace("xml:lang", "lang"))
    assert [s.get("sec-type") for s in root.find("body").findall("sec")] == ["intro", "methods"]
    assert "front" not in "".join(root.find("body").itertext()) and "thanks" in "".join(root.itertext())
    assert {x.get("rid"): x.get("ref-type") for x in root.iter("xref")} == {"fig1": "fig", "t01": "table", "t02": "table"}
    assert [t.get("id") for t in root.iter("table-wrap")] == ["t01", "t02"] and root.find(".//fig/graphic").get("href") == "/x/f1.gif"
    assert root.find("back/email").text == "a@b.c" and [r.get("id") for r in root.iter("ref")] == ["B1"] and root.find("sub-article/body/p").text == "hello"
    ids = [e.get("id") for e in root.iter() if e.get("id")]
    assert len(ids) == len(set(ids))


def test_conversion_column(spark):
    df = spark.createDataFrame([(json.dumps({"before": HTML}),), (None,), ("{}",)], "p string")
    rows = df.select(body.convert_body(F.col("p"), F.lit("acta")).alias("b")).select("b.xml", "b.errors").collect()
    assert rows[0].xml.startswith("<article><body>") and rows[0].errors == [] and rows[1].xml is None and rows[2].xml == "<article><body/><back/></article>"


@pytest.mark.parametrize("href, text, ref, kind", [("mailto:x@y", "", False, "email"), ("#a", "", False, "internal"), ("/acta/v1/f.htm", "", False, "asset"), ("http://h/acta/x", "", True, "external"), ("../x.gif", "", False, "asset"), ("http://h", "", False, "external"), ("site.org/x", "", False, "external"), ("x/y", "", False, "other")])
def test_link_kinds(href, text, ref, kind):
    assert body.link_kind(href, text, "acta", ref) == kind


def test_local_files_are_embedded_once():
    ctx = body.Context("acta", files={"n.htm": "<p>note <a href='/x/acta/n.htm'>self</a></p>"})
    xml = body.assemble({"before": "<p><a href='/x/acta/n.htm'>one</a> <a href='/x/acta/n.htm#k'>two</a></p>"})
    body.embed_files(xml, ctx)
    assert write(xml).count("note") == 1 and len(xml.all("xref")) == 3


def test_citation_parts():
    c = {"index_number": "7", "publication_type": "journal", "analytic_person_authors": [{"surname": "S", "given_names": "A", "role": "nd"}], "article_title_text": "T", "source": "J", "publication_date": "2001-05-00", "doi": "10/x", "ext_link": "h.org", "comment": "c", "volume_text": "3", "start_page": "1"}
    xml = write(citations.ref(c))
    assert xml.startswith('<ref id="B7"><element-citation publication-type="journal"><person-group person-group-type="authors">')
    assert "<date><year>2001</year><month>05</month></date><year>2001</year>" in xml and '<pub-id pub-id-type="doi">10/x</pub-id>' in xml and '<comment>c<ext-link ext-link-type="uri" xlink:href="http://h.org">' in xml
    assert "date-in-citation" not in write(citations.ref(c | {"access_date_iso": "20200101"}))


def test_article_of_attributes():
    body_xml = write(converted()[0])
    d = {"document_type": "oa", "original_language": "pt", "original_title": "A <i>b</i>", "translated_titles": [{"language": "en", "text": "E"}], "title_by_language": {"en": "E"}, "authors": [{"surname": "S", "xref": "aff1"}], "affiliations": [{"id": "aff1", "orgname": "U"}], "issue_publication_date": "20190000", "volume": "1", "start_page": "3", "end_page": "5", "citations": [{"index_number": "1", "source": "X"}, {"index_number": "9"}], "xml_body": body_xml, "journal": {"title": "J"}}
    xml, errors = article.build(d)
    text = article.serialize(xml)
    root = ET.fromstring(text.split("\n", 2)[2].replace("xml:lang", "lang"))
    assert errors == [] and root.get("article-type") == "research-article" and root.find(".//article-title/italic").text == "b"
    assert root.find(".//page-count").get("count") == "3" and root.find(".//ref-count").get("count") == "2" and root.find(".//pub-date/year").text == "2019" and root.find(".//pub-date/month") is None
    assert root.find(".//ref[@id='B1']/element-citation/source").text == "X" and root.find("front/article-meta/author-notes/corresp/email").text == "a@b.c"
    assert root.find("front/article-meta/title-group/trans-title-group") is None  # the translation has its own title
    assert root.find("sub-article/front-stub//article-title").text == "E"


def test_sup_numbers_become_references():
    make = lambda n: article.build({"xml_body": f'<article><body><p>a<sup>1</sup>b<sup>{n}</sup></p></body><back><ref-list><ref id="B1"><mixed-citation>1 x</mixed-citation></ref><ref id="B2"><mixed-citation>2 y</mixed-citation></ref></ref-list></back></article>'})[0]
    assert len(make(2).all("xref")) == 2 and not make(3).all("xref")


def test_node_table_and_paragraphs(spark):
    df = spark.createDataFrame([(1, "<p>a<b>c</b></p><p>d</p>"), (2, None)], "k long, h string")
    assert [(r.node, r.parent, r.depth, r.tag) for r in nodes.node_table(df, "k", "h").orderBy("node").collect()] == [(0, -1, 0, "p"), (1, 0, 1, "b"), (2, -1, 0, "p")]
    rows = spark.createDataFrame([("x", i, f"t{i}", "7" if i in (2, 4) else None) for i in range(6)] + [("y", 0, "z", "1")], "pid string, pos int, text string, reference_index string")
    parts = {r.pid: r for r in paragraphs.part_texts(rows).collect()}
    assert parts["x"].before == "t0t1" and [r.text for r in parts["x"].refs] == ["t2", "t3", "t4"] and parts["x"].after == "t5" and parts["y"].before == "z"


def test_fuzzy_section_types(spark):
    titles = ["metodos", "resultados e discussao", "literatura citada", "a title of many words", "introduccion", None]
    assert values(spark, p.fuzzy_section_type(F.col("t")), titles) == ["methods", "results|discussion", "", None, "intro", None]


def test_link_kinds_of_columns_and_trees(spark):
    from folioframe.operators.body import link_kind, link_kind_of

    links = ["mailto:x", "a@b.c", "#x", "/aa/v1/f.gif", "/AA/v1/", "http://h/aa/f.gif", "img/revistas/x/y", "../x", "www.h.org", "x:y", "h.org/x", "./x", "page", "", "..", "/x/y.pdf#p"]
    rows = [(x, t, r) for x in links for t in ("", "me@x.y") for r in (True, False)]
    df = spark.createDataFrame(rows, "href string, text string, r boolean")
    for acronym in ("aa", None):
        got = df.select("href", "text", "r", link_kind_of(F.col("href"), F.col("text"), acronym, F.col("r")).alias("k")).collect()
        assert {(x.href, x.text, x.r): x.k for x in got} == {(h, t, r): link_kind(h, t, acronym or "", r) for h, t, r in rows}
    assert [link_kind(h, "", "aa", False) for h in links] == ["email", "email", "internal", "asset", "asset", "asset", "asset", "asset", "external", "external", "external", "other", "other", "other", "asset", "other"]
    assert link_kind("http://h/aa/f.gif", "", "aa", True) == "external"


def test_a_detector_decides_the_language(spark):
    import json

    from folioframe.operators import article

    d = {"original_language": "en", "document_type": "oa", "article_titles": [{"language": "en", "text": "Titre"}], "original_title": "Titre"}
    xml = lambda detector: spark.createDataFrame([(json.dumps(d),)], "d string").select(article.article_xml(F.col("d"), detector)["xml"]).first()[0]
    assert 'xml:lang="fr"' in xml(lambda text: "fr" if "Titre" in text else None) and 'xml:lang="fr"' not in xml(None)


def test_numbers_point_to_references_or_footnotes():
    def xml(refs, fns, inside):
        root = Node("article")
        back = root.sub("back")
        for tag, labels in (("ref", refs), ("fn", fns)):
            for n in labels:
                back.sub(tag, id=f"{tag}{n}").sub("label", n)
        p = root.sub("body").sub("p")
        for tag, text in inside:
            p.sub(tag, text, **({"ref_type": "number"} if tag == "xref" else {}))
        article.sup_to_xref(root, {})
        return [(x.get("ref-type"), x.get("rid"), x.content()) for x in root.all("xref")]

    assert xml("12", "", [("sup", "1"), ("sup", "2")]) == [("bibr", "ref1", "1"), ("bibr", "ref2", "2")]
    assert xml("1", "12", [("sup", "1"), ("sup", "2")]) == [("fn", "fn1", "1"), ("fn", "fn2", "2")]
    assert xml("12", "", [("xref", "2"), ("xref", "x")]) == [("bibr", "ref2", "2"), ("number", None, "x")]
    assert xml("1", "123", [("xref", "1"), ("xref", "3")]) == [("fn", "fn1", "1"), ("fn", "fn3", "3")]
    assert xml("1", "", [("xref", "7"), ("sup", "8")]) == [("number", None, "7")]


def test_loose_content_is_grouped():
    def grouped(html, stop="p"):
        root = parse(html)
        body.group_loose(root, stop)
        return write(root)[len("<root>") : -len("</root>")]

    cases = {
        "lead <i>a</i>b<p>one</p>tail <i>x</i><title>T</title><i>y</i>": None,
        "<p>one</p><table/><i>x</i>": "<p>one</p><p><table/><i>x</i></p>",
        "<p>one</p><i>x</i><bold>B</bold><i>y</i>": "<p>one<i>x</i></p><p><bold>B</bold><i>y</i></p>",
        "<span><p>in</p></span><i>x</i>": "<p><p>in</p><i>x</i></p>",
        "<i>none</i>": "<i>none</i>",
    }
    for html, wanted in cases.items():
        if wanted:
            assert grouped(html).replace("<table></table>", "<table/>") == wanted, html
    first = parse("lead <i>a</i><p>one</p>")
    body.group_loose(first, "p")
    assert first.text == "" and [c.tag for c in first.children] == ["p", "p", "p"] and first.children[0].text.strip() == "lead"


def test_embedded_files_come_from_a_table(spark):
    from folioframe.sources import files as sources

    pages = spark.createDataFrame([("/aa/a.htm", '<p>A <a href="/aa/b.htm">to b</a></p>'), ("/aa/b.htm", '<p>B <a href="/aa/c.htm">to c</a></p>'), ("/aa/c.htm", "<p>C</p>"), ("/aa/d.htm", "<p>D</p>")], "page string, html string")
    closure = sources.embedding_closure(spark.createDataFrame([("/aa/a.htm", "/aa/b.htm"), ("/aa/b.htm", "/aa/c.htm")], "page string, linked string"))
    rows = pages.join(body.embedded_files(closure, pages), "page", "left")
    made = rows.select("page", body.convert_body(F.to_json(F.struct(F.col("html").alias("before"))), F.lit("aa"), F.col("files"))["xml"].alias("xml")).collect()
    xml = {r.page: r.xml for r in made}
    assert all(x in xml["/aa/a.htm"] for x in ("A ", "B ", "C")) and "C" in xml["/aa/b.htm"] and "A " not in xml["/aa/b.htm"] and "D" in xml["/aa/d.htm"]


def test_mixed_citations(spark):
    df = spark.createDataFrame([("<body><p>One <i>two</i></p><p>three</p></body>",), ("no paragraph",), (None,)], "t string")
    assert [r.x for r in df.select(citations.mixed_citations("t").alias("x")).collect()] == ["<mixed-citation>One <i>two</i></mixed-citation>", None, None]


def test_references_without_a_semicolon_are_text():
    html = '<p id="a" title="x&copy=1&amp;b">Ti&amp</p><p>tle&quot<i>b&eacute;c</i> R&#38;D &#38 x\ufffe</p>'
    assert write(parse(html)) == '<root><p id="a" title="x&amp;copy=1&amp;b">Ti&amp;amp</p><p>tle&amp;quot<i>béc</i> R&amp;D &amp;#38 x?</p></root>'
    assert "denti&amp;amp<" in write(body.convert({"before": "<h1>denti&amp</h1><p>Text</p>"})[0])
