"""Article XML: front matter from a document's attributes, body and back from its converted text.

The input is one JSON text for each document with its attributes, those of its journal and issue, its
citations and its body; the output is XML and error rows. Rules run in order, each adding to the tree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from folioframe.functions import pattern_tables as T
from folioframe.functions.lookups import ARTICLE_TYPES, CONTRIB_TYPES
from folioframe.operators import citations
from folioframe.operators.body import ERROR, STYLES
from folioframe.operators.trees import Node, clean, element, parse, write

# Fixed values of the target format.
SPECIFIC_USE, DTD_VERSION = "sps-1.10", "1.3"
DOCTYPE = '<!DOCTYPE article PUBLIC "-//NLM//DTD JATS (Z39.96) Journal Publishing DTD v1.3 20210610//EN" "JATS-journalpublishing1-3.dtd">'
LANG, XLINK = "xml:lang", "xlink:href"

Doc = dict
Rule = Callable[[Node, Doc], None]


def _front(xml: Node) -> Node:
    return xml.child("front").child("article-meta")


def setup(xml: Node, d: Doc) -> None:
    params = d.get("params") or {}
    xml.attrs |= {"specific-use": params.get("specific-use", SPECIFIC_USE), "dtd-version": params.get("dtd-version", DTD_VERSION)}
    kind, lang = d.get("document_type"), d.get("original_language")
    if kind and lang:
        xml.attrs |= {LANG: lang, "article-type": ARTICLE_TYPES.get(kind, kind)}
    front = xml.sub("front")
    front.sub("journal-meta")
    front.sub("article-meta")


def journal_meta(xml: Node, d: Doc) -> None:
    j, meta = d.get("journal") or {}, xml.child("front").child("journal-meta")
    meta.sub("journal-id", j.get("acronym"), journal_id_type="publisher-id")
    titles = meta.sub("journal-title-group")
    titles.sub("journal-title", j.get("title"))
    titles.sub("abbrev-journal-title", j.get("abbreviated_title"), abbrev_type="publisher")
    for key, kind in (("print_issn", "ppub"), ("electronic_issn", "epub")):
        if j.get(key):
            meta.sub("issn", j[key], pub_type=kind)
    publisher = meta.sub("publisher")
    publisher.sub("publisher-name", "; ".join(j.get("publisher_name") or []))
    if j.get("publisher_country"):
        country = j.get("publisher_country_name") or j["publisher_country"]
        publisher.sub("publisher-loc", ", ".join([j.get("publisher_city") or "", j.get("publisher_state") or "", country]))


def article_ids(xml: Node, d: Doc) -> None:
    """Pids by the name of their scheme, a parameter (the collection's own name), and the other ids."""
    meta, scheme = _front(xml), (d.get("params") or {}).get("pid-scheme", "pid")
    for version in ("v1", "v2", "v3"):
        if d.get(f"pid_{version}"):
            meta.add(Node("article-id", {"pub-id-type": "publisher-id", "specific-use": f"{scheme}-{version}"}, clean(d[f"pid_{version}"])))
    if d.get("aop_pid"):
        meta.add(Node("article-id", {"specific-use": "previous-pid"}, clean(d["aop_pid"])))
    if d.get("internal_sequence_id"):
        meta.sub("article-id", d["internal_sequence_id"], pub_id_type="other")
    if d.get("doi"):
        meta.sub("article-id", d["doi"], pub_id_type="doi")


def _subject(node: Node, d: Doc, lang: str | None) -> None:
    if not d.get("section_code"):
        return
    group = node.sub("article-categories").sub("subj-group", subj_group_type="heading")
    group.sub("subject", (d.get("section_titles") or {}).get(lang))


def titles(xml: Node, d: Doc) -> None:
    meta = _front(xml)
    _subject(meta, d, d.get("original_language"))
    group = meta.sub("title-group")
    group.add(element("article-title", d.get("original_title")))
    for t in d.get("translated_titles") or []:
        if t.get("language") and t.get("text"):
            group.add(Node("trans-title-group", {LANG: t["language"]})).add(element("trans-title", t["text"]))


def contributors(xml: Node, d: Doc) -> None:
    people, bodies = d.get("authors") or [], d.get("corporative_authors") or []
    if not people and not bodies:
        return
    group = _front(xml).sub("contrib-group")
    for a in people:
        contrib = group.sub("contrib", contrib_type=CONTRIB_TYPES.get(a.get("role"), "author"))
        for kind in ("lattes", "orcid"):
            if a.get(kind):
                contrib.sub("contrib-id", a[kind], contrib_id_type=kind)
        name = contrib.sub("name")
        for key, tag in (("surname", "surname"), ("given_names", "given-names")):
            if a.get(key):
                name.sub(tag, a[key])
        for rid in (a.get("xref") or "").split():
            contrib.sub("xref", ref_type="aff", rid=rid)
    if bodies:
        group.sub("contrib", contrib_type="author").add(element("collab", bodies[0]))


def affiliations(xml: Node, d: Doc) -> None:
    countries = d.get("countries") or {}
    for a in d.get("affiliations") or []:
        aff = _front(xml).add(Node("aff", {"id": a["id"]} if a.get("id") else {}))
        for key, kind in (("orgname", "orgname"), ("div1", "orgdiv1"), ("div2", "orgdiv2"), ("div3", "orgdiv3")):
            if a.get(key):
                aff.sub("institution", a[key], content_type=kind)
        if a.get("city") or a.get("state"):
            line = aff.sub("addr-line")
            for key in ("city", "state"):
                if a.get(key):
                    line.sub("named-content", a[key], content_type=key)
        if a.get("country") and countries.get(a["country"]):
            aff.sub("country", a["country"], country=countries[a["country"]])
        if a.get("email"):
            aff.sub("email", a["email"])


def date_element(tag: str, text: str | None, **attrs: str) -> Node | None:
    """Day, month and year of YYYYMMDD, each if it is a number other than zero."""
    if not text:
        return None
    node = Node(tag, {k.replace("_", "-"): v for k, v in attrs.items()})
    for name, part in (("day", text[6:8]), ("month", text[4:6]), ("year", text[:4])):
        if part.isdigit() and int(part):
            node.sub(name, part)
    return node


def publication(xml: Node, d: Doc) -> None:
    meta = _front(xml)
    for text, kind in ((d.get("document_publication_date") or d.get("processing_date"), "pub"), (d.get("issue_publication_date"), "collection")):
        node = date_element("pub-date", text, publication_format="electronic", date_type=kind)
        if node is not None:
            meta.add(node)
    for key, tag in (("volume", "volume"), ("issue_number", "issue"), ("supplement", "supplement"), ("elocation", "elocation-id")):
        if d.get(key) and not (key == "issue_number" and d[key] == "ahead"):
            meta.sub(tag, d[key])
    if d.get("start_page"):
        meta.add(Node("fpage", {"seq": d["start_page_sequence"]} if d.get("start_page_sequence") else {}, clean(d["start_page"])))
        if d.get("end_page"):
            meta.sub("lpage", d["end_page"])


def history(xml: Node, d: Doc) -> None:
    node = Node("history")
    for key, kind in (("receive_date_iso", "received"), ("review_date_iso", "rev-recd"), ("acceptance_date_iso", "accepted")):
        found = date_element("date", d.get(key), date_type=kind)
        if found is not None:
            node.add(found)
    if node.children:
        _front(xml).add(node)


def permissions(xml: Node, d: Doc) -> None:
    found = [x for x in d.get("licenses") or [] if x.get("url")]
    if found:
        node = _front(xml).sub("permissions")
        for x in found:
            lic = node.add(Node("license", {"license-type": "open-access", XLINK: x["url"], LANG: x.get("language") or ""}))
            lic.sub("license-p", x.get("text"))


def abstracts(xml: Node, d: Doc) -> None:
    meta, done = _front(xml), set(d.get("translated_languages") or [])
    if d.get("original_abstract"):
        meta.sub("abstract").add(element("p", d["original_abstract"]))
    for a in d.get("translated_abstracts") or []:
        if not (a.get("language") and a.get("text")):
            d.setdefault("errors", []).append({"action": "abstracts", "type": "ValueError", "message": "a translated abstract lacks language or text", "detail": json.dumps(a)})
        elif a["language"] not in done:
            meta.add(Node("trans-abstract", {LANG: a["language"]})).add(element("p", a["text"]))
    for lang, words in (d.get("keyword_groups") or {}).items():
        if lang not in done:
            group = meta.add(Node("kwd-group", {LANG: lang, "kwd-group-type": "author-generated"}))
            for w in words:
                group.add(element("kwd", w))


def self_uris(xml: Node, d: Doc) -> None:
    for x in d.get("fulltexts") or []:
        _front(xml).add(Node("self-uri", {XLINK: x.get("uri") or "", LANG: x.get("lang") or ""}, clean(x.get("uri_text"))))


def body(xml: Node, d: Doc) -> None:
    """Body, back and translations of the converted text."""
    if not d.get("xml_body"):
        return
    root = parse_xml(d["xml_body"])
    article = root.children[0] if root.children else root
    for part in list(article.children):
        if part.tag == "body":
            part.attrs["specific-use"] = "quirks-mode"
        if part.tag in ("body", "back", "sub-article"):
            xml.add(part)
    for sub in [c for c in xml.children if c.tag == "sub-article"]:
        lang, stub = sub.get(LANG), Node("front-stub")
        _subject(stub, d, lang)
        if (d.get("title_by_language") or {}).get(lang):
            title = stub.sub("title-group").add(element("article-title", d["title_by_language"][lang]))
            title.attrs[LANG] = lang
        if (d.get("abstract_by_language") or {}).get(lang):
            stub.add(Node("abstract", {LANG: lang})).add(element("p", d["abstract_by_language"][lang]))
        words = (d.get("keyword_groups") or {}).get(lang)
        if words:
            group = stub.add(Node("kwd-group", {LANG: lang}))
            for w in words:
                group.add(element("kwd", w))
        sub.add(stub, 0)


def styles(xml: Node, d: Doc) -> None:
    for n in xml.all("span"):
        name = (n.get("name") or "").removeprefix("style_")
        if name in STYLES:
            n.tag = name
            n.attrs.pop("name")


_SYMBOLS = str.maketrans(T.SYMBOL_FONT)


def symbol_font(xml: Node, d: Doc) -> None:
    """Characters in the symbol font as the glyphs they show."""
    for n in xml.all("font-face-symbol"):
        n.text = n.text.translate(_SYMBOLS)
        n.unwrap()


def author_notes(xml: Node, d: Doc) -> None:
    found = xml.all("corresp")
    if not found:
        mails = [m for m in xml.all("email") if not any(a.tag == "front" for a in m.ancestors())]
        if not mails:
            return
        found = [Node("corresp")]
        for m in mails:
            found[0].add(m)
    notes = xml.first("author-notes") or Node("author-notes")
    for c in found:
        c.tail = ""
        notes.add(c)
    if notes.parent is None:
        meta = _front(xml)
        order = ("article-id", "article-categories", "title-group", "contrib-group", "aff")
        at = max((i for i, c in enumerate(meta.children) if c.tag in order), default=-1)
        meta.add(notes, at + 1)


def merge_refs(xml: Node, d: Doc) -> None:
    """Citations go to the reference with their id; a reference that has a part of one keeps its own."""
    refs = {r.get("id"): r for r in xml.all("ref")}
    for c in d.get("citations") or []:
        target = refs.get(f"B{c.get('index_number') or ''}")
        if target is None:
            continue
        for part in list(citations.ref(c).children):
            if not target.child(part.tag):
                target.add(part)


def _numbered(xml: Node, tag: str) -> dict[str, str]:
    """Ids of the elements of a tag by their number: their label, or what their citation begins with."""
    ids: dict[str, str] = {}
    for n in xml.all(tag):
        label, mixed = n.first("label"), n.first("mixed-citation")
        text = label.content().strip() if label is not None else (m[0] if mixed is not None and (m := re.match(r"\d+", mixed.content().strip())) else "")
        if text:
            ids.setdefault(text, n.get("id") or "")
    return ids


def sup_to_xref(xml: Node, d: Doc) -> None:
    """Superscript numbers, and references of the type number, point to references if every one of them is the number of one, or else to footnotes."""

    def found(nodes: list[Node]) -> list[tuple[Node, str, str, str]]:
        texts = {n.content().strip() for n in nodes}
        numbers = {t for t in texts if t.isdigit()}
        if not numbers:
            return []
        for tag, kind in (("ref", "bibr"), ("fn", "fn")):
            ids = _numbered(xml, tag)
            if numbers <= set(ids):
                return [(n, kind, t, ids[t]) for n in nodes if (t := n.content().strip()) in numbers]
        return []

    sups = [s for s in xml.all("sup") if s.content().strip().isdigit() and not s.first("xref") and s.parent.tag != "xref"]
    for s, kind, number, rid in found(sups):
        s.children, s.text = [], ""
        s.sub("xref", number, ref_type=kind, rid=rid)
    for x, kind, _, rid in found(xml.all("xref", where=lambda n: n.get("ref-type") == "number")):
        if rid:
            x.attrs |= {"ref-type": kind, "rid": rid}


def acknowledgements(xml: Node, d: Doc) -> None:
    found = [a for a in xml.all("ack") if not any(p.tag in ("back", "sub-article") for p in a.ancestors())]
    if found:
        back = xml.child("back")
        if back is None:
            back = Node("back")
            main = xml.child("body")
            main.put_after(back) if main is not None else xml.add(back)
        for i, a in enumerate(found):
            a.tail = ""
            back.add(a, i)


def repeated_ids(xml: Node, d: Doc) -> None:
    """In translations ids get the sub-article's as prefix; of equal ids the first node stays."""
    for sub in [c for c in xml.children if c.tag == "sub-article" and c.get("article-type") == "translation"]:
        own = sub.get("id") or ""
        for n in sub.all(where=lambda n: bool(n.get("id"))):
            if not n.attrs["id"].startswith(own):
                old, n.attrs["id"] = n.attrs["id"], own + n.attrs["id"]
                for x in sub.all("xref", where=lambda x, old=old: x.get("rid") == old):
                    x.attrs["rid"] = own + old
    seen: set[str] = set()
    for n in xml.all(where=lambda n: bool(n.get("id"))):
        if n.attrs["id"] in seen and n.parent is not None:
            before = n.previous()
            if before is not None:
                before.tail += n.tail
            else:
                n.parent.text += n.tail
            n.remove()
        seen.add(n.attrs["id"])


def repeated_translations(xml: Node, d: Doc) -> None:
    meta = _front(xml)
    for sub in [c for c in xml.children if c.tag == "sub-article" and c.get("article-type") == "translation"]:
        for n in meta.all(where=lambda n, lang=sub.get(LANG): n.get(LANG) == lang):
            if n.parent is not None:
                n.remove()


def article_language(xml: Node, d: Doc) -> None:
    """Title and abstract that agree on a language decide the article's; else a detector, if there is one, by the text of its front."""
    told = lambda tag: n.get(LANG) if (n := _front(xml).first(tag, where=lambda n: bool(n.get(LANG)))) is not None else None
    if (lang := told("article-title")) and lang == told("abstract"):
        xml.attrs[LANG] = lang
    elif (detect := d.get("detector")) and (text := _front(xml).content().strip()) and (found := detect(text)):
        xml.attrs[LANG] = found


def counts(xml: Node, d: Doc) -> None:
    def tally(node: Node) -> None:
        main = xml.child("body")
        if main is not None:
            with_id = lambda *tags: str(len(main.all(*tags, where=lambda n: bool(n.get("id")))))
            node.sub("fig-count", count=with_id("fig", "fig-group"))
            node.sub("table-count", count=with_id("table-wrap", "table-wrap-group"))
            node.sub("equation-count", count=with_id("disp-formula"))

    node = _front(xml).sub("counts")
    tally(node)
    node.sub("ref-count", count=str(len(d.get("citations") or [])))
    first, last = d.get("start_page") or "", d.get("end_page") or d.get("start_page") or ""
    if first.isdigit() and last.isdigit() and 0 < int(first) <= int(last):
        node.sub("page-count", count=str(int(last) - int(first) + 1))
    for sub in [c for c in xml.children if c.tag == "sub-article"]:
        stub = sub.child("front-stub") or sub.add(Node("front-stub"), 0)
        tally(stub.child("counts") or stub.sub("counts"))


RULES: list[Rule] = [
    setup,
    journal_meta,
    article_ids,
    titles,
    contributors,
    affiliations,
    publication,
    history,
    permissions,
    abstracts,
    self_uris,
    body,
    styles,
    symbol_font,
    author_notes,
    merge_refs,
    sup_to_xref,
    acknowledgements,
    repeated_ids,
    repeated_translations,
    article_language,
    counts,
]


#: Attributes of a document that the rules read; a new rule's are to be named here, others are not made for an article.
READ = set(
    """params document_type original_language journal pid_v1 pid_v2 pid_v3 aop_pid internal_sequence_id doi section_code section_titles original_title
    translated_titles authors corporative_authors affiliations countries document_publication_date processing_date issue_publication_date volume
    issue_number supplement elocation start_page end_page start_page_sequence receive_date_iso review_date_iso acceptance_date_iso licenses
    translated_languages original_abstract translated_abstracts keyword_groups fulltexts xml_body title_by_language abstract_by_language citations
    errors""".split()
)

#: Rules that leave a tree as it is if it has none of these tags.
NEEDS: dict[Rule, set[str]] = {
    styles: {"span"},
    symbol_font: {"font-face-symbol"},
    author_notes: {"corresp", "email"},
    sup_to_xref: {"sup", "xref"},
    acknowledgements: {"ack"},
}


def parse_xml(text: str) -> Node:
    """Well-formed XML as a tree; case and names are kept."""
    import xml.etree.ElementTree as ET

    def convert(e: ET.Element) -> Node:
        node = Node(e.tag, dict(e.attrib), e.text or "", e.tail or "")
        for c in e:
            node.add(convert(c))
        return node

    names = re.sub(r"\b(xml|xlink|mml):(?=[\w-]+)", r"\1__", text)
    root = Node("root")
    try:
        root.add(convert(ET.fromstring(names)))
    except ET.ParseError:
        return parse(text)
    if "__" not in names:
        return root
    for n in root.all():
        n.tag = n.tag.replace("__", ":") if n.tag.startswith(("xml__", "xlink__", "mml__")) else n.tag
        n.attrs = {re.sub(r"^(xml|xlink|mml)__", r"\1:", k): re.sub(r"\b(xml|xlink|mml)__(?=[\w-]+)", r"\1:", v) for k, v in n.attrs.items()}
        n.text, n.tail = (re.sub(r"\b(xml|xlink|mml)__(?=[\w-]+)", r"\1:", t) for t in (n.text, n.tail))
    return root


def build(d: Doc) -> tuple[Node, list[dict]]:
    """The article tree of a document's attributes, and error rows; a rule that fails is skipped."""
    xml, tags = Node("article"), None
    for rule in RULES:
        if rule in NEEDS:
            tags = {n.tag for n in xml.all()} if tags is None else tags
            if NEEDS[rule].isdisjoint(tags):
                continue
        tags = None
        try:
            rule(xml, d)
        except Exception as e:  # noqa: BLE001  a rule's failure is a row, not the job's
            d.setdefault("errors", []).append({"action": rule.__name__, "type": type(e).__name__, "message": str(e), "detail": ""})
    return xml, d.get("errors") or []


def serialize(xml: Node, doctype: str = DOCTYPE) -> str:
    xml.attrs = {"xmlns:xlink": "http://www.w3.org/1999/xlink", "xmlns:mml": "http://www.w3.org/1998/Math/MathML", **xml.attrs}
    return f'<?xml version="1.0" encoding="utf-8"?>\n{doctype}\n{write(xml)}\n'


RESULT = StructType([StructField("xml", StringType()), StructField("errors", ArrayType(ERROR))])


def article_xml(documents: Column, detector: Callable[[str], str | None] | None = None) -> Column:
    """(xml, errors) of documents given as JSON of their attributes; ``detector`` tells the language of a text."""

    @F.pandas_udf(RESULT)
    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                if text is None:
                    rows.append((None, None))
                    continue
                d = json.loads(text) | ({"detector": detector} if detector else {})
                xml, errors = build(d)
                rows.append((serialize(xml, (d.get("params") or {}).get("doctype", DOCTYPE)), errors))
            yield pd.DataFrame(rows, columns=["xml", "errors"])

    return work(documents)


def assemble_articles(docs: DataFrame, journals: DataFrame, cited: DataFrame, bodies: DataFrame | None = None, licenses: DataFrame | None = None) -> DataFrame:
    """(pid, xml, errors): documents joined to their journal (by ISSN), citations, body (pid, xml_body) and licenses (pid, language, url, text).

    What has a row for each document is merged by pid: sizes guessed from narrow files make Spark broadcast it, whole, through the driver.
    """
    refs = cited.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("n", citations.as_json(cited, tuple(set(cited.columns) - citations.READ)).alias("c")))).alias("_refs"))
    j = journals.select(F.col("issn_id").alias("_issn"), F.struct("acronym", "title", "abbreviated_title", "print_issn", "electronic_issn", "publisher_name", "publisher_city", "publisher_state", "publisher_country").alias("journal"))
    own = ["pid", *[c for c in docs.columns if c in READ and c != "citations"]]
    rows = docs.select(*own).join(refs.hint("merge"), "pid", "left").join(j, F.substring("pid", 2, 9) == F.col("_issn"), "left")
    if bodies is not None:
        rows = rows.join(bodies.select("pid", "xml_body").hint("merge"), "pid", "left")
    if licenses is not None:
        own_licenses = licenses.groupBy("pid").agg(F.collect_list(F.struct("language", "url", "text")).alias("licenses"))
        rows = rows.join(own_licenses.hint("merge"), "pid", "left")
    rows = rows.drop("_issn")
    joined = F.concat(F.lit("["), F.array_join(F.transform(F.coalesce("_refs", F.array().cast("array<struct<n:int,c:string>>")), lambda x: x["c"]), ","), F.lit("]"))
    text = F.to_json(F.struct(*[c for c in rows.columns if c != "_refs"]))
    # citations are JSON already: they take their place at the object's end
    whole = F.concat(F.regexp_replace(text, r"\}$", ""), F.when(F.length(text) > 2, ",").otherwise(""), F.lit('"citations":'), joined, F.lit("}"))
    made = article_xml(whole)
    return rows.select("pid", made.alias("a")).select("pid", "a.xml", "a.errors")
