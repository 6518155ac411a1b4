"""Citation records as ref elements with an element-citation.

Each part of an element-citation is a rule of the table PARTS, in their order: a function from a citation's attributes (as
entities.citations() has them) to the nodes it adds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioframe.operators.trees import Node, clean, element, mixed_citation, write

XLINK = "xlink:href"


def _simple(tag: str, key: str, **attrs: str):
    """A rule for one text attribute."""

    def rule(c: dict) -> list[Node]:
        return [Node(tag, {k.replace("_", "-"): v for k, v in attrs.items()}, clean(c[key]))] if c.get(key) else []

    return rule


def _group_type(people: list[dict]) -> str:
    role = people[-1].get("role")
    return "authors" if not role or role.lower() == "nd" else role


def person_group(people: list[dict] | None) -> list[Node]:
    if not people:
        return []
    group = Node("person-group", {"person-group-type": _group_type(people)})
    for p in people:
        name = Node("name")
        for key, tag in (("surname", "surname"), ("given_names", "given-names")):
            if p.get(key):
                name.sub(tag, p[key])
        if p.get("anonymous"):
            name.sub("anonymous")
        if name.children:
            group.add(name)
    return [group]


def collab_group(bodies: list[dict] | None) -> list[Node]:
    if not bodies:
        return []
    group = Node("person-group", {"person-group-type": _group_type(bodies)})
    for b in bodies:
        text = ", ".join(x for x in (b.get("name"), b.get("division")) if x)
        if text:
            group.sub("collab", text)
    return [group]


def authors(c: dict) -> list[Node]:
    """Persons, then bodies, of analytic, monographic and serial level; etal goes to the first group if there are serial bodies."""
    levels = ("analytic", "monographic", "serial")
    out = [g for x in levels for g in person_group(c.get(f"{x}_person_authors"))] + [g for x in levels for g in collab_group(c.get(f"{x}_corporative_authors"))]
    if out and c.get("serial_corporative_authors") and c.get("etal"):
        out[0].sub("etal")
    return out


def _place(tag: str, place: dict | None, country: str | None) -> list[Node]:
    node = Node(tag)
    for key in ("city", "state"):
        if (place or {}).get(key):
            node.sub(key, place[key])
    if country:
        node.sub("country", country)
    return [node] if node.children else []


def conference(c: dict) -> list[Node]:
    if c.get("publication_type") != "confproc":
        return []
    out = _simple("conf-name", "conference_name")(c)
    if c.get("conference_date_iso"):
        out.append(Node("conf-date", {"iso-8601-date": iso_date(c["conference_date_iso"])}, clean(c.get("conference_date"))))
    return out + _place("conf-loc", c.get("conference_location"), c.get("conference_country")) + _simple("conf-sponsor", "conference_sponsor")(c)


def thesis(c: dict) -> list[Node]:
    if c.get("publication_type") != "thesis":
        return []
    return _simple("publisher-name", "thesis_institution")(c) + _place("publisher-loc", c.get("thesis_location"), c.get("thesis_country")) + _simple("comment", "thesis_degree", content_type="degree")(c)


def publication(c: dict) -> list[Node]:
    return _simple("publisher-name", "publisher_name")(c) + _place("publisher-loc", c.get("publisher_location"), c.get("publisher_country"))


def patent(c: dict) -> list[Node]:
    if not c.get("patent"):
        return []
    country = c.get("patent_country")
    return [Node("patent", {"country": country} if country else {}, clean(" ".join(x for x in (country, c.get("patent_organization"), c.get("patent_id")) if x)))]


def size(c: dict) -> list[Node]:
    s = c.get("size") or {}
    return [Node("size", {"units": s.get("unit") or "pages"}, clean(s["size"]))] if s.get("size") else []


def publication_ids(c: dict) -> list[Node]:
    return [n for kind in ("pmid", "pmcid", "doi") for n in _simple("pub-id", kind, pub_id_type=kind)(c)]


def date(c: dict) -> list[Node]:
    """By places in a dashed date, as the records' home system reads it: of undashed dates only the year is sound."""
    text = c.get("publication_date")
    if not text:
        return []
    node = Node("date")
    for tag, part in (("year", text[0:4]), ("month", text[5:7]), ("day", text[8:10])):
        if part.isdigit() and int(part):
            node.sub(tag, part)
    return [node, Node("year", text=clean(text[0:4]))]


def date_in_citation(c: dict) -> list[Node]:
    """Access dates, but only where there is a date of a patent application too."""
    access, applied = c.get("access_date") or c.get("access_date_iso"), c.get("patent_application_date") or c.get("patent_application_date_iso")
    if not (access and applied):
        return []
    iso = iso_date(c.get("access_date_iso") or c.get("patent_application_date_iso") or "")
    return [Node("date-in-citation", {"content-type": "access-date", "iso-8601-date": iso}, clean(c.get("access_date") or c.get("patent_application_date")))]


def link(c: dict) -> list[Node]:
    if not c.get("ext_link"):
        return []
    node = Node("ext-link", {"ext-link-type": "uri", XLINK: f"http://{c['ext_link']}"}, clean(c["ext_link"]))
    if not c.get("comment"):
        return [node]
    comment = Node("comment", text=clean(c["comment"]))
    comment.add(node)
    return [comment]


def comment(c: dict) -> list[Node]:
    return [] if c.get("ext_link") else _simple("comment", "comment")(c)


def project(c: dict) -> list[Node]:
    return [n for key in ("name", "number") for n in _simple("comment", f"project_{key}", content_type=f"project-{key}")(c)] + _simple("comment", "sponsor", content_type="project-sponsor")(c)


def iso_date(text: str) -> str:
    """Year, month and day of YYYYMMDD, each only if it and those before it are numbers other than zero."""
    out = []
    for part in (text[:4], text[4:6], text[6:8]):
        if not part.isdigit() or not int(part):
            break
        out.append(str(int(part)))
    return "-".join(out)


PARTS = [
    authors,
    _simple("article-title", "article_title_text"),
    _simple("chapter-title", "chapter_title"),
    _simple("data-title", "data_title"),
    _simple("source", "source"),
    conference,
    thesis,
    publication,
    patent,
    _simple("volume", "volume_text"),
    _simple("issue", "issue_number"),
    _simple("supplement", "supplement"),
    _simple("issue-part", "issue_part"),
    _simple("issue-title", "issue_title"),
    _simple("elocation-id", "elocation"),
    _simple("page-range", "page_range"),
    size,
    _simple("fpage", "start_page"),
    _simple("lpage", "end_page"),
    _simple("issn", "issn"),
    publication_ids,
    date,
    _simple("edition", "edition"),
    _simple("isbn", "isbn"),
    _simple("version", "version"),
    _simple("series", "serie"),
    date_in_citation,
    link,
    comment,
    project,
]


#: Attributes of a citation that the parts and ref() read; those of a new part are to be named here.
READ = set(
    """index_number paragraph_text publication_type etal article_title_text chapter_title data_title source conference_name conference_date_iso conference_date
    conference_location conference_country conference_sponsor thesis_institution thesis_location thesis_country thesis_degree publisher_name
    publisher_location publisher_country patent patent_country patent_organization patent_id volume_text issue_number supplement issue_part issue_title
    elocation page_range size start_page end_page issn pmid pmcid doi publication_date edition isbn version serie access_date access_date_iso
    patent_application_date patent_application_date_iso ext_link comment project_name project_number sponsor""".split()
) | {f"{level}_{who}_authors" for level in ("analytic", "monographic", "serial") for who in ("person", "corporative")}


def ref(c: dict) -> Node:
    """The ref element of a citation's attributes."""
    node = Node("ref", {"id": f"B{c.get('index_number') or ''}"})
    if c.get("paragraph_text"):
        mixed = node.add(element("mixed-citation", c["paragraph_text"], drop=("p", "span", "font")))
        jats_tags(mixed)
    cited = node.sub("element-citation", publication_type=c.get("publication_type") or "other")
    for rule in PARTS:
        for n in rule(c):
            cited.add(n)
    return node


def jats_tags(node: Node) -> None:
    """HTML emphasis and web links by their names in XML."""
    names = {"strong": "bold", "b": "bold", "em": "italic", "i": "italic", "u": "underline", "small": "sc"}
    for n in node.all(*names):
        n.tag = names[n.tag]
    for a in node.all("a", where=lambda n: (n.get("href") or "").startswith("http")):
        a.tag, a.attrs = "ext-link", {"ext-link-type": "uri", XLINK: a.attrs["href"]}


@F.pandas_udf(StringType())
def ref_xml(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """XML of citations given as JSON of their attributes."""
    for s in rows:
        yield s.map(lambda x: None if x is None else write(ref(json.loads(x))))


def as_json(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    return F.to_json(F.struct(*[c for c in df.columns if c not in without]))


def with_ref_xml(cited: DataFrame) -> DataFrame:
    """Adds ``ref_xml`` to entities.citations()."""
    return cited.withColumn("ref_xml", ref_xml(as_json(cited, ("c_record", "path", "grp"))))


@F.pandas_udf(StringType())
def mixed_citations(paragraphs: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Mixed citations, as XML, of the paragraphs of references."""
    for s in paragraphs:
        yield s.map(lambda x: None if x is None or (node := mixed_citation(x)) is None else write(node))
