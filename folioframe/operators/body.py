"""Full text in HTML to XML body and back.

A document is parsed once; the steps are functions over the tree, each a list of rules in a fixed order, and
the XML after every step can be had. A step that fails leaves an error row and the tree as it was before it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from folioframe.functions import pattern_tables as T
from folioframe.functions import text as tx
from folioframe.functions.patterns import IDS, LABELS, py_analyze_xref, py_element_of, py_element_type, py_section_type, py_title_parent
from folioframe.operators.trees import Node, element, parse, write

STYLES = ("bold", "sup", "sub", "italic", "underline")
# Plain renames of HTML elements.
RENAMED = {
    "dir": "ul",
    "dl": "def-list",
    "dd": "def-item",
    "em": "italic",
    "i": "italic",
    "b": "bold",
    "strong": "bold",
    "u": "underline",
    "small": "sc",
    "br": "break",
    "blockquote": "disp-quote",
}
EMPTY_GO = ("div", "p", "span", "font", "italic", "bold", "sup", "sub", "b", "i")


class Context:
    """What the rules need to know of the document."""

    def __init__(self, acronym: str | None = None, stem: str | None = None, files: dict[str, str] | None = None):
        self.acronym, self.stem, self.files = (acronym or "").lower(), stem, files or {}


def _roots(xml: Node) -> list[Node]:
    return xml.all("body", "back")


def _unwrap_all(root: Node, *tags: str) -> None:
    for n in root.all(*tags):
        n.unwrap()


# ---- step 10, 20: from parts to body and back --------------------------------------------------


def _fill(node: Node, html: str | None) -> None:
    root = parse(html or "")
    if node.children:
        node.children[-1].tail += root.text
    else:
        node.text = root.text
    for c in list(root.children):
        node.add(c)


def assemble(parts: dict) -> Node:
    """article/body/back of the parts (before, references, after), a sub-article for each translation."""
    article = Node("article")
    body, back = article.sub("body"), article.sub("back")
    _fill(body, parts.get("before"))
    refs = parts.get("references") or []
    if refs:
        ref_list = back.sub("ref-list")
        for i, r in enumerate(refs, 1):
            mixed = element("mixed-citation", r.get("text"), drop=())
            for n in mixed.all(where=lambda n: n.tag not in ("a", "i", "italic", "b", "bold", "sup", "sub", "em", "strong", "u")):
                n.unwrap()
            if mixed.content().strip():
                ref = ref_list.sub("ref", id=f"B{r.get('reference_index') or i}")
                ref.add(mixed)
    _fill(back, parts.get("after"))
    for i, (lang, t) in enumerate(sorted((parts.get("translations") or {}).items()), 1):
        sub = article.sub("sub-article", article_type="translation", id=f"s0{i}", xml__lang=lang)
        _fill(sub.sub("body"), t.get("before"))
        if t.get("after"):
            _fill(sub.sub("back"), t["after"])
    for n in article.all("script", "style", "head"):
        if n.tag != "head":
            n.remove()
        else:
            for t in n.all("title", "meta", "link"):
                t.remove()
            n.unwrap()
    for n in article.all("html"):
        n.unwrap()
    for n in article.all("body", where=lambda n: n.parent.tag not in ("article", "sub-article")):
        n.unwrap()
    return article


# ---- step 30: local HTML files -----------------------------------------------------------------


def embed_files(xml: Node, ctx: Context) -> None:
    """Links to local HTML files: the first embeds the file, later ones refer to it; nested files likewise."""
    seen: set[str] = set()

    def visit(root: Node, busy: tuple[str, ...]) -> None:
        for a in root.all("a", where=lambda n: bool(n.get("href"))):
            path, _, anchor = a.attrs["href"].partition("#")
            local = f"/{ctx.acronym}/" in path.lower() and re.search(r"\.html?$", path, re.IGNORECASE) and not path.startswith("mailto")
            if not (ctx.acronym and local):
                continue
            key = path.rsplit("/", 1)[-1]
            a.attrs = {"rid": anchor or re.sub(r"\.[^.]*$", "", key), "asset_type": "html"}
            a.tag = "xref"
            if key in seen or key in busy or key not in ctx.files:
                continue
            seen.add(key)
            box = Node("embedded", {"id": re.sub(r"\.[^.]*$", "", key)})
            for c in list(parse(ctx.files[key]).children):
                box.add(c)
            for n in box.all("a", where=lambda n: bool(n.get("name"))):
                n.attrs["name"] = box.attrs["id"] + n.attrs["name"]
            a.put_after(box)
            visit(box, (*busy, key))

    visit(xml, ())
    for n in xml.all("embedded"):
        n.tag = "div"


# ---- step 40: basic markup ---------------------------------------------------------------------


def _one_space(text: str) -> str:
    return re.sub(r"\s+", " ", text)


def normalize_space(xml: Node) -> None:
    for n in [xml, *xml.all()]:
        n.text, n.tail = _one_space(n.text), _one_space(n.tail)


def rename_elements(xml: Node) -> None:
    for n in xml.all("font"):
        if (n.get("face") or "").lower() == "symbol":
            n.tag = "font-face-symbol"
    for n in xml.all(*RENAMED):
        n.tag = RENAMED[n.tag]


def lists(xml: Node) -> None:
    for n in xml.all("ol", "ul"):
        n.attrs["list-type"] = "order" if n.tag == "ol" else "bullet"
        n.attrs.pop("list", None)
        n.tag = "list"
        for item in n.children:
            if item.content().strip():
                item.tag = "list-item"


def headings(xml: Node) -> None:
    for n in xml.all("h1", "h2", "h3", "h4", "h5", "h6"):
        n.tag, n.attrs = "title", {"content-type": n.tag}


def centered(xml: Node) -> None:
    for root in _roots(xml):
        for n in [c for c in root.children if c.tag == "center" or c.get("align") == "center"]:
            before = n.previous()
            if before is not None and before.tag == "a":
                n.add(before, 0)
            if n.first("img", "a"):
                n.tag = "p"
            elif not n.children and not n.content().strip():
                n.unwrap()
            else:
                n.tag = "p" if n.children else "title"


def style_attributes(xml: Node) -> None:
    for n in xml.all(where=lambda n: "style" in n.attrs):
        style = next((s for s in STYLES if s in n.attrs["style"]), None)
        if not style:
            continue
        if not n.content().strip():
            n.unwrap()
        elif n.tag == "p":
            n.put_before(Node("p")).add(n)
            n.tag = style
        elif all(c.tag in (*STYLES, "p") for c in n.children):
            n.tag = style


def font_sizes(xml: Node) -> None:
    """The largest size heads sections where it stands first; smaller ones mean nothing."""
    sized = {}
    for n in xml.all("font", where=lambda n: "size" in n.attrs):
        size = n.attrs["size"].removeprefix("+")
        if size.isdigit():
            sized[id(n)] = (n, int(size))
        else:
            n.attrs.pop("size")
    largest = max((s for _, s in sized.values()), default=0)
    for n, size in sized.values():
        if size < largest or not n.children or not n.content().strip():
            n.unwrap()
        elif not n.parent.text.strip() and n.parent.children[0] is n and not n.tail.strip() and not n.first("bold"):
            n.tag = "title"


def empty_tags(xml: Node) -> None:
    while empty := xml.all(*EMPTY_GO, where=lambda n: not n.children and not n.text.strip()):
        for n in empty:
            n.unwrap()


def spelling_spans(xml: Node) -> None:
    for n in xml.all("span", where=lambda n: n.get("class") == "SpellE"):
        n.unwrap()


# ---- step 50: breaks and paragraphs ------------------------------------------------------------


def single_breaks(xml: Node) -> None:
    for n in xml.all("break"):
        after = n.next() if n.parent else None
        if after is not None and after.tag == "break" and not n.tail.strip():
            n.remove()


def absent_paragraphs(xml: Node) -> None:
    """Bodies laid out by fonts and breaks: what stands between breaks becomes paragraphs."""
    for root in _roots(xml):
        if not root.first("font") or len(root.all("break")) < max(1, len(root.all("p"))):
            continue
        for font in root.all("font"):
            font.unwrap()
        for holder in {id(b.parent): b.parent for b in root.all("break")}.values():
            if holder.tag not in ("body", "back", "div"):
                continue
            run = Node("p", text=holder.text)
            pieces, children = [run], list(holder.children)
            for c in children:
                c.detach()
                if c.tag in ("break", "p", "title", "table", "list", "sec", "div"):
                    run = Node("p", text=c.tail)
                    c.tail = ""
                    if c.tag != "break":
                        pieces.append(c)
                    pieces.append(run)
                else:
                    run.add(c)
            holder.text = ""
            for p in pieces:
                if p.tag != "p" or p.children or p.text.strip():
                    holder.add(p)


def presentational_tags(xml: Node) -> None:
    _unwrap_all(xml, "font", "small", "big", "s", "lixo", "center", "span")


def open_paragraphs(xml: Node) -> None:
    for n in xml.all("p", where=lambda n: n.get("type") in ("open", "close")):
        if n.get("type") == "close":
            n.unwrap()
            continue
        n.attrs.pop("type")
        n.text, n.tail = n.text + n.tail, ""
        for after in n.following():
            if after.tag in ("p", "div", "title", "sec", "table"):
                break
            n.add(after)


# Tags that end a group of loose content, and tags that begin one by themselves.
_ENDS_GROUP = ("sec", "ref-list", "ack", "fn-group", "title")
_BEGINS_GROUP = ("table", "list", "disp-quote")


def group_loose(root: Node, stop: str) -> None:
    """Loose children go into elements of the tag ``stop``: into the one before them, or into a new one where none is open."""
    if not any(c.tag == stop or c.first(stop) for c in root.children):
        return
    lead, open_ = root.text, None
    root.text = ""
    for c in list(root.children):
        if c.tag in _ENDS_GROUP:
            open_ = None
            continue
        begins = c.tag in _BEGINS_GROUP or c.tag == "bold" and not c.tail.strip()
        if c.tag == stop or not begins and c.first(stop):  # a group already, or what holds one
            if c.tag == stop and not c.children and not c.text.strip():
                c.text, c.tail = c.text + c.tail, ""
            c.tag, open_ = stop, c
            continue
        if begins or open_ is None:
            open_ = Node(stop)
            c.put_before(open_)
        open_.add(c)
    if lead.strip():
        root.add(Node(stop, text=lead), 0)


def wrap_loose(xml: Node) -> None:
    for root in _roots(xml):
        group_loose(root, "div" if any(c.tag == "div" for c in root.children) else "p")


def divisions(xml: Node) -> None:
    for n in xml.all("div"):
        if n.first("p", "title", "sec"):
            n.unwrap() if not n.child("title") else setattr(n, "tag", "sec")
        else:
            n.tag = "p"


# ---- step 60: links and anchors ----------------------------------------------------------------


def sources(xml: Node) -> None:
    for a in xml.all("a"):
        if not a.get("href") and a.get("src"):
            a.attrs["href"] = a.attrs.pop("src")
    for n in xml.all("img"):
        n.tag = "graphic"
        n.attrs = {"xlink:href": n.attrs.get("src", ""), **({"id": n.attrs["id"]} if n.get("id") else {})}


# Kinds of links, the first row that holds. A row names the kind, what is searched (the address, the text, or the address of
# a link in a reference) and the pattern; where it has {acronym}, it holds only if the journal has one.
LINK_KINDS = [
    ("email", "href", r"mailto|@"),
    ("email", "text", r"@"),
    ("internal", "href", r"^#"),
    ("asset", "href", r"(?is)^(?!http)(?=.*{acronym}).*/[^/]+\.\w{2,5}(#.*)?$"),
    ("external", "cited", r"(?i)/{acronym}/"),
    ("asset", "href", r"(?i)/{acronym}/"),
    ("asset", "href", r"(?i)img/revistas/|\.\."),
    ("external", "href", r":|www|^http"),
    ("external", "href", r"^(?=[^/]*\.)(?=[^/]*[^./])"),
]


@lru_cache(maxsize=256)
def _link_rules(acronym: str | None) -> list[tuple[str, str, str]]:
    named = [(kind, where, p.replace("{acronym}", re.escape(acronym or ""))) for kind, where, p in LINK_KINDS]
    return [new for new, old in zip(named, LINK_KINDS, strict=True) if acronym or new == old]


def link_kind(href: str, text: str, acronym: str, in_ref: bool) -> str:
    """email, internal, asset, external or other."""
    searched = {"href": href, "text": text, "cited": href if in_ref else ""}
    return next((kind for kind, where, p in _link_rules(acronym) if re.search(p, searched[where])), "other")


def link_kind_of(href: Column, text: Column | None = None, acronym: str | None = None, in_ref: Column | None = None) -> Column:
    """link_kind() of Columns."""
    searched = {"href": href, "text": F.lit("") if text is None else text, "cited": F.lit("") if in_ref is None else F.when(in_ref, href).otherwise("")}
    out = None
    for kind, where, p in _link_rules(acronym):
        hit = searched[where].rlike(p)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("other")


def links(xml: Node, ctx: Context) -> None:
    for a in xml.all("a", where=lambda n: bool(n.get("href"))):
        href, text = a.attrs["href"].strip(), a.content()
        if href.count('"') == 2:
            href = href.replace('"', "")
        kind = link_kind(href, text, ctx.acronym, any(n.tag == "ref-list" for n in a.ancestors()))
        if kind == "email":
            words = [w for w in re.split(r"[\s:?]+", href.replace("mailto", "")) if "@" in w] or [w for w in text.split() if "@" in w]
            a.tag, a.attrs = "email", {}
            if words and "@" not in text:
                a.children, a.text = [], words[0]
        elif kind == "internal":
            rid = href.lstrip("#")
            if "top" in rid or "back" in rid:
                a.unwrap()
            else:
                a.tag, a.attrs = "xref", {"rid": rid}
        elif kind == "asset":
            path, _, anchor = href.partition("#")
            name = path.rsplit("/", 1)[-1]
            end = re.search(r"\.[^.]*$", name)
            asset, mime, sub = T.ASSET_TYPES.get((end[0] if end else "").lower(), ("other", "application", "octet-stream"))
            a.tag = "xref"
            a.attrs = {"rid": re.sub(r"\.[^.]*$", "", name), "path": path, "asset_type": asset, "mimetype": mime, "mime-subtype": sub}
            if asset == "html" and anchor:
                a.attrs["rid"] = anchor
        elif kind == "external":
            a.tag, a.attrs = "ext-link", {"ext-link-type": "uri", "xlink:href": href}


def image_assets(xml: Node) -> None:
    """Links to images become figures and tables after the paragraph, labelled by the links; a bare number keeps the label before it."""
    holders = {id(x.parent): x.parent for x in xml.all("xref", where=lambda n: n.get("asset_type") == "image" and bool(n.get("path")))}
    for holder in holders.values():
        word, made = None, []
        for x in [c for c in holder.children if c.tag == "xref" and c.get("asset_type") == "image"]:
            parts = x.content().split()
            if not parts:
                continue
            number = parts[-1] if parts[-1][0].isdigit() and len(parts) <= 2 else None
            word = word if number and len(parts) == 1 else parts[0]
            label = " ".join(p for p in (word, number) if p)
            kind = LABELS.match(label) if label else None
            tag = py_element_of(kind)
            if kind:
                x.attrs["ref-type"] = kind
            if not tag:
                continue
            rid = x.attrs["rid"]
            old = xml.first(where=lambda n, rid=rid: rid in (n.get("id"), n.get("name")))
            if old is not None:
                old.attrs["id"] = rid
            else:
                new = Node(tag, {"id": rid, "path": x.attrs["path"]})
                new.sub("label", label)
                new.sub("graphic", xlink__href=x.attrs["path"])
                made.append(new)
            x.attrs.pop("asset_type")
        for new in sorted(made, key=lambda n: n.attrs["id"], reverse=True):
            holder.put_after(Node("p")).add(new)


def other_assets(xml: Node) -> None:
    """Links to PDF and other files: a supplement for each path, once."""
    seen: set[str] = set()
    for x in xml.all("xref", where=lambda n: n.get("asset_type") not in (None, "image", "html")):
        path = x.attrs.get("path", "")
        x.attrs["ref-type"] = "supplementary-material"
        if path and path not in seen:
            seen.add(path)
            new = Node("supplementary-material", {"id": x.attrs["rid"], "mimetype": x.attrs.get("mimetype", ""), "mime-subtype": x.attrs.get("mime-subtype", ""), "xlink:href": path})
            x.parent.put_after(Node("p")).add(new)
        x.attrs = {"rid": x.attrs["rid"], "ref-type": "supplementary-material"}


def cross_references(xml: Node) -> None:
    """Types of references by text and id; the nodes they name take the type's element."""
    by_name: dict[str, list[Node]] = {}
    for n in xml.all(where=lambda n: bool(n.get("name"))):
        by_name.setdefault(n.attrs["name"], []).append(n)
    for x in xml.all("xref", where=lambda n: not n.get("ref-type") and bool(n.get("rid")) and bool(n.content().strip())):
        rid = x.attrs["rid"]
        kind = "corresp" if "corresp" in rid else py_analyze_xref(x.content(), rid)
        if not kind:
            continue
        if kind in ("number", "symbol", "letter"):
            target = next(iter(by_name.get(rid, [])), None) or xml.first(where=lambda n, rid=rid: n.get("id") == rid)
            places = {n.tag for n in target.ancestors()} if target is not None else set()
            kind = "bibr" if kind == "number" and "ref-list" in places else "fn" if "back" in places else "aff" if "body" in places else kind
        x.attrs["ref-type"] = kind
        tag = py_element_of(kind)
        for n in by_name.get(rid, []):
            if tag and n.tag == "a":
                n.tag, n.attrs = tag.split("//")[-1], {"id": rid}


def anchors(xml: Node) -> None:
    """Anchors by name: a repeated one goes, one for the page's top goes, others become what their name tells."""
    seen: set[str] = set()
    for a in xml.all("a", where=lambda n: bool(n.get("name"))):
        name = a.attrs["name"]
        if name in ("top", "back") or "top" in name or "back" in name:
            a.unwrap()
        elif name in seen:
            a.unwrap()
        else:
            seen.add(name)
            tag = py_element_of(IDS.match(name))
            a.tag, a.attrs = (tag.split("//")[-1] if tag else "target"), {"id": name}


# ---- step 70: figures and tables ---------------------------------------------------------------


def inline_graphics(xml: Node) -> None:
    for g in xml.all("graphic"):
        before = g.previous()
        text = before.tail if before is not None else g.parent.text
        if g.parent.tag not in ("fig", "table-wrap", "disp-formula") and (text.strip() or g.tail.strip()):
            g.tag = "inline-graphic"


def complete(xml: Node, container: str, wanted: tuple[str, ...]) -> None:
    """An empty container takes the nearest target after it: up to three siblings on, up to three levels up."""
    for box in xml.all(container, where=lambda n: bool(n.get("id"))):
        if box.first(*wanted):
            continue
        at: Node | None = box
        for _ in range(4):
            found = next((t for s in at.following()[:3] if (t := s if s.tag in wanted else s.first(*wanted)) is not None), None) if at.parent else None
            if found is not None:
                if found.parent.tag not in (container,):
                    box.add(found)
                break
            at = at.parent
            if at is None or at.tag in ("body", "back", "sec", "app", "article"):
                break


# ---- step 80: titles and sections --------------------------------------------------------------


def bold_titles(xml: Node) -> None:
    for b in xml.all("bold", where=lambda n: len(n.children) == 1 and n.children[0].tag == "p"):
        b.tag, b.children[0].tag = "p", "bold"
    for b in xml.all("bold"):
        after = b.next() if b.parent else None
        if after is not None and after.tag == "bold" and not b.tail:
            b.text, after.text = (b.text + after.text, "") if not b.children else (b.text, after.text)
            for c in list(after.children):
                b.add(c)
            after.unwrap()
    for n in xml.all(where=lambda n: bool(n.children) and n.children[0].tag == "bold"):
        head = n.children[0]
        if not head.tail.strip() and not n.text.strip() and n.tag not in ("title", "label", "mixed-citation"):
            head.tag = "title"
    for b in xml.all("bold", where=lambda n: n.child("title") is not None):
        b.unwrap()
    for t in xml.all("title"):
        if t.children and t.children[0].tag == "bold" and not t.children[0].tail.strip():
            t.children[0].unwrap()
        for b in [c for c in t.children if c.tag == "break"]:
            b.unwrap()


def collapse_nested(xml: Node) -> None:
    for root in _roots(xml):
        for tag in ("title", "p", "sec"):
            while True:
                nested = [n for n in root.all(tag) if n.children and {c.tag for c in n.children} == {tag} and not n.text.strip() and not n.children[-1].tail.strip()]
                if not nested:
                    break
                for n in nested:
                    n.unwrap()


def title_kind(text: str) -> tuple[str | None, str | None]:
    tag, kind = py_element_type(text)
    if tag:
        return tag, kind
    if kind := py_section_type(text):
        return "sec", kind
    if tag := py_title_parent(text):
        return tag, None
    return py_element_of(LABELS.match(text)), None


def title_parents(xml: Node) -> None:
    for root in _roots(xml):
        for parent in [n for n in root.all() if n.children and n.children[0].tag == "title" and not n.text.strip()]:
            title = parent.children[0]
            text = title.text.strip()
            if not text:
                title.unwrap()
                continue
            tag, kind = title_kind(text)
            if not tag:
                parent.attrs["title-unknown"] = "true"
            elif tag == "ref-list":
                if len(title.content().split()) <= 3:
                    parent.attrs["ref-list-title"] = "true"
            else:
                parent.tag = tag.split("//")[-1]
                if kind:
                    parent.attrs[f"{tag}-type"] = kind


def title_tails(xml: Node) -> None:
    for t in xml.all("title", where=lambda n: bool(n.tail.strip())):
        tail, t.tail = t.tail, ""
        p = Node("p", text=tail)
        for after in t.following():
            if after.tag not in ("italic", "bold", "sup", "sub", "xref", "ext-link", "email", "break"):
                break
            p.add(after)
        t.put_after(p)


def section_hierarchy(xml: Node) -> None:
    for body in xml.all("body"):
        for s in body.all("sec", where=lambda n: n.first("sec", where=lambda m: bool(m.get("sec-type"))) is not None):
            s.unwrap()


def sections(xml: Node) -> None:
    for root in _roots(xml):
        for s in root.all("sec", where=lambda n: bool(n.get("sec-type"))):
            while (after := s.next()) is not None and not (after.tag == "sec" and after.get("sec-type")):
                s.add(after)
        for n in root.all(where=lambda n: n.get("title-unknown") == "true"):
            if n.parent is not None and n.parent.get("sec-type"):
                n.tag = "sec"
        for s in root.all("sec", where=lambda n: not n.get("sec-type")):
            while (after := s.next()) is not None and after.tag != "sec":
                s.add(after)
        for n in root.all(where=lambda n: "title-unknown" in n.attrs):
            n.attrs.pop("title-unknown")


def reference_title(xml: Node) -> None:
    for body in xml.all("body")[:1]:
        holder = body.first(where=lambda n: n.get("ref-list-title") == "true")
        back = body.next()
        ref_list = back.first("ref-list") if back is not None and back.tag == "back" else None
        if holder is not None and holder.child("title") and ref_list is not None and not ref_list.child("title"):
            ref_list.add(holder.child("title"), 0)
    for n in xml.all(where=lambda n: "ref-list-title" in n.attrs):
        n.attrs.pop("ref-list-title")


def footnotes(xml: Node) -> None:
    for root in _roots(xml):
        for fn in root.all("fn", where=lambda n: not n.children):
            for after in fn.following():
                if after.tag == "fn" or after.get("id"):
                    break
                fn.add(after)
        for parent in root.all(where=lambda n: sum(c.tag == "fn" for c in n.children) > 1 and n.tag != "fn-group"):
            notes = [c for c in parent.children if c.tag == "fn"]
            if parent.tag in ("p", "sec", "div"):
                parent.tag = "fn-group"
            else:
                group = notes[0].put_before(Node("fn-group"))
                for n in notes:
                    group.add(n)


def acknowledgements(xml: Node) -> None:
    for ack in xml.all("ack"):
        after = ack.next()
        if after is not None and after.tag == "p":
            ack.add(after)


# ---- step 95: front matter ---------------------------------------------------------------------


def front_text(xml: Node) -> None:
    """The first correspondence and e-mail go to the back; what precedes the introduction goes."""
    for body in xml.all("body"):
        for tag in ("corresp", "email"):
            found = body.first(tag)
            if found is not None:
                back = body.next()
                if back is None or back.tag != "back":
                    back = body.put_after(Node("back"))
                back.add(found)
        intro = next((c for c in body.children if c.tag == "sec" and c.get("sec-type") == "intro"), None)
        if intro is not None:
            body.text = ""
            for c in body.children[: intro.index]:
                c.remove()


Rule = Callable[[Node, Context], None]


def _plain(*rules: Callable[[Node], None]) -> list[Rule]:
    return [lambda xml, ctx, r=r: r(xml) for r in rules]


STEPS: list[tuple[str, list[Rule]]] = [
    ("30 embed html", [embed_files]),
    ("40 basic html to xml", _plain(normalize_space, rename_elements, lists, headings, centered, style_attributes, font_sizes, spelling_spans, empty_tags)),
    ("50 break to p", _plain(single_breaks, absent_paragraphs, presentational_tags, open_paragraphs, wrap_loose, divisions)),
    ("60 ahref and aname", [*_plain(sources), links, *_plain(image_assets, other_assets, cross_references, anchors)]),
    ("70 fig and table-wrap", _plain(inline_graphics, lambda x: complete(x, "fig", ("graphic",)), lambda x: complete(x, "table-wrap", ("graphic", "table")))),
    ("80 sections", _plain(empty_tags, bold_titles, collapse_nested, title_parents, title_tails, section_hierarchy, sections, reference_title, footnotes, collapse_nested, acknowledgements)),
    ("95 front text", _plain(front_text)),
]


def convert(parts: dict, ctx: Context | None = None, snapshots: bool = False) -> tuple[Node, list[str], list[dict]]:
    """The article tree, the XML after each step (if asked for), and error rows."""
    ctx = ctx or Context()
    xml, steps, errors, done = assemble(parts), [], [], []
    for name, rules in STEPS:
        try:
            for rule in rules:
                rule(xml, ctx)
            done += rules
        except Exception as e:  # noqa: BLE001  a step's failure is a row, not the job's
            xml = assemble(parts)  # failures are rare, so the tree before one is made again rather than every tree copied
            for rule in done:
                rule(xml, ctx)
            errors.append({"action": name, "type": type(e).__name__, "message": str(e), "detail": ""})
        if snapshots:
            steps.append(write(xml))
    return xml, steps, errors


ERROR = StructType([StructField(c, StringType()) for c in ("action", "type", "message", "detail")])
RESULT = StructType([StructField("xml", StringType()), StructField("steps", ArrayType(StringType())), StructField("errors", ArrayType(ERROR))])


def convert_body(parts: Column, acronym: Column | None = None, files: dict[str, str] | Column | None = None, snapshots: bool = False) -> Column:
    """(xml, steps, errors) of parts as JSON: before, references (text, reference_index), after, translations by language.

    ``files`` holds local HTML files by name: a few that all rows share, or a map Column with each row's own (see embedded_files()); null parts give null.
    """
    shared = files if isinstance(files, dict) else None

    @F.pandas_udf(RESULT)
    def work(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, acronyms, held in batches:
            rows = []
            for text, own, found in zip(texts, acronyms, held, strict=True):
                if text is None:
                    rows.append({"xml": None, "steps": None, "errors": None})
                    continue
                xml, steps, errors = convert(json.loads(text), Context(own, files=json.loads(found) if found else shared), snapshots)
                rows.append({"xml": write(xml), "steps": steps, "errors": errors})
            yield pd.DataFrame(rows, columns=["xml", "steps", "errors"])

    own_files = F.to_json(files) if isinstance(files, Column) else F.lit(None).cast("string")
    return work(parts, F.lit(None).cast("string") if acronym is None else acronym, own_files)


def embedded_files(closure: DataFrame, pages: DataFrame) -> DataFrame:
    """(page, files): for each page the local pages that it reaches, from the pairs (page, embedded) and the contents (page, html), by file name."""
    named = pages.select(F.col("page").alias("embedded"), tx.base_name(F.col("page")).alias("name"), "html").filter("html IS NOT NULL")
    met = closure.select("page", "embedded").join(named, "embedded").groupBy("page", "name").agg(F.min("html").alias("html"))
    return met.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("name", "html"))).alias("files"))
