"""First-match-wins classification by pattern tables, as Columns for tables and as plain functions for trees."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioframe.functions import pattern_tables as T
from folioframe.functions.columns import let


class Table:
    """Ordered (pattern, result) rows. Patterns mind Unicode and, but where they say ``(?c)``, no case."""

    def __init__(self, rows: Sequence[tuple[str, str]], anchored: bool = True):
        self.rows = [(p.removeprefix("(?c)"), not p.startswith("(?c)"), r) for p, r in rows]
        self.anchored = anchored
        self._compiled = [(re.compile(p, re.IGNORECASE if loose else 0), r) for p, loose, r in self.rows]

    def match(self, text: str) -> str | None:
        for pattern, result in self._compiled:
            if pattern.match(text) if self.anchored else pattern.search(text):
                return result
        return None

    def column(self, text: Column) -> Column:
        out = None
        for pattern, loose, result in self.rows:
            java = ("(?iU)" if loose else "(?U)") + (f"^(?:{pattern})" if self.anchored else pattern)
            out = F.when(text.rlike(java), result) if out is None else out.when(text.rlike(java), result)
        return out

    def merged(self) -> Table:
        """Neighbouring rows of one result and case as one pattern: the same answers with fewer tests."""
        out: list[tuple[str, str]] = []
        for p, loose, r in self.rows:
            mark = "" if loose else "(?c)"
            if out and out[-1][1] == r and out[-1][0].startswith("(?c)") == (not loose):
                out[-1] = (out[-1][0] + f"|(?:{p})", r)
            else:
                out.append((f"{mark}(?:{p})", r))
        return Table(out, self.anchored)


def _spaced(pattern: str) -> str:
    return pattern.replace(" ", r"\s+")


def _any(patterns: Sequence[str]) -> str:
    return "|".join(map(_spaced, patterns))


def label_table(words: Mapping[str, Sequence[str]] = T.LABEL_WORDS, extra: Mapping[str, Sequence[str]] = T.LABEL_PATTERNS) -> Table:
    """A word with an optional number (of an appendix: a letter or digit) is a label; other patterns come after a type's words."""
    rows = []
    for kind, listed in words.items():
        end = r"(?:\s*[A-Z\d])?$" if kind == "app" else r"(?:\s*\d+)?$"
        if listed:
            rows.append((f"(?:{_any(listed)}){end}", kind))
        rows += [(p, kind) for p in extra.get(kind, [])]
    return Table(rows).merged()


def prefix_table(patterns: Mapping[str, Sequence[str]], anchored: bool = True) -> Table:
    """Beginnings by type."""
    return Table([(f"(?:{_any(listed)})", kind) for kind, listed in patterns.items()], anchored)


LABELS = label_table()
IDS = Table(T.ID_PATTERNS).merged()
SECTIONS = prefix_table(T.SECTION_PATTERNS)
SECTION_PARTS = prefix_table(T.SECTION_PATTERNS, anchored=False)
COMBINED = Table(T.COMBINED_SECTIONS, anchored=False)
FOOTNOTES = prefix_table(T.FOOTNOTE_PATTERNS)
PARENTS = Table(T.TITLE_PARENTS).merged()

# Numbers before section titles.
_SECTION_NUMBERS = [
    r"^(\d+(?:\.\d+)*)\s*\.?\s+",
    r"^([A-Z])\s*\.\s+",
    r"^([A-Z])\s+",
    r"^([IVX]+)\s*\.\s+",
    r"^([IVX]+)\s+",
]
# Numbers before footnotes.
_FOOTNOTE_NUMBERS = [
    r"^(\d+)\.?\s*",
    r"^\[(\d+)\]",
    r"^\((\d+)\)",
    r"^([a-z])\.?\s*",
    r"^\[([a-z])\]",
    r"^\(([a-z])\)",
    r"^([A-Z])\.?\s*",
    r"^\[([A-Z])\]",
    r"^\(([A-Z])\)",
    r"^([*†‡§¶#]+)\s*",
]
# Numbers of labels.
_NUMBERS = [r"^(\d+)$", r"(\d+[A-Za-z]?)", r"([A-Z])(?:\s|$)", r"([a-z])(?:\s|$)", r"([*†‡§¶#]+)"]


def _first(text: Column, patterns: Sequence[str]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, "(?U)" + p, 1), F.lit("")) for p in patterns])


def _without_first(text: Column, patterns: Sequence[str]) -> Column:
    out = None
    for p in patterns:
        hit, rest = text.rlike("(?U)" + p), F.trim(F.regexp_replace(text, "(?U)" + p, ""))
        out = F.when(hit, rest) if out is None else out.when(hit, rest)
    return out.otherwise(text)


def _py_first(text: str, patterns: Sequence[str]) -> str | None:
    return next((m[1] for p in patterns if (m := re.search(p, text))), None)


def _py_without_first(text: str, patterns: Sequence[str]) -> str:
    return next((text[m.end() :].strip() for p in patterns if (m := re.match(p, text))), text)


# ---- cross references --------------------------------------------------------------------------


def element_of(ref_type: Column) -> Column:
    out = None
    for kind, element in T.ELEMENTS.items():
        out = F.when(ref_type == kind, element) if out is None else out.when(ref_type == kind, element)
    return out.otherwise(ref_type)


def py_element_of(ref_type: str | None) -> str | None:
    return T.ELEMENTS.get(ref_type, ref_type)


def number_in(text: Column) -> Column:
    """The first number, letter or symbol of a label."""
    return _first(F.trim(text), _NUMBERS)


def type_from_id(rid: Column, table: Table = IDS) -> Column:
    """(ref_type, element) that an id tells."""
    return let(table.column(rid), lambda kind: F.struct(kind.alias("ref_type"), element_of(kind).alias("element")))


def type_from_label(text: Column, table: Table = LABELS) -> Column:
    """(ref_type, element, prefix, number) that a label tells."""
    prefix = F.create_map(*[F.lit(x) for prefix, kind in T.ID_PREFIXES.items() for x in (kind, prefix)])

    def told(x: Column) -> Column:
        kind = x["kind"]
        return F.struct(
            kind.alias("ref_type"),
            element_of(kind).alias("element"),
            F.coalesce(F.try_element_at(prefix, kind), kind).alias("prefix"),
            F.when(kind.isNotNull(), number_in(x["text"])).alias("number"),
        )

    return let(F.trim(text), lambda t: let(F.struct(t.alias("text"), table.column(t).alias("kind")), told))


def analyze_xref(text: Column, rid: Column, labels: Table = LABELS, ids: Table = IDS) -> Column:
    """Type of a cross reference by its whole text, else its first word, else its id; source, and whether text and id agree."""
    whole, word = type_from_label(text, labels), type_from_label(F.split(F.trim(text), r"\s+")[0], labels)
    by_text = let(whole, lambda w: F.when(w["ref_type"].isNotNull(), w).otherwise(word))

    def told(x: Column) -> Column:
        t, i = x["text"], x["id"]
        has_text, has_id, same = t["ref_type"].isNotNull(), i["ref_type"].isNotNull(), t["ref_type"] == i["ref_type"]
        return F.struct(
            F.coalesce(t["ref_type"], i["ref_type"]).alias("ref_type"),
            F.when(has_text, t["element"]).otherwise(i["element"]).alias("element"),
            F.when(has_text, t["prefix"]).alias("prefix"),
            F.when(has_text, t["number"]).alias("number"),
            F.when(has_id & (~has_text | same), rid).alias("rid"),
            F.when(has_text & has_id & same, "both").when(has_text, "text").when(has_id, "id").alias("source"),
            F.when(has_text & has_id, same).alias("consistent"),
        )

    return let(F.struct(by_text.alias("text"), type_from_id(rid, ids).alias("id")), told)


def py_analyze_xref(text: str | None, rid: str | None) -> str | None:
    """The type alone, for trees."""
    kind = None
    if text and text.strip():
        kind = LABELS.match(text.strip()) or LABELS.match(text.split()[0])
    return kind or (IDS.match(rid) if rid else None)


# ---- sections ----------------------------------------------------------------------------------


def section_type(title: Column) -> Column:
    """Type of a section title; two types in one are joined by a bar."""
    kinds = lambda p: F.array_compact(F.array(*[F.when(p.rlike(f"(?iU){x}"), F.lit(k)) for x, _, k in SECTION_PARTS.rows]))

    def told(t: Column) -> Column:
        parts = F.split(F.lower(t), "(?U)" + T.CONNECTORS)
        # by part, then by order of types
        found = F.array_distinct(F.flatten(F.transform(parts, lambda p: kinds(F.trim(p)))))
        several = F.when(F.size(parts) > 1, let(found, lambda f: F.when(F.size(f) > 1, F.array_join(f, "|"))))
        return F.coalesce(let(F.lower(t), COMBINED.column), several, SECTIONS.column(t))

    return let(F.trim(title), told)


def py_section_type(title: str) -> str | None:
    title = title.strip()
    low = title.lower()
    if kind := COMBINED.match(low):
        return kind
    parts = re.split(T.CONNECTORS, low)
    if len(parts) > 1:
        found = list(dict.fromkeys(r for p in parts for c, r in SECTION_PARTS._compiled if c.search(p.strip())))
        if len(found) > 1:
            return "|".join(found)
    return SECTIONS.match(title)


def section_number(title: Column) -> Column:
    return _first(F.trim(title), _SECTION_NUMBERS)


def section_type_and_number(title: Column) -> Column:
    title = F.trim(title)
    return F.struct(section_type(_without_first(title, _SECTION_NUMBERS)).alias("sec_type"), section_number(title).alias("number"))


def section_id(title: Column, default: Column | str = "1") -> Column:
    default = F.lit(default) if isinstance(default, str) else default
    return F.concat(F.lit("sec"), F.coalesce(F.replace(section_number(title), F.lit("."), F.lit("_")), default))


# ---- footnotes ---------------------------------------------------------------------------------


def footnote_type(title: Column, table: Table = FOOTNOTES) -> Column:
    """Type of a footnote by its text after a leading symbol or number, else by the symbol."""
    symbols = F.create_map(*[F.lit(x) for pair in T.FOOTNOTE_SYMBOLS.items() for x in pair])

    def told(t: Column) -> Column:
        by_symbol = F.try_element_at(symbols, F.substring(t, 1, 1))
        rest = F.when(by_symbol.isNotNull(), F.trim(F.substr(t, F.lit(2)))).otherwise(t)
        return F.coalesce(let(F.trim(let(rest, lambda r: _without_first(r, _FOOTNOTE_NUMBERS))), table.column), by_symbol)

    return let(F.trim(title), told)


def py_footnote_type(title: str, table: Table = FOOTNOTES) -> str | None:
    title = title.strip()
    for symbol, kind in T.FOOTNOTE_SYMBOLS.items():
        if title.startswith(symbol):
            return table.match(_py_without_first(title[len(symbol) :].strip(), _FOOTNOTE_NUMBERS)) or kind
    return table.match(_py_without_first(title, _FOOTNOTE_NUMBERS))


def footnote_number(text: Column) -> Column:
    return _first(text, _FOOTNOTE_NUMBERS)


def footnote_id(number: Column) -> Column:
    """``fn`` and the number; symbols are spelled out."""
    named = F.when(number == "*", "ast").when(number == "**", "ast2").when(number == "†", "dag").when(number == "††", "dag2").when(number == "‡", "ddag").otherwise(F.regexp_replace(number, "[^A-Za-z0-9]", ""))
    return F.concat(F.lit("fn"), F.coalesce(F.nullif(named, F.lit("")), F.lit("1")))


# ---- titles ------------------------------------------------------------------------------------


# Element, confidence and explanation of a title, the first row that holds. A row holds where all the facts
# named first are true and all named second false: fn, sec (a type of footnote or section matches), worded (it begins as sections
# do), back (it stands in the back matter), symbol (it begins with a footnote symbol), dotted (its number has a dot).
TITLE_DECISIONS = [
    ("sec worded", "", "sec", "high", "section"),
    ("fn", "sec", "fn", "high", "footnote"),
    ("sec", "fn", "sec", "high", "section"),
    ("fn sec back", "", "fn", "medium", "footnote (in back)"),
    ("fn sec symbol", "", "fn", "high", "footnote (symbol)"),
    ("fn sec dotted", "", "sec", "high", "section (numbered)"),
    ("fn sec", "", "sec", "low", "ambiguous (defaulting to section)"),
]
# Titles of one element whatever else they match, in this order.
TITLE_ELEMENTS = [(_any(T.REFERENCES), "ref-list"), (_any(T.ACKNOWLEDGEMENT), "ack")]
_SYMBOL = "[*†‡§¶#]"


def element_type(title: Column, context: Column | str | None = None) -> Column:
    """What a title heads: (element_type, type_attribute, confidence, detected_as, suggested_id, number)."""
    context = F.lit(context).cast("string") if context is None or isinstance(context, str) else context
    names = ("element_type", "type_attribute", "confidence", "detected_as", "suggested_id", "number")

    def answer(*values) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v).cast("string")).alias(n) for n, v in zip(names, values, strict=True)])

    def told(x: Column) -> Column:
        t = x["title"]
        facts = {
            "fn": x["fn"].isNotNull(),
            "sec": x["sec"].isNotNull(),
            "worded": t.rlike(f"(?iU)^(?:{T.NOT_FOOTNOTE})"),
            "back": context.eqNullSafe(F.lit("back")),
            "symbol": t.rlike("^" + _SYMBOL),
            "dotted": F.coalesce(x["number"].contains("."), F.lit(False)),
        }
        note = footnote_number(t)
        out = F.when(t.isNull() | (t == ""), answer(*[None] * 6))
        for pattern, element in TITLE_ELEMENTS:
            out = out.when(t.rlike(f"(?iU){pattern}"), answer(element, *[None] * 5))
        for true, false, element, confidence, label in TITLE_DECISIONS:
            holds = F.lit(True)
            for name in true.split():
                holds = holds & facts[name]
            for name in false.split():
                holds = holds & ~facts[name]
            ids = (footnote_id(note), note) if element == "fn" else (section_id(t), x["number"])
            out = out.when(holds, answer(element, x[element], confidence, F.concat(F.lit(label + ": "), x[element]), *ids))
        return out.otherwise(answer(None, None, "none", "unidentified", None, None))

    facts = lambda t: F.struct(t.alias("title"), footnote_type(t).alias("fn"), section_type(_without_first(t, _SECTION_NUMBERS)).alias("sec"), section_number(t).alias("number"))
    return let(F.trim(title), lambda t: let(facts(t), told))


def py_element_type(title: str, context: str | None = None) -> tuple[str | None, str | None]:
    """(element, type attribute), for trees."""
    title = title.strip()
    if not title:
        return None, None
    for pattern, element in TITLE_ELEMENTS:
        if re.search(pattern, title, re.IGNORECASE):
            return element, None
    kinds = {"fn": py_footnote_type(title), "sec": py_section_type(_py_without_first(title, _SECTION_NUMBERS))}
    facts = {name for name, kind in kinds.items() if kind}
    facts |= {"worded"} if re.match(T.NOT_FOOTNOTE, title, re.IGNORECASE) else set()
    facts |= {"back"} if context == "back" else set()
    facts |= {"symbol"} if re.match(_SYMBOL, title) else set()
    facts |= {"dotted"} if "." in (_py_first(title, _SECTION_NUMBERS) or "") else set()
    for true, false, element, *_ in TITLE_DECISIONS:
        if facts.issuperset(true.split()) and facts.isdisjoint(false.split()):
            return element, kinds[element]
    return None, None


def title_parent(title: Column, table: Table = PARENTS) -> Column:
    """The element that a title belongs to; a numbered title without a pattern heads a section."""
    return let(F.lower(F.trim(title)), lambda low: F.coalesce(table.column(low), F.when(low.rlike(r"(?U)^\d+\.?\d*\.?\s+\w+"), "sec")))


def py_title_parent(title: str) -> str | None:
    low = title.strip().lower()
    return PARENTS.match(low) or ("sec" if re.match(r"\d+\.?\d*\.?\s+\w+", low) else None)


def asset_type(path: Column) -> Column:
    """(asset_type, mimetype, mime_subtype) by lower-case extension."""
    names = ("asset_type", "mimetype", "mime_subtype")
    row = lambda values: F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values, strict=True)])
    table = F.create_map(*[x for extension, values in T.ASSET_TYPES.items() for x in (F.lit(extension), row(values))])
    found = F.try_element_at(table, F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)))
    return F.coalesce(found, row(("other", "application", "octet-stream")))


# ---- fuzzy section types -----------------------------------------------------------------------

# Names that a short title may come close to; those after the types are no sections.
SECTION_NAMES = ("cases", "conclusions", "data-availability", "discussion", "intro", "materials", "methods", "results", "subjects", "supplementary-material", "transcript")
NO_SECTIONS = ("abstract", "resumen", "references", "agradecimientos", "acknownledge")
SAME_AS = {"literatura citada": "references"}


def py_close_names(title: str, n: int = 1, least: float = 0.1) -> list[str]:
    """The names most like the title."""
    return difflib.get_close_matches(title, [*SECTION_NAMES, *NO_SECTIONS], n, least)


def py_fuzzy_section_type(title: str) -> str | None:
    """Types of a title of up to three words by likeness: of three words, of the first and the last; null beyond."""
    words = title.split(" ")
    if len(words) > 3:
        return None
    asked = [words[0], words[-1]] if len(words) == 3 else [SAME_AS.get(title, title)]
    found = [m for w in asked for m in py_close_names(w, 1, 0.6 if len(words) == 3 else 0.4)]
    return "|".join(m for m in found if m not in NO_SECTIONS)


@F.pandas_udf(StringType())
def fuzzy_section_type(titles: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in titles:
        known = {t: py_fuzzy_section_type(t) for t in s.dropna().unique()}
        yield s.map(lambda t, known=known: None if t is None else known[t])
