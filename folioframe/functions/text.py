"""Text, HTML and path functions as Columns; Arrow functions only where SQL has no equivalent."""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# ---- HTML repair -------------------------------------------------------------------------------

# Style tags without attributes and the styles of the spans that stand for them.
STYLES = {
    "b": "bold",
    "i": "italic",
    "u": "underline",
    "sup": "sup",
    "sub": "sub",
}
# Tags whose lines may have only one of the pair.
PAIRED_TAGS = ("p",)


def remove_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def remove_invalid_comments(text: Column) -> Column:
    """Comments whose inside has two hyphens in a row go; others stay."""
    return F.regexp_replace(text, r"(?s)<!--(?:(?!-->).)*?--(?:(?!-->).)*?-->", "")


def remove_office_conditionals(text: Column) -> Column:
    for pattern in (
        r"(?is)<!--\[if.*?<!\[endif\]-->",
        r"(?is)<!--\[if.*?\[endif\]-->",
        r"(?is)<!\[if[^>]*>",
        r"(?is)<!\[endif\]>",
        r"(?is)<\?xml:namespace[^>]*>",
        r"(?is)<xml>.*?</xml>",
        r"(?is)</?[ow]:[^>]*>",
    ):
        text = F.regexp_replace(text, pattern, "")
    return text


def avoid_mismatched_styles(text: Column, styles: Mapping[str, str] | None = None) -> Column:
    """``<b>`` in either case becomes ``<span style="bold">``, ``</b>`` ``</span>``; tags with attributes stay."""
    for tag, name in (styles or STYLES).items():
        text = F.regexp_replace(text, f"<(?:{tag}|{tag.upper()})>", f'<span style="{name}">')
        text = F.regexp_replace(text, f"</(?:{tag}|{tag.upper()})>", "</span>")
    return text


def _balance(tag: str, opens: str, closes: str):
    def fix(line: Column) -> Column:
        opened, closed = line.rlike(opens), line.rlike(closes)
        return (
            F.when(opened & ~closed, F.regexp_replace(line, opens, f'<{tag} type="open"/>'))
            .when(closed & ~opened, F.regexp_replace(line, closes, f'<{tag} type="close"/>'))
            .otherwise(line)
        )

    return fix


def avoid_mismatched_tags(text: Column, tags: tuple[str, ...] = PAIRED_TAGS) -> Column:
    """In lines that only open, or only close, a tag, it becomes an empty element that says so."""
    lines = F.split(text, "\n")
    for tag in tags:
        opens, closes = rf"(?i)<{tag}(?=[\s>])[^>]*>", rf"(?i)</{tag}\s*>"

        lines = F.transform(lines, _balance(tag, opens, closes))
    return F.array_join(lines, "\n")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tokens(text: Column) -> Column:
    """Tags and the texts between them, with white space collapsed."""
    marked = F.regexp_replace(collapse_space(text), r"(<[^>]*>)", "\x1f$1\x1f")
    return F.filter(F.split(marked, "\x1f"), lambda x: x != "")


def has_namespace(tag: Column) -> Column:
    """A colon outside of attribute values."""
    return tag.startswith("<") & F.regexp_replace(tag, r"=\s*(\"[^\"]*\"|'[^']*')", "").contains(":")


def remove_namespaced_tags(text: Column) -> Column:
    return F.array_join(F.filter(tokens(text), lambda t: ~has_namespace(t)), "")


def remove_tags(text: Column, keep: tuple[str, ...] = ()) -> Column:
    """Without tags, but for those that start like one in ``keep``; stray angle brackets are escaped."""
    kept = lambda t: F.lit(False) if not keep else t.rlike(f"(?i)^</?(?:{'|'.join(map(re.escape, keep))})")
    is_tag = lambda t: t.rlike(r"(?s)^<[^>]*>$")
    plain = lambda t: F.replace(F.replace(t, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.array_join(F.transform(F.filter(tokens(text), lambda t: ~is_tag(t) | kept(t)), lambda t: F.when(is_tag(t), t).otherwise(plain(t))), "")


def wrap_html(text: Column) -> Column:
    return F.when(F.lower(text).contains("<html"), text).otherwise(F.concat(F.lit('<html xmlns="http://www.w3.org/1999/xhtml"><body>'), text, F.lit("</body></html>")))


def repair(text: Column, styles: Mapping[str, str] | None = None, tags: tuple[str, ...] = PAIRED_TAGS) -> Column:
    """All repairs, in order: comments, office conditionals, style tags, unbalanced tags, namespaced tags."""
    text = remove_office_conditionals(remove_invalid_comments(text))
    return remove_namespaced_tags(avoid_mismatched_tags(avoid_mismatched_styles(text, styles), tags))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of equal words of two whole texts without tags; null if either is."""

    def words(x: str) -> list[str]:
        return re.sub(r"<[^>]*>", " ", x).split()

    def ratio(x, y):
        if x is None or y is None:
            return None
        x, y = words(x), words(y)
        return 1.0 if x == y else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()

    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def best_choice(score: Column, original: Column, fixed: Column, least: float = 0.7) -> Column:
    return F.when((score == 1) | (score > least), fixed).otherwise(original)


# ---- entities and characters -------------------------------------------------------------------

_XML_ENTITIES = frozenset({"&amp;", "&lt;", "&gt;", "&quot;", "&apos;"})
_ENTITY = re.compile(r"&[^\s;&#]+;")


def _numeric(match: re.Match) -> str:
    if match[0] in _XML_ENTITIES:
        return match[0]
    text = html.entities.html5.get(match[0][1:])
    return "".join(f"&#{ord(c)};" for c in text) if text else "&amp;" + match[0][1:]


@F.pandas_udf(StringType())
def numeric_entities(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Named entities as numeric ones; an unknown one gets its ampersand escaped."""
    for s in texts:
        yield s.map(lambda x: x if x is None else _ENTITY.sub(_numeric, x))


def entities(text: Column) -> Column:
    """Named entities that XML does not know, each once."""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(&[^\s;&#]+;)"), F.lit(1))), lambda e: ~e.isin(sorted(_XML_ENTITIES)))


@F.pandas_udf(StringType())
def safe_unescape(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unescaped, but for what stands for angle brackets and ampersands."""
    kept = re.compile(r"(&(?:lt|gt|amp|#60|#62|#38);)")
    for s in texts:
        yield s.map(lambda x: x if x is None else "".join(p if kept.fullmatch(p) else html.unescape(p) for p in kept.split(x)))


@F.pandas_udf(StringType())
def unescape(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda x: x if x is None else html.unescape(x))


def remove_control(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{C}", "")


def decode_html(text: Column) -> Column:
    return remove_control(unescape(text))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\D", "")


@F.pandas_udf(StringType())
def letters_only(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Decomposed, lower case, letters and blanks alone."""
    for s in texts:
        yield s.map(lambda x: x if x is None else "".join(c for c in unicodedata.normalize("NFD", x).lower() if c == " " or unicodedata.category(c).startswith("L")))


@F.pandas_udf(StringType())
def valid_id(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Without marks and characters that an XML id can't have; starts with a letter or underscore; ``id1`` if nothing is left."""

    def fix(x: str | None) -> str | None:
        if x is None:
            return None
        x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        x = re.sub(r"[^A-Za-z0-9_.\-]", "", x)
        return ("_" + x if x and not re.match("[A-Za-z_]", x) else x) or "id1"

    for s in ids:
        yield s.map(fix)


def xml_characters(text: Column) -> Column:
    """Characters that XML forbids become question marks."""
    return F.regexp_replace(text, r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "?")


def email_of_anchor(text: Column) -> Column:
    """The text of a mail anchor, or what there is."""
    found = F.regexp_extract(text, r'(?i)a href=(".*")>(.*)<(/a)', 2)
    return F.when(found != "", found).otherwise(text)


# ---- links and paths ---------------------------------------------------------------------------


def links(text: Column) -> Column:
    """(attribute, link) of every src and href, in order."""
    whole = F.regexp_extract_all(text, F.lit(r"""(?i)\b((?:src|href)\s*=\s*(?:"[^"]*"|'[^']*'))"""), F.lit(1))
    return F.transform(whole, lambda x: F.struct(F.lower(F.regexp_extract(x, r"^(\w+)", 1)).alias("attribute"), F.regexp_extract(x, r"""=\s*["'](.*)["']$""", 1).alias("link")))


def site_path(link: Column, site: str | None = None) -> Column:
    """The path of a link that belongs to a site (any, if none is given) or has no host, without its anchor; else null."""
    host = F.regexp_extract(link, r"^(?i:https?)://([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(link, r"^(?i:https?)://[^/?#]*", ""), r"[?#].*$", "")
    foreign = (F.lit(False) if site is None else (host != "") & (host != site)) | link.rlike(r"^(?i:mailto|ftp|javascript):") | link.startswith("#")
    return F.when(~foreign & (path != ""), path)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"(?<=.)(\.[^.]*)$", 1)


def replace_links(text: Column, table: Column) -> Column:
    """Links replaced by a map from file name to address; anchors after ``#`` stay."""
    pieces = F.split(F.regexp_replace(text, r"""(?i)(\b(?:src|href)\s*=\s*["'])([^"']*)(["'])""", "$1\x1f$2\x1e$3"), "\x1f")

    def swap(piece: Column, i: Column) -> Column:
        end = F.instr(piece, "\x1e")
        link = F.substr(piece, F.lit(1), end - 1)
        name = base_name(F.regexp_replace(link, "#.*$", ""))
        anchor = F.regexp_extract(link, "(#.*)$", 1)
        new = F.concat(F.coalesce(F.try_element_at(table, name), F.regexp_replace(link, "#.*$", "")), anchor)
        return F.when((i == 0) | (end == 0), piece).otherwise(F.concat(new, F.substr(piece, end + 1)))

    return F.array_join(F.transform(pieces, swap), "")


def is_local_html(href: Column, folder: str) -> Column:
    """A link to an HTML file of a journal's folder on the site."""
    return F.lower(href).contains(f"/{folder.lower()}/") & ~href.rlike("(?i)^(https?|ftp|mailto):") & F.regexp_replace(href, "[?#].*$", "").rlike(r"(?i)\.html?$")


def split_anchor(href: Column) -> Column:
    """(path, anchor) of a link; of an http address its path."""
    local = F.regexp_replace(href, r"^(?i:https?)://[^/]*", "")
    return F.struct(F.regexp_replace(local, "#.*$", "").alias("path"), F.nullif(F.regexp_extract(local, "#(.*)$", 1), F.lit("")).alias("anchor"))


def windows_path(path: Column) -> Column:
    """Backslashes as slashes; control characters that a careless escape made of ``\\a \\b \\f \\n \\r \\t \\v`` as slash and letter."""
    path = F.replace(path, F.lit("\\"), F.lit("/"))
    for char, letter in zip("\a\b\f\n\r\t\v", "abfnrtv", strict=True):
        path = F.replace(path, F.lit(char), F.lit("/" + letter))
    return path


def relative_path(path: Column, keep_root: bool = False, roots: tuple[str, ...] = ("bases", "htdocs")) -> Column:
    """What follows the first root folder found in the path (with it, if asked for)."""
    out = F.lit(None).cast("string")
    for root in reversed(roots):
        at = F.locate(root, path)
        out = F.when(at > 0, F.substr(path, at if keep_root else at + len(root))).otherwise(out)
    return out


def file_role(path: Column, prefix: Column, languages: Column) -> Column:
    """xml, renditions (the article's PDF, in one of its languages) or assets."""
    is_main = (stem(path) == prefix) | F.array_contains(F.transform(languages, lambda x: F.concat(prefix, F.lit("-"), x)), stem(path))
    return F.when(extension(path) == ".xml", "xml").when((extension(path) == ".pdf") & is_main, "renditions").otherwise("assets")


def issn_of(uri: Column) -> Column:
    found = F.regexp_extract(uri, r"/([0-9]{4}-[0-9]{3}[0-9Xx])/", 1)
    return F.when(found != "", found)


@F.pandas_udf(StringType())
def without_surrogates(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in names:
        yield s.map(lambda x: x if x is None else x.encode("utf-8", "replace").decode("utf-8"))


@F.pandas_udf(StringType())
def fixed_encoding(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """File names whose bytes were read as escaped surrogates, read as cp1252."""
    for s in names:
        yield s.map(lambda x: x if x is None else x.encode("utf-8", "surrogateescape").decode("cp1252", "replace") if any(0xDC80 <= ord(c) <= 0xDCFF for c in x) else x)


# ---- dates -------------------------------------------------------------------------------------


def date_parts(text: Column) -> Column:
    """(year, month, day) of ``YYYYMMDD``: parts that are not numbers, or zero, are null."""
    part = lambda a, n: F.when(F.substring(text, a, n).rlike(f"^[0-9]{{{n}}}$") & (F.substring(text, a, n).try_cast("int") > 0), F.substring(text, a, n))
    return F.struct(part(1, 4).alias("year"), part(5, 2).alias("month"), part(7, 2).alias("day"))


def iso_date(text: Column) -> Column:
    """Year, month and day as far as they form a date, unpadded, with hyphens."""
    year, month, day = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 5, 2).try_cast("int"), F.substring(text, 7, 2).try_cast("int")
    ok_year = year.between(1, 9999)
    ok_month = ok_year & month.between(1, 12)
    ok_day = ok_month & F.try_to_date(F.substring(text, 1, 8), "yyyyMMdd").isNotNull()
    return F.when(ok_year, F.concat_ws("-", year.cast("string"), F.when(ok_month, month.cast("string")), F.when(ok_day, day.cast("string"))))


def complete_date(candidates: list[Column], month: int = 6, day: int = 15) -> Column:
    """ISO date of the first candidate that is not empty, with defaults for a month or day 00; null if it is no date."""
    text = F.coalesce(*[F.when(c != "", c) for c in candidates])
    part = lambda a, default: F.when(F.substring(text, a, 2) == "00", f"{default:02d}").otherwise(F.substring(text, a, 2))
    whole = F.concat(F.substring(text, 1, 4), part(5, month), part(7, day))
    return F.date_format(F.try_to_date(whole, "yyyyMMdd"), "yyyy-MM-dd")
