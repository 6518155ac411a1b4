"""Tables carried over whole: every extension, every glyph of the symbol font."""

import json

from pyspark.sql import functions as F

from folioframe.functions import pattern_tables as T
from folioframe.functions import patterns
from folioframe.operators import article

SHEET = "application vnd.openxmlformats-officedocument.spreadsheetml.sheet"
ASSETS = {
    "pdf": {"pdf": "application pdf"},
    "image": {"gif": "image gif", "jpg": "image jpeg", "jpeg": "image jpeg", "png": "image png", "tiff": "image tiff", "bmp": "image bmp", "svg": "image svg+xml"},
    "video": {"mp4": "video mp4", "avi": "video x-msvideo", "mov": "video quicktime", "wmv": "video x-ms-wmv", "flv": "video x-flv", "mkv": "video x-matroska"},
    "audio": {"mp3": "audio mpeg", "wav": "audio wav", "ogg": "audio ogg", "flac": "audio flac"},
    "html": {"htm": "text html", "html": "text html"},
    "spreadsheet": {"xls": "application vnd.ms-excel", "xlsx": SHEET, "xlsm": SHEET},
    "document": {"doc": "application msword", "docx": "application vnd.openxmlformats-officedocument.wordprocessingml.document"},
    "presentation": {"ppt": "application vnd.ms-powerpoint", "pptx": "application vnd.openxmlformats-officedocument.presentationml.presentation"},
    "compressed": {"zip": "application zip", "rar": "application x-rar-compressed", "7z": "application x-7z-compressed", "tar": "application x-tar", "gz": "application x-tar"},
}


def test_every_extension(spark):
    wanted = {f"a.b/c.{x.upper() if k % 2 else x}": (kind, *mime.split(" ")) for kind, xs in ASSETS.items() for k, (x, mime) in enumerate(xs.items())}
    wanted |= {"a.gz/b": ("other", "application", "octet-stream"), "x.unknown": ("other", "application", "octet-stream")}
    assert len(wanted) == 34 and len(T.ASSET_TYPES) == 32
    rows = spark.createDataFrame([(p,) for p in wanted], "p string").select("p", patterns.asset_type(F.col("p")).alias("a")).collect()
    assert {r.p: tuple(r.a) for r in rows} == wanted


def test_every_glyph(spark):
    assert len(T.SYMBOL_FONT) == 177
    text, glyphs = "£³¹¥\"$®¬Îå´abW", "≤≥≠∞∀∃→←∈∑"  # the acute accent is no glyph of the table
    d = {"xml_body": f"<article><body><p>x <font-face-symbol>{text}</font-face-symbol> y</p></body></article>", "document_type": "oa", "original_language": "en"}
    xml = spark.createDataFrame([(json.dumps(d),)], "d string").select(article.article_xml(F.col("d"))["xml"]).first()[0]
    assert f"x {glyphs}´αβΩ y" in xml
