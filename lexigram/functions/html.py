"""Stored HTML pages to text, the output page shell, output names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The page shell, the report shell and the file endings of the result documents.
PAGE_HEAD = "<!DOCTYPE html>\n<html>\n<head>\n<title>PDF Page 1</title>\n</head>\n<body>\n"
PAGE_FOOT = "\n</body>\n</html>"
REPORT_HEAD = "<!DOCTYPE html>\n<html>\n<head>\n<title>Document</title>\n</head>\n<body>\n<pre>"
REPORT_FOOT = "</pre>\n</body>\n</html>"
ENDINGS = {"ToImage": ".jpg", "ToHTML": ".html", "ToText": ".txt"}

#: Named character references that are decoded; numeric ones all are.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}

#: What is not text, in one alternation: the first one that fits at a place counts, so a comment may hold tags and a script may hold
#: comments. A ``>`` within a quoted attribute doesn't end its tag; a tag whose quotes don't close ends at the next ``>``.
MARKUP = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"""|</?[a-z](?:[^"'>]++|"[^"]*+"|'[^']*+')*+>|<[^>]*>"""
)
REFERENCE = "^(#?[A-Za-z0-9]{1,8});"


def _character(code: Column) -> Column:
    """The character of a code point, null if there is none; a non-breaking blank is a blank."""
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code == 160, " ").when(valid, char)


def _decoded(piece: Column) -> Column:
    """A piece that followed an ampersand, its reference decoded; the ampersand stays if it began none."""
    name = F.regexp_extract(piece, REFERENCE, 1)
    char = F.coalesce(
        *[F.when(name == entity, char) for entity, char in ENTITIES.items()],
        _character(F.regexp_extract(name, "^#([0-9]+)$", 1).try_cast("bigint")),
        _character(F.conv(F.nullif(F.regexp_extract(name, "^#[xX]([0-9A-Fa-f]+)$", 1), F.lit("")), 16, 10).try_cast("bigint")),
    )
    return F.coalesce(F.concat(char, F.substr(piece, F.length(name) + 2)), F.concat(F.lit("&"), piece))


def html_to_text(html: Column) -> Column:
    """Visible text: no scripts, styles, comments or tags, character references decoded once, white space collapsed."""
    pieces = F.split(F.regexp_replace(html, MARKUP, " "), "&")
    text = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), _decoded), ""))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def text_to_page(text: Column) -> Column:
    return F.concat(F.lit(PAGE_HEAD), text, F.lit(PAGE_FOOT))


def file_name(url: Column) -> Column:
    """The last path segment of a URL, query included."""
    return F.regexp_extract(url, r"([^/]+)/*$", 1)


def output_key(client: Column, url: Column, op: Column) -> Column:
    """``DoneLocalId<client><file name><op><ending>``; null for an unknown operation."""
    endings = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])
    return F.concat(F.lit("DoneLocalId"), client.cast("string"), file_name(url), op, endings[op])
