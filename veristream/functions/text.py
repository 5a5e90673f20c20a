"""Text expressions, all ``Column -> Column`` and all inside the JVM.

Patterns are written so that Java means what Python's ``re`` means: white
space is spelled out (``WS``), ``.`` stops at line feeds only (``(?d)``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import cache
from html.entities import html5

from pyspark.sql import Column, functions as F

from veristream import fixed_values as fv

URL = f"http{fv.NON_WS}+|www\\.{fv.NON_WS}+"
NON_ALNUM = f"[^a-z0-9{fv.WS_CLASS}]"
LINK_STARTS = ["http://", "https://", "bit.ly/", "wa.me/", "t.me/"]
# Parts of a page that show no text; each one also ends a piece of text.
HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    r"|<template\b[^>]*>.*?</template\s*>|<![^>]*>"
)
# A tag, whose quoted values may hold '>'; one with an odd quote ends at the first '>'.
TAG = r"""<(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|<[^>]*>"""
# A text in pieces: character references, what stands between them, ampersands that begin none.
REFERENCES = r"&#[0-9]{1,9};?|&#[xX][0-9a-fA-F]{1,8};?|&[A-Za-z][A-Za-z0-9]{1,31};?|[^&]+|&"


def strip(c: Column) -> Column:
    """Remove white space (as Python sees it) from both ends."""
    return F.btrim(c, F.lit(fv.TRIM_CHARS))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"{fv.WS}+", " ")


def strip_tags(c: Column) -> Column:
    """Stream cleaning: tags to blanks, blanks collapsed, ends stripped."""
    return strip(collapse(F.regexp_replace(c, "<[^>]+>", " ")))


def _where_any(c: Column, needles: Sequence[str], then: Column, other: Column) -> Column:
    """``then`` for texts with one of the needles.

    A byte search is far cheaper than a regular expression that finds nothing.
    """
    found = F.contains(c, F.lit(needles[0]))
    for needle in needles[1:]:
        found = found | F.contains(c, F.lit(needle))
    return F.when(found, then).otherwise(other)


def _drop_urls(c: Column) -> Column:
    return _where_any(c, ["http", "www."], F.regexp_replace(c, URL, " "), c)


def _drop_tags(c: Column) -> Column:
    return _where_any(c, ["<"], F.regexp_replace(c, "(?d)<.*?>", " "), c)


def _alnum_words(c: Column) -> Column:
    """Everything else to blanks, blanks collapsed, ends stripped: one pass."""
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def clean_train(c: Column) -> Column:
    """Training cleaning: links go before tags."""
    return _alnum_words(_drop_tags(_drop_urls(F.lower(c))))


def clean_similarity(c: Column) -> Column:
    """Similarity cleaning: tags go before links, then common entities."""
    t = _drop_urls(_drop_tags(F.lower(c)))
    for entity in ("&nbsp;", "&amp;", "&quot;"):
        t = F.replace(t, F.lit(entity), F.lit(" "))
    return _alnum_words(t)


def clean_serve(c: Column) -> Column:
    """Serving cleaning: no tag step and no collapsing."""
    return strip(F.regexp_replace(_drop_urls(F.lower(c)), NON_ALNUM, " "))


@cache
def _names() -> str:
    """Character references by name, as browsers know them, in JSON; some do without the semicolon."""
    return json.dumps(html5, ensure_ascii=False)


def _numbered(piece: Column) -> Column:
    """The character of a numeric reference; control numbers mean Windows-1252, impossible ones U+FFFD."""
    digits = F.regexp_extract(piece, "[0-9a-fA-F]+", 0)
    hexadecimal = F.lower(F.substring(piece, 3, 1)) == "x"
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.translate(char, _CONTROLS, _WINDOWS)


_CONTROLS = "".join(chr(c) for c in range(0x80, 0xA0) if bytes([c]).decode("cp1252", "ignore"))
_WINDOWS = _CONTROLS.encode("latin-1").decode("cp1252")


def decode_entities(c: Column) -> Column:
    """Character references to characters, in one pass: '&amp;lt;' gives '&lt;'."""
    names = F.from_json(F.lit(_names()), "map<string,string>")
    decoded = F.transform(
        F.regexp_extract_all(c, F.lit(REFERENCES), F.lit(0)),
        lambda p: F.when(F.startswith(p, F.lit("&#")) & (F.length(p) > 2), _numbered(p))
        .when(F.startswith(p, F.lit("&")), F.coalesce(F.try_element_at(names, F.substr(p, F.lit(2))), p))
        .otherwise(p),
    )
    return _where_any(c, ["&"], F.array_join(decoded, ""), c)


def _visible_pieces(html: Column, separator: str) -> Column:
    pieces = F.split(F.regexp_replace(html, HIDDEN, "<>"), TAG)
    trimmed = F.transform(pieces, lambda p: strip(decode_entities(p)))
    return F.array_join(F.filter(trimmed, lambda p: p != ""), separator)


def html_to_text(c: Column) -> Column:
    """Visible text of a page: stripped pieces joined by one blank."""
    return _visible_pieces(F.coalesce(c, F.lit("")), " ")


def article_text(html: Column, max_chars: int = 5000) -> Column:
    """All paragraphs joined by blanks, else the whole visible page, cut."""
    body = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "<>")
    blocks = F.regexp_extract_all(body, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"), 1)
    # Within one paragraph the stripped pieces are glued without a separator.
    paragraphs = F.array_join(F.transform(blocks, lambda p: _visible_pieces(p, "")), " ")
    text = F.when(paragraphs != "", paragraphs).otherwise(html_to_text(html))
    return strip(F.substring(text, 1, max_chars))


def container_text(html: Column, classes: Sequence[str] = ("entry-content", "post-content")) -> Column:
    """Text of the first ``div`` with one of the classes, '' if there is none.

    Classes are tried in order.  The block ends where its ``div`` does: nested
    ones are counted.  A ``div`` that never ends goes to the end of the page.
    """
    found = [
        F.nullif(
            _balanced(F.regexp_extract(
                html, rf'(?is)<div\b[^>]*class="[^"]*\b{name}\b[^"]*"[^>]*>(.*)$', 1
            )),
            F.lit(""),
        )
        for name in classes
    ]
    return html_to_text(F.coalesce(*found))


def _balanced(inside: Column) -> Column:
    """What comes before the closing tag of the ``div`` that was open at the start."""
    pieces = F.split(inside, r"(?i)(?=<div\b|</div\s*>)")
    opens, closes = (lambda p: p.rlike(r"(?i)^<div\b")), (lambda p: p.rlike(r"(?i)^</div\s*>"))
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
    taken = F.aggregate(
        pieces, start,
        lambda a, p: F.when(a["depth"] == 0, a).otherwise(F.struct(
            (a["depth"] + F.when(opens(p), 1).when(closes(p), -1).otherwise(0)).alias("depth"),
            (a["n"] + F.when((a["depth"] == 1) & closes(p), 0).otherwise(1)).alias("n"),
        )),
        lambda a: a["n"],
    )
    return F.array_join(F.slice(pieces, F.lit(1), taken), "")


def ellipsis(c: Column, max_chars: int = 150, keep: int = 147) -> Column:
    """Texts longer than ``max_chars`` become the first ``keep`` plus '...'."""
    cut = F.concat(F.substring(c, 1, keep), F.lit("..."))
    return F.when(F.length(c) > max_chars, cut).otherwise(c)


def has_any(c: Column, words: Sequence[str]) -> Column:
    """Does the lower-cased text hold any of the words?"""
    lowered = F.lower(c)
    found = F.lit(False)
    for i, word in enumerate(words):
        hit = F.contains(lowered, F.lit(word))
        found = hit if i == 0 else found | hit
    return found


def hits(c: Column, words: Sequence[str]) -> Column:
    """The words that occur in the lower-cased text, in list order."""
    lowered = F.lower(c)
    return F.filter(
        F.array(*[F.lit(w) for w in words]), lambda w: F.contains(lowered, w)
    )


def is_url(c: Column) -> Column:
    return F.rlike(strip(c), F.lit(f"^https?://{fv.NON_WS}+$"))


def _present(matches: Column) -> Column:
    return F.nullif(matches, F.array().cast("array<string>"))


def _early(pattern: str, first: str) -> str:
    """The same pattern with a look at its first character before the costly
    Unicode word boundary."""
    flag = "(?U)"
    return f"{flag}(?={first}){pattern.removeprefix(flag)}"


def scam_entities(c: Column) -> Column:
    """Phone numbers, account numbers and links; a field is null if empty."""
    none = F.lit(None).cast("array<string>")
    links = _present(F.regexp_extract_all(c, F.lit(fv.LINK), 0))
    return F.struct(
        _present(F.regexp_extract_all(c, F.lit(_early(fv.PHONE, "[06+]")), 0)).alias("nomor_hp"),
        _present(F.regexp_extract_all(c, F.lit(_early(fv.ACCOUNT, r"\d")), 0)).alias("rekening"),
        _where_any(c, LINK_STARTS, links, none).alias("links"),
    )


def join_title(title: Column, body: Column, separator: str = ". ") -> Column:
    """Title and body with nulls as ''; ends stripped."""
    return strip(
        F.concat(F.coalesce(title, F.lit("")), F.lit(separator), F.coalesce(body, F.lit("")))
    )


def capitalize(c: Column) -> Column:
    """First character upper, all others lower (``initcap`` is per word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def non_empty(c: Column) -> Column:
    """Null for the empty string: what ``or`` chains skip."""
    return F.nullif(c, F.lit(""))


def first_non_empty(*columns: Column) -> Column:
    """First filled value, '' if there is none."""
    return F.coalesce(*[non_empty(c) for c in columns], F.lit(""))


def recover_json(c: Column, schema) -> Column:
    """Parse a model reply: drop code fences, else take the outer braces.

    Unparsable replies give a null struct.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    bare = F.regexp_replace(c, r"```(?:json)?\s*", "")
    bare = strip(F.rtrim(strip(bare), F.lit("`")))
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)

    def parse(text: Column) -> Column:
        # Only a whole JSON object counts; a half-read struct would be wrong.
        whole = F.try_parse_json(text)
        is_object = F.startswith(F.schema_of_variant(whole), F.lit("OBJECT"))
        return F.when(is_object, F.from_json(text, ddl))

    return F.coalesce(parse(bare), parse(non_empty(inner)))
