"""Reading HTML with Column expressions: comments, attribute values in all tags of
a name (any quotes), and character references."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def without_comments(html) -> Column:
    return F.regexp_replace(col_(html), r"(?s)<!--.*?(?:-->|$)", "")


def decode_references(c) -> Column:
    """Named and numeric character references decoded; unknown ones stay."""
    named = F.create_map(*[F.lit(x) for n, code in sorted(name2codepoint.items()) for x in (n, chr(code))])

    def decoded(ref: Column) -> Column:
        body = F.substring(ref, F.lit(2), F.length(ref) - 2)
        number = (F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10))
                  .when(body.startswith("#"), F.substring(body, 2, 8)).try_cast("bigint"))
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(known, number)), 8, "0")), "UTF-32")
        return F.coalesce(char, F.try_element_at(named, body), ref)

    c = col_(c)
    refs = F.transform(F.regexp_extract_all(c, F.lit(f"({REFERENCE})"), 1), decoded)
    texts = F.split(c, REFERENCE)
    joined = F.array_join(F.zip_with(texts, F.array_append(refs, F.lit("")), lambda t, r: F.concat(t, r)), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


_REFERENCE = re.compile(REFERENCE)


def _decoded(found: re.Match) -> str:
    ref, body = found[0], found[0][1:-1]
    if body[0] != "#":
        return chr(name2codepoint[body]) if body in name2codepoint else ref
    number = int(body[2:], 16) if body[1] in "xX" else int(body[1:])
    return chr(number) if 1 <= number <= 0xD7FF or 0xE000 <= number <= 0x10FFFF else ref


def references_decoded(text: str | None) -> str | None:
    """``decode_references`` of one Python string."""
    return _REFERENCE.sub(_decoded, text) if text and "&" in text else text


def _value(raw: Column) -> Column:
    return decode_references(F.regexp_replace(raw, r"""^["']|["']$""", ""))


def attributes(html: Column, tag: str, name: str) -> Column:
    """The attribute's values in all tags that have it, in page order."""
    pattern = rf"(?is)<{tag}(?=\s)[^>]*?\s{name}\s*=\s*{VALUE}"
    return F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), _value)
