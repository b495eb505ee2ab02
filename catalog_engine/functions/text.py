"""Text normalisation as Column builders (N1, strip, tokens, processors).

All built-in, JVM-side expressions. Java's ``\\s`` and ``trim`` differ from
Python's ``str.strip``/``re`` ``\\s`` (they miss NBSP and friends), so every
whitespace rule uses the Unicode-aware ``(?U)\\s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules):
#   normalize_text: lower; '&' -> ' and '; '-' -> ' '; '/' -> ' ';
#   remove '®' and '™'; collapse whitespace runs to one space; strip.
AMPERSAND_WORD = " and "
SPACE_CHARS = ("-", "/")
REMOVED_MARKS = ("®", "™")

_WS = "(?U)\\s"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col_(c), f"^{_WS}+|{_WS}+$", "")


def blank_to_null(c) -> Column:
    """Python truthiness of a stripped string: '' behaves as absent."""
    s = ustrip(c)
    return F.when(s != "", s)


def normalize_text(c) -> Column:
    """The study's normalisation, steps in the reference's order."""
    s = F.lower(col_(c))
    s = F.replace(s, F.lit("&"), F.lit(AMPERSAND_WORD))
    for ch in SPACE_CHARS:
        s = F.replace(s, F.lit(ch), F.lit(" "))
    for ch in REMOVED_MARKS:
        s = F.replace(s, F.lit(ch), F.lit(""))
    s = F.regexp_replace(s, f"{_WS}+", " ")
    return ustrip(s)


def default_process(c) -> Column:
    """Optional matcher pre-processing: lower case, every character that
    is not a letter or digit becomes a space, strip."""
    s = F.regexp_replace(F.lower(col_(c)), "(?U)[^\\p{L}\\p{N}]", " ")
    return ustrip(s)


def tokens(c) -> Column:
    """Split on Unicode whitespace, blanks removed (Python ``str.split()``)."""
    return F.filter(F.split(col_(c), f"{_WS}+"), lambda t: t != "")


def sorted_tokens_join(c) -> Column:
    """Tokens sorted by code point and joined by one space."""
    return F.array_join(F.sort_array(tokens(c)), " ")


def full_name(brand, name) -> Column:
    """``f"{brand} {name}"``: the match key of a catalogue row."""
    return F.concat(col_(brand), F.lit(" "), col_(name))


def word_count(c) -> Column:
    return F.size(tokens(c))


def apply_processor(c, processor: str | None) -> Column:
    if processor in (None, "none"):
        return col_(c)
    if processor == "default":
        return default_process(c)
    if processor == "normalize":
        return normalize_text(c)
    raise ValueError(f"unknown processor {processor!r}")
