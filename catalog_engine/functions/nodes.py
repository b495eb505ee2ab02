"""Pages as lists of nodes: one tokenisation, and one pass with a stack of open
elements that applies the rules for omitted end tags. Small per-page Python helpers
that ``operators.extract`` runs on Arrow batches of pages.

A node is ``(tag, raw, depth)`` in page order: ``tag`` is the element's
name in lower case ('' for a text), ``raw`` its start tag or the text, ``depth``
the number of elements that are open around it. What an element holds is the
run of deeper nodes after it, so no end is stored. A content is
``(d, nodes)``, d being the depth of the nodes directly in it.

Comments and the contents of ``script`` and ``style`` are no nodes. Start tags end
at a ``>`` outside of quotes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import references_decoded

# The rules of HTML for elements without end tags.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
PARAGRAPH_ENDS = ["address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
                  "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"]
#: (start tags, the open element that they end, where the search for it stops)
IMPLIED = [
    (["td", "th"], ["td", "th"], ["tr", "table"]),
    (["tr"], ["tr"], ["table"]),
    (["tbody", "thead", "tfoot"], ["tbody", "thead", "tfoot"], ["table"]),
    (["li"], ["li"], ["ul", "ol", "menu"]),
    (["dt", "dd"], ["dt", "dd"], ["dl"]),
    (["option", "optgroup"], ["option"], ["select"]),
    (PARAGRAPH_ENDS, ["p"], ["td", "th", "table", "button"]),
]
#: End tags look no further out than these, those of table parts not beyond their table.
TABLE_PARTS = ["td", "th", "tr", "tbody", "thead", "tfoot", "caption"]
END_STOPS = ["td", "th", "table", "caption"]

#: Their contents and end tags are taken out before.
HIDDEN = ["script", "style"]
# an element that is never closed ends before the page's last line end
_END = r"(?=(?:\r\n|(?<!\r)\n|[\r\u0085\u2028\u2029])?\Z)"
_HIDDEN = re.compile(rf"<!--.*?(?:-->|{_END})|(<(script|style)(?=[\s/>])(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>).*?(?:</\2\s*>|{_END})", re.A | re.I | re.S)
_TOKEN = re.compile(r"</?[A-Za-z](?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>|<(?![A-Za-z/])[^<]+|</?[A-Za-z](?:[^<>]*+)|[^<]++|<", re.A | re.S)
_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)", re.A)
_ATTRIBUTE = r"[^\s=>/\"']+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
#: Start tags and values that a worker remembers, as pages of a site repeat them.
_REMEMBERED = 4096

_IMPLIED = {tag: (frozenset(ends), frozenset(stops)) for starts, ends, stops in IMPLIED for tag in starts}
_NO_STACK = frozenset([*VOID, *HIDDEN])

Node = tuple[str, str, int]
Content = tuple[int, list[Node]]
Test = Callable[[str], bool]


@lru_cache(_REMEMBERED)
def _described(raw: str) -> tuple[str, frozenset | None, frozenset | None, bool, bool]:
    """What a token does to the stack of open elements: its tag, the elements it
    ends, where the search for these stops, whether it is shown and opens."""
    found = _TAG.match(raw) if raw.endswith(">") else None
    if not found:
        return "", None, None, True, False
    tag = found[1].lower()
    if raw.startswith("</"):
        # a table's part ends what stands in the way of it too, a paragraph or list item within a cell
        stops = [] if tag == "table" else ["table"] if tag in TABLE_PARTS else END_STOPS
        return tag, frozenset([tag]), frozenset(stops), False, False
    ends, stops = _IMPLIED.get(tag, (None, None))
    return tag, ends, stops, True, tag not in _NO_STACK and not raw.endswith("/>")


def nodes_of(html: str) -> list[Node]:
    """The nodes of a page."""
    stack, nodes = [], []
    for raw in _TOKEN.findall(_HIDDEN.sub(lambda m: m[1] or "", html)):
        if raw[0] != "<":
            nodes.append(("", raw, len(stack)))
            continue
        tag, ends, stops, shown, opens = _described(raw)
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in ends:
                    del stack[k:]
                    break
                if stack[k] in stops:
                    break
        if shown:
            nodes.append((tag, raw, len(stack)))
            if opens:
                stack.append(tag)
    return nodes


def page_nodes(html: Column) -> Column:
    """The nodes of a page as an array of structs; NULL for a null page."""
    @F.arrow_udf("array<struct<tag:string,raw:string,depth:int>>")
    def parsed(pages: pa.Array) -> pa.Array:
        rows = [None if p is None else [dict(zip(("tag", "raw", "depth"), n)) for n in nodes_of(p)] for p in pages.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("tag", pa.string()), ("raw", pa.string()), ("depth", pa.int32())])))

    return parsed(html)


def whole(nodes: list[Node]) -> Content:
    return 0, nodes


@lru_cache(64)
def _pattern(name: str) -> re.Pattern:
    return re.compile(rf"<[^\s/>]+(?:[\s/]+(?!{name}\s*=){_ATTRIBUTE})*[\s/]+{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.A | re.I | re.S)


@lru_cache(_REMEMBERED)
def _given(raw: str, name: str) -> str | None:
    """The attribute's text in a start tag without its quotes, None without it."""
    found = _pattern(name).match(raw)
    return found and (found[1][1:-1] if found[1][0] in "\"'" else found[1])


def value_in(raw: str, name: str) -> str | None:
    """The attribute's value in a start tag, None without it."""
    return references_decoded(_given(raw, name))


@lru_cache(_REMEMBERED)
def _classes(raw: str) -> frozenset[str]:
    return frozenset(re.split(r"\s+", re.sub("[\"']", "", _given(raw, "class") or ""), flags=re.A))


def _of_column(of: Callable, kind: str, arrow: pa.DataType) -> Callable[[Column], Column]:
    """``of`` a string for a column of strings."""
    @F.arrow_udf(kind)
    def each(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else of(v) for v in values.to_pylist()], arrow)

    return each


def value_of(raw: Column, name: str) -> Column:
    """``value_in`` of a column of start tags."""
    return _of_column(lambda x: value_in(x, name), "string", pa.string())(raw)


def with_id(ident: str) -> Test:
    return lambda raw: _given(raw, "id") == ident


def with_class(token: str) -> Callable:
    """A test of a start tag, or of a column of them."""
    has = lambda raw: token in _classes(raw)
    return lambda raw: _of_column(has, "boolean", pa.bool_())(raw) if isinstance(raw, Column) else has(raw)


def without_class(token: str) -> Test:
    return lambda raw: token not in _classes(raw)


def all_inner(content: Content | None, tag: str, test: Test | None = None) -> list[Content]:
    """The contents of all such elements, in page order; one that is inside
    another has its own entry too."""
    if content is None:
        return []
    nodes, found = content[1], []
    for i, (name, raw, depth) in enumerate(nodes):
        if name == tag and (test is None or test(raw)):
            end = i + 1
            while end < len(nodes) and nodes[end][2] > depth:
                end += 1
            found.append((depth + 1, nodes[i + 1 : end]))
    return found


def inner(content: Content | None, tag: str, test: Test | None = None) -> Content | None:
    """The content of the first such element, None without one."""
    return first_of(all_inner(content, tag, test))


def direct_text(content: Content | None) -> str | None:
    """The first text directly in an element, None without any."""
    if content is None:
        return None
    return references_decoded(next((raw for tag, raw, depth in content[1] if tag == "" and depth == content[0]), None))


def texts_of(content: Content | None, tag: str, test: Test | None = None) -> list[str]:
    """The first direct text of each such element that has one."""
    return [t for t in map(direct_text, all_inner(content, tag, test)) if t is not None]


def attributes(content: Content | None, tag: str, name: str) -> list[str]:
    """The attribute's values in all such elements that have it."""
    if content is None:
        return []
    values = (value_in(raw, name) for t, raw, _ in content[1] if t == tag)
    return [v for v in values if v is not None]


def first_of(values: list):
    return values[0] if values else None
