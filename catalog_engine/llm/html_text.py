"""Main text of web pages with site template removal (operator 10).

A page is read into element subtrees. Subtrees get a hash of their markup and
text; Spark counts each hash per host, and subtrees that recur on many pages of
their host are template and are deleted. The main text is what is left of the
article (or, without one, of the body) once elements that never hold it go:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments. What the author marked as the article is not judged by
recurrence: the same article may stand on many pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cut, need_columns

#: A subtree is template if it stands on at least this many pages of a host ...
MIN_PAGES = 10
#: ... and on at least this share of them.
MIN_SHARE = 0.2
#: Template lists of all hosts up to this size are sent to every task; larger
#: ones are joined by host.
BROADCAST_BYTES = 32 << 20

#: Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
NEVER_TEXT = RAW | frozenset("head nav header footer aside form button select option datalist dialog menu svg math canvas object audio video map label fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
P = frozenset(["p"])
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("html body article main section div aside nav header footer table td th ul ol dl blockquote form figure details".split())

#: Whole class tokens, ids and roles that name page furniture: a word for it,
#: words that say which, and words for a box or list of it. Reader comments are
#: apart, as they can be longer than the text they follow.
_COMMENTS = r"comments?|disqus|replies|respond|reactions"
_WORD = (
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w+|signup|login"
    r"|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|sidebar|rail|widgets?|footer|masthead|toolbar|social|shar(?:e|ing)|related|recommend\w*|trending"
    r"|complementary|contentinfo|skip(?:link)?"
)
_WHICH = r"site|global|main|page|post|entry|article|user|reader|top|bottom|left|right|side|header|search|primary|secondary|mobile|desktop|sticky|fixed"
_BOX = r"list|bar|box|links?|buttons?|btns?|icons?|block|wrap|wrapper|container|area|section|slot|unit|inner|form|items?|posts|articles|stories|wall|thread|to"
FURNITURE = re.compile(
    rf"(?:(?:{_WHICH}|{_WORD}|{_COMMENTS})[_-]+)*(?:{_WORD}|(?P<comments>{_COMMENTS}))(?:[_-]+(?:{_BOX}))*"
    rf"|(?:(?:site|global|top|mobile|desktop|sticky|fixed)[_-]+)*(?:header|search)(?:[_-]+(?:bar|box|form|button|wrapper|container|inner))*|side|hidden|visually[_-]hidden",
    re.IGNORECASE,
)
#: How an element counts as furniture: by a name that the most of a page's text
#: speaks against, or for certain.
NAMED, CERTAIN = 1, 2
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


class Node:
    __slots__ = ("name", "parts", "furniture")

    def __init__(self, name: str, furniture: int = 0):
        self.name, self.parts, self.furniture = name, [], furniture


def _furniture(attributes: str) -> int:
    found = 0
    if "=" not in attributes and "hidden" not in attributes.lower():
        return found
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id", "role"):
            for token in value.split():
                if name := FURNITURE.fullmatch(token):
                    found = max(found, CERTAIN if name["comments"] else NAMED)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return CERTAIN
    return found


def _end_implied(stack: list[Node], name: str) -> None:
    """Ends the open elements that a start tag ends by itself."""
    ends = SIBLINGS.get(name) or (P if name in CLOSES_P else None)
    if ends:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in ends:
                del stack[k:]
            elif stack[k].name in SCOPES:
                return


def read(page: str | None) -> Node:
    """The tree of a page. End tags that fit nothing are ignored, elements left
    open end with their parent, and those that HTML closes by themselves
    (p, li, table parts) are closed."""
    root, named = Node("html"), False
    stack, text, at, end = [root], page or "", 0, len(page or "")
    while at < end:
        tag = TOKEN.search(text, at)
        upto = tag.start() if tag else end
        if upto > at:
            stack[-1].parts.append(text[at:upto])
        if not tag:
            break
        at = tag.end()
        closing, name = tag.group(1), (tag.group(2) or "").lower()
        if not name:
            if tag.group().startswith("<![CDATA["):
                stack[-1].parts.append(entities.escape(tag.group()[9:-3]))
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k].name in SCOPES:
                    break
            continue
        _end_implied(stack, name)
        node = Node(name, 0 if name in ("html", "body", "main") else _furniture(tag.group(3)))
        named = named or node.furniture == NAMED
        stack[-1].parts.append(node)
        if name in VOID or tag.group(3).endswith("/") and name not in CLOSES_P | INLINE | SCOPES:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(text, at)
            node.parts.append(text[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(node)
    if named:
        _spare(root)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """Every element after its descendants; without recursion, as pages can be
    nested to any depth."""
    todo = [(root, False)]
    while todo:
        node, seen = todo.pop()
        if seen:
            yield node
            continue
        todo.append((node, True))
        todo += [(p, False) for p in reversed(node.parts) if isinstance(p, Node)]


def subtree_hashes(root: Node) -> dict[int, int]:
    """Node id -> hash of its subtree (names and text, spaces folded)."""
    found: dict[int, int] = {}
    for node in _walk(root):
        h = blake2b(node.name.encode(), digest_size=8)
        for p in node.parts:
            h.update(b"\x01" + found[id(p)].to_bytes(8, "little", signed=True) if isinstance(p, Node) else b"\x02" + " ".join(p.split()).encode("utf-8", "replace"))
        found[id(node)] = int.from_bytes(h.digest(), "little", signed=True)
    return found


def _never(node: Node) -> bool:
    return node.name in NEVER_TEXT or node.furniture > 0


def content_roots(root: Node) -> tuple[list[Node], bool]:
    """The outermost articles that are not furniture; without one the main
    element, without that the whole page. Whether the author marked it."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node is not root and (node.name in RAW or node.furniture or node.name in ("nav", "aside", "footer", "form")):
                continue
            if node.name == wanted:
                found.append(node)
                continue
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
        if found:
            return found, True
    return [root], False


def _spare(root: Node) -> None:
    """Elements named as furniture are none if they hold most of the text of
    the article (without one, of the page), or the only article there is."""
    roots, _ = content_roots(root)
    if not blocks(roots, _never):
        holds: dict[int, bool] = {}
        for node in _walk(root):
            holds[id(node)] = node.name in ("article", "main") or any(holds[id(p)] for p in node.parts if isinstance(p, Node))
            if node.furniture == NAMED and holds[id(node)]:
                node.furniture = 0
        roots, _ = content_roots(root)
        if not blocks(roots, _never):
            roots = [root]
    size: dict[int, int] = {}
    walked = [n for r in roots for n in _walk(r)]
    for node in walked:
        size[id(node)] = 0 if node.name in NEVER_TEXT else sum(len("".join(p.split())) if isinstance(p, str) else size[id(p)] for p in node.parts)
    total = sum(size[id(r)] for r in roots)
    for node in walked:
        if node.furniture == NAMED and 2 * size[id(node)] > total:
            node.furniture = 0


def blocks(roots: list[Node], dropped: Callable[[Node], bool]) -> list[str]:
    """The text of each block, white space folded and references decoded."""
    out, now = [], []

    def close() -> None:
        words = " ".join(entities.unescape("".join(now)).split())
        if words:
            out.append(words)
        now.clear()

    for root in roots:
        close()
        todo: list = [(root, False)]
        while todo:
            part, after = todo.pop()
            if isinstance(part, str):
                now.append(part)
            elif after:
                close()
            elif part.name == "br":
                now.append(" ")
            elif part is root or not dropped(part):
                if part.name not in INLINE:
                    close()
                    todo.append((part, True))
                todo += [(p, False) for p in reversed(part.parts)]
    close()
    return out


def main_text(page: str | None, template: frozenset | set = frozenset()) -> str:
    """The main text of a page; ``template`` holds hashes of subtrees to delete
    outside of what the author marked as the article."""
    root = read(page)
    roots, marked = content_roots(root)
    if marked or not template:
        return "\n\n".join(blocks(roots, _never))
    hashes = subtree_hashes(root)
    return "\n\n".join(blocks(roots, lambda n: _never(n) or n.name not in INLINE and hashes[id(n)] in template))


def judged_subtrees(page: str | None) -> list[int]:
    """Hashes of the block subtrees of a page that recurrence may delete."""
    root = read(page)
    roots, marked = content_roots(root)
    inside = {id(n) for r in roots for n in _walk(r)} if marked else set()
    hashes = subtree_hashes(root)
    return sorted({hashes[id(n)] for n in _walk(root) if n is not root and id(n) not in inside and n.name not in INLINE and n.name not in ("body", "article", "main", "head") and n.parts})


#: Pages whose results leave a task at once.
BLOCK_PAGES = 1000


def _blocks_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_PAGES):
            yield batch.iloc[at : at + BLOCK_PAGES]


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in _blocks_of(batches):
        found = [judged_subtrees(h) for h in part["html"]]
        counts = [len(f) for f in found]
        yield pd.DataFrame({"host": np.repeat(part["host"].to_numpy(dtype=object), counts), "page": np.repeat(part["page"].to_numpy(), counts), "subtree": np.array([s for f in found for s in f], dtype=np.int64)})


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in _blocks_of(batches):
        text = [main_text(h, frozenset(t) if t is not None else frozenset()) for h, t in zip(part["html"], part["template"])]
        yield part[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])


def host_of(url):
    """The host of a URL in lower case; without one the empty string."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    ``text`` holds the blocks of the main text in page order, joined by two line
    feeds; it is empty, never null, where a page has none (null and empty
    pages too), and ``n_chars`` counts its code points. Pages without a host
    (a null url) are one host together. Equal rows give equal rows. Other
    columns are ignored; an empty table gives no rows.
    """
    need_columns(pages, "page_id", "url", "html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("host", host_of(F.col("url"))).withColumn("page", F.xxhash64("host", "html"))
    subtrees = pages.select("host", "page", "html").mapInPandas(_subtrees, "host string, page bigint, subtree bigint")
    # equal pages of a host tell nothing about its template: each counts once
    seen = subtrees.groupBy("host", "subtree", "page").agg(F.lit(1).alias("one")).groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
    hosts = pages.groupBy("host").agg(F.approx_count_distinct("page", 0.02).alias("all_pages"))
    template = seen.where(F.col("pages") >= min_pages).join(hosts, "host").where(F.col("pages") >= F.col("all_pages") * min_share)
    # at most 1 / min_share subtrees of one place fit, so the list of a host is short
    lists = cut(template.groupBy("host").agg(F.collect_set("subtree").alias("template")))
    weight = lists.agg(F.sum(F.size("template") * 8 + F.octet_length("host") + 64)).first()[0] or 0
    if weight <= broadcast_bytes:
        lists = F.broadcast(lists)
    out = pages.select("page_id", "url", "html", "host").join(lists, "host", "left").select("page_id", "url", "html", "template")
    return out.mapInPandas(_texts, "page_id bigint, url string, text string, n_chars bigint")


#: SQL that gives the same rows in DuckDB on pages made as the given ones are:
#: one article of a headline and paragraphs, bold text and line breaks, and the
#: character references of an escaping writer.
ORACLE_SQL = r"""
WITH article AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'), '</?b>', '', 'g') AS body FROM pages
), cut AS (
  SELECT page_id, url, list_transform(string_split(regexp_replace(body, '</?(h1|p)>', chr(1), 'g'), chr(1)),
    lambda x: replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')) AS parts FROM article
), joined AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM cut
)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM joined
"""
