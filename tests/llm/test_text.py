"""Decontamination, line dedup and HTML extraction."""
import random

import numpy as np
from conftest import SF_SMALL

from catalog_engine.llm import decontaminate, html_text, line_dedup


def brute_edits(words, item):
    """Least edits of any run of ``words`` against the item."""
    last = [0] * (len(words) + 1)
    for i, w in enumerate(item):
        now = [i + 1]
        for j, x in enumerate(words):
            now.append(min(last[j + 1] + 1, now[j] + 1, last[j] + (w != x)))
        last = now
    return min(last)


def test_edit_distance_is_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text, item = (rng.integers(0, 4, rng.integers(3, 12)).astype(np.uint64) for _ in range(2))
        want = min(prefix_distance(text[:j].tolist(), item.tolist()) for j in range(len(text) + 1))
        assert decontaminate.edit_distances(text[None], item[None])[0] == want


def prefix_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(last[j + 1] + 1, now[j] + 1, last[j] + (x != y)))
        last = now
    return last[-1]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"edit{rng.randrange(999)}"
        elif kind == 1:
            words.insert(at, f"add{rng.randrange(999)}")
        else:
            del words[at]
    return words


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(5)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    words = {i: decontaminate.WORD.findall(t.lower()) for i, t in items}
    docs, planted = [], set()
    for d in range(200):
        host = texts[d % len(texts)].split(" ")[:150]
        item = items[d % len(items)][0]
        edits = rng.randint(0, decontaminate.edits_allowed(len(words[item])))
        at = rng.randint(0, len(host))
        docs.append((d, " ".join(host[:at] + edited(rng, words[item], edits) + host[at:])))
    for d, text in docs:
        own = decontaminate.WORD.findall(text.lower())
        for i, w in words.items():
            if len(set(w) & set(own)) > len(set(w)) // 2 and brute_edits(own, w) <= decontaminate.edits_allowed(len(w)):
                planted.add((d, i))
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert len(planted) >= 200
    assert got <= planted
    assert len(got) >= 0.95 * len(planted)
    some = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), pass_bytes=2000)
    assert {(r.doc_id, r.item_id) for r in some.collect()} == got


def test_decontamination_finds_edits_in_the_first_words():
    for m in (6, 10, 15, 30):
        item = [f"i{m}x{x}" for x in range(m)]
        benchmark = decontaminate.Benchmark([(m, " ".join(item))])
        for copy, start in (([item[0], "add", *item[1:]], 3), ([item[0], *item[2:]], 3), (item[1:], 2), (["edit", *item[1:]], 3)):
            got = decontaminate.matches(benchmark, [None, "p q", " ".join(["u", "v", "w", *copy, "x", "y"])])
            assert min((d, i, e, s) for d, i, s, e in got) == (2, m, 1, start), (m, copy)


def test_decontamination_recall_at_the_largest_edit_count():
    rng = random.Random(12)
    for m in (15, 30, 31, 45, 59, 100, 200, 400):
        k = decontaminate.edits_allowed(m)
        assert all(k // len(decontaminate.pieces(m)) <= decontaminate.edits_allowed(b - a) for a, b in decontaminate.pieces(m))
        items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(m))) for i in range(100)]
        docs = [" ".join(["c"] * 9 + edited(rng, t.split(), k) + ["d"] * 9) for _, t in items]
        got = {(d, i) for d, i, _, _ in decontaminate.matches(decontaminate.Benchmark(items), docs)}
        assert len({(i, i) for i, _ in items} & got) >= 95, m


def test_nearest_runs_are_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        text, item = (rng.integers(0, 4, rng.integers(3, 12)).astype(np.uint64) for _ in range(2))
        want = min((prefix_distance(text[i:j].tolist(), item.tolist()), i) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        assert tuple(int(x[0]) for x in decontaminate.nearest_runs(text[None], item[None])) == want


def test_decontamination_finds_all_exact_passages(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = [(i, "Before it.\n" + "".join(c.upper() if c.isascii() else c for c in t).replace(" ", "  ") + "\nafter") for i, t in items]
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in out}
    assert all(r.edits == 0 and r.start_word == 2 for r in out if r.doc_id == r.item_id)


def test_decontamination_edges(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b c d e f"), (2, ""), (3, "a b c d e f"), (3, "A, b. c d! e f"), (4, "z " * 30000 + "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "a b c d e f"), (9, "a b c d e f"), (None, None), (8, ""), (7, "a b c d"), (None, "a b c d e f")], "item_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted(map(str, ((r.doc_id, r.item_id, r.start_word, r.edits) for r in got))) == sorted(map(str, [(d, i, 30000 if d == 4 else 0, 0) for d in (None, 3, 4) for i in (9, None)]))
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def brute_lines(rows, least):
    """rows: (doc_id, text, site) with distinct ids."""
    sites, first = {}, {}
    for d, t, s in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            body = line.strip(" \t\r")
            if body:
                sites.setdefault(body, set()).add(s)
                first.setdefault(body, (d, k))
    out = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if not (b := x.strip(" \t\r")) or len(sites[b]) < least or first[b] == (d, k)]
        out.append((d, len(lines), len(lines) - len(kept), t if t is None else "\n".join(kept)))
    return sorted(out)


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(6)
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    top = max(r[0] for r in rows) + 1
    for k in range(300):
        lines = [f"common {rng.randrange(12)}" if rng.random() < 0.6 else f"own {k} {x}" for x in range(rng.randint(1, 8))]
        rows.append((top + k, rng.choice(["\n", "\r\n", "\n\n \t\n"]).join(lines), f"s{min(rng.randrange(60), rng.randrange(60))}" if k % 9 else None))
    rows += [(top + 1000, None, "a"), (top + 1001, "", "a"), (top + 1002, "\n\n", "b")]
    for least in (2, 5, 30):
        got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=least)
        assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()) == brute_lines(rows, least)


def test_line_dedup_edges(spark):
    schema = "doc_id long, text string, source string, n_lines int, uid int"
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "x\ny", s, 5, 6) for s in "abcdef"] + [(None, "x", "q", 5, 6)]
    got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "source", "n_lines", "uid", "_n_lines", "n_removed"]
    # rows equal in id and text share their first places; null sorts first
    assert sorted((r.text, r.n_lines, r._n_lines) for r in got.collect()) == [("x", 5, 1)] + [("y", 5, 2)] * 6


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><a href="/x">Menu</a></nav><div class="cookie notice">We use cookies</div><!-- <p>no</p> -->
<article id=post><h1>Head &amp; line</h1><p><b>One   two<br>three &lt;4&gt; &#233;&nbsp;x.<br><p>Second <i>para</i>graph<ul><li>a<li>b</ul>
<form><input value="q"><p>Ask</p></form><aside>Side</aside><div class="ad">Buy</div><section class="comments"><article><p>Nice!</p></article></section>
<table><tr><td>c1<td>c2<tr><td>c3</table>Tail</article><div id="sidebar">links</div><footer>&copy; me</footer></body></html>"""


def test_html_blocks():
    assert html_text.main_text(PAGE).split("\n\n") == ["Head & line", "One two three <4> é x.", "Second paragraph", "a", "b", "c1", "c2", "c3", "Tail"]
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert html_text.main_text("<p>a<p>b</p></div>c") == "a\n\nb\n\nc"
    assert html_text.main_text("<div>" * 30000 + "deep") == "deep"
    assert html_text.main_text("<main><p>in</p></main><p>out</p>") == "in"


def test_html_layout_classes_are_no_furniture():
    for name in ("overflow-hidden", "layout has-sidebar", "no-sidebar", "side-effects", "search-results", "page-header", "flex hidden md:block", "left-sidebar", "with-menu navy"):
        for inner in ("<article><h1>Head</h1><p>Text of it</p></article>", "<main><h1>Head</h1><p>Text of it</p></main>", "<h1>Head</h1><p>Text of it</p>"):
            assert html_text.main_text(f"<body><nav>x</nav><div class='{name}'>{inner}</div></body>") == "Head\n\nText of it", (name, inner)
    assert html_text.main_text("<article><div class='article-header'><h1>Head</h1></div><p>Text of it</p></article>") == "Head\n\nText of it"
    assert html_text.main_text("<div class='modal'><article><p>In</p></article><nav>x</nav></div><div class='menu'>A longer list of links than the text</div>") == "In"
    for name in ("sidebar", "site-footer", "main-nav", "cookie-banner", "share-buttons", "ad-slot", "site-header", "related-posts", "breadcrumb", "newsletter_form", "post-comments", "comment-list", "side-nav"):
        page = f"<article><p>The text of this article</p><div class='x {name}'>Other</div></article><div id='{name}'><article>Other</article></div>"
        assert html_text.main_text(page) == "The text of this article", name
    assert html_text.main_text("<article><p>Text</p><div class=comments>Longer than the text itself</div></article>") == "Text"


def test_html_template_removal(spark):
    head = "<div class='top'><p>Welcome to the site</p></div>"
    pages = [(k, f"https://h.example/{k}", f"<html><body>{head}<div><p>Story {k} begins here.</p><p>It ends.</p></div><div><p>All rights reserved</p></div></body></html>") for k in range(30)]
    pages += [(100 + k, f"http://other.example/{k}", f"<body>{head}<p>Other {k}</p></body>") for k in range(3)]
    pages += [(200, None, None), (201, "", ""), (None, "x", "<p>q"), (200, None, None)]
    for broadcast_bytes in (1 << 20, 0):
        got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), broadcast_bytes=broadcast_bytes).collect()
        assert len(got) == len(pages)
        text = {r.page_id: r.text for r in got}
        # "It ends." stands on every page of the host too, and goes with the rest of the template
        assert text[7] == "Story 7 begins here."
        assert text[101] == "Welcome to the site\n\nOther 1"
        assert text[200] == text[201] == "" and text[None] == "q"
        assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string, host string, text int")).count() == 0


def test_html_keeps_a_copied_article(spark):
    pages = [(k, f"https://h.example/{k}", f"<body><nav>{k}</nav><article><p>Same text</p></article></body>") for k in range(40)]
    got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Same text"}


def test_html_gives_back_documents(spark):
    """The articles of the given pages: headline, then paragraphs."""
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        inside = r.html.partition("<article>")[2].partition("</article>")[0]
        want = inside.replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        for tag in ("<h1>", "</h1>", "<p>", "</p>"):
            want = want.replace(tag, "\0")
        import html

        blocks = [" ".join(html.unescape(b).split()) for b in want.split("\0")]
        assert html_text.main_text(r.html) == "\n\n".join(b for b in blocks if b)
