"""S1/S3 (JSON-array catalogue, whole-load validation), URL resolution
edge cases and the skip-list modes."""
import json
import os

import pytest
from pyspark.sql import functions as F

from catalog_engine.functions.urls import resolve_url
from catalog_engine.operators import links as L
from catalog_engine.session import scratch_path
from catalog_engine.sources import catalogue as C


def _write(spark, name, items):
    path = scratch_path(spark, name)
    if path.startswith("file:"):
        path = path[len("file:"):]
    os.makedirs(path, exist_ok=True)
    f = os.path.join(path, "catalogue.json")
    with open(f, "w", encoding="utf-8") as fh:
        json.dump(items, fh, ensure_ascii=False)
    return f


def test_json_catalogue_keeps_positions_and_dedups(spark):
    items = [{"brand": "Dove", "name": "Soap", "category": "a"},
             {"brand": "Dove", "name": "Soap", "category": "b"},
             {"brand": "Nivea", "name": "Crème"}]
    cat = C.read_catalogue_json(spark, _write(spark, "cat-ok", items))
    rows = sorted((r.idx, r.brand, r.name, r.category) for r in cat.collect())
    assert rows == [(0, "Dove", "Soap", "a"), (1, "Dove", "Soap", "b"), (2, "Nivea", "Crème", None)]
    uniq = {r.full_name: (r.idx, r.category) for r in C.unique_catalogue(cat).collect()}
    assert uniq == {"Dove Soap": (0, "b"), "Nivea Crème": (2, "")}  # first position, last category
    d = C.duplicate_count(cat).first()
    assert (d.original_count, d.unique_count, d.duplicates_removed) == (3, 2, 1)


def test_validation_rejects_whole_load(spark):
    cat = C.read_catalogue_json(spark, _write(spark, "cat-bad", [{"brand": "x", "name": "y"}, {"brand": "z"}]))
    with pytest.raises(C.CatalogueError):
        C.validate_catalogue(cat)
    assert C.validate_catalogue(cat, mode="quarantine").count() == 1
    assert C.invalid_rows(cat).count() == 1


def test_resolve_url_forms(spark):
    base = "https://shop.example.com/products/all?offset=3#top"
    cases = {
        "https://other.org/x": "https://other.org/x",
        "//cdn.example.com/i.png": "https://cdn.example.com/i.png",
        "/products/7": "https://shop.example.com/products/7",
        "?offset=4": "https://shop.example.com/products/all?offset=4",
        "#frag": "https://shop.example.com/products/all?offset=3#frag",
        "": "https://shop.example.com/products/all?offset=3",
        "9": "https://shop.example.com/products/9",
        "../brands/5": "https://shop.example.com/brands/5",
        "./x/../y": "https://shop.example.com/products/y",
    }
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    got = {r.h: r.u for r in df.select("h", resolve_url(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == cases


def test_skip_modes_and_offsets(spark):
    df = spark.createDataFrame([("/products/all-day-cream",), ("/products/new",), ("/products/7",)], "href string")
    keep_c = [r.href for r in df.filter(L.skip_filter("href")).collect()]
    keep_s = [r.href for r in df.filter(L.skip_filter("href", mode="segment")).collect()]
    assert keep_c == ["/products/7"]                      # reference rule: substring
    assert keep_s == ["/products/all-day-cream", "/products/7"]
    u = spark.createDataFrame([("x?offset=12&offset=3",), ("x?page=2",), ("x?offset=",)], "url string")
    assert [r.o for r in u.select(L.page_offset("url").alias("o")).collect()] == [12, 0, 0]


def test_dot_segments_at_any_depth(spark):
    from urllib.parse import urljoin
    from catalog_engine.functions.urls import resolve_url
    base = "https://s.com/a/b/c/d/e/p?x=1#f"
    hrefs = ["../../../../z", "../../../../../../../z", "..", ".", "a/..", "a/./b", "/q/../w", "/../w", "/a/b/../../..", "./x?y=../z", "g;x/../y",
             "a//b", "//h.com/a/../b", "https://o.com/a/../b", "", "?q", "#g", "../x#../y"]
    rows = spark.createDataFrame([(base, h) for h in hrefs], "b string, h string")
    for r in rows.select("h", resolve_url("b", "h").alias("u")).collect():
        assert r.u == (urljoin(base, r.h) if r.h else base.partition("#")[0]), r.h


def test_links_from_ordinary_markup(spark):
    html = """<!-- <a href="/products/old">x</a> --><a data-href="/products/no">n</a><a class='c' href='/products/1?a=1&amp;b=&#50;'>1</a>
    <A HREF=/products/2>2</A><a href="/products/3?offset=99999999999999999999">3</a>"""
    from catalog_engine.operators import links as L
    page = spark.createDataFrame([(1, "https://s.com/products/all?offset=9223372036854775807", html)], "page_id long, url string, html string")
    assert [r.href for r in L.extract_links(page).orderBy("pos").collect()] == ["/products/1?a=1&b=2", "/products/2", "/products/3?offset=99999999999999999999"]
    assert L.product_links(page).select("page_number").first().page_number is None
    L.with_page_numbers(page.select("page_id", "url")).collect()


def test_product_page_probes(spark):
    from catalog_engine.operators.extract import extract_products

    def one(body):
        row = spark.createDataFrame([("https://s.com/p", body, 1)], "url string, html string, page_number int")
        return extract_products(row).first()

    r = one("""<span id='product-brand-title'><a>Head &amp; Shoulders&#33;</a></span><span class="x" id=product-title>A &eacute;&#x42;</span>
    <div class="image big"><div><b></b></div><img src='/i@2.png'></div>""")
    assert (r.brand, r.name, r.full_name, r.image_url) == ("Head & Shoulders!", "A éB", "Head & Shoulders! A éB", "/i@2.png")
    r = one("""<span id="product-brand-title"></span><a>Log in</a><table class="product-skim"><tbody><tr><td><a>no</a></td></tr></tbody></table>
    <div class="image"></div><footer><img src="/logo.png"><span class="hashtag">#no</span></footer>""")
    assert r.brand is None and r.image_url is None and r.ingredients == [] and r.hashtags is None
    r = one("""<div id="ingredlist-table-section"><div>x</div><table class="a product-skim"><tbody><tr><td><a href="/w"><b>x</b>Aqua</a></td></tr></tbody></table>
    <table class="product-skim"><tbody><tr><td><a>Two</a></td></tr></tbody></table></div>
    <div id="ingredlist-highlights-section"><div class="ingredlist-by-function-block"><div class="k"><span class="a bold" x="1"><a>F</a></span>
    <span y="2"><a>I</a></span></div></div></div><div><span class="hashtag">#out</span></div>""")
    assert [(i.name, i.ingredient_link) for i in r.ingredients] == [("Aqua", "https://s.com/w"), ("Two", None)]
    assert [(h.function, h.ingredients) for h in r.highlights] == [("F", ["I"])] and r.hashtags is None


def test_plan_grows_with_the_corpus(spark):
    from catalog_engine.operators import links as L
    offsets = spark.createDataFrame([(0,), (4000,), (4005,)], "offset long")
    plan = {r.batch_number: (r.pages, r.pages_present) for r in L.batch_plan(spark, offsets).collect()}
    assert plan[1] == (100, 1) and plan[41] == (6, 2)
    assert L.missing_pages(spark, offsets).count() == 4006 - 3


def test_study_keeps_every_score(spark):
    from catalog_engine.operators import matching as M
    cat = spark.createDataFrame([(0, "dove", "shampoo", "c")], "idx long, brand string, name string, category string")
    q = spark.createDataFrame([(1, "zzz qqq")], "query_id long, query string")
    per, merged = M.study_topk(q, cat)
    assert per.count() == 3 and merged.count() == 1
    assert M.recommendation(q, merged).first().quality == "poor"
    assert M.recommendation(q, M.study_topk(q, cat.limit(0))[1]).first().quality == "none"


def test_study_takes_each_query_s_own_count_and_threshold(spark):
    from catalog_engine.operators import matching as M
    cat = spark.createDataFrame([(i, "brand", f"name {i}", "c") for i in range(9)], "idx long, brand string, name string, category string")
    q = spark.createDataFrame([(1, "brand name 1", 2, 101.0), (2, "brand name 2", 4, 0.0)], "query_id long, query string, n int, t double")
    per, merged = M.study_topk(q, cat, top_matches="n")
    assert {r.query_id: r["count"] for r in merged.groupBy("query_id").count().collect()} == {1: 2, 2: 4}
    assert {r.query_id: r["count"] for r in per.groupBy("query_id").count().collect()} == {1: 12, 2: 24}
    shown = M.study_matches(merged.join(q.select("query_id", "t"), "query_id"), "t")
    assert {r.query_id for r in shown.collect()} == {2}


def test_match_refuses_an_invalid_catalogue(spark):
    import pytest
    from catalog_engine.operators import matching as M
    from catalog_engine.sources.catalogue import validate_catalogue
    cat = spark.createDataFrame([(0, "dove", "soap", "c"), (1, None, "x", "c")], "idx long, brand string, name string, category string")
    q = spark.createDataFrame([(1, "dove soap")], "query_id long, query string")
    with pytest.raises(Exception, match="catalogue rejected"):
        M.best_match(q, cat).collect()
    assert M.best_match(q, validate_catalogue(cat, "quarantine")).first().matched


def test_catalogue_over_several_files(spark):
    """Places go on from file to file; odd items are null, other documents refused."""
    import pytest
    from catalog_engine.sources import catalogue as C
    from catalog_engine.streaming.ingest import new_run_dir
    lists = ['[{"brand": "a", "name": "x", "category": "c"}, {"brand": "b", "name": null}]', "[]", '[7, {"name": "é \\"q\\"", "brand": "d", "more": [1]}]']
    base = new_run_dir(spark, "lists")
    for k, text in enumerate(lists):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/f{k}")
    got = sorted(tuple(r) for r in C.read_catalogue_files(spark, base).collect())
    assert got == [(0, "a", "x", "c"), (1, "b", None, None), (2, None, None, None), (3, "d", 'é "q"', None)]
    spark.createDataFrame([('{"brand": "a"}',)], "value string").coalesce(1).write.text(f"{base}/g")
    with pytest.raises(Exception, match="no JSON array"):
        C.read_catalogue_files(spark, base).collect()
