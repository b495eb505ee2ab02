"""Pages at scale: parsed once, never broadcast, dealt out without a sort."""
from pyspark.sql import functions as F

from catalog_engine.functions.html import decode_references, references_decoded
from catalog_engine.operators import extract as E
from catalog_engine.operators import state as ST
from catalog_engine.plans import crawl
from catalog_engine.session import spread_for_compute

PAGE = ('<span id="product-brand-title"><a>Brand</a></span><span id="product-title">Name</span><div class="image"><img src="/i@2x.jpeg"></div>'
        '<div id="ingredlist-table-section"><table class="product-skim"><tbody><tr><td><a href="/w">Water</a><td><a>solvent</a>'
        '<td><span title="irritancy: 1"></span><span title="comedogenicity: 2"></span></table></div>')


def pages(spark, n=6):
    return spark.createDataFrame([(k, f"https://s.com/p/{k}", PAGE if k else None, k) for k in range(n)], "page_id long, url string, html string, page_number int")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_the_extraction_parses_each_page_once(spark):
    """neither a filter nor a status repeats the parsing."""
    products = E.extract_products(pages(spark))
    shown = products.filter(F.col("image_url").isNotNull()).select("url", "image_url", "high_res_image_url")
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("full_name").isNull(), "none").otherwise("named").alias("status")
    for df in (shown, products.groupBy(status).count(), products.select("url", F.explode("ingredients"))):
        text = plan(df)
        assert text.count("regexp_extract_all(regexp_replace(html") == 0 and sum("EvalPython" in line for line in text.split("\n")) == 1, text
    assert {r.high_res_image_url for r in shown.collect()} == {"/i_original.jpeg"} and shown.count() == 5


def test_references_of_strings_and_columns_agree(spark):
    texts = ["a &amp; b", "&#65;&#x42;&#X43;", "&bogus;&#0;&#xD800;&#1114111;&#1114112;&#9999999;", "&eacute;&Alpha;&amp", "&", "", None, "&amp;amp; 1 &lt 2"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_references("t").alias("d")).collect()
    assert [(r.t, r.d) for r in rows] == [(t, references_decoded(t)) for t in texts]


def test_pages_and_state_are_not_broadcast_by_their_size_on_disk(spark, tmp_path):
    """A table of pages, and a state, that is a few bytes on disk."""
    folder = str(tmp_path / "pages")
    pages(spark).write.parquet(folder)
    stored = spark.read.parquet(folder)
    taken = []
    real = E.match_products
    try:
        E.match_products = lambda products, *a, **k: taken.append(products) or real(products, *a, **k)
        listing = spark.createDataFrame([(0, "https://s.com/products/all?offset=0", '<a href="/products/1">x</a>')], "page_id long, url string, html string")
        catalogue = spark.createDataFrame([(0, "Brand", "Name", "c")], "idx long, brand string, name string, category string")
        state = spark.createDataFrame([], crawl.STATE_SCHEMA)
        crawl._products(spark, listing, stored, catalogue, state, 90)
    finally:
        E.match_products = real
    physical = taken[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in physical and "SortMergeJoin" in physical
    folder = str(tmp_path / "state")
    spark.createDataFrame([("u", "Brand Name", False, None, None, 1, None, 1, 1)], crawl.STATE_SCHEMA).write.parquet(folder)
    links = spark.createDataFrame([("u", 1), ("v", 2)], "full_url string, page_number int")
    routed = ST.route_links(links, spark.read.parquet(folder), catalogue)
    assert {r.full_url: r.route for r in routed.collect()} == {"u": "emit_rematched", "v": "fetch"}
    assert "strategy=merge" in routed._jdf.queryExecution().analyzed().toString()


def test_pages_are_dealt_out_by_hash_and_once(spark, tmp_path):
    """dealing rows in turn sorts each task's pages in memory first."""
    pages(spark).write.parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    spread = spread_for_compute(stored)
    exchange = spread._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in exchange and "RoundRobinPartitioning" not in exchange
    longer = spread.select("*", F.concat("html", F.lit("x")).alias("more"))
    assert plan(spread_for_compute(longer)) == plan(longer)
    assert sorted(r.page_id for r in spread_for_compute(stored, 40).collect()) == list(range(6))
    assert spread_for_compute(stored, 40).rdd.getNumPartitions() == 40


def test_product_pages_are_built_where_they_are_spread(spark, tmp_path):
    """the rows are dealt out before they become pages, more tasks for more rows."""
    from catalog_engine.plans import fixtures as FX
    folder = str(tmp_path / "part.parquet")
    spark.range(0, 12).selectExpr("id AS p_partkey", "'red ring' AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "1 AS p_size").write.parquet(folder)
    text = plan(E.extract_products(FX.product_pages(spark, str(tmp_path))))
    assert sum("Repartition" in line for line in text.split("\n")) == 1, text
    assert FX.product_pages(spark, str(tmp_path)).count() == 12


def test_a_match_parses_each_page_once(spark):
    """F8 to F11, and the fetched pages of F2, F3: names and rows of a match come from one extraction."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(html):
        seen.add(1)
        return html

    catalogue = spark.createDataFrame([(0, "Brand", "Name", "c")], "idx long, brand string, name string, category string")
    products = E.extract_products(pages(spark).withColumn("html", counted.asNondeterministic()("html")))
    rows = E.match_products(products.select("url", "full_name", "error"), catalogue).collect()
    assert sorted((r.url[-1], r.matched, r.matched_name) for r in rows) == [("0", False, None)] + [(str(k), True, "Brand Name") for k in range(1, 6)]
    assert seen.value == 6


def test_large_text_sides_are_not_broadcast(spark, monkeypatch):
    """neither distinct names nor the catalogue pass through the driver when they are many."""
    from catalog_engine.operators import matching as M
    names = spark.createDataFrame([("Brand Name",), ("Brand Other",)], "_text string")
    catalogue = spark.createDataFrame([(0, "Brand", "Name", "c")], "idx long, brand string, name string, category string")
    hints = lambda: M.match_candidates(names, catalogue)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in hints() and "strategy=merge" not in hints()
    monkeypatch.setattr(M, "TEXT_BROADCAST_BYTES", 100)
    assert "strategy=broadcast" not in hints() and hints().count("strategy=merge") == 2
    assert [r.matched_name for r in M.best_match_texts(names, catalogue).collect()] == ["Brand Name"]
