"""The page parser and extraction on ordinary markup that is not tidy."""
from pyspark.sql import functions as F

from catalog_engine.functions import nodes as N
from catalog_engine.operators import extract as E


def outline(spark, html):
    row = spark.createDataFrame([(html,)], "html string").select(N.page_nodes(F.col("html")).alias("n")).first()
    return None if row.n is None else [(x.tag or x.raw, x.depth) for x in row.n]


def test_outlines(spark):
    cases = {
        "<p>a<p>b": [("p", 0), ("a", 1), ("p", 0), ("b", 1)],
        "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": [("ul", 0), ("li", 1), ("a", 2), ("li", 1), ("b", 2), ("ul", 2), ("li", 3), ("c", 4), ("li", 1), ("d", 2), ("e", 0)],
        "<table><tr><td>a<td>b<tr><td>c</table>d": [("table", 0), ("tr", 1), ("td", 2), ("a", 3), ("td", 2), ("b", 3), ("tr", 1), ("td", 2), ("c", 3), ("d", 0)],
        "<td><table><tr><td>x</td></tr></table>y</td>": [("td", 0), ("table", 1), ("tr", 2), ("td", 3), ("x", 4), ("y", 1)],
        "<div><td></div>a</td></div>b": [("div", 0), ("td", 1), ("a", 2), ("b", 0)],
        "<a title='x > y'>t</a><br>u<img src=q/>v": [("a", 0), ("t", 1), ("br", 0), ("u", 0), ("img", 0), ("v", 0)],
        "1 < 2 <b>x</b> <": [("1 ", 0), ("< 2 ", 0), ("b", 0), ("x", 1), (" ", 0), ("<", 0)],
        "<B CLASS=q>x</b></i>y": [("b", 0), ("x", 1), ("y", 0)],
        "": [],
        None: None,
    }
    for html, want in cases.items():
        got = outline(spark, html)
        assert got == want, (html, got)
    hidden = outline(spark, "<script>if (a < b) '<span id=\"x\">'</script>t<!-- <b> -->u<style>p > a {}</style>")
    assert hidden == [("script", 0), ("tu", 0), ("style", 0)]


def test_attributes_by_name(spark):
    tags = ["""<a title='x class="image"' class="big image">""", '<a data-class="image">', "<a class=image>", '<a class="images">', '<A\n CLASS = "image"\thref=/x>', '<a title="a > b" href="/q?a=1&amp;b=2">']
    rows = spark.createDataFrame([(t,) for t in tags], "raw string")
    got = rows.select(N.with_class("image")(F.col("raw")).alias("c"), N.value_of(F.col("raw"), "href").alias("h")).collect()
    assert [r.c for r in got] == [True, False, True, False, True, False]
    assert [r.h for r in got] == [None, None, None, None, "/x", "/q?a=1&b=2"]


def extracted(spark, html):
    page = spark.createDataFrame([("https://shop.example.com/p/1", html, 1)], "url string, html string, page_number int")
    return E.extract_products(page).first()


SPAN = '<span id="product-brand-title"><a{0} href="/b">Brand</a></span><span id="product-title">Name</span>'


def test_scripts_and_comments_are_not_read(spark):
    r = extracted(spark, "<script>var t = '<span id=\"product-title\">Wrong</span>';</script><!-- <span id=\"product-title\">Old</span> -->" + SPAN.format(""))
    assert (r.full_name, r.brand, r.name) == ("Brand Name", "Brand", "Name")


def test_quoted_end_of_tag(spark):
    assert extracted(spark, SPAN.format(' title="a > b"')).brand == "Brand"
    r = extracted(spark, SPAN.format("") + """<div title="x > y" class='hero image'><img alt="a > b" src="/i@2x.jpeg"></div>""")
    assert (r.image_url, r.high_res_image_url) == ("/i@2x.jpeg", "/i_original.jpeg")


def table(rows, head='<table class="product-skim"><tbody>', end="</tbody></table>"):
    return SPAN.format("") + f'<div id="ingredlist-table-section">{head}{rows}{end}</div>'


CELLS = '<td><a href="/i/{0}">{0}</a>{2}<td><a>role {0}</a>{2}<td><span title="irritancy: 1"></span><span title="comedogenicity: 2"></span>{2}<td><span class="our-take">{1}</span>{2}'


def test_omitted_end_tags(spark):
    for end, row_end in (("", ""), ("</td>", ""), ("</td>", "</tr>"), ("", "</tr>")):
        rows = "".join("<tr>" + CELLS.format(n, take, end) + row_end for n, take in (("one", "goodie"), ("two", "icky")))
        got = extracted(spark, table(rows)).ingredients
        assert [(i.name, i.what_it_does, i.irritancy_values, i.comedogenicity_values, i.id_rating) for i in got] == [
            ("one", ["role one"], ["1"], ["2"], "goodie"), ("two", ["role two"], ["1"], ["2"], "icky")], (end, row_end)
        assert [i.ingredient_link for i in got] == ["https://shop.example.com/i/one", "https://shop.example.com/i/two"]


def test_nested_table_in_a_cell(spark):
    inside = "<table><tr><td>note</td><td>more</td></tr></table>"
    rows = "<tr>" + CELLS.format("one", "goodie", "</td>").replace('</a></td>', "</a>" + inside + "</td>", 1) + "</tr>"
    (got,) = extracted(spark, table(rows)).ingredients
    assert (got.name, got.what_it_does, got.id_rating) == ("one", ["role one"], "goodie")


def test_nested_divs_are_records_each(spark):
    span = '<span class="bold"><a>solvent</a></span><span><a>water</a></span>'
    html = SPAN.format("") + f'<div id="ingredlist-highlights-section"><span class="hashtag">#x</span><div class="ingredlist-by-function-block"><div><div>{span}</div></div></div></div>'
    r = extracted(spark, html)
    assert [(h["function"], h.ingredients) for h in r.highlights] == [("solvent", ["water"])] * 2
    assert r.hashtags == ["#x"]


def test_text_is_the_elements_own(spark):
    r = extracted(spark, SPAN.format("").replace("Name", "<b>x</b>A &amp; B<i>y</i>C"))
    assert r.name == "A & B"


def test_plan_of_names_parses_each_page_once(spark):
    """Flattening does not filter on the extraction."""
    page = spark.createDataFrame([("u", table("<tr>" + CELLS.format("one", "goodie", "</td>")), 1)], "url string, html string, page_number int")
    plan = E.flatten_ingredients(E.extract_products(page))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "regexp_extract_all" in line for line in plan.split("\n"))
