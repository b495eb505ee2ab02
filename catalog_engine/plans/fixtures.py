"""Inputs of the reference's shapes derived from the driver tables (whole
tables; the same rules are written as SQL in ``plans.oracle``).

* catalogue        <- part  (idx = p_partkey, brand, name, category = p_type)
* query names      <- part  (one variant of each row's name, by key)
* study queries    <- distinct part names (the "how should I set the
                      threshold for this name" use case, one row per name)
* state / lookups  <- part / lineitem
* product pages    <- part  (HTML built by concatenation)
* listing pages    <- part  (50 product links per listing page)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread_for_compute, table

SHOP = "https://shop.example.com"
PAGE_SIZE = 50
#: Product pages that one task builds, and extracts, at most about.
PAGES_PER_TASK = 20_000


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("idx"), F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"), F.col("p_type").alias("category"))


def catalogue_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the catalogue: the first lacks the positions that end in 3,
    the second has these, lacks every eleventh and has other categories."""
    now, i = catalogue(spark, sf_dir), F.col("idx")
    category = F.when(i % 13 == 0, F.lower("category")).otherwise(F.col("category"))
    return now.filter(i % 10 != 3), now.filter(i % 11 != 5).withColumn("category", category)


def name_variant() -> "F.Column":
    """The name variant of a part row (by ``p_partkey % 6``): exact, tokens
    swapped, upper case, last character dropped, name only (short),
    decorated (``&``, hyphens, ``®``)."""
    full = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"))
    v = F.col("p_partkey") % 6
    q = (F.when(v == 0, full)
         .when(v == 1, F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")))
         .when(v == 2, F.upper(full))
         .when(v == 3, F.expr("substring(concat(p_brand, ' ', p_name), 1, length(concat(p_brand, ' ', p_name)) - 1)"))
         .when(v == 4, F.col("p_name"))
         .otherwise(F.concat(F.col("p_brand"), F.lit(" & "),
                             F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("®"))))
    return q


def query_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per part row (see ``name_variant``)."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("query_id"), name_variant().alias("query"))


def score_pairs_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs for the scorer queries: every query name against its own
    catalogue name and against the next key's catalogue name."""
    q = query_names(spark, sf_dir)
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("b"))
    own = q.join(p, q.query_id == p.p_partkey).select("query_id", F.lit(0).alias("shift"),
                                                      F.col("query").alias("a"), "b")
    nxt = q.join(p, q.query_id + 1 == p.p_partkey).select("query_id", F.lit(1).alias("shift"),
                                                          F.col("query").alias("a"), "b")
    return own.unionByName(nxt)


def study_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names as study queries, keyed by their first key."""
    return (table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("query"))
            .agg(F.min("p_partkey").alias("query_id")))


def study_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query name as a study request with its own ``top_matches`` (1 to 3)
    and ``show_threshold`` (60 to 90)."""
    return query_names(spark, sf_dir).select(
        "query_id", "query", (1 + F.col("query_id") % 3).alias("top_matches"), (60 + 10 * (F.col("query_id") % 4)).alias("show_threshold"))


def decorated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with the characters N1 rewrites (&, -, /, ®, ™, NBSP, tabs)."""
    p = table(spark, sf_dir, "part")
    v = F.col("p_partkey") % 4
    text = (F.when(v == 0, F.concat(F.col("p_brand"), F.lit(" & "), F.col("p_name"), F.lit("®")))
            .when(v == 1, F.concat(F.lit("  "), F.upper(F.col("p_brand")), F.lit("/"),
                                   F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("™ ")))
            .when(v == 2, F.concat(F.col("p_brand"), F.lit(" \t\u00a0"), F.col("p_name"), F.lit("\n")))
            .otherwise(F.concat(F.col("p_type"), F.lit(" -- "), F.col("p_name"))))
    return p.select(F.col("p_partkey").alias("id"), text.alias("text"))


def _href(k):
    v = k % 7
    path = F.concat(F.lit("/products/"), k.cast("string"))
    return (F.when(v == 1, F.concat(F.lit(SHOP), path))
            .when(v == 2, F.concat(F.lit("//shop.example.com"), path))
            .otherwise(path))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing corpus: 50 products per page (``offset = key div 50``), plus
    skip-list noise, a commented-out link, a ``data-href``, a repeated link, a
    link to the next page's first product and a pagination link. Groups are bounded by the page size."""
    p = table(spark, sf_dir, "part")
    off = F.floor(F.col("p_partkey") / PAGE_SIZE).cast("bigint")
    items = p.select(off.alias("offset"), F.col("p_partkey").alias("k"), _href(F.col("p_partkey")).alias("href"))
    li = lambda x: F.concat(F.lit('<li><a href="'), x["href"], F.lit('">'), x["k"].cast("string"), F.lit("</a></li>"))
    pages = items.groupBy("offset").agg(F.sort_array(F.collect_list(F.struct("k", "href"))).alias("items"),
                                        F.min("k").alias("first"))
    nxt = (F.col("offset") + 1).cast("string")
    html = F.concat(
        F.lit('<html><body><!-- <a href="/products/old">Old</a> --><a data-href="/products/no">No</a>'
              '<nav><a href="/products/new">New</a> <a href="/products/create">Create</a></nav><ul>'),
        F.array_join(F.transform("items", li), ""),
        F.lit('</ul><a href="/products/'), F.col("first").cast("string"), F.lit('">again</a>'),
        F.lit('<a href="/products/'), ((F.col("offset") + 1) * PAGE_SIZE).cast("string"), F.lit('">featured</a>'),
        F.lit('<a href="/about">About</a><a class="next" href="/products/all?offset='), nxt,
        F.lit('">Next</a></body></html>'))
    url = F.concat(F.lit(SHOP + "/products/all?offset="), F.col("offset").cast("string"))
    return pages.select(F.col("offset").alias("page_id"), url.alias("url"), html.alias("html"))


def product_url(k) -> "F.Column":
    return F.concat(F.lit(SHOP + "/products/"), k.cast("string"))


def state_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes per part key: version 1 from an earlier crawl (rows with
    ``key % 7 == 0`` were error rows without a name; a third matched) and
    version 2 from a later crawl in which keys ``% 5 == 0`` got matched."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    full = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"))
    name = F.when(k % 7 != 0, name_variant())
    m1 = (k % 3 == 0) & (k % 7 != 0)
    m2 = m1 | ((k % 5 == 0) & (k % 7 != 0))
    page = (F.floor(k / PAGE_SIZE) + 1).cast("int")

    def version(m, v):
        return p.select(product_url(k).alias("url"), name.alias("full_name"), m.alias("matched"),
                        F.when(m, full).alias("matched_name"), F.when(m, F.col("p_type")).alias("category"),
                        page.alias("page_number"), F.lit(v).alias("version"))
    return version(m1, 1).unionByName(version(m2, 2))


def state_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_versions(spark, sf_dir).filter(F.col("version") == 1)


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem is a URL request; ``l_partkey % 11 == 0`` asks for an
    unknown URL (a miss)."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    url = F.when(k % 11 == 0, F.concat(F.lit(SHOP + "/products/unknown-"), k.cast("string"))) \
        .otherwise(product_url(k))
    return li.select("l_orderkey", "l_linenumber", url.alias("url"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product pages built from part rows by concatenation (the oracle
    selects the source values). Variants by ``key % 9``: 1 empty brand before a
    stray link, 2 no name, 3 no ingredient section, 4 duplicate ingredient row,
    5 rating titles without ':', 6 image without '@', 7 NBSP/newline around text,
    8 blank link texts, 0 unclosed tags; by ``key % 5``: 1 character
    reference in the brand, 2 single quotes, 3 several classes and attributes
    on inner elements, 4 markup before an ingredient's name and a second table;
    ``key % 97 == 13`` has no body. Every page also holds what must not be
    taken: a commented-out title, a table and a hashtag outside their sections,
    a login link and a footer logo."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # a page is far longer than its row: rows are dealt out before, so many to a task
    p = spread_for_compute(p, -(-p.count() // PAGES_PER_TASK))
    k = F.col("p_partkey")
    v, w = k % 9, k % 5
    ks = k.cast("string")
    ing1 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    ing2 = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    ing3 = F.lower(F.col("p_type"))
    lit = F.lit

    def pick(cond, yes, no):
        return F.when(cond, lit(yes)).otherwise(lit(no))

    def row(x, link, role, irr, com, take):
        return F.concat(lit('<tr><td><a href="/ingredients/'), link, lit('">'), pick(w == 4, "<i>new</i>", ""), x, lit("</a></td>"),
                        lit('<td><a href="/roles/r">'), role, lit("</a></td>"),
                        lit('<td><span title="'), irr, lit('"></span><span title="'), com, lit('"></span></td>'),
                        lit("<td><span"), pick(w == 3, ' data-class="x" class="small our-take"', ' class="our-take"'), lit(">"),
                        take, lit("</span></td></tr>"))

    r1 = row(ing1, ing1, lit("solvent"), F.concat(lit("irritancy: "), (k % 3).cast("string")),
             F.concat(lit("comedogenicity: "), (k % 5).cast("string")), lit("goodie"))
    r2 = row(F.when(v == 8, lit(" ")).otherwise(ing2), ing2, pick(v == 8, " ", "emollient"),
             F.when(v == 5, lit("irritancy unknown")).otherwise(
                 F.concat(lit("irritancy: "), (k % 4).cast("string"), lit(":x"))),
             F.concat(lit("comedogenicity: "), (k % 2).cast("string")), lit("icky"))
    r3 = row(ing3, ing3, lit("preservative"), lit("irritancy: 0"), pick(v == 5, "comedogenicity", "comedogenicity: 1"), lit(""))
    rdup = row(ing1, F.concat(ing1, lit("-2")), lit("humectant"), lit("irritancy: 9"), lit("comedogenicity: 9"), lit("superstar"))
    outside = '<table class="product-skim"><tbody><tr><td><a href="/o">Outside</a></td></tr></tbody></table>'
    open_table = '<table class="product-skim"><thead><tr><th>Name</th></tr></thead><tbody>'
    table_html = F.when(v == 3, lit("")).otherwise(F.concat(
        lit('<div id="ingredlist-table-section"><div class="tools"><a>Filter</a></div>'), lit(open_table),
        r1, r2, F.when(v == 4, rdup).otherwise(lit("")), pick(w == 4, "</tbody></table>" + open_table, ""), r3,
        lit("</tbody></table></div>")))
    brand_core = F.concat(F.col("p_brand"), pick(w == 1, " &amp; Co", ""))
    brand_text = F.when(v == 7, F.concat(lit("\u00a0"), brand_core, lit("\n"))).otherwise(brand_core)
    brand = F.concat(
        lit('<span id="product-brand-title">'),
        F.when(v == 1, lit("")).otherwise(F.concat(lit('<a href="/brands/'), F.col("p_brand"), lit('">'), brand_text, lit("</a>"))),
        lit('</span><a href="/login">Log in</a>'))
    name_text = F.when(v == 7, F.concat(lit(" "), F.col("p_name"), lit("\u00a0"))).otherwise(F.col("p_name"))
    title = F.when(v == 2, lit("")).otherwise(F.concat(lit('<span class="t" id="product-title">'), name_text, lit("</span>")))
    details = F.concat(lit('<span id="product-details">'), F.col("p_type"), lit(" size "), F.col("p_size").cast("string"), lit("</span>"))
    image = F.concat(lit("<div class="), pick(w == 3, '"hero image big"', '"image"'), lit('><img alt="p" data-src="/no.png" src="/img/'), ks,
                     pick(v == 6, ".jpeg", "@1x.jpeg"), lit('"></div>'))
    fdiv, bold, plain = (pick(w == 3, yes, no) for yes, no in (
        ('<div class="f">', "<div>"), ('<span class="x bold">', '<span class="bold">'), ('<span class="y">', "<span>")))
    hl = F.concat(lit('<div id="ingredlist-highlights-section"><span class="hashtag">#'), ing3,
                  lit('</span><span class="hashtag"> </span><div class="ingredlist-by-function-block">'),
                  fdiv, bold, lit("<a>solvent</a></span>"), plain, lit("<a>"), ing1, lit("</a></span></div>"),
                  fdiv, bold, lit("<a> </a></span>"), plain, lit("<a>"), ing3, lit("</a></span></div></div></div>"))
    head = F.concat(brand, title, details, image)
    head = F.when(w == 2, F.replace(head, lit('"'), lit("'"))).otherwise(head)
    html = F.when(k % 97 == 13, lit(None).cast("string")).otherwise(F.concat(
        lit('<html><head><title>'), F.col("p_name"), lit('</title></head><body><!-- <span id="product-title">Old</span> -->'), head,
        pick(v == 0, "<p>note <b>bold", ""), lit(outside), table_html, hl,
        lit('<div class="footer image-strip"><img src="/logo.png"></div><span class="hashtag">#footer</span></body></html>')))
    return p.select(k.alias("page_id"), product_url(k).alias("url"),
                    (F.floor(k / PAGE_SIZE) + 1).cast("int").alias("page_number"), html.alias("html"))
