"""Product-page extraction.

A page ``(url, html, page_number)`` becomes the product
record. Arrow batches of pages are parsed once into nodes (``functions.nodes``); elements are
selected by tag, id and class token among the descendants of the elements around
them. The rules on what was found are built-in expressions: array functions build
the ingredient, hashtag and highlight lists.

Selector semantics kept: the first match is taken or nothing; ``::text`` is
text directly in the element, not in its children; a value is present when its
raw text is non-empty and is then stripped of Unicode whitespace (so
whitespace-only text becomes ''). Comments are ignored, character references
decoded.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions.similarity import let
from ..functions.text import ustrip
from ..functions.urls import resolve_url
from ..session import spread_for_compute, written_once

# Fixed values (must equal the reference's selectors and rules):
TITLE_ID, BRAND_ID, DETAILS_ID = "product-title", "product-brand-title", "product-details"
IMAGE_CLASS = "image"
TABLE_SECTION_ID, TABLE_CLASS = "ingredlist-table-section", "product-skim"
IRRITANCY, COMEDOGENICITY, OUR_TAKE_CLASS = "irritancy", "comedogenicity", "our-take"
HIGHLIGHTS_ID, HASHTAG_CLASS = "ingredlist-highlights-section", "hashtag"
BLOCK_CLASS, BOLD_CLASS = "ingredlist-by-function-block", "bold"
HIGH_RES_SUFFIX = "_original.jpeg"

INGREDIENT = ("struct<name:string,ingredient_link:string,what_it_does:array<string>,"
              "irritancy_values:array<string>,comedogenicity_values:array<string>,id_rating:string>")


def _present(raw: Column) -> Column:
    return raw.isNotNull() & (raw != "")


def _strip_if_present(raw: Column) -> Column:
    return F.when(_present(raw), ustrip(raw))


def _strip_nonblank(arr: Column) -> Column:
    return F.filter(F.transform(arr, lambda x: ustrip(x)), lambda x: x != "")


def _rating_values(titles: Column) -> Column:
    """Text between the first and second ':' of each title,
    stripped; titles without ':' are skipped; NULL when none is left."""
    vals = F.filter(F.transform(titles, lambda t: F.when(F.contains(t, F.lit(":")),
                                                         ustrip(F.split(t, ":").getItem(1)))),
                    lambda x: x.isNotNull())
    return let(vals, lambda v: F.when(F.size(v) > 0, v))


def table_cells(section: N.Content | None) -> list[list[N.Content]]:
    """The cells of each row of the product tables: a row's own, not those of a
    table inside one of them."""
    bodies = [b for t in N.all_inner(section, "table", N.with_class(TABLE_CLASS)) for b in N.all_inner(t, "tbody")]
    rows = [r for b in bodies for r in N.all_inner(b, "tr")]
    return [[cell for cell in N.all_inner(r, "td") if cell[0] == r[0] + 1] for r in rows]


def raw_ingredient(cells: list[N.Content]) -> dict:
    """What the selectors give for a row of cells."""
    c1, c2, c3, c4 = [*cells[:4], None, None, None, None][:4]
    return {"name": N.first_of(N.texts_of(c1, "a")), "href": N.first_of(N.attributes(c1, "a", "href")),
            "roles": N.texts_of(c2, "a"), "titles": N.attributes(c3, "span", "title"),
            "take": N.first_of(N.texts_of(c4, "span", N.with_class(OUR_TAKE_CLASS)))}


def ingredients(raw: Column, page_url: Column) -> Column:
    """Ingredient rows of the product tables, nameless rows dropped,
    first occurrence of a name kept, document order; [] without a table."""
    def of(r):
        values = lambda kind: _rating_values(F.filter(r["titles"], lambda t: F.contains(t, F.lit(kind))))
        return F.struct(
            _strip_if_present(r["name"]).alias("name"),
            F.when(_present(r["href"]), resolve_url(page_url, r["href"])).alias("ingredient_link"),
            F.when(F.size(r["roles"]) > 0, _strip_nonblank(r["roles"])).alias("what_it_does"),
            values(IRRITANCY).alias("irritancy_values"), values(COMEDOGENICITY).alias("comedogenicity_values"),
            _strip_if_present(r["take"]).alias("id_rating"))

    def first_wins(named):
        # keep an item when its name first occurs at its own position
        return let(F.transform(named, lambda y: y["name"]),
                   lambda names: F.filter(named, lambda x, i: F.array_position(names, x["name"]) == i + 1))

    items = F.filter(F.transform(raw, of), lambda x: x["name"].isNotNull() & (x["name"] != ""))
    return F.coalesce(let(items, first_wins), F.array().cast(f"array<{INGREDIENT}>"))


def hashtags(tags: Column) -> Column:
    """Hashtag texts of the highlights section, blanks removed;
    absent when the section or its hashtags are missing."""
    return F.when(F.size(tags) > 0, _strip_nonblank(tags))


def raw_highlights(section: N.Content | None) -> list[dict]:
    """What the selectors give for each div of the function blocks, also for
    those inside another."""
    links = lambda d, test: [t for s in N.all_inner(d, "span", test) for t in N.texts_of(s, "a")]
    divs = [d for b in N.all_inner(section, "div", N.with_class(BLOCK_CLASS)) for d in N.all_inner(b, "div")]
    return [{"fn": N.first_of(links(d, N.with_class(BOLD_CLASS))), "names": links(d, N.without_class(BOLD_CLASS))} for d in divs]


def highlights(raw: Column) -> Column:
    """Per function block div, the bold link text (function) and the
    other link texts (ingredients); kept when both were found; absent when
    the list is empty."""
    kept = F.filter(raw, lambda r: _present(r["fn"]) & (F.size(r["names"]) > 0))
    items = F.transform(kept, lambda r: F.struct(ustrip(r["fn"]).alias("function"), _strip_nonblank(r["names"]).alias("ingredients")))
    return let(items, lambda x: F.when(F.size(x) > 0, x))


def selected(html: bytes) -> dict:
    """What the selectors find in one page."""
    page = N.whole(N.nodes_of(html.decode("utf-8", "replace")))
    span = lambda ident: N.inner(page, "span", N.with_id(ident))
    section = N.inner(page, "div", N.with_id(HIGHLIGHTS_ID))
    return {
        "brand": N.first_of(N.texts_of(span(BRAND_ID), "a")), "name": N.direct_text(span(TITLE_ID)), "details": N.direct_text(span(DETAILS_ID)),
        "image": N.first_of(N.attributes(N.inner(page, "div", N.with_class(IMAGE_CLASS)), "img", "src")),
        "rows": [raw_ingredient(cells) for cells in table_cells(N.inner(page, "div", N.with_id(TABLE_SECTION_ID)))],
        "hashtags": N.texts_of(section, "span", N.with_class(HASHTAG_CLASS)), "blocks": raw_highlights(section)}


SELECTED = ("struct<brand:string,name:string,details:string,image:string,"
            "rows:array<struct<name:string,href:string,roles:array<string>,titles:array<string>,take:string>>,"
            "hashtags:array<string>,blocks:array<struct<fn:string,names:array<string>>>>")


def _selected(html: Column) -> Column:
    """``selected`` of a column of pages. Each is parsed once: as the function
    counts as not deterministic, Spark neither repeats it nor moves a filter on
    its results before it."""
    text, texts = pa.string(), pa.list_(pa.string())
    rows = pa.list_(pa.struct([("name", text), ("href", text), ("roles", texts), ("titles", texts), ("take", text)]))
    kind = pa.struct([("brand", text), ("name", text), ("details", text), ("image", text), ("rows", rows), ("hashtags", texts),
                      ("blocks", pa.list_(pa.struct([("fn", text), ("names", texts)])))])

    @F.arrow_udf(SELECTED)
    def select(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else selected(p) for p in pages.to_pylist()], kind)

    return select.asNondeterministic()(html.cast("binary"))


def extract_products(pages: DataFrame, url: str = "url", html: str = "html",
                     page_number: str = "page_number") -> DataFrame:
    """E1-E18 of every page: the selectors in one pass per page, the rules on what
    they find as one projection. Pages without HTML become error
    rows (E17) instead of failing the job."""
    if not pages.isStreaming:
        pages = spread_for_compute(pages)
    keep = [c for c in pages.columns if c not in (url, html, page_number)]
    h = F.col(html)
    pages = pages.select(*keep, F.col(url).alias("_url"), F.col(page_number).alias("_page_number"),
                         F.coalesce(h != "", F.lit(False)).alias("_ok"), _selected(h).alias("_found"))
    found, ok, u = F.col("_found"), F.col("_ok"), F.col("_url")
    brand_raw, name_raw, image_raw = found["brand"], found["name"], found["image"]
    both = _present(brand_raw) & _present(name_raw)
    image = F.when(_present(image_raw), image_raw)
    rec = [
        ("full_name", F.when(both, F.concat(ustrip(brand_raw), F.lit(" "), ustrip(name_raw)))),
        ("brand", _strip_if_present(brand_raw)),
        ("name", _strip_if_present(name_raw)),
        ("description", _strip_if_present(found["details"])),
        ("image_url", image),
        ("high_res_image_url", F.when(F.contains(image, F.lit("@")),
                                      F.concat(F.substring_index(image, "@", 1), F.lit(HIGH_RES_SUFFIX)))),
        ("ingredients", ingredients(found["rows"], u)),
        ("hashtags", hashtags(found["hashtags"])),
        ("highlights", highlights(found["blocks"])),
    ]
    out = pages.select(
        *keep,
        *[F.when(ok, c).alias(n) for n, c in rec[:4]],
        F.coalesce(F.col("_page_number").try_cast("int"), F.lit(0)).alias("page_number"),
        u.alias("url"),
        *[F.when(ok, c).alias(n) for n, c in rec[4:]],
        F.when(~ok, F.lit("empty or missing page body")).alias("error"))
    return out.withColumn("timestamp", F.current_timestamp())  # E18 (a clock: excluded from checks)


def match_products(products: DataFrame, catalogue: DataFrame, threshold: float = 90, **kw) -> DataFrame:
    """Match every extracted product by its full name (each distinct
    name scored once) and attach the category; rows without a full name
    or with an error are unmatched.

    The columns of ``products`` are written once: the names to match and the rows that
    get the result come from them, and what they come from is not run again. Pass
    only the columns that are used."""
    from .matching import best_match_texts, join_best
    kept = [c for c in products.columns if c not in ("matched", "matched_name", "category")]
    products = written_once(products.select(*kept))
    best = best_match_texts(products.select(F.col("full_name").alias("_text")), catalogue,
                            threshold=threshold, **kw)
    return join_best(products, best, "full_name", "url").select(*kept,
                    F.coalesce(F.col("matched"), F.lit(False)).alias("matched"),
                    "matched_name", "category")


def flatten_ingredients(products: DataFrame) -> DataFrame:
    """One row per (product, ingredient) with its position."""
    # outer, as Spark would otherwise test the array before it explodes it, and for
    # that compute the list a second time
    each = products.select("url", F.posexplode_outer("ingredients").alias("pos", "ing"))
    return each.where(F.col("pos").isNotNull()).select("url", "pos", "ing.*")


def flatten_functions(products: DataFrame) -> DataFrame:
    """One row per (product, ingredient, function)."""
    ing = flatten_ingredients(products)
    return ing.select("url", "pos", "name", F.explode("what_it_does").alias("function"))


def flatten_hashtags(products: DataFrame) -> DataFrame:
    return products.select("url", F.explode("hashtags").alias("hashtag"))
