"""Page attributes over a table of stored pages, and routing of each record to one output row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import html as H
from shelfmark.functions.bitmap import likely_in
from shelfmark.functions.text import (
    absolute_url, brand_and_title, empty_to_null, or_not_available, path_without_query, price_text, utc_iso_stamp,
)
from shelfmark.schema import NOT_AVAILABLE, SCRAPED_COLUMNS

# The site prefix written to results and the text of a blocked page.
SITE = "https://www.amazon.ae/"
BLOCKED = "Blocked by anti-bot"

FIELDS = ["page_title", "page_description", "page_price", "page_image", "page_barcode"]


def latest_pages(pages: DataFrame, wanted: DataFrame | None = None, parse: Callable[[DataFrame], DataFrame] = lambda p: p) -> DataFrame:
    """One page per URL, the highest ``page_id``, as ``parse`` returns it (``url`` and ``page_id`` kept); ``wanted`` limits the URLs.

    The choice is made on ``url, page_id`` alone, with a partial aggregate. Pages are parsed where they are
    read, before the join with the choice, so that only parsed fields are shuffled and no HTML.
    """
    keys = pages.select("url", "page_id")
    if wanted is not None:
        keys = keys.join(wanted, "url", "left_semi")
    chosen = keys.groupBy("url").agg(F.max("page_id").alias("page_id"))
    page = F.xxhash64("url", F.col("page_id").cast("string"))
    # not a semi join, which the optimizer would move below the parsing
    return parse(likely_in(pages, page, chosen, page)).join(chosen, ["url", "page_id"])


def page_fields(pages: DataFrame, fallback_h1: bool = False) -> DataFrame:
    """Add ``unusable`` and the five extracted fields (null when absent); the HTML is dropped."""
    live = pages.withColumn("__markup", F.expr(H.visible_markup("html"))).drop("html")
    fields = {
        "unusable": H.is_unusable("__markup"),
        "page_title": H.title("__markup", fallback_h1),
        "page_description": H.description("__markup"),
        "page_price": H.price("__markup"),
        "page_image": H.image("__markup"),
        "page_barcode": H.barcode("__markup"),
    }
    return live.withColumns({name: F.expr(sql) for name, sql in fields.items()}).drop("__markup")


def needs_page() -> Column:
    """Records with a URL and a status that does not say otherwise."""
    has_url = F.coalesce(F.col("matched_url"), F.lit("")) != ""
    return has_url & ~F.coalesce(F.col("status"), F.lit(NOT_AVAILABLE)).contains(NOT_AVAILABLE)


def all_empty() -> Column:
    """No title, description or price: the earlier variant counts such a page as unavailable."""
    return F.coalesce(*[empty_to_null(F.col(c)) for c in FIELDS[:3]]).isNull()


def _look_up(rows: DataFrame, url: str, wanted: Column, spread: str, found: DataFrame) -> DataFrame:
    """Left join on a URL that many rows do not have.

    ``found`` has one row per ``__url``. Rows that are not ``wanted`` are keyed by ``spread``, so a
    shared "no match" text does not gather them in one partition; the flag keeps them unmatched.
    """
    keyed = rows.withColumn("__look", wanted).withColumn(
        "__url", F.when(F.col("__look"), F.col(url)).otherwise(F.col(spread).cast("string"))
    )
    right = found.withColumns({"__look": F.lit(True), "__found": F.lit(True)})
    return keyed.join(right, ["__look", "__url"], "left").drop("__url")


def _pages_for(rows: DataFrame, url: str, pages: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The latest stored page of each URL that ``rows`` mention, parsed."""
    return latest_pages(pages.select("url", "page_id", "html"), rows.select(F.col(url).alias("url")).distinct(), parse)


def route(matches: DataFrame, pages: DataFrame, fallback_h1: bool = False, check_empty: bool = False) -> DataFrame:
    """Each record with its page's fields and an ``outcome``.

    Pages are cut to the wanted URLs and parsed once each before the join.
    """
    parsed = _pages_for(matches.filter(needs_page()), "matched_url", pages, lambda p: page_fields(p, fallback_h1))
    fields = parsed.select(F.col("url").alias("__url"), "unusable", *FIELDS)
    joined = _look_up(matches, "matched_url", needs_page(), "id", fields)
    outcome = F.when(~F.col("__look"), "no match").when(F.col("__found").isNull(), "missing page")
    outcome = outcome.when(F.col("unusable"), "unusable page")
    if check_empty:
        outcome = outcome.when(all_empty(), "empty page")
    return joined.withColumn("outcome", outcome.otherwise("parsed")).drop("__look", "__found")


def scraped_products(routed: DataFrame, as_of: str, site: str = SITE, clean_price: bool = False) -> DataFrame:
    """Routed records as output rows, sentinels filled, plus ``outcome`` and the record's own id as text, ``record_id``.

    ``Scrape_ID`` is that id as a number; it is null for other ids and does not identify a record.
    """
    ok = F.col("outcome") == "parsed"
    page_price = price_text(F.col("page_price")) if clean_price else F.col("page_price")
    value = lambda c: or_not_available(F.when(ok, c))
    blocked = F.when(F.col("outcome") == "unusable page", BLOCKED)
    return routed.select(
        F.col("id").try_cast("bigint").alias("Scrape_ID"),
        F.col("serial_number").alias("Serial_Number"),
        value(F.col("page_title")).alias("Product_Name"),
        F.col("input_title").alias("Matched_Product_Name"),
        F.coalesce(blocked, value(F.col("page_description"))).alias("Description"),
        value(page_price).alias("Price_AED"),
        value(F.col("page_image")).alias("Image_URL"),
        value(F.col("page_barcode")).alias("Barcode"),
        or_not_available(F.col("matched_url")).alias("Source_URL"),
        F.lit(site).alias("Source_Website"),
        utc_iso_stamp(as_of).alias("Last_Updated"),
        "outcome",
        F.col("id").cast("string").alias("record_id"),
    ).select(*SCRAPED_COLUMNS, "outcome", "record_id")


def search_results(pages: DataFrame, key: str, site: str = SITE, early: bool = False) -> DataFrame:
    """Result pages to long rows ``key, position, url, title`` in page order.

    The earlier variant uses looser selectors and drops the query string of site links.
    """
    live = pages.select(key, F.expr(H.visible_markup("html")).alias("__markup"))
    rows = live.select(key, F.posexplode(F.expr(H.result_blocks("__markup", early))).alias("position", "r"))
    if early:
        url = path_without_query(F.col("r.href"), site)
    else:
        url = absolute_url(F.col("r.href"), site)
    title = brand_and_title(F.col("r.brand"), F.col("r.title"))
    return rows.select(key, "position", url.alias("url"), title.alias("title"))


def titles_from_pages(candidates: DataFrame, pages: DataFrame, key: str = "id") -> DataFrame:
    """Candidate rows titled by the heading of their own page, else the sentinel."""
    known = ~F.coalesce(F.col("url"), F.lit("")).isin("", NOT_AVAILABLE)
    markup = lambda p: p.select("url", "page_id", F.expr(H.visible_markup("html")).alias("__markup"))
    heading = lambda p: markup(p).select("url", "page_id", F.expr(H.search_heading("__markup")).alias("__title"))
    heads = _pages_for(candidates.filter(known), "url", pages, heading).select(F.col("url").alias("__url"), "__title")
    joined = _look_up(candidates.drop("title"), "url", known, key, heads)
    return joined.withColumn("title", or_not_available(F.col("__title"))).drop("__title", "__look", "__found")
