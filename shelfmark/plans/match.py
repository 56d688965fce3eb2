"""Records to candidates to match table.

The job writes each batch under its own folder and its search ledger last, so a run that stops in between repeats the batch
and replaces its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.bitmap import likely_in
from shelfmark.functions.text import normalize_key, or_not_available, strip
from shelfmark.operators.candidates import collect_candidates, long_to_wide, retrieve, top_candidates
from shelfmark.operators.consolidate import first_per_key
from shelfmark.operators.matching import THRESHOLD, augment, match_records, match_summary
from shelfmark.operators.pages import SITE, search_results
from shelfmark.operators.state import drop_blank_keys, ledger_entries, not_done, search_outcomes
from shelfmark.schema import CANDIDATE_RANKS, MATCH_COLUMNS
from shelfmark.sources.tables import read_table, write_augmented

SEARCH_LEDGER = "serial_number string, outcome string, as_of string, batch_id string"


def pending_records(products: DataFrame, ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Products as match records, blank serials dropped, those already searched left out."""
    records = products.select(
        normalize_key(F.col("Serial_Number")).alias("serial_number"),
        normalize_key(F.col("Product_Name")).alias("input_title"),
    )
    return not_done(drop_blank_keys(records, "serial_number"), ledger, "serial_number", retry_failed)


def match_from_results(records: DataFrame, result_pages: DataFrame, site: str = SITE) -> DataFrame:
    """Match records against stored result pages ``id, html``: first five results, best one chosen."""
    found = top_candidates(search_results(result_pages, "id", site), "id", ["position"])
    matched = match_records(collect_candidates(records, found.select("id", "rank", "url", "title")))
    return matched.withColumn("input_title", strip(F.col("input_title"))).select(*MATCH_COLUMNS)


def match_from_catalog(records: DataFrame, catalog: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Match records ``id, serial_number, input_title`` against a catalog table ``key, url, title``.

    One row per record, also where ids repeat: the search is made once per title."""
    titles = records.select(F.col("input_title").alias("id"), F.col("input_title").alias("title")).distinct()
    best = retrieve(titles, catalog, threshold, top=1).select(
        F.col("id").alias("input_title"), F.col("url").alias("best_url"), F.col("similarity").alias("best_similarity")
    )
    return match_summary(records, best, threshold=threshold, on="input_title")


def run_match(
    spark: SparkSession, products: DataFrame, result_pages: DataFrame, out: str, batch_id: str, as_of: str,
    site: str = SITE, retry_failed: bool = False,
) -> None:
    """Match the products not searched yet against their result pages ``id`` (the serial), ``html``; running again adds nothing.

    Writes candidates, the scored records as JSON, the match table and the search ledger. A product is known by its serial; of
    several with one serial the lowest title stands. A serial without a result page is recorded as failed and keeps its
    row, unmatched; ``retry_failed`` takes failed ones up again.
    """
    at = lambda table: f"{out}/{table}/batch_id={batch_id}"

    def written(df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(at(table))
        return spark.read.schema(df.schema).parquet(at(table))

    # a repeat of this very batch must see the same work again
    earlier = read_table(spark, f"{out}/search_ledger", SEARCH_LEDGER).filter(F.col("batch_id") != batch_id)
    pending = first_per_key(pending_records(products, earlier, retry_failed), ["serial_number"], ["input_title"])
    records = written(pending.withColumn("id", F.col("serial_number")), "search_records")

    # pages are cut to the batch and parsed where they are read; only results are shuffled
    key = F.xxhash64(F.col("id").cast("string"))
    pages = likely_in(result_pages.select(F.col("id").cast("string").alias("id"), "html"), key, records, key)
    results = search_results(pages, "id", site).join(records.select("id"), "id")
    found = written(top_candidates(results, "id", ["position", "url", "title"]).select("id", "rank", "url", "title"), "candidates")

    slots = [f"url_{r}{end}" for r in CANDIDATE_RANKS for end in ("", "_title")]
    wide = records.join(long_to_wide(found), "id", "left").withColumns({c: or_not_available(F.col(c)) for c in slots})
    write_augmented(augment(wide.withColumn("scraped_date", F.lit(as_of))), at("augmented"))
    matched = match_records(collect_candidates(records, found)).withColumn("input_title", strip(F.col("input_title")))
    matched.select(*MATCH_COLUMNS).write.mode("overwrite").parquet(at("matches"))

    searched = result_pages.select(F.col("id").cast("string").alias("serial_number")).distinct()
    outcomes = search_outcomes(records.select("serial_number"), searched, "serial_number")
    ledger_entries(outcomes, "serial_number", as_of).write.mode("overwrite").parquet(at("search_ledger"))
