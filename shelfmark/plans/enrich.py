"""Matched records to scraped products, resumable batch by batch.

Results are written first and the ledger second, both under the batch's own folder, so a run
that stops between the two repeats the batch and replaces its files: nothing is lost or doubled.
Records are known by their id as text, whatever it looks like; a record without an id cannot be
resumed and goes to ``rejected``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.consolidate import first_per_key
from shelfmark.operators.pages import SITE, route, scraped_products
from shelfmark.operators.state import is_pending, ledger_entries, not_done, with_flag
from shelfmark.schema import SCRAPED_COLUMNS
from shelfmark.sources.tables import append_csv, append_results, read_table

LEDGER_SCHEMA = "id string, outcome string, as_of string"


def pending_matches(matches: DataFrame, ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Rows neither flagged as processed nor in the ledger."""
    open_rows = with_flag(matches).filter(is_pending()).drop("scraped")
    return not_done(open_rows, ledger, "id", retry_failed)


def enrich(matches: DataFrame, pages: DataFrame, as_of: str, site: str = SITE, **options) -> DataFrame:
    """Output rows with outcome for every given match record."""
    return scraped_products(route(matches, pages, **options), as_of, site)


def run_batch(
    spark: SparkSession, matches: DataFrame, pages: DataFrame, out: str, batch_id: str, as_of: str,
    site: str = SITE, retry_failed: bool = False, csv: bool = False, **options,
) -> None:
    """Process what is pending and record it; running again adds nothing.

    ``csv`` also writes the batch as CSV; ``options`` are those of ``route``.
    """
    ledger = read_table(spark, f"{out}/ledger", LEDGER_SCHEMA + ", batch_id string")
    # A repeat of this very batch must see the same work again.
    earlier = ledger.filter(F.col("batch_id") != batch_id)
    matches.filter("id IS NULL").write.mode("overwrite").parquet(f"{out}/rejected/batch_id={batch_id}")
    todo = pending_matches(matches.filter("id IS NOT NULL"), earlier, retry_failed)
    write_batch(enrich(todo, pages, as_of, site, **options), out, batch_id, as_of, csv)


def write_batch(rows: DataFrame, out: str, batch_id: str, as_of: str, csv: bool = False) -> None:
    """Results, then ledger; the outcome is kept in the results so the ledger needs no recompute."""
    spark = rows.sparkSession
    staged = f"{out}/staged/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(staged)
    done = spark.read.parquet(staged)
    append_results(done, f"{out}/scraped_products", batch_id)
    if csv:
        append_csv(done, f"{out}/scraped_products_csv", batch_id)
    failed = F.when(F.col("outcome").isin("parsed", "no match"), "done").otherwise("failed")
    entries = done.select(F.col("record_id").alias("id"), failed.alias("outcome"))
    ledger_entries(entries, "id", as_of).write.mode("overwrite").parquet(f"{out}/ledger/batch_id={batch_id}")


def current_products(spark: SparkSession, out: str) -> DataFrame:
    """One row per record over all batches: the latest stamp wins."""
    rows = spark.read.parquet(f"{out}/scraped_products")
    return first_per_key(rows, ["record_id"], [F.desc("Last_Updated"), F.desc("batch_id")]).select(*SCRAPED_COLUMNS)
