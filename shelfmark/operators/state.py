"""Incremental state: pending rows, upserts, ledgers and outcomes over append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_or_blank
from shelfmark.operators.consolidate import first_per_key
from shelfmark.schema import AVAILABLE, NOT_AVAILABLE


def with_flag(df: DataFrame, name: str = "scraped") -> DataFrame:
    """Add the processed flag with default 0 where the table does not have it yet."""
    return df if name in df.columns else df.withColumn(name, F.lit(0))


def is_pending(flag: str = "scraped"):
    return F.coalesce(F.col(flag), F.lit(0)) == 0


def is_available(status: str = "status"):
    return F.col(status).isin(AVAILABLE, AVAILABLE.lower())


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(~null_or_blank(F.col(key)))


def not_done(df: DataFrame, ledger: DataFrame, key: str, retry_failed: bool = False) -> DataFrame:
    """Rows whose key is not in the ledger; with ``retry_failed`` failed keys come back."""
    done = ledger.filter(F.col("outcome") != "failed") if retry_failed else ledger
    return df.join(done.select(key).distinct(), key, "left_anti")


def upsert_last(old: DataFrame, new: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The new side replaces the old, whatever its version; within a side the newest version wins."""
    sides = old.withColumn("__side", F.lit(0)).unionByName(
        new.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col(v).desc() for v in ["__side", *version]]
    return first_per_key(sides, keys, order).drop("__side")


def upsert_first(old: DataFrame, new: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """A key that exists keeps its row; new keys take their first version."""
    sides = old.withColumn("__side", F.lit(0)).unionByName(
        new.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(sides, keys, ["__side", *version]).drop("__side")


def ledger_entries(processed: DataFrame, key: str, as_of: str) -> DataFrame:
    """One ledger row per processed key, for appending after the results are written."""
    outcome = F.col("outcome") if "outcome" in processed.columns else F.lit("done")
    return processed.select(key, outcome.alias("outcome")).distinct().withColumn("as_of", F.lit(as_of))


def mark_processed(df: DataFrame, ledger: DataFrame, key: str, flag: str = "scraped") -> DataFrame:
    """The work table with its flag set for keys in the ledger, as a new snapshot."""
    done = ledger.select(F.col(key), F.lit(1).alias("__done")).distinct()
    marked = with_flag(df, flag).join(done, key, "left")
    return marked.withColumn(flag, F.coalesce("__done", F.coalesce(F.col(flag), F.lit(0)))).drop("__done")


def downgrade_failed(matches: DataFrame, outcomes: DataFrame, key: str = "id") -> DataFrame:
    """Records whose page failed become unavailable and processed; parsed ones only processed."""
    failed = F.max(F.when(F.col("outcome") == "parsed", 0).otherwise(1))
    latest = outcomes.groupBy(key).agg(failed.alias("__failed"))
    joined = with_flag(matches).join(latest, key, "left")
    return joined.withColumns({
        "status": F.when(F.col("__failed") == 1, NOT_AVAILABLE).otherwise(F.col("status")),
        "scraped": F.when(F.col("__failed").isNotNull(), 1).otherwise(F.coalesce("scraped", F.lit(0))),
    }).drop("__failed")


def search_outcomes(records: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Every searched record with its outcome: ``found`` holds the keys that gave a result page."""
    hits = found.select(key, F.lit("done").alias("outcome")).distinct()
    joined = records.join(hits, key, "left")
    return joined.withColumn("outcome", F.coalesce("outcome", F.lit("failed")))
