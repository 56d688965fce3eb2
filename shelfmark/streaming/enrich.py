"""The resumable page stage as a stream: new match files are picked up once each.

The stream's own checkpoint replaces the processed flag. Each micro-batch writes under its batch
number and replaces what an interrupted attempt left there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.pages import SITE
from shelfmark.plans.enrich import run_batch
from shelfmark.schema import MATCH_COLUMNS

MATCH_SCHEMA = ", ".join(f"{name} string" for name in MATCH_COLUMNS)


def start_enrichment(
    spark: SparkSession, matches_path: str, pages_path: str, out: str, state: str, as_of: str,
    site: str = SITE, files_per_batch: int = 100,
) -> StreamingQuery:
    """Process every match file not seen yet, then stop; ``state`` is the stream checkpoint folder."""
    matches = (
        spark.readStream.schema(MATCH_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(matches_path)
    )

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run_batch(spark, batch.dropDuplicates(["id"]), spark.read.parquet(pages_path), out, f"stream-{number:08d}", as_of, site)

    return (
        matches.writeStream.foreachBatch(handle)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
