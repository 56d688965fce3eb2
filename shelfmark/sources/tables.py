"""Table reads and writes. Every write is one job commit per batch, never per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.schema import CLEAN_COLUMNS, MASTER_COLUMNS, REPORT_COLUMNS, SCRAPED_COLUMNS, require


def write_catalog(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    require(df.columns, CLEAN_COLUMNS, "catalog")
    writer = df.select(*CLEAN_COLUMNS).write.mode("overwrite")
    writer.csv(path, header=True, escape='"') if fmt == "csv" else writer.format(fmt).save(path)


def load_master(df: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Replace the master table; a missing column or a repeated Product_ID is an error."""
    require(df.columns, MASTER_COLUMNS, "master table")
    rows = df.select(*MASTER_COLUMNS)
    repeated = rows.groupBy("Product_ID").count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError("master table: Product_ID is not unique")
    writer = rows.write.mode("overwrite").format("parquet")
    writer.saveAsTable(table) if table else writer.save(path)


def write_augmented(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_results(df: DataFrame, path: str, batch_id: str) -> None:
    """Append one batch under its own folder; writing the same batch again replaces it. Keeps ``record_id`` where there is one."""
    require(df.columns, SCRAPED_COLUMNS, "scraped products")
    df.select(*SCRAPED_COLUMNS, *(c for c in ["record_id"] if c in df.columns)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_csv(df: DataFrame, path: str, batch_id: str) -> None:
    """The same batch as CSV with a header per file and the published price heading."""
    rows = df.select(*SCRAPED_COLUMNS).withColumnRenamed("Price_AED", "Price (AED)")
    rows.write.mode("overwrite").csv(f"{path}/batch_id={batch_id}", header=True, escape='"')


def write_report(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    rows = df.select(*REPORT_COLUMNS)
    rows.write.mode("overwrite").parquet(path)
    if csv_path:
        df.sparkSession.read.parquet(path).write.mode("overwrite").csv(csv_path, header=True, escape='"')


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet table that may not exist yet: then an empty one with the given schema."""
    from shelfmark.sources.catalogs import path_exists

    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
