"""Supplier files to master table to reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.consolidate import consolidate, to_master
from shelfmark.operators.reports import report
from shelfmark.sources.catalogs import read_catalogs
from shelfmark.sources.tables import load_master, write_catalog, write_report


def build_master(
    spark: SparkSession, paths: dict[str, str], out: str, as_of: str,
    unit_suppliers: tuple[str, ...] = (), multi_line: bool | None = None,
) -> DataFrame:
    """Read the catalogs, write ``clean``, ``master``, ``report`` and its CSV copy ``report_csv`` under ``out``, return the report."""
    catalogs = read_catalogs(spark, paths, multi_line)
    if not catalogs:
        raise ValueError("no catalog file was found")
    write_catalog(consolidate(catalogs, unit_suppliers), f"{out}/clean")
    load_master(to_master(spark.read.parquet(f"{out}/clean"), as_of), path=f"{out}/master")
    write_report(report(spark.read.parquet(f"{out}/master"), as_of), f"{out}/report", f"{out}/report_csv")
    return spark.read.parquet(f"{out}/report")
