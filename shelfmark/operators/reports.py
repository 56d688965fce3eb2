"""The data-quality reports over the master table, and coverage counts over matches and pages.

Five reports come from one small aggregate by packaging and supplier, three from one aggregate
by serial number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import local_stamp, null_or_blank
from shelfmark.schema import AVAILABLE, NOT_AVAILABLE
from shelfmark.session import ensure_checkpoint_dir

# Unit texts that count as one unit, and the report texts.
NO_UNITS = ["N/A", "", "0", "NULL"]
REPORTS = {
    "Total number of products": "SELECT COUNT(*) AS total_products FROM products",
    "Number of CTN vs NON-CTN products":
        "SELECT Packaging_Type, COUNT(*) AS count FROM products GROUP BY Packaging_Type",
    "Total units available":
        "SELECT SUM(CASE WHEN Packaging_Type = 'CTN' AND Units_Per_Carton NOT IN ('N/A', '', '0', 'NULL')"
        " THEN CAST(Units_Per_Carton AS INTEGER) ELSE 1 END) AS total_units FROM products",
    "Duplicate Serial_Numbers":
        "SELECT Serial_Number, COUNT(*) AS count FROM products GROUP BY Serial_Number HAVING COUNT(*) > 1",
    "Missing Serial_Numbers":
        "SELECT COUNT(*) AS missing_serials FROM products"
        " WHERE Serial_Number IS NULL OR TRIM(Serial_Number) = ''",
    "Supplier-wise product counts":
        "SELECT Supplier, COUNT(*) AS total_products FROM products GROUP BY Supplier"
        " ORDER BY total_products DESC",
    "Products appearing in multiple catalogs":
        "SELECT Serial_Number, COUNT(DISTINCT Supplier) AS supplier_count FROM products"
        " GROUP BY Serial_Number HAVING supplier_count > 1",
    "Unique products (only in one catalog)":
        "SELECT COUNT(*) AS unique_products FROM (SELECT Serial_Number FROM products"
        " GROUP BY Serial_Number HAVING COUNT(DISTINCT Supplier) = 1)",
}


def counted_units() -> Column:
    """Units of one row: the integer prefix of a carton's units (0 for junk), else 1."""
    units = F.col("Units_Per_Carton").cast("string")
    prefix = F.regexp_extract(units, r"^\s*([+-]?\d+)", 1).try_cast("bigint")
    is_carton = (F.col("Packaging_Type") == "CTN") & ~units.isin(NO_UNITS)
    return F.when(is_carton, F.coalesce(prefix, F.lit(0).cast("bigint"))).otherwise(F.lit(1).cast("bigint"))


def group_summary(products: DataFrame) -> DataFrame:
    """Rows, units and missing serials by packaging and supplier."""
    return products.groupBy("Packaging_Type", "Supplier").agg(
        F.count("*").alias("rows"),
        F.sum(counted_units()).alias("units"),
        F.count_if(null_or_blank(F.col("Serial_Number"))).alias("missing"),
    )


def serial_summary(products: DataFrame) -> DataFrame:
    """Rows and distinct suppliers by serial number."""
    by_supplier = products.groupBy("Serial_Number", "Supplier").agg(F.count("*").alias("rows"))
    return by_supplier.groupBy("Serial_Number").agg(
        F.sum("rows").alias("count"), F.count("Supplier").alias("supplier_count")
    )


def total_products(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_products"))


def by_packaging(summary: DataFrame) -> DataFrame:
    return summary.groupBy("Packaging_Type").agg(F.sum("rows").alias("count"))


def total_units(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("units").alias("total_units"))


def duplicate_serials(serials: DataFrame) -> DataFrame:
    return serials.filter("count > 1").select("Serial_Number", "count")


def missing_serials(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_serials"))


def by_supplier(summary: DataFrame) -> DataFrame:
    totals = summary.groupBy("Supplier").agg(F.sum("rows").alias("total_products"))
    return totals.orderBy(F.desc("total_products"), "Supplier")


def in_several_catalogs(serials: DataFrame) -> DataFrame:
    return serials.filter("supplier_count > 1").select("Serial_Number", "supplier_count")


def only_in_one_catalog(serials: DataFrame) -> DataFrame:
    return serials.filter("supplier_count = 1").agg(F.count("*").alias("unique_products"))


def report_tables(products: DataFrame, share: bool = False) -> dict[str, DataFrame]:
    """All eight result tables, complete, by report description.

    ``share`` writes the two aggregates to the checkpoint folder, so that reading every report
    still scans the master table only twice.
    """
    summary, serials = group_summary(products), serial_summary(products)
    if share:
        ensure_checkpoint_dir(products.sparkSession)
        summary, serials = summary.checkpoint(), serials.checkpoint()
    tables = [
        total_products(summary), by_packaging(summary), total_units(summary),
        duplicate_serials(serials), missing_serials(summary), by_supplier(summary),
        in_several_catalogs(serials), only_in_one_catalog(serials),
    ]
    return dict(zip(REPORTS, tables))


def report(products: DataFrame, as_of: str) -> DataFrame:
    """Every row of every report: description, query text, the row as JSON, run stamp.

    Reports that grow with the data are complete and stay rows, so the shape is the same at every size.
    """
    rows = [
        table.select(
            F.lit(text).alias("Query_Description"),
            F.lit(REPORTS[text]).alias("Query"),
            F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}).alias("Result"),
            local_stamp(as_of).alias("Generated_At"),
        )
        for text, table in report_tables(products, share=True).items()
    ]
    return reduce(DataFrame.unionByName, rows)


def match_coverage(matches: DataFrame) -> DataFrame:
    state = F.when(F.col("status") == AVAILABLE, "Matched").otherwise("Not Matched")
    return matches.groupBy(state.alias("Match_Status")).agg(F.count("*").alias("Count"))


def field_coverage(scraped: DataFrame, field: str, label: str, known_only: bool = False) -> DataFrame:
    """Available and missing counts of one output field, or the available count alone."""
    known = F.coalesce(~F.col(field).isin("", NOT_AVAILABLE), F.lit(False))
    if known_only:
        scraped = scraped.filter(known)
    state = F.when(known, "Available").otherwise("Missing")
    return scraped.groupBy(state.alias(label)).agg(F.count("*").alias("Count"))


def barcode_coverage(scraped: DataFrame) -> DataFrame:
    return field_coverage(scraped, "Barcode", "Barcode_Status")


def image_coverage(scraped: DataFrame) -> DataFrame:
    return field_coverage(scraped, "Image_URL", "Image_Status", known_only=True)
