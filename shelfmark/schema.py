"""Column lists of the tables that pass between the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the published tables.
CLEAN_COLUMNS = [
    "Product_ID", "Product_Name", "Serial_Number", "Supplier",
    "Weight_Quantity", "Packaging_Type", "Units_Per_Carton",
]
MASTER_COLUMNS = CLEAN_COLUMNS + ["Source_File", "Last_Updated"]
MATCH_COLUMNS = ["id", "serial_number", "input_title", "matched_url", "status"]
SCRAPED_COLUMNS = [
    "Scrape_ID", "Serial_Number", "Product_Name", "Matched_Product_Name", "Description",
    "Price_AED", "Image_URL", "Barcode", "Source_URL", "Source_Website", "Last_Updated",
]
REPORT_COLUMNS = ["Query_Description", "Query", "Result", "Generated_At"]
CANDIDATE_RANKS = [1, 2, 3, 4, 5]

NOT_AVAILABLE = "Not Available"
AVAILABLE = "Available"
NO_MATCH_URL = "Not available everywhere"

WIDE_CANDIDATE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "serial_number", "input_title")]
    + [
        T.StructField(name, T.StringType())
        for rank in CANDIDATE_RANKS
        for name in (f"url_{rank}", f"url_{rank}_title")
    ]
    + [T.StructField("scraped_date", T.StringType())]
)


def require(columns: list[str], needed: list[str], where: str) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"{where}: missing column(s) {', '.join(missing)}")
