"""Supplier catalogs: one header CSV per supplier, read as text and brought to common columns."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import null_token_to_null, strip
from shelfmark.sources.splits import before, gather, last_before, pieces

log = logging.getLogger(__name__)

# Supplier header names and the column each one means.
COLUMN_NAMES = {
    "Item Name": "Product_Name",
    "PRODUCT TITLE": "Product_Name",
    "Name": "Product_Name",
    "SERIAL NUMBER": "Serial_Number",
    "SL NO": "Serial_Number",
}

# Input order within one source; the source itself is ranked by the caller.
ORDER_COLUMNS = ["source_rank", "file_name", "block_start", "row_seq"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    matches = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return matches is not None and len(matches) > 0


# One value, from a line's start or a comma on: quoted up to a quote before a comma or the line's end, or unquoted.
_QUOTED = r'(?:[^"]++|""|"(?!,|\z))*+"(?=,|\z)'
_VALUE = rf'(?:"{_QUOTED}|[^",][^,]*+|)'
_REST = rf"(?:,{_VALUE})*+\z"


def _ends_outside(line: Column) -> Column:
    """Does a line that starts outside of quotes end outside? An inch mark inside an unquoted value opens nothing."""
    return ~F.contains(line, F.lit('"')) | line.rlike(rf"(?s)^{_VALUE}{_REST}")


def _closes(line: Column) -> Column:
    """Does a line that starts inside quotes end outside?"""
    return F.contains(line, F.lit('"')) & line.rlike(rf"(?s)^{_QUOTED}{_REST}")


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted value may go over a line's end: a line leaves one open."""
    return not spark.read.text(path).filter(~_ends_outside(F.col("value"))).isEmpty()


def _whole_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV text that may hold line breaks inside quotes, as ``gather`` gives them; splits are read in parallel.

    A line turns the state at its start (inside quotes or not) into the state at its end: it keeps it, turns it, or ends in one
    state whatever it was. So the state is that of the last line of the third kind before, turned by the turning lines since."""
    lines = pieces(spark, path)
    outside, inside = ~_ends_outside(F.col("raw")), ~_closes(F.col("raw"))  # is it inside quotes at the end, by how it began?
    lines = lines.withColumn("__from_outside", outside.cast("int")).withColumn("__from_inside", inside.cast("int"))
    fixed = F.col("__from_outside") == F.col("__from_inside")
    turns = (F.col("__from_outside") > F.col("__from_inside")).cast("long")
    lines = before(lines, turns, "__turned")
    # the last fixing line, and the turns before it
    order = [F.col("block_start"), F.col("row_seq")]
    mark = F.when(fixed, F.struct(*order, F.col("__from_outside").alias("state"), F.col("__turned").alias("turned")))
    lines = last_before(lines, mark, "__fix")
    state = F.coalesce(F.col("__fix.state"), F.lit(0)) + F.col("__turned") - F.coalesce(F.col("__fix.turned"), F.lit(0))
    ends_inside = F.when(state % 2 == 1, F.col("__from_inside")).otherwise(F.col("__from_outside"))
    return gather(lines.select("file_name", "block_start", "row_seq", "raw", (ends_inside == 0).alias("__ends")), F.col("__ends"), "\n")


def read_catalog(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """All columns as strings, null tokens as nulls, plus the row's place in the input.

    Files are read in splits. Where a value holds a line break inside quotes, the lines of each record are put together first;
    whether there are such is looked up in one distributed scan unless ``multi_line`` states it.
    """
    if multi_line is None:
        multi_line = has_quoted_breaks(spark, path)
    options = {"header": True, "inferSchema": False, "escape": '"'}
    raw = spark.read.csv(path, **options)
    places = [F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("row_seq")]
    names = raw.columns
    if multi_line:
        # each file's first record is its header
        records = _whole_records(spark, path).filter("record > 0").filter(strip(F.col("text")) != "")
        schema = ", ".join(f"`_{i}` string" for i in range(len(names)))
        raw = records.withColumn("__r", F.from_csv("text", schema, {"escape": '"'}))
        raw = raw.select(*[F.col(f"__r._{i}").alias(name) for i, name in enumerate(names)], *ORDER_COLUMNS[1:])
        places = ORDER_COLUMNS[1:]
    values = [null_token_to_null(F.col(f"`{name}`")).alias(name) for name in names]
    return raw.select(*values, *places)


def normalize_null_tokens(df: DataFrame) -> DataFrame:
    return df.select(*[
        null_token_to_null(F.col(f"`{name}`")).alias(name) if kind == "string" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def standardize_columns(df: DataFrame, supplier: str) -> DataFrame:
    """Rename known headers, tag the supplier; a catalog without product names is an error."""
    df = df.withColumnsRenamed({old: new for old, new in COLUMN_NAMES.items() if old in df.columns})
    if "Product_Name" not in df.columns:
        raise ValueError(f"product name column missing in the catalog of {supplier}")
    if "Serial_Number" not in df.columns:
        df = df.withColumn("Serial_Number", F.lit(None).cast("string"))
    return df.withColumn("Supplier", F.lit(supplier))


def read_catalogs(spark: SparkSession, paths: dict[str, str], multi_line: bool | None = None) -> dict[str, DataFrame]:
    """One DataFrame per supplier, in the given order; missing files are skipped with a warning."""
    catalogs = {}
    for supplier, path in paths.items():
        if not path_exists(spark, path):
            log.warning("catalog of %s not found: %s", supplier, path)
            continue
        catalogs[supplier] = read_catalog(spark, path, multi_line)
    return catalogs
