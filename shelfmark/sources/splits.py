"""Records that cross line ends, put together from file splits read in parallel.

A file is read as short pieces (lines, or text up to a separator). What a piece means depends on the state in which the pieces
before it leave off: inside quotes or not, how many braces are open. Such states are prefix sums. They are taken inside each split
by a window and over the splits of a file by a second, small one, so no file is read by one task. ``pieces`` gives the order;
``gather`` joins the pieces of each record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["file_name", "block_start"]


def pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """file_name, file_size, block_start, row_seq (the order of pieces) and raw, without the separator (a line's end if none is given)."""
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_seq"), F.col("value").alias("raw"),
    )


def before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the pieces before, in the same file.

    The sums of whole splits are one row each; adaptive execution broadcasts them where they are few."""
    totals = rows.groupBy(*_SPLIT).agg(F.sum(value).alias("__total"))
    earlier = Window.partitionBy("file_name").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*_SPLIT, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__earlier"))
    inside = Window.partitionBy(*_SPLIT).orderBy("row_seq").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("__own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(totals, _SPLIT).withColumn(name, F.col("__own") + F.col("__earlier")).drop("__own", "__earlier")


def last_before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with the last ``value`` that is not null among the pieces before, in the same file. ``value`` begins with its place."""
    totals = rows.groupBy(*_SPLIT).agg(F.max(value).alias("__last"))
    earlier = Window.partitionBy("file_name").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*_SPLIT, F.max("__last").over(earlier).alias("__earlier"))
    inside = Window.partitionBy(*_SPLIT).orderBy("row_seq").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("__own", F.max(value).over(inside))
    return own.join(totals, _SPLIT).withColumn(name, F.coalesce("__own", "__earlier")).drop("__own", "__earlier")


def gather(rows: DataFrame, is_last: Column, separator: str) -> DataFrame:
    """One row per record: its number in the file, its first piece's place and its text. ``is_last`` tells a record's last piece.

    The last record of a file is the one whose pieces end without such a piece (``complete`` is false); its text may be empty."""
    numbered = before(rows.withColumn("__last", is_last), F.col("__last").cast("long"), "record")
    part = F.struct("block_start", "row_seq", "raw")
    joined = numbered.groupBy("file_name", "record").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.bool_or("__last").alias("complete"))
    first = F.col("parts")[0]
    joined = joined.sortWithinPartitions("file_name", "record")  # files in order where they are not spread over partitions
    return joined.select(
        "file_name", first["block_start"].alias("block_start"), first["row_seq"].alias("row_seq"), "record", "complete",
        F.array_join(F.transform("parts", lambda p: p["raw"]), separator).alias("text"),
    )
