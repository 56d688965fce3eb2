"""Extraction, union, keep-first dedup and dense product IDs."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.packs import (
    FINAL_RULES, packaging_from_unit, packaging_type, units_per_carton, weight_quantity,
)
from shelfmark.functions.text import local_stamp
from shelfmark.schema import CLEAN_COLUMNS, MASTER_COLUMNS, require
from shelfmark.session import ensure_checkpoint_dir
from shelfmark.sources.catalogs import ORDER_COLUMNS, standardize_columns


def extract_features(df: DataFrame, weight=weight_quantity, rules: list[str] = FINAL_RULES) -> DataFrame:
    """Add weight, units and packaging; columns of those names in the input are replaced."""
    name = "Product_Name"
    return df.withColumns({
        "Weight_Quantity": weight(name),
        "Units_Per_Carton": units_per_carton(name, rules),
        "Packaging_Type": packaging_type(name),
    })


def union_sources(catalogs: dict[str, DataFrame], unit_suppliers: tuple[str, ...] = ()) -> DataFrame:
    """Standardize and concatenate the catalogs in the order given, then extract.

    For ``unit_suppliers`` a ``Unit`` column, where there is one, decides the packaging.
    """
    parts = []
    for rank, (supplier, df) in enumerate(catalogs.items()):
        if "row_seq" not in df.columns:
            raise ValueError(f"catalog of {supplier} has no row_seq to keep its input order")
        ready = standardize_columns(df, supplier)
        by_unit = supplier in unit_suppliers and "Unit" in ready.columns
        parts.append(ready.select(
            "Product_Name", "Serial_Number", "Supplier",
            F.lit(rank).alias("source_rank"),
            F.col("file_name") if "file_name" in df.columns else F.lit("").alias("file_name"),
            F.col("block_start") if "block_start" in df.columns else F.lit(0).cast("bigint").alias("block_start"),
            "row_seq",
            (packaging_from_unit(F.col("Unit")) if by_unit else F.lit(None).cast("string")).alias("__by_unit"),
        ))
    rows = extract_features(reduce(DataFrame.unionByName, parts))
    packaging = F.coalesce("__by_unit", "Packaging_Type")
    return rows.withColumn("Packaging_Type", packaging).select(*CLEAN_COLUMNS[1:], *ORDER_COLUMNS)


def first_per_key(df: DataFrame, keys: list[str], order: list, n: int = 1, rank_name: str | None = None) -> DataFrame:
    """First ``n`` rows per key in a total order; nulls are one key.

    Spark limits each map task to ``n`` rows per key before the shuffle, so a hot key sends at
    most ``n`` rows per task.
    """
    name = rank_name or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank_name else kept.drop(name)


def dedup_keep_first(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["Product_Name", "Supplier"], ORDER_COLUMNS)


def with_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 1..n in the given total order without a single-task sort.

    Rows are range-partitioned and sorted, then written to the shared checkpoint folder: that
    fixes which row sits where, so a lost executor cannot renumber. The driver sums one row count
    per partition; the sums are a table of as many rows, which is broadcast.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    numbered = placed.select(
        "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")
    )
    counts = sorted((r["__part"], r["n"]) for r in numbered.groupBy("__part").agg(F.count("*").alias("n")).collect())
    before = accumulate((n for _, n in counts), initial=0)
    starts = [(part, total) for (part, _), total in zip(counts, before, strict=False)]
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "__part int, __before long"))
    # The low 33 bits of the increasing id count the rows of one partition.
    number = F.expr(f"__before + (__at & {(1 << 33) - 1}L) + 1")
    return numbered.join(offsets, "__part").withColumn(name, number).drop("__part", "__at", "__before")


def with_dense_ids(df: DataFrame, order: list[str], name: str = "Product_ID", prefix: str = "product_") -> DataFrame:
    numbered = with_row_number(df, order, name)
    return numbered.withColumn(name, F.concat(F.lit(prefix), F.col(name).cast("string")))


def consolidate(catalogs: dict[str, DataFrame], unit_suppliers: tuple[str, ...] = ()) -> DataFrame:
    """Catalogs to the cleaned product table."""
    rows = dedup_keep_first(union_sources(catalogs, unit_suppliers))
    return with_dense_ids(rows, ORDER_COLUMNS).select(*CLEAN_COLUMNS)


def preview(clean: DataFrame, n: int = 10) -> DataFrame:
    """First products by number, as a top-n rather than a full sort."""
    number = F.substring_index("Product_ID", "_", -1).cast("bigint")
    return clean.orderBy(number).limit(n)


def to_master(clean: DataFrame, as_of: str) -> DataFrame:
    """Add lineage and load stamp, in the master column order."""
    source = F.col("Supplier") if "Supplier" in clean.columns else F.lit("Unknown")
    stamped = clean.withColumns({"Source_File": source, "Last_Updated": local_stamp(as_of)})
    require(stamped.columns, MASTER_COLUMNS, "master table")
    return stamped.select(*MASTER_COLUMNS)
