"""One query per operator over the given tables, and the SQL where SQL can express a result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import chosen_path, decontaminate, hard_negatives, html_templates, line_dedup, packing, pu_quality, quality_rules, sanitise, secret_scan, sharding, substring_dedup, variants

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return keep


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op1_templates")
def op1(spark, sf_dir):
    return html_templates.extract(read(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


@query("op2_chosen_path")
def op2(spark, sf_dir):
    return chosen_path.near_duplicates(read(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


@query("op3_sanitise")
def op3(spark, sf_dir):
    found = sanitise.find(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("key").alias("doc_id"), *map(count, (*sanitise.PATTERNS, "term")),
        F.sha2(sanitise.joined(base), 256).alias("base_sha256"), sanitise.joined(F.col("spans")).alias("spans"),
    )


@query("op4_template_leaks")
def op4(spark, sf_dir):
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")


@query("op5_fixed_blocks")
def op5(spark, sf_dir):
    found = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query("op6_secret_scan")
def op6(spark, sf_dir):
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("key").alias("doc_id"), *map(count, secret_scan.KINDS),
        F.sha2(sanitise.joined(base), 256).alias("base_sha256"), sanitise.joined(F.col("spans")).alias("spans"),
    )


@query("op7_fuzzy_lines")
def op7(spark, sf_dir):
    found = line_dedup.report(read(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_lines", "n_dropped", "places")


@query("op8_best_fit")
def op8(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op9_jump_shards")
def op9(spark, sf_dir):
    placed = sharding.assign_shards(read(spark, sf_dir, "documents"), 24)
    return placed.withColumn("law", F.lit("key")).withColumnRenamed("key", "doc_id")


@query("op10_host_rules")
def op10(spark, sf_dir):
    return quality_rules.judge(read(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id").withColumnRenamed("host", "source")


@query("op11_hard_negatives")
def op11(spark, sf_dir):
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # false for NaN, which is above all
    rows = read(spark, sf_dir, "embeddings").filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.col("label").cast("long")
    rows = rows.select(
        F.col("vec_id").cast("long").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"),
    )
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


@query("op12_pu_quality")
def op12(spark, sf_dir):
    """Labels of the fold with remainder 1 teach nothing; a document with a label 1 and none of 0 is a trusted one."""
    held_out = lambda key: F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1
    labels = read(spark, sf_dir, "labels").filter(~held_out("doc_id")).groupBy(F.col("doc_id").alias("key")).agg(F.min("quality").alias("least"))
    found = pu_quality.learn_and_score(read(spark, sf_dir, "documents"), labels.filter("least = 1"), held_out("key"))
    return found.withColumnRenamed("key", "doc_id")


@query("op13_variants")
def op13(spark, sf_dir):
    return variants.group_variants(variants.count_words(read(spark, sf_dir, "documents")))
