"""Candidate records kept as JSON: a list of records, an object keyed by serial, or JSON lines.

Lists and keyed objects are read in splits, however long their lines: text is cut after each closing brace, the braces and quotes
before each cut tell which records end there, and each record is parsed on its own. So one bad entry costs that entry alone. A
record's pieces are held together in one row; in a file with an unclosed quote or brace, that is everything from there on.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import strip
from shelfmark.schema import CANDIDATE_RANKS, WIDE_CANDIDATE_SCHEMA
from shelfmark.sources.splits import before, gather, pieces

# Field names of the keyed layout.
ORDINALS = {1: "1st", 2: "2nd", 3: "3rd", 4: "4th", 5: "5th"}
KEYED_SCHEMA = T.StructType(
    [T.StructField("Serial_Number", T.StringType()), T.StructField("input_title", T.StringType())]
    + [
        T.StructField(name, T.StringType())
        for rank in CANDIDATE_RANKS
        for name in (f"{ORDINALS[rank]}_url", f"{ORDINALS[rank]}_url_title")
    ]
)
_CORRUPT = "_corrupt_record"


def _raw_text(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path).select(F.input_file_name().alias("file_name"), F.col("value").alias("raw"))
    return text.filter(strip(F.col("raw")) != "")


def _entries(spark: SparkSession, path: str, keyed: bool) -> tuple[DataFrame, DataFrame]:
    """The entries of a list, or of an object (``keyed``): file_name, key, value (variant); and what does not parse.

    A file that begins otherwise is set aside, each of its pieces as it is."""
    rows = pieces(spark, path, "}")
    # Escaped characters out; a piece turns the quotes' state where it holds an odd number of them.
    bare = F.regexp_replace("raw", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    rows = before(rows.withColumn("__odd", (quotes % 2).cast("long")), F.col("__odd"), "__quotes")
    # The piece without what is quoted; then its opening signs less the closing ones, with the brace that cut it.
    begins_inside = F.col("__quotes") % 2 == 1
    ends_inside = (F.col("__quotes") + F.col("__odd")) % 2 == 1
    plain = F.regexp_replace(F.concat(F.when(begins_inside, '"').otherwise(""), bare), '"[^"]*(?:"|$)', "")
    opened = F.length(F.regexp_replace(plain, r"[^\[{]", "")) - F.length(F.regexp_replace(plain, r"[^\]]", ""))
    first = F.expr("substring(ltrim(chr(10) || chr(13) || chr(9) || ' ' || chr(65279), raw), 1, 1)")
    place = F.struct("block_start", "row_seq")
    files = rows.groupBy("file_name").agg(
        F.max(place).alias("__end"), F.min_by(first, place).alias("__begins"),
        # what the pieces and one brace after each leave of the file: nothing (or a byte order mark), or too little for the last brace
        (F.max("file_size") - F.sum(F.octet_length("raw") + 1)).isin(0, 3).alias("__whole"),
    )
    rows = rows.join(files, "file_name").withColumn("__cut", F.col("__whole") | (place < F.col("__end")))
    closing = F.col("__cut") & ~ends_inside
    rows = rows.withColumn("__open", opened.cast("long") - closing.cast("long")).withColumn("__closing", closing)
    rows = before(rows, F.col("__open"), "__depth")
    right = F.col("__begins") == ("{" if keyed else "[")
    odd = rows.filter(~right & (strip(F.col("raw")) != "")).select("file_name", F.concat("raw", F.when(F.col("__cut"), "}").otherwise("")).alias("raw"))

    rows = rows.filter(right).withColumn("raw", F.concat("raw", F.when(F.col("__cut"), "}").otherwise("")))
    last = F.col("__closing") & (F.col("__depth") + F.col("__open") == 1)
    records = gather(rows.select("file_name", "block_start", "row_seq", "raw", last.alias("__ends")), F.col("__ends"), "")
    # A record's text: the opening sign or a comma before it, the closing sign after the last one.
    opening, ending = (r"\{", r"\}") if keyed else (r"\[", r"\]")
    lead = F.when(F.col("record") == 0, F.regexp_replace("text", rf"^[\s\x{{FEFF}}]*{opening}", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    body = F.when(F.col("complete"), lead).otherwise(F.regexp_replace(lead, rf"{ending}\s*\z", ""))
    texts = records.select("file_name", "text", body.alias("body"), (F.col("complete") | F.col("text").rlike(rf"{ending}\s*\z")).alias("closed"))
    texts = texts.filter(~(F.col("closed") & (strip(F.col("body")) == "")))
    wrapped = F.concat(F.lit("{" if keyed else "["), "body", F.lit("}" if keyed else "]"))
    parsed = texts.withColumn("__v", F.when(F.col("closed"), F.try_parse_json(wrapped)))
    found = spark.sql("SELECT t.file_name, x.key, x.value FROM {t} AS t, LATERAL variant_explode(t.__v) AS x", t=parsed.filter("__v IS NOT NULL"))
    return found, odd.unionByName(parsed.filter("__v IS NULL").select("file_name", F.col("text").alias("raw")))


def _field(name: str) -> Column:
    return F.try_variant_get("value", f'$["{name}"]', "string")


def _is_record(names: list[str]) -> Column:
    """An object whose known fields are plain values."""
    nested = [F.schema_of_variant(F.try_variant_get("value", f'$["{name}"]', "variant")).rlike("^(OBJECT|ARRAY)") for name in names]
    flat = functools.reduce(lambda x, y: x & ~F.coalesce(y, F.lit(False)), nested, F.lit(True))
    return F.schema_of_variant("value").startswith("OBJECT") & flat


def read_records(
    spark: SparkSession, path: str, schema: T.StructType = WIDE_CANDIDATE_SCHEMA, lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Good records, and what is set aside as file_name and raw: entries that are no records, text that does not parse.

    ``lines`` reads one record per line; otherwise a file is one list of records. Numbers become text.
    """
    if lines:
        full = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
        parsed = _raw_text(spark, path).withColumn("r", F.from_json("raw", full, {"columnNameOfCorruptRecord": _CORRUPT}))
        is_good = F.col(f"r.{_CORRUPT}").isNull()
        return parsed.filter(is_good).select(*[f"r.{name}" for name in schema.names]), parsed.filter(~is_good).select("file_name", "raw")
    found, bad = _entries(spark, path, keyed=False)
    good = found.filter(_is_record(schema.names)).select(*[_field(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    odd = found.filter(~_is_record(schema.names)).select("file_name", F.to_json("value").alias("raw"))
    return good, bad.unionByName(odd)


def read_keyed_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records of an object keyed by serial, in the wide layout, and what is set aside, with its key."""
    found, bad = _entries(spark, path, keyed=True)
    names = KEYED_SCHEMA.names
    wide = found.filter(_is_record(names)).select(
        F.col("key").alias("id"),
        F.coalesce(_field("Serial_Number"), "key").alias("serial_number"),
        _field("input_title").alias("input_title"),
        *[
            _field(f"{ORDINALS[rank]}_url{tail}").alias(f"url_{rank}{tail}")
            for rank in CANDIDATE_RANKS
            for tail in ("", "_title")
        ],
    )
    entry = F.concat(F.to_json(F.struct("key")).substr(F.lit(8), F.length(F.to_json(F.struct("key"))) - 8), F.lit(":"), F.to_json("value"))
    odd = found.filter(~_is_record(names)).select("file_name", F.concat(F.lit("{"), entry, F.lit("}")).alias("raw"))
    return wide, bad.unionByName(odd)
