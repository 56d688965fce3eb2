"""Column builders for text cleanup, sentinels and URLs."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.schema import NOT_AVAILABLE

# Whitespace as Python's str.split() sees it: Unicode white space plus the four separators.
SPACE = r"[\s\x1c-\x1f]"

# Strings a CSV reader with default settings takes as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Every other Unicode decimal digit and its 0-9 form, so that a ``\d`` match can be cast.
_DIGITS = [
    ch for ch in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(ch) == "Nd"
]
UNICODE_DIGITS = "".join(_DIGITS)
ASCII_DIGITS = "".join(str(unicodedata.decimal(ch)) for ch in _DIGITS)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def normalize_key(c: Column) -> Column:
    return strip(c.cast("string"))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_not_available(c: Column) -> Column:
    return F.coalesce(empty_to_null(c), F.lit(NOT_AVAILABLE))


def null_or_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def null_token_to_null(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def price_text(c: Column) -> Column:
    return strip(F.translate(c, "\u00a0", " "))


def brand_and_title(brand: Column, title: Column) -> Column:
    """``brand title`` when the brand is known, else the title; a missing title is the sentinel."""
    known = empty_to_null(strip(brand))
    known = F.when(known != NOT_AVAILABLE, known)
    return F.concat_ws(" ", known, F.coalesce(strip(title), F.lit(NOT_AVAILABLE)))


def absolute_url(href: Column, site: str) -> Column:
    site = site.rstrip("/")
    return (
        F.when(F.coalesce(href, F.lit("")) == "", F.lit(NOT_AVAILABLE))
        .when(href.startswith("http"), href)
        .otherwise(F.concat(F.lit(site), href))
    )


def path_without_query(href: Column, site: str) -> Column:
    """Site-relative links lose their query string; other links are kept as they are."""
    site = site.rstrip("/")
    return (
        F.when(F.coalesce(href, F.lit("")) == "", F.lit(NOT_AVAILABLE))
        .when(href.startswith("//"), F.concat(F.lit("https:"), F.substring_index(href, "?", 1)))
        .when(href.startswith("/"), F.concat(F.lit(site), F.substring_index(href, "?", 1)))
        .otherwise(href)
    )


def form_encode(c: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped, unlike the JVM encoder."""
    return F.replace(
        F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def search_url(title: Column, site: str) -> Column:
    return F.concat(F.lit(site.rstrip("/") + "/s?k="), form_encode(title))


def local_stamp(as_of: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the run time, a job parameter so that reruns repeat."""
    return F.date_format(F.lit(as_of).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


def utc_iso_stamp(as_of: str) -> Column:
    """ISO 8601 without zone; microseconds appear only when they are not zero."""
    at = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(at, ".SSSSSS")
    return F.when(micros == ".000000", seconds).otherwise(F.concat(seconds, micros))
