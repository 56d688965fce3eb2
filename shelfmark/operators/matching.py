"""Scoring candidates against a record's title and choosing the match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.similarity import cosine_sql, tfidf_cosine, tokens, tokens_sql
from shelfmark.functions.sqltext import each
from shelfmark.functions.text import local_stamp, strip
from shelfmark.operators.candidates import candidate_array, wide_to_long
from shelfmark.schema import AVAILABLE, CANDIDATE_RANKS, MATCH_COLUMNS, NO_MATCH_URL, NOT_AVAILABLE

THRESHOLD = 0.6


def score_candidates(df: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Add ``scored`` to records with a ``candidates`` array: rank, url and similarity per candidate.

    A missing title is not scored (null); the text "Not Available" is a title like any other.
    Everything happens inside the row: no shuffle, and the record's title is tokenized once.
    """
    words = each("transform", "candidates", lambda c: (
        f"named_struct('rank', {c}.rank, 'url', {c}.url,"
        f" 'words', CASE WHEN {c}.title <> '' THEN {tokens_sql(f'{c}.title', stop_words)} END)"
    ))
    prepared = df.withColumns({"__own": tokens("input_title", stop_words), "__theirs": F.expr(words)})
    scored = each("transform", "__theirs", lambda c: (
        f"named_struct('rank', {c}.rank, 'url', {c}.url,"
        f" 'similarity', CASE WHEN {c}.words IS NOT NULL THEN {cosine_sql('__own', f'{c}.words')} END)"
    ))
    return prepared.withColumn("scored", F.expr(scored)).drop("__own", "__theirs")


# Scores this close are ties: equal scores can differ in their last bits.
TIE_DIGITS = 9


def best_of(scored: Column) -> Column:
    """Highest similarity above zero, the lowest rank on ties; null when nothing scores."""
    entries = F.transform(
        F.filter(scored, lambda c: c["similarity"] > 0),
        lambda c: F.struct(
            F.round(c["similarity"], TIE_DIGITS).alias("score"), (-c["rank"]).alias("order"),
            c["url"].alias("url"), c["similarity"].alias("similarity"),
        ),
    )
    return F.array_max(entries)


def best_candidate(scored: DataFrame, key: str = "id") -> DataFrame:
    """The same choice over long rows ``key, rank, url, similarity``."""
    score = F.round("similarity", TIE_DIGITS)
    # chosen inside the aggregate: a filter would move below the scoring, which would then be made again for each mention
    entry = F.when(F.col("similarity") > 0, F.struct(score.alias("score"), (-F.col("rank")).alias("order"), "url", "similarity"))
    return scored.groupBy(key).agg(F.max(entry).alias("b")).filter("b IS NOT NULL").select(
        key, F.col("b.url").alias("best_url"), F.col("b.similarity").alias("best_similarity")
    )


def decide(similarity: Column, url: Column, threshold: float = THRESHOLD) -> tuple[Column, Column]:
    """Matched URL and status, from the unrounded similarity."""
    matched = F.coalesce(similarity, F.lit(0.0)) >= threshold
    return (
        F.when(matched, url).otherwise(NO_MATCH_URL),
        F.when(matched, AVAILABLE).otherwise(NOT_AVAILABLE),
    )


def match_records(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scored records with ``best_similarity`` (3 decimals), ``matched_url`` and ``status``."""
    chosen = score_candidates(df).withColumn("__best", best_of(F.col("scored")))
    url, status = decide(F.col("__best.similarity"), F.col("__best.url"), threshold)
    return chosen.withColumns({
        "matched_url": url,
        "status": status,
        "best_similarity": F.round(F.coalesce("__best.similarity", F.lit(0.0)), 3),
    }).drop("__best")


def similarity_of(rank: int, digits: int = 3) -> Column:
    hit = F.get(F.filter("scored", lambda c: c["rank"] == rank), F.lit(0))
    return F.round(hit["similarity"], digits)


def augment(wide: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Wide candidate records plus ``url_i_similarity``, best score, URL and status."""
    matched = match_records(wide.withColumn("candidates", candidate_array()), threshold)
    scores = {f"url_{r}_similarity": similarity_of(r) for r in CANDIDATE_RANKS}
    return matched.withColumns(scores).drop("candidates", "scored")


def similarity_table(wide: DataFrame, as_of: str, stop_words: list[str] | None = None) -> DataFrame:
    """The earlier variant's wide table: rounded scores beside each URL, no decision."""
    scored = score_candidates(wide.withColumn("candidates", candidate_array()), stop_words)
    columns = ["id", "serial_number", "input_title"]
    for r in CANDIDATE_RANKS:
        columns += [f"url_{r}", f"url_{r}_title", similarity_of(r).alias(f"url_{r}_similarity")]
    return scored.select(*columns, "scraped_date", local_stamp(as_of).alias("processed_date"))


def score_long(records: DataFrame, candidates: DataFrame, key: str = "id") -> DataFrame:
    """Scores of long candidate rows: ``key, rank, url, similarity`` with unscored rows dropped."""
    titled = candidates.filter(F.col("title") != "")
    # a record's title is taken apart once, not once per candidate
    joined = titled.join(records.select(key, tokens("input_title").alias("__a")), key).withColumn("__b", tokens("title"))
    return joined.select(key, "rank", "url", tfidf_cosine("__a", "__b").alias("similarity"))


def scores_to_wide(scored: DataFrame, key: str = "id") -> DataFrame:
    pivoted = scored.groupBy(key).pivot("rank", CANDIDATE_RANKS).agg(F.first(F.round("similarity", 3)))
    return pivoted.select(key, *[F.col(str(r)).alias(f"url_{r}_similarity") for r in CANDIDATE_RANKS])


def match_summary(records: DataFrame, best: DataFrame, key: str = "id", threshold: float = THRESHOLD, on: str | None = None) -> DataFrame:
    """One row per record, those without candidates included. ``best`` has one row per value of ``on`` (else ``key``)."""
    url, status = decide(F.col("best_similarity"), F.col("best_url"), threshold)
    joined = records.join(best, on or key, "left")
    return joined.withColumns({
        "input_title": strip(F.col("input_title")), "matched_url": url, "status": status
    }).select(key, *MATCH_COLUMNS[1:])


def match_wide(wide: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Match table straight from wide records."""
    matched = match_records(wide.withColumn("candidates", candidate_array()), threshold)
    return matched.withColumn("input_title", strip(F.col("input_title"))).select(*MATCH_COLUMNS)


def long_scores_of_wide(wide: DataFrame) -> DataFrame:
    return score_long(wide.select("id", "input_title"), wide_to_long(wide))
