"""TF-IDF cosine of two texts when the idf weights come from those two texts alone.

With two documents a shared token weighs 1 and a token of one side weighs ln(1.5) + 1, so
the score has a closed form over token counts. Title-sized texts are scored inside the row by
:func:`tfidf_cosine`; long texts go through :func:`score_long_pairs`, which is linear in length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.sqltext import Sql, each, let, lit, raw, var

# Squared idf of a token that occurs in only one of the two texts.
LONE_WEIGHT = (math.log(1.5) + 1.0) ** 2
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens_sql(text: Sql, stop_words: list[str] | None = None) -> Sql:
    """Lower-cased word tokens of two or more characters; null text has none."""
    found = f"regexp_extract_all(lower(coalesce({text}, '')), {raw(TOKEN)}, 0)"
    if stop_words:
        words = ", ".join(lit(w) for w in stop_words)
        found = each("filter", found, lambda t: f"{t} NOT IN ({words})")
    return found


def tokens(text: str, stop_words: list[str] | None = None) -> Column:
    return F.expr(tokens_sql(text, stop_words))


def _cosine_sql(dot: Sql, sq_a: Sql, shared_a: Sql, sq_b: Sql, shared_b: Sql) -> Sql:
    # From integer sums: tf products, squared tf, and squared tf over the shared tokens.
    norm = lambda sq, shared: f"({shared} + ({sq} - {shared}) * {LONE_WEIGHT!r}D)"
    return f"CASE WHEN {dot} > 0 THEN {dot} / sqrt({norm(sq_a, shared_a)} * {norm(sq_b, shared_b)}) ELSE 0D END"


def _equal_pairs(left: Sql, right: Sql) -> Sql:
    # Number of equal pairs between two token arrays: the dot product of their counts.
    acc, t = var(), var()
    return f"aggregate({left}, 0L, ({acc}, {t}) -> {acc} + size({each('filter', right, lambda u: f'{u} = {t}')}))"


def cosine_of_sizes(size_a: Sql, size_b: Sql, shared: Sql) -> Sql:
    """Score of two texts without repeated tokens, from their sizes and the number shared."""
    return _cosine_sql(shared, size_a, shared, size_b, shared)


def cosine_general(a: Sql, b: Sql) -> Sql:
    """Score of two token arrays, repeats allowed; quadratic, for title-sized texts."""
    within = lambda side, other: each("filter", side, lambda t: f"array_contains({other}, {t})")
    return _cosine_sql(
        _equal_pairs(a, b), _equal_pairs(a, a), _equal_pairs(within(a, b), a),
        _equal_pairs(b, b), _equal_pairs(within(b, a), b),
    )


def cosine_of_terms(a: Sql, b: Sql) -> Sql:
    """Score of two texts given as structs of distinct ``tokens``, their counts ``tf`` and the sum of squared counts ``whole``.

    Takes the shared tokens times both lengths; nothing leaves the row."""
    count = lambda side, t: f"get({side}.tf, CAST(array_position({side}.tokens, {t}) AS INT) - 1)"
    acc, p = var(), var()
    counts = each("transform", f"array_intersect({a}.tokens, {b}.tokens)", lambda t: f"named_struct('x', {count(a, t)}, 'y', {count(b, t)})")
    sums = (
        f"aggregate({counts}, named_struct('dot', 0L, 'a', 0L, 'b', 0L), ({acc}, {p}) -> named_struct('dot', {acc}.dot + {p}.x * {p}.y,"
        f" 'a', {acc}.a + {p}.x * {p}.x, 'b', {acc}.b + {p}.y * {p}.y))"
    )
    return let(sums, lambda s: _cosine_sql(f"{s}.dot", f"{a}.whole", f"{s}.a", f"{b}.whole", f"{s}.b"))


def cosine_sql(a: Sql, b: Sql) -> Sql:
    """Score of two token arrays given as plain column or lambda variable names."""
    simple = let(
        f"size(array_intersect({a}, {b}))", lambda n: cosine_of_sizes(f"size({a})", f"size({b})", n)
    )
    distinct = f"size(array_distinct({a})) = size({a}) AND size(array_distinct({b})) = size({b})"
    return f"CASE WHEN {distinct} THEN coalesce({simple}, 0D) ELSE {cosine_general(a, b)} END"


def tfidf_cosine(a: str, b: str) -> Column:
    """Score of two token array columns."""
    return F.expr(cosine_sql(a, b))


def _run_sums(xs: Sql) -> Sql:
    # From sorted token hashes whose last bit is the side: runs of equal values are counts, and a token's two runs are neighbours.
    i, s, j, r, k, acc, y = (var() for _ in range(7))
    starts = f"filter(sequence(0, size({xs}) - 1), {i} -> {i} = 0 OR get({xs}, {i}) <> get({xs}, {i} - 1))"
    runs = lambda at: f"transform({at}, ({s}, {j}) -> named_struct('x', get({xs}, {s}), 'n', CAST(coalesce(get({at}, {j} + 1), size({xs})) - {s} AS BIGINT)))"
    other = lambda rs, side, step: f"IF(get({rs}, {k} {side} 1).x = {r}.x {step} 1L, get({rs}, {k} {side} 1).n, 0L)"
    paired = lambda rs: (
        f"transform({rs}, ({r}, {k}) -> IF(({r}.x & 1L) = 0L, named_struct('a', {r}.n, 'b', {other(rs, '+', '+')}, 'own', 1L),"
        f" named_struct('a', {other(rs, '-', '-')}, 'b', {r}.n, 'own', 0L)))"
    )
    sums = lambda ps: (
        f"aggregate({ps}, named_struct('dot', 0L, 'sq_a', 0L, 'shared_a', 0L, 'sq_b', 0L, 'shared_b', 0L), ({acc}, {y}) -> named_struct("
        f"'dot', {acc}.dot + {y}.own * {y}.a * {y}.b, 'sq_a', {acc}.sq_a + {y}.own * {y}.a * {y}.a,"
        f" 'shared_a', {acc}.shared_a + IF({y}.b > 0, {y}.own * {y}.a * {y}.a, 0L), 'sq_b', {acc}.sq_b + (1L - {y}.own) * {y}.b * {y}.b,"
        f" 'shared_b', {acc}.shared_b + IF({y}.a > 0, (1L - {y}.own) * {y}.b * {y}.b, 0L)))"
    )
    return let(starts, lambda at: let(runs(at), lambda rs: sums(paired(rs))))


def score_long_pairs(pairs: DataFrame, keys: list[str], left: Sql, right: Sql, score: str = "similarity") -> DataFrame:
    """Score one pair of texts per row; returns ``keys`` and the score. Rows of equal keys are one pair.

    ``left`` and ``right`` give the token arrays and are evaluated after the rows have moved, once, by pair key. From there on a
    token is 63 bits of its hash, and a pair is counted inside its row: a task holds eight bytes per token and no table of
    tokens. Linear in the text length but for one sort of the hashes.
    """
    hashes = lambda tokens, side: each("transform", tokens, lambda t: f"xxhash64({t}) {side}")
    both = f"coalesce(concat({hashes(left, '& -2L')}, {hashes(right, '| 1L')}), CAST(array() AS ARRAY<BIGINT>))"
    moved = pairs.repartition(*keys).selectExpr(*keys, f"{both} AS __hashes")
    joined = moved.groupBy(*keys).agg(F.expr("flatten(collect_list(__hashes))").alias("__hashes"))
    value = let("sort_array(__hashes)", lambda xs: let(_run_sums(xs), lambda n: _cosine_sql(f"{n}.dot", f"{n}.sq_a", f"{n}.shared_a", f"{n}.sq_b", f"{n}.shared_b")))
    return joined.select(*keys, F.expr(f"CASE WHEN size(__hashes) = 0 THEN 0D ELSE {value} END").alias(score))
