"""Candidate records: wide and long shapes, top five per record, and exact retrieval."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bitmap import likely_in
from shelfmark.functions.similarity import LONE_WEIGHT, cosine_general, cosine_of_sizes, cosine_of_terms, tokens_sql
from shelfmark.functions.sqltext import Sql, each, let, var
from shelfmark.functions.text import or_not_available
from shelfmark.operators.consolidate import first_per_key
from shelfmark.schema import CANDIDATE_RANKS
from shelfmark.session import stored


def candidate_array(ranks: list[int] = CANDIDATE_RANKS) -> Column:
    """The numbered url and title columns as one array, for work inside the row."""
    return F.array(*[
        F.struct(F.lit(r).alias("rank"), F.col(f"url_{r}").alias("url"), F.col(f"url_{r}_title").alias("title"))
        for r in ranks
    ])


def wide_to_long(wide: DataFrame, key: str = "id") -> DataFrame:
    """One row per record and numbered candidate, empty slots included."""
    return wide.select(key, F.explode(candidate_array()).alias("c")).select(key, "c.rank", "c.url", "c.title")


def top_candidates(found: DataFrame, key: str, order: list, n: int = 5) -> DataFrame:
    """First ``n`` results per record in result order, ranked from 1."""
    return first_per_key(found, [key], order, n, rank_name="rank")


def long_to_wide(candidates: DataFrame, key: str = "id", pad: bool = True) -> DataFrame:
    """Numbered columns again; ``pad`` fills missing slots with the sentinel."""
    pivoted = candidates.groupBy(key).pivot("rank", CANDIDATE_RANKS).agg(
        F.first("url").alias("url"), F.first("title").alias("title")
    )
    fill = or_not_available if pad else (lambda c: c)
    columns = []
    for rank in CANDIDATE_RANKS:
        columns.append(fill(F.col(f"{rank}_url")).alias(f"url_{rank}"))
        columns.append(fill(F.col(f"{rank}_title")).alias(f"url_{rank}_title"))
    return pivoted.select(key, *columns)


def collect_candidates(records: DataFrame, candidates: DataFrame, key: str = "id") -> DataFrame:
    """Records with their ranked candidates (at most five) as one array; none gives an empty array."""
    entry = F.struct("rank", "url", "title")
    grouped = candidates.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("candidates"))
    empty = F.array().cast("array<struct<rank:int,url:string,title:string>>")
    typed = F.col("candidates").cast("array<struct<rank:int,url:string,title:string>>")
    return records.join(grouped, key, "left").withColumn("candidates", F.coalesce(typed, empty))


def title_bag(title: str) -> Column:
    """Sorted tokens as text: titles with equal bags score the same against everything."""
    return F.expr(f"array_join(sort_array({tokens_sql(title)}), ' ')")


def digest(bag: Sql) -> Sql:
    """A bag by 32 bytes, so that joins do not move long texts."""
    return f"unhex(sha2({bag}, 256))"


_COUNTERS, _PER_LONG = 1 << 16, 8  # token frequencies by hash: counters of eight bits, eight times the logarithm of the count


def _frequencies(bags: DataFrame) -> Sql:
    """Logarithms of the document frequencies of tokens by hash, packed into a literal array of fixed size."""
    at = each("transform", "split(bag, ' ')", lambda t: f"pmod(xxhash64({t}), {_COUNTERS}L)")
    packed = [0] * (_COUNTERS // _PER_LONG)
    for r in bags.selectExpr(f"explode(array_distinct({at})) AS at").groupBy("at").agg(F.count("*").alias("n")).collect():
        packed[r["at"] // _PER_LONG] |= min(255, int(8 * math.log2(r["n"]))) << (8 * (r["at"] % _PER_LONG))
    return f"CAST(split('{','.join(str(x - (x >> 63 << 64)) for x in packed)}', ',') AS ARRAY<BIGINT>)"


def _number_bags(bags: DataFrame) -> DataFrame:
    """Distinct bags with an id, a digest and their terms (token, count), rare tokens first; the text itself is not kept.

    A token is its 64-bit hash. Terms are made inside the row: bags are sorted, so equal tokens are neighbours, and the
    order by frequency comes from a table of fixed size, in which tokens share counters by hash. Any order that is one
    for all bags gives the same pairs. The result is written to the checkpoint folder: every step below reads it, and the
    ids must not change on a retry.
    """
    counters = _frequencies(bags)
    held = lambda h: f"get({counters}, CAST(pmod({h}, {_COUNTERS}L) div {_PER_LONG} AS INT))"
    rank = lambda h: f"(shiftright({held(h)}, CAST(8 * ({h} & {_PER_LONG - 1}L) AS INT)) & 255L)"

    def terms(xs: Sql) -> Sql:
        i = var()
        starts = f"filter(sequence(0, size({xs}) - 1), {i} -> {i} = 0 OR get({xs}, {i}) <> get({xs}, {i} - 1))"
        x, j = var(), var()
        return let(starts, lambda at: (
            f"transform({at}, ({x}, {j}) -> named_struct('rank', {rank(f'get({xs}, {x})')}, 'token', get({xs}, {x}),"
            f" 'tf', CAST(coalesce(get({at}, {j} + 1), size({xs})) - {x} AS BIGINT)))"
        ))

    hashed = f"sort_array({each('transform', "split(bag, ' ')", lambda t: f'coalesce(nullif(xxhash64({t}), 0L), 1L)')})"  # 0 is no token
    ordered = each("transform", f"sort_array({let(hashed, terms)})", lambda x: f"named_struct('token', {x}.token, 'tf', {x}.tf)")
    made = bags.selectExpr("*", f"{ordered} AS terms")
    return stored(made.selectExpr(
        "monotonically_increasing_id() AS bag_id", f"{digest('bag')} AS digest", "is_record", "is_item", "item_key", "terms",
        "aggregate(terms, 0L, (n, x) -> n + x.tf) AS length",
    ))


def _share(threshold: float) -> float:
    # A pair scoring >= threshold shares tokens worth at least this part of each side's sum of
    # squared counts: by Cauchy-Schwarz the score is at most sqrt(s / (s + LONE_WEIGHT * (1 - s))).
    t2 = threshold * threshold
    return t2 * LONE_WEIGHT / (1 - t2 + t2 * LONE_WEIGHT) - 1e-9


def _token_keys(threshold: float) -> Sql:
    """Single-token keys of a bag: its rarest tokens, up to where too little weight is left.

    Terms are in one global order, so the first shared token has the weight of all shared tokens
    from itself on, and that is at least the needed share.
    """
    spare = f"(aggregate(terms, 0L, (n, x) -> n + x.tf * x.tf) * {1 - _share(threshold)!r}D)"
    taken = let(spare, lambda s: (
        f"aggregate(terms, named_struct('before', 0L, 'n', 0), (acc, x) -> named_struct("
        f"'before', acc.before + x.tf * x.tf, 'n', acc.n + CASE WHEN acc.before <= {s} THEN 1 ELSE 0 END)).n"
    ))
    return f"transform(slice(terms, 1, {taken}), x -> x.token)"


def _pair_keys(threshold: float) -> Sql:
    """Token-pair keys: the two rarest shared tokens, the first worth ``w`` and the rest to its right.

    A single token worth enough can be all that is shared: a key with 0 for the second.
    """
    weighed = let(
        each("transform", "terms", lambda x: f"named_struct('token', {x}.token, 'w', {x}.tf * {x}.tf)"),
        lambda xs: (
            f"transform({xs}, (x, i) -> named_struct('token', x.token, 'w', x.w, 'i', i,"
            f" 'rest', aggregate(slice({xs}, i + 1, size({xs})), 0L, (acc, y) -> acc + y.w)))"
        ),
    )
    key = lambda x, y: f"named_struct('first', {x}, 'second', {y})"

    def keys(xs: Sql) -> Sql:
        need = f"(get({xs}, 0).rest * {_share(threshold)!r}D)"
        heavy = each("filter", xs, lambda x: f"{x}.w >= {need}")
        alone = each("transform", heavy, lambda x: key(f"{x}.token", "0L"))
        second = lambda x: each("filter", xs, lambda y: f"{y}.i > {x}.i AND {x}.w + {y}.rest >= {need}")
        both = each("transform", xs, lambda x: each("transform", second(x), lambda y: key(f"{x}.token", f"{y}.token")))
        return f"concat({alone}, flatten({both}))"

    return let(weighed, keys)


def _least_shared(threshold: float, longest: int) -> Sql:
    """Array of arrays: the fewest tokens that texts of given sizes, without repeats, must share."""

    def least(a: int, b: int) -> int:
        for n in range(1, min(a, b) + 1):
            norms = (n + (a - n) * LONE_WEIGHT) * (n + (b - n) * LONE_WEIGHT)
            if n / math.sqrt(norms) >= threshold - 1e-9:
                return n
        return a + b  # out of reach

    sizes = range(1, longest + 1)
    return "array(" + ", ".join("array(" + ", ".join(str(least(a, b)) for b in sizes) + ")" for a in sizes) + ")"


def _sized_keys(threshold: float, longest: int) -> Sql:
    """Token-pair keys of a text without repeats, for every partner size it can match.

    Knowing both sizes, the shared tokens must be more, so a key reaches less far into the
    frequent tokens: titles that differ in one rare token do not all meet under the common ones.
    """
    key = lambda x, y, other: f"named_struct('first', {x}.token, 'second', {y}, 'other', {other})"

    def for_size(row: Sql, other: Sql) -> Sql:
        def keys(need: Sql) -> Sql:
            n = "size(terms)"
            x, i = var(), var()
            alone = each("transform", "terms", lambda t: key(t, "0L", other))
            y, j = var(), var()
            # Two shared tokens at i < j leave at most n - j from the second on.
            second = f"filter(transform(terms, ({y}, {j}) -> named_struct('token', {y}.token, 'at', {j})), {y} -> {y}.at > {i} AND {n} - {y}.at + 1 >= {need})"
            both = f"flatten(transform(terms, ({x}, {i}) -> transform({second}, {y} -> {key(x, f'{y}.token', other)})))"
            none = "CAST(array() AS ARRAY<STRUCT<first: BIGINT, second: BIGINT, other: INT>>)"
            return f"CASE WHEN {need} > {n} THEN {none} WHEN {need} = 1 THEN concat({alone}, {both}) ELSE {both} END"

        return let(f"get({row}, {other} - 1)", keys)

    row = f"get({_least_shared(threshold, longest)}, size(terms) - 1)"
    return let(row, lambda r: f"flatten({each('transform', f'sequence(1, {longest})', lambda other: for_size(r, other))})")


def _scored_where(shared_is: Sql) -> Sql:
    # Score of two texts without repeats, 0 where ``shared_is`` does not hold: a pair is scored at one meeting place only.
    # Not nullable, so that a filter on the score does not evaluate it again for a null check.
    score = lambda shared: cosine_of_sizes("record_size", "item_size", f"size({shared})")
    value = let("array_intersect(record_words, item_words)", lambda s: f"CASE WHEN {shared_is.format(s=s)} THEN {score(s)} ELSE 0D END")
    return f"coalesce({value}, 0D) AS similarity"


# A meeting place: the rarest shared tokens so far, in order, and both sizes. ``closed`` places are for pairs that share no more.
_PLACE = ["path", "closed", "record_size", "item_size"]
_PREFIX = "slice({s}, 1, size(path)) = path AND (NOT closed OR size({s}) = size(path))"
_CROWDED = 32


def _crowded(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places where joining both sides makes many more pairs than rows."""
    counts = [rows.groupBy(*_PLACE).agg(F.count("*").alias(name)) for rows, name in ((left, "n"), (right, "m"))]
    return counts[0].join(counts[1], _PLACE).filter(F.col("n") * F.col("m") > _CROWDED * (F.col("n") + F.col("m"))).select(*_PLACE)


def _top_pairs(left: DataFrame, right: DataFrame, least: Sql, top: int) -> DataFrame:
    """Scored pairs of texts without repeats that hold every record's ``top`` best items, by score and key; most other pairs are not made.

    At a crowded place (a template that a large part of the titles share) pairs that share just its path all score the same, so
    only the ``top`` items of lowest key enter the join: an item behind them is behind them in every record's order as well, since
    they share the path or more. Pairs that share more go on to the places of one token more, which are treated alike.
    """
    need = f"get(get({least}, record_size - 1), item_size - 1)"
    pairs = ["record_bag", "item_bag"]
    found = None
    while True:
        left, right = stored(left), stored(right)  # each is read several times below, and places take long to make
        crowded = stored(_crowded(left, right))
        if crowded.isEmpty():
            met = left.join(right, _PLACE).selectExpr(*pairs, _scored_where(_PREFIX))
            return met if found is None else found.unionByName(met)
        sides = [stored(rows.join(crowded, _PLACE)) for rows in (left, right)]
        rest = [rows.join(crowded, _PLACE, "left_anti") for rows in (left, right)]
        met = rest[0].join(rest[1], _PLACE).selectExpr(*pairs, _scored_where(_PREFIX))
        lowest = first_per_key(sides[1], _PLACE, ["item_key", "item_bag"], top)
        ends = sides[0].filter(F.expr(f"size(path) >= {need}")).join(lowest, _PLACE)
        met = met.unionByName(ends.selectExpr(*pairs, _scored_where("{s} = path")))
        found = met if found is None else found.unionByName(met)

        def onward(rows: DataFrame, side: str) -> DataFrame:
            words, size = f"{side}_words", f"{side}_size"
            last = f"CAST(array_position({words}, element_at(path, -1)) AS INT)"
            # at a later place, with enough tokens left to reach what the sizes ask for
            fits = let(f"named_struct('last', {last}, 'need', {need})", lambda x: (
                f"filter(transform({words}, (t, i) -> named_struct('token', t, 'at', i + 1)),"
                f" y -> y.at > {x}.last AND size(path) + 1 + {size} - y.at >= {x}.need)"
            ))
            kept = [c for c in rows.columns if c != "path"]
            return rows.filter("NOT closed").selectExpr(*kept, "path AS before", f"explode({fits}) AS next").selectExpr(
                *kept, "concat(before, array(next.token)) AS path"
            )

        left, right = onward(sides[0], "record"), onward(sides[1], "item")


def _short_pairs(bags: DataFrame, threshold: float, longest: int, top: int) -> DataFrame:
    # Keyed by token pairs and scored in the join. A pair meets under several keys but is scored
    # only under its rarest shared tokens, and is 0 elsewhere, so no distinct is needed.
    words = "flatten(transform(terms, x -> array_repeat(x.token, CAST(x.tf AS INT)))) AS words"
    # spread out: a few MB of titles, one split of a file, make many keys
    spark = bags.sparkSession
    bags = bags.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bags = bags.selectExpr("bag_id", "is_record", "is_item", "item_key", "terms", words, "size(terms) = length AS plain")

    def keyed(rows: DataFrame, side: str, keys: Sql) -> DataFrame:
        return rows.selectExpr(f"bag_id AS {side}_bag", f"words AS {side}_words", "item_key", f"explode({keys}) AS key")

    def general(left: DataFrame, right: DataFrame) -> DataFrame:
        value = let("array_intersect(record_words, item_words)", lambda shared: (
            f"CASE WHEN {shared}[0] <> first OR coalesce(get({shared}, 1), 0L) <> second THEN 0D"
            f" ELSE {cosine_general('record_words', 'item_words')} END"
        ))
        parts = "key.first AS first", "key.second AS second"
        sides = (keyed(rows, side, loose).selectExpr(f"{side}_bag", f"{side}_words", *parts) for rows, side in ((left, "record"), (right, "item")))
        return next(sides).join(next(sides), ["first", "second"]).select("record_bag", "item_bag", F.expr(f"coalesce({value}, 0D)").alias("similarity"))

    records, items = bags.filter("is_record"), bags.filter("is_item")
    sized, loose = _sized_keys(threshold, longest), _pair_keys(threshold)
    place = "key.second = 0 AS closed", "IF(key.second = 0, array(key.first), array(key.first, key.second)) AS path"
    left = keyed(records.filter("plain"), "record", sized).selectExpr(
        "record_bag", "record_words", *place, "size(record_words) AS record_size", "key.other AS item_size")
    right = keyed(items.filter("plain"), "item", sized).selectExpr(
        "item_bag", "item_words", "item_key", *place, "key.other AS record_size", "size(item_words) AS item_size")
    plain = _top_pairs(left, right, _least_shared(threshold, longest), top)
    # Pairs with a repeated token on some side.
    from_repeats = general(records.filter("NOT plain"), items)
    to_repeats = general(records.filter("plain"), items.filter("NOT plain"))
    return plain.unionByName(from_repeats).unionByName(to_repeats)


def _reach(own: str, other: str) -> Sql:
    # The most that what is shared can add to one side's part of the score: its remaining squared counts, or as many of its
    # largest counts as the other side has tokens left. Written out twice: a lambda would keep it out of compiled code.
    most = f"least({own}_rest, {other}_left * {own}_most)"
    return f"{most} / ({most} + ({own}_all - {most}) * {LONE_WEIGHT!r}D)"


def _long_pairs(bags: DataFrame, threshold: float, longest: int) -> DataFrame:
    # Pairs with a long side: single-token keys carry ids and what is left of the text from that token on. Where a pair meets
    # first, all it shares lies from there on, so the bound of the score holds there; pairs under it never get their texts.
    # Each token before counts for one or more.
    # In two steps: beside a generator, the sums would be made once per key.
    summed = bags.selectExpr(
        "bag_id", "is_record", "is_item", f"length > {longest} AS is_long", "size(terms) AS n",
        "array_max(transform(terms, x -> x.tf * x.tf)) AS most", "aggregate(terms, 0L, (n, x) -> n + x.tf * x.tf) AS whole",
        f"{_token_keys(threshold)} AS keys",
    )
    keyed = summed.selectExpr("bag_id", "is_record", "is_item", "is_long", "n", "most", "whole", "posexplode(keys) AS (at, key)")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.selectExpr(
            "key", f"bag_id AS {name}_bag", f"n - at AS {name}_left", f"most AS {name}_most",
            f"whole AS {name}_all", f"whole - at AS {name}_rest",
        )

    def meet(records: DataFrame, items: DataFrame) -> DataFrame:
        # keys that no record has never leave their task
        items = likely_in(items, F.xxhash64("key"), records, F.xxhash64("key"))
        return side(records, "record").join(side(items, "item"), "key").filter(bound).select("record_bag", "item_bag")

    bound = f"{_reach('record', 'item')} * ({_reach('item', 'record')}) >= {max(threshold - 1e-9, 0) ** 2!r}D"
    records, items = keyed.filter("is_record"), keyed.filter("is_item")
    # two joins, since in one all pairs of short texts would meet as well
    met = meet(records.filter("is_long"), items).unionByName(meet(records.filter("NOT is_long"), items.filter("is_long"))).distinct()
    text = (
        "named_struct('tokens', transform(terms, x -> x.token), 'tf', transform(terms, x -> x.tf),"
        " 'whole', aggregate(terms, 0L, (n, x) -> n + x.tf * x.tf))"
    )
    sides = [bags.filter(f"is_{name}").selectExpr(f"bag_id AS {name}_bag", f"{text} AS {name}") for name in ("record", "item")]
    joined = met.join(sides[0], "record_bag").join(sides[1], "item_bag")
    return joined.select("record_bag", "item_bag", F.expr(f"coalesce({cosine_of_terms('record', 'item')}, 0D)").alias("similarity"))


def similar_bags(bags: DataFrame, threshold: float, longest: int = 32, top: int = 5) -> DataFrame:
    """(record bag, item bag) pairs scoring at least ``threshold`` (above 0), with every record's ``top`` best: exact, no frequency cap.

    ``bags`` comes from :func:`_number_bags`. Bags of up to ``longest`` tokens meet under token
    pairs, which keeps key groups small; their number is quadratic in the length, so pairs with a
    longer bag take single-token keys and a bound of what is left from there on.
    """
    short = _short_pairs(bags.filter(F.col("length") <= longest), threshold, longest, top)
    return short.unionByName(_long_pairs(bags, threshold, longest)).filter(F.col("similarity") >= threshold)


def retrieve(
    records: DataFrame, catalog: DataFrame, threshold: float = 0.6, top: int = 5, longest: int = 32
) -> DataFrame:
    """The ``top`` catalog items per record with title similarity >= ``threshold``.

    ``records`` has ``id, title``; ``catalog`` has ``key, url, title``. Ranked by similarity,
    then key, as if every record were scored against the whole catalog. Work is done once per
    distinct bag of tokens, so repeated titles on either side add no pairs, and titles of one template
    add a bounded number of pairs each (unless they repeat a token).
    """
    rec = records.select("id", title_bag("title").alias("bag")).filter("bag != ''")
    items = catalog.select("key", "url", "title", title_bag("title").alias("bag")).filter("bag != ''")
    digested = lambda df: df.withColumn("digest", F.expr(digest("bag"))).drop("bag")
    sides = rec.select("bag", F.lit(True).alias("r"), F.lit(False).alias("i")).unionByName(
        items.select("bag", "key", F.lit(False).alias("r"), F.lit(True).alias("i")), allowMissingColumns=True
    )
    bags = _number_bags(sides.groupBy("bag").agg(
        F.bool_or("r").alias("is_record"), F.bool_or("i").alias("is_item"), F.min("key").alias("item_key")
    ))
    pairs = similar_bags(bags, threshold, longest, top)
    # No record can use more than the first `top` items of one bag.
    firsts = first_per_key(digested(items), ["digest"], ["key"], top)
    firsts = firsts.join(bags.filter("is_item").selectExpr("digest", "bag_id AS item_bag"), "digest").drop("digest")
    by_score = F.round("similarity", 9).desc()  # equal scores can differ in their last bits
    ranked = first_per_key(pairs.join(firsts, "item_bag"), ["record_bag"], [by_score, "key"], top, rank_name="rank")
    # The results go back to their bag first, so that the records move only once.
    named = ranked.join(bags.filter("is_record").selectExpr("digest", "bag_id AS record_bag"), "record_bag")
    return digested(rec).join(named, "digest").select("id", "rank", "key", "url", "title", "similarity")
