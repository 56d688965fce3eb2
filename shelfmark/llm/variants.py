"""Spelling variant grouping by PartEnum signatures, in DataFrame expressions.

A word's letters are a multiset, read as the binary vector of its elements (letter, occurrence): "tepee" has t1, e1, e2, e3 and p1.
One replaced code point changes at most two elements, one inserted or deleted code point exactly one. So words that differ by one
edit have vectors at a Hamming distance of at most two, and the exact signatures of PartEnum find all of them: the elements are dealt
to parts by hash, and vectors that differ in at most two elements agree in all parts but some two. Each choice of the two parts to
leave out gives a signature of the others. Words of one length meet under these; words whose lengths differ by one agree in all parts
but one, and meet under the smaller signatures that leave one out, the longer word on one side and the shorter on the other. Two
words may meet under several signatures; only the first one they share lets the pair through, so no pair is made unique afterwards.
Every pair is verified by its edit distance. Words are distinct, so no word's frequency adds pairs; a signature that many words share
is a large key of an equi-join, which adaptive execution splits.

Words with null text are left out. A word table that repeats a word counts the sum of its rows. Ties among near words go to the
smallest in code-point order. A word of any length takes time linear in it. An empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, every: int = 31, occurrences: int = 2) -> DataFrame:
    """``word`` and ``n`` of all whole texts: runs of letters, A-Z lower-cased, of ``least`` code points and ``occurrences`` or more.

    Where ``every`` divides the crc32 of ``<key>:<run>``, the run's code point at that number modulo its length is left out first.
    Null text has no words; a null key is written as nothing."""
    run = F.explode(F.regexp_extract_all(F.translate(F.col(text).cast("string"), UPPER, LOWER), F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), run.alias("run"))
    drawn = runs.select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = drawn.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= occurrences)


def _elements(word: Column) -> Column:
    """Hashes of a word's (letter, occurrence) elements; each distinct."""
    times = lambda c: F.length(word) - F.length(F.replace(word, c, F.lit("")))
    letters = F.array_distinct(F.filter(F.split(word, ""), lambda c: c != ""))
    return F.flatten(F.transform(letters, lambda c: F.transform(F.sequence(F.lit(1), times(c).cast("int")), lambda k: F.xxhash64(c, k))))


def _packed(elements: Column, count: int) -> Column:
    """The parts of a word in one long: ``60 // count`` bits for each, the exclusive-or of its elements' hashes, so in no order.

    Parts that differ may get equal bits, which only lets more words meet."""
    bits = 60 // count
    term = lambda h: F.call_function("shiftleft", h.bitwiseAND(F.lit((1 << bits) - 1).cast("long")), (F.pmod(F.shiftright(h, 20), F.lit(count)) * bits).cast("int"))
    return F.aggregate(elements, F.lit(0).cast("long"), lambda x, h: x.bitwiseXOR(term(h)))


def _masks(count: int, out: int) -> list[tuple[tuple[int, ...], int]]:
    """Choices of ``out`` parts to leave out, each with the bits of the parts it keeps."""
    bits = 60 // count
    own = (1 << bits) - 1
    return [(left, sum(own << bits * p for p in range(count) if p not in left)) for left in combinations(range(count), out)]


def _signatures(parts: str, count: int, out: int, length: Column) -> Column:
    """Entries (at, signature): each leaves out ``out`` of ``count`` parts; ``length`` must agree as well."""
    kept = lambda mask: F.col(parts).bitwiseAND(F.lit(mask).cast("long"))
    return F.array(*(F.struct(F.lit(i).alias("at"), F.xxhash64(length, kept(mask)).alias("signature")) for i, (_, mask) in enumerate(_masks(count, out))))


def _first_shared(count: int, out: int) -> Column:
    """The number of the first signature that the parts of two rows (``a_parts``, ``b_parts``) share; null if none is."""
    differ = F.col("a_parts").bitwiseXOR(F.col("b_parts"))
    shared = [F.when(differ.bitwiseAND(F.lit(mask).cast("long")) == 0, i) for i, (_, mask) in enumerate(_masks(count, out))]
    return F.coalesce(*shared)


def near_words(words: DataFrame, parts: int = 6, parts_by_length: int = 4) -> DataFrame:
    """Pairs ``a``, ``b`` of words that differ by exactly one inserted, deleted or replaced code point, each once, with ``a_n``, ``b_n``.

    ``words``: word, n, each word once."""
    element = words.withColumn("elements", _elements(F.col("word")))
    own = element.select("word", "n", F.length("word").alias("length"), _packed(F.col("elements"), parts).alias("parts"), _packed(F.col("elements"), parts_by_length).alias("few"))
    own = stage(own, "variants-parts")
    named = lambda df, side, column: df.select("entry.*", *(F.col(c).alias(f"{side}_{c}") for c in ("word", "n")), F.col(column).alias(f"{side}_parts"))
    same = own.withColumn("entry", F.explode(_signatures("parts", parts, 2, F.col("length"))))
    longer, shorter = (own.withColumn("entry", F.explode(_signatures("few", parts_by_length, 1, F.col("length") + more))) for more in (0, 1))
    met = [
        named(same, "a", "parts").join(named(same, "b", "parts"), ["at", "signature"]).filter((F.col("a_word") < F.col("b_word")) & (_first_shared(parts, 2) == F.col("at"))),
        named(longer, "a", "few").join(named(shorter, "b", "few"), ["at", "signature"]).filter(_first_shared(parts_by_length, 1) == F.col("at")),
    ]
    columns = [F.col("a_word").alias("a"), F.col("b_word").alias("b"), "a_n", "b_n"]
    return met[0].select(*columns).unionByName(met[1].select(*columns)).filter(F.levenshtein("a", "b", 1) == 1)


def _roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) to word and root, by following each word's form as far as it goes, twice as far with each step.

    A form is more frequent than its word, so there are no rings."""
    links = stage(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(onward, "root", "left_semi").isEmpty():
            return links
        links = stage(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variants-roots")


def group_variants(words: DataFrame, ratio: int = 10, **options) -> DataFrame:
    """Every word of ``words`` (word, n) with its root and form, n, the number of its near words and the form's n.

    A word's form is its near word of largest n, if that is ``ratio`` times the word's or more."""
    words = stage(words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "variants-words")
    pairs = stage(near_words(words, **options), "variants-pairs")
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("best")
    near = pairs.select(F.explode(sides).alias("side")).select("side.*").groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left")
    has_form = -F.col("best.order") >= ratio * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.order")).alias("form_n"))
    found = stage(found, "variants-forms")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
