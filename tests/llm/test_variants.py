"""Spelling variants against every pair of words in plain Python."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfmark.llm import queries, variants

SMALL = "/root/testdata/sf0.001"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_groups(counts, ratio=10):
    by_length, out, forms = {}, {}, {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    for w, n in counts.items():
        mates = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(size, ()) if near(w, v)]
        best = min(mates, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= ratio * n else None
        out[w] = (forms[w], n, len(mates), counts[best] if forms[w] else None)
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (w, out[w][0], root, *out[w][1:])
    return set(out.values())


def rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def grouped(spark, counts, **options):
    return rows(variants.group_variants(spark.createDataFrame(list(counts.items()) or [], "word string, n long"), **options))


def test_documents_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.QUERIES["op13_variants"](spark, SMALL))
    assert len(got) == len(set(got)) and set(got) == plain_groups(plain_words(docs))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abcéÿ×", min_size=1, max_size=9), st.integers(1, 3000), min_size=1, max_size=60), st.sampled_from([(6, 4), (3, 2), (5, 3)]))
def test_any_words_equal_brute_force(spark, counts, parts):
    """Few letters: anagrams, repeated letters and chains of forms abound."""
    got = grouped(spark, counts, parts=parts[0], parts_by_length=parts[1])
    assert len(got) == len(counts) and set(got) == plain_groups(counts)


def test_chain_of_forms_ends_at_the_last(spark):
    counts = {"a" * 7 + "b" * k: 10**k for k in range(12)}
    assert {r[2] for r in grouped(spark, counts)} == {"a" * 7 + "b" * 11}


def test_one_centre_with_every_replacement(spark):
    """A hot signature: all words of one length that differ from a frequent one in a single place."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    counts = {f"kernel{x}{y}": 1 + (x > "m") for x in letters for y in letters}
    counts["kernelaa"] = 5000
    assert set(grouped(spark, counts)) == plain_groups(counts)


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = "z" * 5000
    docs = [(1, f"Keyboard keyboard {long}y"), (1, f"Keyboard keyboard {long}y"), (None, "keyboard"), (None, None), (2, ""), (3, f"{long} {long} keyboards keyboards")]
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, n long, word string")
    counts = plain_words(docs)
    assert {r.word: r.n for r in variants.count_words(frame).collect()} == counts
    assert set(rows(variants.group_variants(variants.count_words(frame)))) == plain_groups(counts)
    assert near(f"{long}y", long) and any(r[4] for r in plain_groups(counts) if len(r[0]) == 5000)


def test_repeated_and_null_words_of_a_word_table(spark):
    frame = spark.createDataFrame([("kernel", 3), ("kernel", 4), (None, 9)], "word string, n long")
    assert rows(variants.group_variants(frame)) == [("kernel", None, "kernel", 7, 0, None)]


def test_empty_tables(spark):
    assert rows(variants.group_variants(variants.count_words(spark.createDataFrame([], "doc_id long, text string")))) == []


@pytest.mark.parametrize("count, out", [(6, 2), (4, 1), (3, 2)])
def test_every_signature_is_first_once(count, out):
    """Vectors that differ in any set of at most ``out`` parts share a signature."""
    masks = variants._masks(count, out)
    for differ in range(1 << count):
        if bin(differ).count("1") <= out:
            assert any(all(p in left for p in range(count) if differ >> p & 1) for left, _ in masks)
