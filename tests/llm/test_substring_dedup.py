"""Operator 5 against a plain version that looks every window up in a dictionary."""

import hashlib
import random
import re

import pytest

from shelfmark.llm import substring_dedup


def plain(rows, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in sorted(rows)}
    first, out = {}, {}
    for i, w in words.items():
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), (i, p))
    for i, w in words.items():
        gone = {p + k for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] != (i, p) for k in range(window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def got(df, **options):
    return {r["key"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(df, **options).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(documents, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "\u00e9t\u00e9", "x\u00a0y", "w\x1cv", *(f"w{i}" for i in range(300))])
    passages = [[word() for _ in range(rng.randint(15, 70))] for _ in range(12)]
    texts = [None, "", " \n", "one two", "same " * 100, "same " * 19, "p q " * 40]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, len(p))
                parts += p[a : a + rng.randint(5, 70)]
            else:
                parts += [word() for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
    texts += texts[20:30]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(order[i], t, "s") for i, t in enumerate(texts)]
    assert got(documents(rows)) == plain([(i, t) for i, t, _ in rows], 20)


def test_repeated_rows_are_one_document(documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = substring_dedup.remove_repeats(documents([(4, text, "s"), (4, text, "s"), (5, text, "s")])).collect()
    assert sorted((r["key"], r["n_removed"]) for r in rows) == [(4, 0), (4, 0), (5, 30)]
    assert all(r["kept"] == ("" if r["key"] == 5 else text) for r in rows)


def test_rows_with_a_null_id_are_the_first_document(documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = substring_dedup.remove_repeats(documents([(None, text, "s"), (None, text, "s"), (None, None, "s"), (-5, text, "s"), (4, "x " + text, "s")])).collect()
    assert sorted((str(r["key"]), r["n_words"], r["n_removed"]) for r in rows) == [("-5", 30, 30), ("4", 31, 30), ("None", 0, 0), ("None", 30, 0), ("None", 30, 0)]


def test_windows_differ_where_one_of_two_hashes_does():
    import numpy as np

    entries = {"hashes": np.array([7, 7, 7, 9], np.uint64), "second": np.array([1, 2, 1, 1], np.uint64), "doc": np.array([3, 4, 5, 6]), "place": np.array([0, 0, 0, 0])}
    assert substring_dedup._starts_earlier(entries).tolist() == [False, False, True, False]


def test_empty_table(documents):
    assert got(documents(["x"]).filter("false")) == {}
