"""Operator 2 and the components against brute force."""

import itertools
import random

from shelfmark.llm import chosen_path
from shelfmark.llm.components import components


def shingles(text, n=5):
    words = (text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def plain(rows, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in rows]
    links, label = {i: 0 for i, _ in sets}, {i: i for i, _ in sets}
    pairs = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and 5 * len(x & y) >= 4 * len(x | y)]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (label[i], links[i]) for i in label}


def got(df, **options):
    return {r["key"]: (r["class_id"], r["n_links"]) for r in chosen_path.near_duplicates(df, **options).collect()}


def corpus(seed, families, copies):
    rng = random.Random(seed)
    rows = [None, "", "one", "one", "a b c d", "a b c d", "x y z x y z x y z"]
    for _ in range(families):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 9999)}"
            rows.append(" ".join(words))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t) for i, t in enumerate(rows)]


def test_equals_brute_force(documents):
    rows = corpus(1, 60, 8)
    assert got(documents([(i, t, "s") for i, t in rows])) == plain(rows)


def test_large_groups_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(chosen_path, "_BLOCK_SETS", 16)
    rows = corpus(2, 3, 150)
    assert got(documents([(i, t, "s") for i, t in rows]), bucket=4) == plain(rows)


def test_keep_one(documents):
    rows = corpus(3, 30, 5)
    df = documents([(i, t, "s") for i, t in rows])
    left = chosen_path.keep_one(df)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {i for i, (c, _) in plain(rows).items() if i == c}


def test_repeated_rows_and_empty_table(documents):
    text = " ".join(map(str, range(30)))
    df = documents([(3, text, "s"), (3, text, "s"), (4, text, "s")])
    assert sorted(tuple(r) for r in chosen_path.near_duplicates(df).collect()) == [(3, 3, 3, 2), (3, 3, 3, 2), (4, 3, 3, 2)]
    assert got(df.filter("false")) == {}


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 150)] + [(1000 + rng.randint(0, 300), 1000 + rng.randint(0, 300)) for _ in range(260)]
    label = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    alone = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == {n: c for n, c in label.items() if n not in alone} and len(rows) == len(label) - len(alone)
