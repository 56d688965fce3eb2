"""Operator 4: copies, re-parameterised questions and chance overlaps, and a plain search for copies."""

import random

import pytest

from shelfmark.llm import decontaminate

ITEMS = [
    (0, "A farmer named Olga sells 12 eggs for 3 dollars each day. How much money does Olga earn in 7 days if every egg is sold?"),
    (1, "A farmer named Olga sells 15 eggs for 4 dollars each day. How much money does Olga earn in 9 days if every egg is sold?"),
    (2, "The quick brown fox jumps over lazy dogs while seven wizards quietly brew strong coffee near the old harbour."),
    (3, "short one here now"), (4, "too short"), (5, None), (6, ""),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, key string")


def leaks(df, items, **options):
    return {(r["key"], r["item_id"]): r for r in decontaminate.find_leaks(df, items, **options).collect()}


def test_copies_and_other_values(documents, items):
    other = "So: a farmer named Ivan sells 31 eggs for 2 dollars each day. How much money does Ivan earn in 5 days if every egg is sold? End."
    mixed = other.replace("does Ivan", "does Anna")  # one slot, two values
    texts = [f"before it {ITEMS[2][1]} and after", other, mixed, ITEMS[0][1].upper(), "nothing of the kind is in this text at all", None, "",
             "say short one here now again", "the quick brown fox jumps over other things entirely", ITEMS[1][1], ITEMS[1][1]]
    rows = [*((i, t, "s") for i, t in enumerate(texts)), (0, texts[0], "s")]
    got = leaks(documents(rows), items)
    assert set(got) == {(0, 2), (1, 0), (7, 3), (9, 0), (10, 0)} | ({(3, 0)} if (3, 0) in got else set())
    assert got[0, 2]["same_values"] and not got[1, 0]["same_values"] and got[1, 0]["n_items"] == 2
    kept = decontaminate.drop_contaminated(documents(rows), items)
    assert {r["doc_id"] for r in kept.collect()} == set(range(11)) - {d for d, _ in got} and "spans" in kept.columns


def test_capitals_line_breaks_and_first_words(documents, spark):
    bench = [*ITEMS[:3], (10, "Olga buys 5 red apples at market. Olga eats 2 green apples at home. Olga sells 3 old apples at school. How many apples are left?"),
             (11, "Paris Lyon Marseille Toulouse Nice Nantes Strasbourg Montpellier Bordeaux Lille"), (12, "Water boils at sea level"),
             (13, "She picked every flower beside that river\nMorning came and nobody saw them leave again")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    ivan = bench[3][1].replace("Olga", "Ivan").replace("5 red", "6 red")
    texts = [ITEMS[0][1].upper(), ITEMS[2][1].title(), ITEMS[1][1].upper(), ivan, f"cities are {bench[4][1]} and others", "we know that Water boils at sea level here",
             bench[6][1].replace("\n", " "), ivan.replace("Ivan eats", "Anna eats"), "nothing of the kind is in this text at all"]
    got = {k: r["same_values"] for k, r in leaks(documents(texts), items).items()}
    assert got == {(0, 0): True, (1, 2): True, (2, 0): True, (3, 10): False, (4, 11): True, (5, 12): True, (6, 13): True}


def test_planted_copies_in_random_text(documents, spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randint(0, 400)}x"
    bench = [(i, " ".join(word() for _ in range(rng.randint(15, 50)))) for i in range(30)]
    texts, want = [], set()
    for i in range(200):
        words = [word() for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.3:
            item, text = rng.choice(bench)
            at = rng.randint(0, len(words))
            words[at:at] = text.split()
            want.add((i, item))
        texts.append(" ".join(words))
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert set(leaks(documents(texts), items)) == want
    assert set(leaks(documents(texts), items, filter_bits=1 << 10)) == want  # a filter that lets nearly everything through


def test_empty_tables(documents, items):
    df = documents(["x"])
    assert leaks(df.filter("false"), items) == {} and leaks(df, items.filter("false")) == {}
