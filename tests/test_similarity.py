import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from shelfmark.functions.similarity import score_long_pairs, tfidf_cosine, tokens
from shelfmark.operators import candidates
from shelfmark.operators.candidates import retrieve
from shelfmark.operators.matching import best_candidate, long_scores_of_wide
from shelfmark.operators.matching import augment, match_wide, similarity_table


def cosine(a, b):
    """The score the long way: fit idf on the two texts, normalize, multiply."""
    ca, cb = (Counter(re.findall(r"\w\w+", t.lower())) for t in (a, b))
    idf = {w: math.log(3 / (1 + (w in ca) + (w in cb))) + 1 for w in ca | cb}
    dot = sum(ca[w] * cb[w] * idf[w] ** 2 for w in idf)
    norms = [math.sqrt(sum((c[w] * idf[w]) ** 2 for w in c)) for c in (ca, cb)]
    return dot / (norms[0] * norms[1]) if dot else 0.0


def random_titles(n, words, longest, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(words)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(1, longest))) for _ in range(n)]


def test_vectors(spark):
    rows = [
        ("prime beef burger 1kg x10", "prime beef burger 1kg", 0.818), ("tea tea lipton", "lipton tea", 0.949),
        ("Same Words", "same words", 1.0), ("x y", "lipton tea", 0.0), ("a b", "c d", 0.0), ("Crème brûlée", "crème", 0.58),
    ]
    df = spark.createDataFrame(rows, "a string, b string, s double").withColumns({"x": tokens("a"), "y": tokens("b")})
    got = [r[0] for r in df.select(F.round(tfidf_cosine("x", "y"), 3)).collect()]
    assert got == [r[2] for r in rows]
    assert got[-1] == round(cosine(*rows[-1][:2]), 3)


def test_short_and_long_forms_agree_with_the_definition(spark):
    left, right = random_titles(200, 30, 12, 1), random_titles(200, 30, 12, 2)
    df = spark.createDataFrame(list(zip(range(200), left, right)), "k int, a string, b string")
    df = df.withColumns({"x": tokens("a"), "y": tokens("b")})
    short = {r.k: r.s for r in df.select("k", tfidf_cosine("x", "y").alias("s")).collect()}
    long = {r.k: r.similarity for r in score_long_pairs(df, ["k"], "x", "y").collect()}
    for k, (a, b) in enumerate(zip(left, right)):
        assert math.isclose(short[k], cosine(a, b), abs_tol=1e-9)
        assert math.isclose(long[k], cosine(a, b), abs_tol=1e-9)


def brute_force(records, items, threshold, top=5):
    found = set()
    for i, title in records:
        scored = [(round(cosine(title, t), 9), key) for key, t in items]
        best = sorted(((s, k) for s, k in scored if s >= threshold), key=lambda x: (-x[0], x[1]))[:top]
        found |= {(i, rank + 1, key, s) for rank, (s, key) in enumerate(best)}
    return found


def check_retrieval(spark, records, items, threshold=0.6, longest=32):
    rec = spark.createDataFrame(records, "id int, title string")
    cat = spark.createDataFrame([(k, f"u{k}", t) for k, t in items], "key int, url string, title string")
    got = {(r["id"], r["rank"], r["key"], round(r["similarity"], 9)) for r in retrieve(rec, cat, threshold, longest=longest).collect()}
    want = brute_force(records, items, threshold)
    assert {g[:3] for g in got} == {w[:3] for w in want}
    assert all(any(g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-6 for w in want) for g in got)
    assert want


def test_retrieval_equals_brute_force(spark):
    records = list(enumerate(random_titles(150, 25, 7, 3)))
    items = list(enumerate(random_titles(200, 25, 7, 4)))
    check_retrieval(spark, records, items)


def test_retrieval_with_long_titles_equals_brute_force(spark):
    records = list(enumerate(random_titles(60, 40, 14, 5)))
    items = list(enumerate(random_titles(80, 40, 14, 6)))
    check_retrieval(spark, records, items, threshold=0.5, longest=5)


def test_retrieval_with_a_third_of_all_titles_equal(spark):
    records = list(enumerate(["red plate"] * 60 + random_titles(120, 20, 5, 7)))
    items = list(enumerate(["plate red"] * 70 + random_titles(140, 20, 5, 8)))
    check_retrieval(spark, records, items)


def test_titles_that_differ_in_one_rare_token_do_not_all_meet(spark):
    records = [(i, f"acme widget sku{i}") for i in range(400)] + [(400, "acme widget")]
    items = [(i, f"widget acme sku{i * 2}") for i in range(400)]
    rec = spark.createDataFrame(records, "id int, title string")
    cat = spark.createDataFrame([(k, f"u{k}", t) for k, t in items], "key int, url string, title string")
    got = {(r["id"], r["key"]) for r in retrieve(rec, cat).collect()}
    assert got == {(i, i // 2) for i in range(0, 400, 2)} | {(400, k) for k in range(5)}


def pairs_made(spark, monkeypatch, records, items, threshold=0.6, step="_top_pairs"):
    """Number of pairs that a step of retrieval scores; the result must be right."""
    made = []
    whole = getattr(candidates, step)
    monkeypatch.setattr(candidates, step, lambda *a, **k: made.append(whole(*a, **k)) or made[-1])
    check_retrieval(spark, records, items, threshold)
    return made[0].count()


def test_titles_of_one_template_make_few_pairs(spark, monkeypatch):
    """All pairs of titles score alike; the pairs made grow with the titles, not with their square."""
    titles = lambda n, step: [(i, f"acme steel widget blue no{i * step}") for i in range(n)]
    made = [pairs_made(spark, monkeypatch, titles(n, 1), titles(n, 3)) for n in (200, 400)]
    assert made[1] < 2.5 * made[0] and made[1] < 400 * 12


def test_templates_of_several_lengths_equal_brute_force(spark, monkeypatch):
    """Crowded places within crowded places: common tokens, some shared by a part of the titles only."""
    rng = random.Random(9)
    words = "acme steel widget blue heavy duty outdoor".split()
    title = lambda: " ".join([w for w in words if rng.random() < 0.85] + [f"no{rng.randrange(60)}"] * (rng.random() < 0.8))
    records, items = ([(i, title()) for i in range(n)] for n in (250, 300))
    monkeypatch.setattr(candidates, "_CROWDED", 2)
    for threshold in (0.6, 0.35):
        check_retrieval(spark, records, items, threshold)


def test_long_texts_make_few_pairs(spark, monkeypatch):
    """Where two long texts meet under a token, most pairs cannot reach the threshold any more."""
    rng = random.Random(4)
    common, rare = [f"c{i}" for i in range(60)], [f"r{i}" for i in range(4000)]
    text = lambda n: rng.sample(common, 25) + rng.choices(rare, k=n)
    texts = [text(rng.randint(20, 60)) for _ in range(80)]
    near = [[w if rng.random() < 0.8 else rng.choice(rare) for w in t] for t in texts[:40]]
    records, items = ([(i, " ".join(t)) for i, t in enumerate(ts)] for ts in (texts, near + [text(40) for _ in range(60)]))
    assert pairs_made(spark, monkeypatch, records, items, step="_long_pairs") < 0.1 * 80 * 100


def test_numbered_bags_hold_terms_and_no_text(spark):
    """Each token of a long text used to carry the whole text into a shuffle, and the text stayed with the terms."""
    bags = spark.createDataFrame([("a a b c", True, False, 1), ("a b", False, True, 2), ("a", True, True, 3)], "bag string, is_record boolean, is_item boolean, item_key int")
    numbered = candidates._number_bags(bags)
    assert "bag" not in numbered.columns
    hashes = spark.range(1).selectExpr("xxhash64('a') AS a", "xxhash64('b') AS b", "xxhash64('c') AS c").first()
    got = {r.item_key: ([(t.token, t.tf) for t in r.terms], r.length) for r in numbered.collect()}
    assert got == {1: ([(hashes.c, 1), (hashes.b, 1), (hashes.a, 2)], 4), 2: ([(hashes.b, 1), (hashes.a, 1)], 2), 3: ([(hashes.a, 1)], 1)}
    assert numbered.select("bag_id").distinct().count() == 3


def test_short_texts_do_not_meet_by_single_tokens(spark, monkeypatch):
    """Where no text is long, the join for long texts gets no rows; all short texts with a common token used to meet there."""
    left = [(i, f"acme steel widget no{i}") for i in range(50)]
    seen = []
    whole = candidates.likely_in
    monkeypatch.setattr(candidates, "likely_in", lambda rows, h, keys, k: seen.append((rows, keys)) or whole(rows, h, keys, k))
    check_retrieval(spark, left, left)
    assert [rows.isEmpty() or keys.isEmpty() for rows, keys in seen] == [True, True]


def test_places_are_made_once(spark, monkeypatch):
    """The keys of titles used to be made anew for each of the three reads of a round."""
    plans = []
    whole = candidates._crowded
    monkeypatch.setattr(candidates, "_crowded", lambda *sides: plans.extend(x._jdf.queryExecution().executedPlan().toString() for x in sides) or whole(*sides))
    titles = [(i, f"acme steel widget blue no{i}") for i in range(100)]
    check_retrieval(spark, titles, titles)
    assert len(plans) >= 4 and not any("Generate" in p for p in plans)


def test_long_pairs_hold_no_table_of_tokens(spark):
    """Repeats on either side, empty and null texts, and rows of one key, which are one pair; tokens never become rows."""
    rows = [(1, "a a b c", "a b b d"), (2, "a", "b"), (3, "", ""), (4, None, "a"), (5, "x y", "x y"), (6, "a b", "a"), (6, "c", "b c c"), (None, "a", "a b")]
    df = spark.createDataFrame(rows, "k int, x string, y string")
    scored = score_long_pairs(df, ["k"], "filter(split(x, ' '), t -> t <> '')", "filter(split(y, ' '), t -> t <> '')")
    assert "Generate" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.similarity for r in scored.collect()}
    want = {1: ("aa aa bb cc", "aa bb bb dd"), 2: ("aa", "bb"), 5: ("xx yy", "xx yy"), 6: ("aa bb cc", "aa bb cc cc"), None: ("aa", "aa bb")}
    assert set(got) == {*want, 3, 4} and got[3] == got[4] == 0.0
    assert all(abs(got[k] - cosine(*w)) < 1e-9 for k, w in want.items())


def test_best_candidate_scores_each_pair_once(spark):
    """A filter on the score used to move below the scoring, which was then made again in it."""
    df = wide(spark, ("red tea", ["tea red", "blue", None]), ("red", ["blue"]), ("", ["blue"]))
    best = best_candidate(long_scores_of_wide(df))
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert not any("array_intersect" in line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter"))
    assert sum("array_intersect" in line for line in plan.splitlines()) == 1
    assert [tuple(r) for r in best.collect()] == [("0", "u1", 1.0)]


WIDE = "id string, serial_number string, input_title string, " + ", ".join(
    f"url_{r} string, url_{r}_title string" for r in range(1, 6)
) + ", scraped_date string"


def wide(spark, *records):
    rows = []
    for i, (title, candidates) in enumerate(records):
        slots = [x for r in range(5) for x in (f"u{r + 1}", candidates[r] if r < len(candidates) else None)]
        rows.append((str(i), f"S{i}", title, *slots, "2025-01-01 00:00:00"))
    return spark.createDataFrame(rows, WIDE)


def test_match_edges(spark):
    df = wide(
        spark,
        (" lipton tea ", ["tea lipton", "", "lipton tea"]),  # tie: the lower rank wins
        ("lipton tea", ["coffee beans"]),  # all zero
        ("lipton tea", []),  # no candidate
        ("not available", ["Not Available"]),  # the sentinel text is a title
        ("tea lipton yellow", [None, "tea pot"]),  # below the threshold
    )
    got = [(r.input_title, r.matched_url, r.status) for r in match_wide(df).orderBy("id").collect()]
    none = "Not available everywhere"
    assert got == [
        ("lipton tea", "u1", "Available"), ("lipton tea", none, "Not Available"), ("lipton tea", none, "Not Available"),
        ("not available", "u1", "Available"), ("tea lipton yellow", none, "Not Available"),
    ]
    scores = augment(df).orderBy("id").collect()
    assert scores[0].url_2_similarity is None and scores[0].url_3_similarity == 1.0
    assert scores[1].url_1_similarity == 0.0 and scores[2].best_similarity == 0.0


def test_variant_table_keeps_empty_slots(spark):
    row = similarity_table(wide(spark, ("the tea", ["the tea pot"])), "2025-02-03 04:05:06", ["the"]).first()
    assert len(row) == 20
    assert row.url_1_similarity == round(cosine("tea", "tea pot"), 3) and row.url_2_similarity is None
    assert row.processed_date == "2025-02-03 04:05:06"


def test_scoring_stays_in_the_row(spark):
    plan = match_wide(wide(spark, ("a", [])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
