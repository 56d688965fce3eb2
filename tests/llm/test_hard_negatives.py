"""Hard negatives against all pairs in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import hard_negatives, queries

SMALL = "/root/testdata/sf0.001"


def plain(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    out, anchors = [], {(i, lab, tuple(v)) for i, lab, v in rows if is_anchor(i)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, v in anchors:
        scored = sorted((-dot(v, w), j, lab) for j, lab, w in rows)
        same = [(j, -s) for s, j, lab in scored if lab == label and j != i][:positives]
        for j, p in same:
            hard = [(k, -s) for s, k, lab in scored if lab != label and low * p <= 100 * -s <= high * p][:negatives]
            out += [(i, j, r + 1, k, p, n) for r, (k, n) in enumerate(hard)]
    return sorted(out)


def mined(spark, rows, every=100, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "id long, label long, v array<long>, no long, w string, score int")
    return sorted(map(tuple, hard_negatives.mine(frame.repartition(3), F.col("id") % every == 0, **options).collect()))


def test_embeddings_equal_brute_force(spark):
    kept = []
    for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding):
            kept.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * float(x)) for x in r.embedding]))
    got = queries.QUERIES["op11_hard_negatives"](spark, SMALL)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(kept, lambda i: i % 100 == 0)


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_in_many_slots(spark, monkeypatch, seed):
    """Small blocks: a first look, several rounds of thresholds, ties, zero and short vectors, one label with half of the rows."""
    monkeypatch.setattr(hard_negatives, "_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 4)
    rng = np.random.default_rng(seed)
    centres = rng.integers(-20, 20, (4, 10))
    rows = []
    for i in range(300):
        v = centres[rng.integers(4)] // (1 + i % 3) + rng.integers(-3, 4, 10)
        label = 0 if rng.random() < 0.5 else int(rng.integers(1, 6))
        rows.append((i, label, [int(x) for x in v[: 10 - (i % 17 == 0) * 4]] if i % 50 else [0] * 10))
    for options in ({}, {"positives": 2, "negatives": 7, "low": 30, "high": 95}):
        assert mined(spark, rows, 10, **options) == plain(rows, lambda i: i % 10 == 0, **options)


def test_pairs_at_equal_the_full_product():
    rng = np.random.default_rng(5)
    for dims, scale in ((0, 1), (1, 5), (7, 50), (40, 300)):
        q, x = rng.integers(-scale, scale + 1, (9, dims)), rng.integers(-scale, scale + 1, (60, dims)) // rng.integers(1, 30, (60, 1))
        full, allowed = q @ x.T, rng.random((9, 60)) < 0.7
        for share in (-0.5, 0.0, 0.3, 0.9):
            goal = (full.max(initial=0) * share * rng.random(9)).astype(np.int64)
            a, b, s = hard_negatives.pairs_at(q, x, goal, allowed)
            want = np.argwhere((full >= goal[:, None]) & allowed)
            assert sorted(zip(a, b, s)) == [(i, j, full[i, j]) for i, j in want]


def test_high_thresholds_leave_rows_and_dimensions_out():
    """What lies under the norms' bound is not in the index: the partial scores of such rows are never made."""
    q, x = np.array([[100, 1, 1]]), np.array([[90, 2, 0], [1, 1, 1], [0, 50, 50]])
    a, b, s = hard_negatives.pairs_at(q, x, np.array([9000]), np.ones((1, 3), bool))
    assert list(zip(a, b, s)) == [(0, 0, 9002)]


def test_nulls_repeats_and_few_rows(spark):
    rows = [(0, 1, [5, 5]), (0, 1, [5, 5]), (0, 1, [4, 4]), (1, 1, [5, 4]), (1, 1, [5, 4]), (2, 2, [4, 4]), (2, 2, [4, 4]), (3, 2, []), (100, 3, [1, 1])]
    extra = [(None, 1, [9, 9]), (7, None, [9, 9]), (8, 1, None)]
    assert mined(spark, rows + extra) == plain(rows, lambda i: i % 100 == 0)


def test_one_label_only_and_empty_table(spark):
    assert mined(spark, [(i, 1, [i, 1]) for i in range(20)]) == []
    assert mined(spark, []) == []


def test_vectors_too_large_for_exact_scores_raise(spark):
    with pytest.raises(Exception, match="squared norm"):
        mined(spark, [(0, 1, [1 << 30, 1 << 30]), (1, 1, [1, 1])])


def test_long_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [int(x) for x in rng.integers(-9, 10, 5000)]) for i in range(0, 300, 20)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 100 == 0)
