"""The quality classifier: held-out accuracy, its risk against a plain search, its sums against numpy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import pu_quality, queries

TENTH = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op12_pu_quality"](spark, TENTH)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.toPandas().merge(spark.read.parquet(f"{TENTH}/labels.parquet").toPandas(), "left", "doc_id")
    assert len(rows) == spark.read.parquet(f"{TENTH}/documents.parquet").count()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    held = rows[rows.held_out & rows.quality.notna()]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert len(bad) > 10 and (good[:, None] > bad).mean() > 0.99
    assert ((held.predicted == held.quality).mean()) > 0.97


def test_labels_of_the_held_out_fold_and_negatives_teach_nothing(spark, tmp_path):
    """Other labels on held-out rows, and other negatives, give the same scores."""
    labels = spark.read.parquet(f"{TENTH}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).filter(held | (F.col("quality") == 1))
    spark.read.parquet(f"{TENTH}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    turned.write.parquet(f"{tmp_path}/labels.parquet")
    scores = lambda at: dict(queries.QUERIES["op12_pu_quality"](spark, at).select("doc_id", "score").collect())
    assert scores(str(tmp_path)) == pytest.approx(scores(TENTH), abs=2e-6)


def risk(p, u, prior, w, ridge=0.0):
    l = lambda x, sign: ((1 - sign * (x @ w)) ** 2 / 4).mean()  # noqa: E731, E741
    return prior * l(p, 1) + max(0.0, l(u, -1) - prior * l(p, -1)) + ridge * w @ w / 4


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_minimum_of_the_non_negative_risk(prior):
    rng = np.random.default_rng(1)
    one = lambda x: np.column_stack([np.ones(len(x)), x])
    p = one(rng.normal(1, 1, (300, 3)))
    u = one(np.concatenate([rng.normal(1, 1, (150, 3)), rng.normal(-1, 1, (250, 3))]))
    w = pu_quality.minimise(p.T @ p / len(p), u.T @ u / len(u), prior)
    least = risk(p, u, prior, w, 1e-4)
    for _ in range(3000):  # the risk is convex: no step, small or large, lowers it
        assert risk(p, u, prior, w + rng.normal(0, 10 ** rng.uniform(-5, 0.5), 4), 1e-4) >= least - 1e-9


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.9):
        bins = lambda x: np.histogram(x, 100, (-6, 6))[0]
        u = np.concatenate([rng.normal(2, 1, int(20000 * share)), rng.normal(-2, 1, int(20000 * (1 - share)))])
        assert pu_quality.estimate_prior(bins(rng.normal(2, 1, 20000)), bins(u)) == pytest.approx(share, abs=0.06)


def test_sums_equal_numpy(spark, documents):
    texts = [None, "", "a b c", "x\ny\nx\n", "### 12 $$$ " * 50, "Eine kurze Zeile, ÄÖÜ 😀.\n" * 20, "w" * 3000]
    rows = pu_quality.featurise(documents(texts)).withColumn("trusted", F.col("key") % 2 == 0)
    x = np.array([pu_quality.features((t or "").encode()).astype("<f2") for t in texts], np.float64)
    both = pu_quality._moments(rows)
    assert np.allclose(both[1], x.T @ x) and np.allclose(both[0], x[::2].T @ x[::2])


def test_pieces_of_a_long_text_join(monkeypatch):
    text = ("Some words, 12 numbers;\n\n  and a line || more.\n" * 40 + "äöü").encode()
    whole = pu_quality.features(text)
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(pu_quality, "_PIECE", size)
        assert np.array_equal(pu_quality.features(text), whole)


def test_nulls_repeats_empty_tables_and_nothing_to_learn(spark, documents):
    docs = documents([(1, None, "s"), (1, "good text here", "s"), (None, "no id", "s"), (2, "", "s"), (2, "", "s"), (3, "word " * 100000, "s")])
    ids = lambda rows: spark.createDataFrame(rows, "key long, other string")
    held = F.col("key") == 2
    got = pu_quality.learn_and_score(docs, ids([(1, "x"), (1, "x"), (None, "y")]), held).collect()
    assert sorted((str(r.key), r.held_out) for r in got) == [("1", False), ("1", False), ("2", True), ("2", True), ("3", False), ("None", False)]
    assert all(0 <= r.score <= 1 for r in got)
    assert {(r.score, r.predicted) for r in pu_quality.learn_and_score(docs, ids([]), held).collect()} == {(0.5, 1)}
    assert pu_quality.learn_and_score(docs.limit(0), ids([(1, "x")]), held).collect() == []
