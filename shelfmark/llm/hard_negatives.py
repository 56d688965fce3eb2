"""Hard negatives by threshold joins in the manner of L2AP: rows of another label that score just below an anchor's positives.

Scores are integer inner products. Rows are packed into blocks that mostly hold one label; anchors, into smaller ones that meet every
block of rows. For a pair of blocks the dimensions are ordered by their weight in the block of rows. A row's last dimensions are left
out of the index where the product of the norms that remain there is under every threshold of the anchors' block, and a row that is
covered from its first dimension on is not in the index at all. Posting lists are accumulated into partial scores, each pair is
pruned by the norms that remain from there on, and only the pairs left are completed, exactly. Thresholds are per anchor. A first look
at one slot of the blocks gives thresholds that are sure to fill the windows; where it can't tell they start high. Anchors with
windows that are not full go on with lower thresholds, down to the windows' floors, so results are exact whatever the look gives.

Rows with a null id, label or vector take no part; vectors of unequal length are filled up with zeros. A vector's squared norm must be
below 2**53, which keeps all sums exact; others raise. Ties in score go by id. Rows that repeat an id are rows of their own; an anchor's
positives have another id than it. Anchors that are equal in id, label and vector count once. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage

_ROWS, _ANCHORS, _STEP, _PER_SLOT = 2048, 256, 8, 4
_LEAST = -(1 << 62)
_BLOCK = "least long, greatest long, n int, ids binary, labels binary, data binary"
_WANTED = f"{_BLOCK}, numbers binary, at binary, w binary, low binary, high binary"


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.float64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    if ((out * out).sum(1) >= 2.0**53).any():
        raise ValueError("a vector's squared norm is 2**53 or more: its scores would not be exact")
    return out.astype("<i4")


def _pieces(labels: np.ndarray, size: int) -> Iterator[slice]:
    """Cuts of sorted labels into at most ``size`` rows, at a label's end where a quarter is reached."""
    start, ends = 0, np.flatnonzero(np.append(labels[1:] != labels[:-1], True)) + 1
    while start < len(labels):
        near = ends[np.searchsorted(ends, start + size // 4) :]
        end = min(start + size, int(near[0]) if len(near) else len(labels))
        yield slice(start, end)
        start = end


def _pack(size: int) -> Callable:
    """Rows id, label, v (sorted by label), for anchors with no and windows, to blocks of at most ``size`` rows."""

    def pack(batches):
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("id", "label"))
            for own in _pieces(labels, size):
                part = batch.slice(own.start, own.stop - own.start)
                columns = {"least": int(labels[own].min()), "greatest": int(labels[own].max()), "n": len(part), "ids": ids[own].tobytes(),
                           "labels": labels[own].tobytes(), "data": _matrix(part.column("v")).tobytes()}
                if "windows" in batch.schema.names:
                    windows = part.column("windows")
                    fields = windows.flatten().flatten()
                    columns["numbers"] = part.column("no").to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                    columns["at"] = np.repeat(np.arange(len(part)), np.diff(windows.offsets.to_numpy())).astype("<i8").tobytes()
                    columns |= {c: x.to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c, x in zip(("w", "low", "high"), fields, strict=True)}
                types = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * (len(columns) - 3)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(columns.values(), types, strict=True)], list(columns))

    return pack


def _remaining(m: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on; one column more than dimensions."""
    out = np.zeros((len(m), m.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1])
    return out


def pairs_at(anchors: np.ndarray, rows: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Allowed pairs (anchor, row) whose score reaches the anchor's threshold, and the scores."""
    dims = max(anchors.shape[1], rows.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, dims - m.shape[1]))).astype(np.float64) for m in (anchors, rows))
    order = np.argsort(-(x * x).sum(0), kind="stable")
    q, x = q[:, order], x[:, order]
    rest_q, rest_x = _remaining(q), _remaining(x)
    goal = thresholds.astype(np.float64)
    with np.errstate(divide="ignore"):
        cover = np.where(rest_q > 0, goal[:, None] / np.where(rest_q > 0, rest_q, 1), np.where(goal > 0, np.inf, -np.inf)[:, None]).min(0)
    covered = rest_x * (1 + 1e-9) + 1e-6 < cover
    first = np.where(covered.any(1), covered.argmax(1), dims)  # the row's dimensions from here on are not indexed
    kept = np.flatnonzero((first > 0) | (dims == 0))
    indexed = np.minimum(-(-first // _STEP) * _STEP, dims)
    kept = kept[np.argsort(-indexed[kept], kind="stable")]
    x, indexed, rest_x = x[kept], indexed[kept], rest_x[kept]
    partial = np.zeros((len(q), len(kept)))
    for d in range(0, dims, _STEP):
        posted = int(np.searchsorted(-indexed, -d, "left"))  # rows whose index goes beyond d come first
        if posted:
            partial[:, :posted] += q[:, d : d + _STEP] @ x[:posted, d : d + _STEP].T
    bound = partial + rest_q[:, indexed] * rest_x[np.arange(len(kept)), indexed]
    at, of = np.nonzero((bound * (1 + np.sign(bound) * 1e-9) + 1e-3 >= goal[:, None]) & allowed[:, kept])
    scores = partial[at, of]
    left = np.flatnonzero(indexed[of] < dims)
    for part in np.array_split(left, -(-len(left) // 65536)) if len(left) else ():
        beyond = np.arange(dims) >= indexed[of[part], None]
        scores[part] += (q[at[part]] * np.where(beyond, x[of[part]], 0)).sum(1)
    scores = np.rint(scores).astype(np.int64)
    good = scores >= thresholds[at]
    return at[good], kept[of[good]], scores[good]


def _best(row: dict, k: int, same: bool) -> list[np.ndarray]:
    """For a pair of blocks: number, window, id and score of the first ``k`` rows inside each window."""
    of = lambda name, kind="<i8": np.frombuffer(row[name], kind)
    anchors, rows = (of(f"{side}data", "<i4").reshape(row[f"{side}n"], -1) for side in ("", "x_"))
    allowed = (of("labels")[:, None] == of("x_labels")) == same
    if same:
        allowed &= of("ids")[:, None] != of("x_ids")
    at, w, low, high = (of(c) for c in ("at", "w", "low", "high"))
    thresholds = np.full(len(anchors), 1 << 62, np.int64)
    np.minimum.at(thresholds, at, low)
    used = np.flatnonzero(thresholds < 1 << 62)
    a, x, scores = pairs_at(anchors[used], rows, thresholds[used], allowed[used])
    a, ids = used[a], of("x_ids")[x]
    order = np.lexsort((ids, -scores, a))
    a, ids, scores = a[order], ids[order], scores[order]
    begin, end = np.searchsorted(a, at, "left"), np.searchsorted(a, at, "right")
    taken, sizes = [], []
    for b, e, lo, hi in zip(begin.tolist(), end.tolist(), low.tolist(), high.tolist(), strict=True):
        own = -scores[b:e]
        first, last = b + np.searchsorted(own, -hi, "left"), b + np.searchsorted(own, -lo, "right")
        taken.append(np.arange(first, max(first, min(last, first + k))))
        sizes.append(len(taken[-1]))
    taken = np.concatenate([*taken, np.zeros(0, np.int64)]).astype(np.int64)
    return [np.repeat(of("numbers")[at], sizes), np.repeat(w, sizes), ids[taken], scores[taken]]


def search(anchors: DataFrame, blocks: DataFrame, slots: range, of: int, k: int, same: bool) -> DataFrame:
    """The first ``k`` rows of every window of every anchor among the blocks of ``slots`` (``of`` in all): no, w, id, score, rank.

    ``anchors``: no, id, label, v, windows (w, low, high). ``same``: rows of the anchor's label but other id, else rows of other labels."""

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = _best(row, k, same)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["no", "w", "id", "score"])

    packed = anchors.select("id", "label", "v", "no", "windows").sortWithinPartitions("label").mapInArrow(_pack(_ANCHORS), _WANTED)
    dealt = packed.withColumn("slot", F.explode(F.sequence(F.lit(slots[0]), F.lit(slots[-1])))).repartition(of, "slot")
    rows = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(of)).cast("int")).filter(F.col("slot").between(slots[0], slots[-1]))
    rows = rows.select("slot", *(F.col(c).alias(f"x_{c}") for c in ("least", "greatest", "n", "ids", "labels", "data"))).repartition(of, "slot")
    on = dealt["slot"] == rows["slot"]
    if same:
        on = on & (dealt["least"] <= rows["x_greatest"]) & (rows["x_least"] <= dealt["greatest"])
    met = dealt.join(rows.hint("merge"), on).drop("slot").mapInArrow(meet, "no long, w long, id long, score long")
    first = Window.partitionBy("no", "w").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    entry = F.struct("w", "low", "high")
    return anchors.join(windows.groupBy("no").agg(F.sort_array(F.collect_list(entry)).alias("windows")), "no")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its first ``positives`` other rows of its label, the first ``negatives`` rows of other labels whose
    score lies between ``low`` and ``high`` per cent of the positive's: anchor_id, positive_id, rank, negative_id, both scores.

    ``rows``: id, label, v (array of integers); ``is_anchor`` tells the anchors among them."""
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<long>")).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    anchors = stage(rows.filter(is_anchor).distinct().withColumn("no", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = rows.sortWithinPartitions("label").mapInArrow(_pack(_ROWS), _BLOCK)
    blocks = stage(blocks.withColumn("block", F.monotonically_increasing_id()), "negatives-blocks")
    of = max(1, -(-blocks.count() // _PER_SLOT))
    every, look = range(of), range(1)

    def sure(windows: DataFrame, k: int, same: bool, otherwise: Column) -> DataFrame:
        """``windows`` with the score of the k-th row inside one slot, which the windows reach for sure, as ``start``."""
        if of < 8:
            return windows.withColumn("start", otherwise)
        seen = search(_with_windows(anchors, windows), blocks, look, of, k, same).filter(F.col("rank") == k)
        return windows.join(seen.select("no", "w", F.col("score").alias("seen")), ["no", "w"], "left").withColumn("start", F.coalesce("seen", otherwise)).drop("seen")

    whole = anchors.select("no", F.lit(0).cast("long").alias("w"), F.lit(_LEAST).alias("low"), F.lit(-_LEAST).alias("high"))
    begun = sure(whole, positives, True, F.lit(_LEAST)).select("no", "w", F.col("start").alias("low"), "high")
    best = search(_with_windows(anchors, begun), blocks, every, of, positives, True)
    best = stage(best.select("no", F.col("rank").cast("long").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    least = F.expr(f"(positive_score * {low} + pmod(-positive_score * {low}, 100)) div 100")
    most = F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100")
    windows = best.select("no", "w", least.alias("low"), most.alias("high")).filter("low <= high")
    windows = stage(sure(windows, negatives, False, F.expr("low + (high - low) div 2")), "negatives-windows")
    found = None
    while found is None or not windows.isEmpty():
        now = windows.select("no", "w", F.col("start").alias("low"), "high")
        got = stage(search(_with_windows(anchors, now), blocks, every, of, negatives, False), "negatives-found")
        counts = got.groupBy("no", "w").agg(F.count("*").alias("n"))
        windows = windows.join(counts, ["no", "w"], "left").withColumn("full", (F.coalesce("n", F.lit(0)) >= negatives) | (F.col("start") <= F.col("low")))
        windows = stage(windows.drop("n"), "negatives-windows")
        got = got.join(windows.filter("full").select("no", "w"), ["no", "w"])
        found = got if found is None else found.unionByName(got)
        windows = windows.filter("NOT full").drop("full").withColumn("start", F.greatest("low", F.expr("high - 2 * (high - start) - 1")))
    named = found.join(best, ["no", "w"]).join(anchors.select("no", F.col("id").alias("anchor_id")), "no")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
