"""N-gram Jaccard join by chosen paths: near-duplicate documents and the number of their links.

Documents are sets of hashed word shingles; documents with equal sets are one class from the start. A set's MinHash values are
samples of its tokens, and sets that agree on one share a sampled token. Each run splits all classes by one sampled token, splits
what is still large by the next, and so on along the run's own path of samples; a bucket that is small is compared by brute
force on its signatures, and one that stays large through ``depth`` splits (sets that agree on all of these are alike) is joined
up whole. Runs repeat until a pair at the threshold is missed with less than ``1 - recall`` probability. That chooses candidates;
then every group of connected candidates is compared exactly, all against all, on whole shingle sets.

Exact comparison counts links inside tasks: no pair is ever a row. A group is dealt into blocks of bounded size, each pair of
blocks is one task's matrix product, so large groups of near copies are spread and a task's memory does not grow. The work in a
group of n different near copies remains of the order n^2 (that many links are counted); copies with equal sets cost nothing.

A text with fewer words than a shingle is one shingle of all its words; texts without words (null, empty) link to nothing.
Rows that repeat a doc_id must repeat its text; each counts as a document. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.llm.scratch import stage
from shelfmark.llm.words import WordHashes, hash_words, in_chunks, inside, mix, windows

_SAMPLES = 64
_MULTIPLIERS = mix(np.arange(1, _SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BLOCK_SETS, _BLOCK_TOKENS = 512, 1 << 20


def shingle_sets(texts: list[bytes], known: WordHashes, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, starts = hash_words(texts, known)
    rolling, ok = windows(hashes, n), inside(starts, n)
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= n:
            sets.append(np.unique(rolling[a : b - n + 1][ok[a : b - n + 1]]))
        else:
            sets.append(windows(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def signature(tokens: np.ndarray) -> np.ndarray:
    """MinHash values of a set, as 32 bits each."""
    low = np.full(_SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(tokens), 4096):
        low = np.minimum(low, (tokens[a : a + 4096, None] * _MULTIPLIERS).min(axis=0))
    return (mix(low) >> np.uint64(32)).astype("<u4")


def _sets(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """key, hash of the whole set (null without words), number of shingles, signature and one bucket key per run and depth."""

    def run(batches):
        known = WordHashes()
        for part, texts in in_chunks(batches):
            sets = shingle_sets(texts, known, n)
            names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            signs = [signature(s).tobytes() if len(s) else None for s in sets]
            columns = [part.column("key"), pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "name", "n", "signature"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, "key long, name binary, n long, signature binary"), "sets")


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with this probability even if every bucket needs all splits."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def _paths(runs: int, depth: int) -> np.ndarray:
    """The samples along each run's path; runs share as few as they can."""
    order = np.concatenate([np.random.default_rng(seed).permutation(_SAMPLES) for seed in range(-(-runs * depth // _SAMPLES))])
    return order[: runs * depth].reshape(runs, depth)


def _agreeing(signs: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose signatures agree as pairs at the threshold do, four standard deviations allowed."""
    least = _SAMPLES * threshold - 4 * math.sqrt(_SAMPLES * threshold * (1 - threshold))
    return (signs[:, None, :] == signs).sum(axis=2) >= least


def _lowest(linked: np.ndarray) -> np.ndarray:
    """For every row of a symmetric relation, the first row of its connected component."""
    label = np.arange(len(linked))
    while True:
        spread = np.where(linked, label, len(label)).min(axis=1)
        new = np.minimum(label, spread)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _edges(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = _lowest(linked)
    own = np.flatnonzero(label != np.arange(len(label)))
    return ids[own], ids[label[own]]


def candidates(classes: DataFrame, threshold: float, recall: float, depth: int, bucket: int) -> DataFrame:
    """Edges (a, b) that connect classes which may be similar."""
    paths = _paths(runs_for(recall, threshold, depth), depth)

    def path_keys(batches):
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(-1, _SAMPLES).astype(np.uint64)
            ids = batch.column("id").to_numpy()
            for run, path in enumerate(paths):
                key, columns = np.full(len(ids), run, np.uint64), []
                for sample in path.tolist():
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signs[:, sample])
                    columns.append(pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids), *columns], ["id", *(f"key{d}" for d in range(depth))])

    rows = classes.select("id", "signature").mapInArrow(path_keys, "id long, " + ", ".join(f"key{d} long" for d in range(depth)))
    small, large = [], None
    for d in range(depth):
        rows = stage(rows, "paths") if d == 0 else rows
        sizes = rows.groupBy(F.col(f"key{d}").alias("of")).agg(F.count("*").alias("members"), F.min("id").alias("lowest")).filter("members > 1")
        sized = stage(rows.join(sizes, rows[f"key{d}"] == sizes["of"]).drop("of"), "sized")
        small.append(sized.filter(F.col("members") <= bucket).select(F.col(f"key{d}").alias("bucket"), "id"))
        rows = sized.filter(F.col("members") > bucket)
        if d == depth - 1:
            large = rows.filter("id <> lowest").select(F.col("id").alias("a"), F.col("lowest").alias("b"))
        rows = rows.drop("members", "lowest")
    together = small[0]
    for more in small[1:]:
        together = together.unionByName(more)

    def brute_force(batches):
        for keys, ids, signs in _groups(batches, "bucket", ("id",), "signature"):
            del keys
            linked = _agreeing(np.frombuffer(b"".join(signs), "<u4").reshape(-1, _SAMPLES), threshold)
            a, b = _edges(ids["id"], linked)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    met = together.join(classes.select("id", "signature"), "id")
    met = met.repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(brute_force, "a long, b long")
    return met.unionByName(large)


def _groups(batches, by: str, columns: tuple[str, ...], data: str):
    """Groups of rows sorted by ``by``: its value, arrays of the columns, and the list of binaries; one group is held at a time."""
    held: list[pa.RecordBatch] = []

    def whole():
        table = pa.Table.from_batches(held)
        return held[0].column(by)[0].as_py(), {c: table.column(c).to_numpy() for c in columns}, table.column(data).to_pylist()

    for batch in batches:
        keys = batch.column(by)
        if not batch.num_rows:
            continue
        values = keys.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and held[0].column(by)[0] != part.column(by)[0]:
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections. Tokens in one set only are left out before the products."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    place = np.cumsum(new) - 1
    shared = np.bincount(place)[place] > 1
    owner, place = owner[shared], place[shared]
    place = np.cumsum(np.concatenate([[0], place[1:] != place[:-1]])) if len(place) else place
    counts = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for a in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        lo, hi = np.searchsorted(place, [a, a + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], place[lo:hi] - a] = 1
        counts += part @ part.T
    return counts


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of the threshold or more (never a set with itself)."""
    sizes = np.array([len(s) for s in sets], np.float64)
    shared = common(sets)
    linked = shared + 1e-9 >= threshold * (sizes[:, None] + sizes - shared)
    np.fill_diagonal(linked, False)
    return linked


def _exact(docs: DataFrame, members: DataFrame, n: int, threshold: float, key: str, text: str) -> DataFrame:
    """Rows (a, b, links): b is the lowest class a task found a to be connected with, links how many documents it counted for a.

    ``members``: id (one document of the class), weight and n, component.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("sets") / _BLOCK_SETS), F.ceil(F.col("tokens") / _BLOCK_TOKENS)).cast("int")
    placed = members.join(sizes.select("component", blocks.alias("blocks")), "component")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    first = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def to_sets(batches):
        known = WordHashes()
        for part, texts in in_chunks(batches):
            data = pa.array([s.tobytes() for s in shingle_sets(texts, known, n)], pa.binary())
            names = ["id", "weight", "component", "blocks", "block"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), data], [*names, "tokens"])

    # one plan for all sizes: the members are a share of the documents
    sets = first.join(placed.drop("n").hint("merge"), "id").select("id", "weight", "component", "blocks", "block", "text")
    sets = sets.mapInArrow(to_sets, "id long, weight long, component long, blocks int, block int, tokens binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    task = F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other"))
    dealt = sets.select("id", "weight", "component", "block", "tokens", other)
    dealt = dealt.select(task.alias("task"), "component", "id", "weight", "block", (F.col("block") == F.col("other")).alias("alone"), "tokens")

    def count(batches):
        for _, c, data in _groups(batches, "task", ("id", "weight", "block", "alone"), "tokens"):
            ids, kept = np.unique(c["id"], return_index=True)  # a document in two rows is one member
            sets = [np.frombuffer(data[i], np.uint64) for i in kept.tolist()]
            linked = similar(sets, threshold)
            if not c["alone"].all():
                block = c["block"][kept]
                linked &= block[:, None] != block
            links = linked @ c["weight"][kept]
            label = _lowest(linked)
            some = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[label[some]]), pa.array(links[some].astype(np.int64))], ["a", "b", "links"])

    return dealt.repartition("task").sortWithinPartitions("task", "id").mapInArrow(count, "a long, b long, links long")


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, depth: int = 3, bucket: int = 64,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``class_id`` (lowest key among documents it is linked with, directly or through others),
    ``rep_id`` (lowest key with an equal shingle set) and ``n_links`` (other documents at the threshold or above)."""
    rows = _sets(docs, n, key, text)
    found = rows.filter("name IS NOT NULL").groupBy("name").agg(
        F.min("key").alias("id"), F.count("*").alias("weight"), F.min("n").alias("n"), F.min("signature").alias("signature")
    )
    classes = stage(found, "classes")
    grouped = components(candidates(classes, threshold, recall, depth, bucket))
    members = stage(classes.select("id", "weight", "n").join(grouped.select(F.col("node").alias("id"), "component"), "id"), "members")
    exact = stage(_exact(docs, members, n, threshold, key, text), "links")
    linked = components(exact.select("a", "b")).select(F.col("node").alias("id"), F.col("component").alias("class_id"))
    links = exact.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    named = classes.select("name", "id", "weight").join(linked, "id", "left").join(links, "id", "left")
    named = named.select("name", F.col("id").alias("rep_id"), F.coalesce("class_id", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.select("key", "name").join(named, "name", "left")
    return out.select("key", F.coalesce("class_id", "key").alias("class_id"), F.coalesce("rep_id", "key").alias("rep_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every class the document with the lowest key stays, with all its rows and columns."""
    found = near_duplicates(docs, key=key, text=text, **options)
    dropped = stage(found.filter("key <> class_id").select(F.col("key").alias("__dropped_key")).distinct(), "dropped")
    return docs.join(dropped, F.col(key).cast("long") == F.col("__dropped_key"), "left_anti")
