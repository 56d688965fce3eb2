"""Substring dedup by fixed-block anchors: every passage of ``window`` words that also starts earlier is removed.

Reference blocks of half a window are indexed at fixed, non-overlapping places of every document. Any passage of ``window``
words holds one whole block, so probing the index with the rolling window at every word finds each passage that occurs twice.
Around the hits, windows are extended to full length and compared; joined, the repeated windows are the maximal exact repeats.

Nothing is paired: a passage in a third of all documents costs one entry per occurrence. What moves between tasks is packed:
documents are kept in compressed chunks on the shared folder, each chunk sends its probes as four bytes per word to the shard
of their hash, and the shards answer with one bit per probe. Then the windows around hits go to shards by their hash with
document and place, and again one bit comes back: does this window start earlier elsewhere? Shards grow in number with the
input, so the size of a task stays the same. Windows are equal where two hashes of different functions of their
words are, 96 bits together: of 10^13 windows, two unlike ones agree by chance in one run of a thousand or fewer.

Null text has no words. A text under ``window`` words is kept whole. Rows that repeat a doc_id are the same document at the same
places, hence no repeats of each other; rows with a null doc_id are one such document, before all others. An empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import WordHashes, hash_words, in_chunks, inside, mix, owners, sums, windows

_CHUNK = 1 << 22  # bytes of text
_SHARD = 1 << 22  # entries
_NULL = -(1 << 63)  # stands for a null id inside chunks


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents in compressed chunks: chunk, doc ids, ends of the texts in bytes, all texts, number of words."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for part, texts in in_chunks(batches, _CHUNK):
            ids = np.array([_NULL if i is None else i for i in part.column("key").to_pylist()], np.int64)
            ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
            words = sum(len(x.split()) for x in texts)
            row = [(task << 32) + number], [_pack(ids)], [_pack(ends)], [zstandard.ZstdCompressor(level=5).compress(b"".join(texts))], [words]
            types = pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], ["chunk", "ids", "ends", "texts", "words"])
            number += 1

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, "chunk long, ids binary, ends binary, texts binary, words long"), "chunks")


def _texts(row: dict) -> tuple[np.ndarray, list[bytes]]:
    ends = _unpack(row["ends"], "<i8").tolist()
    whole = zstandard.ZstdDecompressor().decompress(row["texts"]) if ends and ends[-1] else b""
    return _unpack(row["ids"], "<i8"), [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _rows(batches) -> Iterator[dict]:
    """Rows one by one, so that one row's arrays are held at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _deal(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts entries by shard (and keeps their order within), and where each shard starts."""
    shard = (hashes >> np.uint64(64 - shards.bit_length() + 1)).astype(np.uint16 if shards <= 1 << 16 else np.uint32) if shards > 1 else np.zeros(len(hashes), np.uint16)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _answers(replies, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One flag per entry from the packed bits of its shard."""
    flags = np.zeros(len(order), bool)
    for reply in replies or []:
        own = order[starts[reply["shard"]] : starts[reply["shard"] + 1]]
        flags[own] = np.unpackbits(np.frombuffer(reply["bits"], np.uint8), count=len(own)).astype(bool)
    return flags


def _probes(hashes: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rolling windows of block length: their places, their hashes, and which are reference blocks."""
    rolling = windows(hashes, block)
    at = np.flatnonzero(inside(starts, block))
    return at, rolling[at], (at - starts[owners(starts)[at]]) % block == 0


def _by_shard(batches, answer, kinds: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Call ``answer(arrays)`` for each shard of a task whose rows are sorted by shard; send its flags back to the chunks."""
    held: list[dict] = []

    def close():
        parts = {name: [_unpack(r[name], kind) for r in held] for name, kind in kinds.items()}
        sizes = [len(x) for x in parts[next(iter(kinds))]]
        flags = answer({name: np.concatenate(x) for name, x in parts.items()})
        bits = [np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(sizes)[:-1])]
        some = [i for i, x in enumerate(bits) if any(x)]
        columns = [[held[i]["chunk"] for i in some], [held[i]["shard"] for i in some], [bits[i] for i in some]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["chunk", "shard", "bits"])

    for row in _rows(batches):
        if held and held[0]["shard"] != row["shard"]:
            yield close()
            held = []
        held.append(row)
    if held:
        yield close()


def _found_twice(e: dict[str, np.ndarray]) -> np.ndarray:
    """Probes that hit a reference block which two probes or more hit."""
    probes, blocks = e["hashes"], np.unique(e["hashes"][e["blocks"] > 0])
    if not len(blocks):
        return np.zeros(len(probes), bool)
    at = np.minimum(np.searchsorted(blocks, probes), len(blocks) - 1)
    hit = blocks[at] == probes
    return hit & (np.bincount(at[hit], minlength=len(blocks)) > 1)[at]


def _starts_earlier(e: dict[str, np.ndarray]) -> np.ndarray:
    """Windows that are not the first of their two hashes by document and place."""
    order = np.lexsort((e["place"], e["doc"], e["second"], e["hashes"]))
    hashes, second, docs, places = e["hashes"][order], e["second"][order], e["doc"][order], e["place"][order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (second[1:] != second[:-1])])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    flags = np.zeros(len(order), bool)
    flags[order] = (docs != docs[first]) | (places != places[first])
    return flags


def _shards(entries: int) -> int:
    return 1 << max(4, (-(-entries // _SHARD) - 1).bit_length())


def remove_repeats(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_removed, ``kept`` (the words that stay, joined by one space) and its SHA-256."""
    block = window // 2
    chunks = _chunks(docs, key, text)
    words = chunks.agg(F.sum("words")).first()[0] or 0
    shards = _shards(words)

    def send_probes(batches):
        known = WordHashes()
        for row in _rows(batches):
            hashes, starts = hash_words(_texts(row)[1], known)
            _, probes, is_block = _probes(hashes, starts, block)
            order, begin = _deal(probes, shards)
            low = ((probes << np.uint64(shards.bit_length() - 1)) >> np.uint64(32)).astype("<u4")[order]
            is_block = is_block[order].astype(np.uint8)
            own = [s for s in range(shards) if begin[s] < begin[s + 1]]
            cut = [slice(begin[s], begin[s + 1]) for s in own]
            columns = [[row["chunk"]] * len(own), own, [_pack(low[c]) for c in cut], [_pack(is_block[c]) for c in cut]]
            types = pa.int64(), pa.int32(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["chunk", "shard", "hashes", "blocks"])

    def candidates(row: dict, known: WordHashes):
        """Windows of full length that hold a hit, in order: hash, document, place in the document, place in the chunk."""
        ids, texts = _texts(row)
        hashes, starts = hash_words(texts, known)
        at, probes, _ = _probes(hashes, starts, block)
        hit = np.zeros(len(hashes) + 1, np.int64)
        hit[at[_answers(row["hits"], *_deal(probes, shards))]] = 1
        before = np.concatenate([[0], np.cumsum(hit)])
        full = np.flatnonzero(inside(starts, window))
        full = full[before[full + window - block + 1] > before[full]]
        rolling = windows(hashes, window)[full] if len(full) else np.zeros(0, np.uint64)
        owner = owners(starts)[full] if len(full) else np.zeros(0, np.int64)
        return ids, texts, hashes, starts, rolling, owner, full

    def send_windows(batches):
        known = WordHashes()
        for row in _rows(batches):
            ids, _, hashes, starts, rolling, owner, full = candidates(row, known)
            second = (windows(mix(hashes), window)[full] >> np.uint64(32)).astype("<u4") if len(full) else rolling
            order, begin = _deal(rolling, shards)
            columns = [[], [], [], [], [], []]
            for s in range(shards):
                own = order[begin[s] : begin[s + 1]]
                if len(own):
                    docs_of, places = ids[owner[own]], (full - starts[owner])[own]
                    for c, v in zip(columns, (row["chunk"], s, _pack(rolling[own]), _pack(second[own]), _pack(docs_of), _pack(places.astype("<i8"))), strict=True):
                        c.append(v)
            types = pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["chunk", "shard", "hashes", "second", "doc", "place"])

    def finish(batches):
        known = WordHashes()
        for row in _rows(batches):
            ids, texts, _, starts, rolling, _, full = candidates(row, known)
            covered = np.zeros(int(starts[-1]) + 1, np.int64)
            again = full[_answers(row["again"], *_deal(rolling, shards))]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + window, -1)
            gone = np.cumsum(covered)[:-1] > 0
            removed = sums(gone, starts)
            kept = []
            for i, x in enumerate(texts):
                parts = x.split()
                if removed[i]:
                    parts = [w for w, out in zip(parts, gone[starts[i] : starts[i + 1]].tolist(), strict=True) if not out]
                kept.append(b" ".join(parts))
            columns = [pa.array(ids, mask=ids == _NULL), pa.array(np.diff(starts)), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())]
            sha = pa.array([hashlib.sha256(x).hexdigest() for x in kept])
            yield pa.RecordBatch.from_arrays([*columns, sha], ["key", "n_words", "n_removed", "kept", "kept_sha256"])

    def answered(sent: DataFrame, answer, name: str) -> DataFrame:
        by_shard = sent.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(answer, "chunk long, shard int, bits binary")
        return by_shard.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias(name))

    probes = chunks.mapInArrow(send_probes, "chunk long, shard int, hashes binary, blocks binary")
    hits = stage(answered(probes, _answer_probes, "hits"), "hits")
    around = chunks.join(hits, "chunk").mapInArrow(send_windows, "chunk long, shard int, hashes binary, second binary, doc binary, place binary")
    again = answered(around, _answer_windows, "again")
    both = chunks.join(hits, "chunk", "left").join(again, "chunk", "left")
    return both.mapInArrow(finish, "key long, n_words long, n_removed long, kept string, kept_sha256 string")


def _answer_probes(batches):
    return _by_shard(batches, _found_twice, {"hashes": "<u4", "blocks": "u1"})


def _answer_windows(batches):
    return _by_shard(batches, _starts_earlier, {"hashes": "<u8", "second": "<u4", "doc": "<i8", "place": "<i8"})
