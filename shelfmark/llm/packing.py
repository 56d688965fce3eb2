"""Bounded-space online best-fit packing of tokenized documents into sequences of a fixed length.

A piece goes into the open sequence with the least room that still holds it. Open sequences are found through a bitset keyed
by free space; when the bound on open sequences is reached, the fullest closes first. Documents are tokenized where they are
read; only lengths and checksums of pieces are shuffled.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import in_chunks

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_LONG_RUN = re.compile(r"\s{1000}")


class Encoder:
    """Token ids of a public byte-level BPE file.

    ``path`` is the vocabulary for ``tokenizers``, ``ranks`` the same vocabulary as ranks: from it tiktoken gives the same ids
    four times as fast. Texts with very long runs of white space, which its matcher refuses, go through ``tokenizers``.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.path, self.plain = path, None

    def ids(self, text: str) -> list[int]:
        if not _LONG_RUN.search(text):
            return self.fast.encode_ordinary(text)
        if self.plain is None:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_file(self.path)
            self.plain.encode_special_tokens = True
        return self.plain.encode(text, add_special_tokens=False).ids


def public_encoder() -> Encoder:
    import public_tokenizers as public

    return Encoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: only the first may be short."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


class OpenSequences:
    """At most ``most`` open sequences, found by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free, self.by_free, self.open, self.made = 0, {}, 0, 0

    def put(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece and the piece's offset there."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            room, number = self.capacity, self.made
            self.made += 1
        if room > length:
            self.by_free.setdefault(room - length, []).append(number)
            self.free |= 1 << (room - length)
            self.open += 1
        return number, self.capacity - room

    def _take(self, room: int) -> int:
        numbers = self.by_free[room]
        number = numbers.pop()
        self.open -= 1
        if not numbers:
            self.free ^= 1 << room
        return number


def pieces(docs: DataFrame, capacity: int = 2048, encoder=public_encoder, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: its ids and ``end_id``, cut only where they exceed the capacity."""

    def run(batches):
        encode = encoder()
        for part, texts in in_chunks(batches):
            rows = []
            for doc, x in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.array([*encode.ids(x.decode("utf-8", "replace")), end_id], "<u4")
                rows += [(doc, i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(cut(len(ids), capacity))]
            columns = zip(*rows, strict=True)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _PIECES)


def pack(docs: DataFrame, capacity: int = 2048, open_sequences: int = 1 << 15, group_tokens: int = 1 << 26, encoder=public_encoder,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece with its ``sequence_id`` and gapless ``offset``.

    Pieces are dealt into groups of about ``group_tokens`` tokens (a bound on a task, about 32,000 sequences) and each group is
    packed on its own, longest pieces first: long pieces stay open until short ones fill them, so the bound on open sequences is
    as large as a group has sequences (32,768 numbers of memory). Null text is empty: the document is its end id alone. Repeated rows are packed as
    often as they occur; an empty table gives an empty result.
    """
    cut_up = stage(pieces(docs, capacity, encoder, key=key, text=text).withColumn("deal", F.monotonically_increasing_id()), "pieces")
    groups = -(-(cut_up.agg(F.sum("length")).first()[0] or 1) // group_tokens)

    def run(frames):
        bins, group = OpenSequences(capacity, open_sequences), TaskContext.get().partitionId()
        for frame in frames:
            found = [bins.put(n) for n in frame["length"].tolist()]
            frame["sequence_id"] = np.array([s for s, _ in found], np.int64) + (group << 40)
            frame["offset"] = np.array([o for _, o in found], np.int64)
            yield frame

    dealt = cut_up.repartition(int(groups), "deal").sortWithinPartitions(F.desc("length"), "doc_id", "piece", "deal").drop("deal")
    return dealt.mapInPandas(run, f"{_PIECES}, sequence_id long, offset long")
