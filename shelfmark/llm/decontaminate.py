"""Benchmark decontamination by template canonicalisation: finds copied questions, and ones with other numbers, names or units.

Words become template tokens: numbers, units after a number, numbers with a unit attached and names (capitals inside a sentence)
turn into typed placeholders, all else into its lower-case letters without surrounding punctuation. Sentences end at their signs and at
line breaks. Windows of ``window`` tokens
of documents and benchmark items meet by hash. For an item and a document the matching windows must line up, and the slots must
be consistent: wherever the item repeats a value, the document repeats one value too.

Texts are read in three forms: as above; with a capitalised first word of a sentence as a name too, so that names there may differ; and
plain, with every word literal, so that copies in capitals or of mostly names and numbers are found. Each form lines up for itself.

Items of one template and one pattern of equal slots are one class, so a benchmark with a thousand variants of a question is
matched once. Before documents are shuffled at all, their windows pass a Bloom filter of the benchmark's windows whose size is
fixed (``filter_bits``); what it lets through by chance, the join drops. So nothing that grows is broadcast, and the same plan
holds for a benchmark of any size.

A document is contaminated by an item when, on one alignment with consistent slots, at least ``least_run`` windows match or at
least half of the item's windows do. Items with fewer than ``window`` tokens are one window of their own length; items under
``least_words`` tokens are too short to tell from chance and are left out, and so are windows with fewer than half their tokens
literal (of the first two forms). Null texts are empty and match nothing. Rows that repeat a doc_id are one document. Empty tables give an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import in_chunks, inside, owners, windows

#: Words that are numbers, and units that may follow a number.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty "
    "fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres g kg mg gram grams kilogram kilograms ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons cup cups second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees volt volts watt watts mph kmh".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?[%€£$]?")
_MEASURE = re.compile(r"[+-]?\d[\d.,]*[A-Za-z°µ]{1,5}\d?")
_EDGES = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])) + "«»“”‘’¿¡…–—"
_LITERAL, _NUM, _UNIT, _NUM_UNIT, _NAME = range(5)
_BREAK = b"\x01"  # stands for a line break between words
_HASH = np.uint64((1 << 60) - 1)
_PLACEHOLDER = np.array([0, *(xxhash.xxh3_64_intdigest(x) for x in ("<number>", "<unit>", "<measure>", "<name>"))], np.uint64)


class Canon(dict):
    """Word (bytes) to 60 bits of its literal's hash, 2 bits of kind, a capital bit and a sentence-end bit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        text = word.decode("utf-8", "replace")
        bare = text.strip(_EDGES)
        low = bare.lower()
        sign = "-" + low if bare and text.lstrip("([{\"'").startswith("-") and low[0].isdigit() else low
        kind = _NUM if low in NUMBER_WORDS or _NUMBER.fullmatch(low) else _UNIT if low in UNITS else _NUM_UNIT if _MEASURE.fullmatch(low) else _LITERAL
        capital = len(bare) > 1 and bare[0].isupper() and kind == _LITERAL
        ends = text.rstrip("\"')]}»”’")[-1:] in {".", "!", "?", ":", ";"}
        value = self[word] = (xxhash.xxh3_64_intdigest((sign or text).encode()) >> 4) | kind << 60 | capital << 62 | ends << 63
        return value


def tokens(texts: list[bytes], known: Canon) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Literal hashes of tokens, their kinds in each of the three forms, and where each text's tokens start."""
    parts, breaks, starts = [], [], np.zeros(len(texts) + 1, np.int64)
    mark = known[_BREAK]
    for i, x in enumerate(texts):
        words = (x.replace(b"\n", b" \x01 ") if b"\n" in x else x).split()
        own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        cut = own == mark
        stays = ~cut
        parts.append(own[stays])
        breaks.append(np.concatenate([[False], cut[:-1]])[stays] if len(own) else cut)
        starts[i + 1] = starts[i] + len(parts[-1])
    packed = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    broken = np.concatenate(breaks) if breaks else np.zeros(0, bool)
    literal = packed & _HASH
    kind = ((packed >> np.uint64(60)) & np.uint64(3)).astype(np.int64)
    first = np.zeros(len(packed) + 1, bool)
    first[starts[:-1]] = True
    first = first[:-1]
    after = np.concatenate([[True], (packed[:-1] >> np.uint64(63)).astype(bool)]) if len(packed) else first
    capital = ((packed >> np.uint64(62)) & np.uint64(1)).astype(bool)
    if len(packed):
        number_before = np.concatenate([[False], kind[:-1] == _NUM]) & ~first
        kind[(kind == _UNIT) & ~number_before] = _LITERAL
    inner = np.where(capital & ~first & ~after & ~broken, _NAME, kind)
    return literal, [inner, np.where(capital, _NAME, kind), np.zeros_like(kind)], starts


def _template(literal: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return np.where(kind == _LITERAL, literal, _PLACEHOLDER[kind])


def _windows(template: np.ndarray, kind: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of windows inside one text with enough literals."""
    if len(template) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    literals = np.concatenate([[0], np.cumsum(kind == _LITERAL)])
    ok = inside(starts, n) & (2 * (literals[n:] - literals[:-n]) >= n)
    at = np.flatnonzero(ok)
    return at, windows(template, n)[at] ^ np.uint64(n)


def _slots(at: np.ndarray, n: int, literal: np.ndarray, kind: np.ndarray) -> list[list[int]]:
    return [(literal[a : a + n][kind[a : a + n] != _LITERAL]).astype(np.int64).tolist() for a in at.tolist()]


_BENCH = "class binary, item_id long, form int, n_windows int, place int, hash long, slots array<long>"


def benchmark_windows(items: DataFrame, window: int, least_words: int, key: str, text: str) -> DataFrame:
    """Windows of one item (the lowest id) of every class, the plain ones of all its items, and how many items the class has."""

    def run(batches):
        known = Canon()
        for part, texts in in_chunks(batches):
            literal, kinds, starts = tokens(texts, known)
            rows = []
            for i, item in enumerate(part.column("key").to_pylist()):
                a, b = int(starts[i]), int(starts[i + 1])
                n = min(window, b - a)
                if n < least_words:
                    continue
                own, forms = literal[a:b], [kind[a:b] for kind in kinds]
                seen: dict[int, int] = {}
                pattern = [seen.setdefault(v, len(seen)) for v in own[forms[1] != _LITERAL].tolist()]
                name = xxhash.xxh3_128_digest(_template(own, forms[0]).tobytes() + np.array(pattern, "<i8").tobytes())
                for form, kind in enumerate(forms):
                    at, hashes = _windows(_template(own, kind), kind, np.array([0, b - a]), n)
                    rows += [(name, item, form, len(at), int(p), int(h), s) for p, h, s in zip(at, hashes.view(np.int64), _slots(at, n, own, kind), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            types = pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())
            names = ["class", "item_id", "form", "n_windows", "place", "hash", "slots"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    narrow = items.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    found = stage(narrow.mapInArrow(run, _BENCH), "benchmark")
    classes = found.select("class", "item_id").distinct().groupBy("class").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    chosen = found.withColumnRenamed("item_id", "own_id").join(classes, "class").filter("form = 2 OR own_id = item_id").drop("own_id")
    return stage(chosen.dropDuplicates(["class", "form", "place", "hash"]), "benchmark")


def _bloom(bench: DataFrame, bits: int) -> np.ndarray:
    """The bits that the benchmark's hashes set. The driver gets at most 16 bitsets of fixed size."""

    def run(batches):
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _bloom_places(batch.column("hash").to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], ["bits"])

    whole = np.zeros(bits // 8, np.uint8)
    for row in bench.select("hash").coalesce(16).mapInArrow(run, "bits binary").collect():
        whole |= np.frombuffer(row["bits"], np.uint8)
    return whole


def _bloom_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((hashes >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64) for shift in (0, 19, 38)]


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 8, least_words: int = 4, least_run: int = 6, filter_bits: int = 1 << 23,
               key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated document and class of items: doc key, lowest item_id, n_items, n_matched, n_windows, same_values."""
    bench = benchmark_windows(items, window, least_words, item_key, item_text)
    lengths = [r["n"] for r in bench.select(F.when(F.col("n_windows") > 1, window).otherwise(F.lit(0)).alias("n")).distinct().collect()]
    sizes = range(least_words, window + 1) if 0 in lengths else [window]
    bits = docs.sparkSession.sparkContext.broadcast(_bloom(bench, filter_bits))

    def run(batches):
        known, passed = Canon(), bits.value
        for part, texts in in_chunks(batches):
            literal, kinds, starts = tokens(texts, known)
            owner, ids = owners(starts), part.column("key")
            columns = [[], [], [], []]
            for form, kind in enumerate(kinds):
                template = _template(literal, kind)
                other = np.concatenate([[0], np.cumsum(kind != kinds[0])])
                for n in sizes:
                    at, hashes = _windows(template, kind, starts, n)
                    if form:  # windows that read as in the first form are there already, as far as that form takes them
                        new = other[at + n] > other[at]
                        at, hashes = at[new], hashes[new]
                    ok = np.ones(len(at), bool)
                    for place in _bloom_places(hashes, filter_bits):
                        ok &= (passed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    at, hashes = at[ok], hashes[ok]
                    columns[0] += ids.take(pa.array(owner[at])).to_pylist()
                    columns[1] += (at - starts[owner[at]]).tolist()
                    columns[2] += hashes.view(np.int64).tolist()
                    columns[3] += _slots(at, n, literal, kind)
            types = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "at", "hash", "filled"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    hits = narrow.mapInArrow(run, "key long, at long, hash long, filled array<long>")
    met = hits.join(bench, "hash").select(
        "key", "item_id", "n_items", "form", "n_windows", "place", (F.col("at") - F.col("place")).alias("offset"),
        F.transform(F.arrays_zip("slots", "filled"), lambda p: F.struct(p["slots"].alias("item"), p["filled"].alias("doc"))).alias("values"),
    )
    lined_up = met.groupBy("key", "item_id", "n_items", "form", "n_windows", "offset").agg(
        F.count_distinct("place").alias("n_matched"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values")
    )
    values = F.col("values")
    consistent = F.size(values) == F.size(F.array_distinct(F.transform(values, lambda p: p["item"])))
    enough = (F.col("n_matched") >= least_run) | (2 * F.col("n_matched") >= F.col("n_windows"))
    lined_up = lined_up.withColumn("same_values", F.forall(values, lambda p: p["item"] == p["doc"]))
    found = lined_up.filter(consistent & enough).groupBy("key", "item_id", "n_items")
    best = found.agg(F.max(F.struct("n_matched", "n_windows")).alias("best"), F.max("same_values").alias("same_values"))
    return best.select("key", "item_id", "n_items", "best.n_windows", "best.n_matched", "same_values")


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without contaminated documents, with all their columns."""
    leaks = stage(find_leaks(docs, items, key=key, text=text, **options).select(F.col("key").alias("__leaking_key")).distinct(), "leaks")
    return docs.join(leaks, F.col(key).cast("long") == F.col("__leaking_key"), "left_anti")
