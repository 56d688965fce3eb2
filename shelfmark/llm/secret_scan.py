"""Secret scans: fixed patterns, and a guess-cost dynamic program over values in a credential context.

The cost of a value is the least sum of log10 guesses over its segmentations into words (with capitals and look-alike digits),
dates, repeats, keyboard walks, number or letter sequences and brute-force spans. A value that stays expensive under every
segmentation is a real secret, and its span is added as kind ``guess``; a cheap one ("password: please", "login: successful",
"token = 12345678") adds nothing. Spans of the fixed patterns are never taken away.

Words are those that people choose for passwords, by rank, and those of the corpus: a word of 3 to ``longest`` letters that N/n of
all N documents hold takes as many guesses as the inverse of that share. Only what stands outside credential contexts counts, in
two documents at least, so a secret does not become a word by being copied. Counts cover all documents; a filter of fixed size
drops words that no value holds before they are shuffled, and each distinct value is costed once.

Null text is empty and has no spans. Repeated rows are scanned each, also rows with a null key; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bitmap import likely_in
from shelfmark.llm.scratch import stage
from shelfmark.llm.words import in_chunks

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: Runs are whole because nothing of their own class comes before them.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: A wider context than the fixed pattern: more names, also after a camel-case boundary, more signs between name and value with any
#: spaces and tabs around them, any visible value; between matching quotes on one line the whole text is the value.
CONTEXT = re.compile(
    r"(?:(?<![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|secret|auth|client)[_-]?(?:key|secret|token)|login|auth)"
    r"[\"']?[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+(?:\"([^\"\x00-\x08\x0A-\x1F]+)\"|'([^'\x00-\x08\x0A-\x1F]+)'|[\"']?([^\"'\x00-\x20]+))",
    re.IGNORECASE | re.ASCII,
)
_NAMES = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"login", b"auth")

#: Words that people choose, the likeliest first. A word's place is its number of guesses.
COMMON_WORDS = (
    "password", "qwerty", "admin", "letmein", "welcome", "monkey", "dragon", "login", "secret", "master", "hello", "iloveyou", "sunshine", "princess",
    "football", "baseball", "shadow", "superman", "trustno", "test", "guest", "root", "user", "default", "changeme", "example", "sample", "pass",
    "love", "summer", "winter", "spring", "autumn", "monday", "friday", "january", "december", "the", "and", "you", "this", "that", "with", "from",
    "your", "please", "none", "null", "true", "false", "token", "key", "api", "value", "string", "here", "insert", "enter", "new", "old", "my", "is",
    "not", "for", "hunter", "charlie", "michael", "jordan", "computer", "internet", "server", "service", "system", "public", "private", "access",
)
#: Rows of a common keyboard.
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_SEGMENT = math.log10(2)  # what trying one more segment costs
_LETTERS = re.compile(r"[^\W\d_]+")
_SALTS = 16  # parts of a value that many documents hold


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            around = [(r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c), (r + 1, c - 1)]
            near[key] = {KEY_ROWS[y][x] for y, x in around if 0 <= y < len(KEY_ROWS) and 0 <= x < len(KEY_ROWS[y])}
    return near


_NEAR = _neighbours()


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100


def guess_cost(value: str, ranks: dict[str, int], longest: int) -> float:
    """log10 of the guesses the cheapest segmentation needs. Time grows with the length times the longest word."""
    n, low = len(value), value.lower()
    plain = low.translate(_LOOKALIKE)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # start to (end, cost) of segments other than brute force
    for i in range(n):
        for j in range(i + 3 if i + 3 <= n else n, min(n, i + longest) + 1):
            for word, extra in ((low[i:j], 0.0), (plain[i:j], 0.3)):
                if word in ranks:
                    ends[i].append((j, math.log10(ranks[word] + 1) + extra + (0.3 if value[i:j] != low[i:j] else 0)))
                    break
        if m := _DATE.match(value, i):
            ends[i].append((m.end(), math.log10(120 * 365) if m.end() - i > 4 else math.log10(120)))
    for same, start_cost in ((lambda a, b: a == b, 1.5), (lambda a, b: b in _NEAR.get(a, ""), 1.9), (lambda a, b: a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1, 1.2)):
        i = 0
        while i < n:
            j = i + 1
            while j < n and same(low[j - 1], low[j]):
                j += 1
            if j - i >= 3:
                ends[i].append((j, start_cost + math.log10(j - i)))
            i = j if j > i + 1 else i + 1
    for size in (2, 3, 4):  # a block said again and again
        i = 0
        while i + 2 * size <= n:
            j = i + size
            while low[j : j + size] == low[i : i + size] and j + size <= n:
                j += size
            if j > i + size:
                ends[i].append((j, sum(math.log10(_alphabet(c)) for c in low[i : i + size]) + math.log10((j - i) // size)))
                i = j
            else:
                i += 1
    done, brute = [math.inf] * (n + 1), [math.inf] * (n + 1)  # at a segment's end; inside a brute-force span
    done[0] = 0.0
    for i in range(n):
        here = min(done[i], brute[i])
        for j, cost in ends[i]:
            done[j] = min(done[j], here + cost + _SEGMENT)
        brute[i + 1] = min(brute[i + 1], min(done[i] + _SEGMENT, brute[i]) + math.log10(_alphabet(value[i])))
    return min(done[n], brute[n])


def contexts(text: str, low: bytes) -> list[tuple[int, int]]:
    """Places of the values in credential contexts."""
    if not any(name in low for name in _NAMES):
        return []
    found = []
    for m in CONTEXT.finditer(text):
        start, value = m.start(m.lastindex), m[m.lastindex] if m.lastindex < 3 else m[3].rstrip(".,;:!?)]}")
        if value:
            found.append((start, start + len(value)))
    return found


def fixed_spans(text: str, low: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    found = []
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def words_outside(text: str, low: bytes, longest: int) -> set[str]:
    """Distinct lower-case words of the text without the values in credential contexts."""
    for start, end in reversed(contexts(text, low)):
        text = f"{text[:start]} {text[end:]}" if end - start < len(text) else ""
    return {w for w in _LETTERS.findall(text.lower()) if 3 <= len(w) <= longest}


def words_inside(value: str, longest: int) -> set[str]:
    """Every lower-case piece of a value that may be a word, also with look-alike digits read as letters."""
    low = value.lower()
    runs = {m.group() for form in (low, low.translate(_LOOKALIKE)) for m in _LETTERS.finditer(form)}
    return {r[i:j] for r in runs for i in range(len(r) - 2) for j in range(i + 3, min(len(r), i + longest) + 1)}


def scan(docs: DataFrame, least_cost: float = 8.0, words: tuple[str, ...] = COMMON_WORDS, longest: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and ``spans`` (kind, start, end in code points, end exclusive, cost), by start, then kind."""
    ranks = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
    longest = max([longest, *map(len, words)])
    place = pa.struct([("number", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    value_type = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def search(batches):
        for part, texts in in_chunks(batches):
            fixed, values = [], []
            for x in texts:
                decoded, low = x.decode("utf-8", "replace"), x.lower()
                fixed.append([{"number": k, "start": s, "end": e} for s, k, e in fixed_spans(decoded, low)])
                values.append([{"start": s, "end": e, "value": decoded[s:e]} for s, e in contexts(decoded, low)])
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("row"), pa.array(fixed, pa.list_(place)), pa.array(values, pa.list_(value_type))], ["key", "row", "fixed", "values"])

    def corpus_words(batches):
        for part, texts in in_chunks(batches):
            found = [w for x in texts for w in words_outside(x.decode("utf-8", "replace"), x.lower(), longest)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    def pieces(batches):
        for part, texts in in_chunks(batches, 1 << 16, "value"):
            for name, x in zip(part.column("name").to_pylist(), texts, strict=True):
                found = list(words_inside(x.decode(), longest))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found, pa.string())], ["name", "word"])

    def costs(batches):
        for part, texts in in_chunks(batches, 1 << 16, "value"):
            known = part.column("known").to_pylist()
            found = []
            for x, own in zip(texts, known, strict=True):
                seen = {k["word"]: min(k["guesses"], ranks.get(k["word"], math.inf)) for k in own or []}
                found.append(guess_cost(x.decode(), {**ranks, **seen}, longest))
            yield pa.RecordBatch.from_arrays([part.column("name"), pa.array(found, pa.float64())], ["name", "cost"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    schema = "key long, row long, fixed array<struct<number:int,start:long,end:long>>, values array<struct<start:long,end:long,value:string>>"
    found = stage(narrow.mapInArrow(search, schema), "secrets")
    each = found.select("row", F.inline("values")).withColumn("name", F.md5("value"))
    values = stage(each.groupBy("name").agg(F.min("value").alias("value")), "values")
    parts = stage(values.mapInArrow(pieces, "name string, word string"), "value-words")
    met = likely_in(narrow.select("text").mapInArrow(corpus_words, "word string"), F.xxhash64("word"), parts, F.xxhash64("word"))
    counts = met.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1")
    guesses = counts.select("word", (F.lit(float(found.count())) / F.col("n")).alias("guesses"))
    known = parts.join(guesses, "word").groupBy("name").agg(F.collect_list(F.struct("word", "guesses")).alias("known"))
    costly = stage(values.join(known, "name", "left").mapInArrow(costs, "name string, cost double").filter(F.col("cost") >= least_cost), "costs")
    # a value may stand in a third of all documents: its rows are dealt to some tasks, its cost is in each
    salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    real = each.drop("value").withColumn("salt", F.pmod("row", F.lit(_SALTS)).cast("int")).join(costly.select("*", salt), ["name", "salt"])
    real = real.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("guess")).alias("number"), "end", "cost")).alias("guessed"))
    fixed = F.transform("fixed", lambda s: F.struct(s["start"].alias("start"), s["number"].alias("number"), s["end"].alias("end"), F.lit(0.0).alias("cost")))
    both = found.select("key", "row", fixed.alias("fixed")).join(real, "row", "left")
    ordered = F.array_sort(F.concat("fixed", F.coalesce("guessed", F.array().cast("array<struct<start:bigint,number:int,end:bigint,cost:double>>"))))
    names = F.array(*map(F.lit, KINDS))
    span = lambda s: F.struct(F.get(names, s["number"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["cost"].alias("cost"))
    return both.select("key", F.transform(ordered, span).alias("spans"))


def digest(spans: list[tuple[str, int, int]]) -> str:
    """Lowercase hex SHA-256 of kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
