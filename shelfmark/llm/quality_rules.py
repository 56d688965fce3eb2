"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior, joined back to documents.

Every document gets its row rules from its whole text: the base rule (``base_failed``) and the further ones of ``RULES`` over symbols
per word, repeated lines and mean word length. A document that fails any of them is not kept and counts as a failure of its host. A host's failure rate is not taken at face value: the rates of all
hosts fit a beta prior (method of moments), and a host's verdict comes from its posterior mean, so that a host with few
documents is judged mostly by what hosts are like and a host with many by its own record.

Null text counts as empty (and fails). A null host is no host: its documents are judged by their own rules alone. Repeated
rows are counted and returned as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import SPACES, WordHashes, hash_words, in_chunks, mix, owners, sums, windows

SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))
#: Further rules; a document without words fails by the base rule alone. Symbols over a tenth of the words; over half of the lines
#: repeat an earlier one; a mean word of under 2 or over 12 characters.
RULES = {
    "symbols_failed": lambda m: (m["n_words"] > 0) & (10 * m["n_symbols"] > m["n_words"]),
    "lines_failed": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "length_failed": lambda m: (m["n_words"] > 0) & ((m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"])),
}
_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_VERDICTS = ", ".join(f"{c} boolean" for c in ("base_failed", *RULES, "failed"))


def measure(texts: list[bytes], known: WordHashes) -> dict[str, np.ndarray]:
    """The five measures of every text, and n_lines (with a word)."""
    hashes, starts = hash_words(texts, known)
    n_words = np.diff(starts)
    three = windows(hashes, 3)
    repeated = np.zeros(len(hashes) + 2, bool)
    if len(three):
        owner = owners(starts)
        within = np.flatnonzero(owner[: len(three)] == owner[2:])
        key = mix(three[within] ^ mix(owner[within].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        found = within[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        for shift in range(3):
            repeated[found + shift] = True
    dup_lines, n_lines = np.zeros(len(texts), np.int64), np.minimum(n_words, 1)
    for i, x in enumerate(texts):
        if b"\n" in x:
            lines = [line for line in x.split(b"\n") if line.strip(SPACES)]
            dup_lines[i], n_lines[i] = len(lines) - len(set(lines)), len(lines)
    return {
        "n_words": n_words,
        "word_chars": np.fromiter((len(x.translate(None, SPACES + _CONTINUED)) for x in texts), np.int64, len(texts)),
        "n_symbols": np.fromiter((len(x) - len(x.translate(None, SYMBOLS)) for x in texts), np.int64, len(texts)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": sums(repeated[: len(hashes)], starts),
        "n_lines": n_lines,
    }


def failing(m: dict[str, np.ndarray]) -> np.ndarray:
    """The base rule: too few words, or over half of them in three-word windows that the text repeats."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def verdicts(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Per rule whether a document fails it, and ``failed``: it fails any."""
    found = {"base_failed": failing(m), **{name: rule(m) for name, rule in RULES.items()}}
    return {**found, "failed": np.logical_or.reduce(list(found.values()))}


def document_measures(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: key, host, the measures and the verdict of every rule."""

    def run(batches):
        known = WordHashes()
        for part, texts in in_chunks(batches):
            m = measure(texts, known)
            columns = {**m, **verdicts(m)}
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("host"), *(pa.array(x) for x in columns.values())], ["key", "host", *columns])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"key long, host string, {_MEASURES}, n_lines long, {_VERDICTS}")


def host_rates(measures: DataFrame) -> DataFrame:
    """Per host: documents, failures, the shrunk rate (posterior mean) and the plain rate.

    The prior's mean is the mean of the hosts' rates and its strength follows from their variance beyond what counting
    alone explains; without such excess (or with one host) the prior is as strong as the mean host is large.
    """
    hosts = stage(
        measures.filter("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")),
        "hosts",
    )
    rate = F.col("n_failed") / F.col("n_docs")
    fit = hosts.agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("variance"), F.avg(F.lit(1.0) / F.col("n_docs")).alias("inverse"), F.avg("n_docs").alias("size")
    ).first()
    mean = min(max(fit["mean"] or 0.0, 1e-6), 1 - 1e-6)
    spread = mean * (1 - mean)
    excess = (fit["variance"] or 0.0) - spread * (fit["inverse"] or 0.0)
    strength = max(spread / excess - 1, 1.0) if excess > 0 else max(fit["size"] or 1.0, 1.0)
    return hosts.select("host", "n_docs", "n_failed", rate.alias("rate"), ((F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)).alias("shrunk_rate"))


def judge(docs: DataFrame, reject_rate: float = 0.75, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Every document with its measures, its host's shrunk rate and ``kept``: its own rules hold and its host is not rejected.

    A host is rejected at a shrunk rate of ``reject_rate`` or more.
    """
    measures = stage(document_measures(docs, key, text, host), "measures")
    hosts = host_rates(measures).select(F.col("host").alias("of_host"), "shrunk_rate")
    judged = measures.join(hosts, F.col("host") == F.col("of_host"), "left").drop("of_host")
    rejected = F.coalesce(F.col("shrunk_rate") >= reject_rate, F.lit(False))
    return judged.withColumn("kept", ~F.col("failed") & ~rejected).drop("n_lines", *RULES, "failed")


def keep_good(docs: DataFrame, reject_rate: float = 0.75, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns; their text is never shuffled for its own rules."""
    measures = stage(document_measures(docs, key, text, host).select("host", "failed"), "measures")
    rejected = host_rates(measures).filter(F.col("shrunk_rate") >= reject_rate).select(F.col("host").alias("__rejected_host"))

    def run(batches):
        known = WordHashes()
        for part, texts in in_chunks(batches, text=text):
            yield part.filter(pa.array(~verdicts(measure(texts, known))["failed"]))

    passed = docs.mapInArrow(run, docs.schema)
    return passed.join(rejected, F.col(host).cast("string") == F.col("__rejected_host"), "left_anti")
