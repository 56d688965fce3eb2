"""Personal data by fixed patterns, and information-theoretic sanitisation of the terms around it. Native expressions only.

Fixed patterns find the protected entities: e-mail and IP addresses, card and telephone numbers. A term that stands in the same
documents is no pattern, but it may still give the entity away: over the whole corpus, the pointwise mutual information of term t
and entity e, log2(N n(t,e) / (n(t) n(e))), against the information of the entity itself, log2(N / n(e)), is the share of the entity
that the term discloses (1: the term never occurs without it). Counts are documents; n(t,e) counts those that hold both, however
far apart. Terms at or above the disclosure threshold are sensitive in every document that holds the entity, and all their mentions
there are added as kind ``term``. Two conditions keep out copies and chance: the documents show the entity in two different
contexts at least (``around`` characters on both sides tell contexts apart; they bound no search), and the evidence, n(t,e) times
the mutual information, is more bits than it takes to name one of all documents. ``generalise`` replaces spans by their kind.

Terms are taken from the whole text outside e-mail addresses. An entity of one document discloses nothing by these counts. A term
can pass for an entity only if n(t) <= N^(1-threshold) n(e)^threshold, as n(t,e) <= n(e); so before terms meet entities, a filter
of fixed size drops the terms that are too frequent for entities of up to ``_COMMON`` documents (the few others meet all terms),
and counts are combined before their shuffle. The result is that of counting every pair.

Null text is empty and has no spans. Repeated rows are separate documents and get equal spans; so are rows with a null key. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bitmap import likely_in
from shelfmark.llm.scratch import stage

#: Runs are possessive, so that long texts neither backtrack nor recurse; an attempt starts where a run starts or the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_TERM = r"\p{L}[\p{L}\p{N}]++"
_BLOCK = 64
_SPAN = "array<struct<start:bigint,end:bigint,value:string,context:bigint>>"
_SALTS = 16  # parts of a key that many documents share
_COMMON = 1000  # documents of an entity that meets all terms


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(steps: Column) -> Column:
    """Sums of all steps before each step. Blocks keep the appended arrays short, so that time stays near linear."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))
    part = lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))
    append = lambda so_far, step: F.concat(so_far, F.array(F.element_at(so_far, -1) + step))
    start = F.array(F.lit(0).cast("bigint"))
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0).cast("bigint"), lambda a, x: a + x))
    inside = lambda base: F.transform(
        blocks, lambda b: F.slice(F.aggregate(part(b), F.array(base[b]), append), F.lit(1), F.size(part(b)))
    )
    return F.when(F.size(steps) == 0, F.array().cast("array<bigint>")).otherwise(
        _let(F.aggregate(totals, start, append), lambda base: F.flatten(inside(base)))
    )


def _cut(text: Column, pattern: str) -> Column:
    """The matches, and the text between them: one piece more."""
    return F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))


def located(text: Column, pattern: str, around: int = 0) -> Column:
    """Every match with its place in code points and a hash of up to ``around`` characters on both sides, no further than the next match.

    Text between matches (``split``) and the matches (``regexp_extract_all``) alternate, so places are running sums of lengths.
    """

    def build(both: Column) -> Column:
        hits, gaps = both["hits"], both["gaps"]
        steps = F.transform(hits, lambda h, i: (F.length(gaps[i]) + F.length(h)).cast("bigint"))
        beside = lambda i: F.xxhash64(F.right(gaps[i], F.lit(around)), F.left(gaps[i + 1], F.lit(around))) if around else F.lit(0).cast("bigint")

        def rows(before: Column) -> Column:
            return F.transform(hits, lambda h, i: _let(
                before[i] + F.length(gaps[i]),
                lambda start: F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("value"), beside(i).alias("context")),
            ))

        return _let(steps, lambda s: _let(_running(s), rows))

    return _let(_cut(text, pattern), build)


def _outside(text: Column) -> Column:
    """The text with e-mail addresses blanked, so that places stay. The other kinds hold no letters, hence no terms."""
    blanked = lambda both: F.array_join(
        F.transform(both["gaps"], lambda g, i: F.concat(g, F.repeat(F.lit(" "), F.coalesce(F.length(F.get(both["hits"], i)), F.lit(0))))), ""
    )
    return F.when(F.contains(text, F.lit("@")), _let(_cut(text, PATTERNS["email"]), blanked)).otherwise(text)


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.lower))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"),
    "card": lambda v: F.length(_digits(v)).between(13, 19) & F.call_function("luhn_check", _digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
_SAME = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}


def base_spans(text: Column, kind: str, around: int) -> Column:
    """Valid matches of one kind; texts that cannot hold one skip the search."""
    possible = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))
    found = F.filter(located(text, PATTERNS[kind], around), lambda s: _VALID[kind](s["value"]))
    return F.when(possible, found).otherwise(F.array().cast(_SPAN))


def _entities(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), _SAME[kind](s["value"]).alias("entity"), s["context"].alias("context")))


def _spans(kind: str, column: str = "", prefix: str = "") -> Column:
    return F.transform(
        F.col(column or kind), lambda s: F.struct(F.lit(kind).alias("kind"), s[f"{prefix}start"].alias("start"), s[f"{prefix}end"].alias("end"))
    )


def _salted(rows: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join in which a key of many rows is dealt to ``_SALTS`` tasks; ``small`` is repeated in each."""
    dealt = rows.withColumn("salt", F.pmod("row", F.lit(_SALTS)))
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))))
    return dealt.join(copies, [*on, "salt"], how).drop("salt")


def _sensitive_mentions(found: DataFrame, n_term: DataFrame, n_docs: int, threshold: float) -> DataFrame:
    """Rows (row, term_start, term_end): all mentions of terms that disclose an entity of their document."""
    entities = found.filter("text IS NOT NULL").select("row", F.inline(F.concat(*map(_entities, PATTERNS))))
    entities = stage(entities.groupBy("row", "kind", "entity").agg(F.min("context").alias("low"), F.max("context").alias("high")), "entities")
    counted = entities.groupBy("kind", "entity").agg(F.count("*").alias("n_entity"), F.min("low").alias("least"), F.max("high").alias("most"))
    recurring = counted.filter("n_entity > 1 AND least < most").select("kind", "entity", "n_entity")
    held = _salted(entities, recurring, ["kind", "entity"]).groupBy("row").agg(F.collect_list(F.struct("kind", "entity", "n_entity", "low", "high")).alias("held"))
    holders = stage(found.select("row", "text").join(held, "row"), "holders")

    def pairs(some: Callable[[Column], Column], terms: DataFrame) -> DataFrame:
        chosen = holders.withColumn("held", F.filter("held", some)).filter(F.size("held") > 0)
        each = chosen.select("row", "held", F.explode(_distinct_terms(F.col("text"))).alias("term"))
        return likely_in(each, F.xxhash64("term"), terms, F.xxhash64("term")).select("row", "term", F.inline("held"))

    rare = n_term.filter(F.col("n_term") <= n_docs ** (1 - threshold) * _COMMON**threshold * (1 + 1e-9))
    met = pairs(lambda e: e["n_entity"] <= _COMMON, rare).unionByName(pairs(lambda e: e["n_entity"] > _COMMON, n_term))
    joint = met.groupBy("kind", "entity", "n_entity", "term").agg(F.count("*").alias("n_joint"), F.min("low").alias("low"), F.max("high").alias("high"))
    bits = F.log2(F.lit(float(n_docs)) * F.col("n_joint") / (F.col("n_term") * F.col("n_entity")))
    told = joint.filter("n_joint > 1 AND low < high").join(n_term, "term").withColumn("bits", bits)
    told = told.filter((F.col("bits") >= threshold * F.log2(n_docs / F.col("n_entity"))) & (F.col("n_joint") * F.col("bits") > F.log2(F.lit(float(n_docs)))))
    names = ["kind", "entity", "term"]
    sensitive = stage(told.select(*names), "sensitive")
    marked = likely_in(met, F.xxhash64(*names), sensitive, F.xxhash64(*names)).select("row", *names)
    marked = stage(_salted(marked, sensitive, names, "left_semi").select("row", "term").distinct(), "marked")
    mention = lambda t: F.struct(F.lower(t["value"]).alias("term"), t["start"].alias("term_start"), t["end"].alias("term_end"))
    mentions = holders.select("row", F.inline(F.transform(located(F.col("text"), _TERM), mention)))
    mentions = likely_in(mentions, F.xxhash64("row", "term"), marked, F.xxhash64("row", "term"))
    return mentions.join(marked, ["row", "term"], "left_semi").select("row", "term_start", "term_end")


def find(docs: DataFrame, threshold: float = 0.9, around: int = 120, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and ``spans`` (kind, start, end in code points, end exclusive), by kind, then start."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(F.col(key).alias("key"), content.alias("text"))
    spans = [base_spans(F.col("text"), kind, around).alias(kind) for kind in PATTERNS]
    personal = narrow.select("key", F.monotonically_increasing_id().alias("row"), "text", *spans)
    some = F.size(F.concat(*PATTERNS)) > 0
    found = stage(personal.withColumn("text", F.when(some, _outside(F.col("text")))), "personal")
    n_term = narrow.select(F.explode(_distinct_terms(_outside(F.col("text")))).alias("term"))
    n_term = stage(n_term.groupBy("term").agg(F.count("*").alias("n_term")).filter("n_term > 1"), "terms")
    hits = _sensitive_mentions(found, n_term, max(found.count(), 1), threshold)
    hits = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term_start", "term_end"))).alias("terms"))
    none = F.array().cast("array<struct<term_start:bigint,term_end:bigint>>")
    bare = found.select("key", "row", F.concat(*map(_spans, PATTERNS)).alias("base"))
    both = bare.join(hits, "row", "left").withColumn("terms", F.coalesce("terms", none))
    return both.select("key", F.concat("base", _spans("term", "terms", "term_")).alias("spans"))


def generalise(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the one that starts first stands."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda a, s: F.array(
        F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.concat(F.lit("["), s["kind"], F.lit("]"))
    )
    step = lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), F.concat(a["out"], piece(a, s)).alias("out")))
    end = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(ordered, state, step, end)


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
