"""Weight, units per carton and packaging read from free-text product names.

Each rule is guarded by a plain substring test, so most names never reach the regex engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.sqltext import Sql, let, lit, raw, var
from shelfmark.functions.text import ASCII_DIGITS, UNICODE_DIGITS, strip

# The extraction patterns and unit lists that define the results.
WEIGHT = r"(\d+(?:\.\d+)?)\s*(KG|KGS|G|GM|GR|GRAM|GRAMS|L|LTR|LITRE|ML|M L|LT)(?=[\s\*×X0-9\W]|$)"
WEIGHT_EARLY = r"(\d+(?:\.\d+)?\s?(?:KG|g|G|GM|L|ML|ml|l|gm|kg))"
TIMES_THOUSAND = ["KG", "KGS", "L", "LTR", "LITRE"]
PIECES = r"(\d+)\s*(PCS|PC|PS)\b"
PIECES_EARLY = r"(\d+)\s*(PCS|PC)\b"
BRACKET = r"\(\s*[\d\.]+\s*(?:ML|L|G|KG)?\s*[*×X]\s*(\d+)\s*\)"
BEFORE_UNIT = r"(\d+)\s*[*×X]\s*[\d\.]+\s*(?:ML|L|LTR|G|KG|MIL|OZ)"
BEFORE_UNIT_EARLY = r"(\d+)\s*[*×X]\s*[\d\.]+\s*(?:ML|L|LTR|G|KG)"
TIMES_CHAIN = r"(\d+)\s*[X×]\s*(?=\d+)"
SINGLE_TIMES = r"\b(\d+)\s*[X×]\s*\d*\s*(?:KG|G|GM|L|ML)\b"
BAGS = r"\b(\d+)\s*(BAG|BAGS|TEABAG|TEABAGS|TEA BAGS|STICKS)\b"
PLUS = r"(\d+)\s*\+\s*(\d+)"
AFTER_TIMES = r"[*×X]\s*(\d+)"

CARTON_WORDS = ["CTN", "CARTON"]

# The number at the start of a weight match.
AMOUNT = r"(?U)^[\d.]+"

FINAL_RULES = ["pieces", "bracket", "before_unit", "chain", "single", "bags", "plus", "after"]
EARLY_RULES = ["pieces_early", "bracket", "before_unit_early", "chain", "single", "after"]


def _number(digits: Sql, kind: str = "BIGINT") -> Sql:
    # `digits` is a name: it is read three times.
    plain = f"translate({digits}, '{UNICODE_DIGITS}', '{ASCII_DIGITS}')"
    ascii_only = f"octet_length({digits}) = char_length({digits})"
    return f"try_cast(CASE WHEN {ascii_only} THEN {digits} ELSE {plain} END AS {kind})"


def _contains_any(text: Sql, words: list[str]) -> Sql:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def weight_quantity(name: Sql) -> Column:
    """First number with a unit, as whole grams (litres count as kilograms): ``2.5KG`` -> ``2500G``."""
    thousands = ", ".join(lit(unit) for unit in TIMES_THOUSAND)

    def grams(found: Sql) -> Sql:
        digits = f"regexp_extract({found}, {raw(AMOUNT)}, 0)"
        amount = let(digits, lambda d: _number(d, "DOUBLE"))
        factor = f"CASE WHEN regexp_extract({found}, '[A-Z][A-Z ]*$', 0) IN ({thousands}) THEN 1000D ELSE 1D END"
        # rint rounds halves to even
        whole = f"CAST(try_cast(rint({amount} * {factor}) AS DECIMAL(38, 0)) AS STRING)"
        return f"CASE WHEN {found} <> '' THEN {whole} || 'G' END"

    return F.expr(let(f"regexp_extract(upper({name}), {raw('(?U)' + WEIGHT)}, 0)", grams))


def weight_token(name: Sql) -> Column:
    """The earlier rule: the matched text itself, upper case and without blanks."""
    found = f"regexp_extract({name}, {raw('(?iuU)' + WEIGHT_EARLY)}, 1)"
    return F.expr(let(found, lambda token: f"CASE WHEN {token} <> '' THEN replace(upper({token}), ' ', '') END"))


def _boxed(value: Sql) -> Sql:
    # A rule that fires with a number beyond bigint yields a null, but still stops the later rules.
    return f"named_struct('units', {value})"


def _first_group(up: Sql, pattern: str) -> Sql:
    found = f"regexp_extract({up}, {raw('(?U)' + pattern)}, 1)"
    return let(found, lambda digits: f"CASE WHEN {digits} <> '' THEN {_boxed(_number(digits))} END")


def _chain(up: Sql) -> Sql:
    def product(factors: Sql) -> Sql:
        acc, digits = var(), var()
        value = f"aggregate({factors}, 1L, ({acc}, {digits}) -> try_multiply({acc}, {_number(digits)}))"
        return f"CASE WHEN size({factors}) > 0 THEN {_boxed(value)} END"

    return let(f"regexp_extract_all({up}, {raw('(?U)' + TIMES_CHAIN)}, 1)", product)


def _plus(up: Sql) -> Sql:
    def total(found: Sql) -> Sql:
        part = lambda n: let(f"regexp_extract({found}, {raw('(?U)' + PLUS)}, {n})", _number)
        return f"CASE WHEN {found} <> '' THEN {_boxed(f'try_add({part(1)}, {part(2)})')} END"

    return let(f"regexp_extract({up}, {raw('(?U)' + PLUS)}, 0)", total)


def units_per_carton(name: Sql, rules: list[str] = FINAL_RULES) -> Column:
    """Units per carton by the first rule that fires, else null."""

    def first_rule(up: Sql) -> Sql:
        times, cross = _contains_any(up, ["X", "*", "×"]), _contains_any(up, ["X", "×"])
        pieces = _contains_any(up, ["PC", "PS"])
        guarded = {
            "pieces": (pieces, _first_group(up, PIECES)),
            "pieces_early": (pieces, _first_group(up, PIECES_EARLY)),
            "bracket": (f"contains({up}, '(') AND {times}", _first_group(up, BRACKET)),
            "before_unit": (times, _first_group(up, BEFORE_UNIT)),
            "before_unit_early": (times, _first_group(up, BEFORE_UNIT_EARLY)),
            "chain": (cross, _chain(up)),
            "single": (cross, _first_group(up, SINGLE_TIMES)),
            "bags": (_contains_any(up, ["BAG", "STICKS"]), _first_group(up, BAGS)),
            "plus": (f"contains({up}, '+')", _plus(up)),
            "after": (times, _first_group(up, AFTER_TIMES)),
        }
        tried = [f"CASE WHEN {guard} THEN {value} END" for guard, value in map(guarded.get, rules)]
        return f"coalesce({', '.join(tried)}).units"

    return F.expr(let(f"upper({name})", first_rule))


def packaging_type(name: Sql) -> Column:
    carton = let(f"upper({name})", lambda up: _contains_any(up, CARTON_WORDS))
    return F.expr(f"CASE WHEN {carton} THEN 'CTN' ELSE 'NON-CTN' END")


def packaging_from_unit(unit: Column) -> Column:
    return F.when(F.upper(strip(unit)) == "CTN", "CTN").otherwise("NON-CTN")
