"""Page attributes as native expressions over stored HTML.

Elements are found by one regex for the open tag; where a rule needs everything inside an
element, the text after the tag is split at tags of the same name and folded by depth until
the element closes. Each rule is guarded by a substring test, so a page pays only for the
markup it has, and no page leaves the JVM.

The functions take and return SQL expression text, for ``F.expr``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from shelfmark.functions.sqltext import Sql, each, let, lit, raw, var

# Element ids and classes, keys and phrases that define the results.
PRICE_IDS = ["priceblock_ourprice", "priceblock_dealprice"]
BULLET_LIST_CLASSES = ["a-unordered-list", "a-vertical", "a-spacing-mini"]
RESULT_LINK_CLASSES = ["a-link-normal", "s-line-clamp-4", "s-link-style", "a-text-normal"]
RESULT_LINK_CLASSES_EARLY = ["a-link-normal", "s-link-style", "a-text-normal"]
BRAND_CLASSES = ["a-size-base-plus", "a-color-base"]
HEADING_CLASSES = ["a-size-base-plus", "a-spacing-none", "a-color-base", "a-text-normal"]
BARCODE_KEYS = ["EAN", "EAN-13", "UPC", "Barcode", "ASIN", "Manufacturer barcode"]
BLOCK_PHRASES = ["robot check", "press and hold", "enter the characters you see"]
BLOCK_PHRASES_SEARCH = [
    "robot check", "captcha", "enter the characters you see below",
    "we have detected unusual traffic", "are you a human",
]

# Regexes. Quotes delimit a value only right after "="; possessive loops keep matching linear.
_TAG_REST = r"""(?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+>"""
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
_HIDDEN = (
    r"<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>"
)
_TAG = r"<[/!?a-zA-Z]" + _TAG_REST
_SPACE = r"[\s\x1c-\x1f]"
_WORD = r"[^\s\x1c-\x1f]"
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_MARK = "chr(1)"

# HTML 4 entity names as one literal: "name<3>character" entries joined by <2>.
_ENTITIES = "\x02".join(f"{name}\x03{chr(code)}" for name, code in (*name2codepoint.items(), ("apos", 39)))

def strip(text: Sql) -> Sql:
    return f"regexp_replace({text}, {raw(rf'(?U)^{_SPACE}+|{_SPACE}+' + chr(92) + 'z')}, '')"


def empty_to_null(text: Sql) -> Sql:
    return f"nullif({text}, '')"


def _skip_to(name: str) -> str:
    # The attributes before the wanted one, then its name.
    return rf"(?:[\s/]+(?!(?i:{name})[\s=/>])[^\s>/=]+(?:\s*=\s*{_VALUE})?)*+[\s/]+(?i:{name})"


def _quoted(value: str) -> str:
    return rf"""\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>]))"""


def any_tag(tag: str) -> str:
    return rf"<(?i:{tag})(?=[\s/>])" + _TAG_REST


def by_id(element_id: str, tag: str = "[a-zA-Z][a-zA-Z0-9]*") -> str:
    return rf"<(?i:{tag})" + _skip_to("id") + _quoted(element_id) + _TAG_REST


def by_classes(tag: str, classes: list[str]) -> str:
    wanted = "".join(rf"""(?=(?:[^"'>]*\s)?{name}[\s"'>])""" for name in classes)
    value = rf"""\s*=\s*(?:"{wanted}[^"]*"|'{wanted}[^']*'|{wanted}[^\s"'>]+)"""
    return rf"<(?i:{tag})" + _skip_to("class") + value + _TAG_REST


def by_attribute(tag: str, name: str, value: str | None = None) -> str:
    wanted = r"(?=[\s=/>])" if value is None else _quoted(value)
    return rf"<(?i:{tag})" + _skip_to(name) + wanted + _TAG_REST


def visible_markup(html: Sql) -> Sql:
    """The page without comments, scripts, styles and templates; a bare tag marks each gap."""
    return f"regexp_replace(coalesce({html}, ''), {raw('(?is)' + _HIDDEN)}, '<!>')"


def decode_entities(text: Sql) -> Sql:
    """Decode ``&name;`` for the HTML 4 names and numeric references; others stay as written."""
    names = f"str_to_map({lit(_ENTITIES)}, chr(2), chr(3))"
    whole = r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});|[^&]+|&"

    def point(code: Sql) -> Sql:
        valid = f"{code} > 0 AND {code} < 1114112 AND {code} NOT BETWEEN 55296 AND 57343"
        return f"decode(unhex(lpad(hex(CASE WHEN {valid} THEN {code} ELSE 65533 END), 8, '0')), 'UTF-32')"

    def piece(p: Sql) -> Sql:
        number = (
            f"CAST(CASE WHEN lower(substr({p}, 3, 1)) = 'x' THEN conv(regexp_extract({p}, '[0-9a-fA-F]+', 0), 16, 10)"
            f" ELSE regexp_extract({p}, '[0-9]+', 0) END AS BIGINT)"
        )
        named = f"coalesce(element_at({names}, regexp_extract({p}, '[A-Za-z0-9]+', 0)), {p})"
        return (
            f"CASE WHEN NOT startswith({p}, '&') OR {p} = '&' THEN {p}"
            f" WHEN startswith({p}, '&#') THEN {let(number, point)} ELSE {named} END"
        )

    def decoded(t: Sql) -> Sql:
        pieces = each("transform", f"regexp_extract_all({t}, {raw(whole)}, 0)", piece)
        return f"CASE WHEN contains({t}, '&') THEN array_join({pieces}, '') ELSE {t} END"

    return let(text, decoded)


def joined_strings(markup: Sql, separator: str) -> Sql:
    """Text nodes, each stripped, empty ones dropped, joined by ``separator``."""
    marked = decode_entities(f"regexp_replace({markup}, {raw(_TAG)}, {_MARK})")
    edge = r"[\s\x01\x1c-\x1f]"
    ends = raw(rf"(?U)^{edge}++|(?<!{edge}){edge}++\z")
    gaps = raw(rf"(?U)(?<!{_SPACE}){_SPACE}*+\x01{edge}*+")
    return f"regexp_replace(regexp_replace({marked}, {ends}, ''), {gaps}, {lit(separator)})"


def page_text(markup: Sql) -> Sql:
    """Text nodes as they are, one tag gap per line break."""
    return decode_entities(f"regexp_replace({markup}, {raw(_TAG)}, chr(10))")


def is_unusable(markup: Sql, phrases: list[str] = BLOCK_PHRASES) -> Sql:
    """The visible text holds one of the block-page phrases."""
    return let(
        f"lower({joined_strings(markup, ' ')})",
        lambda text: "(" + " OR ".join(f"contains({text}, {lit(p)})" for p in phrases) + ")",
    )


def inner(markup: Sql, open_tag: str) -> Sql:
    """Everything inside the first element whose open tag matches; null if there is none."""

    def cut(pieces: Sql) -> Sql:
        # Walk the tags of that name from depth 1; the element ends where the depth reaches 0.
        a, p = var(), var()
        depth = f"({a}.depth + CASE WHEN startswith({p}, '</') THEN -1 WHEN startswith({p}, '<') THEN 1 ELSE 0 END)"
        fold = (
            f"aggregate({pieces}, named_struct('i', 0, 'depth', 1, 'stop', -1), ({a}, {p}) -> named_struct("
            f"'i', {a}.i + 1, 'depth', {depth},"
            f" 'stop', CASE WHEN {a}.stop < 0 AND {depth} = 0 THEN {a}.i ELSE {a}.stop END)).stop"
        )
        return let(
            fold,
            lambda stop: f"array_join(slice({pieces}, 1, CASE WHEN {stop} < 0 THEN size({pieces}) ELSE {stop} END), '')",
        )

    def find(text: Sql) -> Sql:
        tag = f"regexp_extract({text}, {raw(open_tag)}, 0)"
        name = f"regexp_extract({tag}, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)"
        after = f"get(split({text}, {raw(open_tag)}, 2), 1)"
        same = f"concat('(?i)(?=</?', {name}, {raw(r'[\s/>])')})"
        # The leading mark keeps the first piece apart from the tags of the same name.
        return f"CASE WHEN {tag} <> '' THEN substr({let(f'split(concat({_MARK}, {after}), {same})', cut)}, 2) END"

    return let(markup, find)


def outermost(markup: Sql, open_tag: str) -> Sql:
    """The elements whose open tag matches and that lie in no other such element, each whole up to its own end tag, one after the other.

    One walk over the tags of that name; an element that is not closed goes on to the end."""
    name = re.match(r"<\(\?i:(\w+)\)", open_tag)[1]

    def find(pieces: Sql) -> Sql:
        a, p, s = var(), var(), var()
        starts = lambda tag: f"rlike({p}, {raw(rf'^(?i:{tag})[\s/>]')})"
        step = f"CASE WHEN {starts('<' + name)} THEN 1 WHEN {starts('</' + name)} THEN -1 ELSE 0 END"
        depth = f"CASE WHEN {a}.depth > 0 THEN {a}.depth + {step} WHEN rlike({p}, {raw(f'^{open_tag}')}) THEN 1 ELSE 0 END"
        span = lambda end: f"concat({a}.spans, array(named_struct('begin', {a}.begin, 'end', {end})))"
        walk = let(depth, lambda d: (
            f"named_struct('i', {a}.i + 1, 'depth', {d}, 'begin', CASE WHEN {a}.depth = 0 THEN {a}.i ELSE {a}.begin END,"
            f" 'spans', CASE WHEN {a}.depth > 0 AND {d} = 0 THEN {span(f'{a}.i')} ELSE {a}.spans END)"
        ))
        zero = "named_struct('i', 0, 'depth', 0, 'begin', 0, 'spans', CAST(array() AS ARRAY<STRUCT<begin: INT, end: INT>>))"
        spans = f"aggregate({pieces}, {zero}, ({a}, {p}) -> {walk}, {a} -> CASE WHEN {a}.depth > 0 THEN {span(f'{a}.i')} ELSE {a}.spans END)"
        text = f"array_join(slice({pieces}, {s}.begin + 1, {s}.end - {s}.begin), '')"
        return f"array_join(transform({spans}, {s} -> {text}), {_MARK})"

    return let(f"split(concat({_MARK}, {markup}), {raw(rf'(?i)(?=</?{name}[\s/>])')})", find)


def first_below_markup(markup: Sql, outer: str, wanted: str) -> Sql:
    """Content of the first ``wanted`` element that lies inside an ``outer`` one, whatever is nested; null if none does."""
    outer_name, wanted_name = (re.match(r"<\(\?i:(\w+)\)", tag)[1] for tag in (outer, wanted))

    def find(pieces: Sql) -> Sql:
        # Depth counts elements of the outer's name; ``top`` is the depth of the open outer element, 0 if none is open.
        a, p = var(), var()
        starts = lambda tag: f"rlike({p}, {raw(rf'^(?i:{tag})[\s/>]')})"
        step = f"CASE WHEN {starts('<' + outer_name)} THEN 1 WHEN {starts('</' + outer_name)} THEN -1 ELSE 0 END"
        depth = f"greatest({a}.depth + {step}, 0)"
        walk = let(depth, lambda d: (
            f"named_struct('i', {a}.i + 1, 'depth', {d},"
            f" 'top', CASE WHEN {a}.top > 0 THEN if({d} < {a}.top, 0, {a}.top) WHEN rlike({p}, {raw(f'^{outer}')}) THEN {d} ELSE 0 END,"
            f" 'hit', CASE WHEN {a}.hit < 0 AND {a}.top > 0 AND rlike({p}, {raw(f'^{wanted}')}) THEN {a}.i ELSE {a}.hit END)"
        ))
        hit = f"aggregate({pieces}, named_struct('i', 0, 'depth', 0, 'top', 0, 'hit', -1), ({a}, {p}) -> {walk}).hit"
        rest = lambda i: inner(f"array_join(slice({pieces}, {i} + 1, size({pieces})), '')", wanted)
        return let(hit, lambda i: f"CASE WHEN {i} >= 0 THEN {rest(i)} END")

    tags = rf"(?i)(?=</?(?:{outer_name}|{wanted_name})[\s/>])"
    return let(f"split(concat({_MARK}, {markup}), {raw(tags)})", find)


def first_below(markup: Sql, outer: str, wanted: str) -> Sql:
    return joined_strings(first_below_markup(markup, outer, wanted), "")


def attribute(tag: Sql, name: str) -> Sql:
    """Value of an attribute of one open tag; null when absent or empty."""
    pattern = raw(
        r"^<[a-zA-Z][a-zA-Z0-9]*" + _skip_to(name) + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    )
    # One of the three groups is filled.
    groups = lambda t: "concat(" + ", ".join(f"regexp_extract({t}, {pattern}, {i})" for i in (1, 2, 3)) + ")"
    return empty_to_null(decode_entities(let(tag, groups)))


def _text_of(markup: Sql, guard: str, open_tag: str) -> Sql:
    # Text of the first matching element: null without the element, "" when it is empty.
    return f"CASE WHEN contains({markup}, '{guard}') THEN {joined_strings(inner(markup, open_tag), '')} END"


def title(markup: Sql, fallback_h1: bool = False) -> Sql:
    """Product title; the variant falls back to the first ``h1`` when the title element is absent."""
    text = _text_of(markup, "productTitle", by_id("productTitle"))
    if fallback_h1:
        text = f"coalesce({text}, {joined_strings(inner(markup, any_tag('h1')), '')})"
    return empty_to_null(f"trim(regexp_replace({text}, {raw(f'(?U){_SPACE}+')}, ' '))")


def search_heading(markup: Sql) -> Sql:
    """Title of a candidate's page: the first ``span`` inside the styled ``h2``."""
    heading = first_below(markup, by_classes("h2", HEADING_CLASSES), any_tag("span"))
    return f"CASE WHEN contains({markup}, 'a-text-normal') THEN {heading} END"


def price(markup: Sql) -> Sql:
    """First non-empty of four price elements, in priority order, as raw text."""
    offscreen = by_classes("span", ["a-offscreen"])
    options = [_text_of(markup, name, by_id(name, "span")) for name in PRICE_IDS]
    options.append(
        f"CASE WHEN contains({markup}, 'a-offscreen') AND contains({markup}, 'a-price')"
        f" THEN {first_below(markup, by_classes('span', ['a-price']), offscreen)} END"
    )
    options.append(_text_of(markup, "a-offscreen", offscreen))
    return "coalesce(" + ", ".join(empty_to_null(option) for option in options) + ")"


def image(markup: Sql) -> Sql:
    """High-resolution source, else source, of the landing image, else the ``og:image`` link."""
    box = inner(markup, by_id("imgTagWrapperId"))
    sources = let(
        f"regexp_extract({box}, {raw(by_id('landingImage', 'img'))}, 0)",
        lambda tag: f"coalesce({attribute(tag, 'data-old-hires')}, {attribute(tag, 'src')})",
    )
    meta = f"regexp_extract({markup}, {raw(by_attribute('meta', 'property', 'og:image'))}, 0)"
    return (
        f"coalesce(CASE WHEN contains({markup}, 'landingImage') THEN {sources} END,"
        f" CASE WHEN contains({markup}, 'og:image') THEN {attribute(meta, 'content')} END)"
    )


def list_items(markup: Sql, in_list: bool = False) -> Sql:
    """Non-empty texts of the ``li`` elements, in order; ``in_list`` keeps only those below a ``ul``.

    An item runs to its own close tag, to the next item of the same list, or to the end of its
    list, whichever comes first.
    """
    starts = lambda p, tag: f"rlike({p}, {raw(f'^(?i)<{tag}' + r'[\s/>]')})"
    kinds = [("li", "item"), ("/li", "end"), ("ul", "ul"), ("ol", "ol"), ("/ul", "ul end"), ("/ol", "ol end")]
    kind = lambda p: "CASE " + " ".join(f"WHEN {starts(p, tag)} THEN '{k}'" for tag, k in kinds) + " ELSE '' END"

    nothing = lambda *names: f"CAST(array() AS ARRAY<STRUCT<{', '.join(f'{n}: INT' for n in names)}>>)"
    state = lambda i, depth, uls, open_: f"'i', {i}, 'depth', {depth}, 'uls', {uls}, 'open', {open_}"

    def advance(a: Sql, p: Sql) -> Sql:
        # One tag: the items it ends move from ``open`` to ``closed``, an item it starts is opened.
        step = lambda names: f"CASE {p} " + " ".join(f"WHEN '{n}' THEN 1 WHEN '{n} end' THEN -1" for n in names) + " ELSE 0 END"
        now = f"named_struct('depth', {a}.depth + {step(['ul', 'ol'])}, 'uls', {a}.uls + {step(['ul'])})"

        def after(s: Sql) -> Sql:
            ends = lambda o: (
                f"CASE WHEN {p} IN ('item', 'end') THEN {o}.depth = {s}.depth"
                f" WHEN {p} IN ('ul end', 'ol end') THEN {o}.depth > {s}.depth ELSE false END"
            )
            ended = each("filter", f"{a}.open", ends)
            closed = each("transform", ended, lambda o: f"named_struct('start', {o}.start, 'stop', {a}.i)")
            wanted = f"{p} = 'item'" + (f" AND {s}.uls > 0" if in_list else "")
            opened = f"CASE WHEN {wanted} THEN array(named_struct('start', {a}.i, 'depth', {s}.depth)) ELSE {nothing('start', 'depth')} END"
            still = each("filter", f"{a}.open", lambda o: f"NOT {ends(o)}")
            carried = state(f"{a}.i + 1", f"{s}.depth", f"{s}.uls", f"concat({still}, {opened})")
            return f"named_struct({carried}, 'closed', concat({a}.closed, {closed}))"

        return let(now, after)

    def item_texts(pieces: Sql) -> Sql:
        # Walked in runs of about the square root of all tags, since a growing array is copied at each step.
        def walk(kinds: Sql, run: Sql) -> Sql:
            a, r, b, p = var(), var(), var(), var()
            begin = f"named_struct({state(f'{a}.i', f'{a}.depth', f'{a}.uls', f'{a}.open')}, 'closed', {nothing('start', 'stop')})"
            one = f"aggregate(slice({kinds}, {r} * {run} + 1, {run}), {begin}, ({b}, {p}) -> {advance(b, p)})"
            step = let(one, lambda x: (
                f"named_struct({state(f'{x}.i', f'{x}.depth', f'{x}.uls', f'{x}.open')}, 'runs', concat({a}.runs, array({x}.closed)))"
            ))
            zero = f"named_struct({state(0, 0, 0, nothing('start', 'depth'))}, 'runs', array({nothing('start', 'stop')}))"
            runs = f"sequence(0, CAST((size({kinds}) - 1) div {run} AS INT))"
            return f"aggregate({runs}, {zero}, ({a}, {r}) -> {step})"

        def texts(end: Sql) -> Sql:
            unended = each("transform", f"{end}.open", lambda o: f"named_struct('start', {o}.start, 'stop', {end}.i)")
            items = f"sort_array(concat(flatten({end}.runs), {unended}))"
            return each("transform", items, lambda x: f"array_join(slice({pieces}, {x}.start + 1, {x}.stop - {x}.start), '')")

        kinds_of = each("transform", pieces, kind)
        run_of = lambda kinds: f"CAST(ceil(sqrt(size({kinds}))) AS INT)"
        return let(let(kinds_of, lambda kinds: let(run_of(kinds), lambda run: walk(kinds, run))), texts)

    pieces = f"split(concat({_MARK}, {markup}), {raw(r'(?i)(?=</?(?:li|ul|ol)[\s/>])')})"
    items = let(pieces, item_texts)
    texts = each("transform", items, lambda x: joined_strings(x, " "))
    return each("filter", texts, lambda x: f"{x} <> ''")


def description(markup: Sql) -> Sql:
    """Bullet texts of the first of three containers that has any, joined by `` | ``; else null."""

    def bullets(guard: str, open_tag: str, in_list: bool = False) -> Sql:
        found = f"array_join({list_items(inner(markup, open_tag), in_list)}, ' | ')"
        return f"CASE WHEN contains({markup}, '{guard}') THEN {empty_to_null(found)} END"

    options = [
        bullets("feature-bullets", by_id("feature-bullets"), in_list=True),
        bullets("productDetails_feature_div", by_id("productDetails_feature_div")),
        bullets("a-spacing-mini", by_classes("ul", BULLET_LIST_CLASSES)),
    ]
    return "coalesce(" + ", ".join(options) + ")"


def _any_key(text: Sql) -> Sql:
    return f"rlike({text}, {raw('(?i)' + '|'.join(BARCODE_KEYS))})"


def _barcode_row(markup: Sql) -> Sql:
    # Value of the first detail-table row whose header holds a key; "" when that value is empty.
    table = f"coalesce({inner(markup, by_id('productDetails_detailBullets_sections1'))}, '')"
    cell = lambda row, tag: joined_strings(inner(row, any_tag(tag)), "")
    cells = each(
        "transform", f"split({table}, {raw(r'(?i)(?=<tr[\s/>])')})",
        lambda row: f"named_struct('head', {cell(row, 'th')}, 'value', {cell(row, 'td')})",
    )
    hits = each("filter", cells, lambda c: f"{_any_key(f'{c}.head')} AND {c}.value IS NOT NULL")
    return f"get({hits}, 0).value"


def _barcode_line(text: Sql) -> Sql:
    # Keys in order, then lines in order: after the first colon, or the last of several words.
    several = raw(rf"(?U){_WORD}{_SPACE}+{_WORD}")
    last = raw(rf"(?U)({_WORD}+){_SPACE}*\z")

    def value(line: Sql) -> Sql:
        after = strip(f"substr({line}, instr({line}, ':') + 1)")
        return f"CASE WHEN contains({line}, ':') THEN {after} ELSE regexp_extract({line}, {last}, 1) END"

    def first_value(lines: Sql, key: str) -> Sql:
        usable = each(
            "filter", lines,
            lambda x: f"contains(lower({x}), {lit(key.lower())}) AND (contains({x}, ':') OR rlike({x}, {several}))",
        )
        return let(f"get({usable}, 0)", value)

    lines = each("filter", f"split({text}, {raw(_LINE_BREAK)})", _any_key)
    return let(lines, lambda ls: "coalesce(" + ", ".join(first_value(ls, key) for key in BARCODE_KEYS) + ")")


def barcode(markup: Sql) -> Sql:
    """Barcode from the detail table, else a labelled line, else a bare run of 8-14 digits."""
    digits = raw(r"(?U)\b\d{8,14}\b")
    found = let(
        page_text(markup),
        lambda text: f"coalesce(CASE WHEN {_any_key(text)} THEN {_barcode_line(text)} END,"
        f" {empty_to_null(f'regexp_extract({text}, {digits}, 0)')})",
    )
    table = f"CASE WHEN contains({markup}, 'productDetails_detailBullets_sections1') THEN {_barcode_row(markup)} END"
    return empty_to_null(f"coalesce({table}, {found})")


def result_blocks(markup: Sql, early: bool = False) -> Sql:
    """Search results in all slots of a page, in order: an array of ``href``, ``brand`` and ``title``, each from inside its block.

    ``early`` takes the earlier variant's looser link and title rules. Only the rules asked for are evaluated: nothing below would
    drop the fields of a struct that is made in a lambda.
    """
    block = by_attribute("div", "data-component-type", "s-search-result")
    span, h2, link = any_tag("span"), any_tag("h2"), any_tag("a")

    def first_link(piece: Sql) -> Sql:
        heads = f"split(concat({_MARK}, {piece}), {raw(r'(?i)(?=<h2[\s/>])')})"
        links = let(heads, lambda hs: each(
            "transform", f"slice({hs}, 2, size({hs}))", lambda head: f"regexp_extract({inner(head, h2)}, {raw(link)}, 0)"
        ))
        return f"get({each('filter', links, lambda tag: f'{tag} <> {chr(39) * 2}')}, 0)"

    def fields(piece: Sql) -> Sql:
        tag = f"regexp_extract({piece}, {raw(by_classes('a', RESULT_LINK_CLASSES))}, 0)"
        title = first_below(piece, by_attribute("h2", "aria-label"), span)
        if early:
            tag = let(
                f"regexp_extract({piece}, {raw(by_classes('a', RESULT_LINK_CLASSES_EARLY))}, 0)",
                lambda tag: f"CASE WHEN {tag} <> '' THEN {tag} ELSE {first_link(piece)} END",
            )
            title = f"coalesce({title}, {joined_strings(inner(first_below_markup(piece, h2, link), span), '')})"
        brand = first_below(piece, by_classes("h2", ["a-size-mini"]), by_classes("span", BRAND_CLASSES))
        return f"named_struct('href', {attribute(tag, 'href')}, 'brand', {brand}, 'title', {title})"

    def inside(markup: Sql, tag: str, body: Callable[[Sql], Sql]) -> Sql:
        # The body of each element of that tag, up to its own end.
        starts = f"split(concat({_MARK}, {markup}), {raw(f'(?={tag})')})"
        return let(starts, lambda ps: each("transform", f"slice({ps}, 2, size({ps}))", lambda p: let(inner(p, tag), body)))

    found = inside(outermost(markup, by_classes("div", ["s-main-slot"])), block, fields)
    return f"CASE WHEN contains({markup}, 's-search-result') THEN {found} END"
