"""HTML extraction by equivalence-class template deduction: what a host's pages have in common is template, the slots are data.

A page is a sequence of tokens: its tags by their path, and its text blocks by path and words. Over the pages of a host, tokens with
the same occurrence vector (how often they occur on every page) form an equivalence class. A class is large and frequent when it
has several tokens and its pages are most of the host's; the tokens of such classes, in page order, are the host's template, and a
page uses the part of it that it shows in that order, so that classes nest as their tags do. Text of the template (the same menu,
notice or slogan on page after page) is boilerplate; the text in the slots between is extracted where its place is that of an
article. Places are told by elements and by class, id and role names, which also serves hosts of a single page.

The vectors are never built: a class is known by the number of pages and an exclusive-or of hashed (page, count), so any number of
pages per host is one aggregate, combined before its shuffle. Pages of a host with equal text count once, so copies are no
template. A host's template is at most a few tokens for each token of a page (each stands on most pages).

Null html or html without text gives the empty string; a null or odd url has no host and no template. Repeated rows give equal
rows. Broken markup is read as far as it goes: unclosed elements end with their parent, and
from a tag without its closing bracket on the rest of a page is text, so a scan is linear. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage
from shelfmark.llm.words import in_chunks

#: Comments, declarations and tags; quoted values may hold a closing bracket. The last group is a tag that never ends.
_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/><]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>|(<)(?=/?[A-Za-z])",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|aria-modal|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript noframes iframe noembed xmp template svg math".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption".split()
)
_SPACED = frozenset("br td th".split())
_ENDED_BY_SAME = frozenset("p li dt dd tr td th option".split())
#: Elements and name parts that are not article text, wherever they stand.
_NEVER = frozenset("nav aside footer form button select menu dialog head object canvas audio video map datalist".split())
_NEVER_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs masthead topbar footer sidebar aside widget widgets ad ads adv advert adverts advertisement "
    "advertising adsense banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent gdpr notice notices notification alert subscribe "
    "subscription newsletter signup login search share sharing social comment comments commentlist respond disqus replies related recommended copyright "
    "disclaimer toolbar pagination pager form skip".split()
)
_NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_COMMENTS = frozenset("comment comments commentlist respond disqus replies".split())
#: Names of an element that holds the article, the surest first.
_CONTENT_NAMES = ("articlebody", "article body", "article content", "post content", "entry content", "post body", "article", "entry", "story", "post", "content")
_NAME_PARTS = re.compile(r"[a-z0-9]+")
_NOT_OWN = frozenset("has with no without".split())


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in _ATTRIBUTE.finditer(source)}


class _Open:
    """An open element: its tag, path, why it is left out (or ""), and how surely it holds the article (0: not)."""

    __slots__ = ("left_out", "path", "sure", "tag")

    def __init__(self, tag: str, path: int, left_out: str, sure: int):
        self.tag, self.path, self.left_out, self.sure = tag, path, left_out, sure


_SUREST = len(_CONTENT_NAMES) + 2
_PLAIN: dict[tuple[int, str], int] = {}


def _path(parent: int, tag: str, names: str) -> int:
    key = parent, f"{tag}.{names}"
    if key not in _PLAIN:
        if len(_PLAIN) > 1 << 16:
            _PLAIN.clear()
        _PLAIN[key] = xxhash.xxh3_64_intdigest(f"{parent}/{key[1]}")
    return _PLAIN[key]


def _opened(tag: str, source: str, parent: _Open) -> _Open:
    left_out, sure, names = parent.left_out, parent.sure, ""
    if source and not source.isspace():
        a = _attributes(source)
        names = f"{a.get('class', '')} {a.get('id', '')}".lower()
        parts = _NAME_PARTS.findall(names)
        own = {p for before, p in zip(["", *parts], parts, strict=False) if before not in _NOT_OWN}
        role = a.get("role", "").lower()
        unseen = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
        if not left_out:
            if own & _COMMENTS:
                left_out = "comments"
            elif own & _NEVER_NAMES or role in _NEVER_ROLES or unseen or ("header" in own and not sure):
                left_out = "name"
        if tag in ("div", "section", "td", "article", "main") and not left_out:
            said = " ".join(parts) + " " + a.get("itemprop", "").lower()
            sure = max(sure, next((len(_CONTENT_NAMES) - i for i, name in enumerate(_CONTENT_NAMES) if f" {name} " in f" {said} "), 0))
        if role in ("main", "article"):
            tag = role
    if tag in _NEVER or (tag == "header" and not sure):
        left_out = left_out or "element"
    elif tag in ("article", "main"):
        if left_out == "name" and not parent.left_out:
            left_out = "" if not set(_NAME_PARTS.findall(names)) & _COMMENTS else "comments"
        elif parent.left_out == "name":
            left_out = ""  # a wrapper whose name only mentions a side bar or a banner
        if not left_out:
            sure = max(sure, _SUREST if tag == "article" else _SUREST - 1)
    return _Open(tag, _path(parent.path, tag, names), left_out, sure)


def blocks_of(page: str) -> tuple[list[tuple[str, int, int]], set[int]]:
    """Text blocks that are not left out (text, path, how surely an article's) in page order, and the paths of all elements."""
    top = _Open("", 0, "", 0)
    stack, counts = [top], {}
    found: list[tuple[str, int, int]] = []
    paths: set[int] = set()
    pieces: list[str] = []
    held = top

    def end_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                found.append((text, held.path, held.sure))

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        now = stack[-1]
        unended = m and m[4]  # no later one ends either, unless inside its quotes: looking on would take quadratic time
        run = page[at : m.start() if m and not unended else size]
        if run and not now.left_out:
            if not pieces:
                held = now
            pieces.append(html.unescape(run) if "&" in run else run)
        if not m or unended:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), m[1]
        if tag in _BLOCKS:
            end_block()
        elif tag in _SPACED and pieces:
            pieces.append(" ")
        if closing:
            if counts.get(tag):
                while True:
                    gone = stack.pop()
                    counts[gone.tag] = counts.get(gone.tag, 1) - 1
                    if gone.tag == tag or len(stack) == 1:
                        break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
            if end:
                close = page.find(">", at)
                at = close + 1 if close >= 0 else size
            continue
        if tag in _VOID:
            continue
        if tag in _ENDED_BY_SAME and now.tag == tag:
            stack.pop()
            counts[tag] -= 1
            now = stack[-1]
        if m[3].endswith("/") and tag not in _BLOCKS:
            continue
        opened = _opened(tag, m[3], now)
        if not now.left_out and opened.left_out and pieces and tag not in _BLOCKS:
            pieces.append(" ")
        opened.tag = tag
        stack.append(opened)
        counts[tag] = counts.get(tag, 0) + 1
        paths.add(opened.path)
    end_block()
    return found, paths


def _token(path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"), path & 0xFFFFFFFFFFFF)


def host_of(url: Column) -> Column:
    """The host of a url in lower case; null where there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, page (hash of its text), token, how often it is there, its first place, and whether it is text in an article.

    Only tokens that can matter are rows: element paths and text blocks."""

    def run(batches):
        for part, texts in in_chunks(batches, text="html"):
            columns = [[], [], [], [], [], []]
            for host, x in zip(part.column("host").to_pylist(), texts, strict=True):
                found, paths = blocks_of(x.decode("utf-8", "replace"))
                page = xxhash.xxh3_64_intdigest("\n".join(t for t, _, _ in found).encode("utf-8", "replace"))
                seen: dict[int, list[int]] = {p: [1, 0, 0] for p in paths}
                for place, (text, path, sure) in enumerate(found, 1):
                    seen.setdefault(_token(path, text), [0, place, 2 if sure >= _SUREST - 1 else 1])[0] += 1
                for token, (n, place, kind) in seen.items():
                    for c, v in zip(columns, (host, page, token, n, place, kind), strict=True):
                        c.append(v)
            to_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), to_long(columns[1]), to_long(columns[2]), *(pa.array(c, pa.int32()) for c in columns[3:])],
                ["host", "page", "token", "n", "place", "kind"],
            )

    return pages.filter("host IS NOT NULL").select("host", "html").mapInArrow(run, "host string, page long, token long, n int, place int, kind int")


def templates(tokens: DataFrame, least_pages: int, share: float, article_share: float) -> DataFrame:
    """Per host the text tokens of its template, in order.

    An equivalence class counts when it has two tokens or more on at least ``least_pages`` different pages and ``share`` of the
    host's; inside an article element it must be on ``article_share`` of them.
    """
    once = tokens.groupBy("host", "page", "token").agg(F.max("n").alias("n"), F.min("place").alias("place"), F.max("kind").alias("kind"))
    vectors = once.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.avg("place").alias("place"), F.max("kind").alias("kind")
    )
    frequent = vectors.filter(F.col("pages") >= least_pages)
    hosts = once.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of")).filter(F.col("of") >= least_pages)
    frequent = stage(frequent.join(hosts, "host").filter(F.col("pages") >= share * F.col("of")), "vectors")
    classes = frequent.groupBy("host", "pages", "vector").agg(F.count("*").alias("tokens")).filter("tokens > 1").drop("tokens")
    text = frequent.join(classes, ["host", "pages", "vector"]).filter((F.col("kind") == 1) | ((F.col("kind") == 2) & (F.col("pages") >= article_share * F.col("of"))))
    return text.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda t: t["token"]).alias("template"))


def _in_order(shown: list[int]) -> set[int]:
    """Places of the longest rising run of template positions: what a page shows of its template in the template's order."""
    import bisect

    tails, at, back = [], [], [-1] * len(shown)
    for i, x in enumerate(shown):
        k = bisect.bisect_left(tails, x)
        back[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(x)
            at.append(i)
        else:
            tails[k], at[k] = x, i
    i, kept = at[-1] if at else -1, set()
    while i >= 0:
        kept.add(i)
        i = back[i]
    return kept


def article(page: str, template: list[int] | None) -> str:
    """The article of a page: of its blocks in the surest kind of place, those that are not its host's template."""
    found, _ = blocks_of(page)
    if template:
        order = {t & 0xFFFFFFFFFFFFFFFF: i for i, t in enumerate(template)}
        places = [(i, order[t]) for i, (text, path, _) in enumerate(found) if (t := _token(path, text)) in order]
        gone = {places[k][0] for k in _in_order([p for _, p in places])}
        found = [b for i, b in enumerate(found) if i not in gone]
    surest = max((sure for _, _, sure in found), default=0)
    least = surest if surest >= _SUREST - 1 else min(surest, 1)
    return "\n".join(text for text, _, sure in found if sure >= least)


def extract(pages: DataFrame, least_pages: int = 8, share: float = 0.6, article_share: float = 0.9, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """One row per page: key, url, host, ``text`` and ``n_chars``."""
    narrow = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), host_of(F.col(url).cast("string")).alias("host"), F.col(markup).cast("string").alias("html"))
    found = stage(templates(page_tokens(narrow), least_pages, share, article_share), "templates")
    joined = narrow.join(found, "host", "left").select("key", "url", "host", "html", "template")

    def run(batches):
        for part, texts in in_chunks(batches, text="html"):
            own = part.column("template").to_pylist()
            out = [article(x.decode("utf-8", "replace"), t) for x, t in zip(texts, own, strict=True)]
            columns = [part.column("key"), part.column("url"), part.column("host"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "url", "host", "text", "n_chars"])

    kind = dict(narrow.dtypes)["key"]
    return joined.mapInArrow(run, f"key {kind}, url string, host string, text string, n_chars long")
