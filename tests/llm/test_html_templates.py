"""Operator 1: markup cases by hand, templates against vectors that are built in full."""

import collections
import time

import pytest

from shelfmark.llm import html_templates as H

CASES = [
    ("<div class='wrap has-sidebar'><header class='site'>H</header><main><article><header><h1>T</h1></header><p>a&nbsp;b<br>c <b>d</b></p><ul><li>x<li>y</ul>"
     "<div class='comments'><p>no</p></div><aside>q</aside></article></main><div id=\"sidebar\">s</div></div>", "T\na b c d\nx\ny"),
    ("<body><div id=nav>m</div><div class='post-content'><p>one</p><p>two &lt;3 &#x41;</p></div><div class='footer'>f</div>", "one\ntwo <3 A"),
    ("<p>plain<p>text <!-- <p>c --> more<script>x</p></script> z", "plain\ntext more z"),
    ("a < b and c > d <unclosed", "a < b and c > d <unclosed"),
    ("<form>n</form><div class=cookie-notice>ck</div><h1>Title</h1><p>t</p><section id=comments><article class=comment><p>c</p></article></section>", "Title\nt"),
    ("<article><p title=\"a>b\">x</p><p hidden>h</p><div style='display: none'>n</div><p>y</article><article><p>z</p></article>", "x\ny\nz"),
    ("<title>t &amp; u</title><style>p{}</style><textarea>q</textarea>", ""),
    ("<script>never closed <p>x</p>", ""), ("", ""), (" \n ", ""), ("<article><p><b>First.<br><p>Second</p></article><footer>f</footer>", "First.\nSecond"),
    ("<p>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>x", "deep\nx"),
]


@pytest.mark.parametrize("unit", ["<a ", "</a ", "<a b='>' ", '<a b=">" ', "<a =", "<!-", "<", "<p>", "<a b='", "<script>x</script "])
def test_broken_markup_takes_linear_time(unit):
    start = time.perf_counter()
    H.article("<p>text</p>" + unit * ((1 << 20) // len(unit)), None)
    assert time.perf_counter() - start < 6


@pytest.mark.parametrize("page,want", CASES)
def test_article(page, want):
    assert H.article(page, None) == want


def pages(n, host="h.example", body=lambda i: f"story {i}"):
    return [(i, f"https://{host}/{i}", f"<div class='x1'>Our slogan</div><div class='x2'>row {i % 3}</div><p>{body(i)}</p><p>more of {i}</p>") for i in range(n)]


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, text string, host string")
    return {r["key"]: (r["text"], r["n_chars"]) for r in H.extract(df).collect()}


def test_template_text_goes_and_slots_stay(spark):
    got = extracted(spark, pages(20))
    assert got == {i: (t := f"row {i % 3}\nstory {i}\nmore of {i}", len(t)) for i in range(20)}


def test_copies_and_small_hosts_are_no_template(spark):
    rows = pages(30, body=lambda i: "same") + [(100, None, "<p>x</p>"), (101, "https://h.example/", None), (102, "odd", ""), (103, "//k.example/a", "<p>\u00e9\U0001f600</p>")]
    same = [(200 + i, "http://copies.example/a", "<p>one text</p><p>other text</p>") for i in range(30)]
    few = [(300 + i, u, h) for i, u, h in pages(5, "few.example")]
    got = extracted(spark, rows + same + few)
    assert got[100] == ("x", 1) and got[101] == got[102] == ("", 0) and got[103] == ("\u00e9\U0001f600", 2)
    assert all(got[200 + i][0] == "one text\nother text" for i in range(30))
    assert all(got[300 + i][0].startswith("Our slogan") for i in range(5)) and not got[3][0].startswith("Our")


def test_classes_equal_full_vectors(spark):
    rows = pages(12) + pages(12, "k.example", lambda i: "news today" if i % 2 else f"s{i}")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", H.host_of(H.F.col("url")))
    got = {r["host"]: {t & 0xFFFFFFFFFFFFFFFF for t in r["template"]} for r in H.templates(H.page_tokens(df), 8, 0.6, 0.9).collect()}
    vectors, of = collections.defaultdict(lambda: collections.defaultdict(dict)), collections.Counter()
    for i, url, page in rows:
        host, (found, paths) = url.split("/")[2], H.blocks_of(page)
        of[host] += 1
        for token in [*paths, *(H._token(p, t) for t, p, _ in found)]:
            own = vectors[host][token]
            own[i] = own.get(i, 0) + 1 if token not in paths else 1
    want = {}
    for host, tokens in vectors.items():
        classes = collections.defaultdict(set)
        for token, v in tokens.items():
            if len(v) >= max(8, 0.6 * of[host]):
                classes[tuple(sorted(v.items()))].add(token)
        text = {H._token(p, t) for _, u, page in rows if u.split("/")[2] == host for t, p, _ in H.blocks_of(page)[0]}
        want[host] = {t for c in classes.values() if len(c) > 1 for t in c} & text
    assert got == want


def test_repeated_rows_and_empty_table(spark):
    rows = pages(9)
    assert len(extracted(spark, rows)) == 9
    df = spark.createDataFrame(rows + rows, "page_id long, url string, html string")
    assert H.extract(df).count() == 18 and H.extract(df.filter("false")).count() == 0
