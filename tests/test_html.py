import pytest
from pyspark.sql import functions as F

from shelfmark.functions import html as H
from shelfmark.operators.pages import page_fields, search_results, titles_from_pages

PRODUCT = '''<!DOCTYPE html><html><head><script>var x='<span id="productTitle">no</span>';</script>
<meta property="og:image" content="http://og/i.jpg"></head><body>
<div id="titleSection"><h1 id="title"><span id="productTitle" class="a-size-large">   Coo <b>Toly</b> &amp;  Bags&nbsp;100 &#8364;&#x41;  </span></h1></div>
<span id="priceblock_ourprice">  </span><span class="a-price x"><span aria-hidden="true">zz</span><span class="q a-offscreen" >AED&nbsp;16.14</span></span>
<div id="imgTagWrapperId"><div>x</div><img alt="a > b id='zz'" src="http://s.jpg" data-old-hires="http://l.jpg?a=1&amp;b=2" onload="if(a > 1.0){}" id="landingImage"></div>
<div id="feature-bullets"><div><ul class="u"><li> one <b>two</b></li><li>three<li>four</ul><ul><li>five<ul><li>six</li></ul></li><li>  </li></ul></div></div><ul><li>out</li></ul>
<table id="productDetails_detailBullets_sections1"><tr><th>Weight</th><td>5</td></tr><tr><th> EAN code </th><td> 123 </td></tr></table>
<p>UPC : 9 9</p></body></html>'''


def fields(spark, html, h1=False):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return page_fields(df, h1).first()


def test_product_page(spark):
    row = fields(spark, PRODUCT)
    assert row.page_title == "CooToly& Bags 100 €A"
    assert row.page_description == "one two | three | four | five six | six"
    assert row.page_price == "AED\xa016.14"
    assert row.page_image == "http://l.jpg?a=1&b=2"
    assert row.page_barcode == "123"
    assert row.unusable is False


@pytest.mark.parametrize("html, field, want", [
    ("<body><h1>Only <i>heading</i></h1></body>", "page_title", None),
    ("<span id='priceblock_dealprice'>5</span><span class=a-offscreen>6</span>", "page_price", "5"),
    ("<span class=a-offscreen>6</span>", "page_price", "6"),
    ("<span class='a-offscreen'> </span><span class='a-offscreen'>7</span>", "page_price", None),
    ("<span class='a-price'><span>1</span></span><span class='a-offscreen'>8</span>", "page_price", "8"),
    ("<span class='my-a-offscreen'>6</span>", "page_price", None),
    ("<span class='a-offscreen'>first</span><span class='a-price'><span class='a-price s'></span><span class='a-offscreen'>AED 5</span></span>", "page_price", "AED 5"),
    ("</span><span class='a-offscreen'>1</span><span class='a-price'>2</span><span class='a-offscreen'>3</span>", "page_price", "1"),
    ("<span class='a-price'><span><span class='a-offscreen'>4<span>.5</span></span></span>", "page_price", "4.5"),
    ("<div id=imgTagWrapperId><img id='landingImage' data-old-hires='' src='s.jpg'></div>", "page_image", "s.jpg"),
    ("<img id='landingImage' src='s.jpg'><meta property='og:image' content='m.jpg'>", "page_image", "m.jpg"),
    ("<img alt='src=x.jpg'>", "page_image", None),
    ("<div id='feature-bullets'><ol><li>x</li></ol></div>", "page_description", None),
    ("<div id='productDetails_feature_div'><li>a<li>b</div>", "page_description", "a | b"),
    ("<ul class='a-spacing-mini a-vertical zz a-unordered-list'><li>q</li></ul>", "page_description", "q"),
    ("<ul class='a-spacing-mini a-vertical'><li>q</li></ul>", "page_description", None),
    ("<p>EAN : 123</p>", "page_barcode", "123"),
    ("<p>upc : 1:2</p>", "page_barcode", "1:2"),
    ("<p>asin</p><p>BEAN</p><p>the ean is 55</p>", "page_barcode", "55"),
    ("<p>asin B01</p><p>upc 77</p>", "page_barcode", "77"),
    ("<p>EAN:</p>12345678", "page_barcode", None),
    ("<p>code 1234567890123 x</p>", "page_barcode", "1234567890123"),
    ("<p>123456789012345</p>", "page_barcode", None),
    ("<script>EAN : 5</script><p>x</p>", "page_barcode", None),
    ("Press <b>and</b> hold", "unusable", True),
    ("Press and<!-- press and hold --> wait", "unusable", False),
    ("", "page_title", None),
    (None, "page_barcode", None),
])
def test_fields(spark, html, field, want):
    assert fields(spark, html)[field] == want


def test_title_falls_back_to_heading(spark):
    assert fields(spark, "<h1 class=x>Only <i>heading</i></h1>", h1=True).page_title == "Onlyheading"
    assert fields(spark, "<span id=productTitle> </span><h1>other</h1>", h1=True).page_title is None


@pytest.mark.parametrize("text, want", [
    ("a &lt;b&gt; &quot;&apos;&copy;&eacute;", "a <b> \"'©é"), ("&#65;&#x42;&#X43;&#0000000068;&#x000000045;", "ABCDE"), ("&#0; &#1114112; &#55296;", "� � �"),
    ("&nosuch; & &amp;lt; R&D", "&nosuch; & &lt; R&D"),
])
def test_entities(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.expr(H.decode_entities("t"))).first()[0] == want


def test_text_survives_odd_markup(spark):
    html = "<p title=\"a > b\">one</p><br/>two<p it's>three</p><!-- x > y -->four<STYLE>p{}</style><a href=x?y='>five"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(F.expr(H.joined_strings(H.visible_markup("html"), " "))).first()[0] == "one two three four five"


def test_long_page_is_read_whole(spark):
    html = "<div id='feature-bullets'><ul>" + "".join(f"<li>item {i}</li>" for i in range(600)) + "</ul></div>"
    html += "<p>" + "word " * 60000 + "</p><p>EAN: 42</p>" + "<i " + "a='x' " * 3000 + ">end</i>"
    row = fields(spark, html)
    assert row.page_description.split(" | ") == [f"item {i}" for i in range(600)] and row.page_barcode == "42"


def test_result_list(spark):
    block = "<div data-component-type='s-search-result'>{}</div>"
    page = "<div class='s-main-slot'>" + block.format(
        "<h2 class='a-size-mini'><span class='a-size-base-plus a-color-base'> Acme </span></h2>"
        "<a class='a-link-normal s-line-clamp-4 s-link-style a-text-normal' href='/dp/1?x=1'><h2 aria-label='t'><span>Tea</span></h2></a>"
    ) + block.format("<h2><a href='http://z/2'><span>Plain</span></a></h2>") + block.format("") + "</div>"
    df = spark.createDataFrame([("r", page), ("none", "<p>x</p>")], "id string, html string")
    final = search_results(df, "id", "https://s/").collect()
    assert [(r.position, r.url, r.title) for r in final] == [
        (0, "https://s/dp/1?x=1", "Acme Tea"), (1, "Not Available", "Not Available"), (2, "Not Available", "Not Available"),
    ]
    early = search_results(df, "id", "https://s/", early=True).collect()
    assert [(r.url, r.title) for r in early] == [
        ("https://s/dp/1", "Acme Tea"), ("http://z/2", "Plain"), ("Not Available", "Not Available"),
    ]


def test_results_end_with_their_block(spark):
    block = "<div data-component-type='s-search-result'>{}</div>"
    link = "<a class='a-link-normal s-line-clamp-4 s-link-style a-text-normal' href='{}'><h2 aria-label='t'><span>{}</span></h2></a>"
    slots = [
        block.format("<div>no link</div>") + "<div class='promo'>" + link.format("/promo", "Promo") + "</div>" + block.format(link.format("/1", "One")),
        block.format("<div><div>" + link.format("/2", "Two") + "</div></div>"),
    ]
    page = "".join(f"<div class='x s-main-slot'>{slot}</div><p>{link.format('/out', 'Out')}</p>" for slot in slots)
    df = spark.createDataFrame([("r", page)], "id string, html string")
    got = [(r.position, r.url, r.title) for r in search_results(df, "id", "https://s/").collect()]
    assert got == [(0, "Not Available", "Not Available"), (1, "https://s/1", "One"), (2, "https://s/2", "Two")]


def test_slots_in_slots_keep_every_result(spark):
    """The results before, inside and after a nested slot, of unclosed slots and of slots one after the other."""
    result = lambda n: (
        '<div data-component-type="s-search-result"><div><a class="a-link-normal s-line-clamp-4 s-link-style a-text-normal"'
        f' href="/{n}"><h2 aria-label="x"><span>T{n}</span></h2></a></div></div>'
    )
    slot = lambda *inside: f'<div class="s-main-slot">{"".join(inside)}</div>'
    pages = {
        "nested": result(0) + slot(result(1), "<div>", slot(result(2), slot(result(3))), "</div>", result(4)) + result(5) + slot(result(6)),
        "open": slot(result(1)) + result(2) + '<DIV class="s-main-slot">' + result(3) + "<div>" + result(4),
        "none": "<div>" + result(1),
    }
    df = spark.createDataFrame(list(pages.items()), "id string, html string")
    got = {}
    for r in search_results(df, "id", "https://s/").orderBy("position").collect():
        got.setdefault(r.id, []).append((r.position, r.title))
    numbered = lambda *titles: list(enumerate(f"T{n}" for n in titles))
    assert got == {"nested": numbered(1, 2, 3, 4, 6), "open": numbered(1, 3, 4)}


def nested_items(html):
    """Item texts by a plain walk over tags, with explicit stacks."""
    import re

    items, open_, depth = [], [], 0
    for piece in re.split(r"(?=</?(?:li|ul)>)", html):
        tag = re.match(r"</?(?:li|ul)>", piece)
        kind = tag[0] if tag else ""
        depth += {"<ul>": 1, "</ul>": -1}.get(kind, 0)
        if kind in ("<li>", "</li>"):
            open_ = [o for o in open_ if o[0] != depth]
        if kind == "</ul>":
            open_ = [o for o in open_ if o[0] <= depth]
        if kind == "<li>":
            items.append([])
            open_.append((depth, items[-1]))
        for _, texts in open_:
            texts.append(piece[len(kind):].strip())
    return [" ".join(filter(None, texts)) for texts in items if any(texts)]


def test_list_items_over_runs(spark):
    import random

    draw = random.Random(5)
    for size in (1, 2, 3, 7, 60, 400):
        html = "".join(draw.choice(["<ul>", "</ul>", "<li>", "<li>", "</li>"]) + draw.choice(["", f"t{i}"]) for i in range(size))
        df = spark.createDataFrame([(html,)], "t string")
        assert df.select(F.expr(H.list_items("t"))).first()[0] == nested_items(html), html


def test_long_lists_take_linear_time(spark):
    import time

    def seconds(items):
        html = "<div id='feature-bullets'><ul>" + "".join(f"<li>item {i}</li>" for i in range(items)) + "</ul></div>"
        df = spark.createDataFrame([(html,)], "t string").select(F.expr(H.description("t")))
        begin = time.time()
        assert df.first()[0].count(" | ") == items - 1
        return time.time() - begin

    seconds(100)
    assert seconds(16000) < 2.5 * seconds(8000) + 1


def test_titles_from_pages(spark):
    head = "<h2 class='a-size-base-plus a-spacing-none a-color-base a-text-normal'><span>T{}</span></h2>"
    pages = spark.createDataFrame([(1, "u", head.format(1)), (2, "u", head.format(2))], "page_id int, url string, html string")
    found = spark.createDataFrame([("a", "u"), ("b", "gone"), ("c", None), ("d", "Not Available")], "id string, url string")
    got = {r.id: r.title for r in titles_from_pages(found, pages).collect()}
    assert got == {"a": "T2", "b": "Not Available", "c": "Not Available", "d": "Not Available"}


def test_pages_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "x")], "page_id int, html string")
    assert "Python" not in page_fields(df)._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


def test_each_variant_of_results_evaluates_only_its_own_rules():
    """The looser link rule and a second look for each title used to run for every block, whichever variant was asked for."""
    early = H.raw(H.by_classes("a", H.RESULT_LINK_CLASSES_EARLY))
    assert early not in H.result_blocks("m") and early in H.result_blocks("m", early=True)
    assert H.result_blocks("m").count("aria-label") == H.result_blocks("m", early=True).count("aria-label") > 0
    assert not any("early" in H.result_blocks("m", early=x) for x in (False, True))
