"""Inputs derived from the given tables, in SQL that Spark and DuckDB both accept.

The tables hold no pack sizes, supplier catalogs or product markup, so those are built from
their rows. Expressions here are shared by the queries and the oracle; results are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2025-01-31 08:00:00"
SITE = "https://shop.example.com/"
SUPPLIERS = ["North", "South", "East", "West"]
UNIT_SUPPLIER = "West"

PACKED_NAME = """upper(p_name) || ' ' || CASE p_partkey % 16
 WHEN 0 THEN p_size || 'KG' WHEN 1 THEN p_size || '.5G' WHEN 2 THEN p_size || ' ML X 30'
 WHEN 3 THEN p_size || 'PCS' WHEN 4 THEN '(1.5 ML*' || p_size || ')' WHEN 5 THEN p_size || '*2.5L'
 WHEN 6 THEN '4 X ' || p_size || ' X 56 PKT' WHEN 7 THEN '4 X ' || p_size || ' X 56G'
 WHEN 8 THEN p_size || ' TEABAGS' WHEN 9 THEN p_size || '+6' WHEN 10 THEN p_size || 'LT CTN'
 WHEN 11 THEN p_size || ' X KG' WHEN 12 THEN 'MIX ' || p_size || 'ml carton'
 WHEN 13 THEN p_size || ' × 250 GM' WHEN 14 THEN p_size || ' tea bags' ELSE 'PLAIN' END"""
PRODUCTS = f"SELECT p_partkey, p_size, p_brand, {PACKED_NAME} AS name FROM part"

BRAND_CLASS = "CAST(substr(p_brand, 7) AS int) % 4"
UNIT = "CASE p_size % 3 WHEN 0 THEN ' ctn ' WHEN 1 THEN 'CTN PACK' END"

MASTER = """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS Product_ID,
 p_name AS Product_Name,
 CASE WHEN l_linenumber = 7 AND l_quantity < 10 THEN NULL WHEN l_linenumber = 7 THEN '  '
      ELSE l_partkey || '-' || CAST(l_quantity AS int) END AS Serial_Number,
 'S' || l_suppkey AS Supplier,
 CASE WHEN l_linestatus = 'F' THEN 'CTN' WHEN l_returnflag = 'N' THEN 'NON-CTN' END AS Packaging_Type,
 CASE p_size % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'NULL'
      WHEN 4 THEN p_size || '.0' WHEN 5 THEN 'abc' WHEN 6 THEN NULL ELSE ' ' || p_size END AS Units_Per_Carton
FROM lineitem JOIN part ON l_partkey = p_partkey"""

WIDE = """SELECT CAST(p_partkey AS varchar(20)) AS id, 'S' || p_partkey AS serial_number,
 '  ' || p_brand || ' ' || p_type || ' ' || p_name || ' ' AS input_title,
 'https://shop.example.com/dp/' || p_partkey || '/1' AS url_1, p_name || ' ' || p_size AS url_1_title,
 'https://shop.example.com/dp/' || p_partkey || '/2' AS url_2,
 CASE WHEN p_partkey % 4 < 2 THEN p_brand || ' ' || p_name || ' ' || p_size END AS url_2_title,
 'https://shop.example.com/dp/' || p_partkey || '/3' AS url_3,
 CASE WHEN p_partkey % 4 = 1 THEN p_brand || ' ' || p_name || ' ' || p_type || ' ' || p_name || ' promo' END AS url_3_title,
 'https://shop.example.com/dp/' || p_partkey || '/4' AS url_4,
 CASE p_partkey % 7 WHEN 0 THEN 'Not Available' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE p_type || ' ' || p_type || ' pack' END AS url_4_title,
 'https://shop.example.com/dp/' || p_partkey || '/5' AS url_5,
 CASE WHEN p_partkey % 4 < 2 THEN p_size || ' ' || p_name || ' ' || p_brand ELSE '!' END AS url_5_title,
 '2025-01-30 10:00:00' AS scraped_date
FROM part"""

RECORD_TITLES = """SELECT CAST(p_partkey AS varchar(20)) AS id, 'S' || p_partkey AS serial_number,
 p_brand || ' ' || p_type || ' ' || p_name AS input_title FROM part"""
ITEM_TITLES = """SELECT p_partkey AS key, 'https://shop.example.com/dp/' || p_partkey AS url,
 p_brand || ' ' || p_name || ' ' || p_size AS title FROM part"""

# Titles of one template: all of them share four tokens or more of five, and differ in a number.
TEMPLATED = "SELECT {key}, 'account in ' || lower(c_mktsegment) || ' area ' || CASE c_nationkey % 3 WHEN 0 THEN 'north no' ELSE 'no' END || (c_custkey {change}) AS title FROM customer"
TEMPLATED_RECORDS = TEMPLATED.format(key="c_custkey AS id", change="% 500")
TEMPLATED_ITEMS = TEMPLATED.format(key="c_custkey AS key, 'https://shop.example.com/ac/' || c_custkey AS url", change="* 7")
LONG_RECORDS = "SELECT item_id AS id, text AS title FROM benchmark UNION ALL SELECT p_partkey + 1000000, p_name || ' ' || p_type FROM part"
LONG_ITEMS = "SELECT doc_id AS key, source AS url, text AS title FROM documents"
REPEATED_RECORDS = """SELECT CAST(p_partkey % 50 AS varchar(20)) AS id, 'S' || p_partkey AS serial_number,
 p_brand || ' ' || p_type || ' ' || p_name AS input_title FROM part"""

# A name with a line break, a comma and quotes; one with an inch mark; one that is plain. And how a CSV file holds each.
BROKEN_NAME = """CASE p_partkey % 3 WHEN 0 THEN p_name || chr(10) || 'line, "two"' || chr(10) || chr(10) || p_size WHEN 1 THEN p_size || '" PIPE ' || p_name ELSE p_name END"""
BROKEN_CSV = """CASE p_partkey % 3 WHEN 0 THEN '"' || p_name || chr(10) || 'line, ""two""' || chr(10) || chr(10) || p_size || '"' WHEN 1 THEN p_size || '" PIPE ' || p_name ELSE p_name END"""

FRAGMENT = """CASE WHEN page_id % 3 = 0 THEN '<div id="titleSection"><h1 id="title"><span id="productTitle" class="a-size-large">  Item <b>' || page_id || '</b> &amp; Co  pack </span></h1></div>' ELSE '' END
|| CASE page_id % 5
 WHEN 0 THEN '<span id="priceblock_ourprice"> </span><span class="a-price b"><span class="a-offscreen">AED&nbsp;' || page_id || '.50</span><span aria-hidden="true">x</span></span>'
 WHEN 1 THEN '<span class="a-offscreen">List ' || page_id || '</span><span id="priceblock_dealprice">' || page_id || ' <i>AED</i></span>'
 WHEN 2 THEN '<span class="a-offscreen"> ' || page_id || '.99 </span>' ELSE '' END
|| CASE page_id % 4
 WHEN 0 THEN '<div id="imgTagWrapperId"><div><i>zoom</i></div><img alt="a > b" src="http://img.example.com/' || page_id || '.jpg" data-old-hires="http://img.example.com/' || page_id || '_L.jpg" id="landingImage"></div>'
 WHEN 1 THEN '<div id="imgTagWrapperId"><img alt="c > d" src="http://img.example.com/' || page_id || '.jpg" id="landingImage"></div>'
 WHEN 2 THEN '<meta property="og:image" content="http://img.example.com/og' || page_id || '.jpg">' ELSE '' END
|| CASE page_id % 6
 WHEN 0 THEN '<div id="feature-bullets"><div><ul class="u"><li><span> First <b>point</b> </span></li><li> </li><li>No ' || page_id || '</li></ul></div></div>'
 WHEN 1 THEN '<div id="productDetails_feature_div"><ol><li>Detail ' || page_id || '</li><li>More&amp;more</li></ol></div>'
 WHEN 2 THEN '<ul class="a-unordered-list a-nostyle a-vertical a-spacing-mini"><li>Plain ' || page_id || '</li></ul>' ELSE '' END
|| CASE page_id % 7
 WHEN 0 THEN '<table id="productDetails_detailBullets_sections1"><tr><th> Weight </th><td>1 kg</td></tr><tr><th> UPC code </th><td> ' || (610000000000 + page_id) || ' </td></tr></table>'
 WHEN 1 THEN '<p>Upc : 0' || (10000000000 + page_id) || '</p>'
 WHEN 2 THEN '<p>Item EAN-13 ' || (4000000000000 + page_id) || ' </p>'
 WHEN 3 THEN '<p>' || (5000000000000 + page_id) || '</p>' ELSE '' END
|| CASE WHEN page_id % 11 = 0 THEN '<p>Press <b>and</b> hold</p>' ELSE '' END"""
PRODUCT_PAGES = f"SELECT page_id, url, replace(html, '<article>', {FRAGMENT} || '<article>') AS html FROM pages"

PAGE_MATCHES = """SELECT CAST(page_id AS varchar(20)) AS id, 'S' || page_id AS serial_number, 'title ' || page_id AS input_title,
 CASE page_id % 9 WHEN 0 THEN 'Not available everywhere' WHEN 1 THEN url || '/gone' WHEN 2 THEN '' ELSE url END AS matched_url,
 CASE page_id % 9 WHEN 0 THEN 'Not Available' WHEN 3 THEN 'available' ELSE 'Available' END AS status
FROM pages"""

BLOCK = """'<div class="x" data-component-type="s-search-result"><h2 class="a-size-mini s-line-clamp-1"><span class="a-size-base-plus a-color-base">'
 || CASE WHEN i % 2 = 1 THEN ' Brand' || i || ' ' ELSE '' END || '</span></h2>'
 || CASE WHEN i % 4 = 3 THEN '' ELSE '<a class="a-link-normal s-line-clamp-4 s-link-style a-text-normal" href="/dp/' || page_id || '/' || i || '?ref=' || i || '&amp;x=1">' END
 || CASE WHEN i % 5 = 4 THEN '' ELSE '<h2 aria-label="P' || i || '"><span> Product <b>' || i || '</b> of ' || page_id || ' </span></h2>' END || '</a></div>'"""

# Places where the engines differ by name only.
_SPARK_WORDS = [("varchar(20)", "string")]


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    views(spark, sf_dir, *names)
    for duck, word in _SPARK_WORDS:
        sql = sql.replace(duck, word)
    return spark.sql(sql)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PRODUCTS, "part")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, MASTER, "part", "lineitem")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, WIDE, "part")


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PRODUCT_PAGES, "pages")


def page_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PAGE_MATCHES, "pages")


def result_pages(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    """The stored pages with results in two slots (``nested``: some in a slot inside the other), and links like a result's that follow blocks and slots."""
    block = BLOCK
    decoy = "'<div class=\"promo\"><a class=\"a-link-normal s-line-clamp-4 s-link-style a-text-normal\" href=\"/promo\"><h2 aria-label=\"p\"><span>Promo</span></h2></a></div>'"
    blocks = lambda low, high: (
        f"""array_join(transform(filter(array(1, 2, 3, 4, 5, 6, 7),
        i -> i <= page_id % 8 AND i BETWEEN {low} AND {high}), i -> {block} || {decoy}), '')"""
    )
    slot = lambda inside: f"""'<div class="s-main-slot s-search">' || {inside} || '</div>'"""
    both = f"{slot(blocks(1, 3))} || {decoy} || {slot(blocks(4, 7))} || {decoy}"
    if nested:
        both = slot(f"{blocks(1, 2)} || '<div><ul>' || {slot(blocks(3, 4))} || '</ul></div>' || {decoy} || {blocks(5, 7)}") + f" || {decoy}"
    sql = f"SELECT CAST(page_id AS string) AS id, coalesce(html, '') || {both} AS html FROM pages"
    return run(spark, sf_dir, sql, "pages")


def catalogs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The part table as four supplier catalogs with different headers."""
    heads = [
        f"p_partkey AS `SERIAL NUMBER`, {PACKED_NAME} AS `PRODUCT TITLE`",
        f"p_partkey AS `SL NO`, {PACKED_NAME} AS `Item Name`",
        f"p_partkey AS Serial_Number, {PACKED_NAME} AS Product_Name, '1KG' AS Weight_Quantity, '' AS Units_Per_Carton",
        f"p_partkey AS `SL NO`, {PACKED_NAME} AS `Item Name`, {UNIT} AS Unit",
    ]
    rows = {}
    for n, (supplier, head) in enumerate(zip(SUPPLIERS, heads)):
        sql = f"SELECT {head}, p_partkey AS row_seq FROM part WHERE {BRAND_CLASS} = {n}"
        df = run(spark, sf_dir, sql, "part")
        serial = df.columns[0]
        rows[supplier] = df.withColumn(serial, df[f"`{serial}`"].cast("string"))
    return rows
