import re

import pytest

from shelfmark.operators import reports as R
from shelfmark.operators import state as S
from shelfmark.operators.pages import latest_pages, titles_from_pages
from shelfmark.plans import enrich as E
from shelfmark.plans.match import pending_records, run_match
from shelfmark.streaming.enrich import start_enrichment

AS_OF = "2025-01-02 03:04:05"
SITE = "https://shop.example.com/"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_upserts(spark):
    schema = "k int, v int, x string"
    old = spark.createDataFrame([(1, 5, "a"), (2, 1, "b"), (2, 2, "c"), (None, 1, "n")], schema)
    new = spark.createDataFrame([(1, 1, "d"), (3, 1, "e"), (3, 2, "f"), (None, 1, "m")], schema)
    assert rows(S.upsert_last(old, new, ["k"], ["v"]), "k") == [(None, 1, "m"), (1, 1, "d"), (2, 2, "c"), (3, 2, "f")]
    assert rows(S.upsert_first(old, new, ["k"], ["v"]), "k") == [(None, 1, "n"), (1, 5, "a"), (2, 1, "b"), (3, 1, "e")]


def test_pending_records(spark):
    products = spark.createDataFrame([(" 1 ", " tea "), ("2", "x"), ("  ", "y"), (None, "z"), ("3", "w")], "Serial_Number string, Product_Name string")
    ledger = spark.createDataFrame([("2", "done"), ("3", "failed")], "serial_number string, outcome string")
    assert rows(pending_records(products, ledger), "serial_number") == [("1", "tea")]
    assert rows(pending_records(products, ledger, retry_failed=True), "serial_number") == [("1", "tea"), ("3", "w")]


def test_report_edges(spark):
    data = [
        ("CTN", "N/A", "1", "a"), ("CTN", "", "1", "b"), ("CTN", "0", None, "a"), ("CTN", "NULL", " ", "a"), ("CTN", "20.0", "2", "a"),
        ("CTN", "abc", "2", "a"), ("CTN", None, "3", None), (None, "7", "4", "a"), ("NON-CTN", "7", "5", "a"), ("CTN", " -3x", "6", "a"),
    ]
    df = spark.createDataFrame(data, "Packaging_Type string, Units_Per_Carton string, Serial_Number string, Supplier string")
    t = R.report_tables(df)
    one = lambda name: t[name].first()[0]
    assert one("Total units available") == 1 + 1 + 1 + 1 + 20 + 0 + 1 + 1 + 1 - 3
    assert one("Missing Serial_Numbers") == 2
    assert one("Unique products (only in one catalog)") == 6
    assert rows(t["Duplicate Serial_Numbers"], "Serial_Number") == [("1", 2), ("2", 2)]
    assert rows(t["Products appearing in multiple catalogs"], "Serial_Number") == [("1", 2)]
    assert rows(t["Number of CTN vs NON-CTN products"], "Packaging_Type") == [(None, 1), ("CTN", 8), ("NON-CTN", 1)]
    assert rows(t["Supplier-wise product counts"]) == [("a", 8), (None, 1), ("b", 1)]
    full = [(r.Query_Description, r.Result) for r in R.report(df, AS_OF).collect()]
    assert sorted(r for name, r in full if name == "Duplicate Serial_Numbers") == ['{"Serial_Number":"1","count":2}', '{"Serial_Number":"2","count":2}']
    assert ("Total number of products", '{"total_products":10}') in full
    nothing = {r.Query_Description: r.Result for r in R.report(df.limit(0), AS_OF).collect()}
    assert nothing["Total number of products"] == '{"total_products":0}' and "Duplicate Serial_Numbers" not in nothing


@pytest.fixture
def work(spark):
    matches = spark.createDataFrame([
        ("1", "S1", "t1", "u1", "Available"), ("2", "S2", "t2", "u1", "available"), ("3", "S3", "t3", "gone", "Available"),
        ("4", "S4", "t4", "Not available everywhere", "Not Available"), ("5", "S5", "t5", None, "Available"),
        ("6", "S6", "t6", "u2", "Available"), ("7", "S7", "t7", "u3", "Available"), ("8", "S8", "t8", "u1", None),
    ], "id string, serial_number string, input_title string, matched_url string, status string")
    pages = spark.createDataFrame([
        (1, "u1", "<span id='productTitle'>old</span>"), (2, "u1", "<span id='productTitle'>Tea</span><p>EAN: 5</p>"),
        (3, "u2", "Robot check"), (4, "u3", "<p>nothing</p>"), (5, "unused", "<p>x</p>"),
    ], "page_id int, url string, html string")
    return matches, pages


def test_every_record_gets_one_row(spark, work):
    out = E.enrich(*work, AS_OF, SITE)
    got = rows(out.select("Scrape_ID", "Product_Name", "Description", "Barcode", "Source_URL", "outcome"), "Scrape_ID")
    na = "Not Available"
    assert got == [
        (1, "Tea", na, "5", "u1", "parsed"), (2, "Tea", na, "5", "u1", "parsed"), (3, na, na, na, "gone", "missing page"),
        (4, na, na, na, "Not available everywhere", "no match"), (5, na, na, na, na, "no match"),
        (6, na, "Blocked by anti-bot", na, "u2", "unusable page"), (7, na, na, na, "u3", "parsed"), (8, na, na, na, "u1", "no match"),
    ]
    assert out.first().Last_Updated == "2025-01-02T03:04:05"
    strict = E.enrich(*work, AS_OF, SITE, check_empty=True).filter("outcome = 'empty page'")
    assert [r.Scrape_ID for r in strict.collect()] == [7]


def test_failed_pages_downgrade_the_match(spark, work):
    out = E.enrich(*work, AS_OF, SITE).selectExpr("CAST(Scrape_ID AS string) AS id", "outcome").filter("outcome <> 'no match'")
    got = {r.id: (r.status, r.scraped) for r in S.downgrade_failed(work[0], out).collect()}
    assert got["1"] == ("Available", 1) and got["3"] == ("Not Available", 1) and got["6"] == ("Not Available", 1) and got["4"] == ("Not Available", 0)


def test_batches_resume_without_loss_or_doubles(spark, work, tmp_path):
    matches, pages = work
    out = str(tmp_path / "out")
    first = matches.filter("id < '4'")
    E.run_batch(spark, first, pages, out, "b1", AS_OF, SITE)
    E.run_batch(spark, first, pages, out, "b1", AS_OF, SITE)
    E.run_batch(spark, matches, pages, out, "b2", AS_OF, SITE)
    E.run_batch(spark, matches, pages, out, "b3", AS_OF, SITE)
    written = spark.read.parquet(f"{out}/scraped_products")
    assert sorted(r.Scrape_ID for r in written.collect()) == list(range(1, 9))
    assert {r.id: r.outcome for r in spark.read.parquet(f"{out}/ledger").collect()}["3"] == "failed"
    later = pages.union(spark.createDataFrame([(9, "gone", "<span id='productTitle'>Back</span>")], pages.schema))
    E.run_batch(spark, matches, later, out, "b4", "2025-01-03 00:00:00", SITE, retry_failed=True)
    now = {r.Scrape_ID: r.Product_Name for r in E.current_products(spark, out).collect()}
    assert len(now) == 8 and now[3] == "Back" and now[1] == "Tea"


def test_stream_takes_each_file_once(spark, work, tmp_path):
    matches, pages = work
    source, stored, out, state = (str(tmp_path / n) for n in ("matches", "pages", "out", "state"))
    pages.write.parquet(stored)
    matches.filter("id < '4'").write.mode("append").parquet(source)
    run = lambda: start_enrichment(spark, source, stored, out, state, AS_OF, SITE).awaitTermination()
    run()
    run()
    matches.filter("id >= '4'").write.mode("append").parquet(source)
    run()
    assert sorted(r.Scrape_ID for r in spark.read.parquet(f"{out}/scraped_products").collect()) == list(range(1, 9))


def moved_columns(df):
    """What each exchange of the plan moves."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"^\(\d+\) \w*Exchange.*\nInput \[\d+\]: (.*)$", plan, re.M)


def test_no_html_is_shuffled(spark, work, tmp_path):
    matches, pages = work
    spark.range(0, 9000, numPartitions=4).selectExpr(
        "int(id + 100) AS page_id", "IF(id % 3 = 0, 'u3', 'other' || id) AS url", "'<span id=\"productTitle\">' || id || '</span>' AS html"
    ).unionByName(pages).write.parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    found = matches.selectExpr("id", "matched_url AS url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out, titled = E.enrich(matches, stored, AS_OF, SITE), titles_from_pages(found, stored)
        names = {r.Scrape_ID: r.Product_Name for r in out.collect()}
        moved = [moved_columns(df) for df in (out, titled)]
        counts = titled.count(), latest_pages(stored).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert names[1] == "Tea" and names[7] == "8997" and names[3] == "Not Available" and counts == (8, 6005 - 1)
    assert all(len(columns) >= 3 and not re.search("html|markup", " ".join(columns)) for columns in moved)


def test_unmatched_records_spread_over_partitions(spark, work):
    # A shared "no match" URL must not be a join key.
    many = spark.range(3000).selectExpr(
        "CAST(id AS string) AS id", "'S' AS serial_number", "'t' AS input_title",
        "'Not available everywhere' AS matched_url", "'Not Available' AS status",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = E.enrich(many.unionByName(work[0]), work[1], AS_OF).rdd.glom().map(len).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3008 and max(sizes) < 1000


def test_ids_that_are_no_numbers(spark, work, tmp_path):
    matches, pages = work
    out = str(tmp_path / "out")
    one = matches.limit(1).drop("id").crossJoin(spark.createDataFrame([("A-1",), ("A-2",), ("007",), ("7",), (None,)], "id string")).select(*matches.columns)
    for batch in ("b1", "b2"):
        E.run_batch(spark, one, pages, out, batch, AS_OF, SITE, csv=True)
    assert sorted(r.record_id for r in spark.read.parquet(f"{out}/scraped_products").collect()) == ["007", "7", "A-1", "A-2"]
    assert E.current_products(spark, out).count() == 4
    assert spark.read.parquet(f"{out}/rejected/batch_id=b2").count() == 1
    assert spark.read.csv(f"{out}/scraped_products_csv", header=True).count() == 4


def test_match_job_resumes(spark, tmp_path):
    out = str(tmp_path / "out")
    block = "<div data-component-type='s-search-result'><a class='a-link-normal s-line-clamp-4 s-link-style a-text-normal' href='/{}'><h2 aria-label='t'><span>{}</span></h2></a></div>"
    page = lambda *titles: "<div class='s-main-slot'>" + "".join(block.format(i, t) for i, t in enumerate(titles)) + "</div>"
    products = spark.createDataFrame(
        [("1", "green tea"), ("2", "black coffee"), ("2", "zz other"), ("3", "lost"), (" ", "blank"), ("4", "rice")], "Serial_Number string, Product_Name string"
    )
    pages = spark.createDataFrame([
        ("1", page("oolong", "green tea", *(f"x{i}" for i in range(8)))), ("2", page("black coffee")), ("4", page()), ("9", page("green tea")),
    ], "id string, html string")
    read = lambda table: spark.read.parquet(f"{out}/{table}")
    run_match(spark, products.filter("Serial_Number < '3'"), pages, out, "b1", AS_OF, SITE)
    for _ in range(2):
        run_match(spark, products, pages, out, "b2", AS_OF, SITE)
    run_match(spark, products, pages, out, "b3", AS_OF, SITE)
    na = "Not Available"
    got = {r.serial_number: (r.input_title, r.matched_url, r.status) for r in read("matches").collect()}
    assert read("matches").count() == 4 and got["1"] == ("green tea", SITE + "1", "Available") and got["2"][:2] == ("black coffee", SITE + "0")
    assert got["3"][2] == na and got["4"][2] == na
    assert {r.serial_number: r.outcome for r in read("search_ledger").collect()} == {"1": "done", "2": "done", "3": "failed", "4": "done"}
    assert read("candidates").groupBy("id").count().orderBy("id").collect() == [("1", 5), ("2", 1)]
    augmented = {r.serial_number: r for r in spark.read.json(f"{out}/augmented").collect()}
    assert len(augmented) == 4 and augmented["1"].url_2_similarity == 1.0 and augmented["3"].url_1 == na
    found = pages.union(spark.createDataFrame([("3", page("lost"))], pages.schema))
    run_match(spark, products, found, out, "b4", AS_OF, SITE, retry_failed=True)
    assert [(r.serial_number, r.status) for r in read("matches").filter("batch_id = 'b4'").collect()] == [("3", "Available")]
