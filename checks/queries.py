"""One query per operator over the given tables; keys carry the operator's inventory number."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derive as D
from shelfmark.functions import html as H
from shelfmark.functions import packs, text
from shelfmark.functions.similarity import score_long_pairs, tokens_sql
from shelfmark.operators import candidates as C
from shelfmark.operators import consolidate as K
from shelfmark.operators import matching as M
from shelfmark.operators import pages as P
from shelfmark.operators import reports as R
from shelfmark.operators import state as S
from shelfmark.plans import enrich as E
from shelfmark.plans import match as PM
from shelfmark.schema import SCRAPED_COLUMNS
from shelfmark.session import ensure_checkpoint_dir
from shelfmark.sources import catalogs as SC
from shelfmark.sources import records as SR
from shelfmark.sources import tables as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STOP_WORDS = ["the", "and", "pack", "promo"]


def query(name: str):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return keep


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, where every executor can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/io-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Sources and sinks: written, read back, compared with the rows that went in.

def csv_catalogs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    out, paths = scratch(spark), {}
    for supplier, df in D.catalogs(spark, sf_dir).items():
        paths[supplier] = f"{out}/{supplier}"
        df.drop("row_seq").write.csv(paths[supplier], header=True, escape='"')
    paths["Absent"] = f"{out}/Absent"
    return paths


@query("s01_read_catalogs")
def s01(spark, sf_dir):
    found = SC.read_catalogs(spark, csv_catalogs(spark, sf_dir))
    rows = K.union_sources(found, (D.UNIT_SUPPLIER,))
    return rows.select("Supplier", "Serial_Number", "Product_Name", "Packaging_Type")


@query("s01_quoted_breaks")
def s01_breaks(spark, sf_dir):
    """Line breaks, commas and quotes inside quoted names beside names with an inch mark."""
    path = f"{scratch(spark)}/breaks"
    lines = D.run(spark, sf_dir, f"SELECT p_partkey % 8 AS file, p_partkey, p_partkey || ',' || {D.BROKEN_CSV} || ',' || p_brand AS line FROM part", "part")
    files = lines.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("p_partkey", "line"))).alias("lines"))
    text = F.concat(F.lit("SL NO,Item Name,Brand\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
    files.select("file", text.alias("value")).write.partitionBy("file").text(path)
    found = SC.read_catalogs(spark, {"Breaks": f"{path}/*"})["Breaks"]
    return found.select(F.col("`SL NO`").alias("serial"), F.col("`Item Name`").alias("name"), F.col("Brand").alias("brand"))


@query("s02_null_tokens")
def s02(spark, sf_dir):
    df = D.run(spark, sf_dir, """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN '#N/A'
        WHEN 3 THEN 'nan' WHEN 4 THEN 'Nan' ELSE p_name END AS value FROM part""", "part")
    return SC.normalize_null_tokens(df)


@query("s03_write_catalog")
def s03(spark, sf_dir):
    path = f"{scratch(spark)}/clean"
    ST.write_catalog(K.consolidate(D.catalogs(spark, sf_dir), (D.UNIT_SUPPLIER,)), path)
    return spark.read.parquet(path)


@query("s04_load_master")
def s04(spark, sf_dir):
    path = f"{scratch(spark)}/master"
    clean = K.consolidate(D.catalogs(spark, sf_dir), (D.UNIT_SUPPLIER,))
    ST.load_master(K.to_master(clean, D.AS_OF), path=path)
    return spark.read.parquet(path)


@query("s05_read_records")
def s05(spark, sf_dir):
    path = f"{scratch(spark)}/records"
    D.wide(spark, sf_dir).write.json(path)
    good, _ = SR.read_records(spark, path, lines=True)
    return good


def json_files(spark, rows: DataFrame, entry: str, opening: str, closing: str) -> str:
    """Files of one line each, that hold the entries of ``rows`` (id, ...) in a list or an object."""
    path = f"{scratch(spark)}/json"
    files = rows.selectExpr("CAST(id AS INT) % 8 AS file", "CAST(id AS INT) AS id", f"{entry} AS entry").groupBy("file").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "entry"))), lambda x: x["entry"]), ", ").alias("entries")
    )
    files.select("file", F.concat(F.lit(opening), "entries", F.lit(closing)).alias("value")).write.partitionBy("file").text(path)
    return f"{path}/*"


@query("s05_list")
def s05_list(spark, sf_dir):
    wide = D.wide(spark, sf_dir)
    path = json_files(spark, wide, f"to_json(struct({', '.join(wide.columns)}))", "[", "]")
    return SR.read_records(spark, path)[0]


@query("s05_keyed")
def s05_keyed(spark, sf_dir):
    names = {1: "1st", 2: "2nd", 3: "3rd", 4: "4th", 5: "5th"}
    slots = ", ".join(f"url_{r} AS `{n}_url`, url_{r}_title AS `{n}_url_title`" for r, n in names.items())
    wide = D.wide(spark, sf_dir)
    entry = f"""concat('"', serial_number, '": ', to_json(struct(input_title, {slots})))"""
    return SR.read_keyed_records(spark, json_files(spark, wide, entry, "{", "}"))[0]


@query("s05_quarantine")
def s05_quarantine(spark, sf_dir):
    """Every third entry of a list is no record; its neighbours are kept."""
    entry = """CASE CAST(id AS INT) % 9 WHEN 0 THEN concat('{"id":{"x":', id, '}}') WHEN 3 THEN id
        WHEN 6 THEN concat('{"id":"', id, '","url_1":["', url_1, '"]}') ELSE to_json(struct(id, input_title, url_1)) END"""
    good, bad = SR.read_records(spark, json_files(spark, D.wide(spark, sf_dir), entry, "[", "]"))
    return good.select(F.lit("record").alias("kind"), F.concat_ws("|", "id", "input_title", "url_1").alias("value")).unionByName(
        bad.select(F.lit("set aside").alias("kind"), F.col("raw").alias("value"))
    )


@query("s06_write_augmented")
def s06(spark, sf_dir):
    path = f"{scratch(spark)}/augmented"
    ST.write_augmented(M.augment(D.wide(spark, sf_dir)), path)
    return spark.read.schema(
        "id string, url_1_similarity double, url_2_similarity double, url_3_similarity double,"
        " url_4_similarity double, url_5_similarity double, best_similarity double, matched_url string, status string"
    ).json(path)


@query("s07_append_results")
def s07(spark, sf_dir):
    path = f"{scratch(spark)}/scraped"
    rows = E.enrich(D.page_matches(spark, sf_dir), D.product_pages(spark, sf_dir), D.AS_OF, D.SITE)
    parsed = F.col("outcome") == "parsed"
    ST.append_results(rows.filter(parsed), path, "1")
    ST.append_results(rows.filter(~parsed), path, "2")
    ST.append_results(rows.filter(parsed), path, "1")  # a repeated batch replaces itself
    return spark.read.parquet(path).select("Scrape_ID", "Product_Name", "Price_AED")


@query("s08_write_report")
def s08(spark, sf_dir):
    path = f"{scratch(spark)}/report"
    ST.write_report(R.report(D.master(spark, sf_dir), D.AS_OF), path)
    return spark.read.parquet(path)


@query("s09_read_pending")
def s09(spark, sf_dir):
    ledger = read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.lit("done").alias("outcome")
    )
    return E.pending_matches(D.page_matches(spark, sf_dir), ledger)


# Projections, filters and predicates.

@query("p01_standardize_columns")
def p01(spark, sf_dir):
    parts = [
        SC.standardize_columns(df, name).select("Supplier", "Serial_Number", "Product_Name")
        for name, df in D.catalogs(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("p02_required_column")
def p02(spark, sf_dir):
    """The catalogs that have no product name under any known header."""
    found = []
    for n, name in enumerate(["p_name AS Title", "p_name AS Name", "p_type AS `Item Name`", "p_brand AS Brand"]):
        df = D.run(spark, sf_dir, f"SELECT p_partkey AS `SL NO`, {name} FROM part", "part")
        try:
            found.append(SC.standardize_columns(df, f"S{n}").select("Supplier", "Serial_Number", "Product_Name", F.lit(None).cast("string").alias("error")))
        except ValueError as error:
            found.append(df.select(F.lit(f"S{n}").alias("Supplier"), F.col("`SL NO`").alias("Serial_Number"), F.lit(None).cast("string").alias("Product_Name"), F.lit(str(error)).alias("error")))
    return functools.reduce(DataFrame.unionByName, found)


@query("p03_missing_serial")
def p03(spark, sf_dir):
    df = D.run(spark, sf_dir, "SELECT p_name AS Name, p_brand AS Brand FROM part", "part")
    return SC.standardize_columns(df, "East").select("Supplier", "Serial_Number", "Product_Name", "Brand")


@query("p05_extracted_columns_replaced")
def p05(spark, sf_dir):
    filled = D.run(
        spark, sf_dir, f"SELECT p_partkey AS Serial_Number, {D.PACKED_NAME} AS Name, '1KG' AS Weight_Quantity,"
        " '' AS Units_Per_Carton, 'BOX' AS Packaging_Type FROM part", "part"
    )
    ready = K.extract_features(SC.standardize_columns(filled, "East"))
    return ready.select("Supplier", "Serial_Number", "Weight_Quantity", "Units_Per_Carton", "Packaging_Type")


@query("p07_lineage_and_stamps")
def p07(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", text.local_stamp(D.AS_OF).alias("local_stamp"), text.utc_iso_stamp(D.AS_OF).alias("utc_stamp"),
        text.utc_iso_stamp("2025-01-31 08:00:00.25").alias("utc_micros"),
    )


@query("p08_normalize_key")
def p08(spark, sf_dir):
    df = D.run(spark, sf_dir, "SELECT p_partkey, '  ' || p_partkey || chr(9) AS serial, ' ' || p_name || ' ' AS title FROM part", "part")
    return df.select(
        "p_partkey", text.normalize_key(F.col("serial")).alias("serial"), text.normalize_key(F.col("title")).alias("title")
    )


FLAGGED = """SELECT event_id, CASE event_type WHEN 'view' THEN 'Available' WHEN 'click' THEN 'available'
 WHEN 'error' THEN 'AVAILABLE' ELSE 'Not Available' END AS status,
 CASE WHEN value < 5 THEN NULL WHEN value < 20 THEN 0 ELSE 1 END AS scraped FROM events"""


@query("p09_pending")
def p09(spark, sf_dir):
    return D.run(spark, sf_dir, FLAGGED, "events").filter(S.is_pending())


@query("p10_available_pending")
def p10(spark, sf_dir):
    return D.run(spark, sf_dir, FLAGGED, "events").filter(S.is_available() & S.is_pending())


@query("p12_drop_blank_keys")
def p12(spark, sf_dir):
    return S.drop_blank_keys(D.master(spark, sf_dir), "Serial_Number").select("Product_ID", "Serial_Number")


@query("p13_sentinel_fill")
def p13(spark, sf_dir):
    return D.wide(spark, sf_dir).select("id", *[
        text.or_not_available(F.col(f"url_{r}_title")).alias(f"title_{r}") for r in (2, 4, 5)
    ])


@query("p14_missing_candidate_skipped")
def p14(spark, sf_dir):
    return M.long_scores_of_wide(D.wide(spark, sf_dir)).select("id", "rank")


# Extraction and string functions.

def extraction(name: str, alias: str, build) -> None:
    def run(spark, sf_dir):
        return D.products(spark, sf_dir).select("p_partkey", build("name").alias(alias))

    QUERIES[name] = run


extraction("x01_weight_quantity", "weight", packs.weight_quantity)
extraction("x03_units_per_carton", "units", packs.units_per_carton)
extraction("x04_weight_token", "weight", packs.weight_token)
extraction("x05_units_early", "units", lambda c: packs.units_per_carton(c, packs.EARLY_RULES))
extraction("x06_packaging_type", "packaging", packs.packaging_type)


@query("x07_packaging_from_unit")
def x07(spark, sf_dir):
    df = D.run(spark, sf_dir, f"SELECT p_partkey, {D.UNIT} AS unit FROM part", "part")
    return df.select("p_partkey", packs.packaging_from_unit(F.col("unit")).alias("packaging"))


@query("x08_collapse_spaces")
def x08(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.collapse_spaces(F.col("text")).alias("text"))


@query("x09_brand_and_title")
def x09(spark, sf_dir):
    df = D.run(spark, sf_dir, "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN ' ' ELSE p_brand || ' ' END AS brand, CASE WHEN p_size % 5 > 0 THEN p_name END AS title FROM part", "part")
    return df.select("p_partkey", text.brand_and_title(F.col("brand"), F.col("title")).alias("title"))


LINKS = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN url
 ELSE regexp_replace(url, '^https?://[^/]*', '') END AS href FROM pages"""


@query("x10_absolute_url")
def x10(spark, sf_dir):
    df = D.run(spark, sf_dir, LINKS, "pages")
    return df.select("page_id", text.absolute_url(F.col("href"), D.SITE).alias("url"))


@query("x11_drop_query")
def x11(spark, sf_dir):
    df = D.run(spark, sf_dir, LINKS, "pages")
    return df.select("page_id", text.path_without_query(F.col("href"), D.SITE).alias("url"))


@query("x12_search_url")
def x12(spark, sf_dir):
    df = D.run(spark, sf_dir, "SELECT p_partkey, p_brand || ' ~*é&+' || p_name AS title FROM part", "part")
    return df.select("p_partkey", text.search_url(F.col("title"), D.SITE).alias("url"))


@query("x13_price_text")
def x13(spark, sf_dir):
    df = D.run(spark, sf_dir, "SELECT p_partkey, 'AED' || chr(160) || p_retailprice || '  ' AS price FROM part", "part")
    return df.select("p_partkey", text.price_text(F.col("price")).alias("price"))


# Reports.

def grouped_report(name: str, build) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(R.group_summary(D.master(spark, sf_dir)))


def serial_report(name: str, build) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(R.serial_summary(D.master(spark, sf_dir)))


grouped_report("a01_total_products", R.total_products)
grouped_report("a02_by_packaging", R.by_packaging)
grouped_report("a03_total_units", R.total_units)
serial_report("a04_duplicate_serials", R.duplicate_serials)
grouped_report("a05_missing_serials", R.missing_serials)
grouped_report("a06_by_supplier", R.by_supplier)
serial_report("a07_in_several_catalogs", R.in_several_catalogs)
serial_report("a08_only_in_one_catalog", R.only_in_one_catalog)


def scraped(spark, sf_dir) -> DataFrame:
    return E.enrich(D.page_matches(spark, sf_dir), D.product_pages(spark, sf_dir), D.AS_OF, D.SITE)


@query("a09_match_coverage")
def a09(spark, sf_dir):
    return R.match_coverage(M.match_wide(D.wide(spark, sf_dir)))


@query("a10_barcode_coverage")
def a10(spark, sf_dir):
    return R.barcode_coverage(scraped(spark, sf_dir).filter("outcome = 'parsed'"))


@query("a11_image_coverage")
def a11(spark, sf_dir):
    return R.image_coverage(scraped(spark, sf_dir).filter("outcome = 'parsed'"))


@query("a12_report")
def a12(spark, sf_dir):
    return R.report(D.master(spark, sf_dir), D.AS_OF)


# Union, dedup, keys and state.

@query("d01_dedup_keep_first")
def d01(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_name", "p_brand", "p_partkey", "p_type", "p_size")
    return K.first_per_key(parts, ["p_name", "p_brand"], ["p_partkey"])


@query("d02_union_sources")
def d02(spark, sf_dir):
    rows = K.union_sources(D.catalogs(spark, sf_dir), (D.UNIT_SUPPLIER,))
    return rows.select("Supplier", "Product_Name", "Weight_Quantity", "Units_Per_Carton", "Packaging_Type")


@query("d03_skip_done")
def d03(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id", F.lit("done").alias("outcome"))
    return S.not_done(read(spark, sf_dir, "documents"), labels, "doc_id").select("doc_id", "source")


def event_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    events = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    old = F.col("event_type").isin("view", "click")
    return events.filter(old), events.filter(~old)


@query("d04_upsert_last")
def d04(spark, sf_dir):
    return S.upsert_last(*event_sides(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query("d05_upsert_first")
def d05(spark, sf_dir):
    return S.upsert_first(*event_sides(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query("d06_mark_processed")
def d06(spark, sf_dir):
    done = read(spark, sf_dir, "labels").select("doc_id")
    return S.mark_processed(read(spark, sf_dir, "documents").select("doc_id"), done, "doc_id")


@query("d07_evolve_schema")
def d07(spark, sf_dir):
    return S.with_flag(read(spark, sf_dir, "documents").select("doc_id"))


@query("d08_downgrade_failed")
def d08(spark, sf_dir):
    matches = D.page_matches(spark, sf_dir)
    outcomes = scraped(spark, sf_dir).filter("outcome <> 'no match'").select(
        F.col("Scrape_ID").cast("string").alias("id"), "outcome"
    )
    return S.downgrade_failed(matches, outcomes).select("id", "status", "scraped")


@query("d09_dense_ids")
def d09(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return K.with_dense_ids(orders, ["o_orderdate", "o_orderkey"], "order_id", "order_")


@query("d10_failed_records")
def d10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    found = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return S.not_done(docs, S.search_outcomes(docs, found, "doc_id"), "doc_id", retry_failed=True)


# Matching.

@query("t01_title_cosine")
def t01(spark, sf_dir):
    return M.long_scores_of_wide(D.wide(spark, sf_dir)).select("id", "rank", F.round("similarity", 3).alias("similarity"))


@query("t01_long_text_cosine")
def t01_long(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    pairs = docs.select("doc_id", "text").join(following, "doc_id")
    scored = score_long_pairs(pairs, ["doc_id"], tokens_sql("text"), tokens_sql("other"))
    return scored.select("doc_id", F.round("similarity", 3).alias("similarity"))


@query("t02_cosine_without_stop_words")
def t02(spark, sf_dir):
    table = M.similarity_table(D.wide(spark, sf_dir), D.AS_OF, STOP_WORDS)
    return table.select("id", *[f"url_{r}_similarity" for r in C.CANDIDATE_RANKS], "processed_date")


@query("t03_wide_to_long")
def t03(spark, sf_dir):
    return C.wide_to_long(D.wide(spark, sf_dir))


@query("t04_best_candidate")
def t04(spark, sf_dir):
    best = M.best_candidate(M.long_scores_of_wide(D.wide(spark, sf_dir)))
    return best.select("id", "best_url", F.round("best_similarity", 3).alias("best_similarity"))


@query("t05_decision")
def t05(spark, sf_dir):
    return M.match_wide(D.wide(spark, sf_dir))


@query("t06_augmented_scores")
def t06(spark, sf_dir):
    return M.augment(D.wide(spark, sf_dir)).select(
        "id", *[f"url_{r}_similarity" for r in C.CANDIDATE_RANKS], "best_similarity", "matched_url", "status"
    )


@query("t07_scores_to_wide")
def t07(spark, sf_dir):
    return M.scores_to_wide(M.long_scores_of_wide(D.wide(spark, sf_dir)))


def user_events(spark, sf_dir) -> DataFrame:
    events = read(spark, sf_dir, "events")
    return events.select("user_id", "ts", "event_id", F.col("event_type").alias("title"), F.col("props").alias("url"))


@query("t08_top_five")
def t08(spark, sf_dir):
    return C.top_candidates(user_events(spark, sf_dir), "user_id", ["ts", "event_id"]).select(
        "user_id", "rank", "event_id", "title"
    )


@query("t09_pad_to_five")
def t09(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), "turn", F.col("role").alias("url"), F.col("text").alias("title")
    )
    return C.long_to_wide(C.top_candidates(turns, "id", ["turn"]))


def retrieval_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return D.run(spark, sf_dir, D.RECORD_TITLES, "part"), D.run(spark, sf_dir, D.ITEM_TITLES, "part")


@query("t10_retrieve_candidates")
def t10(spark, sf_dir):
    records, items = retrieval_inputs(spark, sf_dir)
    found = C.retrieve(records.select("id", F.col("input_title").alias("title")), items)
    return found.select("id", "rank", "key", "url", "title", F.round("similarity", 3).alias("similarity"))


@query("t10_templated")
def t10_templated(spark, sf_dir):
    found = C.retrieve(D.run(spark, sf_dir, D.TEMPLATED_RECORDS, "customer"), D.run(spark, sf_dir, D.TEMPLATED_ITEMS, "customer"))
    return found.select("id", "rank", "key", "url", "title", F.round("similarity", 3).alias("similarity"))


@query("t10_long_documents")
def t10_long(spark, sf_dir):
    """Benchmark passages and part names against whole documents."""
    records, items = D.run(spark, sf_dir, D.LONG_RECORDS, "benchmark", "part"), D.run(spark, sf_dir, D.LONG_ITEMS, "documents")
    found = C.retrieve(records, items, threshold=0.4)
    return found.select("id", "rank", "key", "url", F.round("similarity", 3).alias("similarity"))


@query("t11_repeated_ids")
def t11_repeated(spark, sf_dir):
    return PM.match_from_catalog(D.run(spark, sf_dir, D.REPEATED_RECORDS, "part"), D.run(spark, sf_dir, D.ITEM_TITLES, "part"))


@query("t11_match_summary")
def t11(spark, sf_dir):
    records, items = retrieval_inputs(spark, sf_dir)
    return PM.match_from_catalog(records, items)


# Page attributes.

def fields(spark, sf_dir, *names: str) -> DataFrame:
    return P.page_fields(D.product_pages(spark, sf_dir), fallback_h1=True).select("page_id", *names)


@query("h01_result_list")
def h01(spark, sf_dir):
    return P.search_results(D.result_pages(spark, sf_dir), "id", D.SITE)


@query("h01_nested_slots")
def h01_nested(spark, sf_dir):
    return P.search_results(D.result_pages(spark, sf_dir, nested=True), "id", D.SITE)


@query("h01_result_list_early")
def h01_early(spark, sf_dir):
    return P.search_results(D.result_pages(spark, sf_dir), "id", D.SITE, early=True)


@query("h02_title")
def h02(spark, sf_dir):
    return fields(spark, sf_dir, "page_title")


@query("h03_price")
def h03(spark, sf_dir):
    return fields(spark, sf_dir, "page_price")


@query("h04_image")
def h04(spark, sf_dir):
    return fields(spark, sf_dir, "page_image")


@query("h05_description")
def h05(spark, sf_dir):
    return fields(spark, sf_dir, "page_description")


@query("h06_barcode")
def h06(spark, sf_dir):
    return fields(spark, sf_dir, "page_barcode")


@query("h07_visible_text")
def h07(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", F.expr(H.joined_strings(H.visible_markup("html"), " ")).alias("text"))


@query("h08_unusable_page")
def h08(spark, sf_dir):
    live = D.product_pages(spark, sf_dir).select("page_id", F.expr(H.visible_markup("html")).alias("live"))
    return live.select(
        "page_id", F.expr(H.is_unusable("live")).alias("unusable"),
        F.expr(H.is_unusable("live", H.BLOCK_PHRASES_SEARCH)).alias("unusable_search"),
    )


@query("h09_scraped_products")
def h09(spark, sf_dir):
    return scraped(spark, sf_dir).select(*SCRAPED_COLUMNS)


@query("h10_all_empty_check")
def h10(spark, sf_dir):
    routed = P.route(D.page_matches(spark, sf_dir), D.product_pages(spark, sf_dir), check_empty=True)
    return routed.groupBy("outcome").agg(F.count("*").alias("n"))


@query("h11_titles_from_pages")
def h11(spark, sf_dir):
    heading = """'<h2 class="a-size-base-plus a-spacing-none x a-color-base a-text-normal"><i>Ad</i><span> Page ' || page_id || '</span></h2>'"""
    pages = D.run(
        spark, sf_dir,
        f"SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN html ELSE replace(html, '<article>', {heading} || '<article>') END AS html FROM pages",
        "pages",
    )
    candidates = D.page_matches(spark, sf_dir).select("id", F.col("matched_url").alias("url"))
    return P.titles_from_pages(candidates, pages)


# Order and preview.

@query("l02_preview")
def l02(spark, sf_dir):
    return K.preview(K.consolidate(D.catalogs(spark, sf_dir), (D.UNIT_SUPPLIER,)))


# End to end.

@query("e1_catalog_to_report")
def e1(spark, sf_dir):
    clean = K.consolidate(D.catalogs(spark, sf_dir), (D.UNIT_SUPPLIER,))
    return R.group_summary(K.to_master(clean, D.AS_OF))


@query("e2_results_to_matches")
def e2(spark, sf_dir):
    pages = D.result_pages(spark, sf_dir)
    records = pages.select(
        "id", F.concat(F.lit("S"), "id").alias("serial_number"),
        F.concat(F.lit("Brand1 Product 1 of "), F.when(F.col("id").cast("int") % 3 == 0, "").otherwise(F.col("id"))).alias("input_title"),
    )
    return PM.match_from_results(records, pages, D.SITE)


@query("e2_resumed")
def e2_resumed(spark, sf_dir):
    """The matching job in batches, one of them repeated and one with nothing left to do."""
    out = scratch(spark)
    pages = D.result_pages(spark, sf_dir).withColumn("id", F.concat(F.lit("S"), "id"))
    number = F.substring("id", 2, 20).cast("int")
    titles = F.concat(F.lit("Brand1 Product 1 of "), F.when(number % 3 == 0, "").otherwise(number.cast("string")))
    products = pages.select(F.col("id").alias("Serial_Number"), titles.alias("Product_Name"))
    for batch, todo in (("1", products.filter("Serial_Number < 'S5'")), ("2", products), ("2", products), ("3", products)):
        PM.run_match(spark, todo, pages, out, batch, D.AS_OF, D.SITE)
    return spark.read.parquet(f"{out}/matches").drop("batch_id")


@query("e3_resumed_batches")
def e3(spark, sf_dir):
    out = scratch(spark)
    matches, pages = D.page_matches(spark, sf_dir), D.product_pages(spark, sf_dir)
    first = matches.filter("status = 'Available'")
    E.run_batch(spark, first, pages, out, "1", D.AS_OF, D.SITE)
    E.run_batch(spark, first, pages, out, "1", D.AS_OF, D.SITE)  # repeated after a crash
    E.run_batch(spark, matches, pages, out, "2", D.AS_OF, D.SITE)
    return E.current_products(spark, out)


@query("e3_text_ids")
def e3_text_ids(spark, sf_dir):
    """Record ids that are no numbers, or that only differ as text: each is processed once and kept."""
    out = scratch(spark)
    matches, pages = D.page_matches(spark, sf_dir), D.product_pages(spark, sf_dir)
    number = F.col("id").cast("bigint")
    matches = matches.withColumn("id", F.when(number % 3 == 0, F.concat(F.lit("A-"), "id")).when(number % 3 == 1, F.concat(F.lit("00"), "id")).otherwise(F.col("id")))
    for batch in ("1", "2", "3"):
        todo = matches.filter(F.col("status") == "Available") if batch == "1" else matches
        E.run_batch(spark, todo, pages, out, batch, D.AS_OF, D.SITE)
    rows = spark.read.parquet(f"{out}/scraped_products")
    return rows.groupBy("record_id").agg(F.count("*").alias("n"), F.max("Product_Name").alias("Product_Name"), F.max("Scrape_ID").alias("Scrape_ID"))
