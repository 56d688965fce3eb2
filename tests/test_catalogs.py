import csv
import io
import json
import logging
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import consolidate as K
from shelfmark.plans.catalog import build_master
from shelfmark.schema import CLEAN_COLUMNS, MASTER_COLUMNS
from shelfmark.sources.catalogs import has_quoted_breaks, path_exists, read_catalogs, standardize_columns
from shelfmark.sources.records import read_keyed_records, read_records
from shelfmark.sources.tables import load_master, write_catalog

AS_OF = "2025-01-02 03:04:05"


@pytest.fixture
def files(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return str(path)

    return {
        "A": write("a.csv", 'SERIAL NUMBER,PRODUCT TITLE\r\n1,"TEA, GREEN 100G"\r\n2,N/A\r\n3,RICE 5KG\r\n1,RICE 5KG'),
        "B": write("b.csv", "SL NO,Item Name\n1,RICE 5KG\n,SALT 96PCS\n\n"),
        "Gone": str(tmp_path / "missing.csv"),
        "C": write("c.csv", "Serial_Number,Product_Name,Weight_Quantity,Units_Per_Carton,Packaging_Type\n9,PEAS 1KG X10,9KG,9,BAG\n"),
        "D": write("d.csv", "SL NO,Item Name,Unit\n7,OIL 5LT CTN,BTL\n8,OIL, ctn \nnan,OIL 2 X 6 X 8,\n"),
    }


def test_catalogs_to_report(spark, files, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        report = build_master(spark, files, str(tmp_path / "out"), AS_OF, unit_suppliers=("D",))
    assert "missing.csv" in caplog.text
    clean = spark.read.parquet(str(tmp_path / "out" / "clean"))
    assert clean.columns == CLEAN_COLUMNS and dict(clean.dtypes)["Units_Per_Carton"] == "bigint"
    rows = [tuple(r) for r in clean.orderBy(F.substring_index("Product_ID", "_", -1).cast("int")).collect()]
    assert rows == [
        ("product_1", "TEA, GREEN 100G", "1", "A", "100G", "NON-CTN", None),
        ("product_2", None, "2", "A", None, "NON-CTN", None),
        ("product_3", "RICE 5KG", "3", "A", "5000G", "NON-CTN", None),
        ("product_4", "RICE 5KG", "1", "B", "5000G", "NON-CTN", None),
        ("product_5", "SALT 96PCS", None, "B", None, "NON-CTN", 96),
        ("product_6", "PEAS 1KG X10", "9", "C", "1000G", "NON-CTN", 10),
        ("product_7", "OIL 5LT CTN", "7", "D", "5G", "NON-CTN", None),
        ("product_8", "OIL", "8", "D", None, "CTN", None),
        ("product_9", "OIL 2 X 6 X 8", None, "D", None, "NON-CTN", 12),
    ]
    master = spark.read.parquet(str(tmp_path / "out" / "master"))
    assert master.columns == MASTER_COLUMNS
    assert master.filter("Source_File <> Supplier OR Last_Updated <> '2025-01-02 03:04:05'").isEmpty()
    results = {}
    for r in report.collect():
        results.setdefault(r.Query_Description, set()).add(r.Result)
    assert len(results) == 8
    assert results["Total number of products"] == {'{"total_products":9}'}
    assert results["Duplicate Serial_Numbers"] == {'{"Serial_Number":null,"count":2}', '{"Serial_Number":"1","count":2}'}
    assert results["Products appearing in multiple catalogs"] == {
        '{"Serial_Number":null,"supplier_count":2}', '{"Serial_Number":"1","supplier_count":2}'
    }
    assert results["Unique products (only in one catalog)"] == {'{"unique_products":5}'}
    assert {'{"Supplier":"A","total_products":3}', '{"Supplier":"D","total_products":3}'} <= results["Supplier-wise product counts"]


def test_missing_product_name_is_an_error(spark):
    with pytest.raises(ValueError, match="Acme"):
        standardize_columns(spark.createDataFrame([("1",)], "`SL NO` string"), "Acme")


def test_missing_serial_becomes_null(spark):
    df = standardize_columns(spark.createDataFrame([("x",)], "Name string"), "Acme")
    assert df.first().asDict() == {"Product_Name": "x", "Serial_Number": None, "Supplier": "Acme"}


@pytest.mark.parametrize("text, want", [
    ('Name,Unit\n"two\nlines",x\n', [("two\nlines", "x")]),
    ('Name,Unit\n"say ""hi""",x\n"two ""\n\nlines",y\n', [('say "hi"', "x"), ('two "\n\nlines', "y")]),
    ('Name,Unit\n"say ""hi""",x\n5" pipe,y\n', [('say "hi"', "x"), ('5" pipe', "y")]),
])
def test_quoted_line_breaks_do_not_split_rows(spark, tmp_path, text, want):
    (tmp_path / "m.csv").write_text(text)
    df = read_catalogs(spark, {"M": str(tmp_path / "m.csv")})["M"]
    assert [(r.Name, r.Unit) for r in df.collect()] == want


def test_input_order_over_many_splits(spark, tmp_path):
    lines = "\n".join(f"{i},NAME {i % 3000}" for i in range(20000))
    (tmp_path / "big.csv").write_text("SL NO,Item Name\n" + lines + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = read_catalogs(spark, {"Big": str(tmp_path / "big.csv")})
        assert found["Big"].rdd.getNumPartitions() > 5
        clean = K.consolidate(found).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    number = {r.Product_Name: (int(r.Product_ID.split("_")[1]), r.Serial_Number) for r in clean}
    assert number == {f"NAME {i}": (i + 1, str(i)) for i in range(3000)}


def test_master_rejects_missing_columns_and_repeated_ids(spark, tmp_path):
    row = spark.createDataFrame([("p", "n", "1", "s", None, None, None)], ", ".join(f"{c} string" for c in CLEAN_COLUMNS))
    with pytest.raises(ValueError, match="Supplier"):
        write_catalog(row.drop("Supplier"), str(tmp_path / "x"))
    master = K.to_master(row, AS_OF)
    load_master(master, path=str(tmp_path / "m"))
    load_master(master, path=str(tmp_path / "m"))  # replaced, not appended
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1
    with pytest.raises(ValueError, match="unique"):
        load_master(master.union(master), path=str(tmp_path / "m"))


def test_lineage_without_supplier(spark):
    cols = [c for c in CLEAN_COLUMNS if c != "Supplier"]
    df = spark.createDataFrame([("p",) + (None,) * 5], ", ".join(f"{c} string" for c in cols))
    with pytest.raises(ValueError, match="Supplier"):
        K.to_master(df, AS_OF)


def test_ids_are_dense_with_one_hot_order_value(spark):
    df = spark.range(0, 30000, numPartitions=7).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    got = K.with_row_number(df, ["g", "id"], "n").orderBy("g", "id").select("n").collect()
    assert [r.n for r in got] == list(range(1, 30001))
    empty = K.with_row_number(df.limit(0), ["g", "id"], "n")
    assert empty.isEmpty()


def test_ids_do_not_sort_in_one_task(spark):
    df = spark.range(1000).withColumn("name", F.lit("x"))
    plan = K.with_dense_ids(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_dedup_keeps_the_first_of_a_hot_key(spark):
    df = spark.range(0, 9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("Product_Name"),
        F.lit(None).cast("string").alias("Supplier"), F.lit(0).alias("source_rank"), F.lit("").alias("file_name"),
        F.lit(0).alias("block_start"), (9000 - F.col("id")).alias("row_seq"),
    )
    kept = K.dedup_keep_first(df)
    assert kept.count() == 6001 and kept.filter("Product_Name = 'hot'").first().row_seq == 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_records_json(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"id": "1", "input_title": "é", "url_1": "u"}, {"id": "2"}]')
    good, bad = read_records(spark, str(tmp_path / "list.json"))
    assert [(r.id, r.input_title, r.url_1, r.url_5) for r in good.collect()] == [("1", "é", "u", None), ("2", None, None, None)]
    assert bad.collect() == []
    (tmp_path / "lines.json").write_text('{"id": "1"}\n{"id": \n')
    good, bad = read_records(spark, str(tmp_path / "lines.json"), lines=True)
    assert [r.id for r in good.collect()] == ["1"] and [r.raw for r in bad.collect()] == ['{"id": ']
    (tmp_path / "empty.json").write_text("")
    assert read_records(spark, str(tmp_path / "empty.json"))[0].collect() == []


def test_keyed_records_json(spark, tmp_path):
    (tmp_path / "keyed.json").write_text('{"5": {"Serial_Number": "5", "input_title": "t", "1st_url": "u", "1st_url_title": "x"}, "6": {"input_title": "failed"}}')
    (tmp_path / "broken.json").write_text("{oops")
    (tmp_path / "blank.json").write_text("  \n")
    good, bad = read_keyed_records(spark, str(tmp_path / "*.json"))
    rows = {r.serial_number: (r.input_title, r.url_1, r.url_1_title) for r in good.collect()}
    assert rows == {"5": ("t", "u", "x"), "6": ("failed", None, None)}
    assert [r.raw for r in bad.collect()] == ["{oops"]


def plain_csv(text):
    return [r for r in csv.reader(io.StringIO(text)) if r]


@pytest.mark.parametrize("multi_line", [None, True])
def test_odd_quotes_and_breaks_in_many_splits(spark, tmp_path, multi_line):
    """Inch marks, doubled quotes, commas and breaks inside quotes, read in small splits."""
    rng = random.Random(3)
    pieces = ['5" PIPE', "plain", "", 'x""y', 'a "b" c', "é"]
    quoted = ['"two\nlines"', '"a, b"', '"say ""hi"", then\n\nstop"', '"5"" PIPE"', '"\n"', '",\n,"', '"""\n"""']
    rows = [f"{i},{rng.choice(pieces + quoted)},{rng.choice(pieces + quoted)}" for i in range(3000)]
    text = "SL NO,Item Name,Note\n" + "\n".join(rows) + "\n"
    (tmp_path / "w.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        assert spark.read.text(str(tmp_path / "w.csv")).rdd.getNumPartitions() > 8
        got = read_catalogs(spark, {"W": str(tmp_path / "w.csv")}, multi_line)["W"]
        rows = [tuple(r) for r in got.orderBy("block_start", "row_seq").select(*got.columns[:3]).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [tuple(x or None for x in r) for r in plain_csv(text)[1:]]


def test_inch_marks_alone_do_not_put_lines_together(spark, tmp_path):
    (tmp_path / "w.csv").write_text('SL NO,Item Name\n1,5" PIPE\n2,6" PIPE "x\n')
    assert not has_quoted_breaks(spark, str(tmp_path / "w.csv"))
    got = read_catalogs(spark, {"W": str(tmp_path / "w.csv")})["W"]
    assert [(r["SL NO"], r["Item Name"]) for r in got.collect()] == [("1", '5" PIPE'), ("2", '6" PIPE "x')]


def test_bad_entries_cost_themselves_alone(spark, tmp_path):
    entries = ['{"id": "1", "input_title": "a } b { \\" ] [ , x"}', '{"id":{"x":1}}', "7", '"}"', '{"id": "2", "url_1": ["u"]}', "null", '{"id": 3, "other": {"deep": [1]}}', "[1, {}]", "{}"]
    (tmp_path / "mixed.json").write_text(" [" + " ,\n".join(entries) + "]\n")
    (tmp_path / "object.json").write_text('{"id": "9"}')
    (tmp_path / "cut.json").write_text('[{"id": "4"}, {"id": "5"}, {"id": "6", "input_ti')
    (tmp_path / "comma.json").write_text('[{"id": "10"} {"id": "11"}, {"id": "12", "id": }, {"id": "13"}]')
    good, bad = read_records(spark, str(tmp_path / "*.json"))
    assert sorted((r.id, r.input_title) for r in good.filter("id IS NOT NULL").collect()) == sorted([("1", 'a } b { " ] [ , x'), ("3", None), ("4", None), ("5", None), ("10", None), ("11", None), ("13", None)])  # a missing comma costs nothing
    assert good.filter("id IS NULL").count() == 1  # the empty object
    got = [(r.file_name.rsplit("/", 1)[1], r.raw.strip()) for r in bad.collect()]
    assert sorted(g for g in got if g[0] == "mixed.json") == sorted(("mixed.json", x) for x in ('{"id":{"x":1}}', "7", '"}"', '{"id":"2","url_1":["u"]}', "null", "[1,{}]"))
    assert ("object.json", '{"id": "9"}') in got and ("cut.json", ', {"id": "6", "input_ti') in got
    assert [g[1] for g in got if g[0] == "comma.json"] == [', {"id": "12", "id": }']


def test_bad_keyed_entries(spark, tmp_path):
    (tmp_path / "k.json").write_text('{"a": {"input_title": "t"}, "b": 7, "c": {"1st_url": {"x": 1}}, "d": {"Serial_Number": 12}}')
    good, bad = read_keyed_records(spark, str(tmp_path / "k.json"))
    assert sorted((r.id, r.serial_number, r.input_title) for r in good.collect()) == [("a", "a", "t"), ("d", "12", None)]
    assert sorted(r.raw for r in bad.collect()) == ['{"b":7}', '{"c":{"1st_url":{"x":1}}}']


def test_one_long_line_is_read_in_many_tasks(spark, tmp_path):
    """A list of one line, cut anywhere: in strings that hold braces, quotes and backslashes too."""
    title = lambda i: '"quoted" } { \\\\ [%d], é' % i if i % 3 else f"plain {i}"
    rows = [{"id": str(i), "input_title": title(i), "url_1": "u" * (i % 90)} for i in range(4000)]
    (tmp_path / "list.json").write_text(json.dumps(rows, ensure_ascii=False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        good, bad = read_records(spark, str(tmp_path / "list.json"))
        got = {(r.id, r.input_title, r.url_1) for r in good.collect()}
        scan = spark.read.option("lineSep", "}").text(str(tmp_path / "list.json"))
        assert scan.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(r["id"], r["input_title"], r["url_1"]) for r in rows} and bad.count() == 0


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "no*"))
