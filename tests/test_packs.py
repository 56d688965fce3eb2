import pytest
from pyspark.sql import functions as F

from shelfmark.functions import packs

# name, weight, units, packaging
VECTORS = [
    ("4 X 18 X 56G tail", "56G", 18, "NON-CTN"),
    ("4 X 18 X 56 PKT", None, 72, "NON-CTN"),
    ("24X500 ML CTN", "500G", 24, "CTN"),
    ("(1.5 ML*12)", "2G", 12, "NON-CTN"),
    ("96PCS", None, 96, "NON-CTN"),
    ("12pc cartons", None, 12, "CTN"),
    ("6*2.5L FAMILY CTN", "2500G", 6, "CTN"),
    ("7 UP 150 ML X 30", "150G", 30, "NON-CTN"),
    ("100 TEA BAGS", None, 100, "NON-CTN"),
    ("36+6", None, 42, "NON-CTN"),
    ("12 X KG", None, 12, "NON-CTN"),
    ("MIX 100G", "100G", 100, "NON-CTN"),
    ("5LT OIL", "5G", None, "NON-CTN"),
    ("62.5G", "62G", None, "NON-CTN"),
    ("63.5G", "64G", None, "NON-CTN"),
    ("2.5KGX 4", "2500G", 4, "NON-CTN"),
    ("10 GREEN TEA 50 BAGS", None, 50, "NON-CTN"),
    ("2 X 3 X 4 X 5 BOX", None, 24, "NON-CTN"),
    ("340GX24", "340G", 24, "NON-CTN"),
    ("6×1 LITRE", "1000G", 6, "NON-CTN"),
    ("500GÉ", None, None, "NON-CTN"),
    ("٥ KG", "5000G", None, "NON-CTN"),
    ("99999999999999999999 PCS X 5", None, None, "NON-CTN"),
    ("4000000000 X 4000000000 X 9 BOX", None, None, "NON-CTN"),
    ("", None, None, "NON-CTN"),
    (None, None, None, "NON-CTN"),
]


def test_vectors(spark):
    df = spark.createDataFrame([(v[0],) for v in VECTORS], "name string")
    name = "name"
    got = df.select(name, packs.weight_quantity(name), packs.units_per_carton(name), packs.packaging_type(name)).collect()
    assert [tuple(r) for r in got] == VECTORS


@pytest.mark.parametrize("name, weight, units", [
    ("500 g pack", "500G", None), ("2.5kg", "2.5KG", None), ("500GM", "500G", None),
    ("12PS", None, None), ("6 X 2 OZ", None, 6), ("100 BAGS", None, None), ("36+6", None, None), ("3*2L", "2L", 3),
])
def test_early_variant(spark, name, weight, units):
    df = spark.createDataFrame([(name,)], "name string")
    row = df.select(packs.weight_token("name"), packs.units_per_carton("name", packs.EARLY_RULES)).first()
    assert tuple(row) == (weight, units)


def test_unit_column(spark):
    df = spark.createDataFrame([(" ctn ",), ("CTN PACK",), (None,)], "u string")
    assert [r[0] for r in df.select(packs.packaging_from_unit(F.col("u"))).collect()] == ["CTN", "NON-CTN", "NON-CTN"]
