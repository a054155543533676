"""Literal cases for the cleaning rules (FIXTURES.md, "Literal cases")."""

import datetime as d

import pytest
from pyspark.sql import functions as F

from tierforge.functions import clean as C

NB = "\u00a0"


def test_price_and_amount(spark):
    cases = [  # sales, qty, price -> amount, fixed price
        ((10, 2, 5), (10.0, 5.0)),
        ((None, 2, 5), (10.0, 5.0)),
        ((-10, 2, None), (10.0, -5.0)),
        ((10, 2, -3), (10.0, 5.0)),
        ((10, 0, None), (10.0, None)),
        ((0, 0, 5), (0.0, 5.0)),
        ((11, 2, 5), (10.0, 5.0)),
        ((10, 3, None), (10.0, 3.3333333333333335)),
        ((None, 2, None), (None, None)),
        ((10, None, 5), (10.0, 5.0)),
        ((10, None, None), (10.0, None)),
        ((1, 49, 0), (0.9999999999999999, 0.02040816326530612)),
    ]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, s int, q int, p int")
    fixed = C.repair_price("s", "q", "p")
    out = df.select("i", C.reconcile_amount("s", "q", fixed).alias("amount"), fixed.alias("price")).collect()
    got = {r.i: (r.amount, r.price) for r in out}
    for i, (_, expected) in enumerate(cases):
        assert got[i] == expected, (cases[i], got[i])


def test_parse_yyyymmdd(spark):
    df = spark.createDataFrame([(20101229,), (0,), (20101345,), (None,), (-1,), (2010122,), (320101229,)], "v int")
    got = [r.d for r in df.select(C.parse_yyyymmdd("v").alias("d")).collect()]
    assert got == [d.date(2010, 12, 29), None, None, None, None, None, None]


def test_parse_yyyymmdd_independent_of_ansi(spark):
    df = spark.createDataFrame([(20101345,)], "v int")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            assert df.select(C.parse_yyyymmdd("v").alias("d")).first().d is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_strip_prefix(spark):
    df = spark.createDataFrame([("NASAW01",), ("AW02",), (None,), ("nasX",)], "c string")
    got = [r.o for r in df.select(C.strip_prefix("c").alias("o")).collect()]
    assert got == ["AW01", "AW02", None, "nasX"]


def test_trim_only_spaces(spark):
    vals = ["\ta ", " a", "a", NB + "a" + NB, "  ", "\t a", "a \t"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.o for r in df.select(C.trim_spaces("c").alias("o")).collect()]
    assert got == ["\ta", "a", "a", NB + "a" + NB, "", "\t a", "a \t"]


@pytest.mark.parametrize("fn,vals,expected", [
    (C.decode_marital_status, [" s", "M ", None, "S", "D", ""], ["Single", "Married", "N/a", "Single", "N/a", "N/a"]),
    (C.decode_crm_gender, ["f ", " M", None, "", "x"], ["Female", "Male", "N/a", "N/a", "N/a"]),
    (C.decode_product_line, ["m ", "R", " s", "T", None, "Z"],
     ["Mountain", "Road", "Other Sales", "Touring", "N/a", "N/a"]),
    (C.normalize_erp_gender, ["F", " female ", "M" + NB, "Male", None, NB, "", "x"],
     ["Female", "Female", "Male", "Male", "n/a", "n/a", "n/a", "n/a"]),
    (C.standardize_country, ["us", NB + "USA ", "DE", None, "  ", "de ", " France" + NB, "New" + NB + "Zealand"],
     ["United States", "United States", "Germany", "n/a", "n/a", "Germany", "France", "NewZealand"]),
])
def test_decoders(spark, fn, vals, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    got = [r.o for r in df.select("i", fn("c").alias("o")).orderBy("i").collect()]
    assert got == expected


def test_split_key(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B-58",), ("AB-CD",), (None,)], "k string")
    got = df.select(C.category_id("k").alias("c"), C.product_number("k").alias("p")).collect()
    assert [(r.c, r.p) for r in got] == [("CO_RF", "FR-R92B-58"), ("AB_CD", ""), (None, None)]


def test_strip_chars(spark):
    df = spark.createDataFrame([("AW-000-1 ",), (None,)], "c string")
    assert [r.o for r in df.select(C.strip_chars("c", "-").alias("o")).collect()] == ["AW0001", None]


def test_null_after(spark):
    df = spark.createDataFrame([(d.date(2020, 1, 1),), (d.date(2020, 1, 2),), (None,), (d.date(1970, 5, 5),)], "b date")
    got = [r.o for r in df.select(C.null_after("b", "2020-01-01").alias("o")).collect()]
    assert got == [d.date(2020, 1, 1), None, None, d.date(1970, 5, 5)]
    assert df.select(C.null_after("b").alias("o")).where(F.col("o").isNull()).count() == 1  # 2020-01-02 < today


def test_prefer(spark):
    df = spark.createDataFrame([("Male", "Female"), ("N/a", "Female"), ("N/a", None), (None, "n/a"), ("N/a", "n/a")],
                               "p string, f string")
    got = [r.o for r in df.select(C.prefer("p", "N/a", "f", "N/a").alias("o")).collect()]
    assert got == ["Male", "Female", "N/a", "n/a", "n/a"]
