"""Sources and sinks: layout, storage configuration, format choice, observed counts."""

import os

import pytest
from pyspark.sql import functions as F

from tierforge.session import scratch_path
from tierforge.sources.io import (
    Layout,
    append_rows,
    configure_storage,
    read_feed,
    read_table,
    table_format,
    write_feed,
    write_table,
)
from tierforge.sources.schemas import AUDIT, ERP_LOCATIONS_FEED


def test_layout_paths():
    lay = Layout("/w")
    assert lay.feed("sales") == "/w/bronze/source_crm/sales_details"
    assert lay.feed("erp_locations") == "/w/bronze/source_erp/loc_a101"
    assert lay.table("silver_customers") == "/w/silver/source_crm/crm_cust_info"
    assert lay.table("silver_categories") == "/w/silver/source_erp/erp_px_cat_g1v2"
    assert lay.table("fact_sales") == "/w/gold/fact_sales"
    assert lay.audit() == "/w/audit/etl_audit"
    assert lay.table("my_extra_table") == "/w/tables/my_extra_table"


def test_layout_feed_paths():
    lay = Layout("/w", {"customers": "crm/cust_info.csv", "sales": "/in/sales.csv", "categories": "s3a://b/px.csv"})
    assert lay.feed("customers") == "/w/bronze/crm/cust_info.csv"
    assert lay.feed("sales") == "/in/sales.csv" and lay.feed("categories") == "s3a://b/px.csv"
    assert lay.feed("products") == Layout("/w").feed("products")


def test_configure_storage_sets_session_keys(spark):
    configure_storage(spark, {"fs.example.auth.type": "OAuth", "fs.example.client.id": "abc"})
    assert spark.conf.get("fs.example.auth.type") == "OAuth"
    assert spark.conf.get("fs.example.client.id") == "abc"


def test_table_format_default_is_parquet(spark):
    assert table_format(spark) == "parquet"


def test_write_table_counts_and_overwrites(spark):
    path = scratch_path(spark, "io")
    assert write_table(spark.range(0, 1234), path, "parquet") == 1234
    assert write_table(spark.range(0, 10).where(F.col("id") > 4), path, "parquet") == 5
    assert read_table(spark, path, "parquet").count() == 5


def test_failed_write_reports_no_count(spark):
    path = scratch_path(spark, "io-fail")
    bad = spark.range(0, 10).select(F.assert_true(F.col("id") < 5).alias("x"))
    try:
        write_table(bad, path, "parquet")
        raise AssertionError("write should fail")
    except Exception as exc:  # noqa: BLE001
        assert "AssertionError" not in type(exc).__name__


def test_failed_overwrite_keeps_the_old_table(spark):
    path = scratch_path(spark, "atomic") + "/t"
    assert write_table(spark.range(7).toDF("n"), path) == 7
    broken = spark.range(0, 100, 1, 8).select(F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("bigint"))
                                              .otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="boom"):
        write_table(broken, path)
    assert sorted(r.n for r in read_table(spark, path).collect()) == list(range(7))
    # a table may even be rewritten from itself, and nothing is left beside it
    assert write_table(read_table(spark, path).where("n < 3"), path) == 3
    assert read_table(spark, path).count() == 3
    folder = path.removeprefix("file://").removeprefix("file:").rsplit("/", 1)[0]
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == ["t"]


def test_columns_are_found_in_any_case(spark):
    row = spark.createDataFrame([(1, " a ")], "CST_ID bigint, Cst_Key string")
    assert row.select("cst_id", F.trim("CST_KEY").alias("k")).collect() == [(1, "a")]


def test_csv_keeps_spaces_and_nbsp(spark):
    path = scratch_path(spark, "csv")
    rows = [(" AW-1 ", "  "), ("AW-2", " USA "), ("AW-3", None), ("AW-4", "")]
    write_feed(spark.createDataFrame(rows, ERP_LOCATIONS_FEED), path)
    back = {r.CID: r.CNTRY for r in read_feed(spark, path, ERP_LOCATIONS_FEED).collect()}
    assert back == {" AW-1 ": "  ", "AW-2": " USA ", "AW-3": None, "AW-4": None}


def test_append_rows_appends_one_file(spark):
    path = scratch_path(spark, "audit")
    row = ("t", "silver", "SUCCESS", 3, None, None, 0.5, None, None, 0, None)
    append_rows(spark, [row, row], AUDIT, path)
    append_rows(spark, [row], AUDIT, path)
    df = read_table(spark, path, "parquet")
    assert df.count() == 3
    assert len(df.inputFiles()) == 2


def test_malformed_value_becomes_null_under_explicit_schema(spark):
    from tierforge.plans.tables import silver_customers
    from tierforge.sources.schemas import CUSTOMERS_FEED

    path = scratch_path(spark, "bad-csv")
    lines = spark.createDataFrame([("cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,"
                                    "cst_create_date",),
                                   ("12,AW1, Ann ,Lee,S,F,2020-01-05",),
                                   ("abc,AW2,Bo,Kim,M,M,2020-02-01",),
                                   ("13,AW3,Cy,Ray,M,M,not-a-date",)], "value string")
    lines.coalesce(1).write.text(path)
    raw = read_feed(spark, path, CUSTOMERS_FEED)
    assert dict(raw.dtypes)["cst_id"] == "bigint"         # the column stays numeric
    by_key = {r.cst_key: r for r in raw.collect()}
    assert by_key["AW2"].cst_id is None                    # the malformed id alone becomes null
    assert by_key["AW3"].cst_create_date is None           # so does the malformed date
    assert sorted(r.cst_key for r in silver_customers(raw).collect()) == ["AW1", "AW3"]


def test_feed_columns_are_found_by_name_and_money_keeps_decimals(spark, tmp_path):
    from tierforge.plans import tables as T
    from tierforge.sources.schemas import SALES_FEED

    path = tmp_path / "sales.csv"
    path.write_text(
        "extra,sls_price,SLS_ORD_NUM,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity\n"
        "x,12.5,SO1,p,7,20200101,20200102,20200103,30,2\n"
        "y,12.75,SO2,p,7,20200101,20200102,20200103,25.5,2\n")
    raw = read_feed(spark, str(path), SALES_FEED)
    assert raw.columns == SALES_FEED.fieldNames()
    got = {r.sls_ord_num: (r.sls_sales, r.fixed_price) for r in T.silver_sales(raw).collect()}
    assert got == {"SO1": (25.0, 12.5), "SO2": (25.5, 12.75)}
