"""Explicit schemas of the six raw feeds and of the audit row.

Reading feeds with a declared schema skips the inference pass over the data
and keeps id columns numeric even when a value is malformed (it becomes null
in PERMISSIVE mode instead of turning the whole column into strings).
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CUSTOMERS_FEED = _schema(
    ("cst_id", LongType()), ("cst_key", StringType()), ("cst_firstname", StringType()),
    ("cst_lastname", StringType()), ("cst_marital_status", StringType()), ("cst_gndr", StringType()),
    ("cst_create_date", DateType()),
)

# The same feed where the creation date has a time of day; two records of one day are then told apart.
CUSTOMERS_FEED_TIMED = StructType(
    [StructField(f.name, TimestampType() if f.name == "cst_create_date" else f.dataType, True) for f in CUSTOMERS_FEED])

PRODUCTS_FEED = _schema(
    ("prd_id", LongType()), ("prd_key", StringType()), ("prd_nm", StringType()),
    ("prd_cost", DoubleType()), ("prd_line", StringType()), ("prd_start_dt", DateType()),
)

SALES_FEED = _schema(
    ("sls_ord_num", StringType()), ("sls_prd_key", StringType()),
    ("sls_cust_id", LongType()), ("sls_order_dt", IntegerType()), ("sls_ship_dt", IntegerType()),
    ("sls_due_dt", IntegerType()), ("sls_sales", DoubleType()), ("sls_quantity", IntegerType()),
    ("sls_price", DoubleType()),
)

ERP_CUSTOMERS_FEED = _schema(("CID", StringType()), ("BDATE", DateType()), ("gen", StringType()))

ERP_LOCATIONS_FEED = _schema(("CID", StringType()), ("CNTRY", StringType()))

CATEGORIES_FEED = _schema(
    ("ID", StringType()), ("CAT", StringType()), ("SUBCAT", StringType()), ("MAINTENANCE", StringType()),
)

AUDIT = _schema(
    ("task_name", StringType()), ("layer", StringType()), ("status", StringType()),
    ("rows_processed", LongType()), ("start_time", TimestampType()), ("end_time", TimestampType()),
    ("duration_seconds", DoubleType()), ("error_message", StringType()), ("executed_at", TimestampType()),
    ("rows_rejected", LongType()), ("rejects", StringType()),
)

# One row per feed record with a value that its declared type does not take.
QUARANTINE = StructType([
    StructField("feed", StringType(), True), StructField("record", StringType(), True),
    StructField("rejected", MapType(StringType(), StringType(), True), True), StructField("run_id", StringType(), True),
])

FEEDS = {
    "customers": CUSTOMERS_FEED,
    "products": PRODUCTS_FEED,
    "sales": SALES_FEED,
    "erp_customers": ERP_CUSTOMERS_FEED,
    "erp_locations": ERP_LOCATIONS_FEED,
    "categories": CATEGORIES_FEED,
}
