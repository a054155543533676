"""The nine table builds (T1-T9): DataFrames in, DataFrame out, no I/O.

Silver builds clean one raw feed each; gold builds join silver tables into two
dimensions and one fact. Output columns are lower-case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.functions import clean as C
from tierforge.operators.keys import surrogate_key
from tierforge.operators.star import lookup
from tierforge.operators.versions import current_only, end_date_versions, keep_latest


def silver_customers(raw: DataFrame) -> DataFrame:
    """Positive ids, latest record per id (ties kept), trimmed names, decoded codes."""
    valid = raw.where(F.col("cst_id") > 0)
    latest = keep_latest(valid, "cst_id", "cst_create_date")
    return latest.select(
        "cst_id", "cst_key",
        *C.trim_columns(["cst_firstname", "cst_lastname"]),
        C.decode_marital_status("cst_marital_status").alias("cst_marital_status"),
        C.decode_crm_gender("cst_gndr").alias("cst_gndr"),
        "cst_create_date",
    )


def silver_product_versions(raw: DataFrame, raw_key: str | None = None) -> DataFrame:
    """Split the composite key, decode the line, end-date versions.

    Versions are keyed on the *full* raw key (the short product number is an
    output column only); equal start dates are ordered by ``prd_id``. With
    ``raw_key`` the full key is put out too, under that name.
    """
    dated = end_date_versions(raw, "prd_key", "prd_start_dt", tie_breaker=["prd_id"], name="prd_end_days")
    return dated.select(
        "prd_id",
        C.category_id("prd_key").alias("cat_id"),
        C.product_number("prd_key").alias("prd_key"),
        "prd_nm", "prd_cost",
        C.decode_product_line("prd_line").alias("prd_line"),
        "prd_start_dt", "prd_end_days",
        *([F.col("prd_key").alias(raw_key)] if raw_key else []),
    )


def silver_sales(raw: DataFrame) -> DataFrame:
    """Repaired price, three parsed dates, reconciled amount. Pure map."""
    fixed = C.repair_price("sls_sales", "sls_quantity", "sls_price")
    return raw.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id",
        C.parse_yyyymmdd("sls_order_dt").alias("sls_order_dt"),
        C.parse_yyyymmdd("sls_ship_dt").alias("sls_ship_dt"),
        C.parse_yyyymmdd("sls_due_dt").alias("sls_due_dt"),
        C.reconcile_amount("sls_sales", "sls_quantity", fixed).alias("sls_sales"),
        "sls_quantity",
        fixed.alias("fixed_price"),
    )


def silver_erp_customers(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """T4: id prefix stripped, future birth dates nulled, gender words normalised."""
    return raw.select(
        C.strip_prefix("CID").alias("cid"),
        C.null_after("BDATE", as_of).alias("bdate"),
        C.normalize_erp_gender("gen").alias("gen"),
    )


def silver_erp_locations(raw: DataFrame) -> DataFrame:
    """T5: dashes removed from the id, country standardised."""
    return raw.select(C.strip_chars("CID", "-").alias("cid"), C.standardize_country("CNTRY").alias("cntry"))


def silver_categories(raw: DataFrame) -> DataFrame:
    """The category lookup as is."""
    return raw.select(
        F.col("ID").alias("id"), F.col("CAT").alias("cat"),
        F.col("SUBCAT").alias("subcat"), F.col("MAINTENANCE").alias("maintenance"),
    )


def dim_customers(customers: DataFrame, erp_customers: DataFrame, erp_locations: DataFrame,
                  key_method: str = "ranged") -> DataFrame:
    """CRM customers + ERP attributes + location, numbered by customer id.

    Both lookups join on the untrimmed CRM key, so Spark shuffles the customers
    once and reuses that partitioning for the second join. Gender prefers the
    CRM value unless it is ``N/a``. Keys follow (customer id, last name),
    then the remaining columns, so that ties don't depend on the run.
    """
    j = lookup(customers, erp_customers, ("cst_key", "cid"), {"gen": "erp_gen", "bdate": "erp_bdate"})
    j = lookup(j, erp_locations, ("cst_key", "cid"), {"cntry": "erp_cntry"})
    rows = j.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("erp_cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        C.prefer("cst_gndr", C.CRM_UNKNOWN, "erp_gen", C.CRM_UNKNOWN).alias("gender"),
        F.col("erp_bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    order = ["customer_id", "last_name", *[c for c in rows.columns if c not in ("customer_id", "last_name")]]
    return surrogate_key(rows, order, "customer_key", method=key_method)


def dim_products(versions: DataFrame, categories: DataFrame, key_method: str = "ranged") -> DataFrame:
    """Current product versions + category attributes, numbered by (start, id).

    The current-version filter runs before the join and before numbering. An id
    or a category that occurs twice ties on (start, id); then the remaining
    columns decide, so that keys don't depend on the run.
    """
    current = current_only(versions, "prd_end_days")
    j = lookup(current, categories, ("cat_id", "id"),
               {"cat": "category", "subcat": "sub_category", "maintenance": "maintenance"})
    rows = j.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        "category", "sub_category", "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    order = ["start_date", "product_id", *[c for c in rows.columns if c not in ("start_date", "product_id")]]
    return surrogate_key(rows, order, "product_key", method=key_method)


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales lines with product and customer surrogate keys.

    Product match is on trimmed keys, customer match on the id. A dimension
    key held by several rows multiplies the sales line, as in the source.

    The customer lookup (a shuffle join once the dimension is large) runs
    first, on the un-multiplied sales lines; the product lookup, where the
    fan-out happens, runs last. Both are left joins on independent keys, so the
    order does not change the result.
    """
    j = lookup(sales, customers, ("sls_cust_id", "customer_id"), {"customer_key": "customer_key"})
    j = lookup(j, products, ("sls_prd_key", "product_number"), {"product_key": "product_key"},
               normalize=C.trim_spaces)
    return j.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key", "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("ship_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        "fixed_price",
    )
