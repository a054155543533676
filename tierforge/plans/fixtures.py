"""The six dirty raw feeds, derived deterministically from the star schema.

Each feed grows with the scale factor of the given tables (FIXTURES.md). They
are test inputs: the builds never depend on how a feed was made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.functions.clean import NBSP

TABLES = ("orders", "part", "lineitem", "customer", "nation")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(value: Column, cases: dict, default) -> Column:
    """CASE value WHEN k THEN v ... ELSE default END with literal branches."""
    out = None
    for k, v in cases.items():
        out = F.when(value == k, F.lit(v)) if out is None else out.when(value == k, F.lit(v))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def _padded_key(c: Column, prefix: str | Column) -> Column:
    lead = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.concat(lead, F.lpad(c.cast("string"), 8, "0"))


def _ymd(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def _customer_columns() -> list[Column]:
    k = F.col("o_orderkey")
    return [
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("o_custkey") - 3).alias("cst_id"),
        _padded_key(F.col("o_custkey"), "AW").alias("cst_key"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("cst_firstname"),
        F.concat(F.lit(" L"), k.cast("string")).alias("cst_lastname"),
        _case(k % 5, {0: " s", 1: "M ", 2: None, 3: "S"}, "D").alias("cst_marital_status"),
        _case(k % 4, {0: "f ", 1: " M", 2: None}, "").alias("cst_gndr"),
        F.when(k % 89 == 0, F.lit(None).cast("date"))
         .otherwise(F.to_date(F.date_trunc("month", F.col("o_orderdate")))).alias("cst_create_date"),
    ]


def raw_customers(orders: DataFrame) -> DataFrame:
    return orders.select(*_customer_columns())


def _product_key(sep: str) -> Column:
    return F.concat(F.upper(F.substring("p_type", 1, 2)), F.lit(sep), F.upper(F.substring("p_name", 1, 2)))


def raw_products(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("prd_id"),
        F.concat(_product_key("-"), F.lit("-"), F.regexp_replace("p_name", " ", "-")).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("prd_cost"),
        _case(k % 6, {0: "m ", 1: "R", 2: " s", 3: "T", 4: None}, "Z").alias("prd_line"),
        F.date_add(F.lit("2005-01-01").cast("date"), ((k * 7) % 3001).cast("int")).alias("prd_start_dt"),
    )


def raw_sales(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    parts = part.select("p_partkey", F.concat(F.lit(" "), F.regexp_replace("p_name", " ", "-"), F.lit(" ")).alias("sls_prd_key"))
    # lineitem and orders both grow with the data: a shuffle join at every scale,
    # never a broadcast chosen from a small file's size; the lines are not sorted.
    joined = (li.join(parts, F.col("l_partkey") == F.col("p_partkey"))
                .join(orders.select("o_orderkey", "o_custkey").hint("shuffle_hash"),
                      F.col("l_orderkey") == F.col("o_orderkey")))
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    ymd = _ymd(F.col("l_shipdate"))
    qty = F.col("l_quantity").cast("int")
    return joined.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.col("l_linenumber").alias("sls_line"),
        "sls_prd_key",
        (F.col("o_custkey") - 3).alias("sls_cust_id"),
        _case(ok % 7, {0: 0, 1: 32154, 2: 20101345}, ymd).alias("sls_order_dt"),
        F.when(ok % 13 == 0, F.lit(None)).otherwise(ymd).alias("sls_ship_dt"),
        F.when(ok % 11 == 0, F.lit(-1)).otherwise(ymd).cast("int").alias("sls_due_dt"),
        _case((ok + F.col("l_linenumber")) % 6, {0: None, 1: -40, 2: 0, 3: 17}, qty * 5)
         .cast("int").alias("sls_sales"),
        _case((ok + pk) % 9, {0: 0, 1: None}, qty).cast("int").alias("sls_quantity"),
        _case(pk % 5, {0: None, 1: -5, 2: 0}, 5).cast("int").alias("sls_price"),
    )


def raw_sales_money(sales: DataFrame) -> DataFrame:
    """The sales feed with fractional amounts and prices."""
    return sales.withColumns({c: F.col(c).cast("double") * F.lit(1.15) for c in ("sls_sales", "sls_price")})


def raw_customers_dirty(orders: DataFrame) -> DataFrame:
    """The customers feed as strings; some ids and creation dates are not values of their types."""
    k = F.col("o_orderkey")
    text = orders.select("o_orderkey", *_customer_columns()).withColumns(
        {c: F.col(c).cast("string") for c in ("cst_id", "cst_create_date")})
    return text.withColumns({
        "cst_id": F.when(k % 31 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(F.col("cst_id")),
        "cst_create_date": F.when(k % 37 == 0, F.concat(F.lit("2020-13-"), k.cast("string"))).otherwise(F.col("cst_create_date")),
    }).drop("o_orderkey")


def raw_erp_customers(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    # Every 19th customer has an id that matches none, so the lookups have misses.
    lead = F.when(c % 19 == 0, F.lit("XW")).otherwise(F.lit("AW"))
    return customer.select(
        F.concat(F.when(c % 3 == 0, F.lit("NAS")).otherwise(F.lit("")), _padded_key(c, lead)).alias("CID"),
        F.when(c % 10 == 0, F.lit("2999-01-01").cast("date"))
         .when(c % 17 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), (c % 9000).cast("int"))).alias("BDATE"),
        _case(c % 8, {0: "F", 1: " female ", 2: "M" + NBSP, 3: "Male", 4: None, 5: NBSP, 6: ""}, "x").alias("gen"),
    )


def raw_erp_locations(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    # The location of every 23rd customer has an id that matches none.
    lead = F.when(c % 23 == 0, F.lit("XW-")).otherwise(F.lit("AW-"))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat(_padded_key(c, lead), F.lit(" ")).alias("CID"),
        _case(c % 9, {0: "us", 1: NBSP + "USA ", 2: "DE", 3: None, 4: "  ", 5: "de "},
              F.concat(F.lit(" "), F.col("n_name"), F.lit(NBSP))).alias("CNTRY"),
    )


def raw_categories(part: DataFrame) -> DataFrame:
    # One product type's category has an id that matches none, so the lookup misses.
    lead = F.when(F.col("p_type") == "SMALL", F.lit("X")).otherwise(F.lit(""))
    return part.select(
        F.concat(lead, _product_key("_")).alias("ID"),
        F.col("p_type").alias("CAT"),
        F.substring("p_name", 1, 2).alias("SUBCAT"),
        F.when(F.col("p_type") == "PROMO", F.lit("No")).otherwise(F.lit("Yes")).alias("MAINTENANCE"),
    ).distinct()


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six feeds over the tables in ``sf_dir``, keyed like ``schemas.FEEDS``."""
    t = {name: load(spark, sf_dir, name) for name in TABLES}
    return {
        "customers": raw_customers(t["orders"]),
        "products": raw_products(t["part"]),
        "sales": raw_sales(t["lineitem"], t["part"], t["orders"]),
        "erp_customers": raw_erp_customers(t["customer"]),
        "erp_locations": raw_erp_locations(t["customer"], t["nation"]),
        "categories": raw_categories(t["part"]),
    }
