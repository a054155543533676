"""DuckDB SQL oracles, one per registered query.

Each oracle is one statement over the pre-registered star-schema views: the
feed CTEs (FIXTURES.md, DuckDB dialect) followed by the operator written in
plain SQL. Engine differences handled here: DuckDB's one-argument ``trim``
also strips NBSP, so ``trim(x, ' ')``; ascending sorts name ``nulls first``;
``try_strptime`` stands in for ``try_to_date``; ``row_number`` cast to bigint.
"""

from __future__ import annotations

AS_OF = "2020-01-01"

RAW_CUST = """raw_cust as (select case when o_orderkey % 97 = 0 then null else o_custkey - 3 end as cst_id,
 concat('AW', lpad(cast(o_custkey as varchar), 8, '0')) as cst_key,
 concat('  ', o_orderpriority, ' ') as cst_firstname, concat(' L', cast(o_orderkey as varchar)) as cst_lastname,
 case o_orderkey % 5 when 0 then ' s' when 1 then 'M ' when 2 then null when 3 then 'S' else 'D' end as cst_marital_status,
 case o_orderkey % 4 when 0 then 'f ' when 1 then ' M' when 2 then null else '' end as cst_gndr,
 case when o_orderkey % 89 = 0 then null else cast(date_trunc('month', o_orderdate) as date) end as cst_create_date
 from orders)"""

RAW_PRD = """raw_prd as (select p_partkey as prd_id,
 concat(upper(substring(p_type,1,2)), '-', upper(substring(p_name,1,2)), '-', replace(p_name,' ','-')) as prd_key,
 p_name as prd_nm, case when p_partkey % 11 = 0 then null else p_retailprice end as prd_cost,
 case p_partkey % 6 when 0 then 'm ' when 1 then 'R' when 2 then ' s' when 3 then 'T' when 4 then null else 'Z' end as prd_line,
 (date '2005-01-01' + cast((p_partkey * 7) % 3001 as int)) as prd_start_dt
 from part)"""

RAW_SALES = """raw_sales as (select concat('SO', cast(l_orderkey as varchar)) as sls_ord_num, l_linenumber as sls_line,
 concat(' ', replace(p_name,' ','-'), ' ') as sls_prd_key, o_custkey - 3 as sls_cust_id,
 cast(case l_orderkey % 7 when 0 then 0 when 1 then 32154 when 2 then 20101345
  else year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) end as int) as sls_order_dt,
 cast(case l_orderkey % 13 when 0 then null else year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) end as int) as sls_ship_dt,
 cast(case when l_orderkey % 11 = 0 then -1 else year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) end as int) as sls_due_dt,
 cast(case (l_orderkey + l_linenumber) % 6 when 0 then null when 1 then -40 when 2 then 0 when 3 then 17
  else cast(l_quantity as int)*5 end as int) as sls_sales,
 cast(case (l_orderkey + l_partkey) % 9 when 0 then 0 when 1 then null else cast(l_quantity as int) end as int) as sls_quantity,
 cast(case l_partkey % 5 when 0 then null when 1 then -5 when 2 then 0 else 5 end as int) as sls_price
 from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)"""

RAW_ERP_CUST = """raw_erp_cust as (select concat(case when c_custkey % 3 = 0 then 'NAS' else '' end, case when c_custkey % 19 = 0 then 'XW' else 'AW' end,
  lpad(cast(c_custkey as varchar), 8, '0')) as CID,
 case when c_custkey % 10 = 0 then date '2999-01-01' when c_custkey % 17 = 0 then null
  else (date '1950-01-01' + cast(c_custkey % 9000 as int)) end as BDATE,
 case c_custkey % 8 when 0 then 'F' when 1 then ' female ' when 2 then concat('M', chr(160)) when 3 then 'Male'
  when 4 then null when 5 then chr(160) when 6 then '' else 'x' end as gen
 from customer)"""

RAW_ERP_LOC = """raw_erp_loc as (select concat(case when c_custkey % 23 = 0 then 'XW-' else 'AW-' end, lpad(cast(c_custkey as varchar), 8, '0'), ' ') as CID,
 case c_custkey % 9 when 0 then 'us' when 1 then concat(chr(160),'USA ') when 2 then 'DE' when 3 then null
  when 4 then '  ' when 5 then 'de ' else concat(' ', n_name, chr(160)) end as CNTRY
 from customer join nation on c_nationkey = n_nationkey)"""

RAW_CAT = """raw_cat as (select distinct concat(case when p_type = 'SMALL' then 'X' else '' end, upper(substring(p_type,1,2)), '_', upper(substring(p_name,1,2))) as ID,
 p_type as CAT, substring(p_name,1,2) as SUBCAT, case when p_type='PROMO' then 'No' else 'Yes' end as MAINTENANCE
 from part)"""


def _ymd(c: str) -> str:
    return (f"case when {c} > 0 and length(cast({c} as varchar)) = 8 "
            f"then cast(try_strptime(cast({c} as varchar), '%Y%m%d') as date) end")


FIXED_PRICE = ("case when sls_price is null or sls_price <= 0 then cast(sls_sales as double) / nullif(sls_quantity, 0) "
               "else cast(sls_price as double) end")


def _reconcile(price: str) -> str:
    exp = f"sls_quantity * abs({price})"
    return (f"cast(case when sls_sales is null or sls_sales <= 0 or sls_sales != {exp} then {exp} "
            f"else sls_sales end as double)")


MARITAL = ("case upper(trim(cst_marital_status, ' ')) when 'S' then 'Single' when 'M' then 'Married' "
           "else 'N/a' end")
CRM_GENDER = "case upper(trim(cst_gndr, ' ')) when 'M' then 'Male' when 'F' then 'Female' else 'N/a' end"
LINE = ("case upper(trim(prd_line, ' ')) when 'M' then 'Mountain' when 'R' then 'Road' when 'S' then 'Other Sales' "
        "when 'T' then 'Touring' else 'N/a' end")
ERP_GENDER = ("case upper(trim(replace(gen, chr(160), ''), ' ')) when 'F' then 'Female' when 'FEMALE' then 'Female' "
              "when 'M' then 'Male' when 'MALE' then 'Male' else 'n/a' end")
CLEAN_CNTRY = "trim(replace(CNTRY, chr(160), ''), ' ')"
COUNTRY = (f"case when {CLEAN_CNTRY} is null or {CLEAN_CNTRY} = '' then 'n/a' "
           f"when upper({CLEAN_CNTRY}) in ('US', 'USA') then 'United States' "
           f"when upper({CLEAN_CNTRY}) = 'DE' then 'Germany' else {CLEAN_CNTRY} end")
STRIP_NAS = "case when starts_with(CID, 'NAS') then substring(CID, 4) else CID end"

SILVER_CUST = f"""silver_cust as (select cst_id, cst_key, trim(cst_firstname, ' ') as cst_firstname,
 trim(cst_lastname, ' ') as cst_lastname, {MARITAL} as cst_marital_status, {CRM_GENDER} as cst_gndr, cst_create_date
 from raw_cust where cst_id > 0
 qualify dense_rank() over (partition by cst_id order by cst_create_date desc nulls last) = 1)"""

PRD_DATED = """prd_dated as (select *, cast(lead(prd_start_dt) over (partition by prd_key
 order by prd_start_dt asc nulls first, prd_id asc nulls first) - 1 as date) as prd_end_days from raw_prd)"""

SILVER_PRD = f"""silver_prd as (select prd_id, replace(substring(prd_key, 1, 5), '-', '_') as cat_id,
 substring(prd_key, 7, length(prd_key)) as prd_key, prd_nm, prd_cost, {LINE} as prd_line, prd_start_dt, prd_end_days
 from prd_dated)"""

SILVER_SALES = f"""silver_sales as (select sls_ord_num, sls_prd_key, sls_cust_id,
 {_ymd('sls_order_dt')} as sls_order_dt, {_ymd('sls_ship_dt')} as sls_ship_dt, {_ymd('sls_due_dt')} as sls_due_dt,
 {_reconcile('fixed_price')} as sls_sales, sls_quantity, fixed_price
 from (select *, {FIXED_PRICE} as fixed_price from raw_sales))"""

SILVER_ERP_CUST = f"""silver_erp_cust as (select {STRIP_NAS} as cid,
 case when BDATE > date '{AS_OF}' then null else BDATE end as bdate, {ERP_GENDER} as gen from raw_erp_cust)"""

SILVER_ERP_LOC = f"""silver_erp_loc as (select trim(replace(CID, '-', ''), ' ') as cid, {COUNTRY} as cntry
 from raw_erp_loc)"""

SILVER_CAT = """silver_cat as (select ID as id, CAT as cat, SUBCAT as subcat, MAINTENANCE as maintenance from raw_cat)"""

DIM_CUST = """dim_cust as (select cast(row_number() over (order by ci.cst_id asc nulls first,
  ci.cst_lastname asc nulls first) as bigint) as customer_key,
 ci.cst_id as customer_id, ci.cst_key as customer_number, ci.cst_firstname as first_name,
 ci.cst_lastname as last_name, cl.cntry as country, ci.cst_marital_status as marital_status,
 case when ci.cst_gndr != 'N/a' then ci.cst_gndr else coalesce(cb.gen, 'N/a') end as gender,
 cb.bdate as birthdate, ci.cst_create_date as create_date
 from silver_cust ci left join silver_erp_cust cb on ci.cst_key = cb.cid left join silver_erp_loc cl on ci.cst_key = cl.cid)"""

DIM_PRD = """dim_prd as (select cast(row_number() over (order by pm.prd_start_dt asc nulls first,
  pm.prd_id asc nulls first, pm.prd_key asc nulls first, pm.prd_nm asc nulls first, pm.cat_id asc nulls first,
  pc.cat asc nulls first, pc.subcat asc nulls first, pc.maintenance asc nulls first, pm.prd_cost asc nulls first,
  pm.prd_line asc nulls first) as bigint) as product_key,
 pm.prd_id as product_id, pm.prd_key as product_number, pm.prd_nm as product_name, pm.cat_id as category_id,
 pc.cat as category, pc.subcat as sub_category, pc.maintenance as maintenance, pm.prd_cost as cost,
 pm.prd_line as product_line, pm.prd_start_dt as start_date
 from silver_prd pm left join silver_cat pc on pm.cat_id = pc.id where pm.prd_end_days is null)"""

FACT = """fact as (select sd.sls_ord_num as order_number, pd.product_key, cd.customer_key,
 sd.sls_order_dt as order_date, sd.sls_ship_dt as ship_date, sd.sls_due_dt as due_date,
 sd.sls_sales as sales_amount, sd.sls_quantity as quantity, sd.fixed_price
 from silver_sales sd left join dim_prd pd on trim(sd.sls_prd_key, ' ') = trim(pd.product_number, ' ')
 left join dim_cust cd on sd.sls_cust_id = cd.customer_id)"""


def _with(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


CUST_CHAIN = (RAW_CUST, SILVER_CUST, RAW_ERP_CUST, SILVER_ERP_CUST, RAW_ERP_LOC, SILVER_ERP_LOC, DIM_CUST)
PRD_CHAIN = (RAW_PRD, PRD_DATED, SILVER_PRD, RAW_CAT, SILVER_CAT, DIM_PRD)
ALL_TABLES = CUST_CHAIN + PRD_CHAIN + (RAW_SALES, SILVER_SALES, FACT)

AUDIT_ROWS = """select * from (values
 ('silver.crm_cust_info', 'silver', 'SUCCESS', (select count(*) from silver_cust)),
 ('silver.crm_prd_info', 'silver', 'SUCCESS', (select count(*) from silver_prd)),
 ('silver.crm_sales_details', 'silver', 'SUCCESS', (select count(*) from silver_sales)),
 ('silver.erp_cust_az12', 'silver', 'SUCCESS', (select count(*) from silver_erp_cust)),
 ('silver.erp_loc_a101', 'silver', 'SUCCESS', (select count(*) from silver_erp_loc)),
 ('silver.erp_px_cat_g1v2', 'silver', 'SUCCESS', (select count(*) from silver_cat)),
 ('gold.dim_customers', 'gold', 'SUCCESS', (select count(*) from dim_cust)),
 ('gold.dim_products', 'gold', 'SUCCESS', (select count(*) from dim_prd)),
 ('gold.fact_sales', 'gold', 'SUCCESS', (select count(*) from fact))
) as t(task_name, layer, status, rows_processed)"""

FAILED_RUN_ROWS = """select * from (values
 ('silver.crm_cust_info', 'silver', 'SUCCESS', (select count(*) from silver_cust)),
 ('silver.crm_prd_info', 'silver', 'SUCCESS', (select count(*) from silver_prd)),
 ('silver.crm_sales_details', 'silver', 'SUCCESS', (select count(*) from silver_sales)),
 ('silver.erp_cust_az12', 'silver', 'SUCCESS', (select count(*) from silver_erp_cust)),
 ('silver.erp_loc_a101', 'silver', 'SUCCESS', (select count(*) from silver_erp_loc)),
 ('silver.erp_px_cat_g1v2', 'silver', 'FAILED', 0),
 ('gold.dim_customers', 'gold', 'SUCCESS', (select count(*) from dim_cust)),
 ('gold.dim_products', 'gold', 'SKIPPED', 0),
 ('gold.fact_sales', 'gold', 'SKIPPED', 0)
) as t(task_name, layer, status, rows_processed)"""


RESUMED_ROWS = f"""{FAILED_RUN_ROWS} union all select * from (values
 ('silver.erp_px_cat_g1v2', 'silver', 'SUCCESS', (select count(*) from silver_cat)),
 ('gold.dim_products', 'gold', 'SUCCESS', (select count(*) from dim_prd)),
 ('gold.fact_sales', 'gold', 'SUCCESS', (select count(*) from fact))
) as t(task_name, layer, status, rows_processed)"""

RAW_MONEY = """raw_money as (select * replace (cast(sls_sales as double) * cast(1.15 as double) as sls_sales,
 cast(sls_price as double) * cast(1.15 as double) as sls_price) from raw_sales)"""

# Feed -> (CTEs, relation, columns with declared and expected inferred types).
FEED_TYPES = {
    "customers": ((RAW_CUST,), "raw_cust", "cst_id bigint int, cst_key string string, cst_firstname string string, "
                  "cst_lastname string string, cst_marital_status string string, cst_gndr string string, "
                  "cst_create_date date date"),
    "products": ((RAW_PRD,), "raw_prd", "prd_id bigint int, prd_key string string, prd_nm string string, "
                 "prd_cost double double, prd_line string string, prd_start_dt date date"),
    "sales": ((RAW_SALES,), "raw_sales", "sls_ord_num string string, sls_prd_key string string, sls_cust_id bigint int, "
              "sls_order_dt int int, sls_ship_dt int int, sls_due_dt int int, sls_sales double int, "
              "sls_quantity int int, sls_price double int"),
    "erp_customers": ((RAW_ERP_CUST,), "raw_erp_cust", "CID string string, BDATE date date, gen string string"),
    "erp_locations": ((RAW_ERP_LOC,), "raw_erp_loc", "CID string string, CNTRY string string"),
    "categories": ((RAW_CAT,), "raw_cat", "ID string string, CAT string string, SUBCAT string string, MAINTENANCE string string"),
}


def _feed_types() -> str:
    ctes, selects = [], []
    for feed, (chain, relation, columns) in FEED_TYPES.items():
        ctes += chain
        for column in columns.split(", "):
            name, declared, inferred = column.split()
            drift = "same" if declared == inferred else "narrower"
            selects.append(f"select '{feed}' as feed, '{name}' as column_name, '{declared}' as declared, '{inferred}' as inferred, "
                           f"count(*) as n_rows, count(*) filter (coalesce(cast({name} as varchar), '') = '') as n_null, "
                           f"cast(0 as bigint) as n_unfit, '{drift}' as drift from {relation}")
    return _with(*ctes, body="\nunion all ".join(selects))


def _scans(q: dict[str, str]) -> None:
    for feed, (chain, relation, columns) in FEED_TYPES.items():
        kinds = {"bigint": "bigint", "int": "integer", "double": "double", "date": "date"}
        parts = []
        for column in columns.split(", "):
            name, declared, _ = column.split()
            parts.append(f"nullif({name}, '') as {name}" if declared == "string" else f"cast({name} as {kinds[declared]}) as {name}")
        if feed != "customers":
            q[f"scan_csv_{feed}"] = _with(*chain, body=f"select {', '.join(parts)} from {relation}")


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    _scans(q)
    q["feed_types"] = _feed_types()
    q["feed_rejects"] = ("select 'cst_id' as column_name, count(*) filter (o_orderkey % 31 = 0) as n_rejected from orders "
                         "union all select 'cst_create_date', count(*) filter (o_orderkey % 37 = 0) from orders "
                         "union all select 'any', count(*) filter (o_orderkey % 31 = 0 or o_orderkey % 37 = 0) from orders")
    q["feed_quarantine"] = ("select 'customers' as feed, 'first' as run_id, 'cst_id' as column_name, concat('x', o_orderkey) as value "
                            "from orders where o_orderkey % 31 = 0 union all select 'customers', 'first', 'cst_create_date', "
                            "concat('2020-13-', o_orderkey) from orders where o_orderkey % 37 = 0")
    q["table_history"] = _with(RAW_CAT, SILVER_CAT, body="select cast(1 as bigint) as version, * from silver_cat where cat = 'PROMO' "
                               "union all select 2, * from silver_cat union all select 3, * from silver_cat "
                               "union all select 3, * from silver_cat where cat = 'PROMO'")
    # every category twice, with other attributes the second time
    q["dim_products_repeated"] = _with(*[c if c != SILVER_CAT else SILVER_CAT.replace("from raw_cat)", "from raw_cat union all "
                                         "select ID, CAT, concat(SUBCAT, '2'), 'No' from raw_cat)") for c in PRD_CHAIN],
                                       body="select * from dim_prd")
    q["silver_customers_touched"] = _with(RAW_CUST, SILVER_CUST, body="select * from silver_cust")
    q["product_versions_touched"] = _with(RAW_PRD, PRD_DATED, SILVER_PRD, body="select * from silver_prd")
    q["registered_keys"] = _with(RAW_CUST, SILVER_CUST, body="""select cast(row_number() over (order by cst_id % 2,
 cst_id asc nulls first, cst_lastname asc nulls first) as bigint) as customer_key, cst_id, cst_lastname from silver_cust""")
    counts = ("(select '{0}' as lookup, count(*) as left_rows, count(*) filter (n > 0) as matched, count(*) filter (n = 0) as missed, "
              "count(*) filter (k is null) as null_keys, coalesce(sum(greatest(n, 1) - 1), 0)::bigint as fan_out from "
              "(select l.k, (select count(*) from ({2}) r where r.k = l.k) as n from ({1}) l))")
    q["lookup_audit"] = _with(*ALL_TABLES, body=" union all ".join("select * from " + counts.format(*c) for c in (
        ("J1", "select cst_key as k from silver_cust", "select cid as k from silver_erp_cust"),
        ("J2", "select cst_key as k from silver_cust", "select cid as k from silver_erp_loc"),
        ("J3", "select cat_id as k from silver_prd", "select id as k from silver_cat"),
        ("J4", "select trim(sls_prd_key, ' ') as k from silver_sales", "select trim(prd_key, ' ') as k from silver_prd"),
        ("J5", "select sls_cust_id as k from silver_sales", "select cst_id as k from silver_cust"))))
    q["pinned_run"] = _with(*CUST_CHAIN, body="select * from dim_cust")
    q["resumed_run"] = _with(*ALL_TABLES, body=RESUMED_ROWS)
    q["fact_sales_bucketed"] = _with(*ALL_TABLES, body="select * from fact")
    q["audit_compacted"] = _with(*ALL_TABLES, body=f"select a.* from ({AUDIT_ROWS}) a, range(2) where layer = 'silver'")
    q["silver_sales_money"] = _with(RAW_SALES, RAW_MONEY, SILVER_SALES.replace("from raw_sales", "from raw_money"),
                                    body="select * from silver_sales")
    q["scan_project"] = "select p_partkey, p_name, p_type from part"
    q["scan_csv_explicit"] = _with(RAW_CUST, body="select cst_id, cst_key, cst_firstname, cst_lastname, "
                                   "nullif(cst_marital_status, '') as cst_marital_status, "
                                   "nullif(cst_gndr, '') as cst_gndr, cst_create_date from raw_cust")
    q["scan_csv_infer"] = q["scan_csv_explicit"]
    q["overwrite_roundtrip"] = _with(RAW_CAT, SILVER_CAT, body="select * from silver_cat")
    q["filter_positive_id"] = _with(RAW_CUST, body="select * from raw_cust where cst_id > 0")
    q["keep_latest"] = _with(RAW_CUST, body="select * from raw_cust qualify dense_rank() over "
                             "(partition by cst_id order by cst_create_date desc nulls last) = 1")
    q["keep_latest_first"] = _with(RAW_CUST, body="select * from raw_cust qualify row_number() over "
                                   "(partition by cst_id order by cst_create_date desc nulls last, "
                                   "cst_lastname asc) = 1")
    q["trim_decode"] = _with(RAW_CUST, body=f"select cst_id, cst_key, trim(cst_firstname, ' ') as cst_firstname, "
                             f"trim(cst_lastname, ' ') as cst_lastname, {MARITAL} as cst_marital_status, "
                             f"{CRM_GENDER} as cst_gndr from raw_cust")
    q["split_key"] = _with(RAW_PRD, body="select prd_id, replace(substring(prd_key, 1, 5), '-', '_') as cat_id, "
                           "substring(prd_key, 7, length(prd_key)) as product_number from raw_prd")
    q["decode_line"] = _with(RAW_PRD, body=f"select prd_id, prd_line as raw_line, {LINE} as prd_line from raw_prd")
    q["end_date_versions"] = _with(RAW_PRD, PRD_DATED,
                                   body="select prd_id, prd_key, prd_start_dt, prd_end_days from prd_dated")
    q["end_date_versions_split"] = q["end_date_versions"]
    q["current_versions"] = _with(RAW_PRD, PRD_DATED, SILVER_PRD,
                                  body="select * from silver_prd where prd_end_days is null")
    q["parse_yyyymmdd"] = _with(RAW_SALES, body=f"select sls_ord_num, sls_line, {_ymd('sls_order_dt')} as order_date, "
                                f"{_ymd('sls_ship_dt')} as ship_date, {_ymd('sls_due_dt')} as due_date from raw_sales")
    q["repair_price"] = _with(RAW_SALES, body=f"select sls_ord_num, sls_line, {FIXED_PRICE} as fixed_price "
                              "from raw_sales")
    q["reconcile_amount"] = _with(RAW_SALES, body=f"select sls_ord_num, sls_line, {_reconcile('fixed_price')} "
                                  f"as sls_sales from (select *, {FIXED_PRICE} as fixed_price from raw_sales)")
    q["strip_prefix"] = _with(RAW_ERP_CUST, body=f"select CID as raw_cid, {STRIP_NAS} as cid from raw_erp_cust")
    q["null_future_dates"] = _with(RAW_ERP_CUST, body="select CID as raw_cid, case when BDATE > "
                                   f"date '{AS_OF}' then null else BDATE end as bdate from raw_erp_cust")
    q["normalize_gender"] = _with(RAW_ERP_CUST, body=f"select CID as raw_cid, {ERP_GENDER} as gen from raw_erp_cust")
    q["strip_chars"] = _with(RAW_ERP_LOC, body="select CID as raw_cid, trim(replace(CID, '-', ''), ' ') as cid "
                             "from raw_erp_loc")
    q["standardize_country"] = _with(RAW_ERP_LOC, body=f"select CID as raw_cid, {COUNTRY} as cntry from raw_erp_loc")
    q["left_lookup"] = _with(RAW_CUST, SILVER_CUST, RAW_ERP_CUST, SILVER_ERP_CUST,
                             body="select ci.cst_id, ci.cst_key, ci.cst_lastname, cb.gen as erp_gen, "
                             "cb.bdate as erp_bdate from silver_cust ci left join silver_erp_cust cb "
                             "on ci.cst_key = cb.cid")
    q["left_lookup_trimmed"] = _with(RAW_SALES, RAW_PRD, PRD_DATED, SILVER_PRD,
                                     body="select s.sls_ord_num, s.sls_line, p.prd_id from raw_sales s "
                                     "left join (select * from silver_prd where prd_end_days is null) p "
                                     "on trim(s.sls_prd_key, ' ') = trim(p.prd_key, ' ')")
    q["survivorship"] = _with(RAW_CUST, SILVER_CUST, RAW_ERP_CUST, SILVER_ERP_CUST,
                              body="select ci.cst_id, ci.cst_lastname, case when ci.cst_gndr != 'N/a' "
                              "then ci.cst_gndr else coalesce(cb.gen, 'N/a') end as gender "
                              "from silver_cust ci left join silver_erp_cust cb on ci.cst_key = cb.cid")
    key_body = ("select cast(row_number() over (order by cst_id asc nulls first, cst_lastname asc nulls first) "
                "as bigint) as customer_key, cst_id, cst_lastname from silver_cust")
    q["surrogate_key_global"] = _with(RAW_CUST, SILVER_CUST, body=key_body)
    q["surrogate_key_ranged"] = q["surrogate_key_global"]
    q["silver_customers"] = _with(RAW_CUST, SILVER_CUST, body="select * from silver_cust")
    q["silver_product_versions"] = _with(RAW_PRD, PRD_DATED, SILVER_PRD, body="select * from silver_prd")
    q["silver_sales"] = _with(RAW_SALES, SILVER_SALES, body="select * from silver_sales")
    q["silver_sales_incremental"] = q["silver_sales"]
    q["silver_erp_customers"] = _with(RAW_ERP_CUST, SILVER_ERP_CUST, body="select * from silver_erp_cust")
    q["silver_erp_locations"] = _with(RAW_ERP_LOC, SILVER_ERP_LOC, body="select * from silver_erp_loc")
    q["silver_erp_locations_incremental"] = q["silver_erp_locations"]
    q["silver_categories"] = _with(RAW_CAT, SILVER_CAT, body="select * from silver_cat")
    q["dim_customers"] = _with(*CUST_CHAIN, body="select * from dim_cust")
    q["dim_customers_ranged"] = q["dim_customers"]
    q["dim_customers_auto"] = q["dim_customers"]
    q["dim_products"] = _with(*PRD_CHAIN, body="select * from dim_prd")
    q["fact_sales"] = _with(*ALL_TABLES, body="select * from fact")
    q["row_count_observed"] = _with(RAW_SALES, SILVER_SALES, body="select 'silver_sales' as table_name, "
                                    "count(*) as rows_processed from silver_sales")
    q["audit_append"] = _with(*ALL_TABLES, body=AUDIT_ROWS)
    q["run_status"] = _with(*ALL_TABLES, body=FAILED_RUN_ROWS)
    return q
