"""Column-expression builders (native Spark expressions, no UDFs)."""

from tierforge.functions.clean import (  # noqa: F401
    category_id,
    code_key,
    decode,
    decode_crm_gender,
    decode_marital_status,
    decode_product_line,
    normalize_erp_gender,
    normalize_text,
    null_after,
    parse_yyyymmdd,
    prefer,
    product_number,
    reconcile_amount,
    remove_chars,
    repair_price,
    standardize_country,
    strip_chars,
    strip_prefix,
    trim_columns,
    trim_spaces,
)
