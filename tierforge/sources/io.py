"""Sources and sinks (S1-S7): feeds, layered tables, audit log, storage config.

Paths are arguments; nothing here knows an account, container or secret.
Table format is configurable: ``parquet`` by default, ``delta`` when the
session has the Delta extension on its classpath.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierforge.sources import commits

# Layer folders and table names of the warehouse layout.
BRONZE, SILVER, GOLD, AUDIT_DIR = "bronze", "silver", "gold", "audit"
CRM, ERP = "source_crm", "source_erp"
FEED_FILES = {
    "customers": (CRM, "cust_info"),
    "products": (CRM, "prd_info"),
    "sales": (CRM, "sales_details"),
    "erp_customers": (ERP, "cust_az12"),
    "erp_locations": (ERP, "loc_a101"),
    "categories": (ERP, "px_cat_g1v2"),
}
SILVER_TABLES = {
    "silver_customers": (CRM, "crm_cust_info"),
    "silver_product_versions": (CRM, "crm_prd_info"),
    "silver_sales": (CRM, "crm_sales_details"),
    "silver_erp_customers": (ERP, "erp_cust_az12"),
    "silver_erp_locations": (ERP, "erp_loc_a101"),
    "silver_categories": (ERP, "erp_px_cat_g1v2"),
}
GOLD_TABLES = ("dim_customers", "dim_products", "fact_sales")
AUDIT_TABLE = "etl_audit"


@dataclass(frozen=True)
class Layout:
    """Layered path layout under one root (S7): layer / source system / table.

    ``feed_paths`` names other places of feeds: absolute paths or URLs as they
    are, anything else under the bronze folder.
    """

    root: str
    feed_paths: Mapping[str, str] = field(default_factory=dict, hash=False)

    def feed(self, name: str) -> str:
        if name in self.feed_paths:
            path = self.feed_paths[name]
            return path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path) else os.path.join(self.root, BRONZE, path)
        system, file = FEED_FILES[name]
        return os.path.join(self.root, BRONZE, system, file)

    def table(self, name: str) -> str:
        if name in SILVER_TABLES:
            system, table = SILVER_TABLES[name]
            return os.path.join(self.root, SILVER, system, table)
        if name in GOLD_TABLES:
            return os.path.join(self.root, GOLD, name)
        return os.path.join(self.root, "tables", name)      # tables of user-defined tasks

    def stream_table(self, name: str) -> str:
        """Incremental loads keep tables of their own: a file sink's log and batch overwrites don't mix."""
        return os.path.join(self.root, "stream", name)

    def quarantine(self) -> str:
        """Feed records with rejected values."""
        return os.path.join(self.root, AUDIT_DIR, "quarantine")

    def ledger(self, run_id: str) -> str:
        """What the tasks of one run have finished."""
        return os.path.join(self.root, AUDIT_DIR, "runs", run_id)

    def audit(self) -> str:
        return os.path.join(self.root, AUDIT_DIR, AUDIT_TABLE)


def table_format(spark: SparkSession) -> str:
    """``delta`` when the session is configured with the Delta extension, else ``parquet``."""
    ext = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "delta" in ext.lower() else "parquet"


Paths = str | list[str]


def file_schema(spark: SparkSession, path: Paths, declared: StructType) -> StructType:
    """The header's columns in file order: declared types by (case-insensitive) name, others as strings.

    Reads one header line. A declared column that the header lacks is an error.
    """
    header = spark.read.option("header", True).csv(path if isinstance(path, str) else path[:1]).columns
    types = {f.name.lower(): f for f in declared.fields}
    missing = sorted(set(types) - {h.lower() for h in header})
    if missing:
        raise ValueError(f"feed {path} lacks the columns {missing}; its header has {header}")
    return StructType([types.get(h.lower(), StructField(h, StringType(), True)) for h in header])


def read_feed(spark: SparkSession, path: Paths, schema: StructType | None = None) -> DataFrame:
    """Headed CSV (a path or a list of files). With ``schema``: no inference pass; columns are found by header
    name in any order and extra ones are dropped. Without: inferred types."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    found = reader.schema(file_schema(spark, path, schema)).option("enforceSchema", False).csv(path)
    return found.select(*schema.fieldNames())


def write_feed(df: DataFrame, path: str) -> None:
    """Write a headed CSV feed, keeping leading/trailing spaces of values."""
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read_table(spark: SparkSession, path: str, fmt: str | None = None, version: int | None = None) -> DataFrame:
    """A table by path. A table with versions is read at its newest one, or at ``version``."""
    if (fmt or table_format(spark)) == "parquet":
        found = commits.version(spark, path, version)
        if found is not None:
            return commits.read(spark, path, found)
    return spark.read.format(fmt or table_format(spark)).load(path)


def write_version(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite", label: str = "",
                  bucket_by: tuple[str, int] | None = None) -> tuple[int, commits.Version | None]:
    """S4 + A1: write ``df``; its row count, and for parquet the version it became (see ``commits``).

    The count is an ``Observation`` on the write, so the lineage runs once
    (not once for ``count()`` and again for the write). It is read only after
    the write succeeded, so a failed write never reports a partial count.
    """
    fmt = fmt or table_format(df.sparkSession)
    if fmt == "parquet" and mode in ("overwrite", "append"):
        made = (commits.overwrite(df, path, label=label, bucket_by=bucket_by) if mode == "overwrite"
                else commits.append(df, path, label))
        return made.added, made
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).save(path)
    return int(obs.get["rows"]), None


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> int:
    """``write_version`` without the version: the row count."""
    return write_version(df, path, fmt, mode)[0]


def append_rows(spark: SparkSession, rows: list[tuple], schema: StructType, path: str, label: str = "") -> None:
    """S3 + S5: a literal table of ``rows`` appended as one file, in one atomic step (see ``commits``)."""
    commits.append(spark.createDataFrame(rows, schema).coalesce(1), path, label)


def configure_storage(spark: SparkSession, settings: Mapping[str, str]) -> None:
    """Set storage-connector keys (account auth, endpoints) on the session.

    Callers pass the mapping (e.g. from their secret store); no account name,
    key or secret lives in this library.
    """
    for key, value in settings.items():
        spark.conf.set(key, value)
