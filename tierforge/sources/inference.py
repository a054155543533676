"""One-pass type inference of feeds and a drift report.

Every value of every column is classed once, over all files, and the classes
are counted; counts add up, so the result does not depend on the order or the
partitioning of the records. The type is the least one that takes all classes
found: int < long < decimal < double, date < timestamp, boolean, else string.
Classes follow the reader's own inference (an empty value has none); where
that inference depends on the order of the values (a bare year behind a date),
this one gives string.

The report compares with a declared schema: which values would not fit it, and
whether the column has become narrower, wider, another one, new or missing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierforge.sources.io import Paths

# Classes of single values, each tried in this order.
CLASSES = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean", "string")
_INTEGER = r"^[+-]?[0-9]+$"
_DOUBLE = r"^\s*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\s*$|^-?Inf$"
_NUMBERS = ("int", "bigint", "decimal", "double")
# A declared type takes these classes of values.
TAKES = {
    "int": ("int",), "bigint": ("int", "bigint"), "double": _NUMBERS, "date": ("date", "timestamp"),
    "timestamp": ("date", "timestamp"), "boolean": ("boolean",), "string": CLASSES,
}


def value_class(v: Column) -> Column:
    """The class of one value, null for null and the empty string."""
    digits = F.length(F.regexp_replace(v, r"^[+-]?0*", ""))
    integer = v.rlike(_INTEGER)
    return (F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
            .when(integer & v.try_cast("int").isNotNull(), "int")
            .when(integer & v.try_cast("bigint").isNotNull(), "bigint")
            .when(integer & (digits <= 38), "decimal")
            .when(v.rlike(_DOUBLE), "double")
            .when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & v.try_cast("date").isNotNull(), "date")
            .when(v.try_cast("timestamp").isNotNull(), "timestamp")
            .when(F.lower(v).isin("true", "false"), "boolean")
            .otherwise("string"))


def _only(*classes: str) -> Column:
    """No values but of these classes (over count columns named like them)."""
    return reduce(lambda a, b: a & b, [F.col(c) == 0 for c in CLASSES if c not in classes], F.lit(True))


def _least_type() -> Column:
    return (F.when(_only(), "string").when(_only("int"), "int").when(_only("int", "bigint"), "bigint")
            .when(_only("int", "bigint", "decimal"), F.format_string("decimal(%d,0)", F.greatest("digits", F.lit(1))))
            .when(_only(*_NUMBERS), "double").when(_only("date"), "date").when(_only("date", "timestamp"), "timestamp")
            .when(_only("boolean"), "boolean").otherwise("string"))


def column_report(strings: DataFrame, declared: StructType | None = None) -> DataFrame:
    """One row per column of ``strings`` (all string columns) and of ``declared``; one scan.

    position, column_name, declared, inferred, n_rows, n_null, n_unfit (values
    that the declared type does not take), drift. Names compare without case.
    """
    types = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in declared or []}
    columns = strings.columns
    # one value to a row, so that there is one classing expression however many columns there are
    values = strings.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("i", "v"))
    classed = values.select("i", value_class(F.col("v")).alias("c"), F.length(F.regexp_replace("v", r"^[+-]?0*", "")).alias("d"))
    counts = classed.groupBy("i").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("c") == k).alias(k) for k in CLASSES],
        F.max(F.when(F.col("c").isin("int", "bigint", "decimal"), F.col("d"))).alias("digits"))
    # one row per column so far; an empty feed has none
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("rows", *CLASSES, "digits")))).alias("m"),
                       F.coalesce(F.max("rows"), F.lit(0)).alias("rows"))
    # names and declared types of the columns, those that only the declaration has last
    known = [(i, *types.get(c.lower(), (c, None))) for i, c in enumerate(columns)]
    known += [(None, *types[c]) for c in sorted(set(types) - {c.lower() for c in columns})]
    named = F.array(*[F.struct(F.lit(i).cast("int").alias("position"), F.lit(name).alias("column_name"),
                               F.lit(kind).cast("string").alias("declared")) for i, name, kind in known])
    listed = found.select("rows", "m", F.inline(named)).select(
        "*", F.try_element_at("m", F.col("position")).alias("n"))
    counted = listed.select("position", "column_name", "declared", F.col("rows").alias("n_rows"), F.col("n.digits").alias("digits"),
                            *[F.coalesce(F.col(f"n.{k}"), F.lit(0)).alias(k) for k in CLASSES])
    values = reduce(lambda a, b: a + b, [F.col(k) for k in CLASSES])
    fits = F.lit(0).cast("bigint")
    for k in CLASSES:
        takers = [t for t, classes in TAKES.items() if k in classes]
        # a type that is not listed is not judged
        fits = fits + F.when(F.col("declared").isNull() | F.col("declared").isin(*takers) | ~F.col("declared").isin(*TAKES), F.col(k)).otherwise(0)
    judged = counted.select("*", (F.col("n_rows") - values).alias("n_null"), (values - fits).alias("n_unfit"), _least_type().alias("least"))
    drift = (F.when(F.col("position").isNull(), "missing").when(F.col("declared").isNull(), "new")
             .when(F.col("n_unfit") > 0, "differs").when((F.col("declared") == "date") & (F.col("timestamp") > 0), "wider")
             .when(F.col("n_rows") == F.col("n_null"), "empty").when(F.col("least") == F.col("declared"), "same").otherwise("narrower"))
    return judged.select("position", "column_name", "declared", F.when(F.col("position").isNotNull(), F.col("least")).alias("inferred"),
                         "n_rows", "n_null", "n_unfit", drift.alias("drift"))


def read_strings(spark: SparkSession, path: Paths) -> DataFrame:
    """A headed feed with every column a string; reads one header line beforehand."""
    header = spark.read.option("header", True).csv(path if isinstance(path, str) else path[:1]).columns
    schema = StructType([StructField(h, StringType(), True) for h in header])
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def feed_report(spark: SparkSession, path: Paths, declared: StructType | None = None) -> DataFrame:
    """``column_report`` of a feed."""
    return column_report(read_strings(spark, path), declared)


def infer_schema(spark: SparkSession, path: Paths) -> StructType:
    """The inferred schema of a feed, in file order: one scan of it, one row per column to the driver."""
    found = feed_report(spark, path).where("position is not null").orderBy("position").collect()
    return StructType.fromDDL(", ".join(f"`{r['column_name']}` {r['inferred']}" for r in found))
