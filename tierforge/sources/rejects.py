"""Rejected feed values (S1): counted in the pass that loads the feed, kept in a quarantine table.

Spark's CSV reader turns a value that its column's type does not take into
null and puts the record's line into a corrupt-record column. Only those lines
are parsed a second time, as strings; a column rejects a value where the typed
one is null and the string is not. A flagged record without such a column has
the wrong number of fields.

The counts are an Observation on the feed, so they come with whatever write
runs the feed's plan. The quarantine table needs another scan and is written
only for feeds that had rejects.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierforge.sources.io import Paths, file_schema

RECORD = "__record"          # the corrupt-record column
FIELDS = "__fields"          # metric: records with the wrong number of fields
ROWS = "__rows"              # metric: flagged records


@dataclass
class CheckedFeed:
    """A feed's rows, and what its columns rejected once an action has run them."""

    rows: DataFrame              # the declared columns, rejected values null
    flagged: DataFrame           # record, rejected (column -> value) of records with rejects
    seen: Observation

    def counts(self, wait_seconds: float = 10.0) -> dict[str, int]:
        """Rejected values by column, columns without any left out; ``{}`` if no action ran the feed.

        To be called after the action; metrics may arrive a moment later.
        """
        return {c: n for c, n in self._metrics(wait_seconds).items() if c != ROWS and n}

    def rows_rejected(self, wait_seconds: float = 10.0) -> int:
        return self._metrics(wait_seconds).get(ROWS, 0)

    def _metrics(self, wait_seconds: float) -> dict[str, int]:
        until = time.monotonic() + wait_seconds
        while not self.seen._jo.future().isCompleted():
            if time.monotonic() > until:
                return {}
            time.sleep(0.05)
        return {c: int(n or 0) for c, n in self.seen.get.items()}


def read_checked(spark: SparkSession, path: Paths, schema: StructType) -> CheckedFeed:
    """S1 with rejects: like ``read_feed`` with a declared schema."""
    found = file_schema(spark, path, schema)
    typed = (spark.read.option("header", True).option("enforceSchema", False)
             .option("columnNameOfCorruptRecord", RECORD)
             .option("columnPruning", False)         # a record's number of fields shows only if all are parsed
             .schema(StructType([*found.fields, StructField(RECORD, StringType(), True)])).csv(path))
    strings = StructType([StructField(f"__s{i}", StringType(), True) for i in range(len(found))])
    at = {f.name.lower(): i for i, f in enumerate(found)}
    raw = F.when(F.col(RECORD).isNotNull(), F.from_csv(F.col(RECORD), F.lit(strings.simpleString()[7:-1].replace(":", " "))))

    def rejected(name: str) -> Column:
        value = raw.getField(f"__s{at[name.lower()]}")
        return F.col(RECORD).isNotNull() & F.col(name).isNull() & value.isNotNull() & (value != "")

    # the reader refuses plans that need nothing but the corrupt-record column
    flag = F.col(RECORD).isNotNull() & F.coalesce(F.length(F.col(schema.fieldNames()[0]).cast("string")) >= 0, F.lit(True))
    checked = [f.name for f in schema if not isinstance(f.dataType, StringType)]
    none = F.lit(True)
    for name in checked:
        none = none & ~rejected(name)
    seen = Observation(f"rejects_{uuid.uuid4().hex[:8]}")
    counted = typed.observe(
        seen, F.count_if(flag).alias(ROWS),
        *[F.count_if(rejected(name)).alias(name) for name in checked],
        F.count_if(flag & none).alias(FIELDS))
    pairs = F.array_compact(F.array(
        *[F.when(rejected(name), F.struct(F.lit(name).alias("key"), raw.getField(f"__s{at[name.lower()]}").alias("value")))
          for name in checked])) if checked else F.array()
    flagged = typed.where(flag).select(
        F.col(RECORD).alias("record"), F.map_from_entries(pairs).alias("rejected") if checked
        else F.create_map().cast("map<string,string>").alias("rejected"))
    return CheckedFeed(counted.select(*schema.fieldNames()), flagged, seen)
