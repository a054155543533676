"""Queries give the oracle's answers in a plain session: Spark defaults, another time zone."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = ["silver_customers", "silver_sales", "dim_customers", "fact_sales", "surrogate_key_ranged",
         "null_future_dates", "audit_append"]

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, ROOT); sys.path.insert(0, ROOT + "/tools")
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from oracle_check import compare, duck
    con = duck("/root/testdata/sf0.001")
    print(json.dumps({n: compare(spark, con, n, "/root/testdata/sf0.001")["status"] for n in NAMES}))
""").replace("ROOT", repr(ROOT)).replace("NAMES", repr(NAMES))


def test_queries_in_a_plain_session():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=900, cwd="/tmp")
    lines = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert lines, out.stderr[-2000:]
    statuses = json.loads(lines[-1])
    assert all(str(s).startswith("match") for s in statuses.values()), statuses
