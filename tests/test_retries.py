"""Task retries (the local stand-in for a lost executor) leave results whole and exact."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, ROOT)
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from tierforge.session import build_session, checkpoint_dir
    from tierforge.operators import surrogate_key, keep_latest

    spark = build_session("local[4,3]", app="retries", shuffle_partitions=8)   # up to 3 attempts per task
    checkpoint_dir(spark)

    @F.pandas_udf("long")
    def flaky(v: pd.Series) -> pd.Series:
        # test-only: the first attempt of every task in stage partition 0 dies mid-way
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            open(MARKER + "-" + str(ctx.stageId()), "w").close()
            raise RuntimeError("injected task failure")
        return v

    n = 50_000
    df = spark.range(0, n, numPartitions=4).select(flaky(F.col("id") % 997).alias("a"), F.col("id").alias("b"))
    keyed = surrogate_key(df, ["a", "b"], "k", rows_per_bucket=5_000)
    s = keyed.agg(F.count("*").alias("n"), F.countDistinct("k").alias("d"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    latest = keep_latest(df.withColumn("d", F.col("b") % 13), "a", "d").count()
    print(json.dumps({"n": s.n, "distinct": s.d, "lo": s.lo, "hi": s.hi, "latest": latest}))
""").replace("ROOT", repr(ROOT))


def _script(marker: str) -> str:
    return SCRIPT.replace("MARKER", repr(marker))


def test_results_survive_task_retries(tmp_path):
    marker = str(tmp_path / "failed")
    out = subprocess.run([sys.executable, "-c", _script(marker)], capture_output=True, text=True, timeout=600,
                         cwd=ROOT)
    last = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert last, out.stderr[-2000:]
    res = json.loads(last[-1])
    assert res["n"] == res["distinct"] == res["hi"] == 50_000 and res["lo"] == 1
    assert list(tmp_path.glob("failed-*")), "no task failure was injected"
    # expected latest rows: per a, ids with max(b % 13) -- computed without Spark
    best = {}
    for b in range(50_000):
        a, d = b % 997, b % 13
        if a not in best or d > best[a][0]:
            best[a] = (d, 1)
        elif d == best[a][0]:
            best[a] = (d, best[a][1] + 1)
    assert res["latest"] == sum(c for _, c in best.values())
