"""Tables stored in buckets: the customer lookup of the fact joins without an exchange."""

import re

from pyspark.sql import functions as F

from tierforge.plans import tables as T
from tierforge.plans.oracles import AS_OF
from tierforge.plans import fixtures as X
from tierforge.plans.workflow import SUCCESS, Workflow, warehouse_tasks, write_feeds
from tierforge.session import scratch_path
from tierforge.sources import commits
from tierforge.sources.io import Layout, read_table
from test_skew import scale_conf


def _exchanges(df):
    """Hash exchanges of the first plan, by what they hash."""
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


def test_the_customer_lookup_needs_no_exchange(spark, sf_dir):
    plain, bucketed = Layout(scratch_path(spark, "plain-wh")), Layout(scratch_path(spark, "bucketed-wh"))
    for layout, buckets in ((plain, None), (bucketed, 4)):
        write_feeds(X.feeds(spark, sf_dir), layout)
        records = Workflow(warehouse_tasks(as_of=AS_OF, buckets=buckets), layout).run(spark)
        assert [r.status for r in records] == [SUCCESS] * 9
    fact = {}
    with scale_conf(spark):                     # dimensions too big to broadcast
        for name, layout in (("plain", plain), ("bucketed", bucketed)):
            inputs = [read_table(spark, layout.table(t)) for t in ("silver_sales", "dim_products", "dim_customers")]
            fact[name] = T.fact_sales(*inputs)
        # the right sides' keys are called __rk0, the trimmed product keys __lk0
        assert sorted(_exchanges(fact["plain"])) == ["__lk0", "__rk0", "__rk0", "sls_cust_id"]
        assert sorted(_exchanges(fact["bucketed"])) == ["__lk0", "__rk0"]
        assert fact["plain"].exceptAll(fact["bucketed"]).count() == 0 == fact["bucketed"].exceptAll(fact["plain"]).count()
    a, b = (read_table(spark, layout.table("fact_sales")) for layout in (plain, bucketed))
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_versions_of_a_bucketed_table(spark):
    path = scratch_path(spark, "buckets") + "/t"
    rows = spark.range(100).select((F.col("id") % 7).alias("a b"), F.col("id").alias("v"))
    first = commits.overwrite(rows, path, bucket_by=("a b", 3))
    assert (first.rows, first.layout) == (100, "a b:3")
    commits.overwrite(rows.where("v < 10"), path, bucket_by=("a b", 2))
    assert read_table(spark, path).count() == 10 and read_table(spark, path, version=1).count() == 100
    grouped = read_table(spark, path, version=1).groupBy("a b").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    # appended files are not part of the buckets: the table is read as plain files again
    commits.append(rows.where("v >= 90"), path)
    assert read_table(spark, path).count() == 20
    assert sorted(r.v for r in read_table(spark, path).collect()) == [*range(10), *range(90, 100)]
