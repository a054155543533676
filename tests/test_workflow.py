"""Task runner: success path, failure handling, audit trail, reruns, schemas."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from tierforge.plans import fixtures as X
from tierforge.plans import tables as T
from tierforge.plans.oracles import AS_OF
from tierforge.plans.workflow import (
    FAILED, SKIPPED, SUCCESS, AuditRecord, Task, Workflow, warehouse_tasks, write_audit, write_feeds)
from tierforge.session import scratch_path
from tierforge.sources.io import Layout, read_feed, read_table
from tierforge.sources.schemas import FEEDS


@pytest.fixture(scope="module")
def feeds_layout(spark, sf_dir):
    layout = Layout(scratch_path(spark, "wf-test"))
    write_feeds(X.feeds(spark, sf_dir), layout)
    return layout


def _fresh(spark, feeds_layout):
    """A new warehouse root whose bronze feeds are the shared test feeds."""
    root = Layout(scratch_path(spark, "wf-run"))

    class Shared(Layout):
        def feed(self, name):
            return feeds_layout.feed(name)

    return Shared(root.root)


def _audit(spark, layout):
    return read_table(spark, layout.audit(), "parquet")


def test_full_run(spark, sf_dir, feeds_layout):
    layout = _fresh(spark, feeds_layout)
    records = Workflow(warehouse_tasks(as_of=AS_OF), layout).run(spark)
    assert [r.status for r in records] == [SUCCESS] * 9
    audit = {r.task_name: r.rows_processed for r in _audit(spark, layout).collect()}
    assert len(audit) == 9
    for task in warehouse_tasks():
        assert read_table(spark, layout.table(task.output)).count() == audit[task.name]
    # the fact equals the in-memory build over the same feeds
    fact = read_table(spark, layout.table("fact_sales"))
    assert fact.count() == audit["gold.fact_sales"] > 0
    assert len(_audit(spark, layout).inputFiles()) == 1          # one audit append per run


def test_rerun_is_a_noop_and_audit_appends(spark, feeds_layout):
    layout = _fresh(spark, feeds_layout)
    first = Workflow(warehouse_tasks(as_of=AS_OF), layout).run(spark)
    second = Workflow(warehouse_tasks(as_of=AS_OF), layout).run(spark)
    assert [r.rows_processed for r in first] == [r.rows_processed for r in second]
    assert _audit(spark, layout).count() == 18
    # same content, not just the same counts
    fact = read_table(spark, layout.table("fact_sales"))
    again = _fresh(spark, feeds_layout)
    Workflow(warehouse_tasks(as_of=AS_OF), again).run(spark)
    other = read_table(spark, again.table("fact_sales"))
    assert fact.exceptAll(other).count() == 0 and other.exceptAll(fact).count() == 0


def test_inferred_schemas_give_the_same_tables(spark, feeds_layout):
    explicit, inferred = _fresh(spark, feeds_layout), _fresh(spark, feeds_layout)
    Workflow(warehouse_tasks(as_of=AS_OF), explicit).run(spark)
    records = Workflow(warehouse_tasks(as_of=AS_OF), inferred, explicit_schemas=False).run(spark)
    assert all(r.status == SUCCESS for r in records)
    for name in ("silver_sales", "silver_erp_locations", "dim_products"):
        a, b = read_table(spark, explicit.table(name)), read_table(spark, inferred.table(name))
        b = b.select(*[F.col(f.name).cast(f.dataType) for f in a.schema.fields])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_failure_skips_dependants(spark, feeds_layout):
    layout = _fresh(spark, feeds_layout)

    class MissingCategories(type(layout)):
        def feed(self, name):
            return layout.feed(name) + ("-missing" if name == "categories" else "")

    broken = MissingCategories(layout.root)
    records = {r.task_name: r for r in Workflow(warehouse_tasks(as_of=AS_OF), broken).run(spark)}
    assert records["silver.erp_px_cat_g1v2"].status == FAILED
    assert records["silver.erp_px_cat_g1v2"].error_message
    assert records["gold.dim_products"].status == SKIPPED
    assert records["gold.fact_sales"].status == SKIPPED
    assert records["gold.dim_customers"].status == SUCCESS
    statuses = {r.task_name: r.status for r in _audit(spark, broken).collect()}
    assert statuses["gold.fact_sales"] == SKIPPED


def test_continue_mode_runs_dependants(spark, feeds_layout):
    layout = _fresh(spark, feeds_layout)
    boom = Task("silver.erp_px_cat_g1v2", "silver", "silver_categories", ("feed:categories",),
                lambda raw: raw.select(F.col("no_such_column")))
    tasks = [t if t.output != "silver_categories" else boom for t in warehouse_tasks(as_of=AS_OF)]
    records = {r.task_name: r for r in Workflow(tasks, layout, on_failure="continue").run(spark)}
    assert records["silver.erp_px_cat_g1v2"].status == FAILED
    # dim_products ran (and failed reading a table that was never written)
    assert records["gold.dim_products"].status == FAILED


def test_build_must_return_a_dataframe(spark, feeds_layout):
    layout = _fresh(spark, feeds_layout)
    bad = Task("silver.erp_px_cat_g1v2", "silver", "silver_categories", ("feed:categories",), lambda raw: {"x": 1})
    (rec,) = Workflow([bad], layout).run(spark)
    assert rec.status == FAILED and "must build a DataFrame" in rec.error_message


def test_audit_defaults(spark):
    record = AuditRecord()
    assert (record.task_name, record.layer, record.status) == ("unknown", "unknown", "UNKNOWN")
    assert record.rows_processed == 0 and record.error_message is None
    assert record.start_time == record.end_time and record.duration_seconds == 0.0
    path = scratch_path(spark, "audit-defaults")
    write_audit(spark, [AuditRecord(task_name="t", rows_processed=None)], path)
    row = read_table(spark, path, "parquet").first()
    assert (row.task_name, row.status, row.rows_processed) == ("t", "UNKNOWN", 0) and row.executed_at is not None


def test_cycle_and_missing_inputs_rejected(spark, feeds_layout):
    t1 = Task("a", "x", "ta", ("tb",), lambda x: x)
    t2 = Task("b", "x", "tb", ("ta",), lambda x: x)
    with pytest.raises(ValueError):
        Workflow([t1], feeds_layout)
    with pytest.raises(ValueError):
        Workflow([t1, t2], Layout(scratch_path(spark, "cyc"))).run(spark)


def test_explicit_and_inferred_schemas_agree(spark, feeds_layout):
    for name, schema in FEEDS.items():
        explicit = read_feed(spark, feeds_layout.feed(name), schema)
        inferred = read_feed(spark, feeds_layout.feed(name))
        conformed = inferred.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        assert explicit.exceptAll(conformed).count() == 0 and conformed.exceptAll(explicit).count() == 0, name


def test_header_mismatch_fails(spark, feeds_layout):
    wrong = FEEDS["categories"]
    with pytest.raises(Exception):
        read_feed(spark, feeds_layout.feed("erp_locations"), wrong).collect()


def test_silver_map_tasks_keep_row_counts(spark, sf_dir):
    f = X.feeds(spark, sf_dir)
    assert T.silver_sales(f["sales"]).count() == f["sales"].count()
    assert T.silver_erp_customers(f["erp_customers"]).count() == f["erp_customers"].count()
    assert T.silver_erp_locations(f["erp_locations"]).count() == f["erp_locations"].count()
    assert T.silver_product_versions(f["products"]).count() == f["products"].count()


def test_fixture_feeds_match_sql(spark, sf_dir):
    """The DataFrame fixtures equal the FIXTURES.md SQL run in DuckDB."""
    from tierforge.plans import oracles as O

    con = duckdb.connect()
    for t in X.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    f = X.feeds(spark, sf_dir)
    for name, cte, view in [("customers", O.RAW_CUST, "raw_cust"), ("products", O.RAW_PRD, "raw_prd"),
                            ("sales", O.RAW_SALES, "raw_sales"), ("erp_customers", O.RAW_ERP_CUST, "raw_erp_cust"),
                            ("erp_locations", O.RAW_ERP_LOC, "raw_erp_loc"), ("categories", O.RAW_CAT, "raw_cat")]:
        expected = sorted(tuple(map(str, r)) for r in con.sql(f"with {cte} select * from {view}").fetchall())
        got = sorted(tuple(map(str, r)) for r in f[name].collect())
        assert got == expected, name


def test_command_line_runs_the_load(spark, sf_dir):
    from tierforge.__main__ import main

    root = scratch_path(spark, "cli")
    write_feeds(X.feeds(spark, sf_dir), Layout(root))
    assert main(["--root", root, "--profile", "local", "--as-of", AS_OF]) == 0
    assert read_table(spark, Layout(root).table("fact_sales")).count() > 0


def test_runner_error_still_writes_finished_audit_rows(spark, feeds_layout):
    layout = _fresh(spark, feeds_layout)

    class Broken(Workflow):
        def _run_task(self, spark, task, fmt, run_id):
            if task.name == "gold.fact_sales":
                raise RuntimeError("runner failure outside the task wrapper")
            return super()._run_task(spark, task, fmt, run_id)

    with pytest.raises(RuntimeError):
        Broken(warehouse_tasks(as_of=AS_OF), layout).run(spark)
    written = {r.task_name: r.status for r in _audit(spark, layout).collect()}
    assert len(written) == 8 and "gold.fact_sales" not in written
    assert set(written.values()) == {SUCCESS}


def test_the_sales_feed_joins_its_orders_by_shuffle_without_sorting_the_lines(spark, sf_dir):
    raw = X.feeds(spark, sf_dir)["sales"]
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [l_orderkey" in plan and "SortMergeJoin" not in plan
    part = spark.createDataFrame([(1, "a b c"), (2, None)], "p_partkey bigint, p_name string")
    lines = spark.createDataFrame([(7, 1, 1, 3.0, dt.datetime(2020, 5, 6)), (7, 2, 2, 4.0, None), (9, 1, 1, 1.0, None)],
                                  "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_shipdate timestamp")
    rows = X.raw_sales(lines, part, spark.createDataFrame([(7, 10)], "o_orderkey bigint, o_custkey bigint")).collect()
    assert {(r.sls_ord_num, r.sls_line, r.sls_prd_key, r.sls_cust_id) for r in rows} == {("SO7", 1, " a-b-c ", 7), ("SO7", 2, None, 7)}


def test_write_feeds_fails_with_the_feed_that_fails(spark):
    layout = Layout(scratch_path(spark, "feeds-fail"))
    good = spark.range(3)
    with pytest.raises(Exception, match="divide"):
        write_feeds({"customers": good.select((F.lit(1) / (F.col("id") * 0)).alias("x"), F.raise_error(F.lit("divide")).alias("y")),
                     "sales": good}, layout)
