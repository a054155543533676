"""Rejected values, one-pass inference, and how the task runner uses them."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierforge.plans import fixtures as X
from tierforge.plans.oracles import AS_OF
from tierforge.plans.workflow import FAILED, SKIPPED, SUCCESS, Task, Workflow, warehouse_tasks, write_feeds
from tierforge.session import scratch_path
from tierforge.sources import commits
from tierforge.sources.inference import feed_report, infer_schema
from tierforge.sources.io import Layout, read_feed, read_table, write_feed, write_table
from tierforge.sources.rejects import FIELDS, read_checked
from tierforge.sources.schemas import CUSTOMERS_FEED, CUSTOMERS_FEED_TIMED, FEEDS

HEAD = "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date"
LINES = [
    "12,AW1, Ann ,Lee,S,F,2020-01-05",
    "abc,AW2,Bo,Kim,M,M,2020-02-01",
    "13,AW3,Cy,Ray,M,M,not-a-date",
    "x,AW4,Di,\"Fo, y\",M,M,2020-13-01",
    ",AW5,,,,,",
    "14,AW6,Ed,Gu,M,M,2020-02-03,extra,fields",
    "15,AW7,Flo",
]


@pytest.fixture()
def customers(tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("\n".join([HEAD, *LINES]) + "\n")
    return str(path)


def test_rejects_are_counted_in_the_pass(spark, customers):
    found = read_checked(spark, customers, CUSTOMERS_FEED)
    plain = read_feed(spark, customers, CUSTOMERS_FEED)
    path = scratch_path(spark, "checked") + "/t"
    assert write_table(found.rows, path) == 7
    assert found.counts() == {"cst_id": 2, "cst_create_date": 2, FIELDS: 2}
    assert found.rows_rejected() == 5
    stored = read_table(spark, path)
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    flagged = {r.record.split(",")[1]: r.rejected for r in found.flagged.collect()}
    assert flagged == {"AW2": {"cst_id": "abc"}, "AW3": {"cst_create_date": "not-a-date"},
                       "AW4": {"cst_id": "x", "cst_create_date": "2020-13-01"}, "AW6": {}, "AW7": {}}


def test_a_feed_that_no_action_runs_has_no_counts(spark, customers):
    assert read_checked(spark, customers, CUSTOMERS_FEED).counts(wait_seconds=0.1) == {}


def test_clean_feeds_have_no_rejects(spark, sf_dir):
    layout = Layout(scratch_path(spark, "clean-feeds"))
    write_feeds(X.feeds(spark, sf_dir), layout)
    for name, schema in FEEDS.items():
        found = read_checked(spark, layout.feed(name), schema)
        plain = read_feed(spark, layout.feed(name), schema)
        assert found.rows.count() == plain.count() and found.counts() == {} and found.flagged.count() == 0, name


def _dirty_layout(spark, sf_dir, customers):
    layout = Layout(scratch_path(spark, "dirty"), {"customers": "file://" + customers})
    write_feeds({k: v for k, v in X.feeds(spark, sf_dir).items() if k != "customers"}, layout)
    return layout


def test_rejects_reach_the_audit_log_and_the_quarantine(spark, sf_dir, customers):
    layout = _dirty_layout(spark, sf_dir, customers)
    records = Workflow(warehouse_tasks(as_of=AS_OF), layout).run(spark, run_id="r1")
    assert [r.status for r in records] == [SUCCESS] * 9
    audit = {r.task_name: (r.rows_rejected, r.rejects) for r in read_table(spark, layout.audit()).collect()}
    assert audit["silver.crm_cust_info"][0] == 5
    assert json.loads(audit["silver.crm_cust_info"][1]) == {"customers.cst_id": 2, "customers.cst_create_date": 2,
                                                            f"customers.{FIELDS}": 2}
    assert all(v == (0, None) for k, v in audit.items() if k != "silver.crm_cust_info")
    kept = read_table(spark, layout.quarantine())
    assert {(r.feed, r.run_id) for r in kept.collect()} == {("customers", "r1")} and kept.count() == 5


def test_time_of_day_separates_two_records_of_one_day(spark, tmp_path):
    from tierforge.plans.tables import silver_customers

    path = tmp_path / "c.csv"
    path.write_text(HEAD + "\n5,A,early,x,S,F,2020-01-05 08:00:00\n5,A,late,x,S,F,2020-01-05 09:30:00\n6,B,day,x,S,F,2020-01-05\n")
    names = lambda schema: sorted(r.cst_firstname for r in silver_customers(read_feed(spark, str(path), schema)).collect())
    assert names(CUSTOMERS_FEED) == ["day", "early", "late"]            # the declared date ties them
    assert names(CUSTOMERS_FEED_TIMED) == ["day", "late"]
    report = {r.column_name: r for r in feed_report(spark, str(path), CUSTOMERS_FEED).collect()}
    assert (report["cst_create_date"].inferred, report["cst_create_date"].drift) == ("timestamp", "wider")


# --- inference ----------------------------------------------------------------

def _inferred(spark, path):
    return {f.name: f.dataType.simpleString() for f in infer_schema(spark, path)}


def _sparks(spark, path):
    found = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    return {f.name: f.dataType.simpleString() for f in found}


def test_inference_equals_the_readers_on_six_feeds(spark, sf_dir):
    layout = Layout(scratch_path(spark, "infer-feeds"))
    write_feeds(X.feeds(spark, sf_dir), layout)
    for name in FEEDS:
        assert _inferred(spark, layout.feed(name)) == _sparks(spark, layout.feed(name)), name


POOLS = [
    ["1", "-5", "+7", "2147483647", "0012"], ["2147483648", "-9223372036854775808"],
    ["9223372036854775808", "123456789012345678901234567890"], ["1.5", "-0.25", "1e5", ".5", "7.", "NaN", " 2.5"],
    ["2020-01-05", "1999-12-31"], ["2020-01-05 10:00:00", "2020-01-05T10:00:00.123"], ["true", "FALSE"],
    ["x", "2020-13-45", "2020-02-30", "12a", "--1", "1 2", "yes"],
]


def test_inference_equals_the_readers_on_random_columns(spark, tmp_path):
    rng = random.Random(11)
    columns = [rng.sample(POOLS, k=rng.choice([1, 1, 2, 3])) for _ in range(60)] + [[p] for p in POOLS] + [[]]
    # a number behind dates is the one case in which the reader depends on the order of the values
    dates = POOLS[4:6]
    columns = [c for c in columns if not (any(p in dates for p in c) and any(p in POOLS[:4] for p in c))]
    lines = [",".join(f"c{i}" for i in range(len(columns)))]
    for _ in range(40):
        lines.append(",".join(rng.choice(rng.choice(c)) if c and rng.random() < 0.8 else "" for c in columns))
    path = tmp_path / "random.csv"
    path.write_text("\n".join(lines) + "\n")
    expected, found = _sparks(spark, str(path)), _inferred(spark, str(path))
    assert found == expected


def test_drift_report(spark, tmp_path):
    path = tmp_path / "drift.csv"
    path.write_text("ID,amount,day,note,fresh\n1,10,2020-01-01,a,x\n99999999999,1.5,2020-01-02,,y\nz,,never,b,z\n")
    declared = StructType.fromDDL("id bigint, amount int, day date, note string, gone double")
    report = {r.column_name: (r.declared, r.inferred, r.n_rows, r.n_null, r.n_unfit, r.drift)
              for r in feed_report(spark, str(path), declared).collect()}
    assert report == {"id": ("bigint", "string", 3, 0, 1, "differs"), "amount": ("int", "double", 3, 1, 1, "differs"),
                      "day": ("date", "string", 3, 0, 1, "differs"), "note": ("string", "string", 3, 1, 0, "same"),
                      "fresh": (None, "string", 3, 0, 0, "new"), "gone": ("double", None, 3, 3, 0, "missing")}
    empty = tmp_path / "empty.csv"
    empty.write_text("id,amount\n")
    assert [(r.n_rows, r.drift) for r in feed_report(spark, str(empty), StructType.fromDDL("id bigint, amount int")).collect()] == \
        [(0, "empty")] * 2


def test_the_report_is_one_scan(spark, customers):
    plan = feed_report(spark, customers, CUSTOMERS_FEED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Join") == 0


# --- pinned runs and resumed runs -------------------------------------------------

def _small(spark, n):
    return spark.range(n).select(F.col("id").alias("n"))


def test_a_table_replaced_mid_run_does_not_change_the_run(spark):
    layout = Layout(scratch_path(spark, "pinned-run"))

    def intruder(first):
        commits.overwrite(_small(spark, 500), layout.table("first"))       # somebody else's write
        return first

    tasks = [Task("a", "x", "first", (), lambda: _small(spark, 10)), Task("b", "x", "second", ("first",), intruder),
             Task("c", "x", "third", ("first", "second"), lambda a, b: a.crossJoin(b.limit(1).select(F.lit(1).alias("one"))))]
    records = {r.task_name: r for r in Workflow(tasks, layout).run(spark)}
    assert records["c"].rows_processed == 10
    assert read_table(spark, layout.table("first")).count() == 500


def test_a_failed_upstream_leaves_the_version_of_the_start(spark):
    layout = Layout(scratch_path(spark, "stale-run"))
    commits.overwrite(_small(spark, 4), layout.table("first"))

    def boom():
        commits.overwrite(_small(spark, 500), layout.table("first"))
        raise ValueError("boom")

    tasks = [Task("a", "x", "first", (), boom), Task("b", "x", "second", ("first",), lambda a: a)]
    records = Workflow(tasks, layout, on_failure="continue").run(spark)
    assert [(r.status, r.rows_processed) for r in records] == [(FAILED, 0), (SUCCESS, 4)]


class Killed(BaseException):
    """Stands for the loss of the driver."""


def test_a_run_killed_in_gold_resumes(spark, sf_dir, monkeypatch):
    from tierforge.plans import workflow as W

    layout = Layout(scratch_path(spark, "resume"))
    write_feeds(X.feeds(spark, sf_dir), layout)
    ran = []

    def recorded(tasks, kill=None):
        def wrap(task):
            def build(*inputs):
                ran.append(task.name)
                if task.name == kill:
                    raise Killed()
                return task.build(*inputs)

            return Task(task.name, task.layer, task.output, task.inputs, build)

        return [wrap(t) for t in tasks]

    # the driver goes down in gold: no audit rows are written
    with monkeypatch.context() as lost:
        lost.setattr(W, "write_audit", lambda *a: None)
        with pytest.raises(Killed):
            Workflow(recorded(warehouse_tasks(as_of=AS_OF), "gold.dim_products"), layout, max_parallel=1).run(spark, "night")
    finished = [n for n in ran if n != "gold.dim_products"]
    versions = {t.output: commits.versions(spark, layout.table(t.output)) for t in warehouse_tasks()}
    ran.clear()
    # the resumed run fails once more, in an ordinary way
    bad = [t if t.name != "gold.dim_products" else Task(t.name, t.layer, t.output, t.inputs, lambda v, c: v.select("nope"))
           for t in warehouse_tasks(as_of=AS_OF)]
    second = {r.task_name: r.status for r in Workflow(recorded(bad), layout).run(spark, "night")}
    assert not set(finished) & set(ran)
    assert second["gold.dim_products"] == FAILED and second["gold.fact_sales"] == SKIPPED
    ran.clear()
    third = Workflow(recorded(warehouse_tasks(as_of=AS_OF)), layout).run(spark, "night")
    assert sorted(ran) == ["gold.dim_products", "gold.fact_sales"] and all(r.status == SUCCESS for r in third)
    for t in warehouse_tasks():
        if t.name in finished:
            assert commits.versions(spark, layout.table(t.output)) == versions[t.output]      # not written again
    audit = sorted((r.task_name, r.status) for r in read_table(spark, layout.audit()).collect())
    assert audit == sorted([(t.name, SUCCESS) for t in warehouse_tasks()] +
                           [("gold.dim_products", FAILED), ("gold.fact_sales", SKIPPED)])
    # nothing is left to do: no task runs, no audit row is added
    ran.clear()
    Workflow(recorded(warehouse_tasks(as_of=AS_OF)), layout).run(spark, "night")
    assert ran == [] and read_table(spark, layout.audit()).count() == 11
    # the same tables as a run without accidents
    clean = Layout(scratch_path(spark, "no-accident"), {k: layout.feed(k) for k in FEEDS})
    Workflow(warehouse_tasks(as_of=AS_OF), clean).run(spark)
    for name in ("fact_sales", "dim_products"):
        a, b = read_table(spark, layout.table(name)), read_table(spark, clean.table(name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
