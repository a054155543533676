"""Refresh by touched keys, registered keys, key audits."""

import datetime as d
import threading

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierforge.functions import clean as C
from tierforge.operators.lookup_audit import audited_lookup, matches, repeated_keys, unfolded
from tierforge.operators.registry import register, registered_key
from tierforge.operators.star import lookup
from tierforge.plans import tables as T
from tierforge.session import scratch_path
from tierforge.sources import commits
from tierforge.sources.io import read_table, write_table
from tierforge.sources.schemas import CUSTOMERS_FEED, PRODUCTS_FEED
from tierforge.streaming import touched

SETTINGS = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
days = st.one_of(st.none(), st.integers(0, 9).map(lambda n: d.date(2020, 1, 1) + d.timedelta(days=n)))
customers = st.lists(st.tuples(st.one_of(st.none(), st.integers(-1, 8)), days), max_size=25)
products = st.lists(st.tuples(st.sampled_from([None, "AB-CD-x", "AB-CE-x", "AB_CD-x", "AB-CD+x", "q"]), days), max_size=25)


def _multiset(df):
    return sorted(tuple("~" if v is None else str(v) for v in r) for r in df.collect())


def _customers(spark, rows, first):
    return spark.createDataFrame([(i, f"k{i}", " a", f"l{first + n}", "S", "m", s) for n, (i, s) in enumerate(rows)], CUSTOMERS_FEED)


def _products(spark, rows, first):
    return spark.createDataFrame([(first + n, k, f"n{n}", 1.0, "m", s) for n, (k, s) in enumerate(rows)], PRODUCTS_FEED)


def _random_increments(spark, table, make, build, parts):
    root, whole, first = scratch_path(spark, "touched-test"), None, 0
    for rows in parts:
        increment = make(spark, rows, first)
        first += len(rows)
        touched.refresh(spark, root, table, increment, buckets=3)
        whole = increment if whole is None else whole.unionByName(increment)
        assert _multiset(touched.current(spark, root)) == _multiset(build(whole))


@SETTINGS
@given(st.lists(customers, min_size=2, max_size=2))
def test_customers_equal_the_full_refresh(spark, parts):
    _random_increments(spark, "silver_customers", _customers, T.silver_customers, parts)


@SETTINGS
@given(st.lists(products, min_size=2, max_size=2))
def test_product_versions_equal_the_full_refresh(spark, parts):
    _random_increments(spark, "silver_product_versions", _products, T.silver_product_versions, parts)


def test_untouched_buckets_are_not_rewritten(spark):
    root = scratch_path(spark, "untouched")
    day = d.date(2020, 1, 1)
    first = touched.refresh(spark, root, "silver_customers", _customers(spark, [(i, day) for i in range(1, 60)], 0), buckets=16)
    second = touched.refresh(spark, root, "silver_customers", _customers(spark, [(7, d.date(2020, 3, 1))], 100), buckets=16)
    assert len(set(first.parts) - set(second.parts)) == 1 and len(first.parts) == len(second.parts) > 8
    row = touched.current(spark, root).where("cst_id = 7").collect()
    assert [(r.cst_lastname, r.cst_create_date) for r in row] == [("l100", d.date(2020, 3, 1))]


def test_a_run_lost_between_its_steps_is_made_up_for(spark, monkeypatch):
    root = scratch_path(spark, "lost")
    day = d.date(2020, 1, 1)
    touched.refresh(spark, root, "silver_customers", _customers(spark, [(1, day), (2, day)], 0), buckets=4)
    plain = commits.replace_buckets

    def lost(df, path, *args, **kw):
        if path.endswith("/table"):
            raise RuntimeError("lost")
        return plain(df, path, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(commits, "replace_buckets", lost)
        try:
            touched.refresh(spark, root, "silver_customers", _customers(spark, [(2, d.date(2020, 2, 2)), (3, day)], 10), buckets=4)
            raise AssertionError("should be lost")
        except RuntimeError:
            pass
    assert touched.current(spark, root).count() == 2
    touched.refresh(spark, root, "silver_customers", _customers(spark, [(9, day)], 20), buckets=4)
    found = {r.cst_id: r.cst_lastname for r in touched.current(spark, root).collect()}
    assert found == {1: "l0", 2: "l10", 3: "l11", 9: "l20"}


# --- registered keys ---------------------------------------------------------------

@SETTINGS
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.sampled_from("abc"))), max_size=15),
                min_size=1, max_size=3))
def test_known_members_keep_their_keys_and_new_ones_are_dense(spark, loads):
    path, known = scratch_path(spark, "registry-test"), {}
    for rows in loads:
        df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "a int, b string, i int")
        found = registered_key(df, ["a", "b"], "k", path).collect()
        assert sorted(r.i for r in found) == list(range(len(rows)))
        fresh = sorted({(r.a, r.b) for r in found} - set(known), key=lambda m: [(v is not None, v or "") if i else (v is not None, v or 0) for i, v in enumerate(m)])
        known.update({m: len(known) + n + 1 for n, m in enumerate(fresh)})
        assert all(r.k == known[r.a, r.b] for r in found)


def test_two_runs_at_a_time_give_no_number_twice(spark):
    path = scratch_path(spark, "registry-race")
    parts = [spark.range(i * 20, i * 20 + 40).toDF("m") for i in range(3)]
    threads = [threading.Thread(target=register, args=(p, ["m"], "k", path)) for p in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = read_table(spark, path).collect()
    assert sorted(r.m for r in rows) == list(range(80)) and sorted(r.k for r in rows) == list(range(1, 81))


# --- key audits -----------------------------------------------------------------------

def test_audit_counts_and_the_joined_rows(spark):
    left = spark.createDataFrame([(i, k) for i, k in enumerate([" a", "a ", "b", "c", None, "zz", "", "c"])], "i int, k string")
    right = spark.createDataFrame([("a", 1), ("a ", 2), ("b", 3), (None, 4), (None, 5), ("c", 6), ("c", 7), ("c", 8), ("q", 9)], "r string, v int")
    joined, audit = audited_lookup(left, right, ("k", "r"), {"v": "v"}, "test", C.trim_spaces)
    path = scratch_path(spark, "audited") + "/t"
    write_table(joined, path)
    assert _multiset(read_table(spark, path)) == _multiset(lookup(left, right, ("k", "r"), {"v": "v"}, normalize=C.trim_spaces))
    assert audit.counts() == {"left_rows": 8, "matched": 5, "missed": 3, "null_keys": 1, "fan_out": 6}


def test_folded_lookups_count_the_same_and_unfold(spark):
    left = spark.createDataFrame([(i, k) for i, k in enumerate([" a", "a ", "b", "c", None, "zz", "", "c"])], "i int, k string")
    right = spark.createDataFrame([("a", 1), ("a ", 2), ("b", 3), (None, 4), (None, 5), ("c", 6), ("c", 7), ("c", 8), ("q", 9)], "r string, v int")
    args = ("k", "r"), {"v": "v"}
    folded, audit = audited_lookup(left, right, *args, "test", C.trim_spaces, multiply=False)
    path = scratch_path(spark, "folded") + "/t"
    write_table(folded, path)
    rows = read_table(spark, path)
    assert {(r.i, r.n_matches) for r in rows.collect()} == {(0, 2), (1, 2), (2, 1), (3, 3), (4, None), (5, None), (6, None), (7, 3)}
    assert audit.counts() == {"left_rows": 8, "matched": 5, "missed": 3, "null_keys": 1, "fan_out": 6}
    whole = unfolded(rows, matches(right, *args, C.trim_spaces), *args, C.trim_spaces)
    assert _multiset(whole) == _multiset(lookup(left, right, *args, normalize=C.trim_spaces))
    nothing, empty = audited_lookup(left.limit(0), right, *args, multiply=False)
    nothing.collect()
    assert set(empty.counts().values()) == {0}


def test_the_audited_lookups_write_no_multiplied_rows(spark, sf_dir, monkeypatch):
    from tierforge.plans import catalog

    written = {}

    def counted(df, path, *args):
        n = write_table(df, path, *args)
        written[path.rpartition("/")[2].rpartition("-")[0]] = n
        return n

    monkeypatch.setattr(catalog, "write_table", counted)
    audits = {r.lookup: r for r in catalog.lookup_audit(spark, sf_dir).collect()}
    assert audits["J4"].fan_out > 0
    for name in ("J1", "J2", "J3", "J4", "J5"):
        assert written[f"audited-{name}"] == audits[name].left_rows
    assert written["matches-J4"] == written["audited-products"]


def test_audit_reads_the_left_side_once(spark):
    path = scratch_path(spark, "audit-left") + "/t"
    write_table(spark.range(50).select(F.col("id").alias("k")), path)
    joined, _ = audited_lookup(read_table(spark, path), spark.range(20).select(F.col("id").alias("r")), ("k", "r"), {"r": "v"})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_repeated_keys_whatever_the_sketch(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1400).alias("k"))
    expected = {r.k: r.n for r in df.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).where("n > 1").collect()}
    for cells in (1, 64, 1 << 20):
        assert {r["__q0"]: r.n for r in repeated_keys(df, ["k"], cells=cells).collect()} == expected
    assert repeated_keys(df.limit(0), ["k"]).count() == 0
