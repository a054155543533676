"""Mixing, conversation repair and hard negatives against brute force, and on the defined edge cases."""

import os
import random
import sys
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tierforge.llm import hard_negatives, mixing, queries, repair  # noqa: E402

SCHEMA = "doc_id bigint, text string, source string, size string, target int, __p string"


def _mix_holds(rows, found):
    """``found`` against the brute-force targets; a source's words are its target, rounded."""
    size, src, target = brute.op11(rows)
    assert sorted((r["doc_id"], r["size"]) for r in found) == sorted((i, n) for (i, _, _), n in zip(rows, size))
    source = {i: s for i, s, _ in rows}
    taken = defaultdict(int)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == src[s] and r["target"] == pytest.approx(float(target[s]), rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["n_whole"] * r["size"] + r["n_part"]
        taken[s] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= Fraction(1, 2)


def test_mixing_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    found = queries.op11_mixing(spark, sf_dir).collect()
    _mix_holds(rows, found)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))         # whatever the partitions are


def test_mixing_edge_cases(spark):
    rng = random.Random(5)
    texts = [None, "", " \t", "a", "a b\nc", "w " * 5000, "é " * 40]
    rows = [(i, rng.choice([None, "", "a", "b", "é", "z" * 50]), rng.choice(texts)) for i in range(300)]
    rows += [(400 + i, "hot", "one two three four") for i in range(600)]
    df = spark.createDataFrame([(i, t, s, "x", 1, "y") for i, s, t in rows], SCHEMA).repartition(5)
    _mix_holds(rows, mixing.mix(df).collect())
    # repeated rows, null ids
    same = spark.createDataFrame([(None, "a b", "s", "x", 1, "y"), (7, "a b c", "s", "x", 1, "y")] * 5, SCHEMA)
    found = mixing.mix(same).collect()
    assert len(found) == 10 and sum(r["taken"] for r in found) == 38       # 1.5 * 25, rounded
    assert mixing.mix(df.limit(0)).collect() == []


def test_mixing_weights_table_and_texts(spark):
    docs = spark.createDataFrame([(i, f"t{i} u v w", "abc"[i % 3]) for i in range(90)], "doc_id int, text string, source string")
    weights = spark.createDataFrame([("a", 5), ("b", 1)], "source string, weight bigint")
    plan = mixing.mix(docs, weights=weights, share=(1, 1), max_epochs=2, carry=["source"])
    by_source = {r["source"]: r["n"] for r in plan.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert by_source == {"a": 240, "b": 120, "c": 0}                        # a is clamped, b takes the excess
    texts = mixing.mixed_texts(docs, weights=weights, share=(1, 2), max_epochs=2)
    found = texts.collect()
    assert sum(len(r["text"].split()) for r in found) == 180
    assert all(r["text"] in (f"t{r['doc_id']} u v w", f"t{r['doc_id']} u v", f"t{r['doc_id']} u", f"t{r['doc_id']}") for r in found)


# --- conversations ----------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, audit string, h1 int"


def _verdicts(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_repair_of_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _verdicts(queries.op12_repair(spark, sf_dir)) == brute.op12(rows)


def test_repair_edge_cases(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "Yes.", "no", "Yes. \t", "a!\x0b", "." * 3, "é?", "x" * 200_000 + "."]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice([None, "", "user", "assistant", "system", "tool", "User"]), rng.choice(texts))
            for c in [None, *range(60)] for _ in range(rng.randrange(1, 12))]
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())      # one row for each turn
    rows += rows[::7]                                                          # and repeated rows
    rows += [(1000, i, "user" if i % 2 == 0 else "assistant", f"line {i}" + ".?,"[i % 3]) for i in range(700)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(6)
    assert _verdicts(repair.repair(repair.damaged(df), present="present")) == brute.op12(rows)
    assert repair.repair(df.limit(0)).collect() == []


def test_repaired_turns_are_valid(spark, sf_dir):
    turns = repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    fixed = repair.repaired_turns(turns, present="present").collect()
    convs = defaultdict(dict)
    for r in fixed:
        convs[r["conv_id"]][r["place"]] = r
    for places in convs.values():
        initials = "".join(places[i]["role"][0] for i in range(len(places)))
        assert initials.lstrip("s") == "ua" * (len(initials) // 2)
    fixed = spark.createDataFrame([(r["conv_id"], r["place"], r["role"], r["text"]) for r in fixed if r["edit"] != "I"],
                                  "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair(fixed).agg(F.sum("duplicate"), F.sum("blank")).first()[:] == (0, 0)


def _all_splits(rows):
    """CYK over every span and every split."""
    cells = {(i, i + 1): repair.terminal(*r) for i, r in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            cell = {}
            for k in range(i + 1, i + length):
                cell = repair.least(cell, repair.combine(cells[i, k], cells[k, i + length]))
            cells[i, i + length] = cell
    top = cells[0, len(rows)] if rows else repair.EMPTY
    return min(top[repair.START, q] for q in repair.ENDS if (repair.START, q) in top)


ROW = st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.integers(0, 3))


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, max_size=9))
def test_one_split_equals_all_splits(rows):
    faults = ["", "truncated", "duplicate", "blank"]
    assert repair.parse(rows) == _all_splits(rows) == brute.op12_best([(i, faults[f]) for i, f in rows])


# --- hard negatives ----------------------------------------------------------

def _mined(df):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def _vectors(df):
    return [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]


def test_hard_negatives_of_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = brute.op13(_vectors(df))
    assert _mined(queries.op13_hard_negatives(spark, sf_dir)) == expected
    # many small trees and blocks of one or two anchors give the same rows
    assert _mined(hard_negatives.mine(df, shard_rows=40, block_bytes=1000)) == expected


def test_hard_negatives_edge_cases(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(8, 6))
    rows = [(i, int(rng.integers(0, 4)), (base[i % 8] + 0.05 * rng.normal(size=6)).tolist()) for i in range(420)]
    rows += [(1000 + i, 1, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]            # ties
    rows += [(100, 2, rows[3][2]), rows[5], rows[5], (None, 1, rows[100][2]), (1100, None, [1.0] * 6), (1200, 3, None),
             (1300, 3, [1.0, None, 0, 0, 0, 0]), (1400, 3, [float("nan")] * 6), (1500, 3, [float("inf")] * 6),
             (1600, 3, [1.0, 2.0]), (1700, 2, []), (1800, -5, [1e6] * 6), (1900, -5, [-1e6] * 6)]
    schema = "vec_id bigint, label int, embedding array<double>, z string, shard int"
    df = spark.createDataFrame([(i, l, v and [x if x is None else float(x) for x in v] if v is not None else None, "x", 1) for i, l, v in rows], schema)
    expected = brute.op13(_vectors(df))
    assert len({r[0] for r in expected}) >= 4
    assert _mined(hard_negatives.mine(df.repartition(3))) == expected
    assert _mined(hard_negatives.mine(df.repartition(5), shard_rows=50)) == expected
    assert hard_negatives.mine(df.limit(0)).collect() == []


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_tree_covers_and_walks_exactly(spread):
    """Small leaves: every point in one leaf and inside the radius of all nodes above; walks find all rows above a bar."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 10))
    points = np.floor(256 * (centres[rng.integers(0, 12, 1500)] + spread * rng.normal(size=(1500, 10)))).astype(np.int64)
    ids = np.arange(1500)
    tree = hard_negatives.Tree.load(hard_negatives.build_tree(ids, ids % 3, points, leaf=40, pool=8).blob())
    assert sorted(tree.ids.tolist()) == ids.tolist() and (tree.points == points[tree.ids]).all()
    anchors = points[:5]
    walk = hard_negatives.Walk(tree, anchors)
    norms = np.einsum("ij,ij->i", tree.points, tree.points).astype(float)
    x = np.column_stack([tree.points, np.sqrt(norms.max() - norms)])
    seen = 0
    for node, (start, stop) in enumerate(zip(tree.starts, tree.stops)):
        above = node
        while above >= 0:
            away = np.linalg.norm(x[start:stop] - x[tree.centres[above]], axis=1)
            assert stop == start or away.max() <= tree.radii[above] * (1 + 1e-9) + 1e-6
            above = tree.parents[above]
        seen += stop - start
    assert seen == len(points)
    for a in range(5):
        exact = points @ anchors[a]
        bar = np.sort(exact)[-20]
        visited = list(walk.leaves(a, lambda low, high: high >= bar))
        found = np.concatenate([tree.ids[s:e][scores >= bar] for s, e, scores in visited])
        assert sorted(found.tolist()) == sorted(np.flatnonzero(exact >= bar).tolist())
        if spread < 0.1:
            assert sum(e - s for s, e, _ in visited) < len(points) // 2        # most of the tree is never opened
