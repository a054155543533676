"""Finer pieces for the tokenizer, bounded caches, step groups, and the suffix filter beside the anchors."""

import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tierforge.llm import common, hashing, packing, suffix_shards, tokens  # noqa: E402

WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
HARD = ["", " ", "<|endoftext|> x", "a<|startoftext|>", "don't 'stop' it's 'S 'x ''s ,'s a'b'c d'd.d", "é á,b İx,y Σ Σας", "é,x",
        "a\x1cb\x85c d　e", "abc123 12,34.5 a1b2 ½x x² ª º µ", "_a_b __c_ snake_case", "«quote» – dash… €5 “x”",
        "日本語 text", "​zero", "tab\tnew\nline\r\n  end ", "ß ŉ ǆ ĸ Ÿ ǅ Ǆ ƻ ǀ", "x" * 30_000, "1" * 5000, "a b " * 3000]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
@pytest.mark.parametrize("limit", [200, 1 << 20])
def test_pieces_give_the_tokens_of_the_text(path, limit, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHES", {})
    rng = random.Random(1)
    alphabet = "ab1'._,-éÉß \t'’½²_xİ́"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(1500)]
    apart = tokens.letters(path) is not None
    assert apart == (path == WORD_BPE)
    whole = tokens.tokenizer(path).encode_batch(texts, add_special_tokens=False)
    for i in range(0, len(texts), 100):
        pieces = [tokens.words(path, t) if apart else tokens.cut(t) for t in texts[i:i + 100]]
        table = tokens.encoded(path, pieces, limit)
        for p, e in zip(pieces, whole[i:i + 100]):
            assert np.frombuffer(tokens.spelled(table, p), "<u4").tolist() == e.ids
    # two generations at most, the young one not far over its bound
    cache = tokens._CACHES[path]
    assert cache.bytes <= limit + 100 * 40_000


def _packed(df):
    return packing.pack(df, WORD_BPE).collect()


def test_step_groups_are_equal_work(spark, sf_dir):
    rows = _packed(spark.read.parquet(f"{sf_dir}/documents.parquet").coalesce(1))
    windows = {r.sequence_id: (r.window, r.step_group) for r in rows}
    work, sizes = Counter(), defaultdict(set)
    for size, group in windows.values():
        work[group] += size
        sizes[group].add(size)
    assert all(len(s) == 1 for s in sizes.values())                       # one context size to a step
    assert max(work.values()) <= packing.STEP_TOKENS
    short = [g for g, n in work.items() if n < packing.STEP_TOKENS]
    assert len(short) <= len({s for v in sizes.values() for s in v})       # only the last step of a size may be smaller


def test_packing_of_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "one two three"), (7, "four five"), (7, "four five"), (None, None), (8, "")] * 3,
                               "doc_id bigint, text string")
    rows = _packed(df.repartition(3))
    length = defaultdict(int)
    for r in rows:
        length[r.doc_id] += r.length
    assert length == {None: 3 * (4 + 1), 7: 3 * 2 * 3, 8: 3 * 1}
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for pieces in spans.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:i]) for i in range(len(pieces))]


def test_released_tasks_pass_everything_on():
    assert list(common.frugal(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3]


def test_powers_are_kept_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(hashing, "KEPT_POWERS", 1 << 17)
    monkeypatch.setattr(hashing, "_POWERS", {})
    for n in (10, 1 << 17, 1 << 18, 5):
        found = hashing.powers(3, n)
        assert len(found) == n and found[4] == 81
        assert all(len(v) <= 1 << 17 for v in hashing._POWERS.values())


@pytest.mark.parametrize("target", [40, 100, 399, 400, 1000])
def test_sides_are_shorter_than_half_of_the_rest(target):
    gram, side = suffix_shards.gram_and_side(target)
    assert gram <= target and 2 * side <= target - gram + 1 and (side > 0) == (target >= 100)


@pytest.mark.parametrize("hot, target", [(2048, 400), (1, 400), (2048, 40)])
def test_repeats_around_the_anchor(spark, hot, target):
    """Shared strings just below and above the target, between random bytes that share shorter pieces."""
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    boiler = [noise(n) for n in (128, 200, 399, 400, 401, 520, 900)]
    texts = []
    for i in range(160):
        parts = [noise(rng.randrange(0, 300))]
        for b in rng.sample(boiler, k=3):
            cut = rng.randrange(0, 60)
            parts += [b[cut:] if rng.random() < 0.5 else b[:len(b) - cut], noise(rng.choice([0, 1, 5, 200]))]
        texts.append("".join(parts))
    texts += texts[:3] + ["é" * 250, "é" * 199, "x" * 1200, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_shards.remove_repeats(df, hot_regions=hot, target=target).collect()}
    assert found == brute.op3(list(enumerate(texts)), target)
