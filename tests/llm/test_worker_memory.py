"""What Python workers hold at once in the stages near and pack."""

import os
import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402
from tierforge.llm import packing, prob_minhash, queries, tokens  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _peak(work) -> float:
    """MB that ``work`` holds at most."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_sketches_are_compared_in_small_blocks():
    """Different sketches of as many components: all pairs are compared (four copies of 32 MB before), none is alike."""
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 256, (600, 512), dtype=np.uint8)
    marks[7] = marks[500]
    found = []
    least = prob_minhash.least_agreement(0.8, 1024)
    assert _peak(lambda: found.append(prob_minhash.alike(marks, np.arange(600), least))) < 40
    assert [x.tolist() for x in found[0]] == [[7], [500]]


def test_shingles_of_a_slice_are_few():
    """Sketching a MB of texts goes slice by slice."""
    rng = random.Random(2)
    column = pa.array([" ".join(f"w{rng.randrange(10**6)}" for _ in range(250)) for _ in range(600)])
    assert sum(map(len, column.to_pylist())) > 1 << 20

    def work():
        for lo, hi in tokens.slices(column, prob_minhash.SLICE_BYTES):
            row, hashes, weight = prob_minhash.shingles(column.slice(lo, hi - lo))
            prob_minhash.signatures(row, hashes, weight, hi - lo, prob_minhash.BANDS * prob_minhash.ROWS)

    assert _peak(work) < 25


def test_a_worker_forgets_its_tokenizers_and_packs_slices(spark, monkeypatch):
    """Small slices give the pieces that one large slice gives; afterwards no tokenizer stays."""
    texts = [f"the {i} words of text number {i % 7}, " * (i % 40) for i in range(300)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    whole = packing.pack(df, WORD_BPE).collect()
    assert sum(r.length for r in whole) == sum(
        len(tokens.tokenizer(WORD_BPE).encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    assert tokens.letters(WORD_BPE) is not None
    tokens.forget()
    assert not tokens._TOKENIZERS and not tokens._CACHES
    assert packing.SLICE_BYTES <= 1 << 18


def test_all_operators_stay_registered():
    names = {**queries.queries(), **queries.later_queries()}
    assert len(names) == 14 and set(names) < set(__spark_entry__.queries())
