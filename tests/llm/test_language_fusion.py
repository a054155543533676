"""The fused posteriors of operator 2 against plain Python, for documents and for pages."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierforge.llm import language, queries


def _softmax(logs):
    top = max(logs)
    powers = [math.exp(x - top) for x in logs]
    return [p / sum(powers) for p in powers]


def fused(rows, names, model):
    """rows: (id, text, host, suffix, declared). -> {id: (language, posterior, kept)}"""
    k, scored = len(names), []
    for i, text, host, suffix, declared in rows:
        buckets, _, n = language._trigrams([text or ""])
        n = int(n[0])
        mean = [float(model[buckets, j].astype(float).sum()) / max(n, 1) for j in range(k)]
        evidence = [m * min(n, language.TEMPER) for m in mean]
        covered = n > 0 and max(mean) > math.log(1 / language.BUCKETS)
        scored.append((i, host or "", suffix or "", declared or "", n, evidence, covered))
    hosts, suffixes, told, top = (defaultdict(lambda: [0.0] * k) for _ in range(4))
    for _, host, suffix, declared, _, evidence, covered in scored:
        if covered:
            p = _softmax(evidence)
            for table, key in ((hosts, (host, suffix)), (suffixes, suffix), (top, "")) + (((told, declared),) if declared else ()):
                table[key] = [a + b for a, b in zip(table[key], p)]

    def smooth(counts, above, weight):
        return [(c + weight * a) / (sum(counts) + weight) for c, a in zip(counts, above)]

    whole = [(c + 1.0) / (sum(top[""]) + k) for c in top[""]]
    out = {}
    for i, host, suffix, declared, n, evidence, covered in scored:
        prior = smooth(hosts[host, suffix], smooth(suffixes[suffix], whole, language.SMOOTHING), language.SMOOTHING) \
            if (host, suffix) in hosts else whole
        said = smooth(told[declared], [1 / k] * k, language.DECLARED_SMOOTHING) if declared in told else [1 / k] * k
        p = _softmax([e + math.log(a) + math.log(b) for e, a, b in zip(evidence, prior, said)])
        best = max(p)
        out[i] = (names[p.index(best)] if covered else None, best if covered else 0.0, n > 0 and (not covered or best >= language.MIN_POSTERIOR))
    return out


def _same(found, expected):
    assert found.keys() == expected.keys()
    for i, (name, posterior, kept) in expected.items():
        assert found[i][1] == pytest.approx(posterior, abs=1e-6) and found[i][2] == kept, i
        assert found[i][0] == name, i


def test_documents_and_their_declared_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(6).select((F.col("doc_id") + 10_000).alias("doc_id"), F.lit("12 ?! …").alias("text"), "lang", F.lit(None).cast("string").alias("source"), "n_chars")
    docs = docs.unionByName(odd).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang")))
    names, model = language.fit_characters(docs, "text", "lang")
    rows = [(r.doc_id, r.text, r.source, None, r.lang) for r in docs.collect()]
    found = {r.doc_id: (r.language, r.posterior, r.kept) for r in language.identify(docs, names=names, model=model).collect()}
    _same(found, fused(rows, names, model))


def test_pages_with_markup_address_and_host(spark, sf_dir):
    names, model = language.fit_characters(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", "lang")
    rows = []
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        page, url = r.html or "", r.url or ""
        declared = re.search(r"""<html[^>]*\blang=["']?([A-Za-z]+)""", page, re.I)
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", url)
        host = host.group(1).lower() if host else ""
        bare = re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ", page))
        rows.append((r.page_id, bare, host, host.rsplit(".", 1)[-1], declared.group(1).lower() if declared else None))
    assert len({r[3] for r in rows}) > 1 and any(r[4] for r in rows)
    found = {r.page_id: (r.language, r.posterior, r.kept) for r in queries.language_pages(spark, sf_dir).collect()}
    _same(found, fused(rows, names, model))


def test_trigrams_are_held_for_a_slice_of_the_texts_only(spark, tmp_path):
    """Of many texts a worker turns SLICE_BYTES at a time into trigrams, when it fits and when it scores; the model is the same."""
    rows = spark.createDataFrame([(i, f"{'word' * 150} {i} {'other' * 100}", "ab"[i % 2]) for i in range(1500)], "doc_id int, text string, lang string").coalesce(1)
    seen = str(tmp_path)
    real = language._trigrams

    def noted(texts):
        import os
        import uuid
        with open(os.path.join(seen, uuid.uuid4().hex), "w") as f:
            f.write(str(sum(map(len, texts))))
        return real(texts)

    names, model = language.fit_characters(rows, "text", "lang")
    buckets, n = np.unique(real([r.text for r in rows.where("lang = 'a'").collect()])[0], return_counts=True)
    table = np.full(language.BUCKETS, 0.05)
    table[buckets] += n
    assert names == ["a", "b"] and np.allclose(model[:, 0], np.log(table / table.sum()))
    language._trigrams = noted
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(language)
        language.fit_characters(rows, "text", "lang")
        language.score_texts(rows.select("doc_id", "text"), model).collect()
        cloudpickle.unregister_pickle_by_value(language)
    finally:
        language._trigrams = real
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(sizes) > 3 * language.SLICE_BYTES and max(sizes) <= language.SLICE_BYTES
