import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf)
        assert name == "mixing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after[name] = (before, docs.collect())
    before, rows = after["toxicity"]
    kept = {r.doc_id for r in rows}
    clean = [d for d in before if labels.get(d) == 0]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)

    before, rows = after["near_duplicates"]
    sets = {}
    for d, r in before.items():
        w = r.text.encode().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    kept = {r.doc_id for r in rows}
    near = lambda a, b: (c := len(sets[a] & sets[b])) >= 0.8 * (len(sets[a]) + len(sets[b]) - c) - 1e-9
    ids = sorted(before)
    linked = {d: [e for e in ids if e != d and near(d, e)] for d in ids}
    assert not [(a, b) for a in kept for b in linked[a] if b in kept]
    assert all(d in kept or min(linked[d]) < d for d in ids)

    before, rows = after["benchmark"]
    kept = {r.doc_id for r in rows}
    assert kept == {d for d, r in before.items() if not any(i in r.text for i in items)}

    before, rows = after["secrets"]
    secret = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}""")
    for r in rows:
        assert not secret.search(r.text) and not re.search("[0-9a-f]{16}", r.text) and r.n_chars == len(r.text)
        if not secret.search(before[r.doc_id].text) and not re.search("[0-9a-f]{16}|AKIA", before[r.doc_id].text):
            assert r.text == before[r.doc_id].text

    before, rows = after["mixing"]
    times = Counter(r.doc_id for r in rows)
    assert max(times.values()) <= 3 and set(times) <= set(before) and {r.copy for r in rows} <= {1, 2, 3}


def test_run_is_the_stages_and_reruns_agree(spark, sf):
    a = sorted((r.doc_id, r.copy) for r in corpus_pipeline.run(spark, sf).select("doc_id", "copy").collect())
    b = sorted((r.doc_id, r.copy) for r in corpus_pipeline.run(spark, sf).select("doc_id", "copy").collect())
    assert a == b and a


def test_stages_take_odd_tables(spark, sf):
    rows = [(1, None, None, None, None), (None, "", "en", None, 0), (2, "word " * 300, None, "s", 5), (2, "word " * 300, None, "s", 5), (3, "a b", "xx", "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({n: F.lit("clash") for n in ("toxicity", "_key", "_kept", "_secrets", "_mix", "_place", "leaks")})
    for _, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.limit(0)):
            stage(spark, d, sf).write.format("noop").mode("overwrite").save()  # all columns, unlike a count
