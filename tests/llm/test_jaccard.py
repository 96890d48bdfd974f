import random

import numpy as np
import pytest

from tidings.llm import graph
from tidings.llm import jaccard as J


def brute(rows):
    def shingled(t):
        w = (t or "").encode().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [shingled(t) for _, t in rows]
    parent, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])):
                c = len(sets[i] & sets[j])
                if c >= 0.8 * (len(sets[i]) + len(sets[j]) - c) - 1e-9:
                    n[i] += 1
                    n[j] += 1
                    parent[find(i)] = find(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), d), d)
    return sorted((d, first[find(i)], n[i]) for i, (d, _) in enumerate(rows))


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


def test_brute_force(spark, sf, monkeypatch):
    rng = random.Random(4)
    texts = []
    for k in range(8):
        texts += near_copies(rng, " ".join(f"{k}w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120, 400]))), 15, 4)
    chain = " ".join(f"c{i}" for i in range(200)).split()
    texts += [" ".join(chain[i * 8 : i * 8 + 120]) for i in range(8)] + ["a b", "a b", "a b c d", "x", "one two three four five", "z " * 20_000, "z " * 19_000]
    rows = [*enumerate(texts), (900, None), (901, ""), (902, " \n"), (903, texts[0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, n_links string, _key int")
    want = brute(rows)
    assert sorted(map(tuple, J.digest(df).collect())) == want
    monkeypatch.setattr(J, "BLOCK", 1)
    monkeypatch.setattr(J, "BUCKET", 3)
    assert sorted(map(tuple, J.digest(df).collect())) == want
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    heads = {c for _, c, _ in want}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(heads)
    assert J.digest(df.limit(0)).count() == 0 and J.keep_one(df.limit(0)).count() == 0
    monkeypatch.undo()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, J.digest(docs).collect())) == brute([tuple(r) for r in docs.collect()])


def test_equal_rows_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, t + " x"), (None, None), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in J.digest(df).collect()), key=str)
    assert got == sorted([(1, 1, 3), (1, 1, 3), (None, 1, 3), (None, 1, 3), (None, None, 0), (None, None, 0)], key=str)
    assert sorted(str(r.doc_id) for r in J.keep_one(df).collect()) == ["1", "None", "None"]


def test_pruning_keeps_what_reaches_the_threshold():
    rng = np.random.default_rng(0)
    least = J.least_matches()
    assert least == sorted(least) and all(0 <= m <= (k + 1) * J.STEP * J.THRESHOLD for k, m in enumerate(least))
    lost = 0
    for _ in range(300):
        a = rng.integers(0, 2**63, 180).astype(np.uint64)
        b = np.concatenate([a[:160], rng.integers(0, 2**63, 20).astype(np.uint64)])  # 160 of 200
        s = J.signatures([np.unique(a), np.unique(b)])
        lost += len(J.survivors(s[0], s[1:], least)) != 1
    assert lost == 0


def test_overlaps_equal_intersections():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.9], rng.integers(0, 40, rng.integers(0, 9)).astype(np.uint64)])) for _ in range(30)]
    overlap = J.Overlap(sets)
    for i, a in enumerate(sets):
        got, want = overlap.common(i), [len(np.intersect1d(a, b)) for b in sets]
        assert [x for j, x in enumerate(got.tolist()) if j != i] == [x for j, x in enumerate(want) if j != i]


def test_hot_classes_are_looked_up_alike(spark, monkeypatch):
    monkeypatch.setattr(J, "max", lambda *_: 2, raising=False)  # every key with over two rows counts as hot
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(i, t + f" x{i % 7}") for i in range(40)] + [(99, None), (98, "")], "doc_id long, text string")
    assert sorted(map(tuple, J.digest(df).collect())) == brute([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("small", [0, 10, 1_000_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(graph, "SMALL", small)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (100, 102), (7, 7), (200, 199)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 199: 199, 200: 199}


def test_sets_of_members_pass_no_driver(spark, monkeypatch):
    texts = [" ".join(f"{k}w{i}" for i in range(30)) for k in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0], None])], "doc_id long, text string")
    sets = {J.node_name(s): s.tobytes() for s in J.shingle_sets([t.encode() for t in texts])}
    some = sorted(sets)[:3]
    members = spark.createDataFrame([(n,) for n in some], "node long")

    def refuse(*_, **__):
        raise AssertionError("names were sent to the driver")

    with monkeypatch.context() as m:
        for name in ("toLocalIterator", "collect", "toPandas"):
            m.setattr(type(docs), name, refuse)
        found = J._sets_of(docs, members, "text")
    assert sorted((r["_sn"], bytes(r["set"])) for r in found.collect()) == sorted((n, sets[n]) for n in some)


def test_unlike_nodes_in_one_bucket_are_parted_by_size(spark, monkeypatch):
    """Nodes that share one band and nothing else, as a template makes them: few of all their pairs are compared, and none is lost."""
    monkeypatch.setattr(J, "BUCKET", 200)
    rng = np.random.default_rng(3)
    n = 4000
    sign = rng.integers(0, 1 << 16, (n, J.HASHES), dtype=np.uint16)
    sign[:, : J.BAND] = 7
    size = np.exp(rng.uniform(np.log(5), np.log(5000), n)).astype(int)
    near = rng.choice(n // 2, 40, replace=False)  # some pairs are alike, with sizes to match
    sign[near + n // 2] = sign[near]
    size[near + n // 2] = np.maximum(1, (size[near] * rng.uniform(0.82, 1.2, len(near))).astype(int))
    rows = [(int(i), int(s), bytearray(x.tobytes())) for i, (s, x) in enumerate(zip(size, sign))]
    nodes = spark.createDataFrame(rows, "node long, size int, sign binary").repartition(8)
    found = J.candidates(nodes, 8).collect()
    assert sum(r.n for r in found) < n * n / 10
    family = {r.node: r.component for r in graph.components(spark.createDataFrame([(r.a, r.b) for r in found], "a long, b long")).collect()}
    assert all(family[int(i)] == family[int(i) + n // 2] for i in near)
    assert len(family) == 2 * len(near)
