import hashlib
import random
import zlib

import numpy as np

from tidings.llm import periodic as P
from tidings.llm.blobs import hashed_words


def brute(words):
    """Every period, every stretch of equal words so far apart; of equal stretches the least period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def made_up(rng):
    w, k = [], rng.choice([1, 2, 3, 4, 20])
    for _ in range(rng.choice([0, 1, 4, 12])):
        c = rng.random()
        if c < 0.3:
            w += [str(rng.randrange(k)) for _ in range(rng.randrange(1, 9))]
        elif c < 0.6:
            w += ([str(rng.randrange(k)) for _ in range(rng.randrange(1, 7))] * rng.randrange(2, 8))[: -rng.randrange(1, 3)]
        elif w:
            i = rng.randrange(len(w))
            w += w[i : i + rng.randrange(1, 60)]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [made_up(rng) for _ in range(rng.randrange(1, 6))]
        assert P.runs_of([" ".join(w).encode() for w in texts]) == [brute(w) for w in texts]


def test_runs_of_long_and_nested_texts():
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    inner = ["x", "y"] * 5 + ["z"] + ["x", "y"] * 5 + ["u", "v", "w"]
    texts = [["a"] * 50_000, list(fib[-1]), inner * 6, inner * 3 + ["end"] + inner * 7, ["a", "b"] * 3 + ["a"]]
    got = P.runs_of([" ".join(w).encode() for w in texts])
    assert got[0] == [(0, 50_000, 1)]
    assert got[1:] == [brute(w) for w in texts[1:]]


def test_longest_previous_factors():
    rng = random.Random(4)
    for _ in range(60):
        w = made_up(rng) or ["a"]
        token, _ = hashed_words([" ".join(w).encode()])
        length, source = P.longest_previous(P.Ranks(token, np.full(len(w), len(w))))
        for i in range(len(w)):
            want = max((next((k for k in range(len(w) - i) if w[i + k] != w[j + k]), len(w) - i) for j in range(i)), default=0)
            assert length[i] == want and (not want or (source[i] < i and w[source[i] : source[i] + want] == w[i : i + want]))


def digest(rows):
    out = []
    for d, t in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        h = zlib.crc32(("" if d is None else str(d)).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = min(((-k, s, q) for s, k, q in runs), default=None)
        told = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        out.append((d, len(runs), *told, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(x for i, x in enumerate(w) if i not in gone)))))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf, monkeypatch):
    rng = random.Random(6)
    rows = [(i, "\n".join(made_up(rng))) for i in range(80)]
    rows += [(None, "a b c d e f g h"), (None, None), (200, None), (201, ""), (202, " \t\n"), (203, "a " * 3000), (204, "é ü é ü é ü é ü  "), (1, rows[1][1])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_runs int")
    assert sorted(map(tuple, P.digest(df).collect()), key=str) == digest(rows)
    assert P.digest(df.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect() if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in P.digest(docs).collect()}
    assert len(got) == docs.count()
    for want in digest(rows):
        assert got[want[0]] == want


def test_blocks_of_texts_answer_alike(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(made_up(rng)).encode() for _ in range(40)]
    whole = P.runs_of(texts)
    monkeypatch.setattr(P, "TOGETHER", 50)
    monkeypatch.setattr(P, "PAIRS", 3)
    assert [x for s, e in P._parts(texts) for x in P.runs_of(texts[s:e])] == whole
