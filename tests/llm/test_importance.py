import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tidings.llm import importance as I


def buckets(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    grams = [b" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), Counter(zlib.crc32(g) % 10_000 for g in grams)


def brute(docs, targets):
    found = [(d, *buckets(t)) for d, t in docs]
    s, t = (sum((c for c in cs), Counter()) for cs in ([c for _, _, c in found], [buckets(x)[1] for x in targets]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000.0) / ((s[b] + 1) * (all_t + 10_000.0)))) for b in s}
    out = []
    for d, n, c in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(k * gain[b] for b, k in c.items())
        out.append([d, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(drawn[: 5 * len(drawn) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows, items = [tuple(r) for r in docs.collect()], [r.text for r in target.collect()]
    assert sorted(map(tuple, I.digest(docs, target).collect()), key=str) == brute(rows, items)
    rng = random.Random(1)
    rows += [(9001, None), (9002, ""), (9003, " ..!"), (9004, "ÄBC abc ß9 " * 30_000), (None, rows[3][1]), (9005, "a-b_c d É" * 9), (-7, " ".join(f"w{rng.randrange(99)}" for _ in range(50)))]
    rows += [(1000 + i, items[i % len(items)]) for i in range(100)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, weight int")
    more = target.select("text").unionByName(spark.createDataFrame([(None,), ("",)], "text string"))
    assert sorted(map(tuple, I.digest(df, more).collect()), key=str) == brute(rows, items)
    assert I.digest(df.limit(0), target).count() == 0
    got = I.digest(docs, target.limit(0)).collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in docs.collect()], [])


def test_equal_rows_weigh_alike_and_are_ranked_apart(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text)] * 70 + [(2, text + " more")] * 30 + [(None, text)] * 5, "doc_id long, text string")
    got = I.resample(df, spark.createDataFrame([(text,)], "text string")).collect()
    assert len(got) == 105 and len({(r.doc_id, r.weight, r.score) for r in got}) == 3
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    drawn = [r for r in got if r["rank"]]
    best = max((r.score, -(r.doc_id or 9)) for r in got)
    assert {(r.score, -(r.doc_id or 9)) for r in drawn} == {best}
    again = I.resample(df, spark.createDataFrame([(text,)], "text string")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_features_of_pieces_and_the_whole(monkeypatch):
    rng = random.Random(2)
    for _ in range(40):
        text = "".join(rng.choice(["a", "Bc", " ", "-", "é", "9", "\n"]) for _ in range(rng.randrange(80)))
        n, counts = buckets(text)
        for size in (1, 7, 1 << 20):
            monkeypatch.setattr(I, "word_pieces", lambda t, k, s=size: __import__("tidings.llm.common", fromlist=["x"]).word_pieces(t, k, s))
            got, words, features = I.features(text.encode())
            assert words == n and features == sum(counts.values()) == got.sum()
            assert {int(b): int(got[b]) for b in np.flatnonzero(got)} == dict(counts)
