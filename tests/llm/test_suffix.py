import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd

from tidings.llm import suffix as S


def brute(rows):
    seen, out = set(), []
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - S.LENGTH + 1):
            k = b[i : i + S.LENGTH]
            if k in seen:
                gone[i : i + S.LENGTH] = True
            seen.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_merge_equals_sorting():
    rng = np.random.default_rng(2)
    runs, texts = [], []
    for n in (0, 1, 40, 7, 40):
        rows = rng.integers(97, 99, (n, S.WHOLE), dtype=np.uint8)
        rows[:, : int(rng.integers(0, 160))] = 97
        rows = np.unique(rows, axis=0)
        shared, rest = S.front_coded(rows)
        assert S.decoded(shared, rest) == [r.tobytes() for r in rows]
        runs.append((shared.tolist(), S.decoded(shared, rest)))
        texts += runs[-1][1]
    run, at, shared = S.merged(runs)
    got = [runs[r][1][i] for r, i in zip(run, at)]
    assert got == sorted(texts)
    for a, b, n in zip(got, got[1:], shared[1:]):
        assert a[:n] == b[:n] and (n == S.WHOLE or a[n] != b[n])


def test_brute_force(spark, sf):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefghij é") for _ in range(rng.choice([60, 99, 100, 130, 300]))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(pool) if rng.random() < 0.7 else "".join(rng.choice("xyz") for _ in range(rng.choice([1, 5, 40]))) for _ in range(5))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 99), (103, "ab" * 10_000), (104, rows[0][1]), (-5, rows[1][1]), (105, "\0" * 250), (106, "ab" * 70 + "\0" * 120)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_bytes string")
    assert sorted(map(tuple, S.digest(df).collect())) == sorted(brute(rows))
    assert S.digest(df.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, S.digest(docs).collect())) == sorted(brute([tuple(r) for r in docs.collect()]))


def test_equal_rows_and_null_ids(spark):
    text = "".join(chr(97 + (i * i) % 26) + str(i) for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text + " more")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed) for r in S.digest(df).collect())
    assert got == [(False, 0), (False, len(text)), (True, len(text)), (True, len(text))]


def shared_passage(n):
    """n documents that share a passage of 250 letters amid text of their own."""
    rng = random.Random(7)
    some = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage = some(250)
    return [(i, some(rng.randrange(90, 200)) + passage + some(rng.randrange(90, 200))) for i in range(n)]


def test_a_passage_in_many_surroundings_loads_no_single_receiver():
    bits, parts = 20, 12
    pdf = pd.DataFrame([(i, i, t.encode()) for i, t in shared_passage(400)], columns=["_id", "_tie", "_text"])

    def loads(limit):
        sketch = S._sketch(bits, parts)((0,), pdf)
        answers = pd.concat([S._merged_sketch(limit)((k,), rows) for k, rows in sketch.groupby("to")])
        s = S.Suffixes(S.Group(pdf), S.sections(answers), bits, parts)
        return np.bincount(s.to[s.new], minlength=parts) + np.bincount(s.strings.to[s.strings.new], minlength=parts)

    assert loads(10**9).max() * 4 > loads(10**9).sum()
    assert loads(200).max() * 6 < loads(200).sum()


def test_hot_anchors_answer_like_others(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdefghij é") for _ in range(k)) for k in (120, 99, 300)]
    rows = shared_passage(60) + [(100 + i, "".join(rng.choice(pool) + "xyz"[i % 3] * rng.choice([0, 1, 60]) for _ in range(4))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, "ab" * 3000), (203, rows[0][1]), (-5, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (2, 20, S.HOT):
        got = S.dedup_bytes(df, hot_from=limit).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(brute(rows))


def test_the_merge_never_compares_known_bytes(monkeypatch):
    """Every byte of a head is compared at most once on its way out: what it shares with the last output is never looked at."""
    rng = random.Random(5)
    looked = [0]

    class Counted(bytes):
        def __getitem__(self, k):
            if isinstance(k, slice):
                looked[0] += max(0, min(k.stop, len(self)) - k.start)
            return bytes.__getitem__(self, k)

    head = bytes(rng.randrange(97, 99) for _ in range(90))
    rows = [head + bytes(rng.randrange(97, 123) for _ in range(S.WHOLE - 90)) for _ in range(400)]
    runs = []
    for k in range(8):
        own = sorted(set(rows[k::8]))
        shared = [0] + [next(i for i in range(S.WHOLE) if a[i] != b[i]) for a, b in zip(own, own[1:])]
        runs.append((shared, [Counted(x) for x in own]))
    run, at, shared = S.merged(runs)
    out = [bytes(runs[r][1][i]) for r, i in zip(run, at)]
    assert out == sorted(out) and len(out) == len(rows)
    assert all(n == next((i for i in range(S.WHOLE) if a[i] != b[i]), S.WHOLE) for n, a, b in zip(shared[1:], out, out[1:]))
    # the common head is read when the tree is built and once where two runs meet, not for each of the 400 outputs
    assert looked[0] < 2 * (8 * 96 + 3 * 16 * len(rows))


def test_memory_stays_small_where_all_text_repeats():
    """Every anchor occurs again: rows of suffixes take some five bytes a byte of text, and little comes on top."""
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 2_000_000, dtype=np.uint8).tobytes()
    g = S.Group(pd.DataFrame([(1, 1, text), (2, 2, text)], columns=["_id", "_tie", "_text"]))
    answers = {("sketch", k): S.join_blobs([S.pack_bits(np.ones(n, dtype=bool)), S.pack_bits(np.zeros(n, dtype=bool))]) for k, n in enumerate(np.diff(S._cuts(np.unique(g.hash >> np.uint64(40)), 24, 12)))}
    tracemalloc.start()
    s = S.Suffixes(g, answers, 24, 12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(s.place) == len(g.at) > 100_000 and int(s.new.sum()) * 2 == len(s.place)
    assert peak < 8 * 2 * len(text)
