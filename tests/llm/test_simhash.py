import random

import numpy as np
import pytest
import xxhash

from tidings.llm import common
from tidings.llm import simhash as H


def brute_print(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(prints):
    """The least place that each of the fingerprints is connected with."""
    least = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_every_link_has_a_chain_within_budget():
    rng = random.Random(1)
    for _ in range(3000):
        flips = sum(1 << k for k in rng.sample(range(64), rng.randrange(5)))
        assert any(all((flips & int(m)).bit_count() <= b for m, b in zip(H.CHAINS[i], H.BUDGETS)) for i in range(5))
    assert [int(c[-1]) for c in H.CHAINS] == [2**64 - 1] * 5 and H.BUDGETS == [0, 1, 2, 3, 4]


def near_prints():
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    prints = {c ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(60)}
    return sorted(prints | {rng.getrandbits(64) for _ in range(60)})


@pytest.mark.parametrize("bucket", [3, 20, H.BUCKET])
def test_links_connect_what_brute_force_does(spark, bucket):
    prints = near_prints()
    nodes = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "node long")
    least = list(range(len(prints)))
    at = {p: i for i, p in enumerate(prints)}
    edges = [(at[r.a % 2**64], at[r.b % 2**64]) for r in H.links(nodes, bucket).collect()]
    if bucket == H.BUCKET:
        assert len(edges) < 5 * len(prints)  # forests of buckets, not pairs
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    assert least == brute(prints)


def test_query_equals_brute_force(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(30_000))
    extra = [(9001, None), (9002, ""), (9003, " \n"), (9004, "One two"), (9005, "one TWO"), (9006, "a b c d"), (9007, "É x"), (-3, rows[5][1]), (None, rows[6][1]), (9008, long), (9009, long + " more"), (9008, long)]
    df = spark.createDataFrame([(*r, "x") for r in rows + extra], "doc_id long, text string, node string")
    monkeypatch.setattr(common, "GAP", common.GAP)
    got = sorted(map(tuple, H.digest(df).collect()), key=str)
    every = sorted(rows + extra, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [brute_print(t) for _, t in every]
    least = brute(prints)
    assert got == sorted(((d, f"{p:016x}", every[k][0]) for (d, _), p, k in zip(every, prints, least)), key=str)
    assert H.digest(df.limit(0)).count() == 0


def test_pieces_of_a_text_answer_like_the_whole(monkeypatch):
    rng = random.Random(4)
    for _ in range(50):
        text = "".join(rng.choice(["a", "bc", " ", "\n\t", "x" * 40]) for _ in range(rng.randrange(60))).encode()
        whole = text.split()
        for size in (1, 5, 1000):
            got = []
            for words, old in common.word_pieces(text, 2, size):
                assert words[:old] == got[len(got) - old :] and old == min(2, len(got))
                got += words[old:]
            assert got == whole


def test_nulls_only(spark):
    df = spark.createDataFrame([(None, None), (None, "a b c d e")], "doc_id long, text string")
    assert [r.component_id for r in H.digest(df).collect()] == [None, None]
