import hashlib
import random

import numpy as np

from tidings.llm import blobs, substr


def brute(rows, size):
    """Keeps the first of each window by (doc_id, start); rows: (doc_id, text), ids distinct."""
    seen, out = set(), []
    for d, t in sorted(rows):
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            if k in seen:
                gone.update(range(i, i + size))
            seen.add(k)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_packing_round_trips():
    rng = np.random.default_rng(0)
    for dtype in (np.uint64, np.int64, np.uint32, np.uint8):
        for n in (0, 1, 1000):
            x = rng.integers(0, np.iinfo(dtype).max, n, dtype=dtype)
            assert (blobs.unpack(blobs.pack(x)) == x).all()
            assert (blobs.unpack_sorted(blobs.pack_sorted(np.sort(x))) == np.sort(x)).all()
    for x in (np.zeros(0, dtype=np.uint32), np.ones(5, dtype=np.uint32), rng.integers(0, 9, 500).astype(np.uint32), rng.random(300).astype(np.float32)):
        assert (blobs.unpack_common(blobs.pack_common(x)) == x).all() and blobs.unpack_common(blobs.pack_common(x)).dtype == x.dtype
    b = rng.random(1003) < 0.5
    assert (blobs.unpack_bits(blobs.pack_bits(b)) == b).all()


def test_window_hashes_depend_on_their_window_only():
    x = np.random.default_rng(0).integers(0, 5, 400).astype(np.uint64)
    for n in (1, 2, 3, 7, 20, 32):
        h = blobs.window_hashes(x, n)
        assert len(h) == len(x) - n + 1
        by = {}
        for i in range(len(h)):
            assert by.setdefault(tuple(x[i : i + n]), h[i]) == h[i]
        assert len(set(by.values())) == len(by)


def test_brute_force(spark, sf):
    rng = random.Random(3)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(6)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.5 else "\n".join(rng.choice("xyz") for _ in range(9)) for _ in range(6))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "é " * 30_000), (104, rows[0][1]), (-5, rows[1][1])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_words string")
    assert sorted(map(tuple, substr.digest(df).collect())) == sorted(brute(rows, substr.WINDOW))
    assert substr.digest(df.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, substr.digest(docs).collect())) == sorted(brute([tuple(r) for r in docs.collect()], substr.WINDOW))


def test_equal_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text + " more")], "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.n_removed) for r in substr.digest(df).collect()))
    assert got == [(False, 0), (False, 25), (True, 25), (True, 25)]


def test_word_hashes_name_words():
    texts = [b"", b" \t\n", b"ab ba ab", "é ab\x0bba\x0c é".encode(), b"x" * 70_000 + b" y", b"a" * 3 + b" " + b"a" * 4] + [b"w%d" % i for i in range(50)]
    flat, counts = blobs.hashed_words(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts] and len(flat) == len(words)
    assert len(set(flat.tolist())) == len(set(words)) and len(set(zip(words, flat.tolist()))) == len(set(words))
