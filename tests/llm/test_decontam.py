import random

import numpy as np
import pytest

from tidings.llm import decontam as D

ITEM = "the quick heron wanders across seven silent rivers before dawn breaks over granite hills where nobody has ever counted stars"


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(1)
    items = [rng.integers(1, 6, rng.integers(1, 9)) for _ in range(40)]
    windows = [rng.integers(1, 6, rng.integers(1, 14)) for _ in range(40)]
    got, _, _ = D.align(items, windows)
    for k, (a, b) in enumerate(zip(items, windows)):
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (D.MATCH if a[i] == b[j] else D.MISMATCH), h[i, j + 1] + D.GAP, h[i + 1, j] + D.GAP)
        assert abs(h.max() - got[k]) < 1e-9


def test_copies_edits_and_clean_texts(spark):
    words = ITEM.split()
    edited = [w if i % 6 else "changed" for i, w in enumerate(words)]
    dropped = [w for i, w in enumerate(words) if i % 7 != 3]
    filler = " ".join(f"f{i}" for i in range(3000))
    rows = [(1, f"{filler} {ITEM.upper()}! {filler}"), (2, " ".join(edited)), (3, f"x {' '.join(dropped)} y"), (4, filler), (5, None), (6, ""), (7, "the quick heron"), (None, ITEM), (1, ITEM)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([(10, ITEM, "e"), (10, ITEM, "e"), (11, "a b", None), (12, None, None), (13, "never seen words in this item at all", None)], "item_id long, text string, extra string")
    got = D.digest(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == [("1", 10), ("1", 10), ("2", 10), ("3", 10), ("None", 10)]
    one = next(r for r in got if r.doc_id == 1 and r.start_word > 0)
    assert (one.start_word, one.end_word, one.score) == (3000, 3000 + len(words), 1.0)
    assert D.digest(docs, bench.limit(0)).count() == 0 and D.digest(docs.limit(0), bench).count() == 0
    assert set(D.find_leaks(docs, bench).columns) == {"doc_id", "text", "leaks"}


def test_every_contained_item_is_found(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = bench.collect()
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text}
    assert want <= {(r.doc_id, r.item_id) for r in D.digest(docs, bench).collect()}


@pytest.mark.parametrize("live", [1, 2, 4])
def test_blocks(spark, monkeypatch, live):
    monkeypatch.setattr(D, "BLOCK_WORDS", 10)
    monkeypatch.setattr(D, "LIVE", live)
    bench = spark.createDataFrame([(i, f"{ITEM} tail{i}") for i in range(3)], "item_id long, text string")
    docs = spark.createDataFrame([(7, f"{ITEM} tail1")], "doc_id long, text string")
    assert sorted(r.item_id for r in D.digest(docs, bench).collect()) == [0, 1, 2]
    more = docs.selectExpr("doc_id", "text", "5 AS _key", "6 AS _found").unionByName(spark.createDataFrame([(None, None, 1, 1), (8, "", 1, 1), (7, f"{ITEM} tail1", 1, 1)], "doc_id long, text string, _key int, _found int"))
    got = D.find_leaks(more, bench)
    assert got.columns == [*more.columns, "leaks"] and sorted(len(r.leaks) for r in got.collect()) == [0, 0, 3, 3]


def test_frequent_passages_are_found_like_rare_ones(spark, monkeypatch):
    words = ITEM.split()
    copy = " ".join(words[:11])  # half of the trigrams, which so many copies make frequent
    bench = spark.createDataFrame([(10, ITEM), (11, "the quick heron wanders across a field of other words that no text here has")], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a{i} b{i} {copy} c{i} d{i}") for i in range(3 * D.RARE)], "doc_id long, text string")
    few = docs.where("doc_id < 3")
    want = [(10, 0.55, 2, 13)]
    found = lambda rows: [tuple(r)[1:] for r in D.digest(rows, bench).collect()]
    assert found(few) == want * 3 and found(docs) == want * 3 * D.RARE
    texts = [r.text for r in docs.collect()] + [ITEM, ""]
    index = D.Index([(r.item_id, r.text) for r in bench.collect()])
    whole = index.leaks(texts)
    monkeypatch.setattr(D, "POSTINGS", 5)  # every text alone, and its items in turns
    index.mark_rare(np.full(len(index.keys), 1000))
    assert index.leaks(texts) == whole and len(whole[-2]) == 1


def test_recall_of_edited_copies_against_plain_alignment(spark):
    """Copies with words changed, dropped and added, found against Smith-Waterman over the whole text."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 40))) for _ in range(25)]
    texts = []
    for k in range(200):
        out = []
        rate = rng.choice([0.05, 0.1, 0.15, 0.2, 0.25])
        for w in rng.choice(items).split():
            x = rng.random()
            out += [rng.choice(vocabulary)] if x < rate / 2 else [] if x < rate * 0.75 else [w, rng.choice(vocabulary)] if x < rate else [w]
        around = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(2)]
        texts.append(f"{around[0]} {' '.join(out)} {around[1]}")
    index = D.Index(list(enumerate(items)))
    numbers, starts = index.numbers(texts)
    want = set()
    for d in range(len(texts)):
        window = numbers[starts[d] : starts[d + 1] - D.N]
        score, _, _ = D.align(index.items, [window] * len(items))
        want |= {(d, i) for i, s in enumerate(score) if s / len(index.items[i]) >= D.REPORT_AT}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.digest(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert found <= want and len(want) > 150 and len(found) >= 0.97 * len(want)
