import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidings.llm import lm


def base(rows, m=5, at=1):
    """Everything but the model's score, by definition."""
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % m == at for d, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for (d, _), ws, h in zip(rows, tokens, held)]


def compare(got, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))


def test_counts_and_base_by_definition(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = lm.digest(docs).collect()
    compare(got, base([tuple(r) for r in docs.collect()]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = {r.doc_id: r.score for r in lm.digest(docs).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)


def test_edges(spark):
    rows = [(i, f"Alpha beta {i} gamma") for i in range(30)] + [(40, None), (41, ""), (42, " \n"), (None, "alpha"), (None, None), (3, "Alpha beta 3 gamma"), (43, "word " * 30_000), (44, "É ALPHA é")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = lm.digest(df).collect()
    compare(got, base(rows))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.digest(df.limit(0)).count() == 0
    none = lm.score_texts(df, F.lit(False)).collect()
    assert {(r.train_tokens, r.base_score, r.score, r.n_known) for r in none} == {(0, 0.0, 0.0, 0)}


def test_probabilities_sum_to_one(spark):
    """Texts of two words after the same context: their scores differ by the second word and the end after it."""
    train = [(i, "a b a c a b d") for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 1]
    free = (i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 5 == 1)
    words = ["a", "b", "c", "d", "never"]
    asked = {next(free): ("a", w) for w in words} | {next(free): (w,) for w in words}
    df = spark.createDataFrame(train + [(i, " ".join(t)) for i, t in asked.items()], "doc_id long, text string")
    score = {asked[r.doc_id]: r.score for r in lm.digest(df).collect() if r.doc_id in asked}
    alone = spark.createDataFrame([*train, (next(free), "")], "doc_id long, text string")
    empty = next(10**r.score for r in lm.digest(alone).collect() if r.held_out)
    start = empty  # p(end | start)
    # p(w | start) p(end | w), summed with p(end | start) over all words and followers, stays below one
    assert 0 < start + sum(10**v for k, v in score.items()) < 1


def test_split_contexts_change_nothing_but_balance(spark, monkeypatch):
    rows = [(i, " ".join(f"x w{(i * 7 + k * k) % 900}" for k in range(20)) + f" x z{i} x y{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    split = {r.doc_id: r.score for r in lm.digest(df).collect()}
    monkeypatch.setattr(lm, "HOT_SHARE", 2.0)
    whole = {r.doc_id: r.score for r in lm.digest(df).collect()}
    off = [abs(split[k] - whole[k]) / abs(whole[k]) for k in whole]  # two samples of the seating, from other seeds
    assert np.mean(off) < 0.02 and max(off) < 0.06


def test_seatings_follow_the_restaurant(monkeypatch):
    """The sampled numbers of tables against their exact distribution: t tables of n customers have the weight
    S(n, t) * parent^t * prod(theta + d * tables so far), with S(n + 1, t) = S(n, t - 1) + (n - t * d) * S(n, t)."""
    monkeypatch.setattr(lm, "BURN_IN", 12)
    rng = np.random.default_rng(0)
    n, d, theta, p, others = 12, 0.6, 0.5, 0.05, 4
    many = 4000
    tables = list(lm.seatings(np.full(many, n), np.full(many, p), np.arange(many), np.full(many, others), np.ones(many, dtype=int), d, theta, rng))
    ways = {1: 1.0}
    for i in range(1, n):
        ways = {t: ways.get(t - 1, 0.0) + (i - t * d) * ways.get(t, 0.0) for t in range(1, i + 2)}
    weight = {t: w * p**t * math.prod(theta + d * (others + k) for k in range(t)) for t, w in ways.items()}
    exact = sum(t * w for t, w in weight.items()) / sum(weight.values())
    assert abs(np.mean([t.mean() for t in tables]) - exact) < 0.02
    assert all((t >= 1).all() and (t <= n).all() for t in tables)
    big = next(iter(lm.seatings(np.array([10**6]), np.array([1e-3]), np.array([0]), np.array([0]), np.array([1]), 0.5, 1.0, rng)))
    assert 1 <= big[0] < 10**5


def test_dishes_of_a_context_are_seated_jointly(monkeypatch):
    """Two dishes of one context share its tables: their sampled numbers against the exact joint distribution."""
    monkeypatch.setattr(lm, "BURN_IN", 12)
    rng = np.random.default_rng(2)
    d, theta, counts, parents, many = 0.6, 0.5, (9, 5), (0.3, 0.05), 4000
    context = np.repeat(np.arange(many), 2)
    drawn = lm.seatings(np.tile(counts, many), np.tile(parents, many), context, np.zeros(many), np.ones(many, dtype=int), d, theta, rng)
    got = np.mean([t.reshape(-1, 2) for t in drawn], axis=(0, 1))
    ways = []
    for n in counts:
        w = {1: 1.0}
        for i in range(1, n):
            w = {t: w.get(t - 1, 0.0) + (i - t * d) * w.get(t, 0.0) for t in range(1, i + 2)}
        ways.append(w)
    weight = {(a, b): x * y * parents[0] ** a * parents[1] ** b * math.prod(theta + d * k for k in range(a + b)) for a, x in ways[0].items() for b, y in ways[1].items()}
    exact = [sum(t[k] * w for t, w in weight.items()) / sum(weight.values()) for k in range(2)]
    assert np.abs(got - exact).max() < 0.03


def exact_tables(n, d, theta, p, others):
    """The mean number of tables of n customers, from its exact distribution."""
    t = np.arange(n + 1)
    ways = np.full(n + 1, -np.inf)
    ways[1] = 0.0
    for i in range(1, n):
        with np.errstate(divide="ignore"):
            ways = np.logaddexp(np.append(-np.inf, ways[:-1]), ways + np.log(np.maximum(i - t * d, 0)))
    weight = ways[1:] + t[1:] * math.log(p) + np.cumsum(np.log(theta + d * (others + t[:-1])))
    weight = np.exp(weight - weight.max())
    return (weight * t[1:]).sum() / weight.sum()


def test_many_customers_sit_as_the_exact_distribution_says():
    rng = np.random.default_rng(1)
    for n, d, p, others, most in ((25, 0.7, 0.02, 3, 0.02), (25, 0.8, 0.1, 20, 0.09), (120, 0.7, 0.2, 3, 0.04), (512, 0.7, 0.01, 10_000, 0.01), (1000, 0.8, 0.01, 3000, 0.01)):
        many = 3000
        drawn = lm.seatings(np.full(many, n), np.full(many, p), np.arange(many), np.full(many, others), np.ones(many, dtype=int), d, 0.5, rng)
        exact = exact_tables(n, d, 0.5, p, others)
        assert abs(np.mean([t.mean() for t in drawn]) - exact) < most * exact + 0.01, (n, d, p, others)


def plainly_sampled(pairs, d, d_word, known, sweeps, burn_in, rng):
    """Mean predictive probabilities by plain Gibbs: every customer of every context, and of the parent, leaves and sits down
    again by the seating of all others, the parent's included. `pairs`: counts by (context, word)."""
    seats = {k: [1] * n for k, n in pairs.items()}  # table sizes
    up = Counter()
    for (_, w), s in seats.items():
        up[w] += len(s)
    parent = {w: [1] * n for w, n in up.items()}
    share, total = 0.5 / known, sum(up.values())
    n_parent_tables = sum(map(len, parent.values()))
    in_context = Counter()
    for (c, _), s in seats.items():
        in_context[c] += len(s)
    sums, samples = Counter(), 0

    def choose(weights):
        x = rng.random() * sum(weights)
        for k, v in enumerate(weights):
            x -= v
            if x < 0:
                return k
        return len(weights) - 1

    def leave(tables):
        k = choose(tables)
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            return True
        return False

    def parent_joins(w):
        nonlocal total, n_parent_tables
        s = parent[w]
        k = choose([x - d_word for x in s] + [(lm.THETA_WORD + d_word * n_parent_tables) * share])
        if k == len(s):
            s.append(1)
            n_parent_tables += 1
        else:
            s[k] += 1
        total += 1

    def parent_leaves(w):
        nonlocal total, n_parent_tables
        n_parent_tables -= leave(parent[w])
        total -= 1

    for sweep in range(sweeps):
        for (c, w), s in seats.items():
            for _ in range(sum(s)):
                if leave(s):
                    in_context[c] -= 1
                    parent_leaves(w)
                t = parent[w]
                p = (sum(t) - d_word * len(t) + (lm.THETA_WORD + d_word * n_parent_tables) * share) / (lm.THETA_WORD + total)
                k = choose([x - d for x in s] + [(lm.THETA_PAIR + d * in_context[c]) * p])
                if k == len(s):
                    s.append(1)
                    in_context[c] += 1
                    parent_joins(w)
                else:
                    s[k] += 1
        for w, s in parent.items():
            for _ in range(sum(s)):
                parent_leaves(w)
                parent_joins(w)
        if sweep < burn_in:
            continue
        samples += 1
        unseen = min(0.95, max(0.05, known / n_parent_tables))
        of = lambda w: (max(0.0, sum(parent[w]) - d_word * len(parent[w])) + (lm.THETA_WORD + d_word * n_parent_tables) * (1 - unseen) / known) / (lm.THETA_WORD + total)
        sat = Counter()
        for (c, _), n in pairs.items():
            sat[c] += n
        for c in sat:
            for w in parent:
                s = seats.get((c, w), [])
                own = sum(s) - d * len(s)
                sums[c, w] += (own + (lm.THETA_PAIR + d * in_context[c]) * of(w)) / (lm.THETA_PAIR + sat[c])
    return {k: v / samples for k, v in sums.items()}


def test_scores_against_a_plain_sampler(monkeypatch):
    """A small corpus of few contexts, seated by plain Gibbs with the parent sampled along, against the operator's steps."""
    import pandas as pd

    monkeypatch.setattr(lm, "BURN_IN", 20)
    monkeypatch.setattr(lm, "SAMPLES", 60)
    rng = np.random.default_rng(5)
    p = np.array([0.3, 0.2, 0.12, 0.1, 0.08, 0.08, 0.06, 0.06])
    learned = ["a " + " ".join("ab"[rng.integers(2)] + " w" + str(rng.choice(8, p=p)) for _ in range(rng.integers(1, 5))) for _ in range(40)]
    asked = [f"{c} w{k}" for c in "ab" for k in range(8)]
    pdf = pd.DataFrame([(0, i, i, t.encode(), i < len(learned)) for i, t in enumerate(learned + asked)], columns=["_group", "_id", "_tie", "_text", "_flag"])
    none = np.zeros(0, dtype=np.uint64)
    to = lambda m, k: m[m["to"] == k]
    counted = lm._count(1, 1, none)((0,), pdf)
    tables = lm._first_tables(1, 1)((2,), to(counted, 2))
    parents = lm._parents(1, 1)((1,), to(counted, 1), to(tables, 1))
    seated = lm._seat(1, 1, none)((2,), to(counted, 2), to(parents, 2))
    words = lm._seat_words(1, 1)((1,), to(counted, 1), to(pd.concat([tables, seated]), 1))
    got = lm._score(1, none)((0,), pdf, to(pd.concat([seated, words]), 0)).set_index("doc_id")["score"]
    pairs = Counter()
    for t in learned:
        tokens = ["<s>", *t.split(), "</s>"]
        pairs.update(zip(tokens, tokens[1:]))
    first, once, twice = Counter(w for _, w in pairs), sum(n == 1 for n in pairs.values()), sum(n == 2 for n in pairs.values())
    d_word = lm.discount(sum(n == 1 for n in first.values()), sum(n == 2 for n in first.values()))
    want = plainly_sampled(pairs, lm.discount(once, twice), d_word, len(first), 220, 20, rng)
    off = []
    for i, t in enumerate(asked):
        tokens = ["<s>", *t.split(), "</s>"]
        exact = sum(math.log10(want[x]) for x in zip(tokens, tokens[1:]))
        off.append(got[len(learned) + i] - exact)
    assert max(map(abs, off)) < 0.1 and abs(np.mean(off)) < 0.04
