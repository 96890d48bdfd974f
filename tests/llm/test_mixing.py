import re
from collections import defaultdict

from tidings.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, cycle=(5, 2, 1), most=3):
    """Shares by weight; what lies above the limit is dealt again until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: most * sizes[s] for s in free if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def check(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, s, t in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want, source_of, taken = targets(sizes), defaultdict(list), defaultdict(int)
    for d, s, t in rows:
        source_of[d, size(t)].append(s)
    assert len(got) == len(rows)
    for r in got:
        s = next(x for x in source_of[r.doc_id, r.size] if abs(want[x] - r.target) < 1e-6 * max(1, want[x]) and sizes[x] == r.source_size)
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] + 1e-6


def test_targets_and_thresholds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = mixing.digest(docs).collect()
    check(rows, got)
    assert sorted(map(tuple, mixing.digest(docs.repartition(3)).collect())) == sorted(map(tuple, got))


def test_hot_small_null_and_empty_sources(spark):
    rows = [(i, "hot", "w " * (1 + i % 9)) for i in range(500)] + [(i, "tiny", "a b") for i in range(600, 603)] + [(700, None, "c d e"), (701, None, None), (702, "zero", ""), (703, "é", "x")]
    rows += [(None, "hot", "n n"), (5, "hot", "w " * 6)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, source string, text string, mix_size string")
    check(rows, mixing.digest(df).collect())
    out = mixing.mix_sources(df)
    assert set(out.columns) == {"doc_id", "source", "text", "mix_size", "mix_source_size", "mix_target", "mix_copies"}
    assert mixing.digest(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 400_000, "a"), *((i, "few words here", "b") for i in range(2, 40))], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.digest(df).collect()}
    assert got[1]["size"] == 400_000 and got[1].taken in (0, 400_000, 800_000, 1_200_000) and len(got) == 39
