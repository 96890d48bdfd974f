import re
from collections import Counter

from tidings.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, rules string"


def brute(rows, line_docs, least_left=30):
    """All measures and verdicts by their definitions; rows: distinct (doc_id, text, source)."""

    def norm(line):
        return re.sub("[0-9]+", "0", re.sub(r"[ \t\x0b\f\r]+", " ", line.strip(" \t\n\x0b\f\r").lower()))

    has = lambda x: bool(WORD.search(x))
    count = Counter((s, k) for _, t, s in set(rows) for k in {norm(x) for x in (t or "").split("\n") if has(x)})
    out = []
    for d, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if has(x)]
        grams = Counter(zip(w, w[1:], w[2:]))
        cover = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        lost = sum(len(WORD.findall(x)) for x in lines if count[s, norm(x)] > line_docs)
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        kept = not failed and 100 * (len(w) - lost) >= least_left * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed, kept, lost))
    return sorted(out, key=str)


def test_brute_force(spark, sf):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"Shared  LINE {i} of this host\n{body} x{chr(97 + i)}", "h") for i in range(12)]
    rows += [(50 + i, "shared line 7 of this host\n" * 30, "h") for i in range(2)] + [(60, body, None), (None, body + "\n\n \n" + body, None)]
    rows += [(61, None, "h"), (62, "", None), (63, " \n\t", "h"), (64, "a b a b a b é#|", "h"), (65, "z " * 30_000, "g"), (0, rows[0][1], "h")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = rules.apply_rules(df, line_docs=10)
    assert set(got.columns) == {"doc_id", "text", "source", "rules"}
    flat = got.select("doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines", "rules.n_repeat_words", "rules.base_failed", "rules.kept", "rules.n_removed_words")
    assert sorted(map(tuple, flat.collect()), key=str) == brute(rows, 10)
    assert got.where("doc_id = 3").first()["rules"]["text"] == f"{body} xd"
    assert rules.digest(df.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    want = brute([tuple(r) for r in docs.collect()], rules.LINE_DOCS)
    assert sorted(map(tuple, rules.digest(docs).collect()), key=str) == want


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for made in (rules.digest(docs), rules.apply_rules(docs)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_very_long_text(spark):
    text = "\n".join(f"line {i} of a long text with words {i * 7919 % 1000}" for i in range(60_000))
    row = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    got = rules.digest(row).first()
    assert got.n_words == 60_000 * 9 and got.kept == (not got.base_failed)
