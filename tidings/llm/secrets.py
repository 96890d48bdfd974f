"""Secret scans by assignment-aware lexing.

Three fixed patterns find keyed assignments, access keys and long hexadecimal runs. Besides, `lexing` reads each text as
source or configuration into pairs of names and literals, through comments, multi-line strings, nested keys and sections,
and carries constants from assignment to assignment; a literal is reported if a name that it reaches is sensitive and the
value looks like a credential.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import free_name
from tidings.llm.lexing import Lexer, Value, literal_value

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of fewer are dropped, so none of these starts inside one
KINDS = ("assign", "access", "hex", "lexed")

#: Name parts that mark a sensitive target, with their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "privatekey": 1.0, "accesskey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "secretkey": 1.0, "sessionkey": 0.8, "connectionstring": 0.8, "dsn": 0.6,
}
#: Values that stand for a secret without being one.
PLACEHOLDER = re.compile(r"(?i)^(?:change_?me|example|placeholder|none|null|true|false|todo|your[-_ ].*|x{4,}|\*{3,}|<.*>|\$\{.*\}|%\(.*\)s)$")
REPORT_AT = 0.5
INHERITED = 0.75  # weight of a section, key or object around a name

_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^@\s]*$")


@lru_cache(maxsize=10_000)
def name_weight(name: str) -> float:
    """How sensitive a target name is, 0 to 1: the best of its parts and of neighbouring parts joined."""
    parts = [p for p in re.split(r"[^a-z0-9]+", _CAMEL.sub("_", name).lower()) if p]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in parts + joined), default=0.0)


def value_score(value: Value) -> float:
    """How much a value looks like a credential, 0 to 1, by length, mixture of characters and entropy."""
    n = value.n
    if n < 8 or PLACEHOLDER.match(value.edges) or any(c.isspace() for c in value.counts):
        return 0.0
    entropy = math.log2(n) - sum(c * math.log2(c) for c in value.counts.values()) / n
    kinds = {("a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-") for c in value.counts}
    if len(kinds) < 2:
        return 0.0
    return min(1.0, entropy / 3.0) * min(1.0, n / 12) * (0.8 if len(kinds) == 2 else 1.0)


def literal_score(text: str) -> float:
    return value_score(literal_value(text, 0, len(text)))


def _told(value: Value, names: list[str], around: tuple[str, ...]) -> None:
    """Note on a value the most sensitive name that it reaches. A name further out counts less, and not for plain addresses."""
    name = max(names, key=name_weight)
    weight = name_weight(name)
    outer = max(around, key=name_weight, default="")
    inherited = INHERITED * name_weight(outer) if outer else 0.0
    if inherited > weight and not _ADDRESS.match(value.edges):
        name, weight = f"{outer}.{name}", inherited
    if not weight:
        return
    for v in value.parts if value.separate else (value,):
        score = weight * value_score(v)
        if score > v.best:
            v.best, v.name = score, name


def lexed(text: str) -> list[tuple[int, int, str, float]]:
    """Literals that reach a sensitive name: start, end, name, score."""
    if "=" not in text and ":" not in text:
        return []
    lexer = Lexer(text)
    for names, around, value in lexer.pairs:
        _told(value, names, around)
    out: dict[tuple[int, int], tuple[float, str]] = {}
    for v in reversed(lexer.values):  # what a value is made of was made before it
        if v.best < REPORT_AT:
            continue
        for part in v.parts:
            if v.best > part.best:
                part.best, part.name = v.best, v.name
        if v.span and v.span[0] < v.span[1] and out.get(v.span, (0.0, ""))[0] < v.best:
            out[v.span] = (v.best, v.name)
    return [(s, e, n, round(score, 4)) for (s, e), (score, n) in sorted(out.items())]


def find_secrets(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind, in code points, the end exclusive. Null and empty texts have none.

    Spans of the lexer that lie inside a base span are left out; base spans always stay.
    """
    if not text:
        return []
    low, base = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        base += [("assign", *m.span(), m[1].lower(), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        base += [("access", *m.span(), "", 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    base += [("hex", *m.span(), "", 1.0) for m in HEX.finditer(text)]
    spans = base + [("lexed", s, e, n, v) for s, e, n, v in lexed(text) if not any(b[1] <= s and e <= b[2] for b in base)]
    spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [{"kind": k, "start": s, "end": e, "name": n, "score": v} for k, s, e, n, v in spans]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType()),
]))


@F.pandas_udf(SPANS)
def _secrets(texts: pd.Series) -> pd.Series:
    return pd.Series([find_secrets(t) for t in texts], dtype=object)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the column `secrets` (kind, start, end, name, score), replacing one of that name.

    Texts are read whole, row by row, without a shuffle. Null and empty texts, and those without a secret, get an empty
    array; repeated rows are scanned each by itself; an empty table stays empty; other columns are kept.
    """
    return docs.withColumn("secrets", _secrets(F.col(text)))


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def one(text, found):
        if text is None or found is None or not len(found):
            return text
        merged: list[list] = []
        for x in found:
            if merged and x["start"] < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], x["end"])
            else:
                merged.append([x["start"], x["end"], x["kind"]])
        parts, at = [], 0
        for s, e, kind in merged:
            parts += [text[at:s], f"[{kind} removed]"]
            at = e
        return "".join(parts) + text[at:]

    return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with each secret span of `text` replaced by a mark; overlapping spans count as one.

    Whole texts are read, however long. Null stays null, and empty texts and those without a secret stay as they are; equal
    rows stay equal; an empty table stays empty; all other columns, whatever their names, are kept.
    """
    found = free_name("_secrets", docs)
    scanned = docs.withColumn(found, _secrets(F.col(text)))
    return scanned.withColumn(text, _redacted(F.col(text), F.col(found))).drop(found)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op8: base counts, the digest of the base spans, and all spans."""
    s = F.col("secrets")
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    return scan_secrets(docs.select("doc_id", "text")).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter(s, lambda x: x["kind"] != "lexed")).cast("binary"), 256).alias("base_sha256"),
        _joined(s).alias("spans"))
