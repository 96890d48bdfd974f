"""Perplexity under a hierarchical Pitman-Yor model of word pairs.

Every context word has a restaurant: its followers are the dishes, their occurrences the customers. Each table is a customer
of the one parent restaurant, which all contexts share and whose base is a share for the unseen word and a uniform rest.
Seatings are sampled by Gibbs: customers leave and sit down again, at a table by its size less the discount, or at a new
one by the parent's probability. The predictive probability of a pair is averaged over the sampled seatings: in each it is
what the context's seating gives, and for the rest what the same sample's seating of the parent gives. While contexts are
seated, the parent's probabilities are those of one table for each pair; all their tables reach the parent afterwards, which
is then seated itself, once for each sample.

Counts, tables and probabilities never meet in one place. A group of documents sends each different pair of its own once;
a context's receiver merges them, seats the customers and answers; word receivers do the same for the parent. Contexts that
a sample shows to be very frequent are split by follower into shards, whose tables are summed by whoever asks; while it seats
customers, a shard takes the context's tables to be its own times the number of shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.blobs import dealt, hashed_words, join_blobs, pack, pack_common, pack_sorted, sizing, split_blobs, unpack, unpack_common, unpack_sorted
from tidings.llm.common import crc_mod, mix64, partitions_of
from tidings.llm.substr import _cuts

END = np.uint64(0x452821E638D01377)  # the token after a text's last word
START = np.uint64(0xBE5466CF34E90C6C)  # the context of its first
KEY = 40  # bits by which a follower is known within its context
THETA_PAIR, THETA_WORD = 0.5, 1.0
BURN_IN, SAMPLES = 4, 3
SEATED = 24  # pairs of up to so many customers are seated one by one; of larger ones the number of tables is drawn
HOT_SHARE, SHARDS = 0.005, 8
MESSAGE = "to int, kind string, at int, data binary"


def discount(once: float, twice: float) -> float:
    """The usual estimate from how many dishes have one and two customers."""
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.98)) if once else 0.5


class Tokens:
    """A group's tokens: `types` (ascending hashes), each token's type and pair, and how often training shows them."""

    def __init__(self, pdf: pd.DataFrame, hot: np.ndarray):
        words, n = hashed_words([bytes(t).lower() for t in pdf["_text"]])
        self.n = n + 1
        ends = np.cumsum(self.n)
        token = np.full(ends[-1], END, dtype=np.uint64)
        is_word = np.ones(len(token), dtype=bool)
        is_word[ends - 1] = False
        token[is_word] = words
        self.first = ends - self.n
        learned = np.repeat(pdf["_flag"].to_numpy(dtype=bool), self.n)
        self.n_learned = int(learned.sum())
        self.types, where = np.unique(np.append(token, START), return_inverse=True)
        self.token = where[:-1]
        self.type_count = np.bincount(self.token[learned], minlength=len(self.types))
        before = np.empty(len(token), dtype=np.int64)  # the type of each token's context
        before[1:] = self.token[:-1]
        before[self.first] = where[-1]
        split = np.isin(self.types, hot)
        self.contexts = np.sort(np.concatenate([self.types[~split], shards_of(self.types[split]).reshape(-1)]))
        self.context = np.searchsorted(self.contexts, self.types)[before]
        some = np.flatnonzero(split[before])
        self.context[some] = np.searchsorted(self.contexts, shard_of(self.types[before[some]], token[some]))
        self.shards = np.searchsorted(self.contexts, shards_of(self.types[split]))  # a row for each split context
        pair, self.pair = np.unique(self.context * len(self.types) + self.token, return_inverse=True)
        self.pair_context, self.pair_type = pair // len(self.types), pair % len(self.types)
        self.pair_count = np.bincount(self.pair[learned], minlength=len(pair))


def shards_of(contexts: np.ndarray) -> np.ndarray:
    """The names of the shards of frequent contexts: a row each."""
    return mix64(contexts[:, None] + np.arange(1, SHARDS + 1, dtype=np.uint64)[None, :])


def shard_of(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(context + (mix64(token) % np.uint64(SHARDS)) + np.uint64(1))


def short(x: np.ndarray) -> np.ndarray:
    return x >> np.uint64(64 - KEY)


# Receivers are numbered after the groups: words first, then contexts.


def _count(groups: int, parts: int, hot: np.ndarray):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        t, out = Tokens(pdf, hot), []
        at = _cuts(short(t.types), KEY, parts)
        for k in range(parts):  # word receivers hear from all, for the total
            s = slice(at[k], at[k + 1])
            head = np.array([t.n_learned], dtype=np.int64)
            out.append((groups + k, "words", key[0], join_blobs([pack(head), pack_sorted(t.types[s]), pack_common(t.type_count[s].astype(np.uint32))])))
        at = _cuts(short(t.contexts), KEY, parts)
        for k in np.flatnonzero(np.diff(at)):
            lo, hi = np.searchsorted(t.pair_context, at[k : k + 2])
            followers = np.bincount(t.pair_context[lo:hi] - at[k], minlength=at[k + 1] - at[k]).astype(np.uint32)
            blobs = [pack_sorted(t.contexts[at[k] : at[k + 1]]), pack_common(followers), pack(_stepped(short(t.types[t.pair_type[lo:hi]]), followers)), pack_common(t.pair_count[lo:hi].astype(np.uint32))]
            out.append((groups + parts + k, "pairs", key[0], join_blobs(blobs)))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _starts(followers: np.ndarray) -> np.ndarray:
    """Where each context's followers begin, for contexts that have any."""
    return (np.cumsum(followers) - followers)[followers > 0]


def _stepped(x: np.ndarray, followers: np.ndarray) -> np.ndarray:
    """Numbers that rise within each context: its first as it is, then the differences."""
    at = _starts(followers.astype(np.int64))
    out = np.diff(x, prepend=x.dtype.type(0))
    out[at] = x[at]
    return out


def _unstepped(x: np.ndarray, followers: np.ndarray) -> np.ndarray:
    at = _starts(followers.astype(np.int64))
    total = np.cumsum(x, dtype=x.dtype)
    lead = np.zeros(len(at), dtype=x.dtype)
    lead[1:] = total[at[1:] - 1]
    return total - np.repeat(lead, followers[followers > 0])


class Words:
    """What a word receiver knows: different types of all groups, how often training shows them, and their customers."""

    def __init__(self, rows: pd.DataFrame):
        self.askers, self.asked, counts, self.n_learned = [], [], [], 0
        for r in rows[rows["kind"] == "words"].itertuples(index=False):
            head, types, count = split_blobs(r.data)
            self.n_learned += int(unpack(head)[0])
            self.askers.append(r.at)
            self.asked.append(unpack_sorted(types))
            counts.append(unpack_common(count))
        self.types, inverse = np.unique(np.concatenate(self.asked or [np.zeros(0, dtype=np.uint64)]), return_inverse=True)
        self.count = np.bincount(inverse, weights=np.concatenate(counts or [np.zeros(0)]), minlength=len(self.types)).astype(np.int64)
        self.inverse = np.split(inverse, np.cumsum([len(a) for a in self.asked])[:-1]) if self.asked else []

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Types by their short keys; every key asked for is there."""
        return np.minimum(np.searchsorted(short(self.types), keys), max(0, len(self.types) - 1))


class Pairs:
    """What a context receiver knows: different pairs of all groups with their counts."""

    def __init__(self, rows: pd.DataFrame):
        self.askers, contexts, followers, keys, counts = [], [], [], [], []
        for r in rows[rows["kind"] == "pairs"].itertuples(index=False):
            a, b, c, d = split_blobs(r.data)
            self.askers.append(r.at)
            contexts.append(unpack_sorted(a))
            followers.append(unpack_common(b))
            keys.append(_unstepped(unpack(c), followers[-1]))
            counts.append(unpack_common(d))
        self.contexts, of = np.unique(np.concatenate(contexts or [np.zeros(0, dtype=np.uint64)]), return_inverse=True)
        self.asked_contexts = np.split(of, np.cumsum([len(c) for c in contexts])[:-1]) if contexts else []
        context = np.repeat(of, np.concatenate(followers or [np.zeros(0, dtype=np.int64)]))
        key = np.concatenate(keys or [np.zeros(0, dtype=np.uint64)])
        if len(self.contexts) < 1 << (64 - KEY):
            joint, inverse = np.unique((context.astype(np.uint64) << np.uint64(KEY)) | key, return_inverse=True)
            self.context, self.key = (joint >> np.uint64(KEY)).astype(np.int64), joint & np.uint64((1 << KEY) - 1)
        else:
            order = np.lexsort((key, context))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (context[order][1:] != context[order][:-1])
            inverse = np.empty(len(order), dtype=np.int64)
            inverse[order] = np.cumsum(new) - 1
            self.context, self.key = context[order][new], key[order][new]
        self.count = np.bincount(inverse, weights=np.concatenate(counts or [np.zeros(0)]), minlength=len(self.key)).astype(np.int64)
        self.inverse = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1]) if keys else []


def _first_tables(groups: int, parts: int):
    """Context receivers tell word receivers one table for each pair that training shows, and which words they need."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        out, me = [], int(key[0]) - groups - parts
        if 0 <= me < parts:
            p = Pairs(rows)
            seen = p.count > 0
            keys, inverse = np.unique(p.key[seen], return_inverse=True)
            tables = np.bincount(inverse, minlength=len(keys))
            needed = np.zeros(len(keys), dtype=bool)
            needed[inverse[p.count[seen] > 1]] = True
            head = np.array([seen.sum(), (p.count == 1).sum(), (p.count == 2).sum()], dtype=np.int64)
            at = _cuts(keys, KEY, parts)
            for k in range(parts):
                s = slice(at[k], at[k + 1])
                out.append((groups + k, "tables", me, join_blobs([pack(head), pack_sorted(keys[s]), pack(tables[s].astype(np.uint32)), pack(needed[s].astype(np.uint8))])))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _parents(groups: int, parts: int):
    """Word receivers, knowing all first tables, tell context receivers the parent's probability of the words they need."""

    def run(key, rows: pd.DataFrame, tables: pd.DataFrame) -> pd.DataFrame:
        out, me = [], int(key[0]) - groups
        if 0 <= me < parts and len(rows):
            w = Words(rows)
            customers, head, needs = _customers(w, tables)
            d = discount((customers == 1).sum(), (customers == 2).sum())
            known = int((w.count > 0).sum())
            base = (THETA_WORD + d * known * parts) * 0.5 / max(1, known * parts)  # words are spread evenly over receivers
            p = (np.maximum(customers - d, 0) + base) / (THETA_WORD + max(1, head[0]))
            for at, (keys, needed) in needs.items():
                out.append((groups + parts + at, "parents", me, join_blobs([pack(head), pack_sorted(keys[needed]), pack(p[w.find(keys[needed])].astype(np.float32))])))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _customers(w: Words, tables: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, dict]:
    """Customers of each word from the tables of all contexts, the totals of all senders, and who needs which words."""
    customers, total, needs = np.zeros(len(w.types), dtype=np.int64), np.zeros(3, dtype=np.int64), {}
    for r in tables[tables["kind"] == "tables"].itertuples(index=False):
        head, keys, n, needed = split_blobs(r.data)
        total += unpack(head)
        keys = unpack_sorted(keys)
        if len(keys):
            np.add.at(customers, w.find(keys), unpack(n).astype(np.int64))
        needs[r.at] = (keys, unpack(needed).astype(bool))
    return customers, total, needs


def _others(i: np.ndarray, total: np.ndarray, scale: np.ndarray, context: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Tables of the other dishes in the context of each dish."""
    return total[context[i]] * scale[context[i]] - tables[i]


def seatings(count: np.ndarray, parent: np.ndarray, context: np.ndarray, fixed: np.ndarray, scale: np.ndarray, d: float, theta: float, rng) -> Iterator[np.ndarray]:
    """Numbers of tables of dishes with two or more customers, for each sample after the burn-in.

    `fixed`: tables of each context's other dishes; `scale`: how many shards a context is split into. A sweep lets every
    customer of every dish leave and sit down again, dishes with equally many customers together; a context's tables are
    counted anew after each of these. Of dishes with over SEATED customers the number of tables is drawn at once: given the
    rest it has the weights S(n, t) * parent^t * prod(theta + d * tables so far), and as S(n, t + 1) / S(n, t) tends to
    1 / (t * d) for many customers, the tables beyond the first are negative binomial (at 25 customers of a word that the parent gives 0.1, 8 % off; from 500 on, under 1 %).
    """
    tables = np.ones(len(count), dtype=np.int64)
    by_count = [(c, np.flatnonzero(count == c)) for c in np.unique(count[count <= SEATED])]
    sizes = {c: np.concatenate([np.full((len(i), 1), c), np.zeros((len(i), c - 1), dtype=np.int64)], axis=1) for c, i in by_count if c > 2}
    large = np.flatnonzero(count > SEATED)
    total = fixed + np.bincount(context, weights=tables, minlength=len(fixed))

    def seated_anew(i: np.ndarray, now: np.ndarray) -> None:
        np.add.at(total, context[i], now - tables[i])
        tables[i] = now

    for sweep in range(BURN_IN + SAMPLES):
        for c, i in by_count:
            others = _others(i, total, scale, context, tables)
            if c == 2:  # one sits, the other joins or not; only the last to sit down matters
                fresh = (theta + d * (others + 1)) * parent[i]
                seated_anew(i, 1 + (rng.random(len(i)) * (fresh + 1 - d) < fresh))
                continue
            s, rows = sizes[c], np.arange(len(i))
            for _ in range(c):
                leaves = (np.cumsum(s, axis=1) <= (rng.random(len(i)) * s.sum(axis=1))[:, None]).sum(axis=1)
                s[rows, np.minimum(leaves, c - 1)] -= 1
                weight = np.cumsum(np.where(s > 0, s - d, 0.0), axis=1)
                fresh = (theta + d * (others + (s > 0).sum(axis=1))) * parent[i]
                to = (weight <= (rng.random(len(i)) * (weight[:, -1] + fresh))[:, None]).sum(axis=1)
                to = np.where(to == c, (s == 0).argmax(axis=1), to)
                s[rows, to] += 1
            seated_anew(i, (s > 0).sum(axis=1))
        if len(large):
            others = _others(large, total, scale, context, tables)
            further = rng.negative_binomial(theta / d + others + 1, 1 - np.clip(parent[large], 0, 1 - 1e-9))
            seated_anew(large, np.minimum(1 + further, count[large]))
        if sweep >= BURN_IN:
            yield tables.copy()


def _seat(groups: int, parts: int, hot: np.ndarray):
    """Context receivers seat their customers; they answer groups and tell word receivers the tables beyond the first."""
    split = np.sort(shards_of(hot).reshape(-1))

    def run(key, rows: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
        out, me = [], int(key[0]) - groups - parts
        if 0 <= me < parts and len(rows):
            p = Pairs(rows)
            keys, probability, head = [], [], np.zeros(3, dtype=np.int64)
            for r in parents[parents["kind"] == "parents"].sort_values("at").itertuples(index=False):
                head, k, x = split_blobs(r.data)
                head = unpack(head)
                keys.append(unpack_sorted(k))
                probability.append(unpack(x))
            keys, probability = np.concatenate(keys or [np.zeros(0, dtype=np.uint64)]), np.concatenate(probability or [np.zeros(0)])
            d = discount(head[1], head[2])
            many = np.flatnonzero(p.count > 1)
            parent = probability[np.searchsorted(keys, p.key[many])].astype(float) if len(many) else np.zeros(0)
            fixed = np.bincount(p.context[p.count == 1], minlength=len(p.contexts))
            scale = np.where(np.isin(p.contexts, split), SHARDS, 1)
            rng = np.random.default_rng([me, 11])
            samples = list(seatings(p.count[many], parent, p.context[many], fixed, scale, d, THETA_PAIR, rng))
            customers = np.bincount(p.context, weights=p.count, minlength=len(p.contexts)).astype(np.uint32)
            # Tables beyond the first, of contexts and of pairs: small numbers, and mostly none.
            totals = [np.bincount(p.context[many], weights=t - 1, minlength=len(fixed)).astype(np.uint32) for t in samples]
            dishes = np.bincount(p.context[p.count > 0], minlength=len(p.contexts)).astype(np.uint32)
            more = [np.zeros(len(p.count), dtype=np.uint32) for _ in samples]
            for x, t in zip(more, samples):
                x[many] = t - 1
            for at, contexts, inverse in zip(p.askers, p.asked_contexts, p.inverse):
                told = [customers[contexts], dishes[contexts], *(x[contexts] for x in totals), p.count[inverse].astype(np.uint32), *(x[inverse] for x in more)]
                out.append((at, "pairs", me, join_blobs([pack(np.array([d])), *map(pack_common, told)])))
            further, inverse = np.unique(p.key[many], return_inverse=True)
            at = _cuts(further, KEY, parts)
            sums = [np.bincount(inverse, weights=t - 1, minlength=len(further)).astype(np.uint32) for t in samples]
            for k in np.flatnonzero(np.diff(at)):
                s = slice(at[k], at[k + 1])
                out.append((groups + int(k), "further", me, join_blobs([pack_sorted(further[s]), *(pack(x[s]) for x in sums)])))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _seat_words(groups: int, parts: int):
    """Word receivers, knowing all tables of every sample, seat the parent's customers and answer groups."""

    def run(key, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out, me = [], int(key[0]) - groups
        if 0 <= me < parts and len(rows):
            w = Words(rows)
            first, head, _ = _customers(w, told)
            samples = [first.copy() for _ in range(SAMPLES)]
            for r in told[told["kind"] == "further"].itertuples(index=False):
                keys, *more = split_blobs(r.data)
                at = w.find(unpack_sorted(keys))
                for x, m in zip(samples, more):
                    np.add.at(x, at, unpack(m).astype(np.int64))
            d = discount((first == 1).sum(), (first == 2).sum())
            known = int((w.count > 0).sum())
            tables, rng = [], np.random.default_rng([me, 13])
            for x in samples:
                t = (x > 0).astype(np.int64)
                many = np.flatnonzero(x > 1)
                one = np.zeros(len(many), dtype=np.int64)
                share = np.full(len(many), 0.5 / max(1, known * parts))
                for last in seatings(x[many], share, one, np.array([(x == 1).sum()]), np.array([parts]), d, THETA_WORD, rng):
                    t[many] = last
                tables.append(t)
            sums = pack(np.array([[known, w.n_learned, x.sum(), d * t.sum(), t.sum()] for x, t in zip(samples, tables)]).reshape(-1))
            own = [np.maximum(x - d * t, 0).astype(np.float32) for x, t in zip(samples, tables)]
            for at, inverse in zip(w.askers, w.inverse):
                out.append((at, "words", me, join_blobs([sums, pack_common(w.count[inverse].astype(np.uint32)), *(pack_common(x[inverse]) for x in own)])))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _score(parts: int, hot: np.ndarray):
    def run(key, docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
        t = Tokens(docs, hot)
        heard = {(r.kind, r.at): split_blobs(r.data) for r in told.itertuples(index=False)}
        count, word = np.zeros(len(t.types), dtype=np.int64), np.zeros((SAMPLES, len(t.types)))
        sums, n_learned = np.zeros((SAMPLES, 5)), 0
        at = _cuts(short(t.types), KEY, parts)
        for k in range(parts):
            head, c, *own = (f(x) for f, x in zip([unpack, *[unpack_common] * (1 + SAMPLES)], heard["words", k]))
            s = slice(at[k], at[k + 1])
            sums += head.reshape(SAMPLES, 5)
            n_learned, count[s] = int(head[1]), c
            for x, y in zip(word, own):
                x[s] = y
        known = sums[0, 0]
        told = np.zeros((1 + SAMPLES, len(t.pair_context)))  # the pairs' customers and tables
        held = np.zeros((2 + SAMPLES, len(t.contexts)))  # the contexts' customers, dishes and tables beyond the first
        d, at = 0.0, _cuts(short(t.contexts), KEY, parts)
        for k in np.flatnonzero(np.diff(at)):
            s = slice(at[k], at[k + 1])
            lo, hi = np.searchsorted(t.pair_context, at[k : k + 2])
            head, *rest = heard["pairs", k]
            d = float(unpack(head)[0])
            for x, y in zip([*held[:, s], *told[:, lo:hi]], rest):
                x[:] = unpack_common(y)
        for shards in t.shards:  # a split context's seats and tables are its shards' together
            held[:, shards] = held[:, shards].sum(axis=1, keepdims=True)
        sat, pairs, probability = held[0, t.pair_context], told[0], np.zeros(len(t.pair_context))
        for k in range(SAMPLES):
            _, _, n, freed, tables = sums[k]  # `freed`: what all tables' discounts leave to the base
            unseen = np.clip(known / tables, 0.05, 0.95) if tables else 1.0
            parent = (word[k] + (THETA_WORD + freed) * np.where(count > 0, (1 - unseen) / max(1.0, known), unseen)) / (THETA_WORD + n)
            parent, seated = parent[t.pair_type], (held[1] + held[2 + k])[t.pair_context]
            own = np.where(pairs > 0, pairs - d * (1 + told[1 + k]), 0.0)
            probability += np.where(sat > 0, (own + (THETA_PAIR + d * seated) * parent) / (THETA_PAIR + sat), parent) / SAMPLES
        score = np.add.reduceat(np.log10(probability)[t.pair], t.first)
        base_score = np.add.reduceat(np.log10((count + 0.5) / (n_learned + 0.5 * (round(known) + 1)))[t.token], t.first)
        n_known = np.add.reduceat((count > 0).astype(np.int64)[t.token], t.first)
        return pd.DataFrame({
            "doc_id": docs["_id"].astype("Int64").to_numpy(), "learned": docs["_flag"].to_numpy(dtype=bool), "n_tokens": t.n, "n_known": n_known,
            "train_tokens": n_learned, "base_score": base_score, "score": score, "perplexity": 10.0 ** np.minimum(300, -score / t.n),
        })

    return run


def _frequent(docs: DataFrame, text: str) -> np.ndarray:
    """Contexts that a sample of documents shows to have more than HOT_SHARE of all followers.

    They decide how work is dealt, and, since shards estimate each other's tables, move scores a little (see the README)."""

    def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, counts = 0, {}
        for b in batches:
            hashes, _ = hashed_words([bytes(t).lower() for t in b["t"]])
            total += len(hashes) + len(b)
            for h, n in zip(*np.unique(hashes, return_counts=True)):
                if n > HOT_SHARE / 4 * len(hashes):
                    counts[h] = counts.get(h, 0) + int(n)
            counts[START] = counts.get(START, 0) + len(b)
        if total:
            rows = [(np.uint64(h).view(np.int64), n, 0) for h, n in counts.items()] + [(0, 0, total)]
            yield pd.DataFrame(rows, columns=["h", "n", "total"])

    sample = docs.where(F.pmod(F.xxhash64(F.lit(5), "doc_id", text), F.lit(64)) == 0)
    rows = sample.select(F.coalesce(text, F.lit("")).cast("binary").alias("t")).mapInPandas(top, "h long, n long, total long")
    rows = rows.groupBy("h").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    total = rows.agg(F.sum("total")).first()[0] or 0
    found = [r["h"] for r in rows.where(F.col("n") > HOT_SHARE * total).select("h").collect()] if total else []  # at most 1 / HOT_SHARE rows
    return np.sort(np.array(found, dtype=np.int64).view(np.uint64))


def score_texts(docs: DataFrame, learn: Column, *, text: str = "text") -> DataFrame:
    """doc_id, learned, n_tokens, n_known, train_tokens, base_score, score (log10 probability) and perplexity for each row of `docs`.

    Words are taken without case (ASCII); each text ends with an end token. The model learns from the rows for which
    `learn` holds, and scores all. Null texts count as empty: one end token. Without a row to learn from every token has
    probability 1. Equal rows score equally; texts are read whole, and a very long one makes its group, which one task holds,
    so much larger; an empty table stays empty; other columns are not read.
    """
    n, parts = sizing(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)
    n = max(24, n // 2)  # the larger the group, the fewer times a pair is sent
    hot = _frequent(docs, text)
    groups = dealt(docs, n, text, learn).groupBy("_group")
    counted = groups.applyInPandas(_count(n, parts, hot), MESSAGE).groupBy("to")
    # What two later steps read is dealt out by name, so that both read the same exchange and nobody is seated twice.
    tables = counted.applyInPandas(_first_tables(n, parts), MESSAGE).repartition(partitions_of(docs), "to")
    parents = counted.cogroup(tables.groupBy("to")).applyInPandas(_parents(n, parts), MESSAGE)
    seated = counted.cogroup(parents.groupBy("to")).applyInPandas(_seat(n, parts, hot), MESSAGE).repartition(partitions_of(docs), "to")
    # Unions of what is dealt alike need no new exchange.
    told = tables.unionByName(seated)
    words = counted.cogroup(told.groupBy("to")).applyInPandas(_seat_words(n, parts), MESSAGE).repartition(partitions_of(docs), "to")
    schema = "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return groups.cogroup(seated.unionByName(words).groupBy("to")).applyInPandas(_score(parts, hot), schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op3. Rows whose id hashes to 1 of 5 are held out of learning."""
    scored = score_texts(docs.select("doc_id", "text"), crc_mod(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
