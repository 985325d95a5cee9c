"""Hierarchical Pitman-Yor language model over words, trained and scored in Spark.

Model.  Each context (the word before, in one of ``CONTEXTS`` hash buckets; a text's
first word and its end stand after a text's end) is a restaurant.  All context
restaurants share one parent, the unigram restaurant, whose base is uniform over
the V known words and one unknown word:

    P1(w)   = (K_w - d1 t_w + (a + d1 T1) / (V + 1)) / (a + K)
    P(w|b)  = (c_bw - d2 t_bw + (a + d2 T_b) P1(w)) / (a + c_b)

c_bw are the customers of dish w at restaurant b (training bigrams), t_bw the
tables they sit at, T_b and c_b the sums for b; a table of a context restaurant is
a customer of the parent: K_w is the sum of t_bw, t_w the parent's tables.

Gibbs sampling.  A sweep draws the tables of each (context, word) anew, given all
the others, from their conditional distribution with the tables' sizes summed out:
proportional to S(c, t) A^t, with S the generalised Stirling numbers of the
discount and A the weight of a new table, (a + d2 T_b) P1(w).  Customers beyond
the first ``EXACT`` of a dish are seated in growing blocks, each of which
opens a binomial number of tables.  Then the parent's tables are drawn likewise.
Every draw follows from the word, the context and the sweep, so scores do not depend on how
the words are dealt to slices.  Predictive probabilities are averaged over ``SAMPLES`` sweeps after ``BURN_IN``.

Spark.  (1) Texts become blobs of distinct (word, context, text, times), dealt to
slices by the word's hash, a very frequent word by word and context; so all
contexts of a word, its count and its parent's customers meet in one slice, and
the one large shuffle carries about five bytes for each bigram.  (2) Each slice
is written as one row: its pairs with counts and its occurrences.  (3) The restaurants' totals,
two numbers for each bucket and so of fixed size, are summed over slices by a
tree.  (4) Slices sweep with these totals held; their new totals are summed.
(5) Slices repeat the same draws, go on with the new totals, and score their
occurrences; the scores are summed by text.  Nothing else leaves the executors.
"""

from __future__ import annotations

import math
import statistics
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm import hashing as H
from shopflow.llm.common import written

CONTEXTS = 1 << 18
CONCENTRATION = 1.0
BURN_IN, SAMPLES = 3, 3
#: Customers of a dish whose seating is drawn exactly.
EXACT = 24
#: Text bytes of a blob's source, texts in it, and text bytes for each slice.
CHUNK_BYTES, CHUNK_TEXTS, SLICE_BYTES = 4 << 20, 30_000, 12 << 20
#: One text in so many is looked at to find very frequent words (this only decides where rows go: a word
#: dealt over several slices is seated as any other).
LOOK = 32
FAN_IN = 128
SEED = 20_240_101
_NORMAL = statistics.NormalDist()
_END = np.uint64(0x5851F42D4C957F2D)  # the end token's hash
_ROUTE = np.uint64(0x2545F4914F6CDD1D)


# ---- packing of integer arrays: one plane for each byte, compressed ----

def pack(*arrays: np.ndarray) -> bytes:
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        body = zlib.compress(planes, 1)
        out.append(np.array([a.itemsize, len(a), len(body)], "<i8").tobytes() + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays as unsigned integers of their width."""
    out, at = [], 0
    while at < len(data):
        width, n, size = np.frombuffer(data, "<i8", 3, at).tolist()
        planes = np.frombuffer(zlib.decompress(data[at + 24 : at + 24 + size]), np.uint8).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n))
        at += 24 + size
    return out


def context_of(words: np.ndarray) -> np.ndarray:
    return (H.mix(words ^ _ROUTE) & np.uint64(CONTEXTS - 1)).astype(np.int64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, context bucket, text number) of all tokens; each text's last is its end."""
    words, doc = H.words(data, offsets, lower=True)
    n = len(offsets) - 1
    out, at = np.full(len(words) + n, _END), np.empty(len(words) + n, np.int64)
    place = np.arange(len(words)) + doc  # each text before adds its end
    out[place], at[place] = words, doc
    ends = np.flatnonzero(np.isin(np.arange(len(out)), place, invert=True, assume_unique=True))
    at[ends] = np.arange(n)
    before = np.r_[np.full(min(1, len(out)), _END), out[:-1]]
    return out, context_of(before), at


# ---- 1: texts to blobs ----

def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for lo, hi in H.blocks(offsets, CHUNK_BYTES):
        for a in range(lo, hi, CHUNK_TEXTS):
            yield a, min(hi, a + CHUNK_TEXTS)


def _emit(n_slices: int, hot: np.ndarray):
    """Rows (doc_id, held_out, text) -> blobs (group, chunk, kind, data); kind D: the texts of a chunk, E: occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, held = b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = H.text_buffer(b.column(2))
            for lo, hi in _chunks(offsets):
                word, context, doc = tokens(data, offsets[lo : hi + 1])
                mine = ids.slice(lo, hi - lo)
                known = np.array(mine.is_valid().to_numpy(zero_copy_only=False), np.uint8)
                blob = pack(mine.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known,
                            held[lo:hi].astype(np.uint8), np.bincount(doc, minlength=hi - lo).astype(np.int64))
                rows = [(-1 - chunk % n_slices, chunk, "D", blob)]
                names, w = np.unique(word, return_inverse=True)
                key, times = np.unique((w.astype(np.int64) << 33) | (context << 15) | doc, return_counts=True)
                w, context, doc = key >> 33, (key >> 15) & (CONTEXTS - 1), key & 0x7FFF
                mark = (doc << 1) | ~held[lo:hi][doc]  # the last bit: a training text
                route = H.mix(names ^ _ROUTE)[w]
                often = np.isin(names, hot)[w]
                route[often] = H.mix(route[often] + context[often].astype(np.uint64))
                slice_ = (route % np.uint64(n_slices)).astype(np.int64)
                order = np.argsort(slice_, kind="stable")
                cuts = np.searchsorted(slice_[order], np.arange(n_slices + 1))
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    at = order[cuts[s] : cuts[s + 1]]
                    own, each = np.unique(w[at], return_counts=True)
                    rows.append((s, chunk, "E", pack(names[own], each.astype(np.uint32), context[at].astype(np.uint32),
                                                     mark[at].astype(np.uint16), times[at].astype(np.uint32))))
                chunk += 1
                for a in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                        zip(*rows[a : a + 512]), (pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                        names=["group", "chunk", "kind", "data"])
    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = H.text_buffer(b.column(0))
        for lo, hi in H.blocks(offsets, 1 << 20):
            word, _, _ = tokens(data, offsets[lo : hi + 1])
            names, n = np.unique(word, return_counts=True)
            many = n >= max(2, len(word) >> 12)  # at most 4096 of a block
            yield pa.RecordBatch.from_arrays([pa.array(names[many].view(np.int64)), pa.array(n[many]),
                                              pa.array(np.full(many.sum(), 0))], names=["word", "n", "total"])
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.array([len(word)])],
                                             names=["word", "n", "total"])


# ---- 2: blobs to slices ----

class Slice:
    """Words, their pairs with contexts and training counts, and the pairs' occurrences in texts."""

    def __init__(self, names, pair_word, pair_context, pair_count, chunks, occ_pair, occ_chunk, occ_mark, occ_times):
        self.names, self.pair_word, self.pair_context, self.pair_count = names, pair_word, pair_context, pair_count
        self.chunks, self.occ_pair, self.occ_chunk, self.occ_mark, self.occ_times = chunks, occ_pair, occ_chunk, occ_mark, occ_times

    @classmethod
    def gather(cls, blobs: list[tuple[int, bytes]]) -> Slice:
        parts = [(c, *unpack(x)) for c, x in sorted(blobs, key=lambda b: b[0])]
        names, back = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        key = np.repeat(back, np.concatenate([p[2] for p in parts]).astype(np.int64)) * CONTEXTS
        key += np.concatenate([p[3] for p in parts])
        order = np.argsort(key, kind="stable")
        key = key[order]
        chunk = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[3]) for p in parts])[order]
        mark, times = (np.concatenate([p[k] for p in parts])[order] for k in (4, 5))
        new = np.r_[True, key[1:] != key[:-1]][: len(key)]
        pairs, occ_pair = key[new], (np.cumsum(new) - 1).astype(np.int32)
        count = np.bincount(occ_pair, times * (mark & 1), len(pairs)).astype(np.int64)
        return cls(names, pairs // CONTEXTS, pairs % CONTEXTS, count, np.array([p[0] for p in parts], np.int64),
                   occ_pair, chunk, mark, times)

    def dump(self) -> bytes:
        per_word = np.bincount(self.pair_word, minlength=len(self.names))
        per_pair = np.bincount(self.occ_pair, minlength=len(self.pair_word))
        return pack(self.names, per_word.astype(np.uint32), self.pair_context.astype(np.uint32), self.pair_count.astype(np.uint64),
                    self.chunks, per_pair.astype(np.uint32), self.occ_chunk.astype(np.uint32), self.occ_mark.astype(np.uint16),
                    self.occ_times.astype(np.uint32))

    @classmethod
    def load(cls, data: bytes) -> Slice:
        names, per_word, context, count, chunks, per_pair, chunk, mark, times = unpack(data)
        return cls(names, np.repeat(np.arange(len(names)), per_word.astype(np.int64)), context.astype(np.int64), count.astype(np.int64),
                   chunks.view(np.int64), np.repeat(np.arange(len(context), dtype=np.int32), per_pair.astype(np.int64)), chunk, mark, times)


def _totals(s: Slice, hot: np.ndarray, tables: np.ndarray, parent_tables: np.ndarray) -> bytes:
    """What a slice adds to the totals: by bucket customers and tables; scalars; customers and tables of hot words."""
    trained = s.pair_count > 0
    customers = np.bincount(s.pair_context, s.pair_count, CONTEXTS).astype(np.int64)
    seated = np.bincount(s.pair_context, tables, CONTEXTS).astype(np.int64)
    word_count = np.bincount(s.pair_word, s.pair_count, len(s.names)).astype(np.int64)
    word_tables = np.bincount(s.pair_word, tables, len(s.names)).astype(np.int64)
    at = np.searchsorted(s.names, hot)
    at[at == len(s.names)] = 0
    here = (s.names[at] == hot) if len(s.names) else np.zeros(len(hot), bool)
    plain = ~np.isin(s.names, hot)
    scalars = np.array([word_count.sum(), (word_count[plain] > 0).sum(), (s.pair_count == 1).sum(), (s.pair_count == 2).sum(),
                        trained.sum(), word_tables.sum(), parent_tables[plain].sum(),
                        (word_tables[plain] == 1).sum(), (word_tables[plain] == 2).sum()], np.int64)
    return pack(customers, seated, scalars, np.where(here, word_count[at] if len(s.names) else 0, 0).astype(np.int64),
                np.where(here, word_tables[at] if len(s.names) else 0, 0).astype(np.int64))


def _gather(hot: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        if group < 0:  # the texts of chunks pass as they are
            return pa.table({"group": table.column("group"), "chunk": table.column("chunk"), "data": table.column("data"),
                             "totals": pa.nulls(len(table), pa.binary())})
        s = Slice.gather(list(zip(table.column("chunk").to_pylist(), table.column("data").to_pylist())))
        first = (s.pair_count > 0).astype(np.int64)  # one table for each dish to begin with
        known = np.bincount(s.pair_word, first, len(s.names)) > 0
        return pa.table({"group": [group], "chunk": pa.array([0], pa.int64()), "data": pa.array([s.dump()], pa.binary()),
                         "totals": pa.array([_totals(s, hot, first, known.astype(np.int64))], pa.binary())})
    return run


def _add(table: pa.Table) -> pa.Table:
    total = None
    for x in table.column("totals").to_pylist():
        arrays = [a.view(np.int64) for a in unpack(x)]
        total = arrays if total is None else [a + b for a, b in zip(total, arrays)]
    return pa.table({"group": [table.column("group")[0].as_py()], "totals": pa.array([pack(*total)], pa.binary())})


class Totals:
    """The restaurants' totals over all slices; their size is fixed by the number of buckets and hot words."""

    def __init__(self, arrays: list[np.ndarray], hot: np.ndarray, before: Totals | None = None):
        """``before``: the totals with which the burn-in was run, None before it."""
        self.customers, self.tables, s, self.hot_count, self.hot_tables = (a.astype(np.int64) for a in arrays)
        self.hot = hot
        self.n = int(s[0])
        self.v = int(s[1] + (self.hot_count > 0).sum())
        self.context_discount = _discount(s[2], s[3])
        self.parent_customers = int(s[5])
        self.parent_discount = _discount(*(s[7 + k] + (self.hot_tables == k + 1).sum() for k in (0, 1)))
        # of a word in several slices the parent's tables are drawn once more here, as they were drawn there
        parent = (self.hot_tables > 0) if before is None else parent_draws(hot, before.hot_tables, before, BURN_IN - 1)
        self.parent_tables = int(s[6] + parent.sum())


def _discount(ones: int, twos: int) -> float:
    """Estimated from how many were seen once and twice; within [0.1, 0.9]."""
    return float(min(0.9, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5)))


def summed(slices: DataFrame, hot: np.ndarray, before: Totals | None = None) -> Totals:
    """Totals over all slices, added up by a tree of ``FAN_IN``."""
    rows = slices.where("totals is not null").select(F.col("group"), "totals")
    n = rows.count()
    while n > 1:
        n = math.ceil(n / FAN_IN)
        rows = rows.withColumn("group", F.pmod(F.xxhash64("group"), F.lit(n))).groupBy("group").applyInArrow(_add, "group long, totals binary")
    got = rows.first()
    zero = np.zeros(CONTEXTS, np.int64)
    return Totals([zero, zero, np.zeros(9, np.int64), *[np.zeros(len(hot), np.int64)] * 2] if got is None
                  else [a.view(np.int64) for a in unpack(got.totals)], hot, before)


# ---- 4: seating ----

def stirling(discount: float, n: int = EXACT) -> np.ndarray:
    """log of the generalised Stirling numbers: [c, t] for up to n customers at t tables."""
    s = np.zeros((n + 1, n + 1))
    s[0, 0] = 1.0
    for c in range(n):
        s[c + 1, 1:] = s[c, :-1] + (c - discount * np.arange(1, n + 1)) * s[c, 1:]
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(s, 0))


class KeyedDraws:
    """Random numbers that follow from a dish's own key, the sweep and the count of numbers it has drawn, so that a
    dish is seated alike wherever it is dealt and whatever stands beside it."""

    def __init__(self, keys: np.ndarray, sweep: int):
        with np.errstate(over="ignore"):
            self.state = H.mix(keys + H.mix(np.full(1, SEED + sweep, np.uint64))[0])

    def uniform(self, at: np.ndarray) -> np.ndarray:
        """One more number in (0, 1) for each of the dishes ``at``."""
        with np.errstate(over="ignore"):
            self.state[at] = H.mix(self.state[at] + _ROUTE)
        return H.uniform(self.state[at])


def binomial(n: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Binomial numbers by inversion of ``u``; where many are expected, by the normal one's."""
    flip = p > 0.5
    got = _few(n, np.where(flip, 1 - p, p), np.where(flip, 1 - u, u))
    return np.where(flip, n - got, got)


def _few(n: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """``binomial`` for p up to a half."""
    out, mean = np.zeros(len(n), np.int64), n * p
    many = np.flatnonzero(mean > 200)
    for i in many.tolist():
        z = _NORMAL.inv_cdf(float(u[i]))
        out[i] = min(int(n[i]), max(0, round(mean[i] + z * math.sqrt(mean[i] * (1 - p[i])))))
    at = np.flatnonzero((mean > 0) & (mean <= 200))
    term = np.exp(n[at] * np.log1p(-p[at]))
    below, odds, k = term.copy(), p[at] / (1 - p[at]), 0
    live = np.flatnonzero(u[at] > below)
    while len(live):
        k += 1
        term[live] *= odds[live] * (n[at[live]] - k + 1) / k
        below[live] += term[live]
        out[at[live]] = np.minimum(k, n[at[live]])
        live = live[(u[at[live]] > below[live]) & (k < n[at[live]]) & ((term[live] > 1e-18) | (k < mean[at[live]]))]
    return out


def draw_tables(count: np.ndarray, weight: np.ndarray, discount: float, log_s: np.ndarray, draws: KeyedDraws) -> np.ndarray:
    """Tables of each dish given its customers and the weight of a new table; 0 for none, 1 for one customer."""
    out = (count > 0).astype(np.int64)
    log_w = np.log(np.maximum(weight, 1e-300))
    capped = np.minimum(count, EXACT)
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(capped == c)
        if len(at):
            t = np.arange(1, c + 1)
            z = log_s[c, 1 : c + 1] + log_w[at, None] * t
            p = np.exp(z - z.max(1, keepdims=True)).cumsum(1)
            out[at] = 1 + (p < draws.uniform(at)[:, None] * p[:, -1:]).sum(1)
    at = np.flatnonzero(count > EXACT)
    seated = EXACT
    while len(at):  # blocks of a quarter of those seated
        block = np.minimum(count[at] - seated, max(1, seated // 4))
        open_ = weight[at] / (weight[at] + seated + block / 2 - discount * out[at])
        out[at] += binomial(block, np.clip(open_, 0, 1), draws.uniform(at))
        seated += max(1, seated // 4)
        at = at[count[at] > seated]
    return out


def parent_draws(names: np.ndarray, customers: np.ndarray, totals: Totals, sweep: int) -> np.ndarray:
    """The parent's tables of each word: the same in every slice that holds the word."""
    new = (CONCENTRATION + totals.parent_discount * totals.parent_tables) / (totals.v + 1)
    return draw_tables(customers, np.full(len(names), new), totals.parent_discount, stirling(totals.parent_discount), KeyedDraws(names, -1 - sweep))


class Sampler:
    """A slice's seating.  What other slices may have a part in (a restaurant's totals, a word's customers at the
    parent) is held from one summation to the next, for frequent and rare words alike."""

    def __init__(self, s: Slice, totals: Totals):
        self.s, self.sweeps = s, 0
        self.word_count = np.bincount(s.pair_word, s.pair_count, len(s.names)).astype(np.int64)
        self.tables = (s.pair_count > 0).astype(np.int64)
        with np.errstate(over="ignore"):
            self.keys = H.mix(s.names[s.pair_word] + H.mix(s.pair_context.astype(np.uint64) + np.uint64(1)))
        self.hold(totals)
        self.parent = (self.customers > 0).astype(np.int64)

    def hold(self, totals: Totals) -> None:
        self.t = totals
        hot = np.searchsorted(totals.hot, self.s.names)
        if len(totals.hot):
            hot[hot == len(totals.hot)] = 0
            hot = np.where(totals.hot[hot] == self.s.names, hot, -1)
        else:
            hot = np.full(len(self.s.names), -1)
        shared = hot >= 0  # words that are dealt over several slices
        self.word_count[shared] = totals.hot_count[hot[shared]]
        self.customers = np.bincount(self.s.pair_word, self.tables, len(self.s.names)).astype(np.int64)  # K_w
        self.customers[shared] = totals.hot_tables[hot[shared]]
        self.log_context = stirling(totals.context_discount)

    def unigram(self) -> np.ndarray:
        t = self.t
        new = (CONCENTRATION + t.parent_discount * t.parent_tables) / (t.v + 1)
        seated = np.maximum(0.0, self.customers - t.parent_discount * self.parent * (self.word_count > 0))
        return (seated + new) / (CONCENTRATION + t.parent_customers)

    def context_weight(self) -> np.ndarray:
        """Weight of a new table at each pair's restaurant, for any dish."""
        return CONCENTRATION + self.t.context_discount * self.t.tables[self.s.pair_context]

    def sweep(self) -> None:
        weight = self.context_weight() * self.unigram()[self.s.pair_word]
        draws = KeyedDraws(self.keys, self.sweeps)
        self.tables = draw_tables(self.s.pair_count, weight, self.t.context_discount, self.log_context, draws)
        self.parent = parent_draws(self.s.names, self.customers, self.t, self.sweeps)
        self.sweeps += 1

    def predictive(self) -> np.ndarray:
        """P(word | context) of each pair."""
        t = self.t
        own = self.s.pair_count - t.context_discount * self.tables
        return (own + self.context_weight() * self.unigram()[self.s.pair_word]) / (CONCENTRATION + t.customers[self.s.pair_context])


def _seat(totals: Totals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for group, data in zip(b.column(0).to_pylist(), b.column(1)):
                sampler = Sampler(Slice.load(data.as_py()), totals)
                for _ in range(BURN_IN):
                    sampler.sweep()
                out = _totals(sampler.s, totals.hot, sampler.tables, sampler.parent)
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([out], pa.binary())], names=["group", "totals"])
    return run


# ---- 5: scoring ----

def _score(first: Totals, second: Totals):
    """Slices -> for each chunk the sums of its texts in this slice: (chunk, kind S, data)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for group, data in zip(b.column(0).to_pylist(), b.column(1)):
                s = Slice.load(data.as_py())
                sampler = Sampler(s, first)
                for _ in range(BURN_IN):
                    sampler.sweep()
                sampler.hold(second)
                mean = np.zeros(len(s.pair_word))
                for _ in range(SAMPLES):
                    sampler.sweep()
                    mean += sampler.predictive() / SAMPLES
                count = sampler.word_count[s.pair_word]
                # fixed steps, so that a text's sum is exact and the same whatever slices its words lie in
                pair_values = (np.round(np.log10(mean) * 2.0**20) / 2.0**20,
                               np.round(np.log10((count + 1) / (second.n + second.v + 1)) * 2.0**30) / 2.0**30, (count > 0).astype(float))
                texts, back = np.unique(s.occ_chunk.astype(np.int64) * (1 << 15) + (s.occ_mark >> 1), return_inverse=True)
                sums = [np.bincount(back, x[s.occ_pair] * s.occ_times, len(texts)) for x in pair_values]
                cuts = np.searchsorted(texts >> 15, np.arange(len(s.chunks) + 1))
                out = [(int(s.chunks[c]), "S", pack_sums(texts[a:z] & 0x7FFF, *(x[a:z] for x in sums)))
                       for c, (a, z) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if z > a]
                for a in range(0, len(out), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                        zip(*out[a : a + 256]), (pa.int64(), pa.string(), pa.binary()))], names=["chunk", "kind", "data"])
    return run


def pack_sums(text: np.ndarray, log_p: np.ndarray, base: np.ndarray, known: np.ndarray) -> bytes:
    """Sums of rising texts; scores as whole numbers of 2**-20 and 2**-30, so they add up the same in any order."""
    def fixed(x: np.ndarray, bits: int) -> np.ndarray:
        return np.round(x * 2.0**bits).astype(np.int64)

    return pack(np.diff(text, prepend=0).astype(np.uint16), fixed(log_p, 20), fixed(base, 30), known.astype(np.uint32))


def unpack_sums(data: bytes) -> tuple[np.ndarray, ...]:
    """(text, log_p, base, known), the scores still as whole numbers."""
    step, log_p, base, known = unpack(data)
    return np.cumsum(step.astype(np.int64)), log_p.view(np.int64), base.view(np.int64), known.astype(np.int64)


def _join_up(table: pa.Table) -> pa.Table:
    """All rows of one chunk: its texts and their sums in the slices."""
    kinds, blobs = table.column("kind").to_pylist(), table.column("data").to_pylist()
    texts = next(x for k, x in zip(kinds, blobs) if k == "D")
    ids, known_id, held, n_tokens = unpack(texts)
    sums = [np.zeros(len(ids), np.int64) for _ in range(3)]
    for x in (x for k, x in zip(kinds, blobs) if k == "S"):
        at, *parts = unpack_sums(x)
        for total, part in zip(sums, parts):
            total[at] += part
    return pa.table({
        "doc_id": pa.array(ids.view(np.int64), mask=known_id == 0), "held_out": pa.array(held.astype(bool)),
        "n_tokens": pa.array(n_tokens.view(np.int64)), "n_known": pa.array(sums[2]),
        "base_score": pa.array(sums[1] * 2.0**-30), "score": pa.array(sums[0] * 2.0**-20)})


def score_texts(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the texts for which the column ``held_out`` is not true, score all of them.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one
    row for each row of ``docs``.  Null texts count as empty: one token, the end.
    Repeated rows are repeated training text.  With no training text, V and N are 0
    and all words are equally unknown.  Scores are log10 probabilities.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n_slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SLICE_BYTES))
    seen = (rows.where(F.pmod(F.xxhash64("text"), F.lit(LOOK)) == 0).select("text")
            .mapInArrow(_frequent, "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    seen = written(seen, "lm-frequent")
    looked = seen.agg(F.sum("total").alias("t")).first().t or 0
    # at most 4 * n_slices words can have this share
    hot = np.sort(np.array([r.word for r in seen.where(F.col("n") * 4 * n_slices > max(looked, 1000)).select("word").collect()],
                           np.int64).view(np.uint64))
    blobs = rows.mapInArrow(_emit(n_slices, hot), "group long, chunk long, kind string, data binary")
    slices = written(blobs.groupBy("group").applyInArrow(_gather(hot), "group long, chunk long, data binary, totals binary"), "lm-slices")
    first = summed(slices, hot)
    seated = slices.where("group >= 0").select("group", "data").mapInArrow(_seat(first), "group long, totals binary")
    second = summed(written(seated, "lm-totals"), hot, first)
    # the counts are those of the first totals; only tables have changed
    sums = slices.where("group >= 0").select("group", "data").mapInArrow(_score(first, second), "chunk long, kind string, data binary")
    texts = slices.where("group < 0").select("chunk", F.lit("D").alias("kind"), "data")
    return (texts.unionByName(sums).groupBy("chunk").applyInArrow(
        _join_up, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(second.n).cast("long").alias("train_tokens"), "base_score", "score"))
