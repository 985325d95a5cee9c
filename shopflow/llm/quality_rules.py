"""Quality rules: a hashed word and character n-gram logistic regression after fixed base rules.

Base rules read counts of the whole text.  The classifier sees the shares of
hashed n-grams: runs of 3 and of 4 characters, and single words and pairs of
words, each family in its half of ``1 << BITS`` buckets.  A text's raw value is
the bias plus the mean weight of its character n-grams plus that of its word
n-grams, so its length does not matter.

Training takes the whole texts of all labelled rows.  A hash of id and text deals them to
blocks of some ``BLOCK_ROWS`` rows; each block takes gradient steps on the logistic loss
from the same start, and the weights are the mean of the blocks' weights (parameter averaging).
A class with few rows lends its rows to several blocks, so that each knows both classes.  One row in four
is kept from the steps, and all of these calibrate the mean model's raw values to probabilities by a fitted
slope and offset, from counts of the raw values in steps of 1 / ``RAW_STEPS``.  What is summed over tasks are whole
numbers, so the model does not depend on the partitions.  Only a caller that gives ``per_class`` learns from so many rows of each
class, those with the least hash (one bounded task); as both classes may then be
sampled at different rates, the offset is moved by the logarithm of the rates.
The trained weights and thresholds are fixed before any document is scored; then
Arrow batches of documents are scored apart from each other.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.llm import hashing as H
from shopflow.llm.common import kept_and_text, least_hashes, map_batches, text_list, written

BITS = 18
SCALE = 40.0
#: Labelled rows and characters of a block, on average, and rows of the rarer class that it should have.
BLOCK_ROWS, BLOCK_CHARS, BLOCK_RARE = 1000, 3_000_000, 100
#: Numbers that are gone through at once in a step.
STEP_CELLS = 1 << 16
#: Bytes of texts whose words are hashed at once.
STEP_BYTES = 1 << 18
#: Weights are added up as whole multiples of 1 / ``FIXED``, in ``PIECES`` parts.
FIXED, PIECES = float(1 << 40), 1024
#: Raw values are counted in steps of 1 / ``RAW_STEPS`` up to ``RAW_MOST`` either way.
RAW_STEPS, RAW_MOST = 256, 64
STEPS = 80
RATE = 0.25
DECAY = 1e-5
#: A document stays if its calibrated probability of good quality is at least this.
KEEP_AT = 0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Characters whose n-grams are hashed at once.
STEP_CHARS = 1 << 18

SYMBOLS = b"#*$%&|<>"  # fixed by the rule
WHITE = bytes([0x20, *range(0x09, 0x0E)])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__  # a new word gets the next number
    w = np.fromiter(map(number.__getitem__, words), np.int64, n + 2)
    pair = w[:-1] * len(number) + w[1:]
    if len(number) >= 1 << 21:  # else a window fits 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + w[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.minimum(np.searchsorted(twice, window), len(twice) - 1)] == window
    covered = np.zeros(n + 2, bool)
    for j in range(3):
        covered[j : j + n] |= twice
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); words are parted by 0x09-0x0D and 0x20."""
    data = text.encode()
    words = data.split()
    white, symbols = (len(data) - len(data.translate(None, signs)) for signs in (WHITE, SYMBOLS))
    return len(words), len(text) - white, symbols, duplicate_lines(data), repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def _run_buckets(c: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the runs of 3 and those of the runs of 4 of the code points ``c``, by their first one."""
    half = np.uint32((1 << (BITS - 1)) - 1)
    if len(c) < 3:
        return
    three = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    for x in (three, three[:-1] + c[3:] * np.uint32(0x27D4EB2F)):
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield (x >> np.uint32(13)) & half


def character_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all runs of 3 and of 4 characters, in steps of bounded size."""
    for lo in range(0, max(1, len(text)), STEP_CHARS):
        last = lo + STEP_CHARS >= len(text)  # the runs that reach into the next step are counted there
        for x in _run_buckets(np.frombuffer(text[lo : lo + STEP_CHARS + 3].encode("utf-32-le", "surrogatepass"), np.uint32)):
            yield x if last else x[:STEP_CHARS]


def _word_buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = 1 << (BITS - 1)
    pairs = H.mix(hashes[:-1] * np.uint64(3) + H.mix(hashes[1:]))
    return tuple((x & np.uint64(half - 1)).astype(np.int64) + half for x in (hashes, pairs))


def word_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of single words and of pairs of words."""
    return np.concatenate(_word_buckets(hashes))


class QualityModel:
    """Weights (``1 << BITS`` numbers), bias, calibration slope and offset."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def raw(self, text: str, hashes: np.ndarray) -> float:
        total, n = 0.0, 0
        for part in character_buckets(text):
            total, n = total + float(self.weights[part].sum(dtype=np.float64)), n + len(part)
        words = word_buckets(hashes)
        return self.bias + SCALE * (total / max(1, n) + float(self.weights[words].sum(dtype=np.float64)) / max(1, len(words)))

    def raws(self, texts: list[str], hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """``raw`` of each text; ``doc`` is the text number of each of ``hashes``.  Texts of all lengths, those over ``STEP_CHARS`` by themselves."""
        edge = np.searchsorted(doc, np.arange(len(texts) + 1))
        long = [i for i, t in enumerate(texts) if len(t) > STEP_CHARS]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        size[long] = 0
        codes = np.frombuffer("".join(["" if len(t) > STEP_CHARS else t for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(size) - size
        total, n = np.zeros(len(texts)), np.maximum(size - 2, 0) + np.maximum(size - 3, 0)
        for k, buckets in zip((3, 4), _run_buckets(codes)):
            has = np.flatnonzero(size >= k)
            if len(has):  # from a text's first run up to the one that would reach into the next text
                spans = np.stack([first[has], first[has] + size[has] - k + 1], 1).reshape(-1)
                total[has] += np.add.reduceat(np.append(self.weights.take(buckets), np.float32(0)), spans, dtype=np.float64)[::2]
        words = np.diff(edge)
        single, pair = _word_buckets(hashes)
        together = np.flatnonzero(doc[1:] == doc[:-1])
        by_words = (np.bincount(doc, self.weights.take(single), len(texts))
                    + np.bincount(doc[together], self.weights.take(pair[together]), len(texts)))
        out = self.bias + SCALE * (total / np.maximum(1, n) + by_words / np.maximum(1, words + np.maximum(words - 1, 0)))
        for i in long:
            out[i] = self.raw(texts[i], hashes[edge[i] : edge[i + 1]])
        return out

    def probability(self, raw):
        """Calibrated probability of good quality."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def _features(text: str, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of one text, equal buckets joined."""
    parts = list(character_buckets(text))
    words = word_buckets(hashes).astype(np.uint32)
    n_chars = sum(map(len, parts))
    idx = np.sort(np.concatenate([*parts, words]))  # the characters' half of the buckets comes first
    first = np.flatnonzero(np.concatenate([[True], idx[1:] != idx[:-1]])) if len(idx) else np.zeros(0, np.int64)
    n = np.diff(first, append=len(idx))
    return idx[first].astype(np.int32), (n * np.where(first < n_chars, SCALE / max(1, n_chars), SCALE / max(1, len(words)))).astype(np.float32)


def _calibrate(raw: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[float, float]:
    """Slope (0 or more) and offset that fit probabilities to ``y`` (smoothed targets, Newton steps); ``n``: rows that each value stands for."""
    n = np.ones(len(y)) if n is None else n
    n1, n0 = (n * y).sum(), (n * (1 - y)).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        s = n * (p * (1 - p) + 1e-9)
        g = np.array([(n * (p - target) * raw).sum() + 1e-3 * a, (n * (p - target)).sum()])
        h = np.array([[(s * raw * raw).sum() + 1e-3, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0] / max(1.0, np.abs(step).max()), b - step[1] / max(1.0, np.abs(step).max())
    return max(0.0, float(a)), float(b)


def _hashed(column: pa.Array) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Texts of an Arrow column (null: empty), block by block, with their words' hashes and the text number of each."""
    data, offsets = H.text_buffer(column)
    for lo, hi in H.blocks(offsets, STEP_BYTES):
        yield text_list(column.slice(lo, hi - lo)), *H.words(data, offsets[lo : hi + 1])


class Features:
    """Buckets and values of texts, by text and by bucket, for steps over all of them; only buckets that occur have a number here."""

    def __init__(self, texts: list[str]):
        rows = []
        for part, hashes, doc in _hashed(pa.array(texts, pa.large_string())):
            edge = np.searchsorted(doc, np.arange(len(part) + 1))
            rows += [_features(t, hashes[a:b]) for t, a, b in zip(part, edge[:-1], edge[1:])]
        rows = [(i, v) if len(i) else (np.zeros(1, np.int32), np.zeros(1, np.float32)) for i, v in rows]  # none is empty, for reduceat
        size = np.array([len(i) for i, _ in rows])
        idx, self.val = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        del rows
        self.first = np.cumsum(size) - size
        there = np.zeros(1 << BITS, bool)
        there[idx] = True
        self.buckets = np.flatnonzero(there)
        number = np.cumsum(there, dtype=np.int32) - np.int32(1)
        self.column = number[idx]
        del idx
        order = self.column.astype(np.int64)  # rising texts in each bucket; in place, as it is the largest array
        order <<= 32
        order |= np.arange(len(order), dtype=np.int32)
        order.sort()
        order &= 0xFFFFFFFF
        self.text = np.repeat(np.arange(len(size), dtype=np.int32), size)[order]
        self.by_bucket = self.val[order]
        n = np.bincount(self.column)
        self.bucket_first = np.cumsum(n) - n

    def _sums(self, x: np.ndarray, at: np.ndarray, val: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each i the sum of x[at] * val from first[i] up to the next, some ``STEP_CELLS`` at once."""
        out, lo = np.empty(len(first)), 0
        while lo < len(first):
            hi = max(lo + 1, int(np.searchsorted(first, first[lo] + STEP_CELLS)))
            a, b = int(first[lo]), int(first[hi]) if hi < len(first) else len(at)
            part = x.take(at[a:b])
            part *= val[a:b]
            out[lo:hi] = np.add.reduceat(part, first[lo:hi] - a)
            lo = hi
        return out

    def raws(self, w: np.ndarray) -> np.ndarray:
        """Each text's sum of value times its bucket's ``w``."""
        return self._sums(w, self.column, self.val, self.first)

    def gradient(self, g: np.ndarray) -> np.ndarray:
        """Each bucket's sum of value times its text's ``g``."""
        return self._sums(g, self.text, self.by_bucket, self.bucket_first)


def _steps(features: Features, y: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias after the gradient steps on the rows that are not ``held``; a bucket that does not occur keeps weight 0."""
    w, bias = np.zeros(len(features.buckets)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    weight = np.where(held, 0.0, 1.0)
    for c in (0.0, 1.0):  # both classes count alike in the steps
        weight[(y == c) & ~held] /= max(1, ((y == c) & ~held).sum())
    for t in range(1, STEPS + 1):
        g = (1 / (1 + np.exp(-np.clip(features.raws(w) + bias, -30, 30))) - y) * weight
        grad, gb = DECAY * w + features.gradient(g), g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
        bias -= RATE * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-6)
    whole = np.zeros(1 << BITS)
    whole[features.buckets] = w
    return whole, float(bias)


def _one_class(good: bool) -> QualityModel:
    """No row, or one class alone: no text is doubted."""
    return QualityModel(np.zeros(1 << BITS, np.float32), 0.0, 0.0, 50.0 if good else -50.0)


def fit(texts: list[str], y: np.ndarray, all_good: int, all_bad: int) -> QualityModel:
    """Train on rows in a fixed order; every fourth calibrates.  One class alone: no text is doubted."""
    y = np.asarray(y, np.float64)
    if not len(y) or y.min() == y.max():
        return _one_class(not len(y) or bool(y.max()))
    features = Features(texts)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    w, bias = _steps(features, y, held)
    raw = features.raws(w[features.buckets]) + bias
    use = held if held.any() else ~held
    slope, offset = _calibrate(raw[use], y[use])
    n1, n0 = y[use].sum(), len(y[use]) - y[use].sum()
    offset += np.log((all_good + 1) / (all_bad + 1)) - np.log((n1 + 1) / (n0 + 1))
    return QualityModel(w.astype(np.float32), bias, slope, float(offset))


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["h"], r["text"], r["good"]))
    good, bad = (rows[0]["all_good"], rows[0]["all_bad"]) if rows else (0, 0)
    model = fit([r["text"] for r in rows], np.array([r["good"] for r in rows]), good, bad)
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model.__dict__)]})


def _held():
    """One id in four is kept from the steps."""
    return F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0


def _pieces(total: np.ndarray) -> list[bytes]:
    return [p.tobytes() for p in np.array_split(total, PIECES)]


def _fit_block(table: pa.Table) -> pa.Table:
    """(block, place, text, good) of one block -> its weights with the bias last; nothing where one class is alone."""
    rows = table.sort_by([("place", "ascending")])
    y = rows["good"].to_numpy().astype(np.float64)
    parts = []
    if y.min() < y.max():
        w, bias = _steps(Features(rows["text"].to_pylist()), y, np.zeros(len(y), bool))
        parts = _pieces(np.rint(np.r_[w, bias] * FIXED).astype(np.int64))
    return pa.table({"piece": pa.array(range(len(parts)), pa.int32()), "weights": pa.array(parts, pa.binary())})


def _sum_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, weights) rows of a task added up, with the number of rows (whole numbers, so the order is all one)."""
    total: dict[int, np.ndarray] = {}
    n: dict[int, int] = {}
    for b in batches:
        for piece, x in zip(b.column(0).to_pylist(), b.column(1)):
            part = np.frombuffer(x.as_py(), np.int64)
            total[piece] = total[piece] + part if piece in total else part
            n[piece] = n.get(piece, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary()),
                                      pa.array([n[k] for k in total], pa.int64())], names=["piece", "weights", "n"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, of batches in the blocks' order."""
    rows: list[pa.RecordBatch] = []
    for b in batches:
        block = b.column(0).to_numpy()
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else []
        for lo, hi in zip(edges[:-1], edges[1:]):
            if rows and rows[-1].column(0)[0].as_py() != block[lo]:
                yield pa.Table.from_batches(rows)
                rows = []
            rows.append(b.slice(lo, hi - lo))
    if rows:
        yield pa.Table.from_batches(rows)


def _fit_blocks(fit_block):
    """A task fits its blocks one after the other and adds up their weights; one Python worker for both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sum_weights(part for block in _blocks(batches) for part in fit_block(block).to_batches())
    return run


def _sum_piece(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table["weights"].to_pylist())
    return pa.table({"piece": table["piece"].to_pylist()[:1], "weights": [total.tobytes()], "n": [sum(table["n"].to_pylist())]},
                    schema=pa.schema([("piece", pa.int32()), ("weights", pa.binary()), ("n", pa.int64())]))


def _raw_values(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(b.num_columns - 1)
            raws = np.concatenate([np.zeros(0), *(model.raws(*part) for part in _hashed(column))])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(raws, pa.float64())], names=[*b.schema.names[:-1], "raw"])
    return run


def _dealt(texts: DataFrame, found: DataFrame, apart: bool, blocks: int, copies: dict[int, int]) -> DataFrame:
    """(block, place, text, good) of the rows that take steps, a row of a class in as many blocks as ``copies`` says.

    Of texts that are kept from the steps none is shuffled: their ids tell.
    """
    stepping, rows = (texts.where(~_held()), found.where("not held")) if apart else (texts, found)
    labelled = (stepping.join(rows, ["doc_id", "h"])
                .groupBy("doc_id", "h", "good", "place").agg(F.min("text").alias("text")))
    lent = F.sequence(F.lit(0), F.when(F.col("good") == 1, copies[1]).otherwise(copies[0]) - 1)
    return labelled.select(F.explode(lent).alias("k"), "place", "text", "good").select(
        F.pmod(F.pmod("place", F.lit(blocks)) + F.col("k"), F.lit(blocks)).alias("block"), "place", "text", "good")


def _train_all(texts: DataFrame, found: DataFrame, n: int, n_good: int) -> QualityModel:
    """From all labelled rows: ``found`` has (doc_id, h, good, place, held, chars) of each, ``texts`` (doc_id, h, text)."""
    if n_good in (0, n):
        return _one_class(not n or n_good > 0)
    sides = {(r.good, r.held): r.n for r in found.groupBy("good", "held").agg(F.count("*").alias("n")).collect()}
    apart = len(sides) == 4  # else too few rows to keep some from the steps
    taught = {good: sides.get((good, False), 0) + (0 if apart else sides.get((good, True), 0)) for good in (0, 1)}
    blocks = max(1, math.ceil(n / BLOCK_ROWS), math.ceil(found.agg(F.sum("chars")).first()[0] / BLOCK_CHARS))
    rare = max(2, min(BLOCK_RARE, n // blocks // 10))
    copies = {good: min(blocks, math.ceil(rare * blocks / taught[good])) for good in (0, 1)}
    dealt = _dealt(texts, found, apart, blocks, copies).repartition("block").sortWithinPartitions("block")
    summed = (map_batches(dealt, _fit_blocks(_fit_block), "piece int, weights binary, n long")
              .groupBy("piece").applyInArrow(_sum_piece, "piece int, weights binary, n long"))
    parts = sorted(summed.collect(), key=lambda r: r.piece)  # PIECES rows, together one model
    if not parts:
        return _one_class(2 * n_good >= n)
    mean = np.concatenate([np.frombuffer(r.weights, np.int64) for r in parts]) / (FIXED * parts[0].n)
    model = QualityModel(mean[:-1].astype(np.float32), float(mean[-1]), 1.0, 0.0)
    raws = map_batches(texts.where(_held()) if apart else texts, _raw_values(model), T.StructType([*texts.schema.fields[:-1], T.StructField("raw", T.DoubleType())]))
    raws = raws.groupBy("doc_id", "h").agg(F.min("raw").alias("raw"))
    step = F.round(F.greatest(F.least("raw", F.lit(RAW_MOST)), F.lit(-RAW_MOST)) * RAW_STEPS).cast("int").alias("step")
    # at most one row for each step and class
    seen = found.join(raws, ["doc_id", "h"]).groupBy(step, "good").agg(F.count("*").alias("n")).orderBy("step", "good").toArrow()
    raw, y, rows = (seen[c].to_numpy().astype(np.float64) for c in ("step", "good", "n"))
    model.slope, offset = _calibrate(raw / RAW_STEPS, y, rows)
    n1, n0 = (rows * y).sum(), (rows * (1 - y)).sum()
    model.offset = float(offset + np.log((n_good + 1) / (n - n_good + 1)) - np.log((n1 + 1) / (n0 + 1)))
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int | None = None) -> QualityModel:
    """Learn from all ``docs`` whose ``labels.quality`` is 0 or 1; ids with both values, null ids and null texts teach nothing.

    Rows equal in id and text count once, in the steps and in the classes' sizes; labels
    without a row in ``docs`` count nowhere.  With ``per_class`` only so many rows of each class are learned from.
    """
    known = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("good"), F.max("quality").alias("__hi")).where("good = __hi").select("doc_id", "good"))
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = written(texts.select("doc_id", "h", F.length("text").alias("chars")).distinct().join(known, "doc_id")
                    .select("doc_id", "h", F.col("good").cast("int").alias("good"), F.xxhash64("h", "doc_id").alias("place"), _held().alias("held"), "chars"), "quality-rows")
    totals = found.agg(F.sum("good").alias("g"), F.count("*").alias("n")).first()
    if per_class is None:
        return _train_all(texts, found, totals.n, int(totals.g or 0))
    chosen = least_hashes(found, "good", "place", per_class).select("doc_id", "h", "good")
    # At most 2 * per_class narrow rows.
    rows = (texts.join(F.broadcast(chosen), ["doc_id", "h"]).groupBy("doc_id", "h", "good").agg(F.min("text").alias("text"))
            .select("h", "text", "good", F.lit(int(totals.g or 0)).alias("all_good"), F.lit(int(totals.n - (totals.g or 0))).alias("all_bad")))
    state = map_batches(rows.repartition(1), _fit_task, "model binary").first()
    model = QualityModel.__new__(QualityModel)
    if state is None:
        return fit([], np.zeros(0), 0, 0)
    model.__dict__.update(pickle.loads(state.model))
    return model


ADDED = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()),
         ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()), ("probability", T.DoubleType()), ("kept", T.BooleanType())]

_ARROW = {T.LongType: pa.int64(), T.BooleanType: pa.bool_(), T.DoubleType: pa.float64()}


def _score(model: QualityModel, keep_at: float, kept: int, at: int):
    """Of batches with ``kept`` columns to keep and the text in column ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for texts, hashes, doc in _hashed(b.column(at)):
                for text, p in zip(texts, model.probability(model.raws(texts, hashes, doc)).tolist()):
                    counts = base_counts(text)
                    failed = base_failed(counts[0], counts[4])
                    rows.append((*counts, failed, p, not failed and p >= keep_at))
            cols = zip(*rows) if rows else [()] * len(ADDED)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:kept], *(pa.array(x, _ARROW[type(t)]) for (_, t), x in zip(ADDED, cols))],
                names=[*b.schema.names[:kept], *(k for k, _ in ADDED)])
    return run


def apply_rules(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", keep_at: float = KEEP_AT,
                added: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the counts, ``base_failed``, ``probability`` and ``kept``.

    Null texts count as empty; they have no words and fail the base rules.  The added columns are
    named by ``added``, as in ``ADDED`` unless given; a column of ``keep`` that bears one of their names is left out.
    """
    added = added or [k for k, _ in ADDED]
    keep = [c for c in keep if c.lower() not in {a.lower() for a in added}]
    names = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField(n, docs.schema[c].dataType, True) for n, c in zip(names, keep)]
                          + [T.StructField(k, t, True) for k, t in ADDED])
    sent, at = kept_and_text(docs, keep, text)
    return map_batches(sent, _score(model, keep_at, len(keep), at), schema).toDF(*keep, *added)
