"""Language ID by unigram pieces with all segmentations summed.

The pieces are those of a fixed public vocabulary (a parameter, the same for
all languages).  Each language has a probability for each piece.  A word (a run of
letters and marks, in lower case, with the vocabulary's word mark before it) has, in
a language, the sum over all its segmentations into pieces of the product of their
probabilities: the forward algorithm, from left to right over the word.  A text's
score is the sum of its words' logarithms; the language with the highest is
predicted, and ``score`` is its posterior under equal priors.

The piece probabilities are learned by expectation maximisation, starting from
equal ones: the expected uses of each piece over all segmentations (forward and
backward) of the training words.  Training counts the words of all distinct texts of each
language; only a caller that gives ``per_language`` learns from so many of them, those with the least hash.

A posterior says which language is likelier, not whether the text is any of them.  For that
there is ``fit``, the text's log likelihood for each of its letters in the predicted language,
and the model's ``least_fit`` for each language, learned from the same training texts.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.llm.common import kept_and_text, least_hashes, map_batches, text_list, worker_memo, written

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MARK = "▁"
#: More languages than this are refused: the model, one number for each piece and language, goes to all tasks.
MAX_LANGUAGES = 1_000
#: Of a language's training texts this share may fit worse than ``least_fit``, which lies ``SLACK`` (for each letter) lower still.
ODD, SLACK = 0.01, 1.0
ROUNDS = 2
#: Share of probability spread equally over all pieces, so none is impossible; a character that no
#: piece covers has one such share in every language.
FLOOR = 1e-2
LONGEST = 16
#: Of training words, only this many characters in a row are segmented at once; longer ones are cut.
TRAIN_CHARS = 48
#: Distinct words a task counts before it hands the counts on, and words whose segmentations one task sums.
COUNTED_WORDS, TASK_WORDS = 100_000, 150_000
#: If no more texts than this come twice, only their rows are moved to be made distinct.
REPEATED = 100_000
MEMO = 150_000
#: Words whose segmentations are summed at once, times the length of the longest.
CELLS = 100_000


_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER = np.uint64((1 << 18) - 1)


def _grow(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of runs that are one character longer."""
    with np.errstate(over="ignore"):
        x = (hashes ^ (hashes >> np.uint64(29))) * _BASE
        return x + codes.astype(np.uint64) + np.uint64(1)


def _hashes(runs: list[str], n: int) -> np.ndarray:
    """Hashes of runs of ``n`` characters each."""
    codes = np.array([[ord(c) for c in r] for r in runs], np.uint32).reshape(len(runs), n)
    h = np.zeros(len(runs), np.uint64)
    for k in range(n):
        h = _grow(h, codes[:, k])
    return h


class Pieces(dict):
    """Piece -> number, and for each length the pieces' hashes, sorted, with a bit table before them and one of the beginnings of longer pieces."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__(numbers)
        self.by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for n in range(1, max(map(len, numbers), default=1) + 1):
            own = [p for p in numbers if len(p) == n]
            h = _hashes(own, n)
            order = np.argsort(h)
            bits, more = np.zeros((2, int(_FILTER) + 1), bool)
            bits[h & _FILTER] = True
            more[_hashes(list({p[:n] for p in numbers if len(p) > n}), n) & _FILTER] = True
            self.by_length.append((h[order], np.array([numbers[own[i]] for i in order], np.int64), bits, more))


def vocabulary_pieces(path: str) -> Pieces:
    """Normal pieces of a sentencepiece model, up to ``LONGEST`` characters, by their number here."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Pieces({p: i for i, p in enumerate(p for p in pieces if len(p) <= LONGEST)})


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@functools.cache
def _plain_word() -> re.Pattern:
    """``WORD`` for texts without code points above U+FFFF, with the same letters and marks as a plain class."""
    all_ = "".join(map(chr, range(0x10000)))

    def of(kind: str) -> str:
        runs = regex.finditer(rf"[{kind}]+", all_)
        return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in runs)

    return re.compile(rf"[{of(r'\p{L}')}][{of(r'\p{L}\p{M}')}]*")


def letter_words(text: str) -> list[str]:
    text = text.lower()
    return (WORD if _ASTRAL.search(text) else _plain_word()).findall(text)


def lattice(words: list[str], pieces: Pieces) -> tuple[np.ndarray, ...]:
    """All places where a piece fits: (word number, start, end, piece), by rising end; -1 is a character without one.

    All words at once: the hash of each run of n characters grows from that of n - 1 and is looked up.
    """
    text = "".join([MARK + w for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), size)
    first = (np.cumsum(size) - size)[word]
    stop = first + size[word]
    at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    places, ends, found = [], [], []
    for n, (hashes, ids, bits, more) in enumerate(pieces.by_length, 1):
        if n > 1:  # go on where the run may begin a longer piece and the word has not ended
            on = np.flatnonzero(begins[low])
            on = on[at[on] + n <= stop[at[on]]]
            at, h = at[on], h[on]
        h = _grow(h, codes[at + n - 1])
        low = h & _FILTER
        hit = np.flatnonzero(bits[low])
        k = np.minimum(np.searchsorted(hashes, h[hit]), max(0, len(hashes) - 1))
        known = hashes[k] == h[hit] if len(hashes) else np.zeros(0, bool)
        hit, piece = hit[known], ids[k[known]] if len(hashes) else np.zeros(0, np.int64)
        if n == 1:  # every character is a place
            alone = np.full(len(at), -1)
            alone[hit] = piece
            hit, piece = np.arange(len(at)), alone
        begins = more
        places.append(at[hit])
        ends.append(at[hit] + n)
        found.append(piece)
    place, end, piece = np.concatenate(places), np.concatenate(ends), np.concatenate(found)
    w, zero = word[place], first[place]
    start, end = place - zero, end - zero
    order = np.argsort(end.astype(np.uint16) if size.max(initial=0) < 1 << 16 else end, kind="stable")
    return w[order], start[order], end[order], piece[order]


def forward(words: list[str], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """log probability of each word in each language; ``prob``: (pieces + 1, languages), the last row for ``-1``."""
    out = np.empty((len(words), prob.shape[1]))
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    size = size[order] + 2
    lo = 0
    while lo < len(order):  # words of like length together, a bounded number of cells
        n = np.arange(1, min(len(order) - lo, CELLS))
        hi = lo + 1 + int(np.searchsorted(n * size[lo + 1 : lo + 1 + len(n)], CELLS))
        part = order[lo:hi]
        out[part] = _forward([words[i] for i in part], pieces, prob)
        lo = hi
    return out


def _forward(words: list[str], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    langs, lengths = prob.shape[1], np.array([len(w) + 1 for w in words])
    w, start, end, piece = lattice(words, pieces)
    steps = np.searchsorted(end, np.arange(1, lengths.max() + 2)).tolist()
    alpha = np.zeros((LONGEST + 1, len(words), langs))  # the last columns, in turn
    alpha[0] = 1.0
    scale = np.zeros((len(words), langs))
    out = np.zeros((len(words), langs))
    for e in range(1, lengths.max() + 1):
        now = slice(steps[e - 1], steps[e])
        column = np.zeros((len(words), langs))
        # by rising length of the piece, so by falling start; of one length a word has one piece that ends here
        sizes = e - start[now]
        edges = steps[e - 1] + np.searchsorted(sizes, np.arange(1, LONGEST + 2))
        for n, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()), 1):
            if lo < hi:
                column[w[lo:hi]] += alpha[(e - n) % (LONGEST + 1)].take(w[lo:hi], 0) * prob.take(piece[lo:hi], 0)
        alpha[e % (LONGEST + 1)] = column
        if e % 8 == 0:  # against underflow: what counts is relative to the largest kept column
            top = alpha.max(0)
            top[top == 0] = 1.0
            alpha /= top
            scale += np.log(top)
        done = lengths == e
        if done.any():
            out[done] = np.log(alpha[e % (LONGEST + 1)][done]) + scale[done]
    return out


def expected_uses(words: list[str], weights: np.ndarray, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in one language (a column of ``prob``) over all segmentations."""
    total = np.zeros(len(prob))
    for lo in range(0, len(words), 4096):
        part, weight = words[lo : lo + 4096], weights[lo : lo + 4096]
        lengths = np.array([len(x) + 1 for x in part])
        w, start, end, piece = lattice(part, pieces)
        cell = lengths.max() + 1
        fore, back = np.zeros((len(part), cell)), np.zeros((len(part), cell))
        fore[:, 0] = 1.0
        back[np.arange(len(part)), lengths] = 1.0
        p = prob[piece]
        steps = np.searchsorted(end, np.arange(1, cell + 1))
        for e in range(1, cell):
            now = slice(steps[e - 1], steps[e])
            np.add.at(fore, (w[now], end[now]), fore[w[now], start[now]] * p[now])
        by_start = np.argsort(start, kind="stable")
        edges = np.searchsorted(start[by_start], np.arange(cell + 1))
        for s in range(cell - 2, -1, -1):
            now = by_start[edges[s] : edges[s + 1]]
            np.add.at(back, (w[now], start[now]), back[w[now], end[now]] * p[now])
        whole = fore[np.arange(len(part)), lengths]
        np.add.at(total, piece, fore[w, start] * p * back[w, end] / whole[w] * weight[w])
    return total


def _train_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of (lang, text) rows; a word comes once for each ``COUNTED_WORDS`` distinct ones."""
    by: dict[str, Counter] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, c in by.items():
            items = list(c.items())
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([k for k, _ in part]),
                                                  pa.array([v for _, v in part], pa.int64())], names=["lang", "word", "n"])
        by.clear()

    for b in batches:
        for lo in range(0, b.num_rows, 500):
            part = b.slice(lo, 500)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = letter_words(text)
                if max(map(len, words), default=0) > TRAIN_CHARS:
                    words = [w[i : i + TRAIN_CHARS] for w in words for i in range(0, len(w), TRAIN_CHARS)]
                by.setdefault(lang, Counter()).update(words)
            if sum(map(len, by.values())) > COUNTED_WORDS:
                yield from counted()
    yield from counted()


def _expect(vocabulary: str, langs: list[str], prob: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_memo(("pieces", vocabulary), lambda: vocabulary_pieces(vocabulary))
        total = np.zeros_like(prob)
        for b in batches:
            lang, n = np.array(b.column(0).to_pylist()), b.column(2).to_numpy(zero_copy_only=False).astype(float)
            words = b.column(1).to_pylist()
            for k, name in enumerate(langs):
                at = np.flatnonzero(lang == name)
                if len(at):
                    total[:, k] += expected_uses([words[i] for i in at], n[at], pieces, prob[:, k])
        piece, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(piece, pa.int64()), pa.array(total[piece, k])],
                                         names=["k", "piece", "uses"])
    return run


class LanguageModel:
    """Languages and their piece probabilities (bounded by vocabulary x languages)."""

    def __init__(self, vocabulary: str, langs: list[str], prob: np.ndarray):
        self.vocabulary, self.langs, self.prob = vocabulary, langs, prob
        self.least_fit = dict.fromkeys(langs, -np.inf)


def _least_hash_texts(rows: DataFrame, per_language: int) -> DataFrame:
    """The ``per_language`` distinct texts of least hash of each language."""
    rows = rows.withColumn("h", F.xxhash64("text"))
    chosen = least_hashes(written(rows.select("lang", "h").distinct(), "langid-texts"), "lang", "h", per_language)
    # at most per_language narrow rows of each language
    return rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """The distinct (lang, text) rows; where few texts come twice, the others stay where they are."""
    hashed = rows.withColumn("h", F.xxhash64("text"))
    repeated = written(hashed.groupBy("lang", "h").agg(F.count("*").alias("n")).where("n > 1").select("lang", "h"), "langid-repeated")
    if repeated.count() > REPEATED:
        return rows.distinct()
    once, more = (hashed.join(F.broadcast(repeated), ["lang", "h"], how).select("lang", "text") for how in ("left_anti", "left_semi"))
    return once.unionByName(more.distinct())


def train(labelled: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang",
          per_language: int | None = None, rounds: int = ROUNDS, fits: bool = True) -> LanguageModel:
    """Learn piece probabilities from all rows with a language; rows without language or text teach nothing.

    Repeated rows of a language count once.  With ``per_language`` only so many distinct texts of each
    language are learned from.  Without ``fits`` the model has no ``least_fit`` (see ``least_fits``), and the texts are read once.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    teaching = _distinct_texts(rows) if per_language is None else _least_hash_texts(rows, per_language)
    if fits:
        teaching = written(teaching, "langid-teaching")
    counts = written(map_batches(teaching, _train_words, "lang string, word string, n long")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    n = len(vocabulary_pieces(vocabulary))
    prob = np.full((n + 1, max(1, len(langs))), 1.0 / n)
    spread = counts.repartition(max(1, math.ceil(counts.count() / TASK_WORDS)), "word")
    for _ in range(rounds if langs else 0):
        uses = np.zeros_like(prob)
        # at most pieces x languages rows
        got = (map_batches(spread, _expect(vocabulary, langs, prob), "k long, piece long, uses double")
               .groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toArrow())
        uses[got["piece"].to_numpy(), got["k"].to_numpy()] = got["uses"].to_numpy()
        uses[-1] = 0
        share = uses / np.maximum(uses.sum(0), 1e-300)
        prob = (1 - FLOOR) * share + FLOOR / n
        prob[-1] = FLOOR / n
    model = LanguageModel(vocabulary, langs, prob)
    if langs and fits:
        model.least_fit |= least_fits(predict(teaching, model, ["lang"], added=["lang_pred", "score", "fit"]))
    return model


def least_fits(scored: DataFrame, lang: str = "lang", lang_pred: str = "lang_pred", fit: str = "fit") -> dict[str, float]:
    """Per language what all but ``ODD`` of the texts that are rightly predicted reach, less ``SLACK``."""
    low = scored.where(F.col(lang) == F.col(lang_pred)).groupBy(F.col(lang).alias("lang")).agg(F.percentile_approx(fit, ODD, 10_000).alias("fit"))
    return {r.lang: r.fit - SLACK for r in low.collect()}  # one row for each language


class WordScores:
    """The worker's memo of word scores; at most ``MEMO`` words, it only saves time."""

    def __init__(self, model: LanguageModel):
        self.pieces = worker_memo(("pieces", model.vocabulary), lambda: vocabulary_pieces(model.vocabulary))
        self.model, self.index = model, {}
        self.scores = np.zeros((0, model.prob.shape[1]))

    def texts(self, texts: list[str]) -> list[tuple[np.ndarray, int] | None]:
        """Per text its log probability in each language and its letters; None where it has no letter."""
        found = [letter_words(t) for t in texts]
        if len(self.index) > MEMO:
            self.index, self.scores = {}, self.scores[:0]
        new = list(set().union(*found).difference(self.index)) if found else []
        if new:
            self.index.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            self.scores = np.concatenate([self.scores, forward(new, self.pieces, self.model.prob)])
        get = self.index.__getitem__
        return [(self.scores[np.fromiter(map(get, w), np.int64, len(w))].sum(0), sum(map(len, w))) if w else None for w in found]


def _predict(model: LanguageModel, kept: int, at: int):
    """Of batches with ``kept`` columns to keep and the text in column ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScores(model)
        for b in batches:
            langs, scores, fits = [], [], []
            for lo in range(0, b.num_rows, 500):
                for got in scorer.texts(text_list(b.column(at).slice(lo, 500))):
                    if got is None or not model.langs:
                        langs.append("und")
                        scores.append(0.0)
                        fits.append(None)
                    else:
                        ll, letters = got
                        k = int(np.argmax(ll))  # of equal ones the first name
                        langs.append(model.langs[k])
                        scores.append(float(1.0 / np.exp(ll - ll[k]).sum()))
                        fits.append(float(ll[k]) / letters)
            yield pa.RecordBatch.from_arrays([*b.columns[:kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.float64())],
                                             names=[*b.schema.names[:kept], "lang_pred", "score", "fit"])
    return run


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text", added: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``; with three names in ``added``, also ``fit``.

    ``lang_pred`` is ``und``, ``score`` 0 and ``fit`` null where the text is null or has no letter, or
    nothing was learned; of equally likely languages the first name wins.  Only the
    text is read for the prediction.  The added columns are named by ``added``; a column
    of ``keep`` that bears one of their names is left out.
    """
    added = added or ["lang_pred", "score"]
    keep = [c for c in keep if c.lower() not in {a.lower() for a in added}]
    names = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField(n, docs.schema[c].dataType, True) for n, c in zip(names, keep)]
                          + [T.StructField("lang_pred", T.StringType(), True), T.StructField("score", T.DoubleType(), True),
                             T.StructField("fit", T.DoubleType(), True)])
    sent, at = kept_and_text(docs, keep, text)
    got = map_batches(sent, _predict(model, len(keep), at), schema)
    return got.select(*names, *["lang_pred", "score", "fit"][: len(added)]).toDF(*keep, *added)
