"""Periodic runs: every maximal repetition of a text's words, by suffix trees and Lyndon roots.

A run is a stretch of consecutive words with a smallest period, which no neighbouring word
extends.  Method: a suffix tree of the words (Ukkonen) and one of the reversed words, each
with an Euler tour over which a sparse table answers the lowest common ancestor of two
leaves in constant time: how far two places agree to the right and to the left.  For
either order of the alphabet, the longest Lyndon word at each place (up to the next
smaller suffix) is a candidate root; it is extended both ways by two such answers.  Every run
of at least two periods holds such a root.

Words that cannot lie in a run cut a text first: in a run of at least ``min_exponent``
periods every word occurs that often.  So words that occur less often in their piece
are cut out, again and again until nothing changes, for a whole block of texts at once.  A cut
word cannot extend a run either, so runs of the pieces are the runs of the text.  What is
left of ordinary prose is next to nothing; the trees see the rest, whole.

Rows: every row of the table gives one row; a null or empty text has no words and no
runs; equal rows give equal results; a null id is not planted.  Other columns are left out.
Memory: about 1 kB for each word of the longest piece that may hold a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MIN_EXPONENT, MIN_LENGTH = 4, 6
BLANKS = " \t\n\x0b\x0c\r"
#: Texts of about so many bytes are cut at once.
BLOCK_BYTES = 4 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
#: (doc_id, number of words) -> (first word, period) of a stretch that is overwritten up to the end, or None.
Plant = Callable[[object, int], tuple[int, int] | None]


class LongestCommon:
    """How far any two suffixes of ``symbols`` (positive integers) agree, each answer in constant time.

    ``ranks``: the suffixes' order, the empty one (least) included.
    """

    def __init__(self, symbols: list[int]):
        self.n = len(symbols)
        self._tree(symbols + [0])
        self._tour()

    def _tree(self, s: list[int]) -> None:
        """Ukkonen's construction; node 0 is the root, a leaf has no children."""
        n = len(s)
        start, end, link, children = [0], [0], [0], [{}]
        node = edge = length = remain = 0
        for i, c in enumerate(s):
            last = 0  # an inner node that still needs its suffix link
            remain += 1
            while remain:
                if not length:
                    edge = i
                kids = children[node]
                child = kids.get(s[edge])
                if child is None:
                    kids[s[edge]] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    children.append(None)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = (end[child] if end[child] <= i else i + 1) - start[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    at = start[child] + length
                    if s[at] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner = len(start)
                    kids[s[edge]] = inner
                    start += (start[child], i)
                    end += (at, n)
                    link += (0, 0)
                    children += ({c: inner + 1, s[at]: child}, None)
                    start[child] = at
                    if last:
                        link[last] = inner
                    last = inner
                remain -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remain + 1
        self._start, self._end, self._children = start, end, children

    def _tour(self) -> None:
        """Euler tour of string depths, first places of the leaves, and the sparse table of least depths."""
        n = self.n + 1
        start, end, children = self._start, self._end, self._children
        depths: list[int] = [0]
        first, order = [0] * n, []
        path = [(0, iter([v for _, v in sorted(children[0].items())]))]
        while path:
            depth, kids = path[-1]
            for child in kids:
                below = children[child]
                if below is None:
                    suffix = start[child] - depth
                    first[suffix] = len(depths)
                    order.append(suffix)
                    depths.append(n - suffix)
                    depths.append(depth)
                else:
                    deeper = depth + end[child] - start[child]
                    depths.append(deeper)
                    path.append((deeper, iter([v for _, v in sorted(below.items())])))
                    break
            else:
                path.pop()
                if path:
                    depths.append(path[-1][0])
        del self._start, self._end, self._children
        self.first = np.array(first)
        self.ranks = np.empty(n, np.int64)
        self.ranks[order] = np.arange(n)
        self.table = [np.array(depths, np.int32)]
        while 2 << (len(self.table) - 1) <= len(depths):
            half = 1 << (len(self.table) - 1)
            row = self.table[-1]
            self.table.append(np.minimum(row[:-half], row[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes at i and j (i != j; the length itself stands for the empty suffix)."""
        a, b = self.first[i], self.first[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k) + 1])
        return out


def next_smaller(values: list[int]) -> list[int]:
    """For each place the next one with a smaller value; the number of values where there is none."""
    out, stack = [len(values)] * len(values), []
    for j, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = j
        stack.append(j)
    return out


def maximal_runs(symbols: list[int], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_exponent`` (two or more) periods and ``min_length`` symbols."""
    n = len(symbols)
    if n < max(2, min_length):
        return []
    right = LongestCommon(symbols)
    places = np.arange(n)
    roots = []
    for ranks in (right.ranks, -right.ranks):
        after = np.array(next_smaller(ranks.tolist()))[:n]
        period = after - places
        fits = (after < n) & (period * min_exponent <= n)
        roots.append(np.stack([places[fits], period[fits]]))
    at, period = np.unique(np.concatenate(roots, axis=1), axis=1)
    if not len(at):
        return []
    more = right(at, at + period)
    maybe = more >= (min_exponent - 2) * period  # a run's first root has all of it but less than a period to its right
    at, period, more = at[maybe], period[maybe], more[maybe]
    if not len(at):
        return []
    left = LongestCommon(symbols[::-1])
    less = left(n - at, n - at - period)
    length = less + period + more
    ok = (length >= min_length) & (length >= period * min_exponent)
    found = np.unique(np.stack([at - less, length, period])[:, ok], axis=1)
    return sorted(map(tuple, found.T.tolist()), key=lambda r: (r[0], r[2]))


def pieces_with_runs(ids: np.ndarray, text: np.ndarray, min_exponent: int, min_length: int) -> list[tuple[int, int]]:
    """Ranges of places, each within one text, outside which no run of ``ids`` can lie."""
    at, piece = np.arange(len(ids)), text.astype(np.int64)
    names = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        _, back, often = np.unique(piece * names + ids[at], return_inverse=True, return_counts=True)
        stays = often[back.reshape(-1)] >= min_exponent
        at, was = at[stays], piece[stays]
        if not len(at):
            return []
        opens = np.r_[True, (at[1:] != at[:-1] + 1) | (was[1:] != was[:-1])]
        piece = np.cumsum(opens) - 1
        sizes = np.bincount(piece)
        long_ = sizes[piece] >= min_length
        if stays.all() and long_.all():
            heads = np.flatnonzero(opens)
            return [(int(at[h]), int(at[h]) + int(k)) for h, k in zip(heads, sizes)]
        at, piece = at[long_], piece[long_]
    return []


def _block(ids, texts: pa.Array, plant: Plant | None, min_exponent: int, min_length: int):
    """(n_runs, runs, kept words' text) of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_trim(texts.fill_null(""), characters=BLANKS))
    flat, edges = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    joined = pc.binary_join(split, " ")
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    place = np.arange(len(codes))
    counts = np.diff(edges)
    counts[pc.equal(joined, "").to_numpy(zero_copy_only=False)] = 0
    planted = {}
    if plant is not None:
        for i, (doc_id, n) in enumerate(zip(ids, counts.tolist())):
            if n and (found := plant(doc_id, n)) is not None:
                first, period = found
                lo, hi = int(edges[i]) + first, int(edges[i]) + n
                place[lo:hi] = lo + np.arange(hi - lo) % period
                planted[i] = True
        codes = codes[place]
    text = np.repeat(np.arange(len(counts)), np.diff(edges))
    runs: dict[int, list] = {}
    for lo, hi in pieces_with_runs(codes, text, min_exponent, min_length):
        i = int(text[lo])
        _, small = np.unique(codes[lo:hi], return_inverse=True)
        found = maximal_runs((small.reshape(-1) + 1).tolist(), min_exponent, min_length)
        if found:
            off = lo - int(edges[i])
            runs.setdefault(i, []).extend((start + off, length, period) for start, length, period in found)
    for i in range(len(counts)):
        mine = sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))
        if not mine and i not in planted:
            yield mine, joined[i].as_py()
            continue
        lo, n = int(edges[i]), int(counts[i])
        change = np.zeros(n + 1, np.int64)  # how many runs' repeated parts cover a word
        for start, length, period in mine:
            change[start + period] += 1
            change[start + length] -= 1
        stays = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        yield mine, pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(stays)], pa.int32()), flat.take(pa.array(place[lo + stays]))), " ")[0].as_py()


def _runs(plant: Plant | None, min_exponent: int, min_length: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_BYTES)) + 1
            for lo, hi in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(texts)].tolist()):
                ids = batch.column(0).slice(lo, hi - lo)
                got = list(_block(ids.to_pylist(), texts.slice(lo, hi - lo), plant, min_exponent, min_length))
                if got:
                    lists = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _ in got]
                    yield pa.record_batch([ids, pa.array(lists, schema[1].type), pa.array([x for _, x in got], pa.string())], schema=schema)

    return run


def periodic_runs(docs: DataFrame, plant: Plant | None = None, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, runs, collapsed) for every row: the runs by start and period, and the words, joined by one
    space, without those that a run repeats.  ``plant`` overwrites the end of chosen texts with a periodic stretch first."""
    schema = T.StructType().add(docs.schema["doc_id"]).add("runs", RUNS).add("collapsed", "string")
    return docs.select("doc_id", "text").mapInArrow(_runs(plant, min_exponent, min_length, to_arrow_schema(schema)), schema)
