"""Byte-level BPE: ranked merges folded over the bytes of distinct words; decoding by concatenation.

A rank file gives each piece (bytes) its rank, which is its id.  A word (one match of
the pattern) starts as its bytes; as long as two neighbours together are a piece,
the pair of least rank (the first of equal ones) becomes one.  Words are merged
apart from each other, so each distinct word is folded once.

Two forms of the same fold:

* ``fold_words``: Spark higher-order functions over a column of distinct words with
  the rank map as a literal (a constant array of small maps, as an ``element_at`` on
  one large map compares its keys one by one).
* ``encode``: the whole-table form.  Arrow batches; the distinct words of a slice of
  texts are folded in Python against the same rank map, with a bounded memo.
  The README says, with figures, why whole tables take this one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.llm.common import quoted, slices, space_cuts, text_list, worker_memo

#: White space of the pattern: the Unicode property, said in full as libraries differ on U+001C-U+001F.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MEMO = 1_000_000
#: Stands for a pair that is no piece; above every rank.
NO_RANK = 1 << 60
BUCKETS = 1 << 15


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def word_pattern(pattern: str) -> str:
    """``pattern`` with its white space said in full."""
    return pattern.replace(r"[^\s", rf"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")


def fold(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one word."""
    whole = ranks.get(word)
    if whole is not None:
        return (whole,)
    parts = [word[i : i + 1] for i in range(len(word))]
    get = ranks.get
    near = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]  # rank of each neighbouring pair
    while near:
        least = min(near)
        if least == NO_RANK:
            break
        i = near.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del near[i]
        if i < len(near):
            near[i] = get(parts[i] + parts[i + 1], NO_RANK)
        if i:
            near[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
    return tuple([ranks[p] for p in parts])


def fold_long(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """As ``fold``, for long words: a heap of pairs instead of a scan for each merge."""
    import heapq

    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, size = heapq.heappop(heap)
        j = after[i]
        if piece[i] is None or j >= n or len(piece[i]) + len(piece[j]) != size or ranks.get(piece[i] + piece[j]) != rank:
            continue  # one of the two has been merged since
        piece[i] += piece[j]
        piece[j] = None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (r, a, len(piece[a]) + len(piece[b])))
    return tuple(ranks[p] for p in piece if p is not None)


class ByteBPE:
    """Encoder and decoder of a rank file; the memos hold at most about ``MEMO`` entries each and only save time.

    Texts are cut at spaces where the pattern always starts a new word
    (``space_cuts``); each distinct cut is matched and each distinct word folded once.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pieces = dict(zip(self.ranks.values(), self.ranks.keys()))
        self.text = {i: b"%d" % i for i in self.pieces}
        self.words = regex.compile(word_pattern(pattern))
        self.first: dict[str, tuple[int, ...]] = {}
        self.after: dict[str, tuple[int, ...]] = {}
        self.folded: dict[str, tuple[int, ...]] = {}  # by word

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self.folded.get(word)
        if ids is None:
            data = word.encode()
            ids = self.folded[word] = fold(data, self.ranks) if len(data) <= 64 else fold_long(data, self.ranks)
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._word, self.words.findall(piece))))

    def encode(self, text: str) -> list[int]:
        parts = space_cuts(text)
        for memo in (self.first, self.after, self.folded):
            if len(memo) > MEMO:
                memo.clear()
        out = []
        for memo, prefix, group in ((self.first, "", parts[:1]), (self.after, " ", parts[1:])):
            for p in set(group).difference(memo):
                memo[p] = self._piece(prefix + p)
            out.append(chain.from_iterable(map(memo.__getitem__, group)))
        return list(chain(*out))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_memo(("byte-bpe", path, pattern), lambda: ByteBPE(path, pattern))
        for b in batches:
            cols = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in text_list(b.column(b.num_columns - 1)):
                ids = bpe.encode(text)
                cols["n_tokens"].append(len(ids))
                cols["ids_sha256"].append(hashlib.sha256(b" ".join(map(bpe.text.__getitem__, ids))).hexdigest())
                cols["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(cols["n_tokens"], pa.int64()),
                                              pa.array(cols["ids_sha256"]), pa.array(cols["decoded_sha256"])],
                                             names=[*b.schema.names[:-1], *cols])
    return run


def _ids(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_memo(("byte-bpe", path, pattern), lambda: ByteBPE(path, pattern))
        for b in batches:
            texts = text_list(b.column(b.num_columns - 1))
            for lo, hi in slices(texts):
                ids = [bpe.encode(t) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[:-1]), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=[*b.schema.names[:-1], "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_memo(("byte-bpe", path, pattern), lambda: ByteBPE(path, pattern))
        for b in batches:
            out = [None if ids is None else bpe.decode(ids) for ids in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], names=[*b.schema.names[:-1], "bytes"])
    return run


def _mapped(df: DataFrame, keep: list[str], column: Column, run, added: list[tuple[str, T.DataType]]) -> DataFrame:
    keep = [c for c in keep if c.lower() not in {n for n, _ in added}]  # a column that bears an added name is left out
    names = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField(n, df.schema[c].dataType, True) for n, c in zip(names, keep)]
                          + [T.StructField(n, t, True) for n, t in added])
    return (df.select(*[F.col(c).alias(n) for n, c in zip(names, quoted(keep))], column.alias("__in"))
            .mapInArrow(run, schema).toDF(*keep, *(n for n, _ in added)))


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``ids`` (array<int>) of every whole text; null counts as empty, an empty text has no ids."""
    return _mapped(docs, keep, F.col(text), _ids(path, pattern), [("ids", T.ArrayType(T.IntegerType()))])


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` and ``bytes``: the pieces of ``ids`` one after the other; null ids give null."""
    return _mapped(encoded, keep, F.col(ids), _decode(path, pattern), [("bytes", T.BinaryType())])


def digests(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with the number and SHA-256 of the ids of every whole text, and the SHA-256 of the decoded ids."""
    return _mapped(docs, keep, F.col(text), _digests(path, pattern),
                   [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())])


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The rank map as a constant: ``BUCKETS`` small maps from a piece in hexadecimal to its rank, by the piece's hash."""
    import json

    table: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        table[xxhash.xxh64_intdigest(key.encode(), seed=42) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """Distinct words with their ``ids``, by higher-order functions only.

    The state is the word's pieces, in hexadecimal; each of at most length - 1 steps
    joins the neighbours of least rank, or leaves the state as it is.
    """
    table = rank_table(ranks)

    def rank(piece: Column) -> Column:
        bucket = (F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)) + 1).cast("int")
        return F.element_at(F.element_at(table, bucket), piece)

    def step(parts: Column, _: Column) -> Column:
        near = F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                           lambda i: rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))))
        least = F.array_min(near)
        at = F.array_position(near, least).cast("int")
        joined = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
                          F.slice(parts, at + 2, F.size(parts)))
        return F.when((F.size(parts) < 2) | least.isNull(), parts).otherwise(joined)

    data = F.hex(F.encode(F.col(word), "UTF-8"))
    n = F.octet_length(F.col(word))
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(data, i * 2 - 1, F.lit(2)))
    folded = F.when(n < 2, parts).otherwise(F.aggregate(F.sequence(F.lit(2), n), parts, step))
    return words.where(F.length(F.col(word)) > 0).withColumn("ids", F.transform(folded, rank))
