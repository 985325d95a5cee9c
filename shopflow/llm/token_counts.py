"""Token counts of whole texts; huge texts by overlapping chunks that are spliced again.

A text of at most ``chunk_chars`` characters is encoded as it is.  A longer one
is cut into chunks of that length of which each begins ``overlap`` characters
before the last one ends, and the chunks go to different tasks.  Each chunk is
encoded with offsets.  A place is a proven stable boundary of two neighbours if
in both a pre-token starts there and the left chunk goes on for at least
``GUARD`` more characters: the pre-tokenizer reads left to right without
looking back and at most one character ahead, so from such a place on both
chunks have the same tokens, and the left one has those of the whole text
before it.  The total is the last chunk's count plus, for each pair, what the
left chunk counts before the first such place less what the right one does.
Where a pair has none (one run of letters or spaces over the whole overlap),
the text is cut anew with chunks and overlaps of twice the length, until it is
one chunk at last; so every text ends with the count of the library.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import load_tokenizer, map_batches, worker_memo, written
from shopflow.llm.pieces import piece_encoder

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
#: More than the longest special token and the pre-tokenizer's one character of lookahead.
GUARD = 32


def _count_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for b in batches:
            counts = encoder.counts(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(counts, pa.int64())],
                                             names=[*b.schema.names[:-1], "n_tokens"])
    return run


def _cut_chunks(chunk: int, overlap: int):
    """Rows (row, text) -> (row, chunk number, last one or not, start, text of the chunk)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                starts = list(range(0, max(1, len(text) - overlap), chunk - overlap))
                for lo in range(0, len(starts), 64):
                    part = starts[lo : lo + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(part), pa.string()),
                        pa.array(range(lo, lo + len(part)), pa.int64()),
                        pa.array([s == starts[-1] for s in part], pa.bool_()),
                        pa.array(part, pa.int64()),
                        pa.array([text[s : s + chunk] for s in part], pa.string()),
                    ], names=["row", "chunk", "is_last", "start", "text"])
    return run


def pre_token_starts(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Places (characters) where a pre-token of ``encoding`` starts, and the tokens before each."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    starts = np.array([a for a, _ in encoding.offsets], np.int64)
    new = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, np.int64)
    return starts[new], new


def _encode_chunks(path: str, overlap: int):
    """Per chunk two rows: its right end (side L of its own pair) and its left end (side R of the pair before)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_memo(("tokenizer", path), lambda: load_tokenizer(path))
        for b in batches:
            cols = {k: [] for k in ("row", "pair", "side", "tail", "places", "counts")}
            for row, k, is_last, start, text in zip(*(c.to_pylist() for c in b.columns)):
                enc = tokenizer.encode(text, add_special_tokens=False)
                places, before = pre_token_starts(enc)
                left = places < overlap
                right = (places >= len(text) - overlap) & (places < len(text) - GUARD)
                for pair, side, tail, keep in ((k - 1, "R", 0, left), (k, "L", len(enc.ids) if is_last else 0, right)):
                    if pair >= 0:
                        for name, x in zip(cols, (row, pair, side, tail, (places[keep] + start).tolist(), before[keep].tolist())):
                            cols[name].append(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(cols["row"], pa.string()), pa.array(cols["pair"], pa.int64()), pa.array(cols["side"], pa.string()),
                pa.array(cols["tail"], pa.int64()), pa.array(cols["places"], pa.list_(pa.int64())),
                pa.array(cols["counts"], pa.list_(pa.int64()))], names=list(cols))
    return run


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens) of the huge texts; n_tokens is null where some pair has no stable boundary."""
    chunks = map_batches(
        huge.select("row", "text"), _cut_chunks(chunk, overlap), "row string, chunk long, is_last boolean, start long, text string")
    ends = map_batches(
        chunks.repartition("row", "chunk"), _encode_chunks(path, overlap), "row string, pair long, side string, tail long, places array<long>, counts array<long>")
    pairs = ends.groupBy("row", "pair").agg(
        *[F.max(F.when(F.col("side") == side, F.col(c))).alias(c + side)
          for side in "LR" for c in ("places", "counts", "tail")], F.count("*").alias("n"))
    place = F.array_min(F.array_intersect("placesL", "placesR"))
    before = [F.element_at(f"counts{s}", F.array_position(f"places{s}", F.col("place")).cast("int")) for s in "LR"]
    # The pair after the last chunk has a left side only: it brings the chunk's whole count.
    return (pairs.withColumn("place", place)
            .withColumn("part", F.when(F.col("n") == 1, F.col("tailL")).otherwise(before[0] - before[1]))
            .groupBy("row").agg(F.sum("part").alias("n_tokens"), F.count("*").alias("n"), F.count("part").alias("ok"))
            .select("row", F.when(F.col("n") == F.col("ok"), F.col("n_tokens")).alias("n_tokens")))


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens",
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``docs`` with the number of tokens of ``text`` (null: 0) as the library counts them.

    All other columns and all rows stay, also repeated ones; a column named as
    ``out`` is replaced.  Huge texts are counted once per distinct text.
    Writes the counts of huge texts to the shared folder.
    """
    if overlap <= 2 * GUARD or chunk_chars < 2 * overlap:
        raise ValueError("chunk_chars >= 2 * overlap > 4 * GUARD is needed")
    kept = [c for c in docs.columns if c != out]
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    is_huge = length > chunk_chars
    # The key of a huge text is its hash, so that equal rows share one count.
    huge = (docs.where(is_huge).select(F.sha2(text, 256).alias("row"), F.col(text).alias("text"))
            .groupBy("row").agg(F.first("text").alias("text")))
    todo, done = huge, None
    size, lap = chunk_chars, overlap
    while True:
        counted = written(_spliced(todo, path, size, lap), "token-counts")
        good = counted.where(F.col("n_tokens").isNotNull())
        done = good if done is None else done.unionByName(good)
        failed = counted.where(F.col("n_tokens").isNull())
        if failed.isEmpty():
            break
        todo = huge.join(failed.select("row"), "row", "left_semi")
        size, lap = 2 * size, 2 * lap
    ordinary = docs.select(*kept, F.when(~is_huge, F.col(text)).alias("__text"))
    names = [f"__c{i}" for i in range(len(kept))]  # clashing names must not matter
    small = map_batches(ordinary.where(~is_huge).toDF(*names, "__text"), _count_whole(path), _schema(docs, kept, names)).toDF(*kept, out)
    large = (docs.where(is_huge).withColumn("__row", F.sha2(text, 256))
             .join(done.select(F.col("row").alias("__row"), F.col("n_tokens").alias("__n")), "__row")
             .select(*kept, F.col("__n").alias(out)))
    return small.unionByName(large)


def _schema(docs: DataFrame, kept: list[str], names: list[str]):
    from pyspark.sql import types as T

    fields = [T.StructField(n, docs.schema[c].dataType, True) for c, n in zip(kept, names)]
    return T.StructType([*fields, T.StructField("n_tokens", T.LongType(), True)])
