"""Line dedup: lines that many documents share stay in one document only.

Method: every long line's key is hashed (128 bits); the occurrences are written once,
then dealt by range of (hash, document, position) and sorted so within a task, the
greatest document first.  A stream over that order sees a key's first occurrence first:
that document keeps the line, and once enough documents have been seen all others lose
it.  What comes back is a compressed bitmap of kept lines for each document that loses
some; the texts are only read again to be cut.

A hot key spans as many ranges as its rows fill.  A task that holds the beginning of a
key knows its greatest document and decides alone; what it cannot know (the first key's
beginning, the last key's end) goes out undecided with the first few documents seen,
and one small table of such keys, two for each task at most, decides it.

Rows: those with equal ``doc_id`` are one document (a null id is one, the least of all);
rows equal in ``doc_id`` and text give equal results.  A null or empty text is one empty
line.  There are no ties: a key stays in its greatest ``doc_id``, with all its lines there.
Other columns are left out.  Memory of a task: a batch of texts, and of one key the
occurrences in its first few documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shopflow.llm.common import slices, text_list, written

#: White space that a key's ends lose.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
#: Rows handed on at once.
CHUNK = 1 << 16
#: What a task says of an occurrence: the line goes; not decided here; a document that holds the key.
DROPPED, OPEN, SEEN = 0, 1, 2


def _hash_lines(min_chars: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, seen = batch.column(0), batch.column(1).to_pylist(), set()
            texts = text_list(batch.column(2))
            for lo, hi in slices(texts):
                at, places, digests = [], [], []
                for i in range(lo, hi):
                    if len(texts[i]) < min_chars or (twin := (rows[i], ids[i].as_py())) in seen:
                        continue  # a repeated row adds nothing
                    seen.add(twin)
                    for k, line in enumerate(texts[i].split("\n")):
                        if len(line) >= min_chars and len(key := line.strip(BLANKS)) >= min_chars:
                            at.append(i)
                            places.append(k)
                            digests.append(hashlib.blake2b(key.encode().lower(), digest_size=16).digest())  # bytes: only A-Z change
                if at:
                    h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                    where = pa.array(at)
                    yield pa.record_batch([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), ids.take(where),
                                           batch.column(1).take(where), pa.array(places, pa.int32())], schema=schema)

    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text); ``row`` tells the texts of one id apart."""
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row, line) of every line whose key has at least ``min_chars`` code points."""
    schema = T.StructType().add("h1", "long").add("h2", "long").add("doc_id", docs.schema["doc_id"].dataType).add("row", "long").add("line", "integer")
    return _numbered(docs).mapInArrow(_hash_lines(min_chars, to_arrow_schema(schema)), schema)


class _Key:
    """The key that a task's stream is at."""

    def __init__(self, key: tuple | None, first: bool):
        self.key, self.first = key, first
        self.docs: list = []  # the first documents seen, greatest first
        self.held: list = []  # occurrences outside the first document while there may be too few documents


def _first_occurrences(min_docs: int, schema: pa.Schema):
    """Occurrences of one range, in order -> rows (kind, h1, h2, doc_id, row, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: _Key | None = None

        def ready(least: int) -> Iterator[pa.RecordBatch]:
            if len(out) >= least:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()

        def close(last: bool) -> None:
            if now.first or last:
                out.extend((SEEN, *now.key, doc, None, None) for doc in now.docs)
                out.extend((OPEN, *now.key, *x) for x in now.held)

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            ends = np.r_[starts[1:], len(h1)]
            # A key of one row inside a batch loses nothing and is over: only others are looked at.
            look = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(h1)))
            for a, b in zip(starts[look].tolist(), ends[look].tolist()):
                key = (int(h1[a]), int(h2[a]))
                if now is None or now.key != key:
                    if now is not None:
                        close(False)
                    now = _Key(key, now is None)
                for at in range(a, b, CHUNK):
                    part = batch.slice(at, min(CHUNK, b - at))
                    for x in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                        if len(now.docs) < min_docs and (not now.docs or x[0] != now.docs[-1]):
                            now.docs.append(x[0])
                        if now.first:  # it may have begun in the task before
                            out.append((OPEN, *key, *x))
                        elif x[0] != now.docs[0]:
                            now.held.append(x)
                    if len(now.docs) >= min_docs:
                        out.extend((DROPPED, None, None, *x) for x in now.held)
                        now.held.clear()
                    yield from ready(CHUNK)
        if now is not None:
            close(True)
        yield from ready(1)

    return run


def dropped_lines(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, line) of the lines that go; ``occurrences`` is a written table, since the ranges are found from a sample of it."""
    schema = T.StructType().add("kind", "integer").add("h1", "long").add("h2", "long").add(occurrences.schema["doc_id"]) \
        .add("row", "long").add("line", "integer")
    order = ["h1", "h2", F.desc_nulls_last("doc_id"), "row", "line"]
    ranged = occurrences.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(ranged.mapInArrow(_first_occurrences(min_docs, to_arrow_schema(schema)), schema), "line-verdicts")
    seen = found.where(F.col("kind") == SEEN).select("h1", "h2", "doc_id").distinct()
    keys = seen.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")).where(F.col("n") >= min_docs)
    open_ = found.where(F.col("kind") == OPEN)
    # At most two keys for each task of the sorted stream, so the table may go to all tasks.
    late = open_.join(F.broadcast(keys), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("top")))
    return found.where(F.col("kind") == DROPPED).select("doc_id", "row", "line").unionByName(late.select("doc_id", "row", "line"))


def pack_bits(lines: np.ndarray) -> bytes:
    """Compressed bitmap (least bit first) of the kept lines up to the last dropped one; ``lines`` are the dropped ones."""
    bits = np.ones((int(lines.max()) // 8 + 1) * 8, np.uint8)
    bits[lines] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def _pack(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            keep = [pack_bits(lists[i].values.to_numpy()) for i in range(len(lists))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(keep, pa.binary())], schema=schema)

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, keep) of the documents that lose lines: ``keep`` is a bitmap, compressed by zlib, of lines 0
    to the last one dropped; lines after it stay.  ``row`` is ``xxhash64`` of the text."""
    dropped = dropped_lines(written(line_occurrences(docs, min_chars), "line-occurrences"), min_docs)
    schema = T.StructType().add(dropped.schema["doc_id"]).add("row", "long").add("keep", "binary")
    lists = dropped.groupBy("doc_id", "row").agg(F.collect_set("line").alias("lines"))
    return lists.mapInArrow(_pack(to_arrow_schema(schema)), schema)


def kept_lines(text: str, keep: bytes | None) -> tuple[int, int, str]:
    """(lines, lines dropped, text without them) by a document's bitmap."""
    if keep is None:
        return text.count("\n") + 1, 0, text
    lines = text.split("\n")
    gone = np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little") == 0).tolist()
    for k in reversed(gone):
        del lines[k]
    return len(lines) + len(gone), len(gone), "\n".join(lines)


def _cut(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = text_list(batch.column(1)), batch.column(2)
            for lo, hi in slices(texts):
                got = [kept_lines(texts[i], keep[i].as_py()) for i in range(lo, hi)]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *(pa.array(c, f.type) for c, f in zip(zip(*got), list(schema)[1:4])),
                                       keep.slice(lo, hi - lo)], schema=schema)

    return run


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text, keep) for every row of ``docs``; ``keep`` is null where all lines stay."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(F.col("doc_id").alias("id"), F.col("row").alias("of"), "keep")
    rows = _numbered(docs)
    both = rows.join(bitmaps, rows["doc_id"].eqNullSafe(bitmaps["id"]) & (rows["row"] == bitmaps["of"]), "left")
    schema = T.StructType().add(docs.schema["doc_id"]).add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string").add("keep", "binary")
    return both.select("doc_id", "text", "keep").mapInArrow(_cut(to_arrow_schema(schema)), schema)
