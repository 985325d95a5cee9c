"""Token ids as length-delimited binary records with a separate offset index.

A data file is a run of records.  Each record is

    length   8 bytes, little-endian: bytes of the payload
    check    4 bytes: masked CRC-32 of those 8 bytes
    payload  the sequence's ids, little-endian unsigned, 2 or 4 bytes each
    check    4 bytes: masked CRC-32 of the payload

with ``masked(c) = rotate_right(c, 15) + 0xA282EAD8 (mod 2**32)``, so that a
file that holds checksums itself is still checked well.  The index file beside
it holds, for each record, its offset and its length as two 8-byte numbers, so a
reader can fetch any record without reading the ones before it.

Each task writes its files under names of its own and reports them in a row of
the manifest, a Parquet table that Spark commits; readers know only files of
the manifest, so what lost or repeated tasks left behind is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.config import fresh_dir
from shopflow.llm.pieces import piece_encoder

MASK_DELTA = 0xA282EAD8  # fixed value of the masked checksum
#: A record's share of a task's memory is its own; a write buffer holds this much more.
BUFFER_BYTES = 4 << 20
MANIFEST = "part int, data_file string, index_file string, n_records long, n_tokens long, width int"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked_crc(head)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: bytes | memoryview) -> bytes:
    """The payload of one record; ``ValueError`` where a checksum or the length is wrong."""
    head = bytes(data[:8])
    if len(data) < 16 or struct.unpack_from("<I", data, 8)[0] != masked_crc(head):
        raise ValueError("record header is damaged")
    size = struct.unpack("<Q", head)[0]
    payload = bytes(data[12 : 12 + size])
    if len(data) != size + 16 or struct.unpack_from("<I", data, 12 + size)[0] != masked_crc(payload):
        raise ValueError("record payload is damaged")
    return payload


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        fs, base = _file_system(folder)
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        n, tokens, offset, data, index = 0, 0, 0, None, None
        try:
            for b in batches:
                docs = b.column("__id").to_pylist()
                for lo, hi, ids, before in encoder.encode(b.column("__text")):
                    if data is None:
                        data = fs.open_output_stream(f"{base}/{name}.rec", buffer_size=BUFFER_BYTES)
                        index = fs.open_output_stream(f"{base}/{name}.idx", buffer_size=BUFFER_BYTES)
                    edges = before.tolist()
                    # the document's id goes before its tokens: a flag, then 8 bytes
                    framed = [frame(struct.pack("<?q", doc is not None, doc or 0) + ids[x:y].tobytes() + end)
                              for doc, x, y in zip(docs[lo:hi], edges, edges[1:])]
                    sizes = np.array([len(x) for x in framed], np.int64)
                    starts = offset + np.cumsum(sizes) - sizes
                    data.write(b"".join(framed))
                    index.write(np.stack([starts, sizes], 1).astype("<i8").tobytes())
                    offset += int(sizes.sum())
                    tokens += len(ids) + hi - lo
                    n += hi - lo
        finally:
            for f in (data, index):
                if f is not None:
                    f.close()
        if n:
            yield pa.RecordBatch.from_pylist([{
                "part": part, "data_file": f"{folder}/{name}.rec", "index_file": f"{folder}/{name}.idx", "n_records": n,
                "n_tokens": tokens, "width": len(end)}], schema=pa.schema([
                    ("part", pa.int32()), ("data_file", pa.string()), ("index_file", pa.string()), ("n_records", pa.int64()),
                    ("n_tokens", pa.int64()), ("width", pa.int32())]))
    return run


def write_records(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                  end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Tokenize every whole text (null: empty), append ``end_id``, write records in ascending ``doc_id``.

    Order: null ids first, then by id, then by the text's hash; equal rows in any
    order.  The files' order is the manifest's ``part``.  Rows are dealt by
    ranges of (id, hash of the text, place in the input), so an id that many
    rows share is split over several files.  Returns the manifest (one row for
    each file; none for an empty table).
    """
    folder = folder or fresh_dir(docs.sparkSession, "records")
    fs, base = _file_system(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"),
                       F.xxhash64(text).alias("__h"), F.monotonically_increasing_id().alias("__m"))
    manifest = (rows.repartitionByRange("__id", "__h", "__m").sortWithinPartitions("__id", "__h")
                .select("__id", "__text").mapInArrow(_write(folder, path, end_id), MANIFEST))
    out = f"{folder}/manifest"
    manifest.write.parquet(out)
    return docs.sparkSession.read.schema(MANIFEST).parquet(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for b in batches:
        for m in b.to_pylist():
            fs, index_path = _file_system(m["index_file"])
            data_path = _file_system(m["data_file"])[1]
            start, before = m["first_token"], 0
            with fs.open_input_stream(index_path) as index, fs.open_input_stream(data_path, buffer_size=BUFFER_BYTES) as data:
                while entries := index.read(16 * 1024):
                    cols = {k: [] for k in names}
                    for offset, size in np.frombuffer(entries, "<i8").reshape(-1, 2).tolist():
                        if offset != before:
                            raise ValueError(f"{m['data_file']}: the index does not follow the records")
                        payload = unframe(data.read(size))
                        before += size
                        known, doc = struct.unpack_from("<?q", payload)
                        ids = np.frombuffer(payload, f"<u{m['width']}", offset=9)
                        for k, x in zip(names, (doc if known else None, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                            cols[k].append(x)
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(cols[k], pa.int64()) for k in names], names=names)


def file_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first_token``: tokens in all files before.

    The one place where all files meet: a running sum over one narrow row for each
    file, of which there are as many as write tasks.
    """
    from pyspark.sql import Window

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read from the files and checked.

    ``start``: ids of all records before.  Files are read by different tasks.
    """
    files = manifest.sparkSession.sparkContext.defaultParallelism
    return (file_starts(manifest).repartition(files, "data_file")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_record(data: str, index: str, k: int, width: int) -> tuple[int | None, np.ndarray]:
    """Record ``k`` of a file, found through its index: (doc_id, ids)."""
    fs, index_path = _file_system(index)
    with fs.open_input_file(index_path) as f:
        offset, size = struct.unpack("<qq", f.read_at(16, 16 * k))
    with fs.open_input_file(_file_system(data)[1]) as f:
        payload = unframe(f.read_at(size, offset))
    known, doc = struct.unpack_from("<?q", payload)
    return (doc if known else None), np.frombuffer(payload, f"<u{width}", offset=9)
