"""Packing, binary records and token counts against the library and brute force."""

import itertools
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shopflow.llm import length_buckets as LB
from shopflow.llm import queries as Q
from shopflow.llm import records, token_counts
from shopflow.llm.common import load_tokenizer
from shopflow.llm.pieces import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b \n c", "a \n\n b\t\tc", "x  y  z", "\x1c a\x1f b",
    "it's we'll I'D don't 've", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b<|endoftext|>", "123 4567 8,9",
    "日本語 テキスト、です。", "émoji 👩‍👩‍👧 ok ", "r\r\n\r\n s", "!!! ??? ...", "tab\t tab \t", "a" * 300, "ab " * 200,
    "word " * 50 + " " * 90 + "end", "é" * 90,
]


def library(texts):
    tok = load_tokenizer(PATH)
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def noise(seed, n):
    r = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "1", "é", "日", " ", "<|endoftext|>", ".", ",", "word", "　", "\x1d"]
    return "".join(r.choice(parts) for _ in range(n))


def test_pieces_equal_the_library():
    texts = HARD + [noise(i, 40) for i in range(300)]
    want = library(texts)
    for entries in (10**6, 0):  # also with a memo that is always dropped
        enc = PieceEncoder(PATH, entries)
        column = pa.array(texts, pa.string())
        got = [ids[a:b].tolist() for lo, hi, ids, at in enc.encode(column) for a, b in zip(at, at[1:])]
        assert got == want
        assert enc.counts(column).tolist() == [len(x) for x in want]
        assert enc.counts(column.slice(5, 7)).tolist() == [len(x) for x in want[5:12]]


def test_memo_of_pieces_is_bounded_in_bytes_and_compact():
    r = random.Random(5)
    texts = ["日本語"[i % 3] * r.randint(100, 4000) + str(i) for i in range(300)]  # long pieces: few entries, many bytes
    want = [len(x) for x in library(texts)]
    enc, most = PieceEncoder(PATH, max_bytes=200_000), 0
    for lo in range(0, len(texts), 10):
        assert enc.counts(pa.array(texts[lo : lo + 10])).tolist() == want[lo : lo + 10]
        most = max(most, len(enc.text))
    assert most < 200_000 + 10 * 3 * 4100  # the limit and one batch
    enc = PieceEncoder(PATH)
    enc.counts(pa.array([" ".join(f"w{i}" for i in range(20_000))]))
    held = sum(x.nbytes for x in vars(enc).values() if isinstance(x, np.ndarray)) - enc.text.nbytes - enc.ids.nbytes
    assert held <= 21 * 20_000  # 48 bytes an entry before


def test_counts_with_tiny_chunks(spark):
    texts = HARD + [noise(i, 300) for i in range(40)] + ["x" * 900, " " * 900, "ab\n" * 400]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] * 2, "doc_id long, text string, row int")
    got = token_counts.count_tokens(docs, PATH, chunk_chars=200, overlap=72)
    assert got.columns == ["doc_id", "text", "row", "n_tokens"]
    want = [len(x) for x in library(texts)]
    rows = got.collect()
    assert len(rows) == 2 * len(texts)
    assert {(r.doc_id, r.n_tokens) for r in rows} == set(enumerate(want))


def test_counts_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).collect() == []


def test_records_round_trip(spark):
    texts = HARD + [noise(i, 30) for i in range(20)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "y"), (3, "same id", "z")] + [(7, "copy", "c")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    manifest = records.write_records(docs, PATH)
    got = records.read_digests(manifest).orderBy(F.col("doc_id").asc_nulls_first(), "start").collect()
    assert len(got) == len(rows)
    ids = {}
    for (doc, text, _), seq in zip(rows, library([t for _, t, _ in rows])):
        ids.setdefault(doc, []).append(zlib.crc32(np.array(seq + [0], "<u4").tobytes()))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        ids[r.doc_id].remove(r.ids_crc32)
    assert not any(ids.values())
    m = manifest.first()
    doc, seq = records.read_record(m.data_file, m.index_file, m.n_records - 1, m.width)
    assert seq[-1] == 0


def test_damaged_records_are_found():
    good = records.frame(b"payload")
    assert records.unframe(good) == b"payload"
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(bytes(bad))


def test_records_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert records.read_digests(records.write_records(docs, PATH)).collect() == []


def padding(sizes, bounds):
    return sum(min(b for b in bounds if b >= s) - s for s in sizes)


def test_boundaries_are_optimal():
    r = random.Random(3)
    for _ in range(60):
        sizes = [r.randint(1, 30) for _ in range(r.randint(1, 25))]
        k = r.randint(1, 5)
        lens = sorted(set(sizes))
        rows = np.array([sizes.count(x) for x in lens], object)
        got = LB.optimal_boundaries(np.array(lens, object), rows, rows * np.array(lens, object), k)
        best = min(padding(sizes, [*c, lens[-1]]) for n in range(k) for c in itertools.combinations(lens[:-1], n))
        assert got == sorted(got) and len(got) <= k and padding(sizes, got) == best


def test_bins_ascend(spark):
    bins = [r.b for r in spark.range(0, 200_000).select("id", LB.length_bin(F.col("id")).alias("b")).orderBy("id").collect()]
    assert bins == sorted(bins) and len(set(bins)) < 40 * LB.EXACT and bins[:1025] == list(range(1025))


def test_packing_rules(spark):
    r = random.Random(5)
    rows = [(i, r.choice([None, 0, 1, 5, 17, 40, 3000]) if i % 3 else 12, "b") for i in range(500)] + [(7, 12, "b")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, n_tokens long, bucket string")
    got = LB.pack(docs, "n_tokens", ["doc_id", "n_tokens"], 128, 3).collect()
    assert len(got) == len(rows)
    full = {}
    for x in got:
        n = x.n_tokens or 0
        assert x.padding == x.boundary - n >= 0 and x.batch_rows == max(1, 128 // max(1, x.boundary))
        full.setdefault((x.bucket, x.batch), []).append(x.slot)
    for (bucket, batch), slots in full.items():
        assert sorted(slots) == list(range(len(slots)))
    last = {b: max(k for c, k in full if c == b) for b, _ in full}
    per = {x.bucket: x.batch_rows for x in got}
    assert all(len(s) == per[b] for (b, k), s in full.items() if k != last[b])
    assert all(sorted(k for c, k in full if c == b) == list(range(last[b] + 1)) for b in last)
    lists = LB.batches(LB.pack(docs, "n_tokens", ["doc_id", "n_tokens"], 128, 3)).collect()
    assert sum(len(x.doc_ids) for x in lists) == len(rows)


def test_packing_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert LB.pack(docs, "n_tokens", ["doc_id"], 128).collect() == []


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


#: Pairs of unlike words that a polynomial hash modulo 2**64 takes for equal, whatever its base.
UNLIKE = [(thue_morse(n, two), thue_morse(n, two[::-1])) for n in (1024, 2048, 4096) for two in ("ab", "er", "01")]


def test_unlike_words_have_unlike_hashes():
    from shopflow.llm import hashing as H

    data, offsets = H.text_buffer(pa.array([w for pair in UNLIKE for w in pair]))
    h, text = H.words(data, offsets)
    assert len(h) == 2 * len(UNLIKE) == len(set(h.tolist())) and text.tolist() == list(range(len(h)))
    long = "x" * (H.BLOCK + 5) + "y"  # longer than a block, against the plain definition
    data, offsets = H.text_buffer(pa.array(["ab " + long]))
    got = H.polynomials(data, np.array([0, 3]), np.array([2, 3 + len(long)]))
    for word, value in zip(("ab", long), got.tolist()):
        halves = [sum((b + 1) * pow(base, i, p) for i, b in enumerate(word.encode())) % p if len(word) < 9 else horner(word, base, p) for p, base in H.FIELDS]
        assert value == halves[0] << 32 | halves[1]


def horner(word, base, p):
    total = 0
    for b in reversed(word.encode()):
        total = (total * base + b + 1) % p
    return total


def test_unlike_words_keep_their_own_ids_and_counts(spark, tmp_dir):
    rows = [(2 * i + k, w) for i, pair in enumerate(UNLIKE) for k, w in enumerate(pair)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    want = library([w for _, w in rows])
    counts = {x.doc_id: x.n_tokens for x in Q.op8_token_counts(spark, tmp_dir).collect()}
    assert counts == {i: len(x) for i, x in enumerate(want)}
    crc = {x.doc_id: x.ids_crc32 for x in Q.op3_binary_records(spark, tmp_dir).collect()}
    assert crc == {i: zlib.crc32(np.array(x + [0], "<u4").tobytes()) for i, x in enumerate(want)}
    classes = {x.doc_id: x.class_id for x in Q.op9_near_duplicates(spark, tmp_dir).collect()}
    assert len(set(classes.values())) == len(rows)


@pytest.mark.parametrize("collide", [lambda h: np.zeros_like(h), lambda h: h % np.uint64(5)])
def test_pieces_are_compared_when_hashes_agree(monkeypatch, collide):
    from shopflow.llm import hashing as H

    mix = H.mix
    monkeypatch.setattr(H, "mix", lambda x: collide(mix(x)))
    texts = HARD + [noise(i, 40) for i in range(100)]
    for entries in (10**6, 50):
        enc = PieceEncoder(PATH, entries)
        assert enc.counts(pa.array(texts, pa.string())).tolist() == [len(x) for x in library(texts)]
        assert enc.counts(pa.array(texts[::-1], pa.string())).tolist() == [len(x) for x in library(texts[::-1])]
