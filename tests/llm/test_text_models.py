"""Byte BPE, language ID, quality rules and the language model against brute force and public libraries."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from shopflow.llm import byte_bpe, hashing, language_id, pitman_yor, quality_rules, queries
from tests.llm.test_tokens_packing import HARD, noise

RANKS = P.path("byte_bpe_50k.tiktoken")


# ---- hashing ----

def test_words_equal_split(spark):
    texts = ["a bb  a\n", None, "", "x", " y z", "bb a", "é日本 a", "a", "\x0b\x0c", "q" * 5000]
    data, offsets = hashing.text_buffer(pa.array(texts))
    h, doc = hashing.words(data, offsets)
    want = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    assert doc.tolist() == [i for i, _ in want]
    of = {}
    assert all(of.setdefault(w, x) == x for (_, w), x in zip(want, h.tolist())) and len(set(of.values())) == len(of)
    lower, _ = hashing.words(*hashing.text_buffer(pa.array(["ABÉ"])), lower=True)
    assert lower[0] == hashing.words(*hashing.text_buffer(pa.array(["abÉ"])))[0][0]


def test_words_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(hashing, "BLOCK", 64)
    monkeypatch.setattr(hashing, "_POW", [])
    h, _ = hashing.words(*hashing.text_buffer(pa.array(["abc" * 50 + " q", "abc" * 50, "q", "abc" * 51])))
    assert h[0] == h[2] and h[1] == h[3] and len({*h.tolist()}) == 3


def test_shingles_of_short_texts():
    data, offsets = hashing.text_buffer(pa.array(["a b c d e f", "a b", "b a", "a b", "", "a b c d e"]))
    s, doc = hashing.shingles(*hashing.words(data, offsets), 5)
    by = {d: sorted(s[doc == d].tolist()) for d in set(doc.tolist())}
    assert {k: len(v) for k, v in by.items()} == {0: 2, 1: 1, 2: 1, 3: 1, 5: 1}
    assert by[1] == by[3] != by[2] and by[5][0] in by[0]


# ---- op4 ----

def test_bpe_equals_tiktoken(spark):
    texts = HARD + [noise(i, 50) for i in range(60)] + ["ab" * 300, "aaaa" * 200]
    ranks = byte_bpe.load_ranks(RANKS)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] * 2, "doc_id long, text string, ids int")
    enc = byte_bpe.encode(docs.drop("ids"), RANKS, P.PATTERN, ["doc_id"])
    rows = byte_bpe.decode(enc, RANKS, P.PATTERN, ["doc_id", "ids"]).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert r.ids == lib.encode_ordinary(texts[r.doc_id] or "") and bytes(r.bytes) == (texts[r.doc_id] or "").encode()
    assert byte_bpe.digests(docs.limit(0), RANKS, P.PATTERN, ["doc_id", "ids"]).collect() == []
    assert byte_bpe.encode(docs, RANKS, P.PATTERN, docs.columns).columns == ["doc_id", "text", "ids"]


@pytest.mark.parametrize("memo", [1_000_000, 0])
def test_op4_digests_equal_tiktoken(spark, tmp_dir, monkeypatch, memo):
    monkeypatch.setattr(byte_bpe, "MEMO", memo)
    texts = HARD + [noise(i, 50) for i in range(40)] + ["a" * 3000, "word " * 2000]
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {x.doc_id: tuple(x)[1:] for x in queries.op4_byte_bpe(spark, tmp_dir).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, t in enumerate(texts):
        ids = lib.encode_ordinary(t or "")
        assert got[i] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))


def plain_fold(word, ranks):
    """The definition: the neighbours of least rank become one, the first of equal ones, as long as any are a piece."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        near = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not near:
            return tuple(ranks[p] for p in parts)
        i = min(near)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_long_words_fold_alike():
    ranks = byte_bpe.load_ranks(RANKS)
    r = random.Random(1)
    for _ in range(200):
        w = "".join(r.choice("abtheé ") for _ in range(r.randint(1, 90))).encode()
        assert plain_fold(w, ranks) == byte_bpe.fold_long(w, ranks) == byte_bpe.fold(w, ranks)


def test_higher_order_fold_equals_python(spark):
    ranks = byte_bpe.load_ranks(RANKS)
    r = random.Random(2)
    words = ["a", " the", " thonen", "日本語", "étion", " " * 5, "x" * 30, "Anblewh", "aaaa" * 20]
    words += list({"".join(r.choice("abtheé onéer") for _ in range(r.randint(1, 40))) for _ in range(200)})
    got = byte_bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()
    assert {r.word: tuple(r.ids) for r in got} == {w: plain_fold(w.encode(), ranks) for w in words}


# ---- op7 ----

def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces({"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "aba": 5, "c": 6})
    prob = np.random.default_rng(0).random((8, 2)) / 4

    def brute(word, column):
        word = "▁" + word
        out = 0.0
        uses = np.zeros(8)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *[i for i, c in enumerate(cuts, 1) if c], len(word)]
            parts = [word[a:b] for a, b in zip(at, at[1:])]
            ids = [pieces.get(x, -1 if len(x) == 1 else None) for x in parts]
            if None not in ids:
                p = math.prod(prob[i, column] for i in ids)
                out += p
                for i in ids:
                    uses[i] += p
        return out, uses / out

    words = ["a", "ab", "aba", "abab", "xabc", "abcababaab", "zz"]
    got = language_id.forward(words, pieces, prob)
    for w, g in zip(words, got):
        assert np.allclose(g, [math.log(brute(w, k)[0]) for k in (0, 1)])
    uses = language_id.expected_uses(words, np.arange(1.0, 8.0), pieces, prob[:, 0])
    assert np.allclose(uses, sum(brute(w, 0)[1] * n for w, n in zip(words, range(1, 8))))
    assert np.isfinite(language_id.forward(["ab" * 3000], pieces, prob)).all()


def test_runs_that_begin_no_piece_are_not_grown(monkeypatch):
    grown, grow = [], language_id._grow
    monkeypatch.setattr(language_id, "_grow", lambda h, codes: grown.append(len(h)) or grow(h, codes))
    pieces = language_id.Pieces({"a": 0, "b": 1, "ab": 2, "xyzuvwxyzuvwxyz": 3, "▁": 4})
    grown.clear()
    w, start, end, piece = language_id.lattice(["ab" * 500], pieces)
    assert sum(grown) < 3 * 1001  # each character, and those that may begin a longer piece: not all lengths of all
    found = {("▁" + "ab" * 500)[a:b] for a, b in zip(start, end)}
    assert found == {"▁", "a", "b", "ab"} and len(end) == 1001 + 500 and (np.diff(end) >= 0).all()


def test_words_by_the_plain_class_equal_the_letter_class():
    every = "".join(chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000)
    texts = ["".join(every[i] + x for i in range(k, len(every), 7)) for k in range(7) for x in ("", "a", " ")]
    for t in [*texts, *(t or "" for t in HARD), "İstanbul ΣΑΣ.", "ﬁn ②x 𝐀b", "a" * 100_000]:
        for part in (t, t.replace("𐀀", " ")[:60_000]):
            assert language_id.letter_words(part) == language_id.WORD.findall(part.lower())


def test_words_of_all_lengths_are_counted_in_parts():
    long = "é" * (2 * language_id.TRAIN_CHARS + 1)
    (b,) = language_id._train_words(iter([pa.record_batch({"lang": ["x", "x"], "text": [f"a {long} b a", "a"]})]))
    want = {"a": 3, "b": 1, "é" * language_id.TRAIN_CHARS: 2, "é": 1}
    assert dict(zip(b.column(1).to_pylist(), b.column(2).to_pylist())) == want


def test_language_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, "the house and the tree", "en", "x"), (2, "das Haus und der Baum", "de", "x"), (3, None, "en", "x"), (4, "12 !?", None, "x"),
         (5, "", "de", "x"), (None, "der Baum", None, "x"), (6, "the tree", None, "x")] * 2, "doc_id long, text string, lang string, lang_pred string")
    model = language_id.train(docs, P.path("piece_bpe_32k.model"))
    got = language_id.predict(docs.drop("lang_pred"), model, ["doc_id"]).collect()
    assert len(got) == 14 and {r.doc_id: r.lang_pred for r in got} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 6: "en"}
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language_id.train(docs.limit(0), P.path("piece_bpe_32k.model"))
    assert {r.lang_pred for r in language_id.predict(docs.drop("lang_pred"), nothing, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(docs.limit(0).drop("lang_pred"), model, ["doc_id"]).collect() == []


def test_copies_do_not_fill_the_language_sample(spark):
    rows = [(lang, f"{lang * 3} {lang}{i} {'uvwxyz'[i % 6] * (1 + i % 4)} tail{i}") for lang in "ab" for i in range(30)]
    df = spark.createDataFrame(rows, "lang string, text string")
    least = df.where("lang = 'a'").orderBy(F.xxhash64("text")).limit(1)
    copies = df.unionByName(least.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n"))
    one, many = (language_id.train(x, P.path("piece_bpe_32k.model"), per_language=10, rounds=1) for x in (df, copies))
    assert one.langs == many.langs == ["a", "b"] and np.allclose(one.prob, many.prob, rtol=1e-9, atol=0)


def test_languages_are_learned_from_all_texts(spark, monkeypatch):
    r = random.Random(8)
    rows = [(lang, " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(6))) for lang, letters in (("a", "abcde"), ("b", "stuni"))
            for _ in range(700)]
    df = spark.createDataFrame(rows + rows[:200], "lang string, text string")  # copies count once
    vocabulary = P.path("piece_bpe_32k.model")
    model, whole, part = (language_id.train(df, vocabulary, rounds=1, **x) for x in ({}, {"per_language": 5000}, {"per_language": 600}))
    assert np.allclose(model.prob, whole.prob, rtol=1e-9, atol=0) and not np.allclose(model.prob, part.prob, rtol=1e-9, atol=0)
    assert model.least_fit == pytest.approx(whole.least_fit) and set(model.least_fit) == {"a", "b"}
    monkeypatch.setattr(language_id, "REPEATED", 10)
    assert np.allclose(language_id.train(df, vocabulary, rounds=1, fits=False).prob, model.prob, rtol=1e-9, atol=0)


def test_word_counts_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(language_id, "COUNTED_WORDS", 3)
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", "a", "a"], "text": ["x y z x", "x", "x q", "x"]})
    got = Counter()
    for b in language_id._train_words(iter([batch, batch])):
        for x in b.to_pylist():
            got[x["lang"], x["word"]] += x["n"]
    assert got == {("a", "x"): 8, ("a", "y"): 2, ("a", "z"): 2, ("a", "q"): 2, ("b", "x"): 2}


def test_held_out_languages(spark):
    from shopflow.llm.queries import op7_language_id

    got = op7_language_id(spark, "/root/testdata/sf0.001").toPandas().merge(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == 200 and (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.95


# ---- op10 ----

def brute_counts(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_base_counts():
    r = random.Random(2)
    texts = [t or "" for t in HARD] + ["a b c a b c", "x\nx\n\n x\nx", "a a a a", "a b a b a", "# * | é日 < >"]
    texts += [" ".join(r.choice("abc\n") for _ in range(r.randint(0, 60))) for _ in range(200)]
    for t in texts:
        assert quality_rules.base_counts(t) == brute_counts(t), t


def test_character_buckets_in_steps(monkeypatch):
    text = noise(4, 500)
    want = sorted(np.concatenate(list(quality_rules.character_buckets(text))).tolist())
    monkeypatch.setattr(quality_rules, "STEP_CHARS", 17)
    assert sorted(np.concatenate(list(quality_rules.character_buckets(text))).tolist()) == want


def test_repeated_words_equal_the_plain_definition():
    r = random.Random(3)
    for n in [*range(12), *[r.randint(3, 80) for _ in range(300)]]:
        words = [r.choice([b"a", b"b", b"c", b"dd"][: r.randint(1, 4)]) for _ in range(n)]
        windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
        want = {i + j for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        assert quality_rules.repeated_words(words) == len(want)


@pytest.mark.parametrize("step", [4, 1 << 18])
def test_raw_values_of_blocks_equal_those_of_single_texts(monkeypatch, step):
    monkeypatch.setattr(quality_rules, "STEP_CHARS", step)
    monkeypatch.setattr(quality_rules, "STEP_BYTES", 64)
    model = quality_rules.QualityModel(np.random.default_rng(0).random(1 << quality_rules.BITS).astype(np.float32), 0.5, 1.0, 0.0)
    texts = ["", "a", "ab", "abc", "abcd", " ", "a b", "", "\U0001f600x", "ab cd\nab cd", "é" * 50, None, "x y " * 40, "", "q"]
    single = [model.raw(t or "", hashing.words(*hashing.text_buffer(pa.array([t])))[0]) for t in texts]
    monkeypatch.setattr(quality_rules.QualityModel, "raw", quality_rules.QualityModel.raw if step == 4 else None)  # one text at a time before
    (got,) = quality_rules._raw_values(model)(iter([pa.record_batch({"text": pa.array(texts[:11] + texts[12:])})]))
    assert np.allclose(got.column(0).to_numpy(), single[:11] + single[12:], rtol=1e-12)
    (scored,) = quality_rules._score(model, 0.5, 0, 0)(iter([pa.record_batch({"text": pa.array(texts)})]))
    assert np.allclose(scored.column("probability").to_numpy(), model.probability(np.array(single)), rtol=1e-12)
    (none,) = quality_rules._score(model, 0.5, 0, 0)(iter([pa.record_batch({"text": pa.array([], pa.string())})]))
    assert none.num_rows == 0


def test_gradient_steps_equal_the_plain_ones(monkeypatch):
    monkeypatch.setattr(quality_rules, "STEP_CELLS", 7)
    monkeypatch.setattr(quality_rules, "STEPS", 5)
    texts = ["good words here", "bad bad text", "", "a", "more good words", "bad words text bad"]
    y, held = np.array([1.0, 0, 1, 0, 1, 0]), np.array([False, False, False, False, True, False])
    features = quality_rules.Features(texts)
    x = np.zeros((len(texts), 1 << quality_rules.BITS))
    for i, t in enumerate(texts):
        n_chars, words = max(0, len(t) - 2) + max(0, len(t) - 3), hashing.words(*hashing.text_buffer(pa.array([t])))[0]
        for part in quality_rules.character_buckets(t):
            np.add.at(x[i], part, quality_rules.SCALE / n_chars)
        buckets = quality_rules.word_buckets(words)
        np.add.at(x[i], buckets, quality_rules.SCALE / max(1, len(buckets)))
    weight = np.where(held, 0, np.where(y == 1, 1 / 2, 1 / 3))
    w, b, m, v, mb, vb = np.zeros(x.shape[1]), 0.0, 0.0, 0.0, 0.0, 0.0
    for t in range(1, 6):
        g = (1 / (1 + np.exp(-(x @ w + b))) - y) * weight
        grad, gb = quality_rules.DECAY * w + x.T @ g, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        w = w - quality_rules.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
        b -= quality_rules.RATE * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-6)
    got, bias = quality_rules._steps(features, y, held)
    assert np.allclose(got, w, atol=1e-4) and np.isclose(bias, b, atol=1e-4)
    assert len(features.buckets) < 200  # only these have a weight to step; all 1 << BITS had before


def test_quality_rules_learn_and_handle_odd_rows(spark):
    r = random.Random(0)
    good = lambda: " ".join(r.choice(["the", "sea", "of", "trees", "and", "hills", "is", "wide"]) + r.choice("aeiou") for _ in range(80))
    bad = lambda: " ".join(r.choice(["BUY", "NOW", "CHEAP", "$$$"]) + r.choice("AEIOU!") + "!!" for _ in range(80))
    rows = [(i, good() if i % 2 else bad(), 7) for i in range(120)] + [(500, None, 7), (501, "", 7), (502, "short", 7), (None, good(), 7), (1, good(), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_symbols int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(500, 1, 0), (None, 1, 0), (70, 1, 0), (70, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_rules.train(docs, labels)
    got = quality_rules.apply_rules(docs.drop("n_symbols"), model, ["doc_id"]).collect()
    assert len(got) == len(rows)
    unseen = [x for x in got if x.doc_id is not None and 80 <= x.doc_id < 120]
    assert all(x.kept == bool(x.doc_id % 2) for x in unseen)
    assert all(x.base_failed and not x.kept for x in got if x.doc_id in (500, 501, 502))
    none = quality_rules.train(docs, labels.limit(0))
    assert all(x.kept != x.base_failed for x in quality_rules.apply_rules(docs.drop("n_symbols"), none, ["doc_id"]).collect())
    assert quality_rules.apply_rules(docs.limit(0).drop("n_symbols"), model, ["doc_id"]).collect() == []


def test_training_rows_are_those_at_hand(spark, monkeypatch):
    """Labels of other documents take no places and no share; a repeated id is one row."""
    fit = quality_rules.fit

    def noted(path):
        def task(batches):
            rows = [r for b in batches for r in b.to_pylist()]
            with open(path, "w") as f:
                f.write(repr((len(rows), {(r["all_good"], r["all_bad"]) for r in rows}, sorted({r["text"] for r in rows})[:1])))
            import pickle

            import pyarrow as pa
            yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit([], np.zeros(0), 0, 0).__dict__)]})
        return task

    import tempfile
    path = tempfile.mkstemp()[1]
    monkeypatch.setattr(quality_rules, "_fit_task", noted(path))
    rows = [(i, f"text {i}") for i in range(100)] + [(7, "text 7")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(-50_000, 50_000).select(F.col("id").alias("doc_id"), F.pmod("id", F.lit(2)).cast("int").alias("quality"))
    for per_class, n in ((1000, 100), (20, 40)):
        quality_rules.train(docs, labels, per_class)
        got, totals, _ = eval(open(path).read())  # noqa: S307
        assert got == n and totals == {(50, 50)}


def labelled_texts(spark, n_good, n_bad):
    r = random.Random(n_bad)
    kinds = [["the", "sea", "of", "trees", "and", "hills", "is", "wide"], ["BUY", "NOW", "CHEAP", "$$$"]]
    rows = [(i, f"t{i} " + " ".join(r.choice(kinds[i >= n_good]) + r.choice("aeiou") for _ in range(12))) for i in range(n_good + n_bad)]
    labels = spark.range(n_good + n_bad).select(F.col("id").alias("doc_id"), (F.col("id") < n_good).cast("int").alias("quality"))
    return rows, spark.createDataFrame(rows + rows[:50], "doc_id long, text string"), labels


def test_quality_is_learned_from_all_labelled_rows(spark, monkeypatch, tmp_dir):
    """Every row takes part in the steps or in the calibration; few rows of a class are lent to every block."""
    import pyarrow as pa

    calibrate, calibrated = quality_rules._calibrate, []

    def noted(table):
        with open(f"{tmp_dir}/{table['block'][0].as_py()}", "w") as f:
            f.write(repr(list(zip(table["text"].to_pylist(), table["good"].to_pylist()))))
        return pa.table({"piece": pa.array([0], pa.int32()), "weights": pa.array([b"\0" * 8 * ((1 << 18) + 1)])})

    monkeypatch.setattr(quality_rules, "_fit_block", noted)
    monkeypatch.setattr(quality_rules, "_calibrate", lambda raw, y, n: calibrated.append((int(n.sum()), int((n * y).sum()))) or calibrate(raw, y, n))
    rows, docs, labels = labelled_texts(spark, 2600, 9)
    quality_rules.train(docs, labels)
    import os
    blocks = [eval(open(f"{tmp_dir}/{f}").read()) for f in os.listdir(tmp_dir)]  # noqa: S307
    taught = Counter(x for b in blocks for x in b)
    assert len(blocks) == 3 and {t for t, _ in taught} <= {t for _, t in rows}
    bad = {x for x in taught if not x[1]}
    assert bad and all(taught[x] == 3 for x in bad) and all(taught[x] == 1 for x in taught if x[1])
    assert len(taught) + calibrated[0][0] == len(rows)
    assert calibrated[0][1] + len(taught) - len(bad) == 2600


def test_quality_texts_kept_from_the_steps_are_not_shuffled(spark):
    rows, docs, labels = labelled_texts(spark, 200, 100)
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = texts.select("doc_id", "h").distinct().join(labels.withColumnRenamed("quality", "good"), "doc_id").select(
        "doc_id", "h", "good", F.xxhash64("h", "doc_id").alias("place"), quality_rules._held().alias("held"))
    dealt = quality_rules._dealt(texts, found.localCheckpoint(), True, 3, {0: 1, 1: 1})
    filters = [x for x in dealt._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "xxhash64(doc_id" in x]
    assert filters  # on the texts' side of the join; the rows found have the answer as a column
    held = {r.doc_id for r in docs.where(quality_rules._held()).collect()}
    assert sorted(r.text for r in dealt.collect()) == sorted(t for i, t in rows if i not in held) and 0 < len(held) < len(rows)


def test_quality_blocks_are_put_together_from_batches():
    """A task's blocks may end anywhere in its batches; each is fitted once and the weights are added up."""
    import pyarrow as pa

    def batch(*blocks):
        return pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "text": [f"t{b}" for b in blocks]})

    batches = [batch(1, 1, 2), batch(), batch(2), batch(2, 3)]
    assert [t["block"].to_pylist() for t in quality_rules._blocks(iter(batches))] == [[1, 1], [2, 2, 2], [3]]

    def fit_block(table):
        return pa.table({"piece": pa.array([0], pa.int32()), "weights": pa.array([np.array([table.num_rows, 1]).tobytes()], pa.binary())})

    (summed,) = quality_rules._fit_blocks(fit_block)(iter(batches))
    assert summed["n"].to_pylist() == [3] and np.frombuffer(summed["weights"][0].as_py(), np.int64).tolist() == [6, 3]
    (none,) = quality_rules._fit_blocks(fit_block)(iter([]))
    assert none.num_rows == 0


def test_a_kept_text_is_sent_once_and_a_worker_keeps_one_memo(spark):
    from shopflow.llm import common

    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, `a.b` string")
    sent, at = common.kept_and_text(docs, ["doc_id", "text", "a.b"], "text")
    assert sent.columns == ["c0", "c1", "c2"] and at == 1
    sent, at = common.kept_and_text(docs, ["doc_id"], "text")
    assert sent.columns == ["c0", "__text"] and at == 1 and sent.first()["__text"] == "a b"
    made = []
    for key in ("one", "one", "two", "one"):
        common.worker_memo(key, lambda: made.append(key) or [key])
    assert made == ["one", "two", "one"]


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark):
    """10,000 texts of some 2 kB were one batch of 21 MB; a limit that the session has been given is kept."""
    import pyarrow as pa

    from shopflow.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows]), "size": pa.array([b.nbytes])})

    docs = spark.range(0, 10_000, 1, 1).selectExpr("id", "concat(id, repeat(' ab', 700)) text")
    given = spark.conf.getAll.get(common.BATCH_LIMIT)
    try:
        spark.conf.unset(common.BATCH_LIMIT)
        # the operators set the limit themselves
        language_id.predict(docs, language_id.LanguageModel("", [], np.zeros((1, 1))), ["id"])
        assert spark.conf.get(common.BATCH_LIMIT) == str(common.BATCH_BYTES)
        got = common.map_batches(docs, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 10_000 and max(r.size for r in got) < 1.1 * common.BATCH_BYTES
        spark.conf.set(common.BATCH_LIMIT, "1m")
        got = common.map_batches(docs, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 10_000 and max(r.size for r in got) < 1.1 * (1 << 20)
    finally:
        spark.conf.unset(common.BATCH_LIMIT)
        if given is not None:
            spark.conf.set(common.BATCH_LIMIT, given)


def test_freed_arrow_memory_is_given_back_after_each_batch(monkeypatch):
    from types import SimpleNamespace

    from shopflow.llm import common

    released = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: released.append(1)))
    run = common._released(lambda given: (2 * x for x in given))
    assert list(run(iter([1, 2]))) == [2, 4] and len(released) == 3
    assert list(run(iter([]))) == [] and len(released) == 4


def test_freed_memory_is_given_back_after_a_task(monkeypatch):
    from shopflow.llm import common

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    out = common._released(lambda batches: (2 * x for x in batches))(iter([1, 2]))
    assert (next(out), next(out), given) == (2, 4, [])
    assert list(out) == [] and given == [1]
    monkeypatch.undo()
    common.give_back()
    monkeypatch.setattr(common, "_c_library", lambda: None)  # another C library
    common.give_back()


def test_quality_model_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BLOCK_ROWS", 60)
    rows, docs, labels = labelled_texts(spark, 200, 100)
    one = quality_rules.train(docs.coalesce(1), labels)
    many = quality_rules.train(docs.repartition(7), labels)
    assert (one.weights == many.weights).all() and (one.bias, one.slope, one.offset) == (many.bias, many.slope, many.offset)
    new = ["a sea of treese and hillso", "BUYa NOWe $$$i CHEAPo"]
    raws = [one.raw(t, hashing.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)], np.int64))[0]) for t in new]
    good, bad = one.probability(np.array(raws))
    assert good > 0.8 and bad < 0.2


def test_added_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "the house", "a", 0.5, True, 3)], "doc_id long, text string, lang_pred string, Score double, kept boolean, n_words int")
    model = language_id.train(docs.withColumn("lang", F.lit("en")), P.path("piece_bpe_32k.model"))
    got = language_id.predict(docs, model, docs.columns)
    assert got.columns == ["doc_id", "text", "kept", "n_words", "lang_pred", "score"] and got.first().lang_pred == "en"
    rules = quality_rules.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality_rules.apply_rules(docs, rules, docs.columns)
    assert got.columns == ["doc_id", "text", "lang_pred", "Score", *(k for k, _ in quality_rules.ADDED)] and got.first().n_words == 2


def test_fit_tells_junk_from_the_learned_languages(spark):
    r = random.Random(5)
    words = {lang: ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(60)] for lang, letters in (("xx", "abcdeo"), ("yy", "stunir"))}
    text = lambda lang: " ".join(r.choice(words[lang]) for _ in range(40))
    rows = [(i, text(lang), lang) for i in range(60) for lang in ("xx", "yy")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), P.path("piece_bpe_32k.model"))
    junk = ["".join(r.choice("qxzvkwjhgpm") for _ in range(200)), "щжъэ " * 30]
    new = spark.createDataFrame([(0, text("xx")), (1, text("yy")), (2, junk[0]), (3, junk[1]), (4, None)], "doc_id long, text string")
    got = {x.doc_id: x for x in language_id.predict(new, model, ["doc_id"], added=["lang_pred", "score", "fit"]).collect()}
    kept = {i for i, x in got.items() if x.fit is not None and x.fit >= model.least_fit[x.lang_pred]}
    assert kept == {0, 1} and got[4].fit is None


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(4)], "text string, lang string")
    with pytest.raises(ValueError):
        language_id.train(docs, P.path("piece_bpe_32k.model"))


def test_op10_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op10_quality_rules(spark, sf).collect()
    assert len(got) == len(texts)
    right = []
    for x in got:
        counts = brute_counts(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == counts
        assert x.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert x.kept == (not x.base_failed and x.probability >= quality_rules.KEEP_AT)
        if not x.base_failed and labels.get(x.doc_id) is not None:
            right.append(x.kept == bool(labels[x.doc_id]))
    assert len(right) > 20 and np.mean(right) > 0.9


# ---- op5 ----

def test_base_score_and_counts(spark):
    r = random.Random(7)
    texts = [None, "", "A a  b\n", "É é ab"] + [" ".join(r.choice(["the", "The", "a", "b", f"w{r.randint(0, 300)}"]) for _ in range(r.randint(0, 60))) for _ in range(120)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "a b", "x")] * 2 + [(None, "null id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = pitman_yor.score_texts(docs, held).collect()
    assert len(got) == len(rows)
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    toks = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter(w for i, t, _ in rows if not is_held(i) for w in toks(t))
    n, v = sum(count.values()), len(count)
    want = sorted((i if i is not None else -1, is_held(i), len(toks(t)), sum(count[w] > 0 for w in toks(t)), n,
                   sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks(t))) for i, t, _ in rows)
    have = sorted((x.doc_id if x.doc_id is not None else -1, x.held_out, x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in got)
    for a, b in zip(want, have):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(x.score < 0 for x in got)
    assert pitman_yor.score_texts(docs.limit(0), held).collect() == []


def test_probabilities_of_a_context_add_up():
    """All words after each context: known ones and the unknown one."""
    texts = ["a b c", "a b d", "b c a a b", "c c a", "d a b c"] * 3
    data, offsets = hashing.text_buffer(pa.array(texts))
    word, context, doc = pitman_yor.tokens(data, offsets)
    names = np.unique(word)
    contexts = np.unique(context)
    # every word with every context, so that the whole distribution can be read
    w, b = np.repeat(names, len(contexts)), np.tile(contexts, len(names))
    seen = Counter(zip(word.tolist(), context.tolist()))
    count = np.array([seen[x, y] for x, y in zip(w.tolist(), b.tolist())])
    s = pitman_yor.Slice(names, np.repeat(np.arange(len(names)), len(contexts)), b, count, *[np.zeros(0, np.int64)] * 5)
    hot = np.zeros(0, np.uint64)
    total = lambda sampler: pitman_yor.Totals([x.view(np.int64) for x in pitman_yor.unpack(
        pitman_yor._totals(s, hot, sampler[0], sampler[1]))], hot)
    sampler = pitman_yor.Sampler(s, total(((count > 0) * 1, np.ones(len(names), np.int64))))
    for _ in range(5):
        sampler.sweep()
        sampler.hold(total((sampler.tables, sampler.parent)))
        p = sampler.predictive().reshape(len(names), len(contexts)).sum(0)
        t = sampler.t
        unknown = (1 + t.context_discount * t.tables[contexts]) * (1 + t.parent_discount * t.parent_tables) / (
            (t.v + 1) * (1 + t.parent_customers)) / (1 + t.customers[contexts])
        assert np.allclose(p + unknown, 1.0)


def test_table_draws_follow_the_exact_conditional():
    """Tables of 4 customers against all set partitions, weighted by hand."""
    d, a, c = 0.6, 0.8, 4
    weights = Counter()

    def grow(sizes, left, w):
        if not left:
            weights[len(sizes)] += w
            return
        grow([*sizes, 1], left - 1, w * a)
        for i, s in enumerate(sizes):
            grow([*sizes[:i], s + 1, *sizes[i + 1 :]], left - 1, w * (s - d))

    grow([1], c - 1, a)
    draws = lambda n: pitman_yor.KeyedDraws(np.arange(n, dtype=np.uint64), 3)
    got = pitman_yor.draw_tables(np.full(200_000, c), np.full(200_000, a), d, pitman_yor.stirling(d), draws(200_000))
    for t in range(1, c + 1):
        assert (got == t).mean() == pytest.approx(weights[t] / sum(weights.values()), abs=0.005)
    many = pitman_yor.draw_tables(np.array([0, 1, 5000]), np.array([0.5, 0.5, 0.5]), d, pitman_yor.stirling(d), draws(3))
    assert many[0] == 0 and many[1] == 1 and 1 <= many[2] < 200


def test_frequent_words_are_dealt_over_slices(spark):
    """A word with half of all tokens: same counts, and better than the base on repeated held-out text."""
    r = random.Random(3)
    rows = [(i, " ".join(f"the w{r.randint(0, 40)}" for _ in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pitman_yor.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).toPandas()
    assert (got.n_known == got.n_tokens).all() and (got.score > got.base_score).all()
    # "the" is certain after each w: half the tokens are free, the rest cost log10 41
    assert got.score.mean() == pytest.approx(-40 * math.log10(41), rel=0.1)


def test_binomial_numbers():
    u = pitman_yor.KeyedDraws(np.arange(100_000, dtype=np.uint64), 1).uniform(np.arange(100_000))
    for n, p in ((1, 0.3), (6, 0.02), (40, 0.5), (5000, 0.01), (100_000, 0.2), (9, 0.0), (9, 1.0), (300, 0.999)):
        got = pitman_yor.binomial(np.full(len(u), n), np.full(len(u), p), u)
        assert got.min() >= 0 and got.max() <= n
        assert got.mean() == pytest.approx(n * p, abs=0.02 + 0.01 * math.sqrt(n * p)) and got.var() == pytest.approx(n * p * (1 - p), rel=0.05, abs=0.01)


def test_scores_do_not_depend_on_partitions(spark):
    sf = "/root/testdata/sf0.001"
    docs, found = spark.read.parquet(f"{sf}/documents.parquet"), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 16, 3):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
            got = pitman_yor.score_texts(docs.repartition(n), held).orderBy("doc_id").collect()
            found.append([(x.doc_id, x.score, x.base_score, x.n_known, x.train_tokens) for x in got])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == docs.count()
    tokens = sum(x.n_tokens for x in got if x.held_out)
    assert sum(x.score for x in got if x.held_out) / tokens > -3.345


def test_op5_equals_a_plain_model(spark, tmp_dir):
    """The model's formulas over dictionaries of restaurants, with the tables that the draws by key give."""
    r = random.Random(9)
    texts = [" ".join(r.choice("abcdefgh") + r.choice(["", "x"]) for _ in range(r.randint(0, 25))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {x.doc_id: x.score for x in queries.op5_pitman_yor(spark, tmp_dir).collect()}
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 == 2}
    pairs = [list(zip(["$", *t.split()], [*t.split(), "$"])) for t in texts]
    train = Counter(p for i, ps in enumerate(pairs) for p in ps if i not in held)
    every = sorted(train.keys() | {p for ps in pairs for p in ps})
    hash_of = {}
    for t in texts:
        data, offsets = hashing.text_buffer(pa.array([t]))
        word, context, _ = pitman_yor.tokens(data, offsets)
        hash_of.update(zip([*t.split(), "$"], word.tolist()))
    contexts = {w: int(pitman_yor.context_of(np.array([h], np.uint64))[0]) for w, h in hash_of.items()}
    assert len(set(contexts.values())) == len(contexts)
    keys = hashing.mix(np.array([hash_of[w] for _, w in every], np.uint64) + hashing.mix(np.array([contexts[b] + 1 for b, _ in every], np.uint64)))
    words = sorted(hash_of, key=hash_of.get)
    names = np.array([hash_of[w] for w in words], np.uint64)
    count = np.array([train[p] for p in every])
    v = len({w for (_, w), n in train.items() if n})
    c_of = Counter()
    for (b, _), n in train.items():
        c_of[b] += n

    def totals(tables, parent):
        t_of, k_of = Counter(), Counter()
        for (b, w), t in zip(every, tables.tolist()):
            t_of[b] += t
            k_of[w] += t
        discount = lambda ones, twos: min(0.9, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))
        return (t_of, k_of, sum(k_of.values()), sum(parent.values()), discount(sum(count == 1), sum(count == 2)),
                discount(*(sum(k == i for k in k_of.values()) for i in (1, 2))))

    tables = (count > 0) * 1
    parent = {w: int(any(train[b, w] for b in words)) for w in words}
    hold, mean = totals(tables, parent), np.zeros(len(every))
    for sweep in range(pitman_yor.BURN_IN + pitman_yor.SAMPLES):
        if sweep == pitman_yor.BURN_IN:
            hold = totals(tables, parent)
        t_of, k_of, k, t1, d2, d1 = hold
        new = (1 + d1 * t1) / (v + 1)
        unigram = lambda: {w: (max(0.0, k_of[w] - d1 * parent[w] * (k_of[w] > 0)) + new) / (1 + k) for w in words}
        p1 = unigram()
        weight = np.array([(1 + d2 * t_of[b]) * p1[w] for b, w in every])
        tables = pitman_yor.draw_tables(count, weight, d2, pitman_yor.stirling(d2), pitman_yor.KeyedDraws(keys, sweep))
        drawn = pitman_yor.draw_tables(np.array([k_of[w] for w in words]), np.full(len(words), new), d1, pitman_yor.stirling(d1),
                                       pitman_yor.KeyedDraws(names, -1 - sweep))
        parent = dict(zip(words, drawn.tolist()))
        if sweep >= pitman_yor.BURN_IN:
            p1 = unigram()
            mean += np.array([(train[b, w] - d2 * t + (1 + d2 * t_of[b]) * p1[w]) / (1 + c_of[b]) for (b, w), t in zip(every, tables.tolist())]) / pitman_yor.SAMPLES
    log_p = dict(zip(every, np.log10(mean)))
    for i, ps in enumerate(pairs):
        assert got[i] == pytest.approx(sum(log_p[p] for p in ps), abs=1e-4)
