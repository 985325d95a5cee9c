"""Preferences, fingerprints, near-duplicates and the pipeline against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import near_duplicates as ND
from shopflow.llm import preferences, syncmers


# ---- op2 ----

def brute_pair(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def render(turns):
        out, spans = "", []
        for role, text in turns:
            head = f"<|im_start|>{role}\n"
            if role == "assistant":
                spans.append((len(out) + len(head), len(out) + len(head) + len(text) + len("<|im_end|>")))
            out += head + text + "<|im_end|>\n"
        return out, spans

    return n, render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:])


def test_preferences(spark):
    r = random.Random(1)
    rows, want = [], {}
    for p in range(60):
        turns = [(r.choice(["user", "assistant", None]), r.choice(["hi", "日本", "", None, "x y"])) for _ in range(r.randint(0, 6))]
        cut = r.randint(0, len(turns))
        other = turns[:cut] + [("assistant", f"o{i}") for i in range(r.randint(0, 3))]
        for side, conv in (("chosen", turns), ("rejected", other)):
            rows += [(p, side, 2 * i, role, text, "extra") for i, (role, text) in enumerate(conv)]
        fill = lambda c: [(a or "", b or "") for a, b in c]
        if turns or other:
            want[p] = brute_pair(fill(turns), fill(other))
    rows += rows[:20] + [(None, "chosen", 0, "user", "lost", "e"), (1, "other", 0, "user", "lost", "e"), (1, "chosen", None, "user", "lost", "e")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string, prompt string")
    got = preferences.format_pairs(df).collect()
    assert {x.pair_id for x in got} == set(want)
    for x in got:
        spans = [[(s.start, s.end) for s in y] for y in (x.chosen_spans, x.rejected_spans)]
        assert (x.prompt_turns, x.prompt, x.chosen, spans[0], x.rejected, spans[1]) == want[x.pair_id]
        assert x.has_preference == bool(x.chosen or x.rejected)
    assert preferences.format_pairs(df.limit(0)).collect() == []


# ---- op6 ----

def test_closed_syncmers(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice(["ab", "c", "dd", "e1", "日本!"]) for _ in range(r.randint(0, 40))) for _ in range(40)] + ["", None, "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", syncmers.anchors(F.col("text")).alias("a"), syncmers.anchor_hashes(F.col("text")).alias("h"),
                     F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(syncmers.PATTERN), F.lit(0)).alias("u")).collect()
    pairs = {(x, y) for row in rows for u in [[""] * 6 + row.u + [""] * 6] for x, y in zip(u, u[1:])}
    hashes = {(x.a, x.b): x.h for x in spark.createDataFrame(list(pairs), "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    for row in rows:
        u = [""] * 6 + row.u + [""] * 6 if row.u else []
        h = [hashes[x, y] for x, y in zip(u, u[1:])]
        want = [i for i in range(len(u) - 7) if min(h[i : i + 7]) in (h[i], h[i + 6])]
        assert [x.position for x in row.a] == want and [x.hash for x in row.a] == row.h
        assert not want or max(np.diff([-1, *want, len(u) - 7])) <= 7  # each window of 7 k-mers has one
    again = spark.createDataFrame([("p " * 3 + " ".join(str(i) for i in range(100)), " ".join(str(i) for i in range(100)) + " tail")], "a string, b string")
    found = again.select(syncmers.matched_positions(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("m")).first().m
    assert len(found) > 10 and {x.a - x.b for x in found} == {3}


def test_fingerprints_and_edits(spark, tmp_dir):
    import hashlib

    r = random.Random(4)
    texts = ["", None, "a", "日本語テキスト", "abcdefgh"] + ["".join(r.choice("ab cdé\n") for _ in range(r.randint(0, 200))) for _ in range(120)]
    ids = r.sample(range(-500, 5000), len(texts))
    rows = [(i, t, "n") for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tie string")
    got = {x.doc_id: x for x in syncmers.fingerprints(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows)
    for (i, t, _), (j, u, _) in zip(order, order[1:] + order[:1]):
        t, u, x = t or "", u or "", got[i]
        m = len(t) // 4
        edited = t[: len(t) - m] + u[:m]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = ({f[k : k + 8] for k in range(0, len(f), 8)} for f in (x.fingerprint, x.edited_fingerprint, got[j].fingerprint))
        like = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert x.near_edited == pytest.approx(like(a, b)) and x.near_next == pytest.approx(like(a, c))
        assert t != edited or x.fingerprint == x.edited_fingerprint
    assert syncmers.fingerprints(df.limit(0)).collect() == []
    from shopflow.llm import queries as Q

    df.write.parquet(f"{tmp_dir}/documents.parquet")
    assert sorted(Q.op6_syncmers(spark, tmp_dir).collect()) == sorted(got.values())
    one = syncmers.fingerprints(df.where(F.col("doc_id") == ids[5])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_anchors_do_not_depend_on_what_stands_before(spark):
    """A letter before a long run without spaces, Chinese or Latin; a passage moved in a text."""
    r = random.Random(6)
    for letters in ("的一是不了人我在有他这为之大来以个中上们", "abcdefghijklmnopqrst"):
        run = "".join(r.choice(letters) for _ in range(3000))
        spaced = " ".join(run[i : i + 9] for i in range(0, 3000, 9))
        rows = [("run", run, letters[0] + run), ("words", spaced, letters[0] + " " + spaced), ("tail", run, run + letters[0]),
                ("moved", spaced, " ".join(spaced.split()[200:] + spaced.split()[:200])), ("same", run, run)]
        df = spark.createDataFrame(rows, "kind string, a string, b string")
        a, b = syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))
        hashes = lambda x: F.transform(x, lambda e: e["hash"])
        got = {x.kind: x for x in df.select("kind", syncmers.likeness(hashes(a), hashes(b)).alias("like"),
                                            syncmers.in_place(syncmers.placed(a), syncmers.placed(b)).alias("place")).collect()}
        assert min(got[k].like for k in ("run", "tail")) > 0.95 and got["same"].like == got["same"].place == 1.0
        assert min(got[k].like for k in ("words", "moved")) > 0.85  # some 95 anchors in all
        assert got["tail"].place > 0.9 and got["moved"].place < 0.1


def test_next_with_shared_and_null_ids(spark):
    rows = [(5, f"t{i}", i * 977 << 50) for i in range(300)] + [(None, f"n{i}", i * 31 << 52) for i in range(300)] + [(i, "x", i) for i in range(20)]
    rows = [(a, b, (c + 2**63) % 2**64 - 2**63) for a, b, c in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, tie long")
    got = syncmers.with_next(df, "doc_id", "tie", ["text"]).collect()
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[2]))
    follow = {(a, t): n[1] for (a, _, t), n in zip(order, order[1:] + order[:1])}
    assert len(got) == len(rows)
    keys = Counter((a, t) for a, _, t in rows)
    assert all(x.next_text == follow[x.doc_id, x.tie] for x in got if keys[x.doc_id, x.tie] == 1)


# ---- op9 ----

def shingle_counts(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def near_texts(seed):
    r = random.Random(seed)
    rows = []
    for g in range(25):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(60, 300))]
        for _ in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.randint(0, 8)):
                w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
            rows.append(" ".join(w))
            if r.random() < 0.3:
                rows.append(rows[-1])
    r.shuffle(rows)
    return rows + [None, "", "a b", "a b", "b a", " ", "rep " * 400, "rep " * 390]


def test_signatures_estimate_weighted_jaccard():
    a, b = Counter({i: 1 + i % 7 for i in range(300)}), Counter({i: 1 + i % 5 for i in range(60, 330)})
    items = np.array([*a, *b], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    doc = np.array([0] * len(a) + [1] * len(b))
    sig = ND.dart_signatures(items, doc, np.array([*a.values(), *b.values()]), 3, 3000)
    want = sum((a & b).values()) / sum((a | b).values())
    assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.035) and not sig[2].any() and (sig[:2] != 0).all()
    real = ND.dart_signatures(items, doc, np.array([*a.values(), *b.values()]) * 0.13, 3, 3000)
    assert (real[0] == real[1]).mean() == pytest.approx(want, abs=0.035)


def test_near_duplicate_classes(spark):
    texts = near_texts(5)
    rows = [(1000 - i, t, "c") for i, t in enumerate(texts)] + [(1000, texts[0], "c"), (None, texts[1], "c"), (None, "only a null id here now", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = ND.duplicate_classes(df).collect()
    assert len(got) == len(rows)
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    sets = [shingle_counts(t) for _, t, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            either = sum((sets[i] | sets[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or either and both / either >= 0.8:
                group[find(i)] = find(j)
    want = defaultdict(list)
    for i, (d, _, _) in enumerate(rows):
        want[find(i)].append(d)
    expect = Counter((d, min((x for x in ds if x is not None), default=None), len(ds)) for ds in want.values() for d in ds)
    assert Counter((x.doc_id, x.class_id, x.class_rows) for x in got) == expect
    kept = Counter(x.class_id for x in got if x.is_kept)
    assert all(n >= 1 for n in kept.values()) and sum(kept.values()) == len(want)
    assert ND.duplicate_classes(df.limit(0)).collect() == []


def test_links_between_templated_texts_and_large_classes(spark):
    r = random.Random(9)
    def replaced(words, *at):
        return [f"x{r.randint(0, 10**9)}" if i in at else w for i, w in enumerate(words)]

    texts = []
    for t in "pq":
        template = [f"{t}{i}" for i in range(120)]
        # three words far apart are replaced: no such text is at 0.8 to another
        texts += [replaced(template, r.randint(5, 30), r.randint(45, 70), r.randint(85, 110)) for _ in range(350)]
        texts += [replaced(template, at) for at in (36, 57, 78)]  # linked with each other; their bands are the crowd's too
    base = [f"b{i}" for i in range(120)]
    texts += [replaced(base, r.randint(5, 110)) for _ in range(200)]  # one class of near copies
    index = {}
    rows = [[index.setdefault(tuple(t[i : i + 5]), len(index)) for i in range(116)] for t in texts]
    has = np.zeros((len(texts), len(index)), np.float32)
    for i, at in enumerate(rows):
        has[i, at] = 1
    both = has @ has.T
    linked = both >= 0.8 * (232 - both)
    want = np.arange(len(texts))
    while (new := np.where(linked, want, len(texts)).min(1)).tolist() != want.tolist():
        want = new
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in ND.duplicate_classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == want.tolist()
    assert len(set(got.values())) == 703


def test_blocks_of_a_bucket_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK_TEXTS", 3)
    monkeypatch.setattr(ND, "TURNS", (1,))
    test_near_duplicate_classes(spark)


def test_contract_long_chains(spark):
    nodes = spark.createDataFrame([(i, i) for i in range(60)], "node long, label long")
    links = spark.createDataFrame([(i, i + 1) for i in range(39)] + [(50, 55)], "a long, b long")
    got = dict(map(tuple, ND.contract(links, nodes).collect()))
    assert got == {i: 39 if i < 40 else (55 if i == 50 else i) for i in range(60)}


def test_all_links_of_the_test_table(spark):
    from shopflow.llm.queries import op9_near_duplicates

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    cls = {r.doc_id: r.class_id for r in op9_near_duplicates(spark, "/root/testdata/sf0.001").collect()}
    sets = {d: shingle_counts(t) for d, t in docs}
    for a in sets:
        for b in sets:
            if a < b and sum((sets[a] & sets[b]).values()) >= 0.8 * sum((sets[a] | sets[b]).values()):
                assert cls[a] == cls[b]


def test_similar_texts_share_a_prefix_token():
    """Whatever the order of the shingles, which the table of common ones decides."""
    from shopflow.llm import hashing as H

    r = random.Random(41)
    for trial in range(200):
        base, docs = [r.randint(0, 30) for _ in range(r.randint(1, 40))], []
        for _ in range(r.randint(2, 6)):
            d = [] if r.random() < 0.1 else base[:]
            for _ in range(r.randint(0, 5)):
                if d:
                    d[r.randrange(len(d))] = r.randint(0, 30)
            docs.append(d)
        flat = np.array([x for d in docs for x in d], np.uint64)
        at = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        common = np.random.default_rng(trial).integers(0, 4, ND.COMMON)
        token, of = ND.prefix_tokens(*H.weighted(H.mix(flat), at), common, 0.8)
        for i, x in enumerate(docs):
            mine = token[of == i].tolist()
            assert len(set(mine)) == len(mine) == (len(x) - math.ceil(0.8 * len(x) - 1e-6) + 1 if x else 0)
            for j, y in enumerate(docs[:i]):
                both, either = (sum(c.values()) for c in (Counter(x) & Counter(y), Counter(x) | Counter(y)))
                assert not either or both < 0.8 * either or set(mine) & set(token[of == j].tolist())


def test_pages_of_one_template_are_not_compared(spark, monkeypatch):
    """Texts that share seven tenths meet in buckets; what is compared of them grows with the planted pairs."""
    r = random.Random(42)
    vocab = [f"v{i}" for i in range(4000)]
    template = [r.choice(vocab) for _ in range(150)]
    rows, compared, written = [], {}, ND.written
    for i in range(600):
        own = [r.choice(vocab) for _ in range(60)]
        rows.append((i, " ".join(template[:75] + own + template[75:])))
        if i % 60 == 0:
            own[5] = "edited"
            rows.append((1000 + i, " ".join(template[:75] + own + template[75:])))

    def noted(df, kind):
        out = written(df, kind)
        compared[kind] = out.count()
        return out

    monkeypatch.setattr(ND, "written", noted)
    monkeypatch.setattr(ND, "TURNS", ())  # so that all links are left to the last step
    got = {x.doc_id: x.class_id for x in ND.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 1000 if i >= 1000 else i for i, _ in rows}
    assert compared["dedup-open"] > 1000 and compared["dedup-partners"] < compared["dedup-open"] / 3


# ---- pipeline ----

def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns
        rows = got.collect()
        assert 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    twice = docs.unionByName(docs.limit(5))
    assert corpus_pipeline.duplicates(spark, twice, sf).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).collect() == []
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.collect()}


def test_pipeline_on_planted_documents(spark, tmp_dir):
    """What goes and what stays is known of every document."""
    import corpus_pipeline
    import public_tokenizers
    from shopflow.llm.common import load_tokenizer

    r = random.Random(51)
    made = {lang: ["".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(400)] for lang, letters in (("xx", "abcdeou"), ("yy", "stunirl"))}
    prose = lambda lang: " ".join(r.choice(made[lang]) for _ in range(r.randint(80, 140)))
    texts, lang, labels, stays = {}, {}, [], set()
    for i in range(120):
        lang[i] = "xx" if i % 2 else "yy"
        texts[i] = prose(lang[i])
        stays.add(i)
        if i % 3 == 0:
            labels.append((i, 1, 0))
    for i in range(120, 180):  # junk of the same letters
        lang[i] = "xx" if i % 2 else "yy"
        texts[i] = " ".join(r.choice(["BUY", "NOW", "CHEAP", "$$$"]) + r.choice("AEIOU!") + "!!" + str(r.randint(0, 999)) for _ in range(90)) + " " + prose(lang[i])[:40]
        if i % 3 == 0:
            labels.append((i, 0, 0))
    for i in range(180, 190):  # too short
        lang[i], texts[i] = "xx", " ".join(prose("xx").split()[:30])
    for i in range(190, 200):  # no letter, nothing at all, or letters of no learned language
        lang[i], texts[i] = None, [None, "", "12 34 " * 60, "щжъэф цчшюя " * 40][i % 4]
    for i in range(200, 220):  # exact copies, and copies with a word changed
        words = texts[i - 200].split()
        words[40] = words[40] if i % 2 else made[lang[i - 200]][0] + "q"
        lang[i], texts[i] = lang[i - 200], " ".join(words)
    rows = [(i, texts[i], lang[i], "s", len(texts[i] or "")) for i in texts]
    r.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    assert sorted(x.doc_id for x in got) == sorted(stays)
    library = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert {x.doc_id: x.n_tokens for x in got} == {i: len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in stays}


def test_op1_batches_of_the_small_table(spark):
    from shopflow.llm import queries as Q

    sf = "/root/testdata/sf0.001"
    rows = Q.op1_length_buckets(spark, sf).collect()
    counts = {x.doc_id: x.n_tokens + 1 for x in Q.op8_token_counts(spark, sf).collect()}
    assert {x.doc_id: x.n_tokens for x in rows} == counts
    batches = defaultdict(list)
    for x in rows:
        batches[x.bucket, x.batch].append(x)
    assert len({x.bucket for x in rows}) <= Q.BUCKETS
    for (_, _), members in batches.items():
        width = members[0].boundary
        assert all(x.boundary == width and x.n_tokens + x.padding == width for x in members) and (len(members) == 1 or len(members) * width <= Q.BATCH_TOKENS)
        assert len({x.slot for x in members}) == len(members)


def test_pipeline_stages_take_any_extra_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    clash = ["score", "LANG_PRED", "fit", "kept", "n_words", "probability", "id", "node", "n", "_fit", "a.b"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = docs
    for k, c in enumerate(clash):
        docs = docs.withColumn(c, F.lit(k))
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, sf), stage(spark, plain, sf)
        assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in want.collect())
        if name != "packing":
            assert got.columns == docs.columns
            assert {tuple(r[len(plain.columns):]) for r in got.collect()} == {tuple(range(len(clash)))}


def test_queries_match_their_sql(spark):
    import duckdb

    from shopflow.llm import queries as Q
    from tools.check_oracle import digest

    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for table in ("conversations", "documents"):
        con.execute(f"create view {table} as select * from read_parquet('{sf}/{table}.parquet')")
    for name, sql in Q.ORACLES.items():
        df = Q.QUERIES[name](spark, sf)
        got = con.execute(sql)
        cols = [d[0] for d in got.description]
        assert sorted(cols) == sorted(df.columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, got.fetchall())[0]
