"""Periodic runs, conversation repair and line dedup against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import conversation_repair as CR
from shopflow.llm import line_dedup as LD
from shopflow.llm import periodic_runs as PR
from shopflow.llm import queries as Q


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- op11 ----

def brute_runs(w, exponent=4, least=6):
    """Every period's maximal stretches; those with a smaller period are left out."""
    n, found = len(w), []
    for q in range(1, n // exponent + 1):
        same = [w[i] == w[i + q] for i in range(n - q)] + [False]
        begin = None
        for i, equal in enumerate(same):
            if equal and begin is None:
                begin = i
            elif not equal and begin is not None:
                length = i - begin + q
                if length >= max(least, exponent * q) and all(
                        any(w[k] != w[k + d] for k in range(begin, begin + length - d)) for d in range(1, q)):
                    found.append((begin, length, q))
                begin = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(r):
    k, n = r.choice([1, 2, 2, 3, 6]), r.randint(0, 70)
    w = [r.randint(1, k) for _ in range(n)]
    for _ in range(r.randint(0, 2)):
        if n:
            a, p = r.randrange(n), r.randint(1, 9)
            b = min(n, a + p * r.randint(3, 8))
            for i in range(a + p, b):
                w[i] = w[i - p]
    return w


def test_maximal_runs():
    r = random.Random(11)
    for _ in range(1500):
        w = random_words(r)
        for exponent, least in ((4, 6), (2, 2), (3, 5)):
            assert PR.maximal_runs(w, exponent, least) == brute_runs(w, exponent, least)


def test_longest_common_prefixes_and_suffix_order():
    r = random.Random(12)
    for _ in range(200):
        w = random_words(r) or [1]
        tree, n = PR.LongestCommon(w), len(w)
        assert sorted(range(n + 1), key=lambda i: w[i:]) == np.argsort(tree.ranks).tolist()
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        got = tree(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        for (i, j), k in zip(pairs, got):
            assert w[i : i + k] == w[j : j + k] and (i + k == n or j + k == n or w[i + k] != w[j + k])


def test_pieces_lose_no_run():
    r = random.Random(13)
    for _ in range(300):
        texts = [random_words(r) for _ in range(4)]
        flat = np.array([x for t in texts for x in t], np.int64)
        text = np.repeat(np.arange(4), [len(t) for t in texts])
        at, got = np.cumsum([0, *map(len, texts)]), []
        for lo, hi in PR.pieces_with_runs(flat, text, 4, 6):
            assert len(set(text[lo:hi].tolist())) == 1
            got += [(s + lo, n, p) for s, n, p in PR.maximal_runs(flat[lo:hi].tolist())]
        assert sorted(got) == sorted((s + at[i], n, p) for i, t in enumerate(texts) for s, n, p in brute_runs(t))


def brute_op11(doc_id, text):
    w = words_of(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def hostile_texts(r):
    texts = [None, "", " ", "\n \t", "a", "a a a a a", "a a a a a a", "é " * 9, "a\x1cb " * 8, "x y " * 6, "日本 " * 7 + "end",
             "a b " * 6 + "c " + "a b " * 6, " lead " * 7]
    for _ in range(150):
        w = random_words(r)
        gap = r.choice([" ", "\n", "\t ", "\x0b", "  "])
        texts.append(r.choice(["", gap]) + gap.join("w%d" % x for x in w) + r.choice(["", gap]))
    return texts


def test_op11_query(spark, tmp_dir):
    r = random.Random(14)
    texts = hostile_texts(r)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a " * 8, "x"), (3, "a", "x"), (3, "a", "x")]
    long = " ".join(random.Random(1).choice("ab") + str(i // 40 % 3) for i in range(30_000))
    rows.append((10_000, long, "x"))
    spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = [tuple(x) for x in Q.op11_periodic_runs(spark, tmp_dir).collect()]
    want = [brute_op11(i, t) for i, t, _ in rows if i != 10_000]
    assert sorted((x for x in got if x[0] != 10_000), key=repr) == sorted(want, key=repr)
    (big,) = [x for x in got if x[0] == 10_000]
    assert big[1] > 0
    empty = spark.read.parquet(f"{tmp_dir}/documents.parquet").limit(0)
    assert PR.periodic_runs(empty).collect() == []


def test_op11_on_the_small_table(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {x.doc_id: tuple(x) for x in Q.op11_periodic_runs(spark, SF_SMALL).collect()}
    short = [d for d in docs if len(words_of(d.text)) <= 300]
    assert len(got) == len(docs) and len(short) > 50
    for d in short:
        assert got[d.doc_id] == brute_op11(d.doc_id, d.text)
    assert any(x[1] for x in got.values())


# ---- op12 ----

def brute_repair(rows):
    """rows: (turn, role, text) in order.  All edit sequences by plain dynamic programming over whole (cost, audit, text) triples."""
    nxt = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    full = {"u": "user", "a": "assistant"}
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    live = {0: (0, "", ())}

    def inserted(live):
        for _ in range(4):
            more = dict(live)
            for state, (cost, audit, said) in live.items():
                for t in nxt[state]:
                    if t in full:
                        x = (cost + 2, audit + "I", (*said, full[t] + ":"))
                        if nxt[state][t] not in more or x < more[nxt[state][t]]:
                            more[nxt[state][t]] = x
            live = more
        return live

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, said) in inserted(live).items():
            options = [(state, cost + 3, "D", said)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in nxt[state]:
                    options.append((nxt[state][role[:1]], cost + extra, "K", (*said, f"{role}:{text}")))
                options += [(to, cost + 2 + extra, "R", (*said, f"{full[t]}:{text}")) for t, to in nxt[state].items() if t in full]
            for to, c, e, s in options:
                x = (c, audit + e, s)
                if to not in after or x < after[to]:
                    after[to] = x
        live = after
    cost, audit, said = min(x for state, x in inserted(live).items() if state in (0, 3))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, sha("\n".join(said)))


def all_sequences(rows, longest):
    """The cheapest audit by trying every sequence of edits."""
    best = None
    for n in range(len(rows), longest + 1):
        for edits in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(rows):
                continue
            at, cost, state = 0, 0, 0
            ok = True
            for e in edits:
                if e == "I":
                    cost, state = cost + 2, {0: 2, 1: 2, 2: 3, 3: 2}[state]
                    continue
                role, must, cut = rows[at]
                at += 1
                if e == "D":
                    cost += 3
                    continue
                to = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state].get(role) if e == "K" else {0: 2, 1: 2, 2: 3, 3: 2}[state]
                if must or to is None:
                    ok = False
                    break
                cost, state = cost + (2 if e == "R" else 0) + cut, to
            if ok and state in (0, 3):
                best = min(best or (cost, "".join(edits)), (cost, "".join(edits)))
    return best


def test_cheapest_of_all_edit_sequences():
    r = random.Random(21)
    for _ in range(60):
        rows = [(r.choice("suax"), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(0, 4))]
        conv = CR.Conversation(0, CR.Steps())
        for i, (role, must, cut) in enumerate(rows):
            conv.add(i, role, "" if must else f"text {i}" + ("" if cut else "."), False)
        got = conv.result()
        assert (got[6], got[7]) == all_sequences(rows, len(rows) + 3)


def random_conversations(r, n):
    rows = []
    for c in range(n):
        turns = r.randint(0, 9)
        role = "user"
        for t in range(turns):
            said = r.choice(["Hello there.", "what", "A b. C", "", " \t", None, f"t{t}?", f"long {t} text!", "日本。", "end. \n"])
            who = r.choice([role, role, role, "assistant", "system", "tool", None, "", "u"])
            rows.append((None if c % 17 == 0 else c, r.choice([t, t, t, t + 1, None, 2 * t]), who, said))
            role = "assistant" if role == "user" else "user"
            if r.random() < 0.1:
                rows.append(rows[-1])
    return rows


def brute_damage(rows):
    kinds = defaultdict(list)
    for conv, turn, role, text in rows:
        here = kinds[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        here += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for here in kinds.values():
        here.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    return kinds


def test_op12_query(spark, tmp_dir):
    rows = random_conversations(random.Random(22), 300)
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]  # a long conversation
    rows += [(901, t, "x", f"turn {t}.") for t in range(3000)]  # no role fits: two ways stay open to the end
    schema = "conv_id long, turn long, role string, text string, audit string, copies int"
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], schema)
    df.repartition(5).write.parquet(f"{tmp_dir}/conversations.parquet")
    want = {c: (c, *brute_repair(x)) for c, x in brute_damage(rows).items()}
    got = {x.conv_id: tuple(x) for x in Q.op12_conversation_repair(spark, tmp_dir).collect()}
    assert got == want
    assert CR.repair_conversations(df.limit(0)).collect() == []


def test_repaired_turns_are_what_was_hashed(spark):
    rows = random_conversations(random.Random(23), 120)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").cache()
    verdicts = CR.repair_conversations(df).cache()
    said = defaultdict(list)
    for x in CR.repaired_turns(df, verdicts).collect():
        said[x.conv_id].append((x.place, f"{x.role}:{x.text}"))
    for v in verdicts.collect():
        places, lines = zip(*sorted(said[v.conv_id])) if said[v.conv_id] else ((), ())
        assert places == tuple(range(1, len(places) + 1)) and sha("\n".join(lines)) == v.repaired_sha256


# ---- op13 ----

def brute_dedup(rows, min_chars=40, min_docs=5):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).encode().lower().decode()
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    top = lambda docs: max((d for d in docs if d is not None), default=None)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or top(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shared_line_rows(r):
    common = [f"Shared line number {k} that is long enough to count here" for k in range(12)]
    common += ["x" * 40, "x" * 39, "é" * 40, "É" * 40, "Z" * 45, "z" * 45]
    rows = []
    for d in range(200):
        lines = []
        for _ in range(r.randint(0, 8)):
            x = r.choice(common)
            lines.append(r.choice([x, x.upper() if x.isascii() else x, "  " + x + "\t", x + "\x0b\r", x + " "]) if r.random() < 0.5
                         else f"own line {d} {r.random()} which nobody else has at all")
        rows.append((d, r.choice(["", "\n"]) + "\n".join(lines) + r.choice(["", "\n"])))
    hot = "This one very common line stands in nearly every single document."
    rows = [(d, t + "\n" + hot if d % 3 else t) for d, t in rows]
    rows += [(None, hot + "\n" + common[0]), (None, common[1]), (None, None), (500, None), (501, ""), (502, "\n"), (502, hot), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(600, "\n".join([hot, common[0]] * 3000))]
    return rows


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_op13_query(spark, tmp_dir, partitions):
    rows = shared_line_rows(random.Random(31))
    spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, n_lines int, keep string").repartition(4) \
        .write.parquet(f"{tmp_dir}/documents.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # hot lines then span many tasks
        got = [tuple(x) for x in Q.op13_line_dedup(spark, tmp_dir).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=repr) == sorted(brute_dedup(rows), key=repr)
    assert LD.dedup_lines(spark.read.parquet(f"{tmp_dir}/documents.parquet").limit(0)).collect() == []


def test_hot_line_is_spread_and_bitmaps_cut_the_text(spark):
    line = "One very common line that is in each and every document of all"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + "\nkept "), F.col("id").cast("string"), F.lit("\n" + line)).alias("text"))
    bitmaps = LD.keep_bitmaps(docs).collect()
    assert {x.doc_id for x in bitmaps} == set(range(3999))
    assert LD.kept_lines(f"{line}\nkept 5\n{line}", bitmaps[0].keep) == (3, 2, "kept 5")
    # The stream over a part in the middle of a hot key decides nothing by itself.
    import pyarrow as pa
    schema = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("line", pa.int32())])
    part = pa.record_batch([pa.array([1] * 9), pa.array([2] * 9), pa.array(range(9, 0, -1)), pa.array([0] * 9), pa.array([0] * 9, pa.int32())],
                           names=["h1", "h2", "doc_id", "row", "line"])
    kinds = [k for b in LD._first_occurrences(5, schema)(iter([part])) for k in b.column(0).to_pylist()]
    assert kinds.count(LD.OPEN) == 9 and kinds.count(LD.SEEN) == 5 and LD.DROPPED not in kinds
