"""Near-duplicates by DartMinHash signatures over weighted word shingles.

Signature.  Each element (a run of five words, weighted by how often the text has
it) owns the half-plane weight x rank.  Its weight axis is cut into the regions
[0,1), [1,2), [2,4), [4,8), ...; into each, darts are thrown by hashing, one after
the other in rising rank, as a Poisson process whose rate is the region's width.
A dart counts for a text if its weight coordinate is below the element's weight
there.  Each dart belongs to one of ``k`` coordinates; the signature keeps, for each,
the dart of least rank.  Two texts agree in a coordinate with the probability of
their weighted Jaccard similarity.  Only darts of rank below (k ln k + 2k) / total
weight are thrown, about k ln k + 2k in all whatever the text's length; texts with
an empty coordinate get twice that, until none is empty.

Join.  ``rows`` neighbouring coordinates make a band; equal bands make texts
candidates.  Equal texts are one node from the start, so a group of exact copies
costs one.  First, ``TURNS`` join what is alike at little cost: in the first turn
each text is compared with one of its buckets' greatest nodes; in later
turns, where a bucket still has members of several classes, those outside its largest
class are compared with ``TURNS[t]`` of the members drawn from that class and from one
other class.  Members that share more bands with the text go first.  Each
comparison is exact, on all shingles of both whole texts.

The turns only save work.  After them ``_remaining`` takes every pair of texts that
share a band and are still in different classes, once, in the first band they share.
Pairs are left out only where no comparison can link them: their classes have been
joined, or a bound shows that they cannot reach the threshold (a prefix of rare shingles,
below; the smaller total over the larger one; the sum of the smaller counts when shingles are
counted in hash bins).

Prefix.  In any order of all shingles, two texts of similarity t share one of their first
(1 - t) |text| + 1.  The order puts those that many texts have last (by a table of counts
of fixed size, which decides the cost and not the result).  Before any text is fetched, a text stays
in a bucket only if a text of another class in it has one of its first shingles.  Pages of one
template that are no duplicates share no rare shingles, so a bucket full of them empties.
Buckets are cut into blocks of texts of one size zone, and of one class where that is
large, and the blocks are paired, so no task holds a whole bucket; blocks of one class
are not paired with each other.  Links, classes and signatures stay in Spark
throughout; classes are found by contracting each node into its greatest neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm import hashing as H
from shopflow.llm.common import map_batches, written

WORDS = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 5
#: Comparisons of a text in each of the turns that come before all remaining pairs.
TURNS = (1, 8, 16)
#: About the most texts and text bytes of a block of a bucket, and the hash bins of a text's shingles.
BLOCK_TEXTS, BLOCK_PART_BYTES, BINS = 512, 4 << 20, 256
#: Hash buckets in which texts are counted by shingle, to tell common ones from rare ones.
COMMON = 1 << 18
#: Text bytes whose signatures are computed at once.
BLOCK_BYTES = 1 << 20


def dart_signatures(items: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """DartMinHash of ``n_docs`` weighted sets: an (n_docs, k) array of dart ids.

    ``items``, ``doc``, ``weight`` give the elements (64-bit hash), the set and the
    positive weight.  Sets without elements have zeros.
    """
    out = np.zeros((n_docs, k), np.uint64)
    if not len(items):
        return out
    total = np.bincount(doc, weight, n_docs)
    limit = np.divide(k * math.log(k) + 2 * k, total, out=np.zeros(n_docs), where=total > 0)
    # one row for each element and weight region: [0,1), then [2**(v-1), 2**v) for v >= 1
    regions = 1 + np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1.0))), 0).astype(np.int64)
    row = np.repeat(np.arange(len(items)), regions)
    v = np.arange(len(row)) - np.repeat(np.cumsum(regions) - regions, regions)
    low = np.where(v == 0, 0.0, 2.0 ** (v - 1.0))
    width = np.where(v == 0, 1.0, low)
    with np.errstate(over="ignore"):
        seed = H.mix(items[row] + H.mix(v.astype(np.uint64) + np.uint64(1)))
    set_, most = doc[row], weight[row].astype(np.float64)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        live = np.isin(set_, todo)
        s, d, lo, w, x = seed[live], set_[live], low[live], width[live], most[live]
        rank = np.zeros(len(s))
        keys, ranks, ids = [], [], []
        j = 0
        while len(s):  # the next dart of each region, as long as it is below the limit
            j += 1
            with np.errstate(over="ignore"):
                dart = H.mix(s + H.mix(np.full(1, j, np.uint64))[0])
                second = H.mix(dart ^ np.uint64(0xD1B54A32D192ED03))
            rank = rank - np.log(H.uniform(dart)) / w
            on = rank <= limit[d]
            s, d, lo, w, x, rank, dart, second = (a[on] for a in (s, d, lo, w, x, rank, dart, second))
            hit = lo + H.uniform(H.mix(second)) * w < x
            keys.append(d[hit] * k + (second[hit] % np.uint64(k)).astype(np.int64))
            ranks.append(rank[hit])
            ids.append(dart[hit])
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(ids)
        least = np.full(n_docs * k, np.inf)
        np.minimum.at(least, key, rank)
        first = rank == least[key]
        flat = out.reshape(-1)
        flat[key[first]] = dart[first]
        empty = np.isinf(least.reshape(n_docs, k)).any(1)
        todo = todo[empty[todo]]
        out[todo] = 0
        limit[todo] *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) hashes of ``rows`` neighbouring coordinates each."""
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            acc = H.mix(acc * np.uint64(0x9E3779B97F4A7C15) + signature[:, r : bands * rows : rows])
    return acc


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return H.weighted(*H.shingles(*H.words(data, offsets), n))


def _sketch(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = H.text_buffer(b.column(2))
            for lo, hi in H.blocks(offsets, BLOCK_BYTES):
                items, doc, count = _shingles(data, offsets[lo : hi + 1], words)
                sig = band_hashes(dart_signatures(items, doc, count, hi - lo, bands * rows), bands, rows)
                filled = np.isin(np.arange(hi - lo), doc)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(filled * bands)], pa.int32()), pa.array(sig[filled].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), lists],
                                                 names=["doc_id", "node", "bands"])
    return run


def weighted_jaccard(a: str, b: str, words: int = WORDS) -> float:
    """Sum of the smaller counts over sum of the larger ones; 1 for two texts without words."""
    sides = []
    for t in (a, b):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        sides.append(_shingles(raw, np.array([0, len(raw)], np.int64), words))
    return _similarity(*sides)


def _similarity(x, y) -> float:
    total = int(x[2].sum() + y[2].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[2][i], y[2][j]).sum())
    return both / (total - both)


def _compare(words: int):
    """Rows (label, pivot, other label, text, pivot's text) -> (label, other label, similarity)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            found = []
            left, right = (H.text_buffer(batch.column(i)) for i in (3, 4))
            for r, pivot in enumerate(batch.column(1).to_pylist()):
                if pivot != known[0]:
                    known = (pivot, _shingles(right[0], right[1][r : r + 2], words))
                found.append(_similarity(_shingles(left[0], left[1][r : r + 2], words), known[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.float64())],
                                             names=["label", "other", "similarity"])
    return run


def text_key(text: Column) -> Column:
    """128 bits of a text's SHA-256; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def contract(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) with the labels of linked nodes made one; ``links``: (a, b) pairs of labels, either way.

    Each label goes to its greatest neighbour's if that is greater, then to where that one
    went (pivots are the greatest nodes, so a star takes one round); links between labels that are still different go on to the next round.
    Every step is written to the shared folder.
    """
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.max("b").alias("b")).select(F.col("a").alias("x"), F.greatest("a", "b").alias("r"))
        # every target is a row of its own, so the join is complete
        root = written(up.join(up.select(F.col("x").alias("r"), F.col("r").alias("next")), "r").select("x", F.col("next").alias("r")), "dedup-root")
        labels = (labels.join(root.select(F.col("x").alias("label"), "r"), "label", "left")
                  .select("node", F.coalesce("r", "label").alias("label")))
        a, b = (root.select(F.col("x").alias(s), F.col("r").alias(f"r{s}")) for s in "ab")
        links = written(links.join(a, "a").join(b, "b").where("ra != rb")
                        .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "dedup-links")
        if links.isEmpty():
            return written(labels, "dedup-labels")


def duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                      words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each document: doc_id, class_id, class_rows, is_kept.

    Texts whose weighted Jaccard similarity over runs of ``words`` words is at
    least ``threshold`` are linked; a class is a set of texts joined by links, and
    ``class_id`` its least doc_id.  Equal texts always share a class; null counts as
    empty.  Texts without words are linked to equal ones only; a text of fewer than ``words`` words
    has one shingle.  ``is_kept`` is true for one row of each class: the one with
    the least doc_id (null ids only if there is no other), then the least text hash; equal
    rows are kept together, as nothing tells them apart.
    """
    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("node"),
                          F.col(text).alias("text"))
    sketch = written(map_batches(rows_in, _sketch(words, bands, rows), "doc_id long, node binary, bands array<long>"), "dedup-sketch")
    nodes = written(sketch.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"),
                                               F.first("bands").alias("bands")), "dedup-nodes")
    placed = nodes.select("node", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("band")
    members = written(placed.join(shared, "band"), "dedup-members")
    labels = nodes.select("node", F.col("node").alias("label"))
    if not members.isEmpty():
        wanted = members.select("node").distinct()
        # A text is fetched by its node and least doc_id, so its copies go to other tasks and are not fetched.
        one = nodes.join(wanted, "node").select(F.col("node").alias("w"), "least")
        texts = written(rows_in.join(one, (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
                        .groupBy("node").agg(F.first("text").alias("text")), "dedup-texts")
        labels = _linked(members, texts, written(wanted.select("node", F.col("node").alias("label")), "dedup-labels"),
                         threshold, words)
        alone = nodes.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label"))
        labels = labels.unionByName(alone)
    named = written(nodes.join(labels, "node").select("node", "label", "least", "n"), "dedup-named")
    order = F.struct(F.col("least").isNull().alias("x"), F.col("least").alias("y"), F.col("node").alias("z"))
    classes = named.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_rows"),
                                         F.min(order)["z"].alias("kept"))
    member = named.join(classes, "label").select("node", "class_id", "class_rows", F.col("least").alias("__least"),
                                                 (F.col("node") == F.col("kept")).alias("__kept"))
    return (sketch.select("doc_id", "node").join(member, "node")
            .select("doc_id", "class_id", "class_rows",
                    (F.col("__kept") & F.col("doc_id").eqNullSafe(F.col("__least"))).alias("is_kept"), "node"))


def _candidates(members: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(node, label, pivot, other): what is compared in this turn, with the labels of both."""
    k = TURNS[turn]
    if turn == 0:  # every text is a class of its own
        greatest = members.groupBy("band").agg(F.max("node").alias("pivot"))
        proposed = members.join(greatest, "band").where("node != pivot").select(
            "node", F.col("node").alias("label"), "pivot", F.col("pivot").alias("other"))
    else:
        at = members.join(labels, "node")
        drawn = [F.min(F.struct(F.xxhash64("node", F.lit(turn * 100 + i)).alias("h"), "node")).getField("node") for i in range(k)]
        classes = at.groupBy("band", "label").agg(F.count("*").alias("n"), F.array(*drawn).alias("nodes"))
        buckets = classes.groupBy("band").agg(
            F.max(F.struct("n", "label", "nodes")).alias("large"),
            F.min(F.struct(F.xxhash64("label", F.lit(turn)).alias("h"), "label", "nodes")).alias("some"),
            F.count("*").alias("classes")).where("classes > 1").drop("classes")
        own = at.join(buckets, "band").where("label != large.label")
        pivots = F.transform(F.col("large.nodes"), lambda p: F.struct(p.alias("pivot"), F.col("large.label").alias("other")))
        extra = F.when((F.col("some.label") != F.col("label")) & (F.col("some.label") != F.col("large.label")), F.array(
            F.struct(F.get("some.nodes", F.lit(0)).alias("pivot"), F.col("some.label").alias("other"))))
        proposed = own.select("node", "label", F.inline(F.concat(pivots, F.coalesce(extra, F.array().cast(
            "array<struct<pivot:binary,other:binary>>")))))
    # by node: the counts, the choice and the join with the texts need no other shuffle
    proposed = proposed.repartition("node")
    pairs = proposed.groupBy("node", "label", "pivot", "other").agg(F.count("*").alias("shared"))
    order = Window.partitionBy("node").orderBy(F.desc("shared"), F.xxhash64("pivot", F.lit(turn)), "pivot")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place", "shared")


def _linked(members: DataFrame, texts: DataFrame, labels: DataFrame, threshold: float, words: int) -> DataFrame:
    for turn in range(len(TURNS)):
        pairs = _candidates(members, labels, turn)
        sides = (pairs.join(texts.select("node", F.col("text").alias("ta")), "node")
                 .join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("tb")), "pivot"))
        found = map_batches(sides.select("label", "pivot", "other", "ta", "tb"),
                            _compare(words), "label binary, other binary, similarity double")
        links = written(found.where(F.col("similarity") >= threshold)
                        .select(F.col("label").alias("a"), F.col("other").alias("b")).distinct(), "dedup-links")
        if not links.isEmpty():
            labels = contract(links, labels)
    links = written(_remaining(members, texts, labels, threshold, words).distinct(), "dedup-links")
    return labels if links.isEmpty() else contract(links, labels)


def _sizes(words: int):
    """Rows (node, text) -> (node, total count of shingles, text bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = H.text_buffer(b.column(1))
            for lo, hi in H.blocks(offsets, BLOCK_BYTES):
                _, doc, count = _shingles(data, offsets[lo : hi + 1], words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.bincount(doc, count, hi - lo).astype(np.int64)),
                     pa.array(np.diff(offsets[lo : hi + 1]).astype(np.int64))], names=["node", "total", "bytes"])
    return run


def _common(words: int):
    """Rows (node, text) -> (bucket, texts): in how many texts of a block a shingle's bucket occurs, where in several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = H.text_buffer(b.column(1))
            for lo, hi in H.blocks(offsets, BLOCK_BYTES):
                items, doc, _ = _shingles(data, offsets[lo : hi + 1], words)
                bucket = (H.mix(items) % np.uint64(COMMON)).astype(np.int64)
                n = np.bincount(np.unique(doc * COMMON + bucket) % COMMON, minlength=COMMON)
                several = np.flatnonzero(n > 1)
                yield pa.RecordBatch.from_arrays([pa.array(several), pa.array(n[several])], names=["bucket", "texts"])
    return run


def prefix_tokens(items: np.ndarray, doc: np.ndarray, count: np.ndarray, common: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(token, text number) of each text's prefix, rare shingles first.

    Each copy of a shingle is a token, so that a weighted similarity is that of token sets.
    """
    order = np.lexsort((items, common[(H.mix(items) % np.uint64(COMMON)).astype(np.int64)], doc))
    items, doc, count = items[order], doc[order], count[order]
    if not len(items):
        return np.zeros(0, np.uint64), doc
    total = np.bincount(doc, count).astype(np.int64)
    first = total - np.ceil(threshold * total * (1 - 1e-9)).astype(np.int64) + 1
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    before = np.cumsum(count) - count
    before -= np.repeat(before[heads], np.diff(np.r_[heads, len(doc)]))
    taken = np.clip(first[doc] - before, 0, count)
    copy = np.arange(int(taken.sum())) - np.repeat(np.cumsum(taken) - taken, taken)
    with np.errstate(over="ignore"):
        return H.mix(np.repeat(H.mix(items), taken) + copy.astype(np.uint64)), np.repeat(doc, taken)


def _prefixes(words: int, threshold: float, common: np.ndarray):
    """Rows (node, text) -> (node, token)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = H.text_buffer(b.column(1))
            for lo, hi in H.blocks(offsets, BLOCK_BYTES):
                token, doc = prefix_tokens(*_shingles(data, offsets[lo : hi + 1], words), common, threshold)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc + lo)), pa.array(token.view(np.int64))], names=["node", "token"])
    return run


def _with_partners(open_: DataFrame, texts: DataFrame, threshold: float, words: int) -> DataFrame:
    """The rows of ``open_`` (band, node, label) whose node shares a prefix token with a node of another label in the same band."""
    at = written(texts.join(open_.select("node").distinct(), "node").select("node", "text"), "dedup-open-texts")
    common = np.zeros(COMMON, np.int64)
    # a table of fixed size, whatever the corpus
    got = map_batches(at, _common(words), "bucket long, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts")).toArrow()
    common[got["bucket"].to_numpy()] = got["texts"].to_numpy()
    labels = open_.select("node", "label").distinct()
    tokens = written(map_batches(at, _prefixes(words, threshold, common), "node binary, token long").join(labels, "node"), "dedup-prefixes")

    def several(rows: DataFrame, *keys: str) -> DataFrame:
        """Rows whose key has several labels."""
        keys_ = rows.groupBy(*keys).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select(*keys)
        return rows.join(keys_, list(keys))

    shared = written(several(tokens, "token"), "dedup-shared")
    both = several(shared.join(open_.select("node", "band"), "node"), "band", "token")
    return both.select("band", "node", "label").distinct()


def _remaining(members: DataFrame, texts: DataFrame, labels: DataFrame, threshold: float, words: int) -> DataFrame:
    """(a, b): the labels of all linked texts that share a band and have different labels.

    Each such pair is met in one pair of blocks of the first band that it shares.
    """
    at = members.join(labels, "node")
    mixed = at.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("band")
    open_ = written(at.join(mixed, "band").select("band", "node", "label"), "dedup-open")
    if not open_.isEmpty():
        open_ = written(_with_partners(open_, texts, threshold, words), "dedup-partners")
    if open_.isEmpty():
        return labels.select(F.col("label").alias("a"), F.col("label").alias("b")).limit(0)
    whose = open_.groupBy("node").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    mine = texts.join(whose, "node")
    sizes = map_batches(mine.select("node", "text"), _sizes(words), "node binary, total long, bytes long")
    # texts of zones that are not the same or neighbours are too unlike in size
    zone = F.floor(F.log(F.greatest(F.col("total"), F.lit(1))) / F.lit(math.log(1 / threshold) * (1 + 1e-6))) if 0 < threshold < 1 else F.lit(0)
    placed = written(open_.join(sizes.withColumn("zone", zone.cast("int")), "node"), "dedup-placed")

    def parts(n: str, size: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / BLOCK_TEXTS), F.ceil(F.col(size) / BLOCK_PART_BYTES), F.lit(1)).cast("int")

    classes = placed.groupBy("band", "zone", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("size")).withColumn(
        "large", (F.col("n") > BLOCK_TEXTS) | (F.col("size") > BLOCK_PART_BYTES))
    # a large class has blocks of its own; the others of a zone share blocks (only: the class of a block of one class)
    units = (classes.withColumn("unit", F.when(F.col("large"), F.col("label")))
             .groupBy("band", "zone", "unit").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
             .select("band", "zone", "unit", parts("n", "size").alias("parts"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("only")))
    units = written(units, "dedup-units")
    blocks = units.select("band", "zone", "only", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                          F.coalesce("unit", F.lit(b"")).alias("unit"))
    x, y = (blocks.select("band", *[F.col(c).alias(f"{c}_{s}") for c in ("zone", "unit", "part", "only")]) for s in "ab")
    later = F.struct("unit_b", "part_b") >= F.struct("unit_a", "part_a")
    tasks = written(x.join(y, "band").where(
        (((F.col("zone_a") == F.col("zone_b")) & later) | (F.col("zone_b") == F.col("zone_a") + 1))
        & ~F.coalesce(F.col("only_a") == F.col("only_b"), F.lit(False)))
        .withColumn("task", F.struct("zone_a", "unit_a", "part_a", "zone_b", "unit_b", "part_b")), "dedup-tasks")
    same = F.col("task.zone_a").eqNullSafe(F.col("task.zone_b")) & (F.col("task.unit_a") == F.col("task.unit_b")) & (
        F.col("task.part_a") == F.col("task.part_b"))
    sides = (tasks.select("band", F.col("zone_a").alias("zone"), F.col("unit_a").alias("unit"), F.col("part_a").alias("part"), "task",
                          F.when(same, 2).otherwise(0).alias("side"))
             .unionByName(tasks.where(~same).select("band", F.col("zone_b").alias("zone"), F.col("unit_b").alias("unit"),
                                                    F.col("part_b").alias("part"), "task", F.lit(1).alias("side"))))
    split = (placed.join(classes.select("band", "zone", "label", F.when(F.col("large"), F.col("label")).otherwise(F.lit(b"")).alias("unit")),
                         ["band", "zone", "label"])
             .join(units.select("band", "zone", F.coalesce("unit", F.lit(b"")).alias("unit"), "parts"), ["band", "zone", "unit"])
             .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    dealt = split.select("band", "zone", "unit", "part", "node", "label").join(sides, ["band", "zone", "unit", "part"])
    return (dealt.select("band", "task", "side", "node", "label").join(mine, "node")
            .select("band", "task", "side", "label", "bands", "text")
            .groupBy("band", "task").applyInArrow(_block_pairs(threshold, words), "a binary, b binary"))


def _block_pairs(threshold: float, words: int):
    """All rows of two blocks of a bucket (side 0 and 1, or 2: one block with itself) -> links between labels."""
    def run(table: pa.Table) -> pa.Table:
        band = table.column("band")[0].as_py()
        side = table.column("side").to_numpy()
        data, offsets = H.text_buffer(table.column("text").combine_chunks())
        items, doc, count = _shingles(data, offsets, words)
        n = len(table)
        edge = np.searchsorted(doc, np.arange(n + 1))
        sets = [(items[a:z], doc[a:z], count[a:z]) for a, z in zip(edge, edge[1:])]
        total = np.bincount(doc, count, n)
        bins = np.bincount(doc * BINS + (H.mix(items) % np.uint64(BINS)).astype(np.int64), count, n * BINS).reshape(n, BINS)
        names, label = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)
        # bands below this one: a pair that shares one of them is met there
        below = [frozenset(x for x in row if x < band) for row in table.column("bands").to_pylist()]
        root = list(range(len(names)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        right = np.flatnonzero(side != 0)
        links = []
        for i in np.flatnonzero(side != 1).tolist():
            js = right[right > i] if side[i] == 2 else right
            js = js[label[js] != label[i]]
            both = total[i] + total[js]
            js = js[np.minimum(np.minimum(total[i], total[js]), np.minimum(bins[js], bins[i]).sum(1)) * (1 + threshold) >= threshold * both * (1 - 1e-6)]
            for j in js.tolist():
                a, b = find(label[i]), find(label[j])
                if a != b and below[i].isdisjoint(below[j]) and _similarity(sets[i], sets[j]) >= threshold:
                    root[a] = b
                    links.append((names[label[i]], names[label[j]]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([x for _, x in links], pa.binary())})
    return run
