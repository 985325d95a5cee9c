"""Packing by optimal length buckets and token-budget batches.

1. The global histogram of lengths is aggregated by Spark.  Lengths up to
   ``EXACT`` have a bin each; above, a bin spans 1/``EXACT`` of its length's
   power of two.  So it has at most ``EXACT * 40`` rows, however many documents
   there are; each bin keeps its rows, its tokens and its largest length.
2. Dynamic programming over the bins finds the bucket boundaries (lengths to
   which a bucket's documents are padded) with the least padding in all.
3. Inside each bucket, batches of ``budget // boundary`` documents (one at
   least) are formed.  A document's place in its bucket is its place in one of
   ``SLICES`` hash slices, plus the documents of the slices before; the slice
   counts are a table of at most buckets * SLICES rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT = 1 << 10
SLICES = 1 << 10


def length_bin(length: Column) -> Column:
    """The histogram bin of a length: itself up to ``EXACT``, then geometric steps; ascending in the length."""
    power = F.floor(F.log2(length / F.lit(EXACT)) + F.lit(1e-12)).cast("long")
    step = F.floor(length / F.pow(F.lit(2.0), power.cast("double"))).cast("long")  # EXACT .. 2 * EXACT - 1
    return F.when(length <= EXACT, length).otherwise(power * F.lit(EXACT) + step)


def optimal_boundaries(largest: np.ndarray, rows: np.ndarray, tokens: np.ndarray, n_buckets: int) -> list[int]:
    """At most ``n_buckets`` boundaries, among the bins' largest lengths, that minimise padding.

    Padding of bins i..j in one bucket: largest[j] * rows - tokens.  Tokens are the
    same for any choice, so the padded size is minimised.  best[j] = min over i of
    best'[i] + largest[j] * (rows up to j - rows up to i): for ascending j the
    lines' slopes (-rows up to i) fall and the queries (largest[j]) rise, so a
    convex hull gives each layer in linear time.  Exact integers throughout.
    """
    n = len(largest)
    if n == 0:
        return []
    total = [0, *np.cumsum(rows.astype(object)).tolist()]
    size = [int(x) for x in largest]
    best = [None] + [size[j] * total[j + 1] for j in range(n)]  # one bucket for the first j + 1 bins
    choice = []
    for _ in range(1, min(n_buckets, n)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        at, layer, came = 0, [None] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            i = j - 1
            if i >= 1 and best[i] is not None:
                line = (-total[i], best[i], i)
                while len(hull) >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (
                        hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            if hull:
                x = size[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                    at += 1
                layer[j], came[j] = hull[at][0] * x + hull[at][1] + x * total[j], hull[at][2]
        if layer[n] is None or layer[n] >= best[n]:
            break  # one more bucket saves nothing
        choice.append(came)
        best = layer
    out, j = [], n
    for came in reversed(choice):
        out.append(size[j - 1])
        j = came[j]
    return [size[j - 1], *reversed(out)]


def bucket_boundaries(docs: DataFrame, length: str, n_buckets: int) -> list[int]:
    """The boundaries for the whole table's lengths (nulls count as 0)."""
    col = F.coalesce(F.col(length), F.lit(0)).cast("long")
    bins = (docs.select(col.alias("l")).groupBy(length_bin(F.col("l")).alias("bin"))
            .agg(F.count("*").alias("rows"), F.sum("l").alias("tokens"), F.max("l").alias("largest")))
    h = sorted(bins.collect(), key=lambda r: r.largest)  # at most EXACT * 40 rows
    return optimal_boundaries(*(np.array([r[k] for r in h], object) for k in ("largest", "rows", "tokens")), n_buckets)


def pack(docs: DataFrame, length: str, key: list[str], budget: int, n_buckets: int = 16) -> DataFrame:
    """``docs`` with its bucket, the bucket's boundary, and its batch.

    Adds ``bucket`` (int, ascending), ``boundary`` (long), ``batch_rows`` (documents
    of a full batch), ``batch`` (number inside the bucket, long), ``slot`` (place in
    the batch, int), ``padding`` (long); columns of these names are replaced.  Each
    batch but a bucket's last is full, and padded to the boundary it holds at most
    ``budget`` tokens, unless one document alone has more.  ``key`` gives the
    order inside a hash slice and should tell rows apart (repeated rows are
    interchangeable).  A null length counts as 0.  An empty table gives none.
    """
    if budget < 1 or n_buckets < 1:
        raise ValueError("budget and n_buckets must be positive")
    added = ["bucket", "boundary", "batch_rows", "batch", "slot", "padding"]
    kept = [c for c in docs.columns if c not in added]
    bounds = bucket_boundaries(docs, length, n_buckets) or [0]
    size = F.coalesce(F.col(length), F.lit(0)).cast("long")
    bucket = sum((F.when(size > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0)).cast("int")
    spread = F.xxhash64(*key)
    rows = (docs.select(*kept, bucket.alias("bucket"), spread.alias("__h"))
            .withColumn("__slice", F.shiftrightunsigned("__h", 64 - SLICES.bit_length() + 1).cast("int")))
    counts = rows.groupBy("bucket", "__slice").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("bucket").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most n_buckets * SLICES narrow rows: small enough to send to all tasks.
    starts = counts.select("bucket", "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("bucket", "__slice").orderBy("__h", *key)
    place = F.col("__start") + F.row_number().over(inside) - 1
    edge = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1)
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("boundary")))).cast("long")
    return (rows.join(F.broadcast(starts), ["bucket", "__slice"])
            .withColumn("__place", place).withColumn("boundary", edge).withColumn("batch_rows", per)
            .select(*kept, "bucket", "boundary", "batch_rows",
                    F.expr("__place div batch_rows").alias("batch"),
                    F.expr("cast(__place % batch_rows as int)").alias("slot"),
                    (F.col("boundary") - size).alias("padding")))


def batches(packed: DataFrame, doc_id: str = "doc_id", length: str = "n_tokens") -> DataFrame:
    """One row for each batch of ``pack``'s result; a batch holds ``batch_rows`` documents at most."""
    return (packed.groupBy("bucket", "batch")
            .agg(F.first("boundary").alias("boundary"),
                 F.transform(F.array_sort(F.collect_list(F.struct("slot", F.col(doc_id).alias("id")))),
                             lambda x: x["id"]).alias("doc_ids"),
                 F.sum(length).alias("n_tokens"), F.sum("padding").alias("padding")))
