"""Document fingerprints from closed syncmers, by DataFrame functions only.

A text is read as units: whole runs of letters or of digits of at most ``UNIT`` characters, and
single other characters that are no white space; in a longer run (a script without
spaces, say) every character is a unit, so that what stands before a passage does not
shift its units.  A k-mer is a run of ``K`` units,
an inner substring (s-mer) a run of ``S`` of them.  A k-mer is a closed syncmer
if its s-mer of least hash is its first or its last; whether it is chosen depends
on its own units only, so equal passages have equal anchors wherever they stand, and
each window of K - S + 1 k-mers has one at least.  The text is taken as if
``K - S`` end marks stood before and after, so that short texts have anchors too.

The fingerprint is the list of the chosen k-mers' 32-bit hashes in text order, as
hexadecimal digits.  Two fingerprints' likeness is the Jaccard similarity of
their anchors; two empty ones are alike.  Positions of equal anchors line two
texts up: ``matched_positions`` gives them as pairs, ``in_place`` the share of anchors that
both texts have at one distance from their beginning.

A task holds a row's text, its units and its anchors several times over, some 50 times the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 8, 2
UNIT = 24
PATTERN = rf"(?<![\p{{L}}\p{{M}}])[\p{{L}}\p{{M}}]{{1,{UNIT}}}(?![\p{{L}}\p{{M}}])|(?<!\p{{N}})\p{{N}}{{1,{UNIT}}}(?!\p{{N}})|\S"
#: Range slices for each shuffle partition.
SLICES_EACH = 4


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<position, hash>> of a text's closed syncmers (position: number of the k-mer's first unit)."""
    pad = F.array_repeat(F.lit(""), k - s)
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))
    padded = F.when(F.size(units) > 0, F.concat(pad, units, pad)).otherwise(F.array().cast("array<string>"))

    def inner(u: Column) -> Column:  # hash of the s-mer at each place
        n = F.size(u) - s + 1
        return F.transform(F.slice(u, 1, F.greatest(n, F.lit(0))),
                           lambda _, i: F.xxhash64(*[F.get(u, i + j) for j in range(s)]))

    def closed(u: Column, h: Column) -> Column:
        w = k - s  # the last s-mer of a k-mer is w places after its first
        n = F.greatest(F.size(h) - w, F.lit(0))
        marked = F.transform(F.slice(h, 1, n), lambda first, i: F.when(
            F.least(first, F.get(h, i + w)) <= F.least(*[F.get(h, i + j) for j in range(1, w)]),
            F.struct(i.alias("position"), F.hash(*[F.get(h, i + j) for j in range(0, w + 1, s)], F.get(h, i + w)).alias("hash"))))
        return F.filter(marked, lambda x: x.isNotNull())

    # each array is bound once by transforming a list that holds it alone
    return F.get(F.transform(F.array(padded), lambda u: F.get(F.transform(F.array(inner(u)), lambda h: closed(u, h)), F.lit(0))), F.lit(0))


def anchor_hashes(text: Column) -> Column:
    return F.transform(anchors(text), lambda a: a["hash"])


def fingerprint(hashes: Column) -> Column:
    """Anchors' hashes in text order, 8 hexadecimal digits each."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two lists of anchors (0 to 1)."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def placed(found: Column) -> Column:
    """Position and hash of each anchor (``anchors``) in one number."""
    return F.transform(found, lambda a: F.shiftleft(a["position"].cast("long"), 32).bitwiseOR(a["hash"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))


def in_place(a: Column, b: Column) -> Column:
    """Of all anchors of two texts, given by ``placed``, the share that both have at the same position (0 to 1)."""
    return likeness(a, b)


def matched_positions(a: Column, b: Column) -> Column:
    """Pairs of positions of anchors (``anchors``) that are in both texts once each: where passages line up."""
    def once(x: Column) -> Column:
        hashes = F.transform(x, lambda e: e["hash"])
        return F.filter(x, lambda e: F.size(F.filter(hashes, lambda h: h == e["hash"])) == 1)

    return F.filter(F.transform(once(a), lambda x: F.struct(
        x["position"].alias("a"), F.get(F.filter(once(b), lambda y: y["hash"] == x["hash"]), F.lit(0))["position"].alias("b"))),
        lambda p: p["b"].isNotNull())


def with_next(docs: DataFrame, order: str, tie: str, columns: list[str],
              derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``derive(docs)`` with ``next_<c>`` of the row that follows in ascending (order, tie); the first after the last.

    Rows are dealt to range slices at quantiles of ``order`` and sorted inside each.  The
    last row of a slice takes the first row of the next one, which is fetched by
    its key.  A value that fills whole slices by itself is split further by ``tie`` (a
    long, well spread).  So the rows are shuffled once, and one narrow row for each
    slice meets in one place.  ``order`` must be a long; nulls go first.
    """
    n = SLICES_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 10_000).alias("q")).first().q or []
    hot = sorted({x for x, y in zip(cuts, cuts[1:]) if x == y})
    bounds = sorted({*cuts} | {x + 1 for x in hot})
    # two levels, so that a row is compared with about twice the root of the number of bounds
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= F.col(order)))

    place = F.lit(0)
    if groups:
        major = at_most(longs([g[0] for g in groups]))
        minor = at_most(F.get(F.array(*[longs(g) for g in groups]), major - 1))
        place = F.when(major == 0, F.lit(0)).otherwise((major - 1) * step + minor)
    is_hot = F.col(order).isNull() | F.col(order).isin(*hot) if hot else F.col(order).isNull()
    sliced = docs.select("*", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(place).alias("__slice"),
                         F.when(is_hot, F.shiftright(F.col(tie), 56)).otherwise(F.lit(0)).alias("__sub"))
    # one narrow row for each slice: the key of the first row of the slice that follows it in the ring
    key = F.struct(F.col(order).alias("o"), F.col(tie).alias("t"))
    firsts = sliced.groupBy("__slice", "__sub").agg(F.min(key).alias("k"))
    ring = Window.orderBy("__slice", "__sub")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = firsts.select(F.col("__slice").alias("__s"), F.col("__sub").alias("__b"),
                           F.coalesce(F.lead("k").over(ring), F.first("k").over(whole)).alias("__k"))
    # As many rows as slices: SLICES_EACH for each shuffle partition, 256 more for each hot value.
    fetched = docs.join(F.broadcast(follow), F.col(order).eqNullSafe(F.col("__k.o")) & (F.col(tie) == F.col("__k.t")))
    heads = derive(fetched).dropDuplicates(["__s", "__b"]).select("__s", "__b", *[F.col(c).alias(f"__head_{c}") for c in columns])
    inside = Window.partitionBy("__slice", "__sub").orderBy(F.col(order).asc_nulls_first(), tie)
    derived = derive(sliced)
    chained = derived.select("*", *[F.lead(c).over(inside).alias(f"__next_{c}") for c in columns],
                             F.lead(F.lit(True)).over(inside).alias("__inner"))
    joined = chained.join(heads, (F.col("__slice") == F.col("__s")) & (F.col("__sub") == F.col("__b")) & F.col("__inner").isNull(), "left")
    kept = [c for c in derived.columns if c not in ("__slice", "__sub")]
    return joined.select(*kept, *[F.when(F.col("__inner"), F.col(f"__next_{c}")).otherwise(F.col(f"__head_{c}")).alias(f"next_{c}")
                                  for c in columns])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    The edited text has its last floor(n_chars / 4) characters replaced by the first as many
    (or all) of the next document in ascending doc_id (null ids first, ties by the text's
    hash; after the last document comes the first).  Null counts as empty.  ``near_*``
    is ``likeness``; ``in_place_edited`` also asks for equal positions.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    both = with_next(rows, "doc_id", "tie", ["text", "own"], lambda df: df.withColumn("own", placed(anchors(F.col("text"))))).select(
        "doc_id", n.cast("long").alias("n_chars"), "own", F.col("next_own").alias("next"),
        F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)).alias("edited"))
    both = both.select("*", placed(anchors(F.col("edited"))).alias("other"))
    hashes = {c: F.transform(c, lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))) for c in ("own", "other", "next")}
    both = both.select("*", *[h.alias(f"{c}_hashes") for c, h in hashes.items()])
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own_hashes")).alias("fingerprint"),
        fingerprint(F.col("other_hashes")).alias("edited_fingerprint"), likeness(F.col("own_hashes"), F.col("other_hashes")).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"), in_place(F.col("own"), F.col("other")).alias("in_place_edited"))
