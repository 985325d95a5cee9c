"""Membership in a large set of ids by bitmaps.

A blacklist of many ids is turned into one bitmap for each 32,768 neighbouring ids, which
is 4 kB whatever it holds; a list of 100 million ids of a dense range is some 12 MB so,
where the ids themselves would be some gigabytes in a hash table.  The bitmaps go to all tasks, and the
log is filtered where it is read: no row of it is shuffled.  Their number is counted
before; ids so scattered that the bitmaps would pass the bound take the plain anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.config import fresh_dir
from shopflow.operators.joins import exclude_keys

#: Words of 64 bits in a bitmap, and the bytes a bitmap takes in a broadcast at most.
WORDS, BITMAP_BYTES = 512, 4_608
#: Bitmaps are sent to all tasks up to so many bytes.
MAX_BYTES = 256 << 20


def id_bitmaps(ids: DataFrame, col: str) -> DataFrame:
    """(bucket, words): the ids of ``col`` as bits; NULLs are left out.

    Bit ``p`` of a bucket is the bit ``p % 8`` of byte ``p / 8``; a word holds eight
    bytes, the first one highest.
    """
    bits = ids.where(F.col(col).isNotNull()).groupBy(F.bitmap_bucket_number(col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(col)).alias("bits"))
    word = lambda w: F.conv(F.hex(F.substring("bits", w * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return bits.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word).alias("words"))


def has_bit(words: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set; NULL words have none."""
    word = F.element_at(words, (F.shiftright(position, 6) + 1).cast("int"))
    place = (F.lit(7) - F.shiftright(position, 3).bitwiseAND(F.lit(7))) * 8 + position.bitwiseAND(F.lit(7))
    return F.coalesce(F.getbit(word, place.cast("int")) == 1, F.lit(False))


def exclude_ids(df: DataFrame, excluded: DataFrame, col: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not among ``excluded``'s; a NULL id is on no list.

    The bitmaps are written to the shared folder and counted; beyond ``max_bytes`` it is ``exclude_keys``.
    """
    path = fresh_dir(df.sparkSession, "bitmaps")
    id_bitmaps(excluded.select(col), col).write.parquet(path)
    bitmaps = df.sparkSession.read.parquet(path)
    if bitmaps.count() * BITMAP_BYTES > max_bytes:
        return exclude_keys(df, excluded, [col])
    side = bitmaps.select(F.col("bucket").alias("__bucket"), F.col("words").alias("__words"))
    both = df.join(F.broadcast(side), F.bitmap_bucket_number(df[col]) == F.col("__bucket"), "left")
    return both.where(~has_bit(F.col("__words"), F.bitmap_bit_position(df[col]))).select(*[df[c] for c in df.columns])
