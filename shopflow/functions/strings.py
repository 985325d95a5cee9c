"""String functions (X1, X12-X17, X19, X20) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_long_string(v: Column | str, s: Column | str, sep: str) -> Column:
    """``<number><sep><text>``, e.g. ``3;广州``; NULL if either is NULL."""
    return F.concat(_col(v).cast("string"), F.lit(sep), _col(s))


def is_empty(c: Column | str) -> Column:
    """NULL or the empty string."""
    return F.coalesce(_col(c), F.lit("")) == F.lit("")


def is_not_empty(c: Column | str) -> Column:
    """Neither NULL nor the empty string."""
    return ~is_empty(c)


def trim_comma(c: Column | str) -> Column:
    """Remove commas on both ends."""
    return F.btrim(_col(c), F.lit(","))


def pad_two(c: Column | str) -> Column:
    """Left-pad to two characters with ``0``; longer text stays as it is."""
    text = _col(c)
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def kv_get(c: Column | str, key: str) -> Column:
    """Value of the first ``key=value`` entry of ``k=v|k=v`` text; NULL if there is none.

    An entry counts if it has one value and nothing but ``=`` after it.
    """
    pattern = f"^\\Q{key}\\E=([^=]+)=*$"
    entry = F.get(F.filter(F.split(_col(c), "[|]"), lambda e: e.rlike(pattern)), F.lit(0))
    return F.regexp_extract(entry, pattern, 1)


def kv_set(c: Column | str, key: str, value: Column | str) -> Column:
    """Set ``key`` to ``value`` in ``k=v|k=v`` text.

    Of entries with the same key the last one stays; the result is sorted by key.
    """
    v = F.lit(value) if isinstance(value, str) else value
    entries = F.transform(F.split(_col(c), "[|]"), lambda e: F.struct(
        F.get(F.split(e, "="), F.lit(0)).alias("k"), F.get(F.split(e, "="), F.lit(1)).alias("v")))
    last = F.filter(entries, lambda e, i: (e["k"] != F.lit(key)) & ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["k"] == e["k"]))
    merged = F.array_sort(F.array_append(last, F.struct(F.lit(key).alias("k"), v.alias("v"))))
    return F.array_join(F.transform(merged, lambda e: F.concat_ws("=", e["k"], e["v"])), "|")


def java_split_space(c: Column | str) -> Column:
    """Tokens of ``line.split(" ")`` as Java computes them.

    Inner empty tokens stay, trailing ones are dropped; an empty line gives
    one empty token and a line of spaces none.
    """
    line = _col(c)
    trimmed = F.rtrim(line)  # rtrim removes trailing spaces only
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def flow_pairs(flow: list[int] | tuple[int, ...]) -> list[tuple[int, str]]:
    """A page flow 1,2,3 -> [(0, '1_2'), (1, '2_3')] in flow order."""
    return [(i, f"{a}_{b}") for i, (a, b) in enumerate(zip(flow[:-1], flow[1:]))]
