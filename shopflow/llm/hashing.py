"""Words and word shingles of whole Arrow text columns as 64-bit hashes, without a Python step per word.

A word is a run of bytes other than 0x09-0x0D and 0x20.  Its hash is made of polynomials
of its bytes modulo two primes, mixed; it does not depend on what stands around it.
(Modulo 2**64 every base has short texts that collide, such as Thue-Morse words.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once; bounds the memory of a step. Longer words are hashed in pieces.
BLOCK = 1 << 17
#: (prime, base) of each half of a hash: the greatest primes below 2**32 that fit, bases drawn at random.
FIELDS = ((4294967291, 0x1E94DDEF), (4294967279, 0xD3C58861))
_GOLDEN = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo ``prime``, doubled up."""
    out = np.ones(n, np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        have, step = have + more, step * step % prime
    return out


_POW: list[tuple[np.ndarray, np.ndarray]] = []


def _tables() -> list[tuple[np.ndarray, np.ndarray]]:
    if not _POW:
        _POW.extend((_powers(b, p, BLOCK), _powers(pow(b, -1, p), p, BLOCK)) for p, b in FIELDS)
    return _POW


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher, element by element."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts[i]:ends[i]]: its polynomials modulo two primes, side by side; ranges ascend and do not overlap.

    A term is below 2**9 * 2**32 and a block has 2**17, so its sums need no reduction.
    """
    halves = [_polynomials(data, starts, ends, prime, base, *tables) for (prime, base), tables in zip(FIELDS, _tables())]
    return (halves[0] << np.uint64(32)) | halves[1]


def _polynomials(data, starts, ends, prime: int, base: int, powers: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    p, i = np.uint64(prime), 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(ends, lo + BLOCK, "right"))
        if j > i:
            part = data[lo : int(ends[j - 1])].astype(np.uint64) + np.uint64(1)
            sums = np.r_[np.uint64(0), np.cumsum(part * powers[: len(part)])]
            a, b = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (sums[b] - sums[a]) % p * inverse[a] % p
            i = j
        else:  # one word longer than a block
            total, shift = 0, 1
            for at in range(lo, int(ends[i]), BLOCK):
                part = data[at : min(at + BLOCK, int(ends[i]))].astype(np.uint64) + np.uint64(1)
                total += int(np.sum(part * powers[: len(part)], dtype=np.uint64)) * shift
                shift = shift * pow(base, BLOCK, prime) % prime
            out[i] = np.uint64(total % prime)
            i += 1
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes in all."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each word of the texts data[offsets[i]:offsets[i + 1]], in order.

    ``lower`` folds A-Z to a-z.
    """
    base = int(offsets[0])
    x = data[base : int(offsets[-1])]
    at = (offsets - base).astype(np.int64)
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_SPACE[x]
    cuts = at[:-1][at[:-1] < at[1:]]  # where texts with bytes begin
    first = np.zeros(len(x) + 1, bool)
    first[cuts] = True
    first[-1] = True
    opens = solid & (np.r_[True, ~solid[:-1]] | first[:-1])
    closes = solid & (np.r_[~solid[1:], True] | first[1:])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    raw = polynomials(_LOWER[x] if lower else x, starts, ends)
    with np.errstate(over="ignore"):
        h = mix(raw + mix((ends - starts).astype(np.uint64)))
    return h, np.searchsorted(at, starts, "right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of all runs of ``n`` words; a text of 1 to n - 1 words has one, of them all."""
    with np.errstate(over="ignore"):
        out, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(h) >= n:
            acc = np.zeros(len(h) - n + 1, np.uint64)
            for j in range(n):
                acc = mix(acc + h[j : len(h) - n + 1 + j])
            whole = doc[: len(acc)] == doc[n - 1 :]
            out, at = acc[whole], doc[: len(acc)][whole]
        short = np.isin(doc, at, invert=True)
        if short.any():
            hs, ds = h[short], doc[short]
            heads = np.flatnonzero(np.r_[True, ds[1:] != ds[:-1]])
            place = np.arange(len(ds)) - np.repeat(heads, np.diff(np.r_[heads, len(ds)]))
            parts = mix(hs + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN))
            out = np.r_[out, mix(np.add.reduceat(parts, heads))]
            at = np.r_[at, ds[heads]]
    return out, at


def weighted(items: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, text number, how often) for distinct items of each text, ordered by text and item."""
    order = np.lexsort((items, doc))
    items, doc = items[order], doc[order]
    if not len(items):
        return items, doc, np.zeros(0, np.int64)
    new = np.flatnonzero(np.r_[True, (items[1:] != items[:-1]) | (doc[1:] != doc[:-1])])
    return items[new], doc[new], np.diff(np.r_[new, len(items)])
