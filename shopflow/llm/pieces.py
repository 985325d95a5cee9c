"""Token ids of whole Arrow text columns by a byte-level BPE tokenizer, each distinct piece encoded once.

The GPT-2 pre-tokenizer starts a new pre-token at every space that follows a character
other than white space, whatever comes before or after.  So a text may be cut
there, and its pieces encoded apart from each other by the library.  Special
tokens hold no space and lie inside one piece.  A memo of about ``max_entries`` pieces and
``max_bytes`` of their texts at most keeps their ids and only saves time: pieces are looked up by a 64-bit hash, then their bytes are
compared, and one that differs from the piece kept under its hash is encoded by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shopflow.llm import hashing as H
from shopflow.llm.common import load_tokenizer, worker_memo

#: Text bytes that are cut at once.
BLOCK_BYTES = 1 << 20
_ASCII_WHITE = np.zeros(256, bool)
_ASCII_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts data[at[i]:at[i + 1]] begin: each text's start and each cut."""
    spaces = np.flatnonzero(data == 0x20)
    spaces = spaces[spaces > 0]
    before = data[spaces - 1]
    ok = ~_ASCII_WHITE[before]
    far = np.flatnonzero(before >= 0x80)  # multi-byte white space
    if len(far):
        p = spaces[far]
        one, two, three = (data[np.maximum(p - k, 0)].astype(np.int64) for k in (1, 2, 3))
        code = (three << 16) | (two << 8) | one
        general = (three == 0xE2) & (two == 0x80) & (((one >= 0x80) & (one <= 0x8A)) | np.isin(one, (0xA8, 0xA9, 0xAF)))
        white = ((two == 0xC2) & np.isin(one, (0x85, 0xA0))) | general | np.isin(code, (0xE19A80, 0xE2819F, 0xE38080))
        ok[far] &= ~white
    starts = np.zeros(len(data), bool)
    starts[spaces[ok]] = True
    starts[at[:-1][at[:-1] < at[1:]]] = True
    return np.flatnonzero(starts)


def _ends(sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``before``, places of which the last is the end, with those after parts of these sizes; in 32 bits where they fit."""
    more = int(before[-1]) + np.cumsum(sizes, dtype=np.int64)
    return np.concatenate([before, more.astype(np.int32) if not len(more) or more[-1] < 1 << 31 else more])


class PieceEncoder:
    def __init__(self, path: str, max_entries: int = 1_200_000, max_bytes: int = 16 << 20):
        self.tokenizer = load_tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.max_entries, self.max_bytes = max_entries, max_bytes
        plain = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()
                 if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark = min(plain) if plain else None  # parts pieces that are encoded in one call
        self._reset()

    def _reset(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, their entries
        self.ids, self.text = np.zeros(0, self.dtype), np.zeros(0, np.uint8)  # the entries' ids and bytes
        self.first, self.at = np.zeros(1, np.int32), np.zeros(1, np.int32)  # where each entry begins in them, and the end

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """New entries for these pieces of ``data``."""
        ids, sizes, texts = [self.ids], [], [self.text]
        for lo in range(0, len(starts), 4096):
            raw = [data[a:b].tobytes() for a, b in zip(starts[lo : lo + 4096].tolist(), ends[lo : lo + 4096].tolist())]
            part, size = self._library([x.decode() for x in raw])
            ids.append(part)
            sizes.append(size)
            texts.append(np.frombuffer(b"".join(raw), np.uint8))
        before = len(self.at) - 1
        self.ids, self.text = np.concatenate(ids), np.concatenate(texts)
        self.first, self.at = _ends(np.concatenate(sizes), self.first), _ends(ends - starts, self.at)
        return np.arange(before, len(self.at) - 1, dtype=np.int32)

    def _differ(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Which of the pieces, which follow each other in ``data``, are not the text of their entry."""
        sizes = ends - starts
        fits = np.flatnonzero(self.at[entries + 1] - self.at[entries] == sizes)
        n = sizes[fits]
        before, step = np.cumsum(n) - n, np.arange(int(n.sum()))
        if len(fits) == len(starts):
            mine = data[int(starts[0]) : int(ends[-1])]
        else:
            mine = data[np.repeat(starts[fits] - before, n) + step]
        apart = np.flatnonzero(self.text[np.repeat(self.at[entries[fits]] - before, n) + step] != mine)
        wrong = np.ones(len(starts), bool)
        wrong[fits] = False
        wrong[fits[np.searchsorted(before, apart, "right") - 1]] = True
        return np.flatnonzero(wrong)

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids of each); pieces parted by a special token are encoded in one call, many calls at once."""
        mark_id, mark = self.mark or (None, None)
        if mark is None or any(mark in p for p in pieces):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], self.dtype), np.fromiter(map(len, found), np.int64, len(found))
        joined = [mark.join(pieces[a : a + 64]) + mark for a in range(0, len(pieces), 64)]
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark_id)
        return ids[ids != mark_id], np.diff(np.r_[-1, ends]) - 1

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The memo's entry of each piece; new pieces are encoded first."""
        with np.errstate(over="ignore"):
            hashes = H.mix(H.polynomials(data, starts, ends) + H.mix((ends - starts).astype(np.uint64)))
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.max_entries or len(self.text) > self.max_bytes:
            self._reset()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            made = self._add(data, starts[where[new]], ends[where[new]])
            self.entry = np.insert(self.entry, at[new], made)
            self.keys = np.insert(self.keys, at[new], keys[new])
            at = np.searchsorted(self.keys, keys)
        entries = self.entry[at][back.reshape(-1)]
        other = self._differ(data, starts, ends, entries)
        if len(other):
            entries[other] = self._add(data, starts[other], ends[other])
        return entries

    def _blocks(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end text, entries of all pieces, pieces before each text and in all) for blocks of texts."""
        data, offsets = H.text_buffer(column)
        for lo, hi in H.blocks(offsets, BLOCK_BYTES):
            base = int(offsets[lo])
            x, at = data[base : int(offsets[hi])], offsets[lo : hi + 1] - base
            starts = piece_starts(x, at)
            ends = np.r_[starts[1:], len(x)][: len(starts)]
            entries = self._entries(x, starts, ends) if len(starts) else np.zeros(0, np.int32)
            yield lo, hi, entries, np.searchsorted(starts, at)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end text, ids of these texts, ids before each text and in all), block by block; null: no ids."""
        for lo, hi, entries, edges in self._blocks(column):
            firsts = self.first[entries].astype(np.int64)
            sizes = self.first[entries + 1] - firsts
            before = np.r_[0, np.cumsum(sizes)]
            place = np.repeat(firsts - before[:-1], sizes) + np.arange(before[-1])
            yield lo, hi, self.ids[place], before[edges]

    def counts(self, column: pa.Array) -> np.ndarray:
        """Ids of each text."""
        out = [np.zeros(0, np.int64)]
        for _, _, entries, edges in self._blocks(column):
            sizes = self.first[entries + 1] - self.first[entries]
            out.append(np.diff(np.r_[0, np.cumsum(sizes, dtype=np.int64)][edges]))
        return np.concatenate(out)


def piece_encoder(path: str) -> PieceEncoder:
    """The worker's encoder for the tokenizer file at ``path``."""
    return worker_memo(("pieces", path), lambda: PieceEncoder(path))
