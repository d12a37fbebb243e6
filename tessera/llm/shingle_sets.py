"""Hashed word-shingle sets of whole texts, in numpy over the UTF-8 bytes of an Arrow batch.

Words are runs of bytes outside the fixed white space (all ASCII, so cutting
bytes cuts characters), A-Z lower-cased. Word hashes come from one running
sum of ``byte * B**place`` modulo 2**64, so no Python loop runs over words.
Shingles are 64-bit; a set is compared by these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_LIMB = 1 << 20  # bytes hashed at once

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the base and its inverse, and what each byte stands for; built once per worker."""

    made: _Tables | None = None

    def __init__(self):
        with np.errstate(over="ignore"):
            self.up = _powers(_BASE, _LIMB + 1)
            self.down = _powers(pow(_BASE, -1, 1 << 64), _LIMB + 1)
        codes = np.arange(256, dtype=np.uint64)
        codes[65:91] += np.uint64(32)
        self.code = codes * np.uint64(0x100000001B3) + np.uint64(1)
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True

    @classmethod
    def get(cls) -> _Tables:
        if cls.made is None:
            cls.made = cls()
        return cls.made


def _limb_words(raw: np.ndarray, borders: np.ndarray, t: _Tables) -> tuple[np.ndarray, np.ndarray]:
    """``(start, hash)`` of the words of at most ``_LIMB`` bytes; words also end at ``borders``."""
    solid = ~t.space[raw]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = borders[(borders > 0) & (borders < len(raw))]
    opens[inner] = solid[inner]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(np.where(solid, t.code[raw] * t.up[:len(raw)], np.uint64(0)), out=total[1:])
    # blanks add nothing, so the sum up to the next word is the sum of this word
    ends = np.append(starts[1:], len(raw))
    return starts, mixed((total[ends] - total[starts]) * t.down[starts])


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of the words of every text, in order (null text: none)."""
    t = _Tables.get()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    with np.errstate(over="ignore"):
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _LIMB, side="right")) - 1)
            lo, hi = int(offsets[first]), int(offsets[last])
            if hi - lo <= _LIMB:
                borders = offsets[first:last + 1] - lo
                starts, hashes = _limb_words(raw[lo:hi], borders, t)
                cuts = np.searchsorted(starts, borders)
                yield from (hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
            else:  # one text longer than a limb
                yield _long_words(raw[lo:hi], t)
            first = last


def _long_words(raw: np.ndarray, t: _Tables) -> np.ndarray:
    """Limb by limb, each cut behind the last blank in it; a word without end is hashed in slices."""
    none, out, at = np.zeros(0, np.int64), [], 0
    while at < len(raw):
        end = min(len(raw), at + _LIMB)
        if end < len(raw):
            blanks = np.flatnonzero(t.space[raw[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:
                stop = np.flatnonzero(t.space[raw[end:end + 64 * _LIMB]])
                word_end = end + int(stop[0]) if len(stop) else min(len(raw), end + 64 * _LIMB)
                h = np.zeros(1, np.uint64)
                for s in range(at, word_end, _LIMB):
                    h = mixed(h * _M3 + _limb_words(raw[s:min(word_end, s + _LIMB)], none, t)[1][:1])
                out.append(h)
                at = word_end
                continue
        out.append(_limb_words(raw[at:end], none, t)[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct ``size``-word shingles, sorted; fewer words are one shingle, no word is none."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        n = max(1, len(words) - size + 1)
        h = np.full(n, min(size, len(words)), np.uint64)
        for k in range(min(size, len(words))):
            h = mixed(h * _M3 + words[k:k + n])
    return np.unique(h)
