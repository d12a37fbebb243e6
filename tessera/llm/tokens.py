"""Token ids of whole texts, with a word cache in front of the tokenizer.

A byte-level BPE vocabulary splits a text before it merges bytes, and no
split piece crosses from a non-space into white space, nor from a letter or
digit into a sign. A text may therefore be cut before every blank or line
feed that follows a non-space and before every ASCII sign that follows a
letter or digit, and the pieces encoded one by one give the ids of the whole.
Natural text repeats its words, so most pieces are found in a cache; only new
ones go through the tokenizer. Cuts, distinct pieces and the ids put together
again are array operations over the bytes of many texts; plain Python sees
the distinct pieces of such a group alone.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 0  # fixed value: the id that closes a document
SEGMENT = 2 << 20  # bytes of a group of texts whose pieces are held at once
CACHE_PIECES = 250_000  # bound of a worker's cache; beyond it the cache starts anew
RUN = 256  # new pieces that go through the tokenizer as one text

# What counts as white space in the tokenizer's split pattern.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{SPACES}])[ \n]")
#: a blank or line feed and no white space after it: between such pieces the split rule cuts by itself
_PLAIN = re.compile(f"[ \n][^{SPACES}]+")
#: kinds of bytes a cut lies before (blanks 1, ASCII signs 2), and after which of them it may
_BEFORE, _AFTER = np.zeros(256, np.uint8), np.full(256, 1, np.uint8)
_BEFORE[[0x20, 0x0a]] = 1
_BEFORE[[b for b in range(0x21, 0x7f) if not chr(b).isalnum()]] = 2
_AFTER[[0x09, 0x0a, 0x0b, 0x0c, 0x0d, 0x20]] = 0
_AFTER[[b for b in range(0x80) if chr(b).isalnum()]] = 3
_AFTER[0x80:] = 3  # the character that ends here decides


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids; one instance per worker and vocabulary."""

    _of: dict[str, PieceEncoder] = {}

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache: dict[str, bytes] = {}
        # the tokens that begin with a blank or line feed, as byte-level vocabularies write them
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(names.values(), default=0) + 1, bool)
        self.opens[[i for name, i in names.items() if name[:1] in ("Ġ", "Ċ")]] = True

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of pieces. Plain ones go through the tokenizer as running text, told apart by their first tokens."""
        learned: dict[str, bytes] = {}
        plain = [p for p in new if _PLAIN.fullmatch(p)]
        runs = [plain[at:at + RUN] for at in range(0, len(plain), RUN)]
        for at in range(0, len(runs), 16):
            few = runs[at:at + 16]
            for run, e in zip(few, self.tokenizer.encode_batch_fast(list(map("".join, few)), add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
                if len(starts) == len(run):
                    raw = ids.tobytes()
                    learned.update(zip(run, (raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)), strict=True))
        others = [p for p in new if p not in learned]
        for at in range(0, len(others), 4096):
            chunk = others[at:at + 4096]
            for piece, e in zip(chunk, self.tokenizer.encode_batch_fast(chunk, add_special_tokens=False), strict=True):
                learned[piece] = np.array(e.ids, "<u4").tobytes()
        return learned

    def _values(self, distinct: list[str]) -> list[bytes]:
        """The ids of every piece, from the cache or learned."""
        found = list(map(self.cache.get, distinct))
        new = [p for p, ids in zip(distinct, found, strict=True) if ids is None]
        if not new:
            return found
        learned = self._learn(new)
        found = [learned[p] if ids is None else ids for p, ids in zip(distinct, found, strict=True)]
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            self.cache.update(zip(distinct, found, strict=True))  # the frequent pieces are among those at hand
        else:
            self.cache.update(learned)
        return found

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ids per text)`` of the texts that lie in ``data`` between ``offsets``."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets) - 1, np.int64)
        cut = cuts(data)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        at = np.flatnonzero(cut)
        own = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data))
        coded = own.dictionary_encode()
        flat = pa.array(self._values(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1) // 4
        ids = np.frombuffer(flat.buffers()[2], "<u4", int(ends[-1]))
        return ids, np.diff(ends[np.searchsorted(at, offsets)])

    def groups(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, ids per text)`` of consecutive groups of the texts (null: none), without end ids.

        The texts are read where they lie; only what a group needs is held beside them.
        """
        if not len(texts):
            return
        texts = texts.cast(pa.large_string())
        places = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(places, places[at] + SEGMENT, "right")) - 1)
            few = texts.slice(at, to - at)
            if few.null_count:
                few = pc.fill_null(few, "")
            _, offsets, data = few.buffers()
            offsets = np.frombuffer(offsets, np.int64, len(few) + 1, 8 * few.offset)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            if offsets[-1] - offsets[0] > SEGMENT:  # a very long text goes through in segments
                parts = [np.frombuffer(s.encode(), np.uint8) for s in segments(few[0].as_py())]
                ids = np.concatenate([self._group(p, np.array([0, len(p)]))[0] for p in parts])
                yield ids, np.array([len(ids)])
            else:
                yield self._group(data[offsets[0]:offsets[-1]], offsets - offsets[0])
            at = to

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """The ids of every text (null: none), without the end id."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        for ids, counts in self.groups(texts):
            raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            for start, end in zip([0, *ends], ends):
                yield raw[start:end]


def segments(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` cut at piece borders into parts of about ``size`` characters."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether a piece may begin at each byte of UTF-8 text."""
    cut = np.zeros(len(data), bool)
    cut[1:] = _AFTER[data[:-1]] & _BEFORE[data[1:]]
    at = np.flatnonzero(cut)
    at = at[data[at - 1] >= 0x80]
    # the last bytes of the character before: is it white space, or a Latin or Cyrillic letter?
    a, b, c = data[at - 3], data[at - 2], data[at - 1]
    space = (((b == 0xc2) & ((c == 0x85) | (c == 0xa0))) | ((a == 0xe1) & (b == 0x9a) & (c == 0x80))
             | ((a == 0xe2) & (b == 0x80) & ((c <= 0x8a) | (c == 0xa8) | (c == 0xa9) | (c == 0xaf)))
             | ((a == 0xe2) & (b == 0x81) & (c == 0x9f)) | ((a == 0xe3) & (b == 0x80) & (c == 0x80)))
    letter = ((b == 0xc3) & (c != 0x97) & (c != 0xb7)) | ((b >= 0xc4) & (b <= 0xc9)) | (b == 0xd0) | (b == 0xd1)
    cut[at] = np.where(_BEFORE[data[at]] == 1, ~space, letter)
    return cut
