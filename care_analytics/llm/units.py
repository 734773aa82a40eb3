"""Tokenizer ids of many texts at a time.

The texts of a batch are cut, by vector operations on their bytes, at places
where the byte-level pre-tokenizer always cuts; each different unit is encoded
once by the tokenizers library and the ids are gathered again.  Cutting only at
certain places makes the ids equal to those of the whole text.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from care_analytics.llm.common import text_bytes

SPACE, LETTER, MARK, CONTROL, HIGH = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[28:32] = CONTROL
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = MARK
_CLASS[128:] = HIGH
# white space after a visible character, or punctuation after an ASCII letter
_PAIR = np.zeros(64, bool)
for _before in (0, LETTER, MARK, HIGH):
    _PAIR[_before * 8 + SPACE] = True
_PAIR[LETTER * 8 + MARK] = True


def cut_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit offsets in ``data`` and, for each text, the index of its first unit (one more at the end)."""
    kind = _CLASS[data]
    inner = np.flatnonzero(_PAIR[(kind[:-1] << 3) | kind[1:]]) + 1
    after_high = inner[kind[inner - 1] == HIGH]
    if len(after_high):
        # not after a white-space character beyond ASCII (two or three bytes)
        b1, b2 = data[after_high - 1], data[after_high - 2]
        b3 = data[np.maximum(after_high - 3, 0)]
        unsafe = ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 >= 0xE1) & (b3 <= 0xE3))
        inner = np.setdiff1d(inner, after_high[unsafe], assume_unique=True)
    cut = np.zeros(len(data) + 1, bool)
    cut[inner] = cut[offsets] = True
    cuts = np.flatnonzero(cut)
    return cuts, np.searchsorted(cuts, offsets)


def distinct_units(array: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different units of a string array, the unit number of each piece in order, first piece of each text."""
    data, offsets = text_bytes(array)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cuts, first = cut_units(data, offsets)
    pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), first


def gather(codes: np.ndarray, unit_ids: np.ndarray, unit_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated ids of the units in ``codes`` and the id offset of each piece (one more at the end)."""
    starts, lengths = unit_offsets[codes], np.diff(unit_offsets)[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    index = np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - ends[:-1], lengths)
    return unit_ids[index], ends


class UnitEncoder:
    """Ids of units by the tokenizers library, remembering up to ``remember`` units between batches.

    New units are encoded many at a time: those that begin with white space and end with a visible
    ASCII character stand in a row as one text, which the pre-tokenizer cuts at least between them;
    the bytes of each token tell which ids are whose.
    """

    def __init__(self, path: str, remember: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.remember = remember
        size = self.tokenizer.get_vocab_size()
        self.wide = size > 1 << 16
        self.n_bytes = np.zeros(size, np.int64)  # of each token; tokens of the byte-level vocabulary have a character a byte
        for token, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(token.content.encode())
        self.forget()

    @property
    def dtype(self) -> str:
        return "<u4" if self.wide else "<u2"

    def forget(self) -> None:
        """No unit is known: ``known`` numbers them, ``ids`` holds theirs end to end up to ``ends``."""
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, self.dtype), np.zeros(1 << 14, np.int64)

    def learn(self, units: list[str]) -> None:
        """Encode new units, in the order of ``units``."""
        rows = [u for u in units if u[0] in " \n\t\r\x0b\x0c" and "!" <= u[-1] <= "~"]
        single = [u for u in units if not (u[0] in " \n\t\r\x0b\x0c" and "!" <= u[-1] <= "~")]
        while rows or single:
            part, rows = rows[:20_000], rows[20_000:]
            if part and not self.learn_rows(part):
                single += part
            part, single = single[:20_000], single[20_000:]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self.append(part, np.fromiter(chain.from_iterable(coded), self.dtype), np.fromiter(map(len, coded), np.int64, len(coded)))

    def learn_rows(self, units: list[str], row: int = 500) -> bool:
        texts = ["".join(units[a:a + row]) for a in range(0, len(units), row)]
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(coded), np.int64)
        sizes = np.fromiter((len(u) if u.isascii() else len(u.encode()) for u in units), np.int64, len(units))
        ends, at = np.cumsum(sizes), np.cumsum(self.n_bytes[ids])
        last = np.searchsorted(at, ends)  # the last id of each unit
        if len(at) != last[-1] + 1 or (at[last] != ends).any():
            return False  # not a byte-level vocabulary
        self.append(units, ids.astype(self.dtype), np.diff(last, prepend=-1))
        return True

    def append(self, units: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.known)
        at = self.ends[n]
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(units) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[at:at + len(ids)] = ids
        self.ends[n + 1:n + 1 + len(units)] = at + np.cumsum(lengths)
        self.known.update(zip(units, range(n, n + len(units))))

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the id offset of each text (null: empty)."""
        units, codes, first = distinct_units(array)
        if not units:
            return np.zeros(0, self.dtype), np.zeros(len(array) + 1, np.int64)
        if len(self.known) > self.remember:
            self.forget()
        get = self.known.get
        if new := [u for u in units if get(u) is None]:
            self.learn(new)
        number = np.fromiter(map(get, units), np.int64, len(units))
        out, ends = gather(number[codes], self.ids, self.ends[:len(self.known) + 1])
        return out, ends[first]

    def encode_ended(self, array: pa.Array, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` appended to every text."""
        ids, offsets = self.encode(array)
        return np.insert(ids, offsets[1:], np.array(end_id, self.dtype)), offsets + np.arange(len(offsets))


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
