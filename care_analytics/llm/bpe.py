"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece the byte-pair encoding ends in one certain token.
An automaton lists the tokens that are suffixes of the prefix; the right one is
the one that is *compatible* with the last token of what is left before it:
bytes of both together encode as exactly these two.  The last tokens are stored
and followed back from the end, which is linear in the piece for bounded token
lengths, however long a piece is.

Compatibility looks at the seam only: merges that grow the last part of the left
token, merges that grow the first part of the right one, and merges across the
seam are replayed in the order of their ranks; a merge across the seam that
comes first makes the pair incompatible.

Special tokens inside a text are taken as such, as the library does by default.
Defined cases: null text is empty (no ids, empty decoded text); equal rows are
encoded alike; other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from care_analytics.llm.common import BLOCK_BYTES, block_cuts, prepare, text_bytes
from care_analytics.llm.units import distinct_units, gather

NEVER = 1 << 60
# The byte-level pre-tokenizer's pattern, with Unicode's White_Space written out.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_names() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: itself if it prints, else one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixEncoder:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, remember: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names, vocab = byte_names(), spec["model"]["vocab"]
        self.token_bytes = {i: bytes(names[c] for c in t) for t, i in vocab.items() if all(c in names for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in enumerate(merges)}
        if any(r <= self.parts[x][2] for a, b, r in self.parts.values() for x in (a, b) if x in self.parts):
            raise ValueError("a merge comes before the merges of its parts")
        self.find = ahocorasick.Automaton()
        special = set(self.special.values())
        for i, b in self.token_bytes.items():
            if i not in special:
                self.find.add_word(b.decode("latin-1"), (i, len(b)))
        self.find.make_automaton()
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        self.library_split = ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.remember, self.units_known, self.pieces_known, self.pairs, self.whole = remember, {}, {}, {}, {}
        top = max(self.token_bytes) + 1
        self.dtype = "<u2" if top <= 1 << 16 else "<u4"
        self.bytes_table = self._table(self.token_bytes.get(i, b"") for i in range(top))
        self.number_table = self._table(b"%d," % i for i in range(top))

    @staticmethod
    def _table(parts) -> tuple[np.ndarray, np.ndarray]:
        parts = list(parts)
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of ``token`` at one end, from its byte upwards, each with the rank of the merge that uses it."""
        out, used = [], NEVER
        while True:
            out.append((token, used))
            if token not in self.parts:
                return out[::-1]
            a, b, used = self.parts[token]
            token = b if side else a

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) > 4 * self.remember:
                self.pairs.clear()
            x, y = self._spine(left, 1), self._spine(right, 0)
            i = j = 0
            while True:
                (a, next_a), (b, next_b) = x[i], y[j]
                across = self.rank.get((a, b), NEVER)
                if across < next_a and across <= next_b:  # of equal merges the leftmost comes first
                    self.pairs[key] = False
                    break
                if next_a == next_b == NEVER:
                    self.pairs[key] = True
                    break
                if next_a <= next_b:
                    i += 1
                else:
                    j += 1
        return self.pairs[key]

    def alone(self, token: int) -> bool:
        """Whether the bytes of ``token`` encode as this token."""
        if token not in self.whole:
            parts = self.parts.get(token)
            if parts is None:
                self.whole[token] = len(self.token_bytes[token]) == 1
            else:
                a, b, r = parts
                # its two parts stand side by side until their own merge, which comes last
                kept = self.rank.pop((a, b))
                self.pairs.pop((a, b), None)
                self.whole[token] = self.alone(a) and self.alone(b) and self.compatible(a, b)
                self.rank[(a, b)] = kept
                self.pairs[(a, b)] = False
        return self.whole[token]

    def piece(self, piece: str) -> list[int]:
        ids = self.pieces_known.get(piece)
        if ids is None:
            text = piece.encode().decode("latin-1")
            last = [(-1, 0)] * (len(text) + 1)
            for end, (token, n) in self.find.iter(text):
                end += 1
                before = last[end - n][0]
                if last[end][1] or (end > n and last[end - n][1] == 0):
                    continue
                if self.alone(token) and (end == n or self.compatible(before, token)):
                    last[end] = (token, n)
            ids, at = [], len(text)
            while at:
                token, n = last[at]
                ids.append(token)
                at -= n
            ids.reverse()
            if len(piece) <= 64:
                if len(self.pieces_known) > self.remember:
                    self.pieces_known.clear()
                self.pieces_known[piece] = ids
        return ids

    def text(self, text: str) -> list[int]:
        out: list[int] = []
        for k, part in enumerate(self.cut_special.split(text) if self.cut_special else [text]):
            if k % 2:
                out.append(self.special[part])
            else:
                for piece in self.split(part):
                    out += self.piece(piece)
        return out

    def split(self, text: str) -> list[str]:
        """Pieces of a text; beyond the settled alphabets the library says which characters are letters."""
        if text.isascii() or max(text, default="") < "\u0500":
            return self.pieces.findall(text)
        return [text[a:b] for _, (a, b) in self.library_split(text)]

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the id offset of each text."""
        units, codes, first = distinct_units(array)
        if not units:
            return np.zeros(0, self.dtype), np.zeros(len(array) + 1, np.int64)
        known = self.units_known
        if len(known) > self.remember:
            known.clear()
        parts = []
        for u in units:
            ids = known.get(u)
            if ids is None:
                ids = known[u] = np.array(self.text(u), self.dtype).tobytes()
            parts.append(ids)
        offsets = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.dtype).itemsize, out=offsets[1:])
        ids, ends = gather(codes, np.frombuffer(b"".join(parts), self.dtype), offsets)
        return ids, ends[first]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of the decoded texts (broken characters replaced)."""
        data, ends = gather(ids, *self.bytes_table)
        out = []
        for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist()):
            text = data[a:b].tobytes()
            out.append(text.decode("utf-8", "replace").encode())
        return out

    def numbers(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Decimal ids of each text, joined by commas."""
        data, ends = gather(ids, *self.number_table)
        return [data[a:max(a, b - 1)].tobytes() for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist())]


_ENCODERS: dict[str, PrefixEncoder] = {}


def prefix_encoder(path: str) -> PrefixEncoder:
    """The encoder of this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def _by_block(docs: DataFrame, make, schema: str) -> DataFrame:
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
                yield make(batch.slice(a, b - a))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ``ids``."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = prefix_encoder(tokenizer).encode(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists], ["doc_id", "ids"])

    return _by_block(docs, make, "doc_id long, ids array<int>")


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ``text`` of rows of doc_id and ``ids`` (null: empty)."""
    prepare(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = prefix_encoder(tokenizer)
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
            texts = coder.decode(np.concatenate([np.zeros(0, np.int64), *rows]), offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([t.decode() for t in texts], pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = prefix_encoder(tokenizer)
        ids, offsets = coder.encode(batch.column(1))
        digests = [[hashlib.sha256(x).hexdigest() for x in part(ids, offsets)] for part in (coder.numbers, coder.decode)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), *(pa.array(d, pa.string()) for d in digests)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _by_block(docs, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
