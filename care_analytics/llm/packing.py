"""Packing into windows of a fixed number of tokens by minimum bin slack.

A document of ``n`` ids (end id included) is cut into whole windows and one
remainder.  Only the histogram of remainder lengths (fewer than ``capacity``
numbers, whatever the input) reaches the driver, which repeats: take the largest
remaining length, let a bitset subset-sum program find the multiset of other
remaining lengths that fills the window closest to its capacity, follow the
bitsets back to its counts, and use it as often as the counts allow.  Multisets
that leave slack go to a tail, whose pieces are laid end to end, cut at window
borders and, at the very end, into powers of two: nothing is padded.

A remainder is found in the plan by its length and its rank among all
remainders of that length; ranks come from per-block counts, so a length that a
third of all documents share is no hot group.

Defined cases: null text is empty (one end id, itself packed); a null ``doc_id``
is kept; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_analytics.llm.common import BLOCK_BYTES, block_cuts, prepare, text_bytes, written
from care_analytics.llm.units import encoder

TOKENS = "block_id long, doc_ids array<long>, n_tokens array<int>, counts array<struct<size: int, n: long>>, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def token_blocks(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Blocks of encoded documents with the counts of their remainder lengths (``capacity``: whole windows)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, block = encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
                part = batch.slice(a, b - a)
                ids, starts = coder.encode_ended(part.column(1), end_id)
                n = np.diff(starts)
                sizes, counts = np.unique(n % capacity, return_counts=True)
                found = [{"size": int(s), "n": int(c)} for s, c in zip(sizes, counts) if s]
                if whole := int((n // capacity).sum()):
                    found.append({"size": capacity, "n": whole})
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([n.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([found], pa.list_(pa.struct([("size", pa.int32()), ("n", pa.int64())]))),
                    pa.array([ids.tobytes()], pa.binary())], ["block_id", "doc_ids", "n_tokens", "counts", "ids"])
                block += 1

    return docs.select("doc_id", "text").mapInArrow(encode, TOKENS)


def closest_fill(sizes: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``sizes`` (at most ``counts`` of each) whose sum comes closest to ``room`` from below."""
    within = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for size in sizes:
        if size > room or not counts[size]:
            continue
        before, left, take = reach, min(counts[size], room // size), 1
        while left:  # binary splitting: 1, 2, 4, ... copies at once
            take = min(take, left)
            reach |= (reach << (size * take)) & within
            left -= take
            take *= 2
        trail.append((size, before))
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for size, before in reversed(trail):
        k = 0
        while not before >> at & 1:
            at -= size
            k += 1
        if k:
            chosen[size] = k
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], int, int]:
    """Segments (size, rank from, rank to, first window, copies a window, offset; window -1: tail at offset),
    the number of windows and the tail's length."""
    left = {s: n for s, n in sorted(histogram.items(), reverse=True) if s and n}
    used = dict.fromkeys(left, 0)
    sizes, segments, windows, tail = list(left), [], 0, 0

    def take(size: int, n: int, window: int, copies: int, offset: int) -> None:
        segments.append((size, used[size], used[size] + n, window, copies, offset))
        used[size] += n
        left[size] -= n

    while sizes:
        seed = sizes[0]
        left[seed] -= 1
        chosen = closest_fill(sizes, left, capacity - seed)
        left[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[s] // k for s, k in chosen.items())
        if sum(s * k for s, k in chosen.items()) == capacity:
            offset = 0
            for size, k in sorted(chosen.items(), reverse=True):
                take(size, k * times, windows, k, offset)
                offset += size * k
            windows += times
        else:
            for size, k in sorted(chosen.items(), reverse=True):
                take(size, k * times, -1, 1, tail)
                tail += size * k * times
        sizes = [s for s in sizes if left[s]]
    return segments, windows, tail


def tail_pieces(at: int, size: int, tail: int, capacity: int) -> list[tuple[int, int, int]]:
    """(window, offset, length) of the tail's ids ``at`` to ``at + size``; the last window falls into powers of two."""
    whole, out = tail // capacity, []
    end = at + size
    while at < end:
        window, base, width = at // capacity, at // capacity * capacity, capacity
        if window == whole:  # beyond the last whole window
            rest = tail - base
            width = 1 << (rest.bit_length() - 1)
            while at >= base + width:
                base, rest, window = base + width, rest - width, window + 1
                width = 1 << (rest.bit_length() - 1)
        n = min(end, base + width) - at
        out.append((window, at - base, n))
        at += n
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and ``ids`` (binary,
    little-endian unsigned 32-bit).  ``sequence_id`` counts from 0 without gaps."""
    spark = prepare(docs.sparkSession)
    tokens = written(token_blocks(docs, tokenizer, capacity, end_id), "token-blocks")
    counts = tokens.select("block_id", F.explode("counts").alias("c")).select("block_id", "c.size", "c.n")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    whole = histogram.pop(capacity, 0)
    segments, windows, tail = plan_windows(histogram, capacity)
    by_size: dict[int, tuple[np.ndarray, ...]] = {}
    for size in histogram:
        rows = np.array([s[1:] for s in segments if s[0] == size], np.int64).reshape(-1, 5)
        by_size[size] = tuple(rows.T)

    before = Window.partitionBy("size").orderBy("block_id").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .groupBy("block_id").agg(F.collect_list(F.struct("size", "rank")).alias("ranks")))
    dtype = encoder(tokenizer).dtype

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, n_tokens = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                ids = np.frombuffer(batch.column(2)[row].as_buffer(), dtype).astype("<u4")
                ranks = {r["size"]: r["rank"] for r in batch.column(3)[row].as_py() or []}
                out, at = [], 0
                for doc, n in zip(doc_ids, n_tokens):
                    for start in range(0, n - n % capacity, capacity):
                        out.append((doc, start, capacity, n, ranks[capacity], 0, ids[at + start:at + start + capacity].tobytes()))
                        ranks[capacity] += 1
                    if size := n % capacity:
                        start, rank = n - size, ranks[size]
                        ranks[size] += 1
                        lo, _, window, copies, offset = by_size[size]
                        k = int(np.searchsorted(lo, rank, side="right")) - 1
                        i = rank - int(lo[k])
                        if window[k] >= 0:
                            found = [(int(window[k]) + i // int(copies[k]), int(offset[k]) + i % int(copies[k]) * size, size)]
                        else:
                            found = [(windows + w, o, m) for w, o, m in tail_pieces(int(offset[k]) + i * size, size, tail, capacity)]
                        for w, o, m in found:
                            out.append((doc, start, m, n, whole + w, o, ids[at + start:at + start + m].tobytes()))
                            start += m
                    at += n
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return (tokens.join(ranks, "block_id", "left").select("doc_ids", "n_tokens", "ids", "ranks")
            .mapInArrow(place, PIECES))


def pack_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pack(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
