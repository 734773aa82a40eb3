"""Removal of repeated byte strings by blockwise comparison over a difference cover.

A byte is removed when a string of ``length`` bytes that covers it also starts
anywhere else in the corpus (same document included, overlaps count); all
strings are judged on the input.

What is asked is whether a string occurs again, not which suffix comes first, so
windows are grouped by fingerprint and no suffix is put in lexicographic order:
buckets are leading bits of a fingerprint, one bucket is sorted (by fingerprint) at
a time, and where a suffix array has ranks there is only equal or not.  The rest is
the method of a difference cover D modulo v, which holds, for any two positions, a
shift k < v that takes both to sample positions.  So two equal strings of ``length``
bytes hold two equal strings of ``length - v + 1`` bytes at sample positions, and
only the samples (a small part of all suffixes) have to be compared with each other:

1. Samples: windows at sample positions go, by the leading bits of their
   fingerprint, to buckets; a sample whose window is alone is settled, and no
   suffix within v before it can be repeated.
2. Long ties: a sample with all of its v - 1 bytes before and ``length`` bytes
   after it repeated settles v suffixes at once.  The other tied samples are
   *edges* (near the ends of documents and of copied passages).
3. A settled sample whose window an edge shares is also compared with it; of each
   group of equal long ties one member does so for all.
4. The suffixes near edges and near those members go to buckets by their own
   fingerprints, again one bucket at a time.

Fingerprints are polynomial, 64 bits where they only choose candidates and 96 bits
where they decide.  Within a block of documents equal ones are merged before the
shuffle, so a passage that every document repeats costs one key a block.  Only
fingerprints and bits are shuffled; the texts stay in a table bucketed by block and
are read again in each pass.  ``release`` deletes that table and the passes' answers
once the result is written.

Defined cases: null and empty texts lose nothing (0 bytes, 0 spans); texts
shorter than ``length`` are never touched; repeated rows and equal texts remove
each other; other columns are returned as they are; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from care_analytics.llm.common import BLOCK_BYTES, free_name, from_payload, new_folder, pack_blocks, prepare, shuffle_tasks, text_bytes, written
from care_analytics.llm.prints import prints

BUCKET_KEYS = 1 << 21
KEYS = "bucket int, block_id long, flags binary, high binary, low binary"
BITS = "block_id long, bucket int, bits binary, lead binary"
REMOVED = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def difference_cover(longest: int) -> tuple[int, np.ndarray]:
    """The largest v = 24 r^2 + 36 r + 13 up to ``longest`` and a cover of 6 r + 4 numbers modulo v,
    by the steps 1^r, r+1, (2r+1)^r, (4r+3)^(2r+1), (2r+2)^(r+1), 1^r (all shifts when even 13 is too large)."""
    if longest < 13:
        return 1, np.zeros(1, np.int64)
    r = 0
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= longest:
        r += 1
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    v, cover = 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])
    assert len({(int(a) - int(b)) % v for a in cover for b in cover}) == v
    return v, cover


def key_order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The order of keys by ``high`` and then ``low`` (empty: by ``high`` alone), equal ones in any order."""
    order = np.argsort(high)
    if len(low):
        a, b = high[order], low[order]
        if ((a[1:] == a[:-1]) & (b[1:] < b[:-1])).any():  # keys that differ only in their low parts, which are rare
            order = np.lexsort((low, high))
    return order


class BlockKeys:
    """The different keys of a block's windows in ascending order, and where each window's key is."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, width: int, exact: bool, bits: int, marked: np.ndarray | None = None):
        high = prints(1).windows(data, starts, width)
        low = (prints(2).windows(data, starts, width) >> np.uint64(32)).astype(np.uint32) if exact else np.zeros(0, np.uint32)
        order = key_order(high, low)
        high = high[order]
        new = np.ones(len(order), bool)
        new[1:] = high[1:] != high[:-1]
        if exact:
            low = low[order]
            new[1:] |= low[1:] != low[:-1]
        group = np.cumsum(new) - 1
        self.where = np.empty(len(order), np.int64)
        self.where[order] = group
        self.high, self.low = high[new], low[new] if exact else None
        # sent along: whether the block itself repeats the key or, if given, holds it in a marked place
        self.flags = np.bincount(group, None if marked is None else marked[order], minlength=len(self.high)) > (marked is None)
        # the leading bits name the bucket, so each bucket is one run of the sorted keys
        self.edges = np.searchsorted(self.high >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(self.high)])

    def rows(self, block_id: int) -> Iterator[tuple]:
        for bucket in np.flatnonzero(np.diff(self.edges)).tolist():
            a, b = self.edges[bucket], self.edges[bucket + 1]
            yield (bucket, block_id, np.packbits(self.flags[a:b]).tobytes(), self.high[a:b].tobytes(), b"" if self.low is None else self.low[a:b].tobytes())

    def answer(self, found: list[dict] | None, plane: str = "bits") -> np.ndarray:
        """The answer to each window, by the bits that its buckets sent back."""
        flags = np.zeros(len(self.high), bool)
        for x in found or []:
            a, b = self.edges[x["bucket"]], self.edges[x["bucket"] + 1]
            flags[a:b] = np.unpackbits(np.frombuffer(x[plane], np.uint8), count=b - a)
        return flags[self.where]


def covered(starts: np.ndarray, before: int, after: int, n: int) -> np.ndarray:
    """Positions within ``[s - before, s + after)`` of any of ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, np.maximum(starts - before, 0), 1)
    np.add.at(steps, np.minimum(starts + after, n), -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


class BlockSuffixes:
    """The suffixes of one block: samples, long ties and open suffixes as the passes settle them."""

    def __init__(self, payload, text: str, length: int, v: int, cover: np.ndarray):
        self.batch = from_payload(payload)
        self.length, self.v = length, v
        self.data, self.offsets = text_bytes(self.batch.column(self.batch.schema.get_field_index(text)))
        sizes, width = np.diff(self.offsets), length - v + 1
        # each document's sample positions are a beginning of one list
        places = (cover + v * np.arange(int(sizes.max(initial=0)) // v + 1)[:, None]).ravel()
        counts = np.where(sizes >= length, np.searchsorted(places, sizes - width, "right"), 0)
        first = np.cumsum(counts) - counts
        self.samples = np.repeat(self.offsets[:-1], counts) + places[np.arange(counts.sum()) - np.repeat(first, counts)]

    @cached_property
    def start(self) -> np.ndarray:
        """Where the document of each byte begins."""
        return np.repeat(self.offsets[:-1].astype(np.int32), np.diff(self.offsets))

    @cached_property
    def left(self) -> np.ndarray:
        """How many bytes of the document are left at each byte."""
        return np.repeat(self.offsets[1:].astype(np.int32), np.diff(self.offsets)) - np.arange(len(self.data), dtype=np.int32)

    def sample_keys(self, bits: int) -> BlockKeys:
        return BlockKeys(self.data, self.samples, self.length - self.v + 1, False, bits)

    def rank_samples(self, found, bits: int) -> "BlockSuffixes":
        self.tied = self.samples[self.sample_keys(bits).answer(found)]
        self.whole = (self.tied - self.start[self.tied] >= self.v - 1) & (self.left[self.tied] >= self.length)
        return self

    def tie_keys(self, bits: int) -> BlockKeys:
        return BlockKeys(self.data, self.tied[self.whole] - (self.v - 1), self.length + self.v - 1, True, bits)

    def settle_ties(self, found, bits: int) -> "BlockSuffixes":
        keys = self.tie_keys(bits)
        settled, lead = np.zeros(len(self.tied), bool), np.zeros(len(self.tied), bool)
        settled[self.whole], lead[self.whole] = keys.answer(found), keys.answer(found, "lead")
        self.settled = covered(self.tied[settled], self.v - 1, 1, len(self.data))
        self.edge, self.asked = ~settled, ~settled | lead
        return self

    def edge_keys(self, bits: int) -> BlockKeys:
        return BlockKeys(self.data, self.tied[self.asked], self.length - self.v + 1, False, bits, self.edge[self.asked])

    def open_suffixes(self, found, bits: int) -> "BlockSuffixes":
        near = self.tied[self.asked][self.edge_keys(bits).answer(found)]
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, np.maximum(near - self.v + 1, self.start[near]), 1)  # never back over the document's start
        np.add.at(steps, near + 1, -1)
        self.open = np.flatnonzero((np.cumsum(steps[:-1], dtype=np.int32) > 0) & (self.left >= self.length))
        return self

    def open_keys(self, bits: int) -> BlockKeys:
        return BlockKeys(self.data, self.open, self.length, True, bits)

    def removed(self, found, bits: int) -> np.ndarray:
        self.settled[self.open[self.open_keys(bits).answer(found)]] = True
        return covered(np.flatnonzero(self.settled), 0, self.length, len(self.data))


def bucket_bits(keys: DataFrame, repeated: bool = True) -> DataFrame:
    """Sort one bucket at a time; for each block the bits of its keys: ``bits`` for keys that are flagged
    anywhere or (``repeated``) occur more than once, ``lead`` for one of those of each key."""

    def sort_bucket(rows: list[tuple]) -> Iterator[tuple]:
        sizes = [len(r[3]) // 8 for r in rows]
        high = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
        flags = np.concatenate([np.unpackbits(np.frombuffer(r[2], np.uint8), count=n) for r, n in zip(rows, sizes)])
        low = np.frombuffer(b"".join(r[4] for r in rows), np.uint32)
        order = key_order(high, low)
        new = np.ones(len(order), bool)
        new[1:] = high[order[1:]] != high[order[:-1]]
        if len(low):
            new[1:] |= low[order[1:]] != low[order[:-1]]
        first = np.flatnonzero(new)
        hit = np.maximum.reduceat(flags[order], first) > 0
        if repeated:
            hit |= np.diff(np.append(first, len(order))) > 1
        bits, lead = np.zeros(len(order), bool), np.zeros(len(order), bool)
        bits[order] = np.repeat(hit, np.diff(np.append(first, len(order))))
        lead[order[first[hit]]] = True
        at = 0
        for r, n in zip(rows, sizes):
            if bits[at:at + n].any():
                yield r[1], r[0], np.packbits(bits[at:at + n]).tobytes(), np.packbits(lead[at:at + n]).tobytes()
            at += n

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            out = list(zip(*sort_bucket(rows)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], ["block_id", "bucket", "bits", "lead"])

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield from flush(held)
                    held = []
                held.append(row)
        if held:
            yield from flush(held)

    spark = keys.sparkSession
    return written(keys.repartition(shuffle_tasks(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(sort, BITS), "bits")


def block_table(spark: SparkSession, blocks: DataFrame, buckets: int) -> tuple[DataFrame, str, DataFrame]:
    """Blocks as a table bucketed by block, so that joins on the block never shuffle the texts; its name, and
    its folder (as ``dropped`` takes it)."""
    name, path = f"care_blocks_{uuid.uuid4().hex}", new_folder(spark, "blocks")
    (blocks.write.format("parquet").bucketBy(buckets, "block_id").option("path", path).option("compression", "zstd").saveAsTable(name))
    folder = spark.createDataFrame([], "x int")
    folder._care_path = path
    return spark.table(name), name, folder


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` (cut ends move inwards to whole characters)
    and a struct ``removed``: n_bytes, n_removed, n_spans, kept_sha256 and the exact byte spans."""
    spark = prepare(docs.sparkSession)
    v, cover = difference_cover(length // 2)
    blocks, name, folder = block_table(spark, pack_blocks(docs, text), shuffle_tasks(spark))
    n_blocks = max(1, blocks.count())
    keys = n_blocks * BLOCK_BYTES * len(cover) / v
    bits = max(0, math.ceil(math.log2(max(keys / BUCKET_KEYS, min(keys / 4096, shuffle_tasks(spark))))))

    def suffixes(payload) -> BlockSuffixes:
        return BlockSuffixes(payload, text, length, v, cover)

    def passing(make) -> DataFrame:
        """Keys of each block by ``make``(suffixes, bits found so far)."""
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    found = [batch.column(k)[i].as_py() for k in range(2, batch.num_columns)]
                    block = make(suffixes(batch.column(1)[i].as_buffer()), *found)
                    rows = list(zip(*block.rows(batch.column(0)[i].as_py()))) if block is not None else []
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64())] + [pa.array(c, pa.binary()) for c in rows[2:]],
                            ["bucket", "block_id", "flags", "high", "low"])
        return emit

    def with_bits(*found: DataFrame) -> DataFrame:
        out = blocks
        if found:
            stages = [x.withColumn("stage", F.lit(i)) for i, x in enumerate(found)]
            every = stages[0]
            for x in stages[1:]:
                every = every.unionByName(x)
            lists = every.groupBy("block_id").agg(*(
                F.collect_list(F.when(F.col("stage") == i, F.struct("bucket", "bits", "lead"))).alias(f"found{i}") for i in range(len(found))))
            out = out.join(lists.hint("shuffle_hash"), "block_id", "left")
        return out

    # each pass takes a block as far as the answers so far settle it
    def tied(s: BlockSuffixes, f1) -> BlockSuffixes:
        return s.rank_samples(f1, bits)

    def settled(s: BlockSuffixes, f1, f2) -> BlockSuffixes:
        return tied(s, f1).settle_ties(f2, bits)

    def opened(s: BlockSuffixes, f1, f2, f3) -> BlockSuffixes:
        return settled(s, f1, f2).open_suffixes(f3, bits)

    ranks = bucket_bits(with_bits().mapInArrow(passing(lambda s: s.sample_keys(bits)), KEYS))
    ties = bucket_bits(with_bits(ranks).mapInArrow(passing(lambda s, f1: tied(s, f1).tie_keys(bits) if f1 else None), KEYS))
    edges = bucket_bits(with_bits(ranks, ties).mapInArrow(passing(
        lambda s, f1, f2: settled(s, f1, f2).edge_keys(bits) if f1 else None), KEYS), repeated=False)
    opens = bucket_bits(with_bits(ranks, ties, edges).mapInArrow(passing(
        lambda s, f1, f2, f3: opened(s, f1, f2, f3).open_keys(bits) if f1 else None), KEYS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                f1, f2, f3, f4 = (batch.column(k)[i].as_py() for k in range(2, 6))
                s = suffixes(batch.column(1)[i].as_buffer())
                gone = opened(s, f1, f2, f3).removed(f4, bits) if f1 else np.zeros(len(s.data), bool)
                yield from cut_texts(s, gone, text, field)

    field = free_name(docs.columns, "removed")
    schema = T.StructType([*docs.schema.fields, T.StructField(field, REMOVED)])
    out = with_bits(ranks, ties, edges, opens).mapInArrow(cut, schema)
    out._care_made = [("table", name), ("folder", folder), *(("folder", x) for x in (ranks, ties, edges, opens))]
    return out


def cut_texts(s: BlockSuffixes, gone: np.ndarray, text: str, field: str) -> Iterator[pa.RecordBatch]:
    """The block's rows without the bytes in ``gone``."""
    column = s.batch.schema.get_field_index(text)
    old = s.batch.column(column)
    changed = np.add.reduceat(np.append(gone, False), s.offsets[:-1]).astype(bool) & (np.diff(s.offsets) > 0) if len(s.offsets) > 1 else []
    texts, info = [], []
    for i, hit in enumerate(changed):
        a, b = int(s.offsets[i]), int(s.offsets[i + 1])
        data = s.data[a:b]
        if not hit:
            texts.append(old[i].as_py())
            info.append((b - a, 0, 0, hashlib.sha256(data.tobytes()).hexdigest(), []))
            continue
        mask = gone[a:b]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = data[~mask]
        # a character that is cut in two stays whole in the text
        first = (data & 0xC0) != 0x80
        whole = np.ones(len(data), bool)
        for x, y in spans:
            while x < y and not first[x]:
                x += 1
            while y > x and y < len(data) and not first[y]:
                y -= 1
            whole[x:y] = False
        texts.append(data[whole].tobytes().decode("utf-8", "replace"))
        info.append((b - a, int(mask.sum()), len(spans), hashlib.sha256(kept.tobytes()).hexdigest(), [{"start": x, "end": y} for x, y in spans]))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    removed = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*info), kinds)], names)
    arrays = [pa.array(texts, s.batch.schema.field(column).type) if k == column else c for k, c in enumerate(s.batch.columns)]
    yield pa.RecordBatch.from_arrays([*arrays, removed], [*s.batch.schema.names, field])
