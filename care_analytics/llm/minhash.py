"""Near-duplicate documents by minwise signatures and a multi-index Hamming join.

A document is the set of its distinct word shingles.  Its signature holds
``size`` symbols, each ``b`` bits of one minwise hash; two documents of
similarity s differ in each symbol with probability about 1 - s.  Signatures are
split into ``chunks``; if two differ in at most ``chunks * (errors + 1) - 1``
symbols, some chunk differs in at most ``errors``.  All ways to leave out
``errors`` symbols of a chunk are enumerated, and what is left of the chunk is a
key: every pair within that distance shares a key (32 symbols, 8 chunks,
1 error: distance 15; at similarity 0.8 a pair is beyond it once in 6,000).
Pairs within the distance are confirmed on their full sets.

Documents with equal sets are one node, so exact copies never meet.  For each
key, all nodes are first compared with one leader, in two rounds with different
leaders; within a component no pair is left to compare.  Then the nodes of a key
that are in different components meet in *rooms*: first each is compared with
the few of nearest signature, then, where it is still apart, with all whose
signature is within the distance.  These last pairs never become rows: nodes
are packed in blocks of one neighbourhood, the pairs travel packed by their two
blocks, and sets are compared where two blocks meet (bounded by their shingles too).  So a large group of near copies costs about
its size, not its square, and no link is lost.  For the rooms a signature has
``EXTRA`` more symbols of 8 bits; a pair at similarity 0.8 differs in more than
``EXTRA_MOST`` of them about once in 400,000.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; a text of fewer words than a shingle is one shingle; equal texts are
one component; rows with a null ``doc_id`` take part, but are kept only if all
of their component have none (its component_id is then null); other columns are ignored; empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import BLOCK_BYTES, block_cuts, free_name, prepare, shuffle_tasks, text_bytes, written
from care_analytics.llm.components import components
from care_analytics.llm.prints import mixed
from care_analytics.llm.words import numbers, spans

SYMBOLS, CHUNKS, ERRORS = 32, 8, 1
EXTRA, EXTRA_MOST, NEAREST, ROOM, BLOCK = 192, 65, 4, 4096, 512
PAIRS_HELD = 1 << 19
BLOCK_SHINGLES, ALONE = 1 << 21, 1 << 18
SETS = "doc_id long, text_hash long, n_shingles long, class binary, signature binary"


def shingle_block(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle numbers of each text, ascending, and where each text's begin (one more at the end)."""
    n = len(offsets) - 1
    starts, ends, first = spans(data, offsets)  # first: each text's first word
    word = numbers(data, starts, ends)
    count = np.diff(first)
    text = np.repeat(np.arange(n), count)
    out, owner = [], []
    if len(word) >= words:
        m = len(word) - words + 1
        h = np.zeros(m, np.uint64)
        for j in range(words):
            h = mixed(h * np.uint64(0x9FB21C651E98DF25) + word[j:j + m] + np.uint64(j))
        whole = text[:m] == text[words - 1:]
        out.append(h[whole])
        owner.append(text[:m][whole])
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        h = [int.from_bytes(hashlib.blake2b(word[first[i]:first[i + 1]].tobytes(), digest_size=8).digest(), "little") for i in short]
        out.append(np.array(h, np.uint64))
        owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    h, owner = np.concatenate(out), np.concatenate(owner)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(n + 1))


@lru_cache
def salts(size: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, size, dtype=np.uint64)


def signatures(shingles: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """``size`` 16-bit and ``EXTRA`` 8-bit symbols of the texts with shingles, as bytes, one row each."""
    full = np.flatnonzero(np.diff(bounds))
    keyed, extra = np.zeros((len(full), size), np.uint16), np.zeros((len(full), EXTRA), np.uint8)
    if len(full):
        starts = bounds[full]
        for i, salt in enumerate(salts(size)):
            keyed[:, i] = (mixed(np.minimum.reduceat(mixed(shingles ^ salt), starts)) >> np.uint64(48)).astype(np.uint16)
        # the halves of one 64-bit number serve two symbols
        for i, salt in enumerate(salts(size + EXTRA // 2)[size:]):
            halves = mixed(shingles ^ salt).view(np.uint32).reshape(-1, 2)
            for j in (0, 1):
                low = np.minimum.reduceat(halves[:, j], starts).astype(np.uint64)
                extra[:, 2 * i + j] = (mixed(low) >> np.uint64(56)).astype(np.uint8)
    return np.hstack([keyed.view(np.uint8), extra])


def _sets(batch: pa.RecordBatch, column: int, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, distinct shingles and their bounds for each block of a batch."""
    data, offsets = text_bytes(batch.column(column))
    for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
        low = int(offsets[a])
        yield a, b, *shingle_block(data[low:int(offsets[b])], offsets[a:b + 1] - low, words)


def _digest(own: bytes) -> bytes:
    return hashlib.blake2b(own, digest_size=16).digest()


def signed_sets(docs: DataFrame, words: int, size: int = SYMBOLS) -> DataFrame:
    """doc_id, hash of the text, n_shingles, class (digest of the set) and signature; nulls for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, shingles, bounds in _sets(batch, 1, words):
                symbols = iter(signatures(shingles, bounds, size))
                rows = []
                for i in range(b - a):
                    own = shingles[bounds[i]:bounds[i + 1]].tobytes()
                    rows.append((_digest(own), next(symbols).tobytes()) if own else (None, None))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), batch.column(2).slice(a, b - a), pa.array(np.diff(bounds), pa.int64())]
                    + [pa.array(c, pa.binary()) for c in zip(*rows)], ["doc_id", "text_hash", "n_shingles", "class", "signature"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(sign, SETS)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node`` and ``shingles`` of the documents in ``wanted`` (node, first_id, class), from their texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, classes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b, shingles, bounds in _sets(batch, 2, words):
                own = [shingles[bounds[i]:bounds[i + 1]].tobytes() for i in range(b - a)]
                # rows of one id may differ in their texts
                found = [(nodes[a + i], x) for i, x in enumerate(own) if _digest(x) == classes[a + i]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], ["node", "shingles"])

    texts = docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), F.expr("doc_id <=> first_id"))
    once = texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "class", "h"])
    return once.select("node", "class", "text").mapInArrow(sets, "node long, shingles binary")


def keyed_symbols(column: pa.Array, size: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.ascontiguousarray(rows[:, :2 * size]).view(np.uint16)


def chunk_keys(nodes: DataFrame, size: int, chunks: int, errors: int) -> DataFrame:
    """One row per node and enumerated key: ``key``, its ``number`` (chunk and symbols left out) and ``node``."""
    width = size // chunks
    patterns = list(itertools.combinations(range(width), width - errors))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = keyed_symbols(batch.column(1), size).astype(np.uint64)
            out = []
            for c in range(chunks):
                for k, pattern in enumerate(patterns):
                    h = np.full(len(symbols), c * len(patterns) + k + 1, np.uint64)
                    for j in pattern:
                        h = mixed(h * np.uint64(0x9FB21C651E98DF25) + symbols[:, c * width + j])
                    out.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(np.arange(len(out)), len(symbols)), pa.int32()),
                 pa.array(np.tile(batch.column(0).to_numpy(zero_copy_only=False), len(out)), pa.int64())], ["key", "number", "node"])

    return nodes.select("node", "signature").mapInArrow(keys, "key long, number int, node long")


def within_distance(pairs: DataFrame, nodes: DataFrame, size: int, most: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose signatures differ in at most ``most`` symbols."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (keyed_symbols(batch.column(k), size) for k in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((x != y).sum(axis=1) <= most))

    sides = [nodes.select(F.col("node").alias(k), F.col("signature").alias(f"s{k}")) for k in "ab"]
    return (pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sa", "sb")
            .mapInArrow(near, "a long, b long"))


def first_shared(differs: np.ndarray, chunks: int, errors: int) -> np.ndarray:
    """For rows of differing symbols the number of the first key that the pair shares."""
    width = differs.shape[1] // chunks
    patterns = list(itertools.combinations(range(width), width - errors))
    shared = np.stack([~differs[:, [c * width + j for j in pattern]].any(axis=1) for c in range(chunks) for pattern in patterns], axis=1)
    return shared.argmax(axis=1)


def room_pairs(placed: DataFrame, nodes: DataFrame, size: int, chunks: int, errors: int, nearest: int | None) -> DataFrame:
    """Pairs of one key in different components within the signature distance, packed by their blocks:
    block_a, block_b, pairs (binary, two numbers each).  With ``nearest`` only each node's few nearest
    in a room; else each pair in the first key that it shares.

    ``placed``: key, number, node, component, block, low (the key's smallest component).  Every node
    sits in one part of its key's room; nodes of other components than the smallest visit all parts.
    Parts hold about ``ROOM`` nodes.
    """
    spark, most = placed.sparkSession, chunks * (errors + 1) - 1
    parts = placed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / ROOM).cast("int").alias("parts"))
    seats = (placed.join(parts, "key")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("home", F.pmod(F.xxhash64("node"), F.col("parts")) == F.col("part"))
             .withColumn("visits", F.col("component") != F.col("low")).where("home or visits"))
    seats = (seats.join(nodes.select("node", "signature"), "node")
             .select(F.xxhash64("key", "part").alias("room"), "home", "visits", "node", "component", "low", "block", "number", "signature"))

    def visits(held: tuple[np.ndarray, ...], seat: tuple[np.ndarray, ...]) -> Iterator[np.ndarray]:
        """The pairs (block, block, node, node) of each of ``seat`` that visits with those at home."""
        at_home, homes, _, home_blocks, _, _, home_marks = held
        who, group, low, block, number, visiting, marks = seat
        for k in np.flatnonzero(visiting).tolist():
            apart = np.flatnonzero(homes != group[k])
            extra = (home_marks[apart, 2 * size:] != marks[k, 2 * size:]).sum(axis=1)
            keep = extra <= EXTRA_MOST
            apart, extra = apart[keep], extra[keep]
            keyed = np.ascontiguousarray(home_marks[apart, :2 * size]).view(np.uint16) != marks[k, :2 * size].copy().view(np.uint16)
            keep = keyed.sum(axis=1) <= most
            if nearest is None:
                # two visitors meet twice, and a pair in every key that it shares
                keep &= (homes[apart] == low[k]) | (at_home[apart] > who[k])
                keep[keep] = first_shared(keyed[keep], chunks, errors) == number[k] if keep.any() else keep[keep]
                apart = apart[keep]
            else:
                apart = apart[keep][np.argsort(extra[keep], kind="stable")[:nearest]]
            if len(apart):
                n = np.full(len(apart), who[k])
                yield np.column_stack([np.full(len(apart), block[k]), home_blocks[apart], n, at_home[apart]])

    def in_rooms(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """Visits start when all homes of a room are held: they come first, in any number of batches."""
        room, coming, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rooms, home, visiting = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            marks = np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            columns = (*(batch.column(k).to_numpy() for k in range(3, 8)), visiting, marks)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(rooms)) + 1, [len(rooms)]])
            for a, b in zip(edges[:-1], edges[1:]):
                if rooms[a] != room:
                    if coming:
                        held = tuple(map(np.concatenate, zip(*coming)))
                        yield from visits(held, held)
                    room, coming, held = rooms[a], [], None
                for at, homes in ((a + np.flatnonzero(home[a:b]), True), (a + np.flatnonzero(~home[a:b]), False)):
                    if not at.size:
                        continue
                    seat = tuple(x[at] for x in columns)
                    if homes:
                        coming.append(seat)
                        continue
                    if coming:
                        held, coming = tuple(map(np.concatenate, zip(*coming))), []
                        yield from visits(held, held)
                    if held:
                        yield from visits(held, seat)
        if coming:
            held = tuple(map(np.concatenate, zip(*coming)))
            yield from visits(held, held)

    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(found)
        turned = rows[:, 0] > rows[:, 1]
        rows[turned] = rows[turned][:, [1, 0, 3, 2]]
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        cuts = np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(axis=1)) + 1
        parted = np.split(rows, cuts)
        return pa.RecordBatch.from_arrays(
            [pa.array([int(x[0, c]) for x in parted], pa.int64()) for c in (0, 1)] + [pa.array([x[:, 2:].tobytes() for x in parted], pa.binary())],
            ["block_a", "block_b", "pairs"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for rows in in_rooms(batches):
            found.append(rows)
            n += len(rows)
            if n >= PAIRS_HELD:
                yield packed(found)
                found, n = [], 0
        if found:
            yield packed(found)

    return (seats.repartition(shuffle_tasks(spark), "room").sortWithinPartitions("room", F.desc("home"))
            .mapInArrow(meet, "block_a long, block_b long, pairs binary"))


def in_blocks(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``block``: nodes whose keys lead to one smallest component, about ``BLOCK`` nodes and
    ``BLOCK_SHINGLES`` shingles together at most; a node of more than ``ALONE`` shingles stands alone."""
    near = (placed.groupBy("node").agg(F.min("low").alias("near")).join(nodes.select("node", "n_shingles"), "node")
            .withColumn("alone", F.col("n_shingles") > ALONE))
    rest = F.when(~F.col("alone"), F.col("n_shingles"))
    parts = near.groupBy("near").agg(F.greatest(F.ceil(F.count(rest) / BLOCK), F.ceil(F.sum(rest) / BLOCK_SHINGLES), F.lit(1)).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    # the number of a lone node makes its hash a different one
    return near.join(parts, "near").select("node", F.when(F.col("alone"), F.xxhash64("near", F.lit(-1), "node")).otherwise(F.xxhash64("near", part)).alias("block"))


def confirmed_in_blocks(packed: DataFrame, blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among packed pairs: the sets of two blocks meet, one row for each two blocks with pairs."""
    spark = packed.sparkSession
    held = written(sets.join(blocks, "node").groupBy("block").agg(F.collect_list(F.struct("node", "shingles")).alias("sets")), "set-blocks")
    pairs = packed.groupBy("block_a", "block_b").agg(F.collect_list("pairs").alias("pairs"))
    sides = [held.select(F.col("block").alias(f"block_{k}"), F.col("sets").alias(f"sets_{k}")) for k in "ab"]
    met = pairs.join(sides[0], "block_a").join(sides[1], "block_b").select("pairs", "sets_a", "sets_b").repartition(shuffle_tasks(spark))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {x["node"]: np.frombuffer(x["shingles"], np.uint64) for k in (1, 2) for x in batch.column(k)[i].as_py()}
                ab = np.frombuffer(b"".join(batch.column(0)[i].as_py()), np.int64).reshape(-1, 2)
                linked = [p for p in np.unique(ab, axis=0).tolist() if overlap(row[p[0]], row[p[1]], percent)]
                if linked:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked)], ["a", "b"])

    return met.mapInArrow(check, "a long, b long")


def overlap(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets share at least ``percent`` of their union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets overlap in at least ``percent`` of their union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = [sets.select(F.col("node").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab"]
    # the larger set travels once with its first node, then with each of its pairs
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, size: int = SYMBOLS, chunks: int = CHUNKS, errors: int = ERRORS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (smallest doc_id linked to it in any number of steps) and kept
    (one document of each component)."""
    prepare(docs.sparkSession)
    most = chunks * (errors + 1) - 1
    sets = written(signed_sets(docs, words, size), "sets")
    # a node is named by its smallest doc_id; a null id only where there is no other
    nodes = written(sets.where("class is not null").groupBy("class")
                    .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
                    .withColumn("node", F.coalesce("doc_id", -1 - F.abs(F.xxhash64("class") % (1 << 62)))), "nodes")
    keys = written(chunk_keys(nodes, size, chunks, errors), "keys")
    shared = keys.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last")
    keys = written(keys.join(shared.select("key"), "key"), "shared-keys")
    wanted = nodes.join(keys.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("first_id"), "class")
    full = written(full_sets(docs, wanted, words), "full-sets")

    links, places = None, None
    for turn in ("first leader", "second leader", "nearest", "all"):
        if places is None:
            placed = keys.withColumn("component", F.col("node"))
        else:
            placed = keys.join(places, "node", "left").withColumn("component", F.coalesce("component", "node"))
            apart = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                     .where("low <> high").select("key", "low"))
            placed = written(placed.join(apart, "key"), "open-keys")
            if not placed.take(1):
                break
        if turn.endswith("leader"):
            order = F.col("node") if turn == "first leader" else F.xxhash64("node")
            lead = placed.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", F.col("component").alias("c"))).alias("lead"))
            pairs = (placed.join(lead, "key").where("component <> lead.c")
                     .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")))
            found = confirmed(within_distance(pairs.distinct(), nodes, size, most), full, percent)
        else:
            blocks = written(in_blocks(placed, nodes), "blocks")
            packed = room_pairs(placed.join(blocks, "node"), nodes, size, chunks, errors, NEAREST if turn == "nearest" else None)
            found = confirmed_in_blocks(packed, blocks, full, percent)
        found = written(found, "links")
        links = found if links is None else links.union(found)
        places = components(links)
    named = (nodes.select("class", "node", F.col("doc_id").alias("first_id")).join(places, "node", "left")
             .select("class", "first_id", F.coalesce("component", "node").alias("component"), F.coalesce(F.col("component") == F.col("node"), F.lit(True)).alias("head")))
    return (sets.select("doc_id", "text_hash", "n_shingles", "class").join(named, "class", "left")
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("class").isNull(), F.col("doc_id")).when(F.col("component") >= 0, F.col("component"))
                    .when(F.col("first_id").isNotNull(), F.col("component")).alias("component_id"),
                    F.when(F.col("class").isNull(), True).otherwise(F.col("head") & F.expr("doc_id <=> first_id")).alias("kept")))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest doc_id.  Rows equal in
    doc_id and text are copies too."""
    h = free_name(docs.columns, "text_hash")
    kept = near_duplicates(docs, words, percent).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    rows = docs.withColumn(h, F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_kept_id"]) & (rows[h] == kept["_kept_hash"]), "left_semi")
    return rows.dropDuplicates(["doc_id", h]).drop(h)
