"""Exact top-k by inner product over KD-trees of shards.

Vectors are scaled and floored to whole numbers.  A bounded sample (SAMPLE rows)
gives median splits, and every row goes to the leaf of these splits that holds it;
a leaf with more rows than a shard takes is dealt out to several.  Each shard builds
a tree by median splits with a tight bounding box at every node.  A query visits
nodes best first by the largest inner product its box allows, and stops when no box
can reach its k-th best score.

Queries travel in blocks of neighbours.  A block first searches a shard of its own
leaf, then the NEXT shards with the largest bounds of all others, then those that are
left.  Its k-th scores go along: a shard whose box cannot reach them is not visited.

Arithmetic is exact: in doubles while all sums stay below 2^53, else in 64-bit whole
numbers, else in unbounded ones.

Defined cases: vectors that are null, empty or hold null or non-finite components and
rows with a null vec_id take no part; a component of 2^63 or more after scaling and a
score beyond 64 bits among the results are errors; only vectors of one length are
compared; all rows with the query's vec_id count as its own row and are no candidates
for it; equal scores go to the smaller vec_id; repeated candidate rows are ranked each,
repeated queries once, different vectors of one vec_id are queries of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_analytics.llm.common import dropped, prepare, shuffle_tasks, written

LEAF, SHARD_ROWS, BLOCK_QUERIES, NEXT = 256, 8192, 256, 8
SAMPLE, SAMPLE_A_LEAF, BOXES = 16_384, 32, 256
EXACT = 1 << 53
NONE = np.iinfo(np.int64).min  # no k-th score yet


class Tree:
    """KD-tree over integer vectors: ids and vectors in leaf order, boxes and spans of the nodes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order, nodes = np.arange(len(ids)), []

        def build(a: int, b: int) -> int:
            part = vectors[order[a:b]]
            at = len(nodes)
            low, high = part.min(0), part.max(0)
            nodes.append([low, high, a, b, -1, -1])
            if b - a > leaf:
                middle = (b - a) // 2
                widest = (high.astype(np.float64) - low.astype(np.float64)).argmax()
                order[a:b] = order[a:b][np.argpartition(part[:, widest], middle)]
                nodes[at][4], nodes[at][5] = build(a, a + middle), build(a + middle, b)
            return at

        build(0, len(ids))
        self.low, self.high = (np.array([n[k] for n in nodes]) for k in (0, 1))
        self.span = np.array([n[2:] for n in nodes])
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query the (up to) ``k`` best ids and scores among scores of at least ``least``."""
        kind = sums_kind(queries, self.low[:1], self.high[:1])
        q, v = queries.astype(kind), self.vectors.astype(kind)
        bounds = box_bounds(q, self.low.astype(kind), self.high.astype(kind))
        span = self.span.tolist()
        for i in range(len(q)):
            bound, floor = bounds[i], least[i].item()
            heap, ids, scores = [(-bound[0], 0)], np.zeros(0, np.int64), np.zeros(0, kind)
            while heap and -heap[0][0] >= floor:
                a, b, left, right = span[heapq.heappop(heap)[1]]
                if left >= 0:
                    for node in (left, right):
                        if bound[node] >= floor:
                            heapq.heappush(heap, (-bound[node], node))
                    continue
                s = v[a:b] @ q[i]
                good = np.flatnonzero((s >= floor) & (self.ids[a:b] != own[i]))
                if len(good):
                    ids, scores = np.concatenate([ids, self.ids[a:b][good]]), np.concatenate([scores, s[good]])
                    if len(ids) > k:
                        best = np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))) if kind is object else np.lexsort((ids, -scores))
                        ids, scores = ids[best[:k]], scores[best[:k]]
                    if len(ids) == k:
                        floor = max(floor, scores.min())
            yield i, ids, scores.astype(np.int64)  # beyond 64 bits: an error


def sums_kind(queries: np.ndarray, low: np.ndarray, high: np.ndarray):
    """The number type in which all inner products and bounds are exact."""
    def most(x: np.ndarray) -> int:
        return max(1, abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))

    top = most(queries) * max(most(low), most(high)) * max(1, queries.shape[1])
    return np.float64 if top < EXACT else np.int64 if top < 1 << 63 else object


def box_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with a point of each box."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


class Splits:
    """Median splits of a sample, for each vector length: leaves are numbered from 0."""

    def __init__(self, sample: dict[int, np.ndarray], leaves: int):
        self.trees = {dim: self._split(v, max(1, min(leaves, len(v) // SAMPLE_A_LEAF))) for dim, v in sample.items()}

    def _split(self, v: np.ndarray, leaves: int):
        spread = v.max(0).astype(np.float64) - v.min(0).astype(np.float64)
        widest = int(spread.argmax())
        x = np.sort(v[:, widest])
        if leaves < 2 or x[0] == x[-1]:
            return None
        cut = x[len(x) // 2] if x[len(x) // 2] > x[0] else x[x > x[0]][0]  # x[0] < cut: neither side is empty
        below = v[:, widest] < cut
        return widest, int(cut), self._split(v[below], leaves // 2), self._split(v[~below], leaves - leaves // 2)

    def leaf(self, dim: int, v: np.ndarray) -> np.ndarray:
        out, count = np.zeros(len(v), np.int32), 0

        def walk(node, rows: np.ndarray) -> None:
            nonlocal count
            if node is None:
                out[rows] = count
                count += 1
                return
            widest, cut, left, right = node
            below = v[rows, widest] < cut
            walk(left, rows[below])
            walk(right, rows[~below])

        walk(self.trees.get(dim), np.arange(len(v)))
        return out


def integer_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, dim and the floored vector of the rows that take part."""
    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 63), F.floor(y)).otherwise(F.raise_error(F.lit("a scaled component is beyond 64 bits")).cast("long"))

    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
            .select(F.col("vec_id").cast("long"), F.size("embedding").alias("dim"), F.transform("embedding", whole).alias("v")))


def _matrices(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """(values of ``keys``, ids, vectors) of the rows of a task with equal ``keys``, the first being dim."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held).combine_chunks().sort_by([(k, "ascending") for k in keys])
        columns = [table.column(k).to_numpy() for k in keys]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0) if len(table) > 1 else np.zeros(0, bool)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(table)]
        for a, b in zip(edges[:-1], edges[1:]):
            part = table.slice(a, b - a).combine_chunks()
            dim = int(columns[0][a])
            yield tuple(int(c[a]) for c in columns), part.column("vec_id").to_numpy(), part.column("v").chunk(0).flatten().to_numpy().reshape(-1, dim)


def fitted_splits(rows: DataFrame, leaves: int) -> Splits:
    """Splits by at most SAMPLE rows, chosen by a hash."""
    sample: dict[int, list] = {}
    for r in rows.select("dim", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, leaves * 4 * SAMPLE_A_LEAF)).collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    return Splits({dim: np.array(v, np.int64) for dim, v in sample.items()}, leaves)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows of every row that meets ``is_query``."""
    spark = prepare(vectors.sparkSession)
    rows = written(integer_vectors(vectors, scale), "integer-vectors")
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    splits = fitted_splits(rows, -(-n_rows // SHARD_ROWS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (dim,), ids, v in _matrices(iter([batch]), ["dim"]):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * dim, pa.int32()), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), dim), pa.int32()), lists, pa.array(splits.leaf(dim, v))], ["vec_id", "dim", "v", "leaf"])

    # rows are numbered once, in a table, so that they keep their shard whatever is computed again
    dealt = written(rows.mapInArrow(deal, "vec_id long, dim int, v array<long>, leaf int").withColumn("row", F.monotonically_increasing_id()), "leaves")
    # a row for each leaf of each length; no leaf is a hot group, its rows are dealt in turn
    parts = dealt.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"))
    sharded = dealt.join(parts, ["dim", "leaf"]).withColumn("part", (F.col("row") % F.col("parts")).cast("int")).drop("parts", "row")

    def pack_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, leaf, part), ids, v in _matrices(batches, ["dim", "leaf", "part"]):
            tree = Tree(ids, v)
            arrays = [tree.ids.astype("<i8"), tree.vectors.astype("<i8"), tree.low.astype("<i8"), tree.high.astype("<i8"), tree.span.astype("<i8")]
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (dim, leaf, part)), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)],
                                             ["dim", "leaf", "part", "ids", "vectors", "low", "high", "span"])

    shards = max(1, -(-n_rows // SHARD_ROWS))
    trees = written(sharded.repartition(max(shards, 1), "dim", "leaf", "part")
                    .mapInArrow(pack_tree, "dim int, leaf int, part int, ids binary, vectors binary, low binary, high binary, span binary")
                    .withColumn("shard", F.monotonically_increasing_id()), "trees")

    def pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for (dim, leaf), ids, v in _matrices(batches, ["dim", "leaf"]):
            for a in range(0, len(ids), BLOCK_QUERIES):
                some = ids[a:a + BLOCK_QUERIES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([leaf], pa.int32()), pa.array([block], pa.int64()), pa.array([some.astype("<i8").tobytes()]),
                     pa.array([v[a:a + BLOCK_QUERIES].astype("<i8").tobytes()]), pa.array([np.full(len(some), NONE, "<i8").tobytes()])],
                    ["dim", "leaf", "block", "q_ids", "q", "least"])
                block += 1

    queries = written(dealt.where(is_query).dropDuplicates(["vec_id", "v"]).repartition(max(1, -(-n_queries // BLOCK_QUERIES)), "dim", "leaf")
                      .mapInArrow(pack_queries, "dim int, leaf int, block long, q_ids binary, q binary, least binary"), "query-blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, tree = row["dim"], Tree.__new__(Tree)
                tree.ids, tree.span = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["span"], "<i8").reshape(-1, 4)
                tree.vectors, tree.low, tree.high = (np.frombuffer(row[x], "<i8").reshape(-1, dim) for x in ("vectors", "low", "high"))
                own, q = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q"], "<i8").reshape(-1, dim)
                found = [x for x in tree.search(q, own, np.frombuffer(row["least"], "<i8"), k) if len(x[1])]
                if found:
                    slots = np.concatenate([np.full(len(x), i) for i, x, _ in found])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(slots), row["block"])), pa.array(slots, pa.int32()), pa.array(own[slots]),
                        pa.array(np.concatenate([x for _, x, _ in found])), pa.array(np.concatenate([s for *_, s in found]))],
                        ["block", "slot", "query_id", "vec_id", "score"])

    def searched(pairs: DataFrame, blocks: DataFrame, tag: str) -> DataFrame:
        """Hits of the (block, shard) ``pairs``."""
        both = (pairs.join(blocks.select("block", "dim", "q_ids", "q", "least"), "block")
                .join(trees.select("shard", "ids", "vectors", "low", "high", "span"), "shard"))
        return written(both.select("block", "dim", "q_ids", "q", "least", "ids", "vectors", "low", "high", "span")
                       .mapInArrow(search, "block long, slot int, query_id long, vec_id long, score long"), tag)

    def ranked(hits: DataFrame) -> DataFrame:
        best = Window.partitionBy("block", "slot").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def bounded(hits: DataFrame, tag: str) -> DataFrame:
        """The query blocks with the k-th scores of ``hits``."""
        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                least = []
                for q_ids, found in zip(batch.column("q_ids").to_pylist(), batch.column("kth").to_pylist()):
                    low = np.full(len(q_ids) // 8, NONE, "<i8")
                    for x in found or []:
                        low[x["slot"]] = x["score"]
                    least.append(low.tobytes())
                yield batch.drop_columns(["kth", "least"]).append_column("least", pa.array(least, pa.binary()))

        kth = (ranked(hits).where(F.col("rank") == k).groupBy("block").agg(F.collect_list(F.struct("slot", "score")).alias("kth")))
        return written(queries.join(kth, "block", "left").select("block", "dim", "leaf", "q_ids", "q", "least", "kth")
                       .mapInArrow(fill, "block long, dim int, leaf int, q_ids binary, q binary, least binary"), tag)

    # the boxes of BOXES shards of one length in a row
    box_rows = (trees.select("dim", "shard", F.substring("low", F.lit(1), F.col("dim") * 8).alias("low"), F.substring("high", F.lit(1), F.col("dim") * 8).alias("high"))
                .withColumn("pack", F.pmod(F.xxhash64("shard"), F.lit(-(-shards // BOXES))).cast("int")))
    boxes = written(box_rows.groupBy("dim", "pack").agg(F.collect_list(F.struct("shard", "low", "high")).alias("boxes")), "boxes")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                q, least = np.frombuffer(row["q"], "<i8").reshape(-1, dim), np.frombuffer(row["least"], "<i8")
                low, high = (np.array([np.frombuffer(b[x], "<i8") for b in row["boxes"]]) for x in ("low", "high"))
                kind = sums_kind(q, low, high)
                bounds = box_bounds(q.astype(kind), low.astype(kind), high.astype(kind))
                some = np.flatnonzero((bounds >= least[:, None]).any(0))
                if len(some):
                    most = [float(x) for x in bounds[:, some].max(0)]  # only for the order of visits
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["block"])), pa.array([row["boxes"][i]["shard"] for i in some.tolist()], pa.int64()), pa.array(most, pa.float64())],
                                                     ["block", "shard", "bound"])

    def reachable(blocks: DataFrame) -> DataFrame:
        """The (block, shard) pairs whose box can reach a k-th score of the block."""
        packs = blocks.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(-(-shards // BOXES) - 1))))
        return packs.join(boxes, ["dim", "pack"]).select("block", "dim", "q", "least", "boxes").mapInArrow(reach, "block long, shard long, bound double")

    home = written(queries.join(trees.where("part = 0").select("dim", "leaf", "shard"), ["dim", "leaf"]).select("block", "shard"), "home-pairs")
    hits = searched(home, queries, "home-hits")
    blocks = bounded(hits, "home-bounds")
    near = written(reachable(blocks).join(home, ["block", "shard"], "left_anti")
                   .withColumn("visit", F.row_number().over(Window.partitionBy("block").orderBy(F.desc("bound"), "shard"))).where(F.col("visit") <= NEXT).select("block", "shard"), "near-pairs")
    hits = written(ranked(hits.union(searched(near, blocks, "near-hits"))).drop("rank"), "near-best")
    blocks = bounded(hits, "near-bounds")
    far = written(reachable(blocks).join(home.union(near), ["block", "shard"], "left_anti").select("block", "shard")
                  .repartition(max(1, min(4 * shuffle_tasks(spark), shards * 4)), "shard", "block"), "far-pairs")
    out = written(ranked(hits.union(searched(far, blocks, "far-hits"))).select("query_id", "rank", "vec_id", "score"), "top-k")
    dropped(rows, dealt, trees, queries, boxes)
    return out
