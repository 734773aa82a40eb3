"""Near-duplicate embeddings by lattice hashing on E8.

In each of several tables a vector is projected to eight dimensions at random
and decoded to the nearest point of the E8 lattice, its home cell; it also
visits the nearest of the 240 cells around.  A pair meets where one of them
visits the home of the other or both are at home, and its cosine is computed
there in double precision.  At the default width a pair at cosine 0.93 meets in
one table with probability 0.93, in three tables with 0.9996; closer pairs more
often.

Equal vectors of a label are one node with a count, so exact copies are never
compared.  Cells with very many homes are split; visitors go to every part.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or vec_id, link with nothing (n_links 0,
a component of their own); equal vectors link with each other; repeated rows
count as other vectors; an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import prepare, shuffle_tasks, written
from care_analytics.llm.components import components
from care_analytics.llm.prints import mixed

TABLES, PROBES, WIDTH, CELL_HOMES = 3, 16, 0.26, 4096


@lru_cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of size 1, or all of size 1/2 with an even number below 0."""
    pairs = [np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + halves)


def nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    near = np.rint(y)
    rest = y - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return near


def nearest_point(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8: whole points with an even sum, or those shifted by 1/2."""
    a, b = nearest_even(y), nearest_even(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def cell_numbers(points: np.ndarray, table: int) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    h = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(8):
        h = mixed(h * np.uint64(0x9FB21C651E98DF25) + doubled[..., k])
    return h.view(np.int64)


def cells(unit: np.ndarray, table: int, probes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell and visited cells of unit vectors."""
    d = unit.shape[1]
    y = unit @ np.random.default_rng([d, table]).normal(0, 1, (d, 8)) * (0.182 / width)
    home = nearest_point(y)
    around = neighbours()
    close = np.argsort((y - home) @ -around.T, axis=1, kind="stable")[:, :probes]
    return cell_numbers(home, table), cell_numbers(home[:, None, :] + around[close], table)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length: their row numbers and vectors."""
    lists = batch.column(column)
    sizes = np.diff(np.asarray(lists.offsets))
    flat, starts = lists.values.to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(lists.offsets)[:-1]
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def embedding_links(vectors: DataFrame, threshold: float = 0.93, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable) and kept."""
    spark = prepare(vectors.sparkSession)
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    nodes = written(rows.where("fine").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy()
            for at, x in _matrices(batch, 2):
                for t in range(tables):
                    home, visits = cells(_unit(x), t, probes, width)
                    cell = np.concatenate([home, visits.ravel()])
                    who = np.concatenate([at, np.repeat(at, visits.shape[1])])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(who)), pa.array(cell), pa.array(ids[who]), pa.array(np.arange(len(cell)) < len(home)), pa.array(np.full(len(cell), x.shape[1]), pa.int32())],
                        ["label", "cell", "node", "home", "dim"])

    label = f"label {nodes.schema['label'].dataType.simpleString()}"
    entries = written(nodes.select("label", "node", "embedding").mapInArrow(places, f"{label}, cell long, node long, home boolean, dim int"), "places")
    # cells without homes hold no pair; crowded ones are split, their visitors repeated
    key = ["label", "dim", "cell"]
    homes = entries.where("home").groupBy(key).agg(F.ceil(F.count(F.lit(1)) / CELL_HOMES).cast("int").alias("parts"), F.count(F.lit(1)).alias("n"))
    visits = entries.where("not home").groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    homes = homes.join(visits, key, "left").where("n > 1 or m > 0").select(*key, "parts")
    met = (entries.join(homes, key)
           .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .withColumn("home", F.col("home") & (F.pmod(F.xxhash64("node"), F.col("parts")) == F.col("part")))
           .select(F.xxhash64("label", "dim", "cell", "part").alias("room"), "label", "node", "home"))
    met = met.join(nodes.select("node", "label", "embedding"), ["node", "label"]).select("room", "home", "node", "embedding")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, home_ids, home_x = None, np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rooms, at_home, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(rooms)) + 1, [len(rooms)]])
            # one room may hold vectors of several lengths only by a clash of its number
            unit = {d: (rows, _unit(x)) for rows, x in _matrices(batch, 3) for d in [x.shape[1]]}
            pairs = []
            for a, b in zip(edges[:-1], edges[1:]):
                if rooms[a] != room:
                    room, home_ids, home_x = rooms[a], np.zeros(0, np.int64), {}
                for d, (rows, x) in unit.items():
                    lo, hi = np.searchsorted(rows, [a, b])
                    if lo == hi:
                        continue
                    own, mine, inside = x[lo:hi], ids[rows[lo:hi]], at_home[rows[lo:hi]]
                    # homes come first in a room
                    if inside.any():
                        old_ids, old_x = home_x.get(d, (np.zeros(0, np.int64), np.zeros((0, d))))
                        home_x[d] = np.concatenate([old_ids, mine[inside]]), np.concatenate([old_x, own[inside]])
                    if d in home_x:
                        for c in range(0, len(own), 512):
                            i, j = np.nonzero(own[c:c + 512] @ home_x[d][1].T >= threshold)
                            p, q = mine[c:c + 512][i], home_x[d][0][j]
                            keep = p != q
                            pairs.append((np.minimum(p, q)[keep], np.maximum(p, q)[keep]))
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs))
                if len(a):
                    ab = np.unique(np.column_stack([a, b]), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    links = written(met.repartition(shuffle_tasks(spark), "room").sortWithinPartitions("room", F.desc("home"))
                    .mapInArrow(compare, "a long, b long").distinct(), "links")
    counts = nodes.select("node", "copies")
    both = links.union(links.select("b", "a"))
    degree = (both.join(counts.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "node"))
    named = (nodes.join(degree, "node", "left").join(components(links), "node", "left")
             .select("label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")))
    linked = (rows.where("fine").join(named, ["label", "embedding"]).select("vec_id", "n_links", F.col("component").alias("component_id")))
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
