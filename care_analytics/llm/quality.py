"""Document quality by kernel ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of the whole text (``FEATURES``) are standardised and mapped to
random cosines that approximate a Gaussian kernel.  Each partition of labelled
rows sums its part of the normal equations (a fixed-size matrix); the sums meet
in one matrix, solved on the driver.  The raw scores of a second part of the
labelled rows, counted in fixed bins, give the isotonic curve from score to
probability.  What reaches the driver has the same size for any input.

Only ``doc_id`` and ``quality`` of the labels are read; language, source and id
are never inputs of a score.  Defined cases: null text counts as empty; an empty
text has a score like any other; several labels of one document count as their
mean; rows without a label are scored but not learned from; without labelled
rows every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import BLOCK_BYTES, block_cuts, prepare, shuffle_tasks, text_bytes, written
from care_analytics.llm.prints import mixed, prints
from care_analytics.llm.words import numbers, spans

COSINES, RIDGE, BINS = 256, 1.0, 2000
FEATURES = ("log_bytes", "log_words", "upper", "digit", "plain_mark", "other_mark", "blank", "line_end", "high",
            "word_mean", "word_spread", "distinct_words", "distinct_pairs", "repeat_next", "marked_words", "upper_words",
            "sentence_ends", "repeated_lines")
_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 plain mark, 4 other mark, 5 blank, 6 line end, 7 beyond ASCII
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 4
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 3
_KIND[[9, 11, 12, 13, 32]], _KIND[10], _KIND[128:] = 5, 6, 7


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of different keys of each owner."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _KIND[data]
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * 8 + kind, minlength=8 * n).reshape(n, 8) if len(data) else np.zeros((n, 8))
    per_byte = kinds / np.maximum(size, 1)[:, None]
    starts, ends, first = spans(data, offsets)
    count = np.diff(first)
    of = np.repeat(np.arange(n), count)
    width = (ends - starts).astype(float)
    many = np.maximum(count, 1)
    mean = np.bincount(of, width, n) / many
    spread = np.sqrt(np.maximum(np.bincount(of, width * width, n) / many - mean * mean, 0))
    word = numbers(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    follows = of[1:] == of[:-1]
    pair = mixed(word[:-1] * np.uint64(0x9FB21C651E98DF25) + word[1:])[follows] if len(word) > 1 else word[:0]
    pair_of = of[1:][follows] if len(word) > 1 else of[:0]
    again = np.bincount(pair_of, (word[1:] == word[:-1])[follows], n) if len(pair) else np.zeros(n)
    marked = np.bincount(of, kind[ends - 1] == 4, n)
    shout = np.bincount(of, (kind[starts] == 1) & (kind[np.minimum(starts + 1, ends - 1)] == 1) & (width > 1), n)
    stops = np.bincount(of, np.isin(data[ends - 1], (33, 46, 63)), n)
    # lines as numbers of their bytes
    line_end = np.flatnonzero(kind == 6)
    cut = np.zeros(len(data) + 1, bool)
    cut[line_end + 1] = cut[offsets] = True
    cuts = np.flatnonzero(cut)
    a, b = cuts[:-1], cuts[1:]
    line_of = np.searchsorted(offsets, a, side="right") - 1
    filled = b - a > 1

    line = prints(4).spans(data, a[filled], b[filled]) if filled.any() else word[:0]
    lines = np.maximum(np.bincount(line_of[filled], minlength=n), 1)
    repeated = 1 - _distinct(line, line_of[filled], n) / lines if len(line) else np.zeros(n)
    return np.column_stack([
        np.log1p(size), np.log1p(count), *(per_byte[:, k] for k in range(1, 8)), mean, spread,
        _distinct(word, of, n) / many, _distinct(pair, pair_of, n) / np.maximum(count - 1, 1), again / many, marked / many, shout / many,
        stops / many, np.where(np.bincount(line_of[filled], minlength=n) > 1, repeated, 0) if len(line) else repeated])


def features(docs: DataFrame) -> DataFrame:
    """doc_id and ``features`` (array of doubles) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
                low = int(offsets[a])
                x = statistics(data[low:int(offsets[b])], offsets[a:b + 1] - low)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int64()), rows], ["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, features array<double>")


class Model:
    """Standardisation, random cosines, ridge weights and the isotonic curve."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, cosines: int = COSINES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        d = len(mean)
        self.directions = rng.normal(0, 1 / np.sqrt(d), (d, cosines))
        self.phases = rng.uniform(0, 2 * np.pi, cosines)
        self.weights = np.zeros(cosines + d + 1)
        self.curve = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), z / 10, np.ones(len(z))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.curve), 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: centres and values of the rising steps of ``mean`` over ``at``."""
    pools: list[list[float]] = []
    for x, y, w in zip(at, mean, weight):
        pools.append([x * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.array(batch.column(column).flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, -1)


def fit(labelled: DataFrame, cosines: int = COSINES, ridge: float = RIDGE) -> Model | None:
    """``labelled``: features, label (0 to 1) and ``curve`` (whether the row shapes the curve or the weights)."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * d + 1)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, 0)
                total += np.concatenate([x.sum(0), (x * x).sum(0), [len(x)]])
        if total[-1]:
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                part = np.frombuffer(x.as_buffer())
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    def summed(df: DataFrame, run) -> np.ndarray:
        # each partition sends its sums as one row; about sqrt(partitions) tasks add those, one task the rest
        parts = df.mapInArrow(run, "v binary").withColumn("k", F.spark_partition_id())
        for groups in (max(1, math.isqrt(shuffle_tasks(df.sparkSession))), 1):
            parts = parts.repartition(groups, "k").select("v").mapInArrow(add, "v binary").withColumn("k", F.spark_partition_id())
        rows = parts.collect()
        return np.frombuffer(rows[0]["v"]) if rows else np.zeros(0)

    base = labelled.where("not curve").select("features", "label")
    m = summed(base, moments)
    if not len(m) or not m[-1]:  # too few rows for two parts
        base = labelled.select("features", "label")
        m = summed(base, moments)
        if not len(m) or not m[-1]:
            return None
    mean = m[:d] / m[-1]
    model = Model(mean, np.sqrt(np.maximum(m[d:2 * d] / m[-1] - mean * mean, 0)), cosines)
    p = len(model.weights)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, p + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.inputs(_matrix(batch, 0))
                total += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        if total.any():
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    ab = summed(base, normal).reshape(p, p + 1)
    model.weights = np.linalg.solve(ab[:, :p] + ridge * np.eye(p), ab[:, p])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, BINS))
        for batch in batches:
            if batch.num_rows:
                raw = model.raw(_matrix(batch, 0))
                k = np.clip((raw + 0.5) * BINS / 2, 0, BINS - 1).astype(int)
                for i, w in enumerate((np.ones(len(k)), batch.column(1).to_numpy(zero_copy_only=False), raw)):
                    sums[i] += np.bincount(k, w, BINS)
        if sums.any():
            yield pa.RecordBatch.from_pydict({"v": [sums.tobytes()]})

    bins = summed(labelled.where("curve").select("features", "label"), binned)
    if not len(bins):
        bins = summed(base, binned)
    n, y, x = bins.reshape(3, BINS)
    used = n > 0
    model.curve = isotonic(x[used] / n[used], y[used] / n[used], n[used])
    return model


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id's text modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % 3


def trained(every: DataFrame, labels: DataFrame, held_out: int | None) -> Model | None:
    """The model of the labelled rows among ``every`` (doc_id, features)."""
    known = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("label")))
    if held_out is not None:
        known = known.where(fold("doc_id") != held_out)
    curve = F.crc32(F.concat(F.lit("curve"), F.col("doc_id").cast("string")).cast("binary")) % 3 == 0
    return fit(written(every.where("doc_id is not null").join(known, "doc_id").select("features", "label", curve.alias("curve")), "labelled"))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: int | None = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; labels of the fold ``held_out`` are not learned."""
    every = written(features(docs), "features")
    model = trained(every, labels, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch, 1)) if model else np.full(batch.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    held = F.coalesce(fold("doc_id") == held_out, F.lit(False)) if held_out is not None else F.lit(False)
    return (every.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, held_out: int | None = 1) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``; texts are scored where they are
    read, so no copy of them is written."""
    model = trained(features(docs), labels, held_out)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not model:
                yield batch
                continue
            data, offsets = text_bytes(batch.column(text))
            for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
                low = int(offsets[a])
                score = model.score(statistics(data[low:int(offsets[b])], offsets[a:b + 1] - low))
                yield batch.slice(a, b - a).filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)
