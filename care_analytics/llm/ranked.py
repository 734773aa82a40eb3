"""Ranked lexical search, term at a time, with a limit on new accumulators.

A pass over the documents keeps, for each block of texts, the postings of the query
terms (document in the block, occurrences) and adds up the corpus figures.  A second
pass over the postings scores the items: the terms of an item are taken rarest first;
each adds its exact contribution to the accumulators of its documents.  Beside the
k-th score known so far -- of the accumulators, or of documents that the task has
finished before -- stands the sum of the largest contributions of the remaining
terms.  Once that sum is smaller, no document without an accumulator can enter the
first k any more: from there on the remaining terms only update the documents that
have one, so every score that is returned is exact.

Each task returns the k best documents per item; a window ranks them.  Items are
taken in blocks of bounded bytes, so neither their number nor the vocabulary has to
fit anywhere at once.

Defined cases: null and empty texts have no terms and never match (neither do items);
repeated rows are documents of their own and tie; equal scores go to the smaller
``doc_id``, null last; repeated (item_id, text) rows are searched once; an empty table
on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_analytics.llm.common import BLOCK_BYTES, block_cuts, dropped, from_payload, pack_blocks, prepare, text_bytes, written
from care_analytics.llm.terms import NO_ALNUM, as_strings, terms

QUERY_BYTES = 1 << 20
PARTS = 64
POSTINGS = "n_docs long, n_terms long, terms array<int>, df array<long>, ids array<long>, lengths binary, at binary, tf binary"
HITS = "item int, item_id long, part int, doc_id long, score long"


class Queries:
    """The terms of a block of items: all different ones, and the numbers of those of each item."""

    def __init__(self, batch: pa.RecordBatch):
        data, bounds, first = terms(batch.column(1), NO_ALNUM)
        coded = as_strings(data, bounds).dictionary_encode()
        codes = coded.indices.to_numpy()
        self.vocabulary = coded.dictionary
        self.item_ids = batch.column(0).cast(pa.int64()).to_pylist()
        self.terms = [np.unique(codes[a:b]) for a, b in zip(first[:-1], first[1:])]


def block_postings(batch: pa.RecordBatch, vocabulary: pa.Array) -> tuple:
    """A block's row of POSTINGS."""
    data, bounds, first = terms(batch.column(1), NO_ALNUM)
    lengths = np.diff(first)
    term = pc.index_in(as_strings(data, bounds), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(batch.num_rows), lengths)
    asked = term >= 0
    pairs, tf = np.unique(term[asked].astype(np.int64) * max(1, batch.num_rows) + doc[asked], return_counts=True)
    found, at = np.divmod(pairs, max(1, batch.num_rows))
    here, df = np.unique(found, return_counts=True)
    return (int((lengths > 0).sum()), int(lengths.sum()), here.astype(np.int32), df, batch.column(0).cast(pa.int64()),
            lengths.astype("<i8").tobytes(), at.astype("<i4").tobytes(), tf.astype("<i8").tobytes())


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """Blocks of documents (doc_id, text) with the postings of the terms in the broadcast ``vocabulary``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary.value, pa.large_string())
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in block_cuts(np.diff(offsets), BLOCK_BYTES):
                n_docs, n_terms, here, df, ids, lengths, at, tf = block_postings(batch.slice(a, b - a), known)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (pa.array(here, pa.int32()), pa.array(df, pa.int64()), ids)]
                yield pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), *lists,
                                                  *(pa.array([x], pa.binary()) for x in (lengths, at, tf))],
                                                 ["n_docs", "n_terms", "terms", "df", "ids", "lengths", "at", "tf"])

    return docs.select("doc_id", "text").mapInArrow(read, POSTINGS)


class Best:
    """The ``k`` best documents so far: highest score first, then the smaller id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The k-th score, 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.score, self.id, self.null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((self.id, self.null, -self.score))[:self.k]
        self.score, self.id, self.null = self.score[order], self.id[order], self.null[order]


def accumulate(found: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the ``k`` best and their exact scores.

    ``found``: (documents, contributions) of each term, rarest first.  Documents whose score must lie
    below ``least`` or below that of ``k`` others may be missing."""
    rest = np.cumsum([0, *(int(c.max()) for _, c in reversed(found))])[::-1]  # of the terms from here on
    total, live, bar, growing = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool), least, True
    for i, (at, add) in enumerate(found):
        if growing and rest[i] < bar:
            growing = False
        if growing:
            total[at] += add
            live[at] = True
            # the k-th score can only pass the bar and the rest if the best one does
            if max(bar, int(rest[i + 1])) < (scores := total[live]).max() and len(scores) >= k:
                bar = max(bar, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        else:
            total[at] += np.where(live[at], add, 0)
    docs = np.flatnonzero(live & (total >= max(1, least)))
    return docs, total[docs]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(docs: DataFrame, queries: Queries, block_id: int, k: int) -> DataFrame:
    """The hits of one block of items."""
    sc = docs.sparkSession.sparkContext
    table = written(postings(docs, sc.broadcast(queries.vocabulary.to_pylist())), "postings")
    n_docs, n_terms = table.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    # one number for each term of the items' block
    every = table.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df").alias("df"))
    df = {r["terms"]: r["df"] for r in every.collect()}
    rarest = [sorted((t for t in own.tolist() if t in df), key=lambda t: (df[t], t)) for own in queries.terms]
    state = sc.broadcast((rarest, queries.item_ids, {t: weight(n_docs, n) for t, n in df.items()}))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, item_ids, weights = state.value
        best = [Best(k) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column(2)[row].values.to_numpy()
                cuts = np.concatenate([[0], np.cumsum(batch.column(3)[row].values.to_numpy())])
                ids = batch.column(4)[row].values
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                lengths, at, tf = (np.frombuffer(batch.column(c)[row].as_buffer(), kind) for c, kind in ((5, "<i8"), (6, "<i4"), (7, "<i8")))
                m = 100 - 50 + 50 * lengths * n_docs // max(1, n_terms)
                w = np.repeat(np.array([weights[t] for t in here.tolist()], np.int64), np.diff(cuts))
                add = w * (1_000_000_000 * tf // (1000 * tf + 20 * m[at]))
                of_term = {t: (at[a:b], add[a:b]) for t, a, b in zip(here.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())}
                for own, top in zip(items, best):
                    if found := [of_term[t] for t in own if t in of_term]:
                        some, scores = accumulate(found, len(ids), k, top.least)
                        if len(some) > k:
                            some = some[order := np.lexsort((ids[some], null[some], -scores))[:k]]
                            scores = scores[order]
                        top.add(scores, ids[some], null[some])
        part = TaskContext.get().partitionId() % PARTS
        for i, top in enumerate(best):
            if n := len(top.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, i), pa.int32()), pa.array([item_ids[i]] * n, pa.int64()), pa.array(np.full(n, part), pa.int32()),
                    pa.array(top.id, pa.int64(), mask=top.null), pa.array(top.score, pa.int64())], ["item", "item_id", "part", "doc_id", "score"])

    return table.mapInArrow(score, HITS).withColumn("block", F.lit(block_id))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item (item_id, text)."""
    spark = prepare(docs.sparkSession)
    asked = items.select(F.col("item_id").cast("long"), "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = written(pack_blocks(asked.repartition(size // QUERY_BYTES + 1), limit=QUERY_BYTES), "items")
    hits = []
    for (block_id,) in blocks.select("block_id").collect():  # one block of items at a time
        payload = blocks.where(F.col("block_id") == block_id).first()["payload"]
        hits.append(search_block(docs, Queries(from_payload(payload)), block_id, k))
    if not hits:
        hits = [spark.createDataFrame([], HITS).withColumn("block", F.lit(0).cast("long"))]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = reduce(DataFrame.unionByName, hits)
    for keys in (["block", "item", "part"], ["block", "item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


# the same by scoring every pair of document and item
RANKED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), i AS (
  SELECT row_number() OVER () AS i, item_id, term FROM (
    SELECT item_id, text, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark GROUP BY ALL)
), q AS (SELECT i, item_id, unnest(term) AS term FROM i),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n, sum(len(ts))::BIGINT AS l FROM d),
t AS (SELECT r, unnest(ts) AS term FROM d),
f AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term),
x AS (
  SELECT q.i, q.item_id, f.r, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + (50 * len(d.ts) * s.n) // s.l))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (r), s GROUP BY ALL HAVING score > 0
)
SELECT x.item_id, row_number() OVER (PARTITION BY x.i ORDER BY x.score DESC, d.doc_id)::INTEGER AS rank, d.doc_id, x.score
FROM x JOIN d USING (r) QUALIFY rank <= 50
"""
