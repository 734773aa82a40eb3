"""Source divergence audit: how far the sources of a language differ in their terms.

Terms are counted by length-bucketed packing.  A chunk of documents is put in order of
their group and counted a part at a time.  In a part a term of up to eight bytes
becomes one 64-bit word, of up to sixteen two words; each of the two buckets is put in
order by a radix sort over 16-bit digits and its runs are counted.  Longer terms go to
buckets by the power of two above their length, which are sorted by bytes.  The sorts
are stable and the part's documents stand in order of their group, so a run splits
into groups and documents by plain comparisons.

Only counts per (group, term) leave a part, and Spark sums them before the shuffle,
so neither a hot source nor a common term gathers rows.  The sum over all kept terms
for a pair of sources is taken over the terms that either of them has; the terms that
neither has contribute one value each.  So no (source, term) pair without a count is
ever made:

    sum f(p, q) = (V - |G| - |H|) f(p0, q0) + sum over G f(p, q0) + sum over H f(p0, q)
                  + sum over G and H of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

with G and H the terms of the two sources and p0, q0 the shares of a term they lack.

Defined cases: null text, lang and source are ''; a repeated row is a document of its
own; a text without terms only makes its group occur; a language without kept terms
gives pairs of value 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_analytics.llm.common import block_cuts, dropped, prepare, text_bytes, written
from care_analytics.llm.terms import NO_LETTER, as_strings, terms

# a chunk's texts are held once or twice, a part takes some 20 times its bytes while it is sorted
CHUNK_BYTES = 32 << 20
PART_BYTES = 4 << 20
# what a document counts beside its text
ROW_BYTES = 64
# counts leave by so many rows
OUT_ROWS = 1 << 15
PAIR_ROWS = 1 << 18
COUNTS = "lang string, source string, term string, n long, docs long"
# the leading k bytes of a word
LEADING = np.array([0, *(((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(1, 9))], np.uint64)


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term as one big-endian number, zeros after its end (no term holds a zero)."""
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    return eight[starts].view(">u8")[:, 0].astype(np.uint64) & LEADING[np.minimum(lengths, 8)]


def radix_order(*words: np.ndarray) -> np.ndarray:
    """Stable order by ``words``, the first the most significant, by 16-bit digits from the last."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digits = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digits) and (digits != digits[0]).any():
                order = order[np.argsort(digits[order], kind="stable")]
    return order


def run_counts(order: np.ndarray, keys: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of equal keys and group: its first member, its size and its number of documents."""
    new = np.ones(len(order), bool)
    new[1:] = group[1:] != group[:-1]
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order))), np.add.reduceat(other.astype(np.int64), first) if len(first) else first


def term_runs(data: np.ndarray, bounds: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of a term, occurrences, documents) of every (term, group); ``group`` and ``doc`` ascend."""
    starts, lengths, out = bounds[:-1], np.diff(bounds), []

    def add(order: np.ndarray, keys: list[np.ndarray]) -> None:
        out.append(run_counts(order, keys, group[order], doc[order]))

    for low, high in ((0, 8), (8, 16)):
        at = np.flatnonzero((lengths > low) & (lengths <= high))
        words = [packed(data, starts[at], lengths[at])]
        if high > 8:
            words.append(packed(data, starts[at] + 8, lengths[at] - 8))
        order = radix_order(*words)
        add(at[order], [w[order] for w in words])
    long_ones = np.flatnonzero(lengths > 16)
    buckets = np.ceil(np.log2(lengths[long_ones])).astype(int)
    whole = data.tobytes() if len(long_ones) else b""
    for bucket in np.unique(buckets):
        at = long_ones[buckets == bucket]
        texts = np.array([whole[a:b] for a, b in zip(starts[at].tolist(), bounds[at + 1].tolist())], f"S{1 << bucket}")
        order = np.argsort(texts, kind="stable")
        add(at[order], [texts[order]])
    return tuple(np.concatenate(x) for x in zip(*out))


def part_counts(lang: pa.DictionaryArray, source: pa.DictionaryArray, text: pa.Array, group: np.ndarray) -> pa.RecordBatch:
    """Counts of documents in order of their group."""
    data, bounds, first = terms(text, NO_LETTER)
    doc = np.repeat(np.arange(len(group)), np.diff(first))
    index, n, docs = term_runs(data, bounds, group[doc], doc)
    of = group[doc[index]] if len(index) else np.zeros(0, np.int64)
    width = max(1, len(source.dictionary))
    return pa.RecordBatch.from_arrays([
        lang.dictionary.take(pa.array(of // width)), source.dictionary.take(pa.array(of % width)),
        as_strings(data, bounds).take(pa.array(index, pa.int64())).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        ["lang", "source", "term", "n", "docs"])


def chunk_counts(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a chunk of (lang, source, text) rows, which ``held`` gives up.  A part of its documents in order of their
    group is sorted at a time: no run goes beyond its group, so only a group that is cut has a term twice."""
    table = pa.Table.from_batches(held).combine_chunks()
    held.clear()
    lang, source = (table.column(k).chunk(0).dictionary_encode() for k in (0, 1))
    text = table.column(2).chunk(0)
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    for a, b in block_cuts(document_costs(text)[order], PART_BYTES):
        counts = part_counts(lang, source, text.take(pa.array(order[a:b])), group[order[a:b]])
        for at in range(0, counts.num_rows, OUT_ROWS):
            yield counts.slice(at, OUT_ROWS)


def document_costs(text: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(text)[1]) + ROW_BYTES


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        costs = document_costs(batch.column(2))
        for a, b in block_cuts(costs, CHUNK_BYTES):
            more = int(costs[a:b].sum())
            if held and size + more > CHUNK_BYTES:
                yield from chunk_counts(held)
                size = 0
            held.append(batch.slice(a, b - a))
            size += more
    if held:
        yield from chunk_counts(held)


def share(n: Column, total: Column) -> Column:
    """1 + floor(10^9 (n + 1) / total) in whole numbers beyond 64 bits; null without a total."""
    up = (n + 1).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", up, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows (lang, term, source, p, p0) in order of lang and term: what the terms that two sources
    share add for the pair, summed over a bounded run of rows."""

    def flush(table: pa.Table) -> pa.RecordBatch:
        lang, source = (pc.dictionary_encode(table.column(k).combine_chunks()) for k in (0, 2))
        codes = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        term = table.column(1).combine_chunks()
        p, p0 = (table.column(k).to_numpy().astype(np.int64) for k in (3, 4))
        same = np.zeros(len(codes), bool)  # as the row before
        same[1:] = (np.diff(lang.indices.to_numpy()) == 0) & pc.equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        run = np.cumsum(~same)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def f(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a - b) * (a - b) // b

        step = 1
        while step < len(run):
            at = np.flatnonzero(run[step:] == run[:-step])
            if not len(at):
                break
            for g, h in ((at, at + step), (at + step, at)):
                add = f(p[g], p[h]) - f(p[g], p0[h]) - f(p0[g], p[h]) + f(p0[g], p0[h])
                pairs, where = np.unique(codes[g] * (int(codes.max()) + 1) + codes[h], return_inverse=True)
                total = np.zeros(len(pairs), np.int64)
                np.add.at(total, where, add)
                found.append((*divmod(pairs, int(codes.max()) + 1), total))
            step += 1
        g, h, total = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        width = max(1, len(source.dictionary))
        return pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(g // width)), source.dictionary.take(pa.array(g % width)), source.dictionary.take(pa.array(h % width)),
             pa.array(total, pa.int64())], ["lang", "source", "item", "value"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= PAIR_ROWS:
            table = pa.Table.from_batches(held)
            # the last term may go on in the next batch
            last = table.slice(rows - 1, 1).to_pylist()[0]
            inside = pc.and_(pc.equal(table.column(0), last["lang"]), pc.equal(table.column(1), last["term"])).to_numpy()
            cut = rows - int(inside.sum())
            if cut:
                yield flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows -= cut
    if held:
        yield flush(pa.Table.from_batches(held))


def source_divergence(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank, as the module says."""
    prepare(docs.sparkSession)
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = (texts.mapInArrow(count_terms, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_term = Window.partitionBy("lang", "term")
    kept = written(counts.withColumn("all_docs", F.sum("docs").over(of_term)).withColumn("all_n", F.sum("n").over(of_term))
                   .withColumn("lead", F.col("source") == F.min("source").over(of_term))
                   .where(F.col("all_docs") >= least_docs).select("lang", "source", "term", "n", "all_n", "lead"), "terms")

    size = F.coalesce(F.sum("n"), F.lit(0))
    langs = kept.groupBy("lang").agg(size.alias("lang_n"), F.count_if("lead").alias("v"))
    own = kept.groupBy("lang", "source").agg(size.alias("own_n"), F.count(F.lit(1)).alias("own_v"))
    zero = {"lang_n": 0, "v": 0, "own_n": 0, "own_v": 0}
    groups = written(texts.select("lang", "source").distinct().join(langs, "lang", "left").join(own, ["lang", "source"], "left").fillna(zero)
                     .withColumn("p0", share(F.lit(0), F.col("own_n") + F.col("v"))), "groups")

    priced = written(kept.join(groups, ["lang", "source"])
                     .select("lang", "source", "term", "p0", share(F.col("n"), F.col("own_n") + F.col("v")).alias("p"),
                             share(F.col("all_n"), F.col("lang_n") + F.col("v")).alias("q")), "shares")
    by_value = [F.col("value").desc(), F.col("item").asc()]
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value))
    words = (priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", ranked).where(F.col("rank") <= top))

    # one row per pair of sources, as the result asks; values are added up beyond 64 bits
    ends = groups.select("lang", F.col("source").alias("item"), F.col("own_v").alias("item_v"), F.col("p0").alias("q0"))
    pairs = (groups.select("lang", "source", "v", "own_v", "p0").join(ends, "lang").where("source <> item")
             .select("lang", "source", "item", ((F.col("v") - F.col("own_v") - F.col("item_v")).cast("decimal(20,0)") * divergence(F.col("p0"), F.col("q0")).cast("decimal(20,0)")).alias("value")))
    levels = written(priced.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("terms")), "levels")
    facing = levels.join(ends, "lang").where("source <> item")
    times = F.col("terms").cast("decimal(20,0)")
    own_side = facing.select("lang", "source", "item", (times * divergence(F.col("p"), F.col("q0")).cast("decimal(20,0)")).alias("value"))
    item_side = facing.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (times * divergence(F.col("q0"), F.col("p")).cast("decimal(20,0)")).alias("value"))
    both = (priced.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(shared_terms, "lang string, source string, item string, value long"))
    parts = [x.select("lang", "source", "item", F.col("value").cast("decimal(38,0)")) for x in (pairs, own_side, item_side, both)]
    summed = parts[0]
    for part in parts[1:]:
        summed = summed.unionByName(part)
    apart = (summed.groupBy("lang", "source", "item").agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", ranked))
    out = written(apart.unionByName(words), "divergence")
    dropped(kept, groups, priced, levels)
    return out


# the same by plain sums over every (group, kept term)
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS n FROM k GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS own,
         1 + ((coalesce(c.n, 0) + 1)::HUGEINT * 1000000000) // (coalesce(s.n, 0) + v.v) AS p,
         1 + ((k.n + 1)::HUGEINT * 1000000000) // (v.n + v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE own > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 200
"""
