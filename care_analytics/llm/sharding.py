"""Extendible hashing of documents into shards of bounded bytes, with DataFrame expressions only.

A directory over the leading bits of a hash says which shard a document belongs
to.  Only prefixes over the byte limit are split on one more bit, so a shard is
the shortest prefix that fits.  Documents are first added up by *cells* a few
bits finer than the shards will be; sizes of all shorter prefixes follow from
the cells.  Cells that are themselves too large are refined in further rounds,
alone.  The directory stays a table; only its round counter is on the driver.

The hash covers doc_id and text, so rows of one id still spread.  Defined cases:
null id or text counts as empty; a single document over the limit, and rows
equal in id and text, cannot be split by any bit: they form a shard of all 60
bits marked ``oversized`` if they exceed the limit; an empty table stays empty;
columns called like the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import free_name, prepare, written

BITS, FINER = 60, 4


def hash_bits() -> Column:
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def prefix(bits: str, depth: Column | int, of: int = BITS) -> Column:
    """The leading ``depth`` of ``of`` bits."""
    return F.call_function("shiftright", F.col(bits), F.lit(of) - (F.lit(depth) if isinstance(depth, int) else depth))


def directory(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """For ``sizes`` (h, n_bytes), rounds of a cell depth and a table from ``cell`` to its shard: depth,
    prefix, shard_bytes and shard_docs."""
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    low, rounds, rest = 0, [], sizes
    deep = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    while True:
        cells = written(rest.groupBy(prefix("h", deep).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_docs")), "cells")
        paths = cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(deep))).alias("depth")).withColumn("prefix", prefix("cell", F.col("depth"), deep))
        sizes_at = paths.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_docs").alias("shard_docs"))
        # sizes fall along a path, so a cell's shard is the first prefix that fits
        ends = F.col("shard_bytes") <= limit
        if deep == BITS:
            ends |= F.col("depth") == BITS
        found = (paths.select("cell", "depth", "prefix").join(sizes_at.where(ends), ["depth", "prefix"])
                 .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("shard")))
        found = written(found.select("cell", "shard.*"), "directory")
        rounds.append((deep, found))
        large = written(cells.join(found, "cell", "left_anti").select("cell"), "large")
        if deep == BITS or not large.take(1):
            return rounds
        rest = rest.join(large, prefix("h", deep) == F.col("cell"), "left_semi").select("h", "n_bytes")
        low, deep = deep + 1, min(BITS, deep + 8)


def sharded(docs: DataFrame, limit: int = 64 << 20) -> DataFrame:
    """``docs`` with n_bytes, shard_id (its prefix, in bits), shard_depth, shard_bytes, shard_docs and oversized;
    a name that ``docs`` has already gets an underscore."""
    prepare(docs.sparkSession)
    added = ("n_bytes", "shard_id", "shard_depth", "shard_bytes", "shard_docs", "oversized")
    n_bytes, *names = (free_name(docs.columns, c) for c in added)
    rows = docs.withColumn(n_bytes, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    kept = [F.col(f"`{c}`") for c in rows.columns]
    rows = rows.select(F.struct(*kept).alias("row"), hash_bits().alias("h"))
    shard = None
    for k, (deep, cells) in enumerate(directory(rows.select("h", F.col("row").getField(n_bytes).alias("n_bytes")), limit)):
        cells = cells.select("cell", F.struct("depth", "prefix", "shard_bytes", "shard_docs").alias(f"shard{k}"))
        rows = rows.withColumn("at", prefix("h", deep)).join(cells, F.col("at") == F.col("cell"), "left").drop("at", "cell")
        shard = F.col(f"shard{k}") if shard is None else F.coalesce(shard, F.col(f"shard{k}"))
    depth = F.col("shard.depth")
    found = (F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin("shard.prefix"), depth, F.lit("0"))), depth,
             F.col("shard.shard_bytes"), F.col("shard.shard_docs"), F.col("shard.shard_bytes") > limit)
    return rows.withColumn("shard", shard).select("row.*", *(c.alias(name) for c, name in zip(found, names)))


def write_shards(docs: DataFrame, path: str, limit: int = 64 << 20) -> None:
    """One folder per shard; each shard is written by one task."""
    sharded(docs, limit).repartition("shard_id").write.partitionBy("shard_id").parquet(path)


def shard_sql(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), levels AS (
  SELECT depth, h >> ({BITS} - depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM d, (SELECT unnest(range(0, {BITS + 1}))::INTEGER AS depth) GROUP BY ALL
  HAVING sum(n_bytes) <= {limit} OR depth = {BITS}
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), {BITS + 4}, '0'), depth) END AS shard_id,
       depth AS shard_depth, shard_bytes, shard_docs, shard_bytes > {limit} AS oversized
FROM d JOIN levels ON prefix = h >> ({BITS} - depth)
QUALIFY depth = min(depth) OVER (PARTITION BY h)
"""
