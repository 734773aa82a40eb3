"""Latest row and running number per key.

``latest_*`` are plain aggregates (the row with the greatest order), so every
map task forwards at most one row per key and no window sorts a key.
``number_within`` adds up the sizes of small groups of rows, so no key is ever
sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Fixed value: the last day, as which an open end counts.
LAST_DAY = "9999-12-31"
# A group of a running number spans 2^16 values of the last order column.
GROUP_BITS = 16


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: list[str], greatest) -> DataFrame:
    """Per key the row with the greatest ``greatest`` (columns compared one after
    the other, a NULL below every value)."""
    order = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(_cols(greatest))])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def latest_open_per_key(df: DataFrame, keys: list[str], end: str, tie) -> DataFrame:
    """The row with the latest end per key, an open (NULL) end counting as the
    last day there is (so it ties with an explicit 9999-12-31), then by ``tie``."""
    return latest_per_key(df, keys, [F.coalesce(F.col(end), F.lit(LAST_DAY).cast("date")), *_cols(tie)])


def number_within(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Running number 1..n per key, ascending by ``order`` (NULLs first; apply filters first).

    The last order column is a whole number that tells rows apart (an id).  Rows
    are shuffled once, to groups of one key, the leading order values and a span
    of 2^16 ids -- at most so many rows, however hot a key or a (key, value)
    pair is -- and numbered there.  The sizes of the groups before it come from
    running sums over sizes, first of the leading order values of a key, then of
    the spans of one such value.  Rows travel packed, so that sizes are taken
    from the same shuffle and the input is read once.
    """
    lead, last = order[:-1], order[-1]
    part = [*keys, *lead]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def listed(prefix: str, names: list[str]) -> str:
        return ", ".join(f"`{prefix}{n}`" for n in names)

    def same(a: str, b: str, names: list[str]) -> str:
        return " AND ".join(f"`{a}{n}` <=> `{b}{n}`" for n in names)

    def before(within: str, by: str) -> str:
        return (f"coalesce(sum(_n) OVER ({f'PARTITION BY {within}' if within else ''} ORDER BY {by} "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")

    packed = df.selectExpr(*[f"`{k}` AS `_g_{k}`" for k in part], f"shiftright(`{last}`, {GROUP_BITS}) AS _g_",
                           f"array(struct({listed('', df.columns)})) AS _row")
    in_group = listed("_g_", [*part, ""])
    groups = packed.repartition(tasks, *[f"_g_{k}" for k in part], "_g_").selectExpr("*", "inline(_row)").drop("_row")
    numbered = groups.selectExpr("*", f"row_number() OVER (PARTITION BY {in_group} ORDER BY `{last}`) AS _at")
    sizes = (groups.groupBy(*[f"_g_{k}" for k in part], "_g_").agg(F.count(F.lit(1)).alias("_n"))
             .selectExpr(*[f"`_g_{k}` AS `_s_{k}`" for k in [*part, ""]], "_n"))
    offsets = sizes.selectExpr(*[f"`_s_{k}`" for k in [*part, ""]], f"{before(listed('_s_', part), '_s_')} AS _off")
    if lead:
        values = (sizes.groupBy(*[f"_s_{k}" for k in part]).agg(F.sum("_n").alias("_n"))
                  .selectExpr(*[f"`_s_{k}` AS `_t_{k}`" for k in part], f"{before(listed('_s_', keys), listed('_s_', lead))} AS _lead"))
        offsets = offsets.join(values, F.expr(same("_s_", "_t_", part))).selectExpr(*[f"`_s_{k}`" for k in [*part, ""]], "_off + _lead AS _off")
    return (numbered.join(offsets, F.expr(same("_g_", "_s_", [*part, ""])))
            .selectExpr(*[f"`{n}`" for n in df.columns], f"cast(_off + _at AS bigint) AS `{name}`"))
