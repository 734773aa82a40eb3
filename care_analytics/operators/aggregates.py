"""Aggregations.

All of them aggregate partially before the shuffle, so a key that holds a
large share of the rows does not pile up raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from care_analytics.operators.text import grouped


def group_sum(df: DataFrame, keys, value: str, name: str) -> DataFrame:
    """``SUM(value)`` per key in the column's own type; a decimal keeps its
    scale and sums to 38 digits.  Text keys are grouped by the text rule."""
    kind = df.select(value).schema[0].dataType
    total = F.sum(value)
    if isinstance(kind, DecimalType):
        total = total.cast(DecimalType(38, kind.scale))
    return grouped(df, list(keys), total.alias(name))


def groups_with_many(df: DataFrame, key, item, min_count: int, name: str) -> DataFrame:
    """Keys with more than ``min_count`` distinct items (exact count).

    Spark plans the distinct count as aggregation on (key, item) first, so a
    hot key is spread over the shuffle before it is counted.
    """
    return (df.groupBy(key).agg(F.countDistinct(item).alias(name))
            .filter(F.col(name) > F.lit(min_count)))


def joined_list(df: DataFrame, keys: list[str], item: str, sep: str,
                list_name: str, count_name: str) -> DataFrame:
    """Per key: the items joined by ``sep`` in item order, and ``COUNT(*)``.

    NULL items are counted but left out of the list; no non-NULL item gives
    a NULL list.  Duplicates are kept.  Rows are first reduced to
    ``(key, item, n)`` with a partial aggregate, so the list is built from
    the distinct items of a key, never from its raw rows.  The list itself is
    one value of one row, as the result asks; it must fit a task's memory.
    """
    per_item = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("_n"))
    entry = F.when(F.col(item).isNotNull(),
                   F.struct(F.col(item).alias("v"), F.col("_n").alias("n")))
    grouped = per_item.groupBy(*keys).agg(
        F.sum("_n").alias(count_name),
        F.sort_array(F.collect_list(entry)).alias("_items"),
    )
    sep_sql = "'" + sep.replace("\\", "\\\\").replace("'", "\\'") + "'"
    joined = F.expr("CASE WHEN size(_items) > 0 THEN array_join(flatten(transform(_items, "
                    f"e -> array_repeat(e.v, CAST(e.n AS INT)))), {sep_sql}) END")
    return grouped.select(*keys, joined.alias(list_name), F.col(count_name))


def sum_over_fanout(values: DataFrame, key: str, value: str, branches, name: str) -> DataFrame:
    """``SUM(value)`` per key as if every 1-n ``branch`` had been left-joined
    on the key first, without building that product.

    Each branch (a DataFrame with a ``key`` column, one row per joined row)
    multiplies a key's sum by its row count, or by 1 when it has no rows --
    exactly what a chain of LEFT JOINs does to a SUM.  Everything is
    pre-aggregated per key, so neither skew nor the product size matters.
    """
    out = values.groupBy(key).agg(F.sum(value).alias(name))
    counted = []
    for i, branch in enumerate(branches):
        counted.append(f"_n{i}")
        out = out.join(branch.groupBy(key).agg(F.count(F.lit(1)).alias(counted[-1])), key, "left")
    return out.select(key, (F.col(name) * fan_factor(counted)).alias(name))


def fan_factor(counts) -> Column:
    """How often a row occurs after left joins with so many matches each (none: the row stays once)."""
    factor = F.lit(1)
    for n in counts:
        factor = factor * F.greatest(F.coalesce(F.col(n), F.lit(0)), F.lit(1))
    return factor
