"""Lookups, anti-joins, parent fallback, bridges and child summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(col) -> Column:
    """A text as the source dialect compares it: without case and trailing spaces."""
    return F.lower(F.rtrim(F.col(col) if isinstance(col, str) else col))


def lookup(df: DataFrame, dim: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Left lookup of a dimension (code list, master row) by key."""
    return df.join(dim, on, how)


def without_related(df: DataFrame, related: DataFrame, on: Column) -> DataFrame:
    """Rows of ``df`` that have no related row (NOT EXISTS -> left anti join)."""
    return df.join(related, on, "left_anti")


def with_related(df: DataFrame, related: DataFrame, on: Column) -> DataFrame:
    """Rows of ``df`` that have a related row (EXISTS -> left semi join)."""
    return df.join(related, on, "left_semi")


def parent_fallback(own_label: Column, parent_label: Column, use_own: Column) -> Column:
    """The row's own label, or its parent's when ``use_own`` is false."""
    return F.when(use_own, own_label).otherwise(parent_label)


# Children travel in lists of at most 2^10.
LIST_BITS = 10


def nested_children(child: DataFrame, parent, columns: dict[str, Column], name: str) -> DataFrame:
    """Lists ``name`` of the children of each parent (``_parent``), as structs of ``columns``.

    A list holds at most 1024 children: rows are cut by their place in the input
    partition, so a parent with a large share of all children has many lists,
    made on many tasks, and no list grows with the data.
    """
    rows = child.select((F.col(parent) if isinstance(parent, str) else parent).alias("_parent"),
                        F.struct(*[col.alias(n) for n, col in columns.items()]).alias("_child"),
                        F.shiftright(F.monotonically_increasing_id(), LIST_BITS).alias("_part"))
    return (rows.filter(F.col("_parent").isNotNull()).groupBy("_parent", "_part")
            .agg(F.collect_list("_child").alias(name)).drop("_part"))


def fan_out(df: DataFrame, key, bridges) -> DataFrame:
    """Left joins to several 1-n bridges, one row per combination.

    ``bridges`` is a list of ``(children, parent column, {output name: column})``.
    Each bridge joins once, as lists of children, so the rows that are moved are
    the parents; the product is only formed at the end, row by row.
    """
    key = F.col(key) if isinstance(key, str) else key
    names = [f"_children{i}" for i in range(len(bridges))]
    for name, (child, parent, columns) in zip(names, bridges):
        df = df.join(nested_children(child, parent, columns, name), key == F.col("_parent"), "left").drop("_parent")
    for name in names:
        df = df.select("*", F.inline_outer(name)).drop(name)
    return df


def attach_summary(df: DataFrame, summary: DataFrame, on, defaults: dict) -> DataFrame:
    """Left join a per-key summary and replace missing values by defaults."""
    out = df.join(summary, on, "left")
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def polymorphic_bridge(df: DataFrame, key: str, targets, kind_name: str = "invitee_kind") -> DataFrame:
    """Resolve a reference that points into one of several tables.

    ``targets`` is a list of ``(kind, target, target_key, extra)`` where
    ``extra`` maps output names to target columns.  The targets are stacked
    with their kind (missing extras become NULL) and joined once, so ``df`` is
    read and shuffled once however many targets there are.
    """
    from functools import reduce

    parts = [target.select(target[target_key].alias("_target"), F.lit(kind).alias(kind_name),
                           *[col.alias(name) for name, col in extra.items()])
             for kind, target, target_key, extra in targets]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.join(stacked, df[key] == F.col("_target")).drop("_target")
