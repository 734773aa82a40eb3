"""One rule for text in DISTINCT, GROUP BY, ORDER BY and equality.

The source compares text without case and without trailing blanks.  Here that
rule is a string collation; grouping under it merges the spellings of a value,
and the smallest spelling (by its bytes) stands for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The collation that compares lower-case text without trailing blanks.
RULE = "UTF8_LCASE_RTRIM"


def as_text(col) -> Column:
    """A text that is compared, grouped, joined and sorted by the rule."""
    return F.collate((F.col(col) if isinstance(col, str) else col).cast("string"), RULE)


def in_order(df: DataFrame, *keys: str) -> list[Column]:
    """Sort keys, texts by the rule; spellings of one value then follow by their bytes."""
    kinds = {f.name: f.dataType for f in df.schema}
    return [as_text(k) if isinstance(kinds[k], StringType) else F.col(k) for k in keys] + [
        F.col(k) for k in keys if isinstance(kinds[k], StringType)]


def grouped(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``GROUP BY keys`` with texts by the rule; the spelling of a group's texts is the
    smallest of its rows (of all texts together, so it is that of one row)."""
    kinds = {f.name: f.dataType for f in df.schema}
    texts = [k for k in keys if isinstance(kinds[k], StringType)]
    if not texts:
        return df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()
    by = [as_text(k).alias(f"_by_{k}") if k in texts else F.col(k) for k in keys]
    out = df.groupBy(*by).agg(F.min(F.struct(*texts)).alias("_spelling"), *aggregates)
    made = [c for c in out.columns if c not in keys and not c.startswith("_by_") and c != "_spelling"]
    return out.select(*[F.col(f"_spelling.{k}").alias(k) if k in texts else F.col(k) for k in keys], *made)


def distinct_rows(df: DataFrame) -> DataFrame:
    """DISTINCT over all columns, texts by the rule."""
    return grouped(df, df.columns)
