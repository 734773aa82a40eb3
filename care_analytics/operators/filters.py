"""Row filters built from report parameters.

Builders return a Column, or ``None`` when the parameter means "no filter";
:func:`where` drops the ``None`` ones, so the plan carries only predicates
that apply and simple ones reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_analytics.functions import params as P
from care_analytics.functions import patterns


def where(df: DataFrame, *preds: Column | None) -> DataFrame:
    """Apply every non-``None`` predicate."""
    live = [p for p in preds if p is not None]
    return df.filter(reduce(lambda a, b: a & b, live)) if live else df


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_eq(col, value: str, case_sensitive: bool = False) -> Column:
    """Text equality as the source dialect compares text: case-insensitive
    (its collation) and blind to trailing spaces.

    ``case_sensitive=True`` keeps a plain ``=`` that Parquet can push down.
    """
    c = col_(col)
    if case_sensitive:
        return c == F.lit(value)
    return F.lower(F.rtrim(c)) == F.lit(value.rstrip(" ").lower())


def not_flag(col, flag: int = 1) -> Column:
    """``col <> flag``; NULL is rejected, as in SQL three-valued logic."""
    return col_(col) != F.lit(flag)


def not_blank(col) -> Column:
    """Not NULL and not empty after trimming."""
    return F.trim(col_(col)) != F.lit("")


def in_period(col, start=None, end=None) -> Column | None:
    """``CAST(col AS DATE) BETWEEN start AND end``; a missing bound is open."""
    c = col_(col).cast("date")
    lo, hi = P.parse_date(start), P.parse_date(end)
    preds = []
    if lo is not None:
        preds.append(c >= F.lit(lo))
    if hi is not None:
        preds.append(c <= F.lit(hi))
    return reduce(lambda a, b: a & b, preds) if preds else None


def like_any(col, spec: str | None, trim: bool = False, empty_is_none: bool = False,
             case_sensitive: bool = False) -> Column | None:
    """Any-of LIKE patterns from a comma list; ``None`` spec means no filter."""
    spec = P.normalise(spec, empty_is_none)
    if spec is None:
        return None
    return patterns.match_any(col_(col), P.split_tokens(spec, trim=trim), case_sensitive)


def contains_none(col, spec: str | None, empty_is_none: bool = True,
                  case_sensitive: bool = False) -> Column | None:
    """None-of contains-matches from a comma list (tokens trimmed).

    A NULL value matches no token and is kept.
    """
    spec = P.normalise(spec, empty_is_none)
    if spec is None:
        return None
    tokens = [patterns.contains_pattern(t) for t in P.split_tokens(spec, trim=True)]
    return patterns.match_none(col_(col), tokens, case_sensitive)


def in_tokens(col, spec: str | None, numeric: bool = True, strip_spaces: bool = True,
              drop_empty: bool = True, empty_is_none: bool = True) -> Column | None:
    """Membership in a comma-separated list.

    For a numeric column, a token that is no number matches nothing.
    """
    spec = P.normalise(spec, empty_is_none)
    if spec is None:
        return None
    tokens = P.split_tokens(spec, strip_spaces=strip_spaces, drop_empty=drop_empty)
    if numeric:
        # ids are 64-bit; a token that is no such number matches nothing
        values = [v for v in (P.try_int(t, bits=64) for t in tokens) if v is not None]
    else:
        values = tokens
    if not values:
        return F.lit(False)
    return col_(col).isin(*dict.fromkeys(values))


def in_text_range(col, spec: str) -> Column:
    """Numeric range given as text (``'1000-3000'``) on a text column.

    The column is read as an integer where it is one; other values and
    unparsable bounds match nothing.
    """
    lo, hi = P.parse_range(spec)
    if lo is None or hi is None:
        return F.lit(False)
    return col_(col).try_cast("int").between(F.lit(lo), F.lit(hi))


def flex_number(col, spec: str | None) -> Column | None:
    """No filter (NULL / ``''``), a numeric range ``'a-b'``, or a list ``'a,b'``."""
    spec = P.normalise(spec, True)
    if spec is None:
        return None
    if P.is_range(spec):
        return in_text_range(col, spec)
    # text equality ignores case and trailing spaces in the source dialect
    tokens = [t.rstrip(" ").lower() for t in P.split_tokens(spec)]
    return F.lower(F.rtrim(col_(col))).isin(*dict.fromkeys(tokens))
