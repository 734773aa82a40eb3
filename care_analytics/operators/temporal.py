"""Validity intervals: overlap, valid-at, and joins on them.

Intervals are ``[begin, end]`` with a NULL end meaning open.  Whether ``end``
itself is still valid differs per table and per report, so ``end_inclusive``
is always an explicit argument.  Predicates are written as
``end IS NULL OR end >= x`` (never with a sentinel date) so they push down.
The joins compare by calendar blocks (:class:`Calendar`), not key by key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_analytics.functions import params as P
from care_analytics.functions.scalars import sql_name


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_moment(v: dt.datetime) -> Column:
    """A wall-clock moment as a ``timestamp_ntz`` literal.

    ``F.lit(datetime)`` would make a time-zone-bound timestamp that depends on
    the driver's and the session's zone; the data's moments are wall-clock
    values, so the literal is one too.
    """
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def lit_value(v) -> Column:
    if isinstance(v, dt.datetime):
        return lit_moment(v)
    return F.lit(v)


def _value(v) -> Column:
    if isinstance(v, dt.datetime):
        return lit_moment(v)
    if isinstance(v, dt.date):
        return F.lit(v)
    if isinstance(v, str):
        return F.lit(P.parse_date(v))
    return v


def end_after(end, at, end_inclusive: bool) -> Column:
    e = col_(end)
    a = _value(at)
    return e.isNull() | ((e >= a) if end_inclusive else (e > a))


def overlaps(begin, end, lo=None, hi=None, end_inclusive: bool = True) -> Column | None:
    """Interval ``[begin, end]`` overlaps the period ``[lo, hi]``.

    ``begin <= hi AND (end IS NULL OR end >= lo)`` (``>`` when the end is
    exclusive).  A missing period bound is open on that side.
    """
    # '' means the same as a missing bound
    lo, hi = (P.parse_date(x) if isinstance(x, str) else x for x in (lo, hi))
    preds = []
    if hi is not None:
        preds.append(col_(begin) <= _value(hi))
    if lo is not None:
        preds.append(end_after(end, lo, end_inclusive))
    if not preds:
        return None
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def valid_at(begin, end, at, end_inclusive: bool = True, unit: str = "moment") -> Column:
    """Interval holds at ``at``; ``unit='date'`` compares on the date only."""
    if isinstance(at, (dt.date, dt.datetime, str)):
        at = P.parse_moment(at) if unit == "moment" else P.parse_date(at)
        at = lit_value(at)
    elif unit == "date":
        at = at.cast("date")
    pred = end_after(end, at, end_inclusive)
    if begin is not None:
        pred = (col_(begin) <= at) & pred
    return pred


def open_after(end, cutoff) -> Column | None:
    """Open, or ending after ``cutoff`` (``'2025'`` is 1 January 2025)."""
    d = P.parse_date(cutoff)
    if d is None:
        return None
    e = col_(end)
    return e.isNull() | (e > F.lit(d))


def since_previous_month(col, as_of) -> Column:
    """On or after the first day of the month before ``as_of`` (a literal)."""
    return col_(col) >= F.lit(P.first_of_previous_month(as_of))


# Calendar of a join without a closed period: 2^16 days from this one on (179
# years); days outside count as its first or last day, the exact interval test
# stands beside.
FIRST_DAY = dt.date(1900, 1, 1)
DAY_BITS = 16
# Blocks of a level are 2^4 = 16 times as long as those of the level below; the
# shortest have 16 days.
STEP_BITS = 4


class Calendar:
    """Blocks of days from ``first`` on: of 16 days, 256 days, ... up to one block
    for the whole calendar.

    An interval is put on the level whose blocks are at least as long as it is,
    so it lies in one block or two neighbours; a day asks for its block on every
    level.  Blocks of all levels have numbers of their own.
    """

    def __init__(self, period: tuple | None = None):
        lo, hi = (P.parse_date(x) for x in period) if period is not None else (None, None)
        closed = lo is not None and hi is not None and hi >= lo
        self.lo, self.hi = lo, hi
        self.first = lo if closed else FIRST_DAY
        self.bits = (hi - lo).days.bit_length() if closed else DAY_BITS
        self.shifts = [*range(STEP_BITS, self.bits, STEP_BITS), self.bits]

    # SQL texts, each built as one expression

    def number(self, day: str) -> str:
        return f"least(greatest(datediff(cast({day} AS date), DATE'{self.first}'), 0), {(1 << self.bits) - 1})"

    def base(self, level: int) -> int:
        """The number of the first block of a level; 0 is no block."""
        return 1 + sum((1 << (self.bits - s)) + 1 for s in self.shifts[:level])

    def path(self, day: str) -> str:
        """The blocks that hold a day, one a level."""
        return "array(" + ", ".join(f"shiftright({self.number(day)}, {s}) + {self.base(i)}" for i, s in enumerate(self.shifts)) + ")"

    def covered(self, versions: DataFrame, begin: str, end: str, extra: tuple = ()) -> DataFrame:
        """Each version once per block (``_block``) of the one or two that hold its
        days from ``begin`` to ``end`` (NULL: open); one that ends before it begins
        has no days."""
        top = len(self.shifts) - 1

        def block(day: str) -> str:
            fits = " ".join(f"WHEN _last - _first < {1 << s} THEN shiftright({day}, {s}) + {self.base(i)}" for i, s in enumerate(self.shifts[:top]))
            return f"CASE {fits} WHEN true THEN shiftright({day}, {self.bits}) + {self.base(top)} END"

        # greatest() skips NULLs, so an open end has its own branch
        days = versions.selectExpr("*", f"{self.number(begin)} AS _first",
                                   f"CASE WHEN {end} IS NULL THEN {(1 << self.bits) - 1} ELSE {self.number(end)} END AS _last")
        blocks = [*map(str, extra), f"CASE WHEN _last >= _first THEN {block('_first')} END",
                  f"CASE WHEN _last > _first AND {block('_last')} <> {block('_first')} THEN {block('_last')} END"]
        return days.selectExpr("*", f"explode(array_compact(array({', '.join(blocks)}))) AS _block").drop("_first", "_last")


def asked_days(rows: DataFrame, key: str, at: str, calendar: Calendar, whole: str | None = None) -> DataFrame:
    """The different (key, day) pairs of ``rows``, each with the blocks that hold the day.

    A key has at most one row a day here, however many rows it has.  Days where
    ``whole`` (SQL) holds ask for all versions of their key (block 0).
    """
    key, at = sql_name(key), sql_name(at)
    pairs = rows.where(f"{key} IS NOT NULL AND {at} IS NOT NULL").selectExpr(
        f"{key} AS _valid_key", f"cast({at} AS date) AS _valid_day", f"coalesce({whole or 'false'}, false) AS _valid_whole").distinct()
    path = calendar.path("_valid_day")
    if whole is not None:
        path = f"CASE WHEN _valid_whole THEN array(0) ELSE {path} END"
    return pairs.selectExpr("*", f"explode({path}) AS _valid_block")


def _by_day(left: DataFrame, right: DataFrame, left_key: str, right_key: str, at: str, begin: str, end: str, test: str,
            how: str, calendar: Calendar, days: DataFrame | None, whole: str | None) -> DataFrame:
    """Join by the versions of each (key, day), ``test`` (SQL) deciding on the rows."""
    if days is None:
        days = asked_days(left, left_key, at, calendar, whole)
    lk, rk, at, begin, end = map(sql_name, (left_key, right_key, at, begin, end))
    blocks = calendar.covered(right.where(f"{rk} IS NOT NULL AND {begin} IS NOT NULL"), begin, end, () if whole is None else (0,))
    # a block is longer than the versions in it
    on_day = f"cast({begin} AS date) <= _valid_day AND ({end} IS NULL OR cast({end} AS date) >= _valid_day)"
    found = (days.join(blocks, F.expr(f"_valid_key = {rk} AND _valid_block = _block AND ({'_valid_whole OR ' if whole else ''}{on_day})"))
             .drop("_block", "_valid_block"))
    same = f"{lk} = _valid_key AND cast({at} AS date) = _valid_day" + (f" AND coalesce({whole}, false) = _valid_whole" if whole else "")
    return left.join(found, F.expr(f"{same} AND {test}"), how).drop("_valid_key", "_valid_day", "_valid_whole")


def validity_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, at: str, begin: str, end: str,
                  end_inclusive: bool = True, how: str = "left", period: tuple | None = None,
                  days: DataFrame | None = None) -> DataFrame:
    """Join each left row to the right versions valid at the left row's date (all
    given as column names).

    Versions are found for the different (key, day) pairs of the left rows: a
    version stands in one or two calendar blocks about as long as itself, a day
    asks for the blocks that hold it (one a level), so a day meets few versions
    that do not hold on it, for open ends as for closed ones.  The left rows are
    then joined by key and day, with the exact interval test beside.  A key that
    has a large share of the rows is so spread by days; one that has a large
    share of the versions is spread by blocks.

    ``period`` = (first, last) date of the left rows, when the parameters say
    it: right versions outside it are dropped at the scan, and a period closed
    on both sides makes the calendar smaller.  ``days``: a ready
    :func:`asked_days` of the same keys, dates and period, to share it.
    """
    calendar = Calendar(period)
    live = overlaps(begin, end, calendar.lo, calendar.hi, end_inclusive=True)
    if live is not None:
        right = right.filter(live)
    a, b, e = map(sql_name, (at, begin, end))
    test = f"{b} <= {a} AND ({e} IS NULL OR {e} {'>=' if end_inclusive else '>'} {a})"
    return _by_day(left, right, left_key, right_key, at, begin, end, test, how, calendar, days, None)


def half_day(at: str) -> str:
    """SQL for a moment that compares with dates as ``at`` does: midnight or noon of its day.

    A key has at most two of them a day, however many moments."""
    at = sql_name(at)
    day = f"cast(cast({at} AS date) AS timestamp_ntz)"
    return f"CASE WHEN cast({at} AS timestamp_ntz) = {day} THEN {day} ELSE {day} + INTERVAL 12 HOUR END"


def versions_at(rows: DataFrame, right: DataFrame, key: str, right_key: str, at: str, begin: str, end: str,
                end_inclusive: bool = True) -> DataFrame:
    """The different (``_valid_key``, ``_valid_at``) pairs of ``rows`` with the right
    versions valid then (inner), found by calendar blocks as in :func:`validity_join`; ``_valid_block``
    is the one in which a version was found."""
    calendar = Calendar()
    k, m, rk, b, e = map(sql_name, (key, at, right_key, begin, end))
    pairs = rows.where(f"{k} IS NOT NULL AND {m} IS NOT NULL").selectExpr(f"{k} AS _valid_key", f"{m} AS _valid_at").distinct()
    asked = pairs.selectExpr("*", f"explode({calendar.path('_valid_at')}) AS _valid_block")
    blocks = calendar.covered(right.where(f"{rk} IS NOT NULL AND {b} IS NOT NULL"), b, e)
    valid = f"{b} <= _valid_at AND ({e} IS NULL OR {e} {'>=' if end_inclusive else '>'} _valid_at)"
    return asked.join(blocks, F.expr(f"_valid_key = {rk} AND _valid_block = _block AND {valid}")).drop("_block")


def containment_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, inner_begin: str, inner_end: str,
                     outer_begin: str, outer_end: str, how: str = "left") -> DataFrame:
    """Join to right rows whose interval contains the left row's interval.

    ``outer_begin <= inner_begin AND (outer_end IS NULL OR outer_end >=
    inner_end)``: an open left interval only fits an open right one.  Right rows
    are found by the day of ``inner_begin`` as in :func:`validity_join`; a left
    interval that ends before it begins meets all right rows of its key.
    """
    ib, ie, ob, oe = map(sql_name, (inner_begin, inner_end, outer_begin, outer_end))
    return _by_day(left, right, left_key, right_key, inner_begin, outer_begin, outer_end,
                   f"{ob} <= {ib} AND ({oe} IS NULL OR {oe} >= {ie})", how, Calendar(), None, f"{ie} < {ib}")
