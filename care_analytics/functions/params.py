"""Report parameters, parsed once on the driver.

The reference takes its parameters as text (``DECLARE @x varchar``) and
decides inside the SQL which branch applies.  Here the decision is made in
Python before the plan is built, so the plan holds only the predicate that
applies and Catalyst can fold and push it.
"""

from __future__ import annotations

import datetime as dt
import re


def normalise(spec: str | None, empty_is_none: bool = True) -> str | None:
    """``None`` when there is no filter: NULL, and also ``''`` if asked."""
    if spec is None:
        return None
    if empty_is_none and spec == "":
        return None
    return spec


def split_tokens(spec: str | None, sep: str = ",", trim: bool = False,
                 strip_spaces: bool = False, drop_empty: bool = False) -> list[str]:
    """Tokens of a delimited parameter, like a string split table function.

    ``None`` gives no tokens; ``''`` gives one empty token unless
    ``drop_empty``.  ``strip_spaces`` removes every space first, ``trim``
    trims each token.
    """
    if spec is None:
        return []
    if strip_spaces:
        spec = spec.replace(" ", "")
    tokens = spec.split(sep)
    if trim:
        tokens = [t.strip() for t in tokens]
    if drop_empty:
        tokens = [t for t in tokens if t != ""]
    return tokens


_INT = re.compile(r"^\s*[+-]?\d+\s*$")


def try_int(text: str | None, bits: int = 32) -> int | None:
    """Integer value of ``text`` that fits ``bits``, or ``None`` (an empty
    string is ``None``)."""
    if text is None or not _INT.match(text):
        return None
    value = int(text)
    if not -(2 ** (bits - 1)) <= value < 2 ** (bits - 1):
        return None
    return value


def dotted_part(text: str, n: int) -> str | None:
    """Part ``n`` counted from the right of a dot-separated name (1..4).

    More than four parts, or an empty part, gives ``None``.
    """
    parts = text.split(".")
    if len(parts) > 4 or n > len(parts):
        return None
    part = parts[-n]
    return part if part != "" else None


def parse_range(spec: str) -> tuple[int | None, int | None]:
    """``'1000-3000'`` -> ``(1000, 3000)``; unparsable bounds give ``None``."""
    dotted = spec.replace("-", ".")
    lo = dotted_part(dotted, 2)
    hi = dotted_part(dotted, 1)
    return (try_int(lo) if lo is not None else None,
            try_int(hi) if hi is not None else None)


def is_range(spec: str) -> bool:
    return "-" in spec


def parse_date(value) -> dt.date | None:
    """A date parameter: ``date``, ``datetime``, ``'2025'`` (1 January) or ISO text."""
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    if text == "":
        return None
    if re.fullmatch(r"\d{4}", text):
        return dt.date(int(text), 1, 1)
    if re.fullmatch(r"\d{8}", text):
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))
    return dt.date.fromisoformat(text[:10])


def parse_moment(value) -> dt.datetime | None:
    """A moment parameter; a bare date means midnight."""
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    if text == "":
        return None
    if len(text) <= 10 or re.fullmatch(r"\d{4}", text):
        d = parse_date(text)
        return dt.datetime(d.year, d.month, d.day)
    return dt.datetime.fromisoformat(text)


def first_of_previous_month(as_of) -> dt.date:
    d = parse_date(as_of)
    year, month = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
    return dt.date(year, month, 1)
