"""Column helpers: all built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source's for right results.
# Unit description -> export unit code (case-insensitive on the description);
# any other description is passed through unchanged.
UNIT_CODES = {
    "dagdeel": "DAY4HOURS",
    "dag": "DAY8HOURS",
    "12 uren": "DAY12HOURS",
    "24 uren": "DAY24HOURS",
    "uur": "HOUR",
    "vijf minuten": "FIVEMINUTE",
    "minuut": "MINUTE",
    "kilometer": "KILOMETERS",
    "stuk": "PIECE",
    "week": "WEEK",
    "maand": "MONTH",
    "periode": "PERIOD",
    "jaar": "YEAR",
    "half jaar": "HALFYEAR",
    "kwartaal": "QUARTER",
    "kwartier": "FIFTEEN_MINUTES",
    "euro": "EURO",
}
# Survey result status code -> label; any other code is 'Onbekend'.
STATUS_LABELS = {0: "Nieuw", 1: "Concept", 2: "Bespreken", 3: "Actueel", 4: "Gearchiveerd"}
STATUS_UNKNOWN = "Onbekend"
YES, NO = "Ja", "Nee"
# Source label written on every survey answer row.
ANSWER_SOURCE = "ONS"
# ---------------------------------------------------------------------------


class Text(str):
    """A literal text part for :func:`concat0` (plain strings are column names)."""


SP = Text(" ")


def sql_name(name: str) -> str:
    """``'a.b'`` -> ```a`.`b``` for use inside a SQL expression string."""
    return ".".join(f"`{part}`" for part in name.split("."))


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def concat0(*cols) -> Column:
    """CONCAT where NULL counts as the empty string (plain ``concat`` gives NULL).

    Strings are column names; :class:`Text` parts (e.g. :data:`SP`) are
    literals.  Built as one SQL expression.
    """
    if all(isinstance(c, str) for c in cols):
        parts = [sql_text(c) if isinstance(c, Text) else f"coalesce(cast({sql_name(c)} as string), '')"
                 for c in cols]
        return F.expr(f"concat({', '.join(parts)})")
    return F.concat(*[F.coalesce(lit_or_col(c).cast("string"), F.lit("")) for c in cols])


def lit_or_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_ws_labels(sep: str, *cols) -> Column:
    """CONCAT_WS: NULL parts are skipped; all NULL gives ``''``."""
    return F.concat_ws(sep, *[lit_or_col(c).cast("string") for c in cols])


def truncate_text(col, length: int = 99) -> Column:
    """A truncating cast to ``varchar(length)``."""
    return F.substring(lit_or_col(col).cast("string"), 1, length)


def time_minute_text(col) -> Column:
    """``HH:mm:ss`` -> ``HH:mm`` (left five characters)."""
    return F.substring(lit_or_col(col), 1, 5)


def _minutes_sql(name: str) -> str:
    n = sql_name(name)
    return f"(try_cast(substring({n}, 1, 2) as int) * 60 + try_cast(substring({n}, 4, 2) as int))"


def minute_of_day(col) -> Column:
    """Minutes since midnight of an ``HH:mm[:ss]`` text; seconds are ignored."""
    if isinstance(col, str):
        return F.expr(_minutes_sql(col))
    return F.substring(col, 1, 2).try_cast("int") * 60 + F.substring(col, 4, 2).try_cast("int")


def shift_hours(start: str, stop: str, break_start: str, break_stop: str) -> Column:
    """Net hours of a shift given as ``HH:mm:ss`` texts (column names).

    A stop before the start runs past midnight (+24 h); so does a break whose
    start is after its stop.  No break start means no break; a break start
    without a stop gives NULL.  Whole minutes, one division, 6 decimals.
    """
    s, e, bs, be = (sql_name(c) for c in (start, stop, break_start, break_stop))
    ms, me, mbs, mbe = (_minutes_sql(c) for c in (start, stop, break_start, break_stop))
    return F.expr(
        f"cast(cast((CASE WHEN {e} < {s} THEN 1440 - {ms} + {me} ELSE {me} - {ms} END)"
        f" - (CASE WHEN {bs} IS NULL THEN 0 WHEN {bs} > {be} THEN {mbe} - {mbs} + 1440"
        f" ELSE {mbe} - {mbs} END) as decimal(18,6)) / 60 as decimal(18,6))")


def date_text(col, fmt: str) -> Column:
    """Date or timestamp as text, e.g. ``'yyyyMMdd'`` or ``'dd-MM-yyyy'``."""
    return F.date_format(lit_or_col(col), fmt)


def compact_date(col) -> Column:
    return date_text(col, "yyyyMMdd")


def dutch_date_text(col) -> Column:
    return date_text(col, "dd-MM-yyyy")


# Dutch weekday names, as they may stand before a date, and month names.
WEEKDAYS = ("maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag", "zondag",
            "ma", "di", "wo", "do", "vr", "za", "zo")
MONTHS = ("januari", "februari", "maart", "april", "mei", "juni", "juli", "augustus",
          "september", "oktober", "november", "december")
SHORT_MONTHS = ("jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec")
# A two-digit year up to this one is in this century, later ones in the last.
LAST_SHORT_YEAR = 49

_MONTH = rf"({'|'.join(dict.fromkeys(MONTHS + SHORT_MONTHS))})\.?"
_YEAR = r"(\d{4}|\d{2})"
# one alternative per order of the parts; at most one of them fills its groups
DUTCH_DATE = (
    rf"(?i)^(?:(?:{'|'.join(WEEKDAYS)})\.?,?\s+)?(?:"
    r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"               # 1 year, 2 month, 3 day
    rf"|(\d{{1,2}})([-/.])(\d{{1,2}})\5{_YEAR}"           # 4 day, 6 month, 7 year
    r"|(\d{1,2})[-/](\d{1,2})"                           # 8 day, 9 month
    rf"|(\d{{1,2}})[\s-]+{_MONTH}(?:[\s-]+{_YEAR})?"      # 10 day, 11 name, 12 year
    rf"|{_MONTH}\s+(\d{{4}})"                             # 13 name, 14 year
    r"|(\d{4})(\d{2})(\d{2})"                            # 15 year, 16 month, 17 day
    r")(?:(?:\s+|T)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?)?$")
# year, month number, month name, day
DUTCH_PARTS = "$1$7$12$14$15;$2$6$9$16;$11$13;$3$4$8$10$17"


def parse_dutch_date(col, as_of=None) -> Column:
    """Dutch date text -> DATE, or NULL when nothing fits.

    The text is an optional weekday, a date and an optional time (dropped).  The
    date is day, month and year in this order, the month as a number or as a
    Dutch name or short name, the parts apart by ``-``, ``/``, ``.`` or blanks;
    or year, month, day (``2025-01-03``, ``20250103``); or a month and a year
    (its first day).  A two-digit year falls in 1950-2049; a missing one is that
    of ``as_of``, or the text gives NULL without it.
    """
    c = F.trim(lit_or_col(col).cast("string"))
    # unfilled groups are empty, so the parts stand at fixed places; a text that does not fit has no parts
    parts = F.split(F.when(c.rlike(DUTCH_DATE), F.regexp_replace(c, DUTCH_DATE, DUTCH_PARTS)), ";")
    year, month, name, day = (parts.getItem(i) for i in range(4))
    names = F.create_map(*[F.lit(x) for i in range(12) for n in dict.fromkeys((MONTHS[i], SHORT_MONTHS[i])) for x in (n, str(i + 1))])
    missing = F.lit(None).cast("string") if as_of is None else F.lit(str(as_of.year))
    short = F.concat(F.when(year.try_cast("int") <= LAST_SHORT_YEAR, F.lit("20")).otherwise(F.lit("19")), year)
    full = F.when(year == "", missing).when(F.length(year) == 2, short).otherwise(year)
    number = F.when(name == "", month).otherwise(F.try_element_at(names, F.lower(name)))
    return F.try_to_date(F.concat(full, F.lit("-"), number, F.lit("-"), F.when(day == "", F.lit("1")).otherwise(day)), "yyyy-M-d")


def map_codes(col: str, pairs: dict[str, str], case_sensitive: bool = False) -> Column:
    """Map a text column through ``pairs``; values without a pair pass unchanged."""
    c = sql_name(col)
    key = c if case_sensitive else f"lower(rtrim({c}))"
    entries = ", ".join(f"{sql_text(k if case_sensitive else k.lower())}, {sql_text(v)}" for k, v in pairs.items())
    return F.expr(f"coalesce(try_element_at(map({entries}), {key}), {c})")


def unit_code(col: str) -> Column:
    return map_codes(col, UNIT_CODES)


def status_label(col: str) -> Column:
    whens = " ".join(f"WHEN {k} THEN {sql_text(v)}" for k, v in STATUS_LABELS.items())
    return F.expr(f"CASE {sql_name(col)} {whens} ELSE {sql_text(STATUS_UNKNOWN)} END")


def yes_no(col: str) -> Column:
    """``'Ja'`` when the flag is 1, otherwise (also NULL) ``'Nee'``."""
    return F.expr(f"CASE WHEN {sql_name(col)} = 1 THEN {sql_text(YES)} ELSE {sql_text(NO)} END")


def answer_text(answertype: str, text: str, definition: str, boolean_answer: str) -> Column:
    """Answer shown for a survey answer: the chosen definition for a
    multiple-choice question without text, 'Ja' for a true boolean, else the
    text."""
    at, tx, de, ba = (sql_name(c) for c in (answertype, text, definition, boolean_answer))
    return F.expr(f"CASE WHEN {at} IN (1, 2) AND {tx} IS NULL THEN {de} "
                  f"WHEN {ba} = 1 THEN {sql_text(YES)} ELSE {tx} END")


def answer_kind(answertype: str) -> Column:
    return F.expr(f"CASE WHEN {sql_name(answertype)} IN (1, 2) THEN 'Meerkeuze' "
                  f"ELSE 'Open/getal/datum/tijd' END")
