"""Driver-side parameter parsing (no Spark needed)."""

import datetime as dt

from care_analytics.functions import params as P
from care_analytics.functions.patterns import like_to_regex


def test_split_tokens_like_string_split():
    assert P.split_tokens(None) == []
    assert P.split_tokens("") == [""]
    assert P.split_tokens("a, b ,,c") == ["a", " b ", "", "c"]
    assert P.split_tokens("a, b ,,c", trim=True, drop_empty=True) == ["a", "b", "c"]
    assert P.split_tokens(" 1 , ,25,x", strip_spaces=True, drop_empty=True) == ["1", "25", "x"]


def test_normalise_optional_parameter():
    assert P.normalise(None) is None
    assert P.normalise("") is None
    assert P.normalise("", empty_is_none=False) == ""
    assert P.normalise("%a%") == "%a%"


def test_range_parsing_takes_last_two_dash_parts():
    assert P.parse_range("1000-3000") == (1000, 3000)
    assert P.parse_range("1-2-3") == (2, 3)
    assert P.parse_range("a-3000") == (None, 3000)
    assert P.parse_range("1-2-3-4-5") == (None, None)   # more than four parts
    assert P.parse_range("-3000") == (None, 3000)       # empty part


def test_try_int():
    assert P.try_int(" 12 ") == 12
    assert P.try_int("") is None        # '' is no number here (the source gives 0)
    assert P.try_int("x") is None
    assert P.try_int("99999999999") is None
    assert P.try_int("99999999999", bits=64) == 99999999999


def test_dates():
    assert P.parse_date("2025") == dt.date(2025, 1, 1)
    assert P.parse_date("") is None
    assert P.parse_date("2025-12-31") == dt.date(2025, 12, 31)
    assert P.parse_moment("1998-09-01") == dt.datetime(1998, 9, 1)
    assert P.first_of_previous_month("1998-09-15") == dt.date(1998, 8, 1)
    assert P.first_of_previous_month(dt.date(2026, 1, 10)) == dt.date(2025, 12, 1)


def test_like_to_regex_classes():
    assert like_to_regex("[0-9]%") == "^[0-9].*$"
    assert like_to_regex("a_[^x]") == "^a.[^x]$"
    assert like_to_regex("1.2%") == "^1\\.2.*$"
