"""Reports with non-default parameters against adjusted oracle SQL (the
parameter matrix of the source: NULL vs '', lists, ranges, trimming)."""

import datetime as dt

import pytest

from care_analytics.plans import oracle_reports as O
from care_analytics.plans import reports as R
from care_analytics.sources import fixtures
from care_analytics.sources.catalog import Tables


def _day(text):
    return f"DATE '{text}'"


CASES = {
    # list of cost centres; NULL relation = any typed relation; '' end date = no cut-off
    "r01_list_any_relation": (
        lambda t: R.r01_clients_without_contact(t, enddate="", costcentre="1200,1500", relation=None),
        O.r01(None, "no IN ('1200', '1500')", "TRUE")),
    # no cost-centre filter: clients without a cost centre stay
    "r01_no_costcentre": (
        lambda t: R.r01_clients_without_contact(t, enddate="1998", costcentre="", relation="%Eerste%"),
        O.r01(_day("1998-01-01"), "TRUE", "name ILIKE '%eerste%'")),
    # an open period end: no week buckets, the rest of the plan is the same
    "r02_open_end": (lambda t: R.r02_rostered_shifts(t, "2024-01-15", ""), O.r02(_day("2024-01-15"), None)),
    "r02_open_begin": (lambda t: R.r02_rostered_shifts(t, None, "2024-01-15"), O.r02(None, _day("2024-01-15"))),
    # NULL expense pattern: no filter
    "r03_all_expenses": (
        lambda t: R.r03_expense_totals(t, "1998-02-01", "1998-03-15", None), O.r03(_day("1998-02-01"), _day("1998-03-16"), "TRUE")),
    # trimmed title patterns
    "r04_title_filter": (
        lambda t: R.r04_survey_overview(t, vragenlijst=" %blue% , %red%"), O._r04_named(O.r04("s.title ILIKE '%blue%' OR s.title ILIKE '%red%'"))),
    "r04_deduped": (lambda t: R.r04_survey_overview(t, vragenlijst=None, dedupe=True), O._r04_named(O.r04(dedupe=True))),
    # id list with spaces and empty tokens; a non-number matches nothing
    "r05_ids": (lambda t: R.r05_survey_answers(t, vragenlijst=" 1, 2 ,,35 ,x"), O.r05("a.surveyResultObjectId IN (1, 2, 35)")),
    # lower bound set; '' location list excludes nothing (documented contract)
    "r12_bounds_no_exclusion": (
        lambda t: R.r12_open_location_after_care(t, eind="1999-06-30", begin="1997", locatie=""),
        O.r12(_day("1997-01-01"), _day("1999-06-30"), ())),
    "r12_two_names": (
        lambda t: R.r12_open_location_after_care(t, eind="1998-09-01", begin=None, locatie="Wachtlijst, Supplier#000000001"),
        O.r12(names=("Wachtlijst", "Supplier#000000001"))),
    # '' means no bound
    "r12_empty_begin": (lambda t: R.r12_open_location_after_care(t, eind="1998-09-01", begin=""), O.r12()),
    "r12_empty_end": (lambda t: R.r12_open_location_after_care(t, eind="", begin="1997-05-01"), O.r12(_day("1997-05-01"), None)),
    "r12_default_begin": (lambda t: R.r12_open_location_after_care(t, eind="2001-12-31"), O.r12(_day("2000-01-01"), _day("2001-12-31"))),
    "r11_other_period": (
        lambda t: R.r11_trajectories_by_referrer(t, dt.date(1996, 1, 1), dt.date(1996, 12, 31), "geen VERWIJZER"),
        O.r11(_day("1996-01-01"), _day("1996-12-31"))),
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    from oracle_check import duck_connection
    return duck_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(CASES))
def test_report_variant(spark, sf_dir, duck, name):
    from oracle_check import rows_multiset
    build, sql = CASES[name]
    df = build(Tables.from_driver(spark, sf_dir))
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(fixtures.oracle_prefix(sql))
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_multiset(df.columns, s_rows) == rows_multiset(d_cols, d_rows)
