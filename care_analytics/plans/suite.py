"""The registered queries: each report and each operator, with test
parameters and an independent DuckDB oracle.

``QUERIES[name] = (build, oracle)`` where ``build(tables)`` returns the Spark
DataFrame and ``oracle`` is DuckDB SQL over the ``fx_*`` adapters (or
``None`` when only a row check applies).
"""

from __future__ import annotations

import datetime as dt

from care_analytics.plans import oracle_reports as O
from care_analytics.plans import reports as R

# Test parameters (the adapters hold 1995-2001 care data and January 2024
# rosters and events).
AS_OF = dt.date(1998, 9, 1)
PERIOD_START = dt.date(1998, 3, 1)

REPORTS = {
    "r01_clients_without_contact": (
        lambda t: R.r01_clients_without_contact(t, enddate="1998-09-01", costcentre="1000-3000",
                                                relation="%eerste%,%tweede%"), O.R01),
    "r02_rostered_shifts": (lambda t: R.r02_rostered_shifts(t, "2024-01-01", "2024-01-31"), O.R02),
    "r03_expense_totals": (
        lambda t: R.r03_expense_totals(t, "1998-01-01", "1998-01-31", "%gear%,red%"), O.R03),
    "r04_survey_overview": (lambda t: R.r04_survey_overview(t, vragenlijst=None), O.R04),
    "r05_survey_answers": (lambda t: R.r05_survey_answers(t, vragenlijst=""), O.R05),
    "r06_multi_client_events": (
        lambda t: R.r06_multi_client_events(t, dt.datetime(1998, 9, 1, 12)), O.R06),
    "r07_pharmacies_latest_address": (lambda t: R.r07_pharmacies_latest_address(t, AS_OF), O.R07),
    "r08_recent_guardians": (lambda t: R.r08_recent_guardians(t, dt.date(1998, 9, 15)), O.R08),
    "r09_current_locations": (lambda t: R.r09_current_locations(t, AS_OF), O.R09),
    "r10_youth_act_clients": (lambda t: R.r10_youth_act_clients(t, PERIOD_START, AS_OF), O.R10),
    "r11_trajectories_by_referrer": (
        lambda t: R.r11_trajectories_by_referrer(t, PERIOD_START, AS_OF, "Geen verwijzer"), O.R11),
    "r12_open_location_after_care": (
        lambda t: R.r12_open_location_after_care(t, eind=AS_OF, begin=None, locatie="Wachtlijst"), O.R12),
    "r13_tariff_export": (lambda t: R.r13_tariff_export(t), O.R13),
    "r14_confidential_documents": (lambda t: R.r14_confidential_documents(t, AS_OF), O.R14),
    "r15_presence_logs": (lambda t: R.r15_presence_logs(t, "2024-01-05", "2024-01-10"), O.R15),
    "starter_query": (lambda t: R.starter_query(t.locations, "name", "identificationNo"), O.STARTER),
}

# Sort keys of the sorted queries, as the source has them (output columns).
ORDERS = {
    "r01_clients_without_contact": ["clientId"],
    "r06_multi_client_events": ["afspraak_start", "eventObjectId"],
    "r08_recent_guardians": ["updatedAt"],
    "r09_current_locations": ["locatie_naam", "achternaam", "voornaam"],
    "r10_youth_act_clients": ["client"],
    "r12_open_location_after_care": ["legitimatie_eind"],
    "starter_query": ["kolom_1", "kolom_2"],
    "sorted_multi_key": ["lastName", "firstName"],
    "sorted_text": ["segment", "city"],
}


def all_queries() -> dict:
    from care_analytics.plans import operator_queries as OQ
    out = dict(REPORTS)
    out.update(OQ.OPERATORS)
    return out
