"""Physical plan shapes that matter at scale."""

import re

import pytest

from care_analytics.plans.suite import REPORTS
from care_analytics.sources.catalog import Tables


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """The reference tables stored as Parquet, as in production (the test
    adapters themselves contain non-equi joins that are not part of any
    report)."""
    from care_analytics.sources import fixtures
    from care_analytics.sources.catalog import materialize
    root = str(tmp_path_factory.mktemp("stored"))
    materialize(Tables.from_driver(spark, sf_dir), fixtures.REFERENCE_TABLES, root, files=2)
    return Tables.from_parquet(spark, root)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_nested_loop_or_cartesian(tables, name):
    text = plan_text(REPORTS[name][0](tables))
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text


def test_latest_row_is_an_aggregate(tables):
    # at most one row per key leaves a map task, and nothing sorts a key's rows by a window
    from care_analytics.plans.operator_queries import OPERATORS
    for build in (REPORTS["r07_pharmacies_latest_address"][0], REPORTS["r12_open_location_after_care"][0], OPERATORS["latest_pair_join"][0]):
        text = plan_text(build(tables))
        assert "Window" not in text and "partial_max_by" in text


def test_filters_reach_the_scan(tables):
    # the predicates must be pushed into the Parquet scan
    import datetime as dt

    from care_analytics.plans import reports as R
    stored = tables
    r11 = plan_text(R.r11_trajectories_by_referrer(stored, dt.date(1998, 3, 1), dt.date(1998, 9, 1)))
    assert "PushedFilters: [IsNotNull(datumAanvang), LessThanOrEqual(datumAanvang" in r11
    r09 = plan_text(R.r09_current_locations(stored, dt.date(1998, 9, 1)))
    assert "IsNull(deathDate)" in r09


def test_count_distinct_is_exact(tables):
    text = plan_text(REPORTS["r06_multi_client_events"][0](tables))
    assert "approx" not in text.lower()


def test_joined_list_aggregates_before_collecting(tables):
    # the list is built from (key, item, n) rows: a partial count comes first
    text = plan_text(REPORTS["r10_youth_act_clients"][0](tables))
    assert "partial_count" in text


@pytest.mark.parametrize("name,cols", [
    ("r01_clients_without_contact", ["clientId"]),
    ("r06_multi_client_events", ["afspraak_start", "eventObjectId"]),
    ("r08_recent_guardians", ["updatedAt"]),
    ("r09_current_locations", ["locatie_naam", "achternaam", "voornaam"]),
    ("r10_youth_act_clients", ["client"]),
    ("r12_open_location_after_care", ["legitimatie_eind"]),
    ("starter_query", ["kolom_1", "kolom_2"]),
])
def test_output_follows_the_source_order(tables, name, cols):
    # extra tie-breakers only refine the order the source asks for
    rows = [tuple(r[c] for c in cols) for r in REPORTS[name][0](tables).collect()]
    key = lambda r: tuple((v is not None, v) for v in r)  # noqa: E731  NULL first, as the source
    assert rows == sorted(rows, key=key)


def test_multi_key_sort(tables):
    from care_analytics.plans.operator_queries import OPERATORS
    got = [(r["lastName"], r["firstName"], r["objectId"]) for r in OPERATORS["sorted_multi_key"][0](tables).collect()]

    def key(v):
        return (v is not None, v.rstrip(" ").lower() if isinstance(v, str) else v)

    assert got and got == sorted(got, key=lambda r: tuple(map(key, r)))


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_building_a_report_starts_no_job(spark, tables, name):
    from care_analytics.sources.catalog import Tables
    fresh = Tables(spark, lambda n: tables[n].select("*"))
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        REPORTS[name][0](fresh)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_period_reaches_the_employee_tables(tables):
    text = plan_text(REPORTS["r02_rostered_shifts"][0](tables))
    for column in ("team_assignments", "expertise_profile_assignments", "contracts"):
        scan = next(x for x in text.split("FileScan") if f"/{column}" in x)
        assert "2024-01-31" in scan and "2024-01-01" in scan, column


@pytest.fixture
def large(spark):
    """Settings under which every table counts as large: no broadcast, Bloom filters whatever a scan's size."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


@pytest.mark.parametrize("name,columns", [
    ("r06_multi_client_events", "eventObjectId.*inviteeObjectId"),  # of agenda_invitations
    ("r10_youth_act_clients", "product_van.*legitimatie|product.*product_van"),  # of legitimaties
    ("r07_pharmacies_latest_address", "careProviderObjectId.*addressObjectId"),  # of care_provider_addresses
    ("r03_expense_totals", "expenseDate"),  # of expenses
])
def test_bloom_filters_stand_at_the_large_scans(tables, large, name, columns):
    filters = [x for x in plan_text(REPORTS[name][0](tables)).splitlines() if "Filter" in x and "might_contain" in x]
    assert any(re.search(columns, x) for x in filters), filters


def test_no_shuffle_above_the_product_of_bridges(tables, large):
    # all shuffles of R14 lie below the lists' expansion
    text = plan_text(REPORTS["r14_confidential_documents"][0](tables))
    above = text[:text.rindex("Generate inline")]
    assert "Exchange" not in above and text.count("Generate inline") == 3


def test_numbering_reads_its_input_once(tables):
    df = REPORTS["r05_survey_answers"][0](tables)
    df.collect()
    final = plan_text(df)
    final = final[:final.index("Initial Plan")] if "Initial Plan" in final else final
    assert final.count("/survey_answers") == 1 and "ReusedExchange" in final


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    from care_analytics.sources import fixtures
    from care_analytics.sources.catalog import store
    out = store(tables, fixtures.REFERENCE_TABLES, str(tmp_path_factory.mktemp("laid")), "care_layout", 4, **{"parquet.block.size": "2048", "parquet.page.size.row.check.min": "10"})
    yield out
    spark.sql("DROP DATABASE care_layout CASCADE")


def shuffles(df) -> int:
    return plan_text(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name,most", [("r01_clients_without_contact", None), ("r09_current_locations", None),
                                       ("r10_youth_act_clients", None), ("r12_open_location_after_care", None), ("r14_confidential_documents", None)])
def test_stored_layout_saves_shuffles(tables, stored, large, name, most):
    plain, laid = REPORTS[name][0](tables), REPORTS[name][0](stored)
    assert shuffles(laid) < shuffles(plain)
    assert sorted(map(tuple, laid.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def scanned(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_period_skips_row_groups_of_the_stored_layout(tables, stored):
    from care_analytics.operators import temporal as T
    for name, begin, end in (("care_allocations", "dateBegin", "dateEnd"), ("location_assignments", "beginDate", "endDate")):
        period = T.overlaps(begin, end, "1999-06-01", "1999-06-30")
        laid, plain = stored[name].filter(period), tables[name].filter(period)
        assert laid.count() == plain.count()
        assert scanned(laid) < 0.8 * scanned(plain), name


def test_early_reductions(tables):
    assert "REPARTITION" not in plan_text(REPORTS["r04_survey_overview"][0](tables))
    r06 = plan_text(REPORTS["r06_multi_client_events"][0](tables))
    assert r06.count("/agenda_invitations") == 1
    assert "LeftSemi" in plan_text(REPORTS["r10_youth_act_clients"][0](tables))
    assert "LeftSemi" in plan_text(REPORTS["r07_pharmacies_latest_address"][0](tables))
    assert "LeftSemi" in plan_text(REPORTS["r03_expense_totals"][0](tables))
    r12 = plan_text(REPORTS["r12_open_location_after_care"][0](tables))
    assert re.search(r"endDate#\d+ >= 9999-12-31", r12)


def test_survey_texts_are_moved_last(spark, tables, large):
    def moved(node):
        own = [node.output().mkString(",")] if node.nodeName() == "Exchange" else []
        children = node.children()
        return own + [x for i in range(children.length()) for x in moved(children.apply(i))]

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = moved(REPORTS["r04_survey_overview"][0](tables)._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the surveys themselves and the lookups of the two cost centre labels, which are small tables
    assert sum("description#" in x for x in rows) == 3
    # results meet answers and cost centres as keys and moments
    assert not any("_moment#" in x and re.search("title#|name#|identificationNo#", x) for x in rows)
    # of an answer's text only whether there is one
    assert any("questionObjectId#" in x for x in rows) and not any("questionObjectId#" in x and re.search(r"\btext#", x) for x in rows)
