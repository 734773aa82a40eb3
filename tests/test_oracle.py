"""Every registered query against its DuckDB oracle on the same tables."""

import pytest

from care_analytics.plans.suite import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    from oracle_check import duck_connection
    return duck_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    from oracle_check import in_order, rows_multiset, runs
    from care_analytics.plans.suite import ORDERS
    from care_analytics.sources import fixtures
    from care_analytics.sources.catalog import Tables

    build, oracle = QUERIES[name]
    df = build(Tables.from_driver(spark, sf_dir))
    s_rows = [tuple(r) for r in df.collect()]
    assert oracle is not None
    sql = fixtures.oracle_prefix(oracle)
    cur = duck.execute(in_order(sql, ORDERS[name]) if name in ORDERS else sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_multiset(df.columns, s_rows) == rows_multiset(d_cols, d_rows)
    if name in ORDERS:
        assert runs(df.columns, s_rows, ORDERS[name]) == runs(d_cols, d_rows, ORDERS[name])


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["r06_multi_client_events", "valid_at_moment", "r15_presence_logs"])
def test_moment_parameters_ignore_session_time_zone(spark, sf_dir, duck, name):
    # wall-clock moments: the answer must not move with the session's zone
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        test_query_matches_oracle(spark, sf_dir, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_reports_read_catalog_tables(spark, sf_dir):
    # the same report over tables registered in the session catalog
    from care_analytics.plans import reports as R
    from care_analytics.plans.suite import AS_OF
    from care_analytics.sources import fixtures
    from care_analytics.sources.catalog import Tables

    driver = Tables.from_driver(spark, sf_dir)
    needed = ["clients", "care_allocations", "location_assignments", "locations"]
    for name in needed:
        driver[name].createOrReplaceTempView(name)
    try:
        via_catalog = R.r09_current_locations(Tables.from_catalog(spark), AS_OF)
        via_driver = R.r09_current_locations(driver, AS_OF)
        assert via_catalog.count() == via_driver.count() > 0
        assert via_catalog.exceptAll(via_driver).count() == 0
    finally:
        for name in needed:
            spark.catalog.dropTempView(name)
    assert set(needed) <= set(fixtures.REFERENCE_TABLES)
