"""Edge cases of the operators on tiny inline frames (traps T1-T21)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from care_analytics.functions import scalars as S
from care_analytics.operators import aggregates as A
from care_analytics.operators import filters as FL
from care_analytics.operators import joins as J
from care_analytics.operators import temporal as T
from care_analytics.operators import text as TX
from care_analytics.operators import windows as W

D = dt.date


def _key(row):
    return tuple((v is not None, v) for v in row)


def rows(df, *cols):
    """Rows as sorted tuples, NULL first."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=_key)


def test_interval_end_rules(spark):  # T1
    df = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 6, 1)), (2, D(2020, 1, 1), None),
                                (3, D(2020, 6, 2), None)], "id int, b date, e date")
    at = D(2020, 6, 1)
    incl = FL.where(df, T.valid_at("b", "e", at, end_inclusive=True, unit="date"))
    excl = FL.where(df, T.valid_at("b", "e", at, end_inclusive=False, unit="date"))
    assert rows(incl, "id") == [(1,), (2,)]
    assert rows(excl, "id") == [(2,)]
    ov = FL.where(df, T.overlaps("b", "e", D(2020, 6, 1), D(2020, 6, 1), end_inclusive=False))
    assert rows(ov, "id") == [(2,)]


def test_case_insensitive_text(spark):  # T2
    df = spark.createDataFrame([("MAIN",), ("main ",), ("Standard",), (None,)], "t string")
    assert df.filter(FL.ci_eq("t", "main")).count() == 2        # trailing spaces do not count
    assert df.filter(FL.like_any("t", "%EERST%,sta%")).count() == 1


def test_none_of_keeps_null_names(spark):  # T3, T4
    df = spark.createDataFrame([("Wachtlijst A",), ("Huis",), (None,)], "n string")
    assert rows(FL.where(df, FL.contains_none("n", "wachtlijst")), "n") == [(None,), ("Huis",)]
    assert FL.contains_none("n", "") is None          # documented: '' means no exclusion
    assert FL.contains_none("n", None) is None


def test_like_classes_and_backslash(spark):  # T12
    df = spark.createDataFrame([("1.2 a",), ("x.2",), ("a\\b",), ("7z",)], "t string")
    assert rows(df.filter(FL.like_any("t", "[0-9]%")), "t") == [("1.2 a",), ("7z",)]
    assert rows(df.filter(FL.like_any("t", "a\\b")), "t") == [("a\\b",)]
    assert rows(df.filter(FL.like_any("t", "%[^0-9].2%")), "t") == [("x.2",)]


def test_optional_and_empty_patterns(spark):  # F17, parameter matrix
    df = spark.createDataFrame([("",), ("abc",), (None,)], "t string")
    assert FL.like_any("t", None) is None
    assert df.filter(FL.like_any("t", "")).count() == 1                      # '' matches empty names
    assert FL.like_any("t", "", empty_is_none=True) is None


def test_flexible_number_filter(spark):  # F8-F10, T11
    df = spark.createDataFrame([("1200",), ("1500",), ("K8",), ("4000",), (None,)], "n string")
    assert rows(df.filter(FL.flex_number("n", "1000-3000")), "n") == [("1200",), ("1500",)]
    assert rows(df.filter(FL.flex_number("n", "1500,4000")), "n") == [("1500",), ("4000",)]
    assert rows(df.filter(FL.flex_number("n", "1500 ,4000")), "n") == [("1500",), ("4000",)]
    assert FL.flex_number("n", "") is None and FL.flex_number("n", None) is None
    assert df.filter(FL.flex_number("n", "a-b")).count() == 0               # unparsable bound
    ids = spark.createDataFrame([(1,), (25,), (3,), (5000000000,)], "id long")
    assert rows(ids.filter(FL.in_tokens("id", " 1 , ,25,x")), "id") == [(1,), (25,)]
    assert rows(ids.filter(FL.in_tokens("id", "5000000000")), "id") == [(5000000000,)]
    assert ids.filter(FL.in_tokens("id", "x")).count() == 0


def test_open_after_year_cutoff(spark):  # F13
    df = spark.createDataFrame([(D(2024, 12, 31),), (D(2025, 1, 2),), (None,)], "e date")
    assert df.filter(T.open_after("e", "2025")).count() == 2
    assert T.open_after("e", "") is None


def test_shift_hours(spark):  # T8, T9
    df = spark.createDataFrame([
        ("22:00:00", "06:00:00", "02:00:00", "02:30:00", 7.5),    # overnight
        ("08:00:59", "09:00:00", None, None, 1.0),                # whole minutes only
        ("08:00:00", "16:00:00", "23:50:00", "00:20:00", 7.5),    # break past midnight
        ("08:00:00", "16:00:00", "12:00:00", None, None),         # break without stop
        ("08:00:00", "08:20:00", None, None, 0.333333),
    ], "a string, b string, c string, d string, want double")
    got = df.select(S.shift_hours("a", "b", "c", "d").alias("h"), "want").collect()
    for h, want in got:
        assert (None if h is None else float(h)) == want


def test_concat_variants(spark):  # X1, X2, T21
    df = spark.createDataFrame([("1", None, "n"), (None, None, None)], "a string, b string, c string")
    got = df.select(S.concat0("a", F.lit(" "), "b", F.lit(" "), "c").alias("x"),
                    S.concat_ws_labels(" ", "a", "b", "c").alias("y")).collect()
    assert [tuple(r) for r in got] == [("1  n", "1 n"), ("  ", "")]


def test_labels_and_maps(spark):  # X12, X13, X15
    df = spark.createDataFrame([(0, 1, "Dagdeel"), (9, None, "iets"), (None, 0, None), (5, 2, "DAG  ")],
                               "s int, f int, u string")
    got = df.select(S.status_label("s"), S.yes_no("f"), S.unit_code("u")).collect()
    assert [tuple(r) for r in got] == [("Nieuw", "Ja", "DAY4HOURS"), ("Onbekend", "Nee", "iets"),
                                       ("Onbekend", "Nee", None), ("Onbekend", "Nee", "DAY8HOURS")]


def test_parse_dutch_date(spark):  # X23
    cases = {"3-1-2025": D(2025, 1, 3), "03/01/2025": D(2025, 1, 3), "2025-01-03": D(2025, 1, 3), "2025/1/3": D(2025, 1, 3), "3.1.2025": D(2025, 1, 3),
             "3 maart 2025": D(2025, 3, 3), "3 mrt 2025": D(2025, 3, 3), "5 mrt. 2025": D(2025, 3, 5), "12 mei 2024": D(2024, 5, 12), "12-Mei-24": D(2024, 5, 12),
             "3-1-25": D(2025, 1, 3), "zondag 5 januari 2025": D(2025, 1, 5), "Zondag, 5  JANUARI 2025 ": D(2025, 1, 5), "za 4/1/97": D(1997, 1, 4), "3 mrt 25": D(2025, 3, 3),
             "20250105": D(2025, 1, 5), "05-01-2025 13:45": D(2025, 1, 5), "5 januari 2025 9:05:30": D(2025, 1, 5), "2025-01-05T13:45:01.123": D(2025, 1, 5), "maart 2025": D(2025, 3, 1),
             "29-2-2024": D(2024, 2, 29), "29-2-2025": None, "31-02-2025": None, "20251301": None, "32 januari 2025": None, "5-13-2025": None, "3-1.2025": None, "5 brumaire 2025": None,
             "geen datum": None, "": None, None: None, "2025": None, "3;1;2025": None, "13:45": None, "05-01-2025 13": None}
    without_year = {"5 januari": 1998, "5-1": 1998, "vr 5/1": 1998, "5 jan. 8:00": 1998}
    df = spark.createDataFrame([(k,) for k in [*cases, *without_year]], "t string")
    got = {r[0]: r[1] for r in df.select("t", S.parse_dutch_date("t")).collect()}
    assert got == {**cases, **dict.fromkeys(without_year)}
    got = {r[0]: r[1] for r in df.select("t", S.parse_dutch_date("t", D(1998, 9, 1))).collect()}
    assert got == {**cases, **dict.fromkeys(without_year, D(1998, 1, 5))}


def test_text_rule(spark):  # T2 in P5, A4, A5, O1-O3
    df = spark.createDataFrame([("Ab ", 1), ("ab", 2), ("AB", 1), ("b", 4), (None, 5), ("é", 6), ("É ", 6), ("", 8), ("  ", 8)], "s string, n int")
    assert rows(TX.distinct_rows(df.select("s"))) == [(None,), ("",), ("AB",), ("b",), ("É ",)]
    assert rows(TX.distinct_rows(df)) == [(None, 5), ("", 8), ("AB", 1), ("ab", 2), ("b", 4), ("É ", 6)]
    assert rows(TX.grouped(df, ["s"], F.sum("n").alias("n"))) == [(None, 5), ("", 16), ("AB", 4), ("b", 4), ("É ", 12)]
    assert [r[0] for r in df.orderBy(*TX.in_order(df, "s")).collect()] == [None, "", "  ", "AB", "Ab ", "ab", "b", "É ", "é"]
    assert rows(A.group_sum(df, ["s"], "n", "t")) == [(None, 5), ("", 16), ("AB", 4), ("b", 4), ("É ", 12)]
    pairs = spark.createDataFrame([("b", "X"), ("B", "a"), ("B ", "x")], "p string, q string")
    assert rows(TX.distinct_rows(pairs)) == [("B", "a"), ("B ", "x")]  # the spelling of one row


def test_truncate_and_date_texts(spark):  # X8, X21, X22
    df = spark.createDataFrame([("x" * 150, D(1998, 3, 5))], "s string, d date")
    r = df.select(S.truncate_text("s", 99).alias("t"), S.compact_date("d"), S.dutch_date_text("d")).first()
    assert len(r[0]) == 99 and r[1] == "19980305" and r[2] == "05-03-1998"


def test_latest_per_key_tie_break(spark):  # W1, W2, T10
    df = spark.createDataFrame([(1, 10, D(2020, 1, 1), None), (1, 11, D(2020, 1, 1), D(2021, 1, 1)),
                                (2, 20, D(2019, 1, 1), D(2019, 5, 1)), (2, 21, None, D(2019, 6, 1))],
                               "k int, id int, created date, e date")
    latest = W.latest_per_key(df, ["k"], ["created", "id"])
    assert rows(latest, "k", "id") == [(1, 11), (2, 20)]
    open_latest = W.latest_open_per_key(df, ["k"], "e", ["id"])
    assert rows(open_latest, "k", "id") == [(1, 10), (2, 21)]
    # an explicit last day ties with an open end; the higher id wins
    tied = spark.createDataFrame([(1, 10, None), (1, 11, D(9999, 12, 31)), (2, 5, D(9999, 12, 31)), (2, 6, None)], "k int, id int, e date")
    assert rows(W.latest_open_per_key(tied, ["k"], "e", ["id"]), "k", "id") == [(1, 11), (2, 6)]


def test_number_after_filter(spark):  # W3, T13
    df = spark.createDataFrame([(1, 3, "a"), (1, 1, None), (1, 2, "b"), (2, 5, "c")], "r int, q int, t string")
    out = W.number_within(df.filter(F.col("t").isNotNull()), ["r"], ["q"], "n")
    assert rows(out, "r", "q", "n") == [(1, 2, 1), (1, 3, 2), (2, 5, 1)]


def test_joined_list_semantics(spark):  # A3
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "b"), (2, None), (3, "z")], "k int, v string")
    got = rows(A.joined_list(df, ["k"], "v", " | ", "list", "n"), "k", "list", "n")
    assert got == [(1, "a | b | b", 4), (2, None, 1), (3, "z", 1)]


def test_cost_centres_at_a_moment_are_one_list(spark):  # R04
    from care_analytics.plans.reports import _costcentres_at
    chain = spark.createDataFrame(
        [(1, D(2020, 1, 1), None, 7), (1, D(2020, 1, 1), D(2020, 1, 9), 7), (1, D(2019, 1, 1), D(2020, 12, 31), 7),
         (1, D(2020, 1, 2), None, 8), (1, D(2020, 1, 2), D(2020, 1, 7), None), (1, D(2018, 1, 1), None, None),
         (1, D(2020, 2, 1), None, 9), (2, D(2020, 2, 1), None, 9), (None, D(2020, 1, 1), None, 9)],
        "_person long, _from date, _to date, _label long")
    results = spark.createDataFrame([(1, D(2020, 1, 5)), (1, D(2020, 1, 5)), (1, D(2017, 1, 5)), (2, D(2020, 1, 5)), (2, D(2021, 1, 5)),
                                     (None, D(2020, 1, 5)), (1, None)], "who long, at date").selectExpr("who", "cast(at AS timestamp_ntz) AS _moment")
    found = _costcentres_at(results, "who", chain, True, "m").collect()
    got = {(r["_m_who"], r["_m_at"].date()): {x["_m_label"]: x["_n_m"] for x in r["_m_centres"]} for r in found}
    assert len(found) == 2 and got == {(1, D(2020, 1, 5)): {7: 3, 8: 1, None: 2}, (2, D(2021, 1, 5)): {9: 1}}


def test_sum_over_fanout_matches_joined_sum(spark):  # A6, T6
    values = spark.createDataFrame([(1, 5), (1, 7), (2, None), (3, 4)], "k int, v int")
    branch = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    got = rows(A.sum_over_fanout(values, "k", "v", [branch], "s"), "k", "s")
    brute = rows(values.join(branch, "k", "left").groupBy("k").agg(F.sum("v").alias("s")), "k", "s")
    assert got == brute == [(1, 24), (2, None), (3, 4)]


def test_timestamp_against_date_parameter_means_midnight(spark):  # T14
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 0, 0),), (dt.datetime(2025, 12, 31, 9, 0),)],
                               "ts timestamp_ntz")
    assert df.filter(T.overlaps("ts", F.lit(None).cast("date"), None, "2025-12-31")).count() == 1
    assert df.filter(FL.in_period("ts", None, "2025-12-31")).count() == 2   # cast to date first


@pytest.mark.parametrize("spec,expected", [(None, []), ("", [""]), ("a, b ,,c", ["a", "b", "c"])])
def test_token_table(spark, spec, expected):  # S4
    from care_analytics.functions.params import split_tokens
    tokens = split_tokens(spec, trim=spec is not None and spec != "", drop_empty=bool(spec))
    assert tokens == expected


def test_numbering_of_a_hot_key_with_nulls_and_large_ids(spark):  # W3 at scale
    # key 0 holds a third of the rows; NULL keys and NULL order values too; ids beyond 2^53
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 100 == 1, F.lit(None))
         .otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 2).alias("k2"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 700).alias("o"),
        (F.col("id") + F.lit(9007199254740993)).alias("tie"))
    for keys, order in ((["k"], ["o", "tie"]), (["k", "k2"], ["o", "tie"]), (["k"], ["tie"]), (["k"], ["o", "k2", "tie"])):
        got = W.number_within(df, keys, order, "rn").select("tie", "rn")
        w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
        want = df.withColumn("rn", F.row_number().over(w).cast("bigint")).select("tie", "rn")
        assert got.count() == 30000 and dict(got.dtypes)["rn"] == "bigint"
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_numbering_splits_a_hot_question(spark):  # W3
    # one (survey, question) holds a third of the answers; its rows come in groups of at most 2^16 ids
    df = spark.range(0, 60000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 911).alias("r"),
                                      F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 13).alias("q"), (F.col("id") * 40).alias("a"))
    got = W.number_within(df, ["r"], ["q", "a"], "n")
    w = Window.partitionBy("r").orderBy("q", "a")
    want = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 60000
    spans = df.filter("r = 5 and q = 7").groupBy(F.shiftright("a", W.GROUP_BITS)).count()
    assert spans.agg(F.max("count")).first()[0] <= 1 << W.GROUP_BITS and spans.count() > 10


def test_children_of_a_hot_parent_come_in_bounded_lists(spark):  # J12
    parents = spark.range(0, 5).withColumnRenamed("id", "p")
    tags = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("tp"), F.col("id").alias("tag"))
    rights = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "x")], "rp long, right string")
    lists = J.nested_children(tags, "tp", {"tag": F.col("tag")}, "rows")
    assert lists.filter(F.size("rows") > 1024).count() == 0 and lists.agg(F.sum(F.size("rows"))).first()[0] == 9000
    got = J.fan_out(parents, "p", [(tags, "tp", {"tag": F.col("tag")}), (rights, "rp", {"right": F.upper("right")})])
    want = parents.join(tags, F.col("p") == F.col("tp"), "left").join(rights, F.col("p") == F.col("rp"), "left").select("p", "tag", F.upper("right").alias("right"))
    assert got.columns == ["p", "tag", "right"]
    assert got.count() == want.count() == 6004 and got.exceptAll(want).count() == 0


def plain_validity(left, right, incl):
    valid = (F.col("b") <= F.col("d")) & (F.col("e").isNull() | ((F.col("e") >= F.col("d")) if incl else (F.col("e") > F.col("d"))))
    return left.join(right, (F.col("k") == F.col("rk")) & valid, "left").select("lid", "rid")


@pytest.fixture(scope="module")
def hot(spark):
    """Rows and versions where key 0 holds a third; NULL keys, missing begins, open and inverted intervals,
    days before, inside and after the calendar."""
    left = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias("lid"),
        F.when(F.col("id") % 97 == 0, F.lit(D(1850, 3, 1))).when(F.col("id") % 89 == 0, F.lit(D(2300, 1, 1))).when(F.col("id") % 83 == 0, F.lit(None))
         .otherwise(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 200).cast("int"))).alias("d"))
    right = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 41 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("rk"), F.col("id").alias("rid"),
        F.when(F.col("id") % 61 == 0, F.lit(D(1800, 1, 1)))
         .when(F.col("id") % 31 != 0, F.date_add(F.lit(D(2023, 10, 1)), (F.col("id") % 400).cast("int"))).alias("b"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 59 == 0, F.lit(D(2400, 1, 1))).when(F.col("id") % 53 == 0, F.lit(D(2023, 1, 1)))
         .otherwise(F.date_add(F.lit(D(2023, 10, 1)), (F.col("id") % 400 + F.col("id") % 40).cast("int"))).alias("e"))
    return left, right


@pytest.mark.parametrize("incl", [True, False])
@pytest.mark.parametrize("period", [None, ("2024-01-01", ""), ("", "2300-01-01")])
def test_validity_join_by_blocks_matches_plain(hot, incl, period):  # J3, J4
    left, right = hot
    if period and period[0]:
        left = left.filter(F.col("d") >= F.lit(D(2024, 1, 1)))
    got = T.validity_join(left, right, "k", "rk", "d", "b", "e", incl, "left", period=period).select("lid", "rid")
    want = plain_validity(left, right, incl)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("days", [0, 1, 30, 31, 200])
def test_validity_join_in_a_closed_period(hot, days):
    left, right = hot
    last = D(2024, 1, 1) + dt.timedelta(days)
    left = left.filter(F.col("d").between(D(2024, 1, 1), last))
    got = T.validity_join(left, right, "k", "rk", "d", "b", "e", True, "left", period=("2024-01-01", last)).select("lid", "rid")
    want = plain_validity(left, right, True)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_versions_are_copied_twice_at_most(hot):
    right = hot[1].filter(F.col("b").isNotNull())
    for calendar in (T.Calendar(), T.Calendar(("2024-01-01", "2024-07-18")), T.Calendar(("2024-01-01", "2024-01-01"))):
        copies = calendar.covered(right, "b", "e").groupBy("rid").count()
        assert copies.agg(F.max("count")).first()[0] <= 2
        # blocks of different levels never share a number
        tops = [calendar.base(i) + ((1 << calendar.bits) - 1 >> s) for i, s in enumerate(calendar.shifts)]
        assert all(top < calendar.base(i + 1) for i, top in enumerate(tops[:-1]))


def test_a_hot_employee_is_spread_by_days(spark):  # J3, J4 with open ends
    # one employee has half of the rows and of the versions, most of them open; a task holds few of them
    left = spark.range(0, 40000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("lid"),
                                        F.date_add(F.lit(D(2015, 1, 1)), (F.col("id") % 3000).cast("int")).alias("d"))
    right = spark.range(0, 200).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("rk"), F.col("id").alias("rid"),
                                       F.date_add(F.lit(D(2015, 1, 1)), (F.col("id") * 17).cast("int")).alias("b"),
                                       F.when(F.col("id") % 8 == 0, F.date_add(F.lit(D(2015, 1, 1)), (F.col("id") * 17 + 400).cast("int"))).alias("e"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = T.validity_join(left, right, "k", "rk", "d", "b", "e", True, "left")
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("lid").alias("n")).collect()]
        want = plain_validity(left, right, True)
        assert joined.count() == want.count() and joined.select("lid", "rid").exceptAll(want).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40000 and max(sizes) < 1.5 * 40000 / len(sizes)


def test_containment_join_matches_plain(hot):  # J5, with inverted intervals on either side
    inner = hot[1].select(F.col("rk").alias("k"), F.col("rid").alias("lid"), F.col("b").alias("d"), F.col("e").alias("f"))
    outer = hot[1]
    got = T.containment_join(inner, outer, "k", "rk", "d", "f", "b", "e").select("lid", "rid")
    want = inner.join(outer, (F.col("k") == F.col("rk")) & (F.col("b") <= F.col("d")) & (F.col("e").isNull() | (F.col("e") >= F.col("f"))), "left").select("lid", "rid")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_sums_keep_four_decimals(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, Decimal("0.0049")), (1, Decimal("0.0049")), (2, None)], "k int, v decimal(18,4)")
    assert rows(A.group_sum(df, ["k"], "v", "s"), "k", "s") == [(1, Decimal("0.0098")), (2, None)]


def test_flexible_list_ignores_case_and_trailing_blanks(spark):
    df = spark.createDataFrame([("K8 ",), ("k8",), ("K9",)], "v string")
    assert df.filter(FL.flex_number("v", "k8, x")).count() == 2


def test_polymorphic_bridge_reads_its_input_once(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 10)], "ev int, who int")
    a, b = spark.createDataFrame([(10, "x"), (30, "y")], "id int, ext string"), spark.createDataFrame([(20,), (30,)], "id int")
    out = J.polymorphic_bridge(df, "who", [("place", a, "id", {"ext": a["ext"]}), ("person", b, "id", {})])
    got = sorted(map(tuple, out.select("ev", "invitee_kind", "ext").collect()), key=str)
    assert got == [(1, "place", "x"), (2, "person", None), (3, "person", None), (3, "place", "y"), (4, "place", "x")]
