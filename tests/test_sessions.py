from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import filters, sessions
from clickloom.params import TaskParams
from tests.rows import action, actions

LENGTHS = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
STEPS = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60]


def one_session(spark, rows):
    return sessions.session_aggregate(actions(spark, rows)).first()


def test_aggregate(spark):
    got = one_session(
        spark,
        [
            action(second=40, click_category_id=11, search_keyword="kw"),
            action(second=0, click_category_id=1),
            action(second=10, click_category_id=11, search_keyword=""),
            action(second=20, search_keyword="k"),
        ],
    )
    assert got.search_keywords == ["k", "kw"]
    assert got.click_category_ids == ["1", "11"]
    assert got.start_time == datetime(2024, 3, 1, 10, 0, 0)
    assert (got.visit_length, got.step_length, got.user_id) == (40, 4, 1)


def test_user_of_a_session_is_the_lowest_id(spark):
    assert one_session(spark, [action(user=9), action(user=2, second=1)]).user_id == 2


def test_unreadable_time_is_counted_but_not_timed(spark):
    got = one_session(
        spark, [action(action_time="bad"), action(second=0), action(second=5)]
    )
    assert (got.visit_length, got.step_length) == (5, 3)


def test_unknown_user_drops_out(spark):
    agg = sessions.session_aggregate(actions(spark, [action("a", user=1), action("b", user=2)]))
    users = spark.createDataFrame(
        [(1, "u", "u", 30, "p", "c", "male")],
        "user_id bigint, username string, name string, age int, professional string, city string, sex string",
    )
    assert [row.session_id for row in sessions.session_with_user(agg, users).collect()] == ["a"]


def test_visit_length_buckets(spark):
    rows = []
    for length in LENGTHS:
        rows += [action(f"s{length}", 0), action(f"s{length}", length)]
    agg = sessions.session_aggregate(actions(spark, rows))
    got = {r.bucket: r.session_count for r in sessions.visit_length_buckets(agg).collect()}
    assert got == {
        "1s_3s": 2,
        "4s_6s": 2,
        "7s_9s": 2,
        "10s_30s": 2,
        "30s_60s": 2,
        "1m_3m": 2,
        "3m_10m": 2,
        "10m_30m": 2,
        "30m": 1,
    }
    stat = sessions.session_aggr_stat(agg, 5).first()
    # The session of 0 seconds is counted and is in no bucket.
    assert (stat.taskid, stat.session_count) == (5, len(LENGTHS))
    assert stat.visit_length_30m_ratio == 0.06
    assert stat.visit_length_1s_3s_ratio == 0.11
    assert stat.step_length_1_3_ratio == 1.0


def test_step_length_buckets(spark):
    rows = [action(f"s{n}", i) for n in STEPS for i in range(n)]
    agg = sessions.session_aggregate(actions(spark, rows))
    got = {r.bucket: r.session_count for r in sessions.step_length_buckets(agg).collect()}
    assert got == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 1}


def test_statistics_of_nothing(spark):
    agg = sessions.session_aggregate(actions(spark, []))
    row = sessions.session_aggr_stat(agg, 1).first()
    assert row.session_count == 0
    assert row.visit_length_30m_ratio is None


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            ("a", 19, "doctor", "city1", "male", ["kw1", "kw2"], ["3"]),
            ("b", 20, "teacher", "city2", "female", [], ["3", "7"]),
            ("c", 30, "doctor", "city11", "male", ["kw11"], []),
            ("d", None, "doctor", "city1", "male", ["kw1"], ["33"]),
        ],
        "session_id string, age int, professional string, city string, sex string,"
        " search_keywords array<string>, click_category_ids array<string>",
    )


@pytest.mark.parametrize(
    ("given", "kept"),
    [
        ({}, "abcd"),
        ({"start_age": 20}, "abcd"),
        ({"end_age": 20}, "abcd"),
        ({"start_age": 20, "end_age": 30}, "bc"),
        ({"professionals": "doctor,nurse"}, "acd"),
        ({"professionals": ""}, "abcd"),
        ({"professionals": ","}, ""),
        ({"cities": "city1"}, "ad"),
        ({"sex": "female"}, "b"),
        ({"keywords": "kw1"}, "ad"),
        ({"keywords": "kw1,kw11"}, "acd"),
        ({"keywords": ","}, ""),
        ({"category_ids": "3"}, "ab"),
        ({"category_ids": "3", "sex": "male", "keywords": "kw2"}, "a"),
    ],
)
def test_filters(people, given, kept):
    params = TaskParams("2024-01-01", "2024-01-02", **given)
    got = filters.filter_sessions(people, params).collect()
    assert sorted(row.session_id for row in got) == sorted(kept)


@pytest.mark.parametrize(
    "given",
    [{}, {"keywords": "kw1"}, {"category_ids": "3,4"}, {"keywords": "kw1", "category_ids": "3"},
     {"keywords": ","}],
)
def test_flags_keep_the_sessions_the_lists_keep(spark, given):
    log = actions(
        spark,
        [
            action("a", 0, search_keyword="kw1"),
            action("a", 1, click_category_id=3),
            action("b", 0, search_keyword="kw11", click_category_id=3),
            action("c", 0, search_keyword="kw1", click_category_id=33),
            action("d", 0, search_keyword=""),
        ],
    )
    params = TaskParams("2024-01-01", "2024-01-02", **given)
    lists = sessions.session_aggregate(log).where(
        filters.any_of_list(F.col("search_keywords"), params.keywords)
        & filters.any_of_list(F.col("click_category_ids"), params.category_ids)
    )
    flags = sessions.session_matches(log, params)
    assert "collect_set" not in flags._jdf.queryExecution().executedPlan().toString()
    assert sorted(flags.collect()) == sorted(lists.select(flags.columns).collect())


def test_equal_param(people):
    assert people.where(filters.equal_param(F.col("sex"), "male")).count() == 3
    assert people.where(filters.equal_param(F.col("sex"), None)).count() == 4


def test_detail_keeps_nulls_and_column_order(spark):
    log = actions(spark, [action("a"), action("a", 1, click_category_id=3), action("b")])
    agg = sessions.session_aggregate(log).where("session_id = 'a'")
    detail = sessions.session_detail_columns(sessions.session_detail(agg, log), 4)
    assert detail.columns == ["taskid", *sessions.DETAIL_COLUMNS]
    got = detail.orderBy("action_time").collect()
    assert [(r.taskid, r.session_id, r.click_category_id) for r in got] == [
        (4, "a", None),
        (4, "a", 3),
    ]
