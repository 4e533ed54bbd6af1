from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom import functions as fn


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [tuple(row) for row in df.select(*columns).collect()]


def test_ratio_is_half_up_on_integers(spark):
    rows = [(3, 40), (1, 8), (1, 3), (0, 5), (7, 0), (2, 3), (5, 5), (3, 2)]
    got = values(spark, "n bigint, m bigint", rows, fn.ratio(F.col("n"), F.col("m")))
    assert [row[0] for row in got] == [0.08, 0.13, 0.33, 0.0, None, 0.67, 1.0, 1.5]


def test_ratio_scale(spark):
    got = values(spark, "n bigint, m bigint", [(1, 3)], fn.ratio(F.col("n"), F.col("m"), 4))
    assert got == [(0.3333,)]


def test_concat_long_string_writes_null_as_text(spark):
    rows = [(1, "a"), (None, "a"), (1, None)]
    got = values(
        spark, "n bigint, t string", rows, fn.concat_long_string(F.col("n"), F.col("t"), ":")
    )
    assert [row[0] for row in got] == ["1:a", "null:a", "1:null"]


def test_json_field(spark):
    rows = [('{"product_status": 0}',), ('{"product_status": 1}',), ("{}",), (None,)]
    got = values(spark, "j string", rows, fn.json_field(F.col("j"), "product_status"))
    assert [row[0] for row in got] == ["0", "1", None, None]


def test_parse_time_takes_one_digit_hours(spark):
    rows = [("2018-08-21 5:02:33",), ("2018-08-21 15:02:33",), ("noon",), (None,)]
    got = values(spark, "t string", rows, fn.parse_time(F.col("t")))
    assert [row[0] for row in got] == [
        datetime(2018, 8, 21, 5, 2, 33),
        datetime(2018, 8, 21, 15, 2, 33),
        None,
        None,
    ]


def test_parse_date_key(spark):
    got = values(spark, "t string", [("20180821",), ("2018",)], fn.parse_date_key(F.col("t")))
    assert [row[0] for row in got] == [date(2018, 8, 21), None]


def test_time_comparisons(spark):
    early, late, bad = "2018-08-21 5:02:33", "2018-08-21 05:03:00", "bad"
    rows = [(early, late), (late, early), (early, early), (bad, late)]
    a, b = F.col("a"), F.col("b")
    got = values(
        spark, "a string, b string", rows, fn.before(a, b), fn.after(a, b), fn.minus_seconds(a, b)
    )
    assert got == [
        (True, False, -27),
        (False, True, 27),
        (False, False, 0),
        (False, False, 0),
    ]


def test_formats(spark):
    ts = F.lit("2018-08-21 05:02:33").cast("timestamp")
    row = (
        spark.range(1)
        .select(
            fn.format_date(ts),
            fn.format_time(ts),
            fn.format_date_key(ts),
            fn.format_time_minute(ts),
            fn.date_hour(ts),
        )
        .first()
    )
    assert tuple(row) == (
        "2018-08-21",
        "2018-08-21 05:02:33",
        "20180821",
        "201808210502",
        "2018-08-21_05",
    )


def test_today_follows_yesterday(spark):
    row = spark.range(1).select(fn.today().alias("t"), fn.yesterday().alias("y")).first()
    assert (date.fromisoformat(row.t) - date.fromisoformat(row.y)).days == 1


@pytest.mark.parametrize(
    ("text", "trimmed"), [(",a,b,", "a,b"), ("a", "a"), (",", ""), (",,a,,", ",a,"), ("", "")]
)
def test_trim_comma(spark, text, trimmed):
    assert values(spark, "t string", [(text,)], fn.trim_comma(F.col("t"))) == [(trimmed,)]


def test_pad2_and_empty(spark):
    rows = [("5",), ("12",), ("",), (None,)]
    t = F.col("t")
    got = values(spark, "t string", rows, fn.pad2(t), fn.is_empty(t), fn.is_not_empty(t))
    assert got[:3] == [("05", False, True), ("12", False, True), ("0", True, False)]
    assert got[3][1:] == (True, False)


def test_group_concat_distinct_compares_whole_values(spark):
    # "1:x" is part of "11:x" but still a value of its own.
    rows = [("11:x",), ("1:x",), ("11:x",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    assert df.agg(fn.group_concat_distinct(F.col("c"))).first()[0] == "11:x,1:x"


def test_sql_functions(spark):
    fn.register_functions(spark)
    row = spark.sql(
        "SELECT concat_long_string(7, 'x', ':'), concat_long_string(null, null, '-'),"
        """ json_field('{"product_status": 0}', 'product_status'),"""
        " (SELECT listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x) FROM VALUES ('b'), ('a'), ('b') t(x))"
    ).first()
    assert tuple(row) == ("7:x", "null-null", "0", "a,b")


def test_parse_time_refuses_what_is_no_date_and_time(spark):
    rows = [("5:02:33",), ("T07:00",), ("2018",), ("2018-08",), ("2018-08-21",), ("",), (None,)]
    assert values(spark, "t string", rows, fn.parse_time(F.col("t"))) == [(None,)] * 7


def test_parse_time_ignores_what_follows(spark):
    rows = [("2018-08-21 05:02:33",), ("2018-08-21 05:02:33+08:00",), ("2018-08-21 5:02:33.7",)]
    got = values(spark, "t string", rows, fn.format_time(fn.parse_time(F.col("t"))))
    assert got == [("2018-08-21 05:02:33",)] * 3


def test_json_field_takes_the_name_as_it_is(spark):
    rows = [('{"a.b": 1, "a": {"b": 2}}',)]
    assert values(spark, "j string", rows, fn.json_field(F.col("j"), "a.b")) == [("1",)]


def test_ad_log_rejects_times_no_date_can_show(spark):
    from clickloom.sources import adlog

    lines = spark.createDataFrame(
        [("9223372036854775807 p c 1 2",), ("253402300800000 p c 1 2",), ("1700000000000 p c 1 2",)], "value string"
    )
    assert [r.date for r in adlog.parse_ad_log(lines).collect()] == ["2023-11-14"]
    assert tuple(adlog.ad_log_rejects(lines).first()) == (2, 3)
