from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import categories
from tests.rows import action, actions


def by_id(df, *columns):
    return {row.category_id: tuple(row[c] for c in columns) for row in df.collect()}


def test_lists_skip_unreadable_entries(spark):
    texts = ["", "1", "1,2", "1,,2", "x,3", None]
    log = actions(spark, [action(second=i, order_category_ids=t) for i, t in enumerate(texts)])
    assert by_id(categories.category_orders(log), "order_count") == {1: (3,), 2: (2,), 3: (1,)}
    assert sorted(r[0] for r in categories.visited_categories(log).collect()) == [1, 2, 3]


def three_join_counts(detail):
    """The same counts as a chain of outer joins."""
    return (
        categories.visited_categories(detail)
        .join(categories.category_clicks(detail), "category_id", "left")
        .join(categories.category_orders(detail), "category_id", "left")
        .join(categories.category_pays(detail), "category_id", "left")
        .na.fill(0)
    )


def test_one_pass_counts_equal_the_join_chain(spark):
    log = actions(
        spark,
        [
            action(second=0, click_category_id=1),
            action(second=1, click_category_id=1),
            action(second=2, order_category_ids="1,2", pay_category_ids="3"),
            action(second=3, pay_category_ids="3,3"),
            action(second=4),
        ],
    )
    names = ("click_count", "order_count", "pay_count")
    got = by_id(categories.category_counts(log), *names)
    assert got == by_id(three_join_counts(log), *names)
    assert got == {1: (2, 1, 0), 2: (0, 1, 0), 3: (0, 0, 3)}


def test_top_categories_is_a_prefix_of_the_whole_order(spark):
    rows = [(i, i % 3, i % 2, 0) for i in range(20)]
    counts = spark.createDataFrame(
        rows, "category_id bigint, click_count bigint, order_count bigint, pay_count bigint"
    )
    whole = sorted(rows, key=lambda r: (-r[1], -r[2], -r[3], r[0]))
    assert [tuple(r) for r in categories.top_categories(counts, 7).collect()] == whole[:7]
    assert categories.top_categories(counts, 50).count() == 20


def test_top_sessions_and_their_detail(spark):
    log = actions(
        spark,
        [action("a", i, click_category_id=1) for i in range(3)]
        + [action("a", 10 + i, click_category_id=2) for i in range(3)]
        + [action("b", i, click_category_id=1) for i in range(3)]
        + [action("c", i, click_category_id=1) for i in range(2)]
        + [action("d", 0)],
    )
    counts = categories.session_category_clicks(log)
    top = categories.top_sessions(counts, 2)
    assert sorted(tuple(r) for r in top.collect()) == [(1, "a", 3), (1, "b", 3), (2, "a", 3)]
    once = categories.top_session_detail(top, log)
    assert once.groupBy("session_id").count().orderBy("session_id").collect() == [("a", 6), ("b", 3)]
    twice = categories.top_session_detail(top, log, dedupe=False)
    assert twice.where(F.col("session_id") == "a").count() == 12


def test_large_n_uses_the_salted_cut(spark):
    counts = spark.range(5000).selectExpr(
        "1L as category_id", "cast(id as string) as session_id", "id % 50 as click_count"
    )
    rows = sorted(((-(i % 50), str(i)) for i in range(5000)))[:1500]
    got = categories.top_sessions(counts, 1500).collect()
    assert sorted((-r.click_count, r.session_id) for r in got) == rows


def test_counts_of_given_sessions(spark):
    log = actions(spark, [action("a", 0, click_category_id=1), action("b", 0, click_category_id=1)])
    kept = spark.createDataFrame([("b",)], "session_id string")
    counts = categories.within_sessions(categories.session_category_clicks(log), kept)
    assert [r.session_id for r in counts.collect()] == ["b"]
