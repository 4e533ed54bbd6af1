"""Session-level aggregates, statistics and detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import format_time, is_not_empty, parse_time, ratio
from clickloom.operators.filters import any_of
from clickloom.operators.joins import hot_key_join
from clickloom.params import TaskParams

# Histogram buckets as (name, lowest value, first value above the bucket).
VISIT_LENGTH_BUCKETS = (
    ("1s_3s", 1, 4),
    ("4s_6s", 4, 7),
    ("7s_9s", 7, 10),
    ("10s_30s", 10, 30),
    ("30s_60s", 30, 60),
    ("1m_3m", 60, 180),
    ("3m_10m", 180, 600),
    ("10m_30m", 600, 1800),
    ("30m", 1800, None),
)
STEP_LENGTH_BUCKETS = (
    ("1_3", 1, 4),
    ("4_6", 4, 7),
    ("7_9", 7, 10),
    ("10_30", 10, 30),
    ("30_60", 30, 60),
    ("60", 60, None),
)

# Columns of a stored detail row, after the task id.
DETAIL_COLUMNS = (
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
)


def _per_session(actions: DataFrame, *more: Column) -> DataFrame:
    """One row per session: user, times, length and steps, and the aggregates in ``more``.

    Times are aggregated as timestamps, not text, which keeps the hash aggregate usable.
    """
    start, end = F.min("_time"), F.max("_time")
    return (
        actions.withColumn("_time", parse_time(F.col("action_time")))
        .groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            *more,
            start.alias("start_time"),
            end.alias("end_time"),
            (F.unix_seconds(end) - F.unix_seconds(start)).alias("visit_length"),
            F.count(F.lit(1)).alias("step_length"),
        )
    )


def session_aggregate(actions: DataFrame) -> DataFrame:
    """One row per session: user, searched keywords, clicked categories, times, length, steps.

    When a consumer does not read the two lists, Catalyst removes them and only numbers are shuffled. To
    filter by keyword or category, :func:`session_matches` needs no lists at all.
    """
    keyword = F.when(is_not_empty(F.col("search_keyword")), F.col("search_keyword"))
    category = F.col("click_category_id").cast("string")
    return _per_session(
        actions,
        F.sort_array(F.collect_set(keyword)).alias("search_keywords"),
        F.sort_array(F.collect_set(category)).alias("click_category_ids"),
    )


def session_matches(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions with a searched keyword and a clicked category among those of ``params``, without lists.

    The same sessions as filtering :func:`session_aggregate` by the two parameters. A session carries two
    flags through the shuffle, however many keywords it has.
    """
    keyword = any_of(F.col("search_keyword"), params.keywords)
    category = any_of(F.col("click_category_id").cast("string"), params.category_ids)
    flagged = _per_session(
        actions,
        F.bool_or(keyword).alias("_keyword"),
        F.bool_or(category).alias("_category"),
    )
    return flagged.where(F.col("_keyword") & F.col("_category")).drop("_keyword", "_category")


def session_with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's age, professional, city and sex; sessions of unknown users drop out.

    No join hint: the user table grows with the business, so its runtime size decides, and a user
    with very many sessions is split by the adaptive skew join.
    """
    columns = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(columns, "user_id")


def session_text(sessions: DataFrame) -> DataFrame:
    """Lists and times of session rows as the text that result tables store."""
    return sessions.withColumns(
        {
            "search_keywords": F.array_join("search_keywords", ","),
            "click_category_ids": F.array_join("click_category_ids", ","),
            "start_time": format_time(F.col("start_time")),
            "end_time": format_time(F.col("end_time")),
        }
    )


def session_detail(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Actions of the given sessions."""
    return hot_key_join(actions, sessions.select("session_id"), "session_id", "left_semi")


def session_detail_columns(actions: DataFrame, task_id: int) -> DataFrame:
    """Stored form of detail rows."""
    return actions.select(F.lit(task_id).cast("bigint").alias("taskid"), *DETAIL_COLUMNS)


def _inside(col: Column, low: int, high: int | None) -> Column:
    return (col >= low) if high is None else ((col >= low) & (col < high))


def _bucket(col: Column, buckets: tuple) -> Column:
    chain = None
    for name, low, high in buckets:
        test = _inside(col, low, high)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def _histogram(sessions: DataFrame, column: str, buckets: tuple) -> DataFrame:
    return (
        sessions.select(_bucket(F.col(column), buckets).alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def visit_length_buckets(sessions: DataFrame) -> DataFrame:
    """Sessions per duration bucket; sessions of 0 seconds are in none."""
    return _histogram(sessions, "visit_length", VISIT_LENGTH_BUCKETS)


def step_length_buckets(sessions: DataFrame) -> DataFrame:
    """Sessions per step-count bucket."""
    return _histogram(sessions, "step_length", STEP_LENGTH_BUCKETS)


def session_aggr_stat(sessions: DataFrame, task_id: int) -> DataFrame:
    """One row: session count and the share of every duration and step bucket."""
    sources = [
        ("visit_length", VISIT_LENGTH_BUCKETS),
        ("step_length", STEP_LENGTH_BUCKETS),
    ]
    named = [
        (f"{column}_{name}_ratio", _inside(F.col(column), low, high))
        for column, buckets in sources
        for name, low, high in buckets
    ]
    counted = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.count_if(test).alias(name) for name, test in named],
    )
    return counted.select(
        F.lit(task_id).cast("bigint").alias("taskid"),
        "session_count",
        *[ratio(F.col(name), F.col("session_count")).alias(name) for name, _ in named],
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions per date and hour of their start."""
    hour = F.date_trunc("hour", "start_time")
    return (
        sessions.groupBy(hour.alias("_hour"))
        .agg(F.count(F.lit(1)).alias("session_count"))
        .select(
            F.col("_hour").cast("date").cast("string").alias("date"),
            F.date_format("_hour", "HH").alias("hour"),
            "session_count",
        )
    )
