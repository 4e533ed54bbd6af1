"""Reproducible sample of sessions, proportional to the hours they start in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import format_time
from clickloom.operators.ranking import top_n_per_group
from clickloom.operators.sessions import sessions_per_hour

# Above this the picked ids are joined without a broadcast hint.
_BROADCAST_ROWS = 100_000


def sample_plan(sessions: DataFrame, total: int = 100) -> DataFrame:
    """Number of sessions to take per (date, hour).

    Every date gets ``total`` divided by the number of dates, every hour its share of that, both rounded
    down. The windows run on one row per hour of the date range, whatever the number of sessions.
    """
    day = Window.partitionBy("date")
    first_of_day = F.row_number().over(day.orderBy("hour")) == 1
    everything = Window.partitionBy()
    share = F.col("session_count").cast("double") / F.col("_day_count").cast("double")
    return (
        sessions_per_hour(sessions)
        .withColumns(
            {
                "_day_count": F.sum("session_count").over(day),
                "_first": first_of_day.cast("bigint"),
            }
        )
        .withColumn("_days", F.sum("_first").over(everything))
        .withColumn("_per_day", F.call_function("div", F.lit(total), F.col("_days")))
        .select(
            "date",
            "hour",
            "session_count",
            F.least(
                F.floor(share * F.col("_per_day")).cast("bigint"), F.col("session_count")
            ).alias("sample_size"),
        )
    )


def sampled_ids(sessions: DataFrame, plan: DataFrame, seed: str, total: int = 100) -> DataFrame:
    """Ids of the sampled sessions, at most ``total`` rows.

    No hour takes more than ``total``, so each hour is cut to its ``total`` first sessions before the
    planned number is looked up: an hour that holds most sessions is pruned inside every task.
    """
    start = F.col("start_time")
    keyed = sessions.select(
        "session_id",
        start.cast("date").cast("string").alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.col("session_id")).cast("binary")).alias("_key"),
    )
    candidates = top_n_per_group(
        keyed,
        by=["date", "hour"],
        order=[F.col("_key"), F.col("session_id")],
        n=total,
        salt_on=["session_id"],
    )
    return (
        candidates.join(plan.select("date", "hour", "sample_size"), ["date", "hour"])
        .where(F.col("rank") <= F.col("sample_size"))
        .select("session_id")
    )


def keep_ids(df: DataFrame, ids: DataFrame, total: int) -> DataFrame:
    """Rows of ``df`` whose session is among the at most ``total`` ids."""
    # The sample has at most `total` rows by construction, which is the proof the hint needs.
    small = F.broadcast(ids) if total <= _BROADCAST_ROWS else ids
    return df.join(small, "session_id", "left_semi")


def sample_sessions(sessions: DataFrame, plan: DataFrame, seed: str, total: int = 100) -> DataFrame:
    """The sampled rows of ``sessions``.

    The pick reads ids and start times only. The rows are fetched with a semi-join that Catalyst moves
    below a session aggregate, so keyword and category lists are built for sampled sessions only.
    """
    return keep_ids(sessions, sampled_ids(sessions, plan, seed, total), total)


def random_extract_columns(sampled: DataFrame, task_id: int) -> DataFrame:
    """Stored form of sampled sessions."""
    return sampled.select(
        F.lit(task_id).cast("bigint").alias("taskid"),
        "session_id",
        format_time(F.col("start_time")).alias("start_time"),
        F.array_join("search_keywords", ",").alias("search_keywords"),
        F.array_join("click_category_ids", ",").alias("click_category_ids"),
    )


def sample_detail(
    sessions: DataFrame, plan: DataFrame, actions: DataFrame, seed: str, total: int = 100
) -> DataFrame:
    """Actions of the sampled sessions: one filtered scan, the action log is not shuffled."""
    ids = sampled_ids(sessions, plan, seed, total)
    return keep_ids(actions, ids, total)
