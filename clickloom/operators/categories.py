"""Category popularity and the sessions behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_n_per_group

# Above this many categories the id list is joined without a broadcast hint.
_BROADCAST_ROWS = 100_000


def _id(text: Column) -> Column:
    return text.try_cast("bigint")


def _listed(detail: DataFrame, column: str) -> DataFrame:
    """Ids of a comma list, one row each; unreadable entries are left out."""
    return (
        detail.where(F.col(column).isNotNull())
        .select(F.explode(F.split(column, ",")).alias("id"))
        .select(_id(F.col("id")).alias("category_id"))
        .where(F.col("category_id").isNotNull())
    )


def _uses(detail: DataFrame) -> DataFrame:
    """(kind, category_id), one row per click, order and pay of a category, in one pass over the input."""
    return (
        detail.select(
            F.stack(
                F.lit(3),
                F.lit("click"),
                F.col("click_category_id").cast("string"),
                F.lit("order"),
                F.col("order_category_ids"),
                F.lit("pay"),
                F.col("pay_category_ids"),
            ).alias("kind", "ids")
        )
        .where(F.col("ids").isNotNull())
        .select("kind", F.explode(F.split("ids", ",")).alias("id"))
        .select("kind", _id(F.col("id")).alias("category_id"))
        .where(F.col("category_id").isNotNull())
    )


def visited_categories(detail: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid."""
    return _uses(detail).select("category_id").distinct()


def category_clicks(detail: DataFrame) -> DataFrame:
    return (
        detail.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def category_orders(detail: DataFrame) -> DataFrame:
    return (
        _listed(detail, "order_category_ids")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def category_pays(detail: DataFrame) -> DataFrame:
    return (
        _listed(detail, "pay_category_ids")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("pay_count"))
    )


def category_counts(detail: DataFrame) -> DataFrame:
    """Click, order and pay count of every visited category: one scan and one shuffle of partial sums."""
    kind = F.col("kind")
    return (
        _uses(detail)
        .groupBy("category_id")
        .agg(
            F.count_if(kind == "click").alias("click_count"),
            F.count_if(kind == "order").alias("order_count"),
            F.count_if(kind == "pay").alias("pay_count"),
        )
    )


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then pays, then lowest id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(n)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Rows with a clicked category, per (session, category)."""
    return (
        actions.where(F.col("click_category_id").isNotNull())
        .groupBy("session_id", F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def within_sessions(counts: DataFrame, sessions: DataFrame) -> DataFrame:
    """Keep the counts of the given sessions.

    An inner join on the unique session id, on purpose: Catalyst would move a semi-join below the
    aggregate, where a session holding a large part of the log would be joined row by row.
    """
    return counts.join(sessions.select("session_id"), "session_id")


def category_sessions(top: DataFrame, counts: DataFrame, n: int = 10) -> DataFrame:
    """Session counts of the ``n`` categories in ``top``."""
    ids = top.select("category_id")
    # `top` comes from top_categories and has at most n rows.
    return counts.join(F.broadcast(ids) if n <= _BROADCAST_ROWS else ids, "category_id")


def top_category_actions(top: DataFrame, actions: DataFrame, n: int = 10) -> DataFrame:
    """Clicks on the ``n`` categories in ``top``; applied before counting per session, it cuts the shuffle."""
    ids = top.select(F.col("category_id").alias("click_category_id"))
    return actions.join(
        F.broadcast(ids) if n <= _BROADCAST_ROWS else ids, "click_category_id", "left_semi"
    )


def top_sessions(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sessions with most clicks of every category; ties go to the lower session id."""
    return top_n_per_group(
        counts,
        by=["category_id"],
        order=[F.desc("click_count"), F.asc("session_id")],
        n=n,
        salt_on=["session_id"],
    ).select("category_id", "session_id", "click_count")


def top_session_detail(
    top: DataFrame, actions: DataFrame, most: int = 100, dedupe: bool = True
) -> DataFrame:
    """Actions of the top sessions.

    A session leading several categories is listed once, or once per category with ``dedupe=False``.
    ``most`` is the largest number of rows ``top`` can have (categories times sessions each).
    """
    ids = top.select("session_id")
    hinted = F.broadcast(ids) if most <= _BROADCAST_ROWS else ids
    return actions.join(hinted, "session_id", "left_semi" if dedupe else "inner")
