"""Ad click statistics. The same functions serve whole tables and single micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.joins import hot_key_join
from clickloom.operators.ranking import top_n_per_group


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not in ``blacklist``.

    No hint: the blacklist only ever grows, so its size decides. Beyond the broadcast limit it is a
    shuffle join whose click side the adaptive skew join splits.
    """
    return hot_key_join(clicks, blacklist.select("user_id"), "user_id", "left_anti")


def daily_user_ad_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def over_threshold(totals: DataFrame, threshold: int = 100) -> DataFrame:
    """Rows of (date, user, ad) totals that blacklist their user."""
    return totals.where(F.col("click_count") >= threshold)


def ad_blacklist(totals: DataFrame, threshold: int = 100) -> DataFrame:
    """Users with ``threshold`` or more clicks on one ad on one day."""
    return over_threshold(totals, threshold).select("user_id").distinct()


def clean_clicks_by_day(clicks: DataFrame, threshold: int = 100) -> DataFrame:
    """What the stream keeps when every day is one micro-batch.

    A user is dropped from the day after the first day on which one ad reaches the threshold; the clicks
    of that day stay.
    """
    crossed = (
        over_threshold(daily_user_ad_clicks(clicks), threshold)
        .groupBy("user_id")
        .agg(F.min(F.col("date").cast("date")).alias("_crossed"))
    )
    later = F.col("date").cast("date") > F.col("_crossed")
    return hot_key_join(clicks, crossed, "user_id", "left_anti", also=later)


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad)."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def ad_province_counts(stat: DataFrame) -> DataFrame:
    """Clicks per (date, province, ad), rolled up from :func:`ad_stat`."""
    return stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))


def ad_province_top(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads per date and province; ties go to the lower ad id."""
    return top_n_per_group(
        counts,
        by=["date", "province"],
        order=[F.desc("click_count"), F.asc("ad_id")],
        n=n,
        salt_on=["ad_id"],
    ).select("date", "province", "ad_id", "click_count")


def _minute_columns(counted: DataFrame, minute: str, *first: str) -> DataFrame:
    return counted.select(
        *first,
        F.col(minute).cast("date").cast("string").alias("date"),
        F.date_format(minute, "HH").alias("hour"),
        F.date_format(minute, "mm").alias("minute"),
        "ad_id",
        "click_count",
    )


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, hour, minute, ad) of the event time; the text is made after counting."""
    counted = clicks.groupBy(F.date_trunc("minute", "ts").alias("_minute"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )
    return _minute_columns(counted, "_minute")


def last_hour(trend: DataFrame, now: str) -> DataFrame:
    """Trend rows of the 60 minutes before the time text ``now``.

    The condition on the date is implied by the others; it prunes the partitions of a stored trend.
    """
    minute = F.concat_ws(" ", "date", F.concat_ws(":", "hour", "minute", F.lit("00"))).cast("timestamp")
    end = F.lit(now).cast("timestamp")
    start = end - F.expr("interval 60 minutes")
    days = F.col("date").between(start.cast("date").cast("string"), end.cast("date").cast("string"))
    return trend.where(days & (minute > start) & (minute <= end))


def ad_click_panes(clicks: DataFrame, arrival: str, pane: str = "10 seconds") -> DataFrame:
    """Clicks per arrival pane, event minute and ad: (pane, minute, ad_id, click_count)."""
    return (
        clicks.groupBy(F.window(arrival, pane).alias("_pane"), F.date_trunc("minute", "ts").alias("minute"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(F.col("_pane.start").alias("pane"), "minute", "ad_id", "click_count")
    )


def sliding_trend(panes: DataFrame, pane_seconds: int = 10, window_seconds: int = 3600) -> DataFrame:
    """What a window over the last ``window_seconds`` of arrivals shows, for every slide at which it changes.

    (slide_end, date, hour, minute, ad_id, click_count): from ``slide_end`` on, until the next row of the same minute and ad, the
    window holds so many clicks; 0 when the last one has left. A pane is added at its end and taken back one window later,
    so a click costs two rows, however many windows overlap on it.
    """
    moves = F.explode(
        F.array(
            F.struct(F.lit(pane_seconds).alias("after"), F.col("click_count").alias("change")),
            F.struct(F.lit(pane_seconds + window_seconds).alias("after"), (-F.col("click_count")).alias("change")),
        )
    )
    seconds = (F.unix_seconds("pane") + F.col("move.after")).alias("slide")
    changes = (
        panes.select("pane", "minute", "ad_id", "click_count", moves.alias("move"))
        .groupBy(seconds, "minute", "ad_id")
        .agg(F.sum("move.change").alias("change"))
    )
    so_far = Window.partitionBy("minute", "ad_id").orderBy("slide")
    counted = changes.withColumn("click_count", F.sum("change").over(so_far))
    return _minute_columns(counted.withColumn("slide_end", F.timestamp_seconds("slide")), "minute", "slide_end")


def window_at(panes: DataFrame, slide_end: str, pane_seconds: int = 10, window_seconds: int = 3600) -> DataFrame:
    """(date, hour, minute, ad_id, click_count) of the window that ends at the time text ``slide_end``."""
    end = F.lit(slide_end).cast("timestamp")
    inside = (F.col("pane") >= end - F.make_interval(secs=F.lit(window_seconds))) & (
        F.col("pane") <= end - F.make_interval(secs=F.lit(pane_seconds))
    )
    counted = panes.where(inside).groupBy("minute", "ad_id").agg(F.sum("click_count").alias("click_count"))
    return _minute_columns(counted, "minute")
