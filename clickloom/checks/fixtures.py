"""Clickstream tables derived from the sample tables. Nothing else in the package knows the latter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) k",
        "cast(cast(ts as date) as string) d",
        # Whole seconds of the day, divided so that sessions of all lengths occur.
        "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
        " div (case user_id % 3 when 0 then 20 when 1 then 600 else 60 end) n",
    )


def user_visit_action(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Action log. With dates given, the raw timestamp is bounded too, which the scan can push down."""
    events = _table(spark, sf_dir, "events")
    if start is not None and end is not None:
        low = F.lit(start).cast("timestamp_ntz")
        high = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        events = events.where((F.col("ts") >= low) & (F.col("ts") < high))
    return _events(events).selectExpr(
        "d as date",
        "user_id",
        "cast(user_id as string) || '_' || replace(d, '-', '') as session_id",
        "k % 5 as page_id",
        "concat(d, ' ', lpad(cast(n div 3600 as string), 2, '0'),"
        " ':', lpad(cast(n div 60 % 60 as string), 2, '0'),"
        " ':', lpad(cast(n % 60 as string), 2, '0')) as action_time",
        "case when event_type = 'view' then 'kw' || cast(k % 10 as string) end as search_keyword",
        "case when event_type = 'click' then k end as click_category_id",
        "case when event_type = 'click' then event_id % 100 end as click_product_id",
        "case when event_type = 'purchase' then"
        " cast(k as string) || ',' || cast((k * 7 + 3) % 100 as string) end as order_category_ids",
        "case when event_type = 'purchase' then cast(event_id % 100 as string)"
        " || ',' || cast((event_id * 3) % 100 as string) end as order_product_ids",
        "case when event_type = 'signup' then cast(k as string) end as pay_category_ids",
        "case when event_type = 'signup' then cast(event_id % 100 as string) end as pay_product_ids",
        "(event_id + k) % 25 as city_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as user_id",
        "c_name as username",
        "c_name as name",
        "cast(18 + c_custkey % 43 as int) as age",
        "c_mktsegment as professional",
        "'city' || cast(c_nationkey as string) as city",
        "case when c_custkey % 2 = 0 then 'male' else 'female' end as sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        """'{"product_status": ' || cast(p_size % 2 as string) || '}' as extend_info""",
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey as bigint) as city_id", "n_name as city_name", "r_name as area"
    )


def ad_clicks_from(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Ad clicks of an events table, batch or streaming: every event is one click."""
    placed = _events(events).withColumn("city_id", F.expr("(event_id + k) % 25"))
    return placed.join(cities, "city_id").selectExpr(
        "event_id",
        "cast(ts as timestamp) as ts",
        "d as date",
        "replace(area, ' ', '-') as province",
        "city_name as city",
        "user_id",
        "k % 10 as ad_id",
    )


def ad_click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_from(_table(spark, sf_dir, "events"), city_info(spark, sf_dir))


def ad_log_lines(spark: SparkSession, sf_dir: str, name: str = "province") -> DataFrame:
    """The ad click log as text lines, whole seconds written as milliseconds.

    With ``name="area"`` the province keeps its spaces, which makes some lines unreadable.
    """
    clicks = ad_click_log(spark, sf_dir)
    if name == "area":
        clicks = clicks.withColumn("province", F.replace("province", F.lit("-"), F.lit(" ")))
    return clicks.selectExpr(
        "concat_ws(' ', concat(cast(unix_seconds(ts) as string), '000'), province, city,"
        " cast(user_id as string), cast(ad_id as string)) as value"
    )
