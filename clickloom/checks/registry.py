"""Registered queries: every operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import functions as fn
from clickloom.checks import fixtures as fx
from clickloom.operators import ads, categories, filters, funnel, products, sampling, sessions
from clickloom.params import TaskParams
from clickloom.plans import FunnelAnalysis, ProductAnalysis, SessionAnalysis
from clickloom.sinks import TaskRun, append, read_results, replace_partitions, upsert
from clickloom.sources import actions_by_date, ad_log_rejects, ad_stream, click_actions, parse_ad_log
from clickloom.streaming import (
    AdClickStream,
    ad_stat_stream,
    ad_trend_panes_stream,
    ad_trend_stream,
    batch_counts,
    start_ad_stream,
    start_upsert,
)
from clickloom.streaming.workdir import work_dir

Query = Callable[[SparkSession, str], DataFrame]

TASK = 1
SEED = "7"
TOTAL = 100
THRESHOLD = 3
# Most files of a stream's batch.
BATCH_FILES = 1000
FLOW = (0, 1, 2, 3)
# Covers every row of the sample tables.
WHOLE = ("2000-01-01", "2099-12-31")
RANGE = ("2024-01-08", "2024-01-21")
LEVELS = {"ASIA": "A level", "EUROPE": "A level", "AMERICA": "B level", "AFRICA": "C level"}
PARAMS = TaskParams(*WHOLE, start_age=20, end_age=50, sex="male", page_flow=FLOW)
EVERY_FILTER = TaskParams(
    *WHOLE,
    start_age=20,
    end_age=55,
    professionals="BUILDING,MACHINERY,AUTOMOBILE",
    cities="city1,city4,city7,city9,city12,city20",
    sex="male",
    keywords="kw1,kw4,kw6,kw8",
    category_ids=",".join(str(i) for i in range(0, 100, 3)),
)

QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = fx.user_visit_action(spark, sf_dir)
    return sessions.session_with_user(sessions.session_aggregate(actions), fx.user_info(spark, sf_dir))


def _picked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_sessions(_sessions(spark, sf_dir), PARAMS)


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_detail(_picked(spark, sf_dir), fx.user_visit_action(spark, sf_dir))


def _analysis(
    spark: SparkSession, sf_dir: str, params: TaskParams = PARAMS
) -> SessionAnalysis:
    return SessionAnalysis(
        fx.user_visit_action(spark, sf_dir),
        fx.user_info(spark, sf_dir),
        params,
        TASK,
        sample_total=TOTAL,
        seed=SEED,
    )


# --- sources ------------------------------------------------------------------


@_query("actions_by_date")
def _actions_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_by_date(fx.user_visit_action(spark, sf_dir, *RANGE), *RANGE)


@_query("click_actions")
def _click_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_actions(fx.user_visit_action(spark, sf_dir, *RANGE), *RANGE)


@_query("parse_ad_log")
def _parse_ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_ad_log(fx.ad_log_lines(spark, sf_dir))
    return parsed.select(
        fn.format_time(F.col("ts")).alias("time"), "date", "province", "city", "user_id", "ad_id"
    )


@_query("ad_log_rejects")
def _ad_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_log_rejects(fx.ad_log_lines(spark, sf_dir, "area"))


# --- sessions -----------------------------------------------------------------


@_query("session_aggregate")
def _session_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_text(sessions.session_aggregate(fx.user_visit_action(spark, sf_dir)))


@_query("session_with_user")
def _session_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_text(_sessions(spark, sf_dir))


@_query("session_filter_age")
def _session_filter_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _sessions(spark, sf_dir).where(filters.between_param(F.col("age"), 25, 40))
    return sessions.session_text(kept)


@_query("session_filter_demo")
def _session_filter_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _sessions(spark, sf_dir).where(
        filters.any_of(F.col("professional"), "BUILDING,MACHINERY")
        & filters.any_of(F.col("city"), "city1,city4,city7,city9,city12,city20")
        & filters.any_of(F.col("sex"), "female")
    )
    return sessions.session_text(kept)


@_query("session_filter_lists")
def _session_filter_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _sessions(spark, sf_dir).where(
        filters.any_of_list(F.col("search_keywords"), "kw1,kw4")
        & filters.any_of_list(F.col("click_category_ids"), "3,17,42,58,96")
    )
    return sessions.session_text(kept)


@_query("session_filter_equal")
def _session_filter_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _sessions(spark, sf_dir).where(
        filters.equal_param(F.col("sex"), "male") & filters.equal_param(F.col("city"), None)
    )
    return sessions.session_text(kept)


@_query("filtered_sessions")
def _filtered_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_text(filters.filter_sessions(_sessions(spark, sf_dir), EVERY_FILTER))


@_query("session_detail")
def _session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).detail()


@_query("filtered_session_detail")
def _filtered_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir, EVERY_FILTER).detail()


@_query("visit_length_buckets")
def _visit_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.visit_length_buckets(_picked(spark, sf_dir))


@_query("step_length_buckets")
def _step_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.step_length_buckets(_picked(spark, sf_dir))


@_query("session_aggr_stat")
def _session_aggr_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).aggr_stat()


# --- sampling -----------------------------------------------------------------


@_query("sessions_per_hour")
def _sessions_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions_per_hour(_picked(spark, sf_dir))


@_query("sample_plan")
def _sample_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_plan(_picked(spark, sf_dir), TOTAL)


@_query("session_random_extract")
def _session_random_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).random_extract()


@_query("sample_detail")
def _sample_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).sample_detail()


# --- categories ---------------------------------------------------------------


@_query("visited_categories")
def _visited_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.visited_categories(_detail(spark, sf_dir))


@_query("category_clicks")
def _category_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_clicks(_detail(spark, sf_dir))


@_query("category_orders")
def _category_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_orders(_detail(spark, sf_dir))


@_query("category_pays")
def _category_pays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_pays(_detail(spark, sf_dir))


@_query("category_counts")
def _category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(_detail(spark, sf_dir))


@_query("top10_category")
def _top10_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).top_categories()


@_query("session_category_clicks")
def _session_category_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = categories.session_category_clicks(fx.user_visit_action(spark, sf_dir))
    return categories.within_sessions(counts, _picked(spark, sf_dir))


@_query("category_session_counts")
def _category_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = categories.top_categories(categories.category_counts(_detail(spark, sf_dir)))
    return categories.category_sessions(top, _session_category_clicks(spark, sf_dir)).select(
        "category_id", "session_id", "click_count"
    )


@_query("top10_category_session")
def _top10_category_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).top_sessions()


@_query("top_session_detail")
def _top_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).top_session_detail()


# --- funnel -------------------------------------------------------------------


@_query("page_transitions")
def _page_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = funnel.page_transitions(fx.user_visit_action(spark, sf_dir))
    return (
        moves.groupBy("session_id", "time", "from_page", "to_page")
        .agg(F.sum("transitions").alias("transitions"))
        .withColumn("time", fn.format_time(F.col("time")))
    )


@_query("page_split_pv")
def _page_split_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.page_split_pv(fx.user_visit_action(spark, sf_dir), FLOW)


@_query("start_page_pv")
def _start_page_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.start_page_pv(fx.user_visit_action(spark, sf_dir), FLOW)


@_query("page_convert_rate")
def _page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FunnelAnalysis(fx.user_visit_action(spark, sf_dir), PARAMS, TASK).rates()


@_query("page_convert_rate_string")
def _page_convert_rate_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FunnelAnalysis(fx.user_visit_action(spark, sf_dir), PARAMS, TASK).rate_string()


# --- products -----------------------------------------------------------------


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_actions(fx.user_visit_action(spark, sf_dir), *WHOLE)


def _area_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.area_product_clicks(_clicks(spark, sf_dir), fx.city_info(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.area_product_enriched(
        _area_counts(spark, sf_dir), fx.product_info(spark, sf_dir)
    )


@_query("click_with_city")
def _click_with_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.click_with_city(_clicks(spark, sf_dir), fx.city_info(spark, sf_dir))


@_query("area_product_clicks")
def _area_product_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_counts(spark, sf_dir)


@_query("area_product_enriched")
def _area_product_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@_query("area_level")
def _area_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = products.area_level(F.col("area"), LEVELS)
    return _enriched(spark, sf_dir).select("area", "product_id", level.alias("area_level"))


@_query("area_top3_product")
def _area_top3_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ProductAnalysis(
        fx.user_visit_action(spark, sf_dir),
        fx.city_info(spark, sf_dir),
        fx.product_info(spark, sf_dir),
        PARAMS,
        TASK,
        levels=LEVELS,
    ).top_products()


# --- ads ----------------------------------------------------------------------


@_query("ad_clean_clicks")
def _ad_clean_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = ads.clean_clicks_by_day(fx.ad_click_log(spark, sf_dir), THRESHOLD)
    return clean.select("event_id", "date", "province", "city", "user_id", "ad_id")


@_query("daily_user_ad_clicks")
def _daily_user_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.daily_user_ad_clicks(fx.ad_click_log(spark, sf_dir))


@_query("ad_blacklist")
def _ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_blacklist(_daily_user_ad_clicks(spark, sf_dir), THRESHOLD)


@_query("ad_stat")
def _ad_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_stat(fx.ad_click_log(spark, sf_dir))


@_query("ad_province_counts")
def _ad_province_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_province_counts(_ad_stat(spark, sf_dir))


@_query("ad_province_top3")
def _ad_province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_province_top(_ad_province_counts(spark, sf_dir))


@_query("ad_click_trend")
def _ad_click_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_click_trend(fx.ad_click_log(spark, sf_dir))


@_query("ad_trend_last_hour")
def _ad_trend_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.last_hour(ads.ad_click_trend(fx.ad_click_log(spark, sf_dir)), "2024-01-15 12:30:00")


# --- streams: replay of the whole table, the result is the final state ----------


def _click_stream(spark: SparkSession, sf_dir: str, path: str, files: int = BATCH_FILES) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return fx.ad_clicks_from(events, fx.city_info(spark, sf_dir))


def _stored_counts(
    spark: SparkSession, counts: DataFrame, keys: list[str], name: str, by: tuple[str, ...] = ("date",)
) -> DataFrame:
    work = work_dir(spark, name)
    query = start_upsert(
        counts, f"{work}/table", keys, f"{work}/checkpoint", available_now=True, partition_by=by
    )
    query.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{work}/table")


@_query("ad_stat_stream")
def _ad_stat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ad_stat_stream(_click_stream(spark, sf_dir, f"{sf_dir}/events*.parquet"))
    return _stored_counts(spark, counts, ["date", "province", "city", "ad_id"], "stat")


@_query("ad_trend_stream")
def _ad_trend_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ad_trend_stream(_click_stream(spark, sf_dir, f"{sf_dir}/events*.parquet"))
    return _stored_counts(spark, counts, ["date", "hour", "minute", "ad_id"], "trend")


def _arrivals(spark: SparkSession, sf_dir: str, path: str, days: int, files: int = 1) -> Iterator[int]:
    """Write the month's events in parts of ``days`` days each, one after the other, a part as up to ``files`` files."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = 30 // days - 1
    arrival = F.least(F.call_function("div", F.day("ts") - 1, F.lit(days)), F.lit(last)).cast("int")
    # The table is read once; each part then reads its own rows.
    dealt = f"{work_dir(spark, 'dealt')}/events"
    rows = events.withColumn("_arrival", arrival)
    rows.write.partitionBy("_arrival").parquet(dealt)
    parts = spark.read.schema(rows.schema).parquet(dealt)
    for number in range(last + 1):
        part = parts.where(F.col("_arrival") == number).drop("_arrival").coalesce(files)
        # Small row groups: a stream reads a file in several tasks.
        part.write.mode("append").option("parquet.block.size", 4 << 20).parquet(path)
        yield number


@_query("ad_trend_sliding_stream")
def _ad_trend_sliding_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slide of the 60-minute window, over clicks that arrive up to a minute after they happened."""
    path = f"{work_dir(spark, 'arrivals')}/events"
    for _ in _arrivals(spark, sf_dir, path, 10):
        pass
    clicks = _click_stream(spark, sf_dir, path, files=1)
    delay = F.make_interval(secs=(F.col("event_id") % 7) * 10)
    panes = ad_trend_panes_stream(clicks.withColumn("arrival", F.col("ts") + delay), "arrival")
    stored = _stored_counts(spark, panes, ["date", "pane", "minute", "ad_id"], "panes")
    slides = ads.sliding_trend(stored)
    return slides.withColumn("slide_end", F.date_format("slide_end", "yyyy-MM-dd HH:mm:ss"))


@_query("ad_log_rejects_stream")
def _ad_log_rejects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and unreadable lines as the stream observed them, added up over its batches."""
    work = work_dir(spark, "lines")
    fx.ad_log_lines(spark, sf_dir, "area").repartition(4).write.text(f"{work}/in")
    clicks = ad_stream(spark, "text", {"path": f"{work}/in", "maxFilesPerTrigger": "1"})
    writer = clicks.writeStream.format("noop").option("checkpointLocation", f"{work}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    counts = spark.createDataFrame(batch_counts(query), "batch_id long, lines long, rejected long, late long")
    return counts.agg(F.sum("rejected").alias("rejected"), F.sum("lines").alias("lines"))


def _replay(spark: SparkSession, sf_dir: str, *tables: str) -> AdClickStream:
    """The job over three arrivals of ten days each, restarted from its checkpoint every time."""
    work = work_dir(spark, "replay")
    job = AdClickStream(spark, f"{work}/state", threshold=THRESHOLD)
    # An arrival is one batch, in no more files than a batch takes.
    for _ in _arrivals(spark, sf_dir, f"{work}/arrivals", 10, files=BATCH_FILES):
        clicks = _click_stream(spark, sf_dir, f"{work}/arrivals")
        queries = start_ad_stream(clicks, job, f"{work}/checkpoint", available_now=True, tables=tables)
        queries.awaitTermination()
    return job


def _daily_replay(spark: SparkSession, sf_dir: str, *tables: str) -> AdClickStream:
    """The job over thirty batches, one a day."""
    work = work_dir(spark, "daily-replay")
    job = AdClickStream(spark, f"{work}/state", threshold=THRESHOLD)
    for _ in _arrivals(spark, sf_dir, f"{work}/arrivals", 1):
        pass
    clicks = _click_stream(spark, sf_dir, f"{work}/arrivals", files=1)
    queries = start_ad_stream(clicks, job, f"{work}/checkpoint", available_now=True, tables=tables)
    queries.awaitTermination()
    return job


@_query("ad_clean_clicks_stream")
def _ad_clean_clicks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _replay(spark, sf_dir)
        .clean_clicks()
        .groupBy("batch_id", "date", "province", "city", "user_id", "ad_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )


@_query("ad_blacklist_stream")
def _ad_blacklist_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir).blacklist()


@_query("ad_province_top3_stream")
def _ad_province_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, "ad_stat").ad_province_top()


@_query("ad_user_counts_stream")
def _ad_user_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_replay(spark, sf_dir).user_ad_counts()


@_query("ad_published_stat_stream")
def _ad_published_stat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_replay(spark, sf_dir, "ad_stat").ad_stat()


# --- tables -------------------------------------------------------------------


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Totals over the clicks of even events, and over all of them for the dates from the 16th on."""
    clicks = fx.ad_click_log(spark, sf_dir)
    return ads.ad_stat(clicks.where("event_id % 2 = 0")), ads.ad_stat(clicks.where("date >= '2024-01-16'"))


@_query("table_upsert")
def _table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _halves(spark, sf_dir)
    work = work_dir(spark, "upsert")
    append(old, f"{work}/table", ["date"])
    new.write.parquet(f"{work}/new")
    stored = spark.read.schema(new.schema).parquet(f"{work}/new")
    upsert(stored, f"{work}/table", ["date", "province", "city", "ad_id"], ["date"])
    return spark.read.schema(old.schema).parquet(f"{work}/table")


@_query("table_append")
def _table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'append')}/table"
    old, new = _halves(spark, sf_dir)
    for rows in (old, new):
        append(rows, path, ["date"])
    return spark.read.schema(old.schema).parquet(path)


@_query("table_replace")
def _table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'replace')}/table"
    old, new = _halves(spark, sf_dir)
    append(old, path, ["date", "province"])
    replace_partitions(new.where("province = 'ASIA'"), path, ["date", "province"])
    return spark.read.schema(old.schema).parquet(path)


@_query("result_replace")
def _result_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a task that ran, ran again over another range and then broke off in a third run."""
    root = work_dir(spark, "results")
    log = fx.user_visit_action(spark, sf_dir)
    counts = {span: log.where(F.col("date").between(*span)).groupBy("date").count() for span in (WHOLE, RANGE)}
    for span in (WHOLE, RANGE):
        run = TaskRun(spark, root, TASK)
        run.write(counts[span], "actions_per_day")
        run.commit()
    TaskRun(spark, root, TASK).write(counts[WHOLE], "actions_per_day")
    return read_results(spark, root, "actions_per_day").withColumnRenamed("count", "actions")


# --- functions ----------------------------------------------------------------


@_query("concat_long_string")
def _concat_long_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fn.concat_long_string(F.col("click_category_id"), F.col("search_keyword"), ":")
    return fx.user_visit_action(spark, sf_dir).select("session_id", text.alias("text"))


@_query("json_field")
def _json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fn.json_field(F.col("extend_info"), "product_status")
    return fx.product_info(spark, sf_dir).select("product_id", status.alias("product_status"))


@_query("group_concat_distinct")
def _group_concat_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per (date, city) first: the lists then see every city once.
    pairs = fx.user_visit_action(spark, sf_dir).select("date", "city_id").distinct()
    cities = fn.group_concat_distinct(F.col("city_id").cast("string"))
    return pairs.groupBy("date").agg(cities.alias("cities"))


@_query("time_formats")
def _time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        fn.format_date(ts).alias("day"),
        fn.format_time(ts).alias("time"),
        fn.format_date_key(ts).alias("day_key"),
        fn.format_time_minute(ts).alias("minute_key"),
        fn.date_hour(ts).alias("day_hour"),
    )


@_query("trim_comma")
def _trim_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit(","), F.coalesce("order_category_ids", F.lit(",")), F.lit(","))
    return fx.user_visit_action(spark, sf_dir).select(
        "session_id", fn.trim_comma(wrapped).alias("text")
    )


@_query("pad2")
def _pad2(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select("event_id", fn.pad2(number).alias("text"))


@_query("time_compare")
def _time_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.user_visit_action(spark, sf_dir)
    time = F.col("action_time")
    # The second text is unreadable for pages 3 and 4.
    noon = F.concat("date", F.when(F.col("page_id") < 3, " 1:00:00").otherwise(" late"))
    return log.select(
        "session_id",
        "action_time",
        fn.before(time, noon).cast("int").alias("is_before"),
        fn.after(time, noon).cast("int").alias("is_after"),
        fn.minus_seconds(time, noon).alias("seconds"),
    )


@_query("parse_times")
def _parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.user_visit_action(spark, sf_dir)
    key = F.when(F.col("page_id") < 3, F.replace("date", F.lit("-"), F.lit(""))).otherwise("soon")
    return log.select(
        "session_id",
        fn.format_time(fn.parse_time(F.col("action_time"))).alias("time"),
        fn.parse_date_key(key).cast("string").alias("day"),
    )


@_query("empty_text")
def _empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Null for other events, empty for clicks on even categories.
    text = F.when(F.col("click_category_id") % 2 == 0, "").otherwise(F.col("search_keyword"))
    return fx.user_visit_action(spark, sf_dir).select(
        "session_id",
        fn.is_empty(text).cast("int").alias("is_empty"),
        fn.is_not_empty(text).cast("int").alias("is_not_empty"),
    )


@_query("sql_functions")
def _sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered SQL functions, called from SQL."""
    fn.register_functions(spark)
    cities = fx.city_info(spark, sf_dir).withColumn("doc", F.to_json(F.struct("city_name", "city_id")))
    return cities.selectExpr(
        "city_id", "concat_long_string(city_id, city_name, ':') AS text", "json_field(doc, 'city_name') AS name"
    )


@_query("days_from_today")
def _days_from_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an event's day is before yesterday and before today."""
    day = F.col("ts").cast("date").cast("string")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.groupBy(day.alias("date")).agg(
        F.count_if(day < fn.yesterday()).alias("before_yesterday"), F.count_if(day < fn.today()).alias("before_today")
    )


@_query("json_parameters")
def _json_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions filtered by parameters in the JSON form of a task."""
    text = (
        f'{{"startDate":["{RANGE[0]}"],"endDate":["{RANGE[1]}"],"startAge":["25"],"endAge":["40"],'
        '"sex":["male"],"cities":[],"keywords":[""]}'
    )
    params = TaskParams.from_json(text)
    log = fx.user_visit_action(spark, sf_dir)
    job = SessionAnalysis(log, fx.user_info(spark, sf_dir), params, TASK)
    return job.sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"))
