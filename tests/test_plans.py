"""Shape of the physical plans: what is read, what is shuffled, and that no row passes through Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from clickloom.checks import fixtures as fx
from clickloom.checks.registry import QUERIES
from clickloom.operators import ads, categories, funnel, sampling, sessions
from clickloom.sources import actions_by_date
from tests.rows import action, actions

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.endswith("_stream")}


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The adaptive plan that really ran."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def exchanges(plan):
    return len(re.findall(r"(?<!Reused)\bExchange (?:hash|range|round|Single)", plan))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_join(spark, name):
    plan = planned(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_date_range_reaches_the_scan(spark, tmp_path):
    log = actions(spark, [action(), action(second=86_400)])
    log.write.partitionBy("date").parquet(f"{tmp_path}/by_date")
    log.write.parquet(f"{tmp_path}/flat")
    day = ("2024-03-01", "2024-03-01")
    parts = planned(actions_by_date(spark.read.parquet(f"{tmp_path}/by_date"), *day))
    assert "2024-03-01" in parts.split("PartitionFilters: [")[1].split("]")[0]
    flat = planned(actions_by_date(spark.read.parquet(f"{tmp_path}/flat"), *day))
    assert "GreaterThanOrEqual(date,2024-03-01)" in flat
    raw = planned(QUERIES["actions_by_date"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in raw and "LessThan(ts" in raw


def test_last_hour_prunes_days(spark, tmp_path):
    trend = ads.ad_click_trend(fx.ad_click_log(spark, SF_DIR))
    trend.write.partitionBy("date").parquet(f"{tmp_path}/trend")
    stored = spark.read.schema(trend.schema).parquet(f"{tmp_path}/trend")
    plan = planned(ads.last_hour(stored, "2024-01-15 00:30:00"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-14" in filters and "2024-01-15" in filters


def test_statistics_read_no_lists_and_aggregate_by_hash(spark):
    plan = planned(QUERIES["session_aggr_stat"](spark, SF_DIR))
    assert "collect_set" not in plan and "SortAggregate" not in plan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>", plan)
    # One shuffle per session, one for the single row.
    assert exchanges(plan) == 2


def test_category_counts_scan_once(spark):
    plan = planned(categories.category_counts(fx.user_visit_action(spark, SF_DIR)))
    assert plan.count("FileScan") == 1
    assert exchanges(plan) == 1


def test_top_n_is_pruned_before_the_shuffle(spark):
    for name in ("area_top3_product", "ad_province_top3", "top10_category_session"):
        plan = planned(QUERIES[name](spark, SF_DIR))
        assert re.search(r"WindowGroupLimit .*Partial", plan), name
    assert "TakeOrderedAndProject" in planned(QUERIES["top10_category"](spark, SF_DIR))


def test_sample_is_fetched_without_shuffling_the_log(spark):
    plan = executed(QUERIES["sample_detail"](spark, SF_DIR))
    top = plan.split("BroadcastQueryStage")[0]
    assert "BroadcastHashJoin" in top and "Exchange" not in top
    # Plan and pick share the session aggregate.
    assert "ReusedExchange" in plan


def test_sampled_sessions_filter_below_the_aggregate(spark):
    log = fx.user_visit_action(spark, SF_DIR)
    agg = sessions.session_aggregate(log)
    sampled = sampling.sample_sessions(agg, sampling.sample_plan(agg), "7")
    plan = planned(sampled)
    outermost = plan.index("collect_set")
    assert plan.index("BroadcastHashJoin") > outermost


def test_transitions_shuffle_the_ticks_once(spark):
    plan = executed(funnel.page_split_pv(fx.user_visit_action(spark, SF_DIR), (0, 1, 2, 3)))
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


@pytest.fixture
def tiny_partitions(spark):
    """Limits under which the sample counts as skewed, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def a_third(column, value):
    return F.when(F.xxhash64("*") % 3 == 0, F.lit(value)).otherwise(F.col(column))


def test_hot_session_is_split(spark, tmp_path, tiny_partitions):
    log = fx.user_visit_action(spark, "/root/testdata/sf0.01")
    log = log.withColumn("session_id", a_third("session_id", "hot"))
    log.repartition(40).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    agg = sessions.session_aggregate(log)
    detail = sessions.session_detail(agg, log)
    plan = executed(detail)
    assert "SortMergeJoin(skew=true)" in plan and "skewed" in plan
    assert detail.count() == log.count()
    # Steps of the hot session are paired in many tasks and still add up.
    moves = funnel.page_transitions(log).where("session_id = 'hot'")
    hot = log.where("session_id = 'hot'").count()
    assert hot > 2000
    assert moves.agg(F.sum("transitions")).first()[0] == hot - 1


def test_hot_user_is_split(spark, tmp_path, tiny_partitions):
    clicks = fx.ad_click_log(spark, "/root/testdata/sf0.01")
    clicks = clicks.withColumn("user_id", a_third("user_id", -1))
    clicks.repartition(40).write.parquet(f"{tmp_path}/clicks")
    clicks = spark.read.parquet(f"{tmp_path}/clicks")
    clean = ads.clean_clicks_by_day(clicks, 3)
    assert "SortMergeJoin(skew=true)" in executed(clean)
    first_day = clicks.where("user_id = -1").agg(F.min("date")).first()[0]
    kept = clean.where("user_id = -1").select("date").distinct().collect()
    assert [r.date for r in kept] == [first_day]
