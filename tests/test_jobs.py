"""Whole jobs on the sample tables: what is written equals what the operators return."""

from __future__ import annotations

import pytest

from clickloom.checks import fixtures as fx
from clickloom.params import TaskParams
from clickloom.plans import FunnelAnalysis, SessionAnalysis
from clickloom.sinks import read_results
from clickloom.streaming.workdir import work_dir

SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    columns = sorted(df.columns)
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_session_job_writes_its_results(spark, tmp_path):
    params = TaskParams("2024-01-01", "2024-01-30", start_age=18, end_age=60)
    job = SessionAnalysis(
        fx.user_visit_action(spark, SF_DIR), fx.user_info(spark, SF_DIR), params, task_id=3
    )
    expected = {
        "session_aggr_stat": bag(job.aggr_stat()),
        "session_random_extract": bag(job.random_extract()),
        "top10_category": bag(job.top_categories()),
        "top10_category_session": bag(job.top_sessions()),
        "session_detail": sorted(bag(job.sample_detail()) + bag(job.top_session_detail()), key=repr),
    }
    root = str(tmp_path)
    # A retried job leaves one set of rows.
    job.write_all(root)
    job.write_all(root)
    for name, rows in expected.items():
        assert rows and bag(read_results(spark, root, name)) == rows
    # The sample is part of the filtered sessions, its detail holds all their actions.
    sessions = {r.session_id for r in job.sessions.collect()}
    sampled = {r.session_id for r in job.random_extract().collect()}
    assert sampled <= sessions
    assert {r.session_id for r in job.sample_detail().collect()} == sampled
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_funnel_job(spark, tmp_path):
    log = fx.user_visit_action(spark, SF_DIR)
    params = TaskParams("2024-01-01", "2024-01-30", page_flow=(0, 1, 2))
    FunnelAnalysis(log, params, 6).write_all(str(tmp_path))
    row = read_results(spark, str(tmp_path), "page_split_convert_rate").first()
    assert row.convert_rate.startswith("0_1=") and "|1_2=" in row.convert_rate
    with pytest.raises(ValueError):
        FunnelAnalysis(log, TaskParams("2024-01-01", "2024-01-30"), 6)


def test_work_folder_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_dir(spark, "x")
    assert folder != work_dir(spark, "x")
    if root:
        assert folder.startswith(root.rstrip("/") + "/")
