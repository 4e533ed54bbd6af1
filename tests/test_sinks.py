from __future__ import annotations

import pytest

from clickloom import sinks

SCHEMA = "date string, k bigint, v bigint"


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("date", "k", "v").collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_upsert_sets_by_key_and_can_be_repeated(spark, path):
    old = spark.createDataFrame([("d1", 1, 10), ("d1", 2, 20), ("d2", 1, 30)], SCHEMA)
    sinks.append(old, path, ["date"])
    new = spark.createDataFrame([("d1", 2, 21), ("d1", 3, 31), ("d3", 1, 41)], SCHEMA)
    for _ in range(2):
        sinks.upsert(new, path, ["date", "k"], ["date"])
        assert table(spark, path) == [
            ("d1", 1, 10),
            ("d1", 2, 21),
            ("d1", 3, 31),
            ("d2", 1, 30),
            ("d3", 1, 41),
        ]
    sinks.upsert(new.limit(0), path, ["date", "k"], ["date"])
    assert len(table(spark, path)) == 5


def test_upsert_takes_null_partitions_and_keys(spark, path):
    sinks.append(spark.createDataFrame([(None, 1, 10), ("d1", None, 20), ("", 1, 5)], SCHEMA), path, ["date"])
    sinks.upsert(spark.createDataFrame([(None, 1, 11), ("d1", None, 21)], SCHEMA), path, ["date", "k"], ["date"])
    got = spark.read.schema(SCHEMA).parquet(path).select("date", "k", "v").collect()
    # Files know no empty partition value: it is null there.
    assert sorted((r.date or "", r.k or 0, r.v) for r in got) == [("", 1, 11), ("d1", 0, 21)]


def test_upsert_prunes_at_run_time(spark, path, monkeypatch):
    old = spark.createDataFrame([("d1", 1, 10), ("d2", 1, 30)], SCHEMA)
    sinks.append(old, path, ["date"])
    seen = []
    monkeypatch.setattr("clickloom.sinks.tables.replace_partitions", lambda df, *_: seen.append(df))
    new = spark.createDataFrame([("d1", 1, 11)], SCHEMA)
    new.write.parquet(f"{path}-new")
    sinks.upsert(spark.read.schema(SCHEMA).parquet(f"{path}-new"), path, ["date", "k"], ["date"])
    (merged,) = seen
    assert [tuple(r) for r in merged.collect()] == [("d1", 1, 11)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_upsert_over_many_partitions_fetches_none(spark, path, monkeypatch):
    days = spark.range(3000).selectExpr("concat('d', id % 1500) AS date", "id AS k", "id AS v")
    sinks.append(days.coalesce(1), path, ["date"])
    changed = days.selectExpr("date", "k", "v + 1 AS v")
    monkeypatch.setattr(type(changed), "collect", None)
    sinks.upsert(changed, path, ["date", "k"], ["date"])
    monkeypatch.undo()
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert stored.where("v = k + 1").count() == stored.count() == 3000


def test_upsert_needs_partition_columns_among_the_keys(spark, path):
    df = spark.createDataFrame([("d1", 1, 10)], SCHEMA)
    with pytest.raises(ValueError):
        sinks.upsert(df, path, ["k"], ["date"])


def test_replace_partitions_leaves_the_others(spark, path):
    sinks.append(spark.createDataFrame([("d1", 1, 1), ("d2", 2, 2)], SCHEMA), path, ["date"])
    sinks.replace_partitions(spark.createDataFrame([("d1", 9, 9)], SCHEMA), path, ["date"])
    assert table(spark, path) == [("d1", 9, 9), ("d2", 2, 2)]


def test_results_are_appended_per_task(spark, path):
    df = spark.createDataFrame([(1,)], "x bigint")
    sinks.write_result(df, path, "r", 4)
    sinks.write_result(df, path, "r", 4)
    sinks.write_result(df, path, "r", 5)
    got = spark.read.parquet(f"{path}/r").groupBy("taskid").count().orderBy("taskid").collect()
    assert [tuple(r) for r in got] == [(4, 2), (5, 1)]
    sinks.write_result(df, path, "r", 4, replace=True)
    assert spark.read.parquet(f"{path}/r").where("taskid = 4").count() == 1
    sinks.write_result(df.limit(0), path, "r", 4, replace=True)
    assert [tuple(r) for r in spark.read.parquet(f"{path}/r").collect()] == [(1, 5)]


def results(spark, root, name="r"):
    return sorted(tuple(r) for r in sinks.read_results(spark, root, name).collect())


def test_results_show_together_and_replace_those_before(spark, path):
    def run(task, *values, commit=True):
        job = sinks.TaskRun(spark, path, task)
        job.write(spark.createDataFrame([(v,) for v in values], "x bigint"), "r")
        if commit:
            job.write(spark.createDataFrame([(-v, task) for v in values], "y bigint, taskid bigint"), "s")
            job.commit()

    run(4, 1, 2)
    run(5, 3)
    assert results(spark, path) == [(4, 1), (4, 2), (5, 3)]
    # Killed between two results: nothing of it shows, and the next run leaves one set.
    run(4, 7, commit=False)
    assert results(spark, path) == [(4, 1), (4, 2), (5, 3)]
    run(4, 8)
    assert results(spark, path) == [(4, 8), (5, 3)]
    assert results(spark, path, "s") == [(4, -8), (5, -3)]
    empty = sinks.TaskRun(spark, path, 5)
    empty.write(spark.createDataFrame([], "x bigint"), "r")
    empty.commit()
    assert results(spark, path) == [(4, 8)]
