"""Table writers: append, upsert, replace."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together, so that it gets few files.

    Adaptive execution splits a partition that holds too much and merges small ones.
    """
    return df.hint("rebalance", *by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_jdbc(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Add rows to a JDBC table, in batches, one connection per partition."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows for; the others stay.

    Repeating the call with the same rows leaves the same table.
    """
    (
        rebalanced(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _partition_text(name: str) -> Column:
    """A partition value as text, with a text of its own for null, so that plain equality also joins nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def touched_partitions(table: DataFrame, df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the partitioned ``table`` in the partitions that ``df`` has rows for.

    The touched partitions are a table themselves and its join with ``table`` prunes partitions at run time; where they are
    too many for a broadcast, it is a plain join.
    """
    touched = df.select(*(_partition_text(name).alias(f"_touched_{name}") for name in by)).distinct()
    # Always true; Spark prunes at run time only by tables with a condition.
    touched = touched.where(F.col(f"_touched_{by[0]}") >= "")
    same = [_partition_text(name) == F.col(f"_touched_{name}") for name in by]
    return table.join(touched, reduce(and_, same), "left_semi")


def upsert(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Set rows of an existing Parquet table by key: new rows win, other rows stay.

    ``partition_by`` must be among ``keys``; ``df`` is read twice, so it should be stored. Only the partitions that
    ``df`` touches are read and written; the write stages next to the table and swaps partitions at commit, so it may read the
    table it replaces. Repeating the call is harmless.
    """
    missing = set(partition_by) - set(keys)
    if missing:
        raise ValueError(f"partition columns {sorted(missing)} are not keys")
    values = [name for name in df.columns if name not in keys]
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    kept = touched_partitions(stored, df, partition_by).withColumn("_new", F.lit(0))
    merged = (
        kept.unionByName(df.withColumn("_new", F.lit(1)))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "_new").alias("_row"))
        .select(*keys, "_row.*")
    )
    replace_partitions(merged, path, partition_by)


class TaskRun:
    """All results of one run of a task, visible to :func:`read_results` together and only once it is committed.

    A run that ends early leaves nothing to see. A task that runs again has new results in place of all its old ones.
    """

    RUNS = "task_runs"
    SCHEMA = "taskid bigint, run string, committed timestamp"

    def __init__(self, spark: SparkSession, root: str, task_id: int) -> None:
        self._spark = spark
        self._root = root
        self._task_id = task_id
        # Read back as a partition value: the letters keep it from looking like a number.
        self._run = f"run-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> None:
        """Store the rows of one result, all of them of this task."""
        rows = df.drop("taskid")
        rows.write.mode("overwrite").parquet(f"{self._root}/{name}/taskid={self._task_id}/run={self._run}")

    def commit(self) -> None:
        """Make the results visible: one row in one file, which appears whole or not at all."""
        row = self._spark.range(1).select(
            F.lit(self._task_id).cast("bigint").alias("taskid"),
            F.lit(self._run).alias("run"),
            F.current_timestamp().alias("committed"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self._root}/{self.RUNS}")


def read_results(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of result ``name`` with their ``taskid``: of every task those of its last committed run."""
    runs = spark.read.schema(TaskRun.SCHEMA).parquet(f"{root}/{TaskRun.RUNS}")
    last = runs.groupBy("taskid").agg(F.max_by("run", F.struct("committed", "run")).alias("run"))
    rows = spark.read.parquet(f"{root}/{name}")
    columns = [c for c in rows.columns if c not in ("taskid", "run")]
    shown = rows.withColumn("taskid", F.col("taskid").cast("bigint")).join(last, ["taskid", "run"], "left_semi")
    return shown.select("taskid", *columns)


def write_result(
    df: DataFrame, root: str, name: str, task_id: int, replace: bool = False
) -> None:
    """Add one result to ``root/name``, kept in a directory per task; jobs use :class:`TaskRun`.

    Running a task again adds its rows again, or takes the place of its earlier rows with ``replace``, also when
    it has no rows this time. All rows belong to the task ``task_id``.
    """
    rows = df.drop("taskid")
    mode = "overwrite" if replace else "append"
    rows.write.mode(mode).parquet(f"{root}/{name}/taskid={task_id}")
