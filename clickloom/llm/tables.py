"""Written intermediate tables and offsets over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.streaming.workdir import work_dir


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared folder and read again, which cuts their lineage."""
    spark = rows.sparkSession
    path = work_dir(spark, purpose)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def block_starts(blocks: DataFrame, order: str, total: str) -> DataFrame:
    """(``order``, start): sum of ``total`` over the blocks before each one.

    There is a row for every input split or file, not for every record, so one task can order them. The table is
    written: its real size then tells Spark how to join it.
    """
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(order, F.coalesce(F.sum(total).over(before), F.lit(0)).alias("start"))
    return stored(starts, "starts")
