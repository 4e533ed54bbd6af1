"""JDBC table scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; the last three arguments must be given together or not at all."""
    split = (partition_column, bounds, partitions)
    given = [value is not None for value in split]
    if any(given) and not all(given):
        raise ValueError("partition_column, bounds and partitions go together")
    result = {**options, "dbtable": table}
    if all(given):
        low, high = bounds
        result.update(
            partitionColumn=partition_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(partitions),
        )
    return result


def read_jdbc(spark: SparkSession, options: Mapping[str, str], table: str, **split) -> DataFrame:
    """Read ``table``; ``options`` hold url, user, password, driver.

    Without a split the whole table comes through one connection, which suits small dimensions only.
    Give ``partition_column``, ``bounds`` and ``partitions`` for anything larger.
    """
    return spark.read.format("jdbc").options(**jdbc_options(options, table, **split)).load()
