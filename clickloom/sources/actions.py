"""Date-range scans of the action log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def actions_by_date(actions: DataFrame, start: str, end: str) -> DataFrame:
    """Actions with ``start <= date <= end``; the plain comparison is pushed to the scan or partition list."""
    return actions.where(F.col("date").between(start, end))


def click_actions(actions: DataFrame, start: str, end: str) -> DataFrame:
    """(city_id, product_id) of the product clicks in the date range."""
    return (
        actions_by_date(actions, start, end)
        .where(F.col("click_product_id").isNotNull())
        .select("city_id", F.col("click_product_id").alias("product_id"))
    )
