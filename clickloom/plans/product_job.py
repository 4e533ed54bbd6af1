"""Top products per area of one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import products
from clickloom.params import TaskParams
from clickloom.sinks import TaskRun
from clickloom.sources import click_actions


class ProductAnalysis:
    """Most clicked products of every area in the task's date range."""

    def __init__(
        self,
        actions: DataFrame,
        cities: DataFrame,
        product_info: DataFrame,
        params: TaskParams,
        task_id: int,
        levels: Mapping[str, str] = products.AREA_LEVELS,
        default_level: str = products.DEFAULT_LEVEL,
    ) -> None:
        self._clicks = click_actions(actions, params.start_date, params.end_date)
        self._cities = cities
        self._products = product_info
        self._task_id = task_id
        self._levels = levels
        self._default = default_level

    def top_products(self, n: int = 3) -> DataFrame:
        top = products.area_top_products(
            self._clicks, self._cities, self._products, n, self._levels, self._default
        )
        return top.select(F.lit(self._task_id).cast("bigint").alias("taskid"), "*")

    def write_all(self, root: str) -> None:
        """Store the result below ``root``, in place of an earlier run of the task."""
        run = TaskRun(self._clicks.sparkSession, root, self._task_id)
        run.write(self.top_products(), "area_top3_product")
        run.commit()
