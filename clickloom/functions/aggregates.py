"""Aggregate column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_concat_distinct(text: Column, sep: str = ",") -> Column:
    """Distinct values of a group, sorted ascending, joined by ``sep``.

    The values of one group end up in one row, so use it on columns with few distinct values
    (cities, categories) and group by (key, value) first when a key may repeat a value often.
    """
    return F.array_join(F.sort_array(F.collect_set(text)), sep)
