"""Joins whose large side may have a few keys with most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_key_join(
    left: DataFrame, right: DataFrame, key: str, how: str, also: Column | None = None
) -> DataFrame:
    """``left`` semi- or anti-joined with ``right`` on ``key`` (and ``also``), safe for hot keys.

    Adaptive execution splits a skewed join partition only when both inputs come straight from a
    shuffle. A side that was just aggregated by the key would be joined in place, and a key with a
    third of all rows would be one task. The second condition follows from the first; being a join key of
    its own, it makes Spark shuffle both sides for this join, which can then be split.
    Names in ``also`` that both sides have must be made unique by the caller.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    other = right.withColumnRenamed(key, "_right_key")
    same = (F.col(key) == F.col("_right_key")) & (
        F.xxhash64(F.col(key)) == F.xxhash64(F.col("_right_key"))
    )
    return left.join(other, same if also is None else same & also, how)
