"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark prunes a "row_number <= n" filter before the shuffle only up to this n
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
_PRUNED_BELOW = 1000
_SALTS = 256


def top_n_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    salt_on: Sequence[str],
    rank: str = "rank",
) -> DataFrame:
    """First ``n`` rows of each group in ``order``, numbered from 1 in column ``rank``.

    ``order`` must be total. Up to 1000 rows per group the limit is applied inside every task before
    the shuffle, so a group of any size sends at most ``n`` rows per task. For a larger ``n`` the group is
    first cut down inside salts taken from ``salt_on``, which gives the same rows.
    """
    if n > _PRUNED_BELOW:
        salted = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(_SALTS)))
            .withColumn("_rank", F.row_number().over(salted))
            .where(F.col("_rank") <= n)
            .drop("_salt", "_rank")
        )
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
