"""Ad click log: text parsing and the streaming source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the observed metrics of the streaming source.
AD_LOG = "ad_log"
# Milliseconds of the years 1 to 9999, less a day at both ends for the time zones.
_MILLIS = (-62_135_510_400_000, 253_402_214_399_999)


def _tokens(lines: DataFrame, col: str) -> DataFrame:
    """One array of tokens per line.

    The explode of a one-element array is there for the optimizer: filters are not moved across it, so
    the split is evaluated once per line and not again in every predicate and field.
    """
    tokens = F.split(F.rtrim(F.col(col).cast("string")), " ")
    return lines.select(F.explode(F.array(tokens)).alias("_tokens"))


def _field(position: int) -> Column:
    return F.get("_tokens", F.lit(position))


def _number(position: int) -> Column:
    return _field(position).try_cast("bigint")


def _readable() -> Column:
    numbers = [_number(position).isNotNull() for position in (0, 3, 4)]
    # Five tokens and a time that a date can show; the coalesce covers a null line.
    readable = (F.size("_tokens") == 5) & numbers[0] & numbers[1] & numbers[2] & _number(0).between(*_MILLIS)
    return F.coalesce(readable, F.lit(False))


def parse_ad_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """``epoch_millis province city user_id ad_id`` text to columns; other lines are left out.

    Count the lines left out with :func:`ad_log_rejects`. Works on batch and streaming input.
    """
    return _parsed(_tokens(lines, col))


def _parsed(tokens: DataFrame) -> DataFrame:
    ts = F.timestamp_millis(_number(0))
    return (
        tokens.where(_readable())
        .select(
            ts.alias("ts"),
            ts.cast("date").cast("string").alias("date"),
            _field(1).alias("province"),
            _field(2).alias("city"),
            _number(3).alias("user_id"),
            _number(4).alias("ad_id"),
        )
    )


def ad_log_rejects(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row with the number of lines :func:`parse_ad_log` cannot read."""
    return _tokens(lines, col).agg(*_line_counts())


def _line_counts() -> list[Column]:
    return [F.count_if(~_readable()).alias("rejected"), F.count(F.lit(1)).alias("lines")]


def ad_stream(spark: SparkSession, source: str, options: Mapping[str, str]) -> DataFrame:
    """Streaming click log as parsed columns.

    ``source`` is any streaming text source with a ``value`` column: ``kafka`` (options
    ``kafka.bootstrap.servers``, ``subscribe`` and, to bound a micro-batch, ``maxOffsetsPerTrigger``)
    or ``text`` (option ``path``, and ``maxFilesPerTrigger``). The Kafka connector is not part of a
    plain Spark installation; add it with ``spark.jars.packages``. Lines and unreadable lines are counted
    on the way, as the observed metrics ``AD_LOG`` of every batch (``streaming.batch_counts``).
    """
    lines = spark.readStream.format(source).options(**options).load()
    return _parsed(_tokens(lines, "value").observe(AD_LOG, *_line_counts()))
