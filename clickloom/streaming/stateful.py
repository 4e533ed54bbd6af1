"""Running counts kept in Spark's own state store, and the tables that follow them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.sinks import upsert

PANE = "10 seconds"
_STATE = {
    # State on disk, not in the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch stores what it changed; whole states are stored in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Expired state is found when the next rows come. Batches without rows would never end a run over what is there.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_STORES = "spark.sql.shuffle.partitions"
# Executors may still be on their way when a stream begins.
_FEWEST_STORES = 12


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings of streams started inside; a query holds to them as long as it runs."""
    # Every batch opens and commits the store of every partition, with rows for it or not, and writes files for each: no more
    # of them than cores. A checkpoint keeps the number that it began with.
    cores = max(_FEWEST_STORES, spark.sparkContext.defaultParallelism)
    stores = min(int(spark.conf.get(_STORES)), cores)
    settings = _STATE | {_STORES: str(stores)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _limited(clicks: DataFrame, time: str, lateness: str | None) -> DataFrame:
    return clicks if lateness is None else clicks.withWatermark(time, lateness)


def ad_stat_stream(clicks: DataFrame, lateness: str | None = None) -> DataFrame:
    """Running clicks per (date, province, city, ad); write it in update mode.

    The date is a day of the session's time zone. By default every click counts and state is kept. With
    ``lateness``, clicks that much older than the newest one are dropped, which :func:`batch_counts` tells, and the state of
    past days is freed.
    """
    zone = clicks.sparkSession.conf.get("spark.sql.session.timeZone")
    # Local clock time, for windows know the clock of UTC alone.
    local = clicks.withColumn("_local", F.from_utc_timestamp("ts", zone))
    day = F.window("_local", "1 day")
    return (
        _limited(local, "_local", lateness)
        .groupBy(day.alias("_day"), "province", "city", "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(
            F.to_utc_timestamp("_day.start", zone).cast("date").cast("string").alias("date"),
            "province",
            "city",
            "ad_id",
            "click_count",
        )
    )


def ad_trend_stream(clicks: DataFrame, lateness: str | None = None) -> DataFrame:
    """Running clicks per (date, hour, minute, ad); write it in update mode.

    One-minute windows, so a click updates one row. The last hour is a filter on the stored table
    (``operators.ads.last_hour``). ``lateness`` as in :func:`ad_stat_stream`.
    """
    return (
        _limited(clicks, "ts", lateness)
        .groupBy(F.window("ts", "1 minute").alias("_minute"), "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(
            F.col("_minute.start").cast("date").cast("string").alias("date"),
            F.date_format("_minute.start", "HH").alias("hour"),
            F.date_format("_minute.start", "mm").alias("minute"),
            "ad_id",
            "click_count",
        )
    )


def ad_trend_panes_stream(
    clicks: DataFrame, arrival: str, lateness: str | None = None, pane: str = PANE
) -> DataFrame:
    """Running clicks per arrival pane, event minute and ad; write it in update mode.

    A click updates one row, however many windows overlap on it; ``operators.ads.sliding_trend`` makes the windows of the
    panes by adding the newest and taking back the oldest. ``date`` is the day of the pane.
    """
    return (
        _limited(clicks, arrival, lateness)
        .groupBy(
            F.window(arrival, pane).alias("_pane"), F.date_trunc("minute", "ts").alias("minute"), "ad_id"
        )
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(
            F.col("_pane.start").cast("date").cast("string").alias("date"),
            F.col("_pane.start").alias("pane"),
            "minute",
            "ad_id",
            "click_count",
        )
    )


def start_upsert(
    counts: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    interval: str = "5 seconds",
    available_now: bool = False,
    partition_by: Sequence[str] = ("date",),
    then: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Keep the table at ``path`` equal to the newest counts; ``then`` gets the changed rows of every batch."""
    empty = counts.sparkSession.createDataFrame([], counts.schema)
    # Makes the table exist; changes nothing when it does.
    empty.write.mode("append").partitionBy(*partition_by).parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Stored before use: the upsert reads the rows more than once, and every read of `batch` itself
        # would run the stateful plan again. Survives the loss of an executor, unlike a cache.
        staged = f"{path}_incoming"
        batch.write.mode("overwrite").parquet(staged)
        changed = counts.sparkSession.read.schema(counts.schema).parquet(staged)
        upsert(changed, path, keys, partition_by)
        if then:
            then(changed)

    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def batch_counts(query: StreamingQuery, name: str = "ad_log") -> list[dict[str, int]]:
    """What the recent batches of a query read: (batch_id, lines, rejected, late), one entry for each batch with input.

    ``late`` counts the rows that a state operator dropped as too late; lines are those that ``sources.ad_stream`` observed.
    """
    found = []
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get(name)
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        if seen is not None or late:
            lines, rejected = (0, 0) if seen is None else (seen.lines, seen.rejected)
            found.append({"batch_id": progress.batchId, "lines": lines, "rejected": rejected, "late": late})
    return found
