"""The ad click job: dynamic blacklist, running totals, province ranking and minute trend."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.ads import ad_province_counts, ad_province_top
from clickloom.sinks import replace_partitions, touched_partitions
from clickloom.streaming.screen import BAN, CLICK, LOG, TOTAL, screened
from clickloom.streaming.stateful import (
    ad_stat_stream,
    ad_trend_stream,
    state_settings,
    start_upsert,
)

#: Tables that follow the screened log; ``ad_stat`` brings the ranking ``ad_province_top3`` with it.
FOLLOWERS = ("ad_stat", "ad_click_trend")
_STAT = "date string, province string, city string, ad_id bigint, click_count bigint"
_TOP = "date string, province string, ad_id bigint, click_count bigint"
_TREND = "date string, hour string, minute string, ad_id bigint, click_count bigint"


class AdClickStream:
    """Tables of the job below ``root``, a folder that all executors share.

    A first stream screens the clicks by the blacklist as it stood before their batch (:func:`screened`) and writes a log through
    Spark's file sink, so a repeated batch leaves the same rows. Two more streams follow the log: one keeps ``ad_stat`` and
    ranks again the (date, province) groups that changed, one keeps ``ad_click_trend``. All state is Spark's and
    lies in the queries' checkpoints; readers see the newest tables and need no batch number.

    ``keep_days`` frees totals that no click has come for, see :func:`screened`; ``lateness`` frees state of the two
    followers, see :func:`ad_stat_stream`. By default nothing is dropped.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        threshold: int = 100,
        keep_days: int | None = None,
        lateness: str | None = None,
        n: int = 3,
    ) -> None:
        self._spark = spark
        self._root = root
        self._threshold = threshold
        self._keep_days = keep_days
        self._lateness = lateness
        self._n = n

    # --- streams ------------------------------------------------------------

    def start_screen(self, clicks: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        """Screen ``clicks`` (ts, date, province, city, user_id, ad_id) into the log."""
        rows = screened(clicks, self._threshold, self._keep_days)
        with state_settings(self._spark):
            return (
                rows.writeStream.format("parquet")
                .partitionBy("kind", "date")
                .option("path", self._path("log"))
                .option("checkpointLocation", f"{checkpoint}/screen")
                .trigger(**trigger)
                .start()
            )

    def start_followers(
        self, checkpoint: str, interval: str, available_now: bool, tables: Sequence[str] = FOLLOWERS
    ) -> list[StreamingQuery]:
        """Keep ``tables`` up with the log, which must exist."""
        passed = self._spark.readStream.schema(LOG).parquet(self._path("log")).where(F.col("kind") == CLICK)

        def start(name: str) -> StreamingQuery:
            if name == "ad_stat":
                counts, then = ad_stat_stream(passed, self._lateness), self._rank_again
                keys, by = ["date", "province", "city", "ad_id"], ["date", "province"]
            else:
                counts, then = ad_trend_stream(passed, self._lateness), None
                keys, by = ["date", "hour", "minute", "ad_id"], ["date", "hour"]
            place = f"{checkpoint}/{name}"
            return start_upsert(counts, self._path(name), keys, place, interval, available_now, by, then)

        with state_settings(self._spark):
            return [start(name) for name in tables]

    def _rank_again(self, changed: DataFrame) -> None:
        """Rewrite the ranking of the (date, province) groups in ``changed``."""
        by = ["date", "province"]
        groups = touched_partitions(self.ad_stat(), changed, by)
        top = ad_province_top(ad_province_counts(groups), self._n)
        replace_partitions(top, self._path("ad_province_top3"), by)

    # --- tables -------------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self._root}/{name}"

    def _table(self, name: str, schema: str) -> DataFrame:
        # Partition columns come last from files.
        columns = [column.split()[0] for column in schema.split(", ")]
        return self._spark.read.schema(schema).parquet(self._path(name)).select(*columns)

    def _log(self, kind: str) -> DataFrame:
        return self._table("log", LOG).where(F.col("kind") == kind)

    def clean_clicks(self) -> DataFrame:
        """All clicks that passed, with the ``batch_id`` that brought them."""
        return self._log(CLICK).select("ts", "date", "province", "city", "user_id", "ad_id", "batch_id")

    def blacklist(self) -> DataFrame:
        """(user_id, crossed_in) of the blacklisted users, with the batch that did it."""
        return self._log(BAN).select("user_id", F.col("batch_id").alias("crossed_in"))

    def user_ad_counts(self) -> DataFrame:
        """Running totals per (date, user, ad). Every batch logs the totals it changed; they only grow."""
        totals = self._log(TOTAL).groupBy("date", "user_id", "ad_id")
        return totals.agg(F.max("click_count").alias("click_count"))

    def ad_stat(self) -> DataFrame:
        """Running totals per (date, province, city, ad)."""
        return self._table("ad_stat", _STAT)

    def ad_province_top(self) -> DataFrame:
        """Most clicked ads per (date, province)."""
        return self._table("ad_province_top3", _TOP)

    def ad_click_trend(self) -> DataFrame:
        """Running totals per (date, hour, minute, ad)."""
        return self._table("ad_click_trend", _TREND)


@dataclass
class AdQueries:
    """The running streams of a job: the screen and its followers."""

    screen: StreamingQuery
    followers: list[StreamingQuery] = field(default_factory=list)

    def awaitTermination(self) -> None:
        for query in (self.screen, *self.followers):
            query.awaitTermination()

    def stop(self) -> None:
        for query in (self.screen, *self.followers):
            query.stop()


def start_ad_stream(
    clicks: DataFrame,
    stream: AdClickStream,
    checkpoint: str,
    interval: str = "5 seconds",
    available_now: bool = False,
    tables: Sequence[str] = FOLLOWERS,
) -> AdQueries:
    """Run the job on a streaming click log, every ``interval`` or once over what is there, and keep up ``tables``.

    Once over what is there, the screen is done when this returns, and its followers have started.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    screen = stream.start_screen(clicks, checkpoint, trigger)
    if available_now:
        screen.awaitTermination()
    return AdQueries(screen, stream.start_followers(checkpoint, interval, available_now, tables))
