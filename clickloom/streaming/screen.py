"""The self-growing blacklist as keyed state: totals and bans of a bucket of users in Spark's state store."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows of the screened log. ``click``: a click that passed; ``total``: a user's new total on an ad and day;
#: ``ban``: a user who is dropped from the next batch on. Columns without a meaning for the kind are null.
LOG = (
    "kind string, batch_id bigint, ts timestamp, date string, province string, city string, "
    "user_id bigint, ad_id bigint, click_count bigint"
)
CLICK, TOTAL, BAN = "click", "total", "ban"

#: Users share states by hash, so a batch asks the store per bucket and day, not per total. Part of every checkpoint: never change it.
BUCKETS = 128
# The bucket of clicks without a user.
_NO_USER = -1
# Bits of ``missing``: numbers that are null travel as 0, since pandas would turn their column into doubles.
_NO_TS, _NULL_USER, _NO_AD = 1, 2, 4
_PACKED = (
    "kind string, batch_id bigint, missing int, ts bigint, date string, province string, city string, "
    "user_id bigint, ad_id bigint, click_count bigint"
)


def _screen(threshold: int, keep_ms: int | None) -> StatefulProcessor:
    # A class of this function travels to the workers whole; they need not have the package.
    click, total, ban = CLICK, TOTAL, BAN
    no_ts, null_user, no_ad, no_user = _NO_TS, _NULL_USER, _NO_AD, _NO_USER
    columns = [field.split()[0] for field in _PACKED.split(", ")]
    # Columns of a total in the state; numbers of eight bytes.
    width, (user, ad, count, seen) = 4, range(4)

    class BucketClicks(StatefulProcessor):
        """Totals per (user, ad), packed by date, and the banned users of one bucket."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._totals = handle.getMapState("totals", "date string, has_ad boolean", "packed binary", keep_ms)
            self._banned = handle.getValueState("banned", "users binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            batch = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))
            now = 0 if keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
            of_user = null_user if key[0] == no_user else 0
            held = self._banned.get()
            banned = np.frombuffer(held[0] if held else b"", "<i8")
            fresh: Counter = Counter()
            for clicks in rows:
                passed = clicks[~np.isin(clicks["user_id"].to_numpy(), banned)] if len(banned) else clicks
                if len(passed):
                    has_ad = (passed["missing"] & no_ad) == 0
                    fresh.update(zip(passed["date"], has_ad, passed["user_id"], passed["ad_id"]))
                    yield passed.assign(kind=click, batch_id=batch, click_count=1)[columns]
            if not fresh:
                return
            days = defaultdict(list)
            for (date, has_ad, *who), clicks in fresh.items():
                days[date if isinstance(date, str) else None, bool(has_ad)].append((*who, clicks, now))
            # One frame per bucket: every frame costs some milliseconds.
            numbers, dates, missing = [], [], []
            for (date, has_ad), new in days.items():
                numbers.append(self._grow((date, has_ad), np.array(new, "<i8"), now))
                dates += [date] * len(numbers[-1])
                missing += [no_ts | of_user | (0 if has_ad else no_ad)] * len(numbers[-1])
            grown = np.concatenate(numbers)
            bans = np.unique(grown[grown[:, count] >= threshold, user])
            if len(bans):
                self._banned.update((np.concatenate([banned, bans]).tobytes(),))
            none = np.zeros(len(bans), "<i8")
            found = {
                "kind": [total] * len(grown) + [ban] * len(bans),
                "batch_id": batch,
                "missing": missing + [no_ts | of_user | no_ad] * len(bans),
                "ts": 0,
                "date": np.array(dates + [None] * len(bans), object),
                "province": None,
                "city": None,
                "user_id": np.concatenate([grown[:, user], bans]),
                "ad_id": np.concatenate([grown[:, ad], none]),
                "click_count": np.concatenate([grown[:, count], none]),
            }
            yield pd.DataFrame(found, columns=columns)

        def _grow(self, day: tuple, new: np.ndarray, now: int) -> np.ndarray:
            """Add new clicks to the totals of a day; the totals that grew, as they are now."""
            held = self._totals.getValue(day)
            old = np.frombuffer(held[0] if held else b"", "<i8").reshape(-1, width)
            if keep_ms is not None:
                old = old[old[:, seen] + keep_ms > now]
            both = np.concatenate([old, new])
            order = np.lexsort((both[:, ad], both[:, user]))
            both = both[order]
            starts = np.flatnonzero(np.append(True, (both[1:, :count] != both[:-1, :count]).any(axis=1)))
            totals = both[starts]
            totals[:, count] = np.add.reduceat(both[:, count], starts)
            totals[:, seen] = np.maximum.reduceat(both[:, seen], starts)
            self._totals.updateValue(day, (totals.tobytes(),))
            return totals[np.maximum.reduceat(order, starts) >= len(old)]

        def close(self) -> None:
            pass

    return BucketClicks()


def screened(clicks: DataFrame, threshold: int, keep_days: float | None = None) -> DataFrame:
    """The streaming ``clicks`` of users who are not banned, with new totals and new bans, as ``LOG`` rows.

    Clicks of the batch in which a user reaches ``threshold`` on one ad and day pass; later batches drop the
    user for every ad. With ``keep_days``, a total is freed when no click has come for it for so many days of the clock:
    each total has its own time, so no click, however dated, can free another one. Bans are kept.
    """
    keep_ms = None if keep_days is None else round(keep_days * 86_400_000)

    def bit(name: str, value: int) -> Column:
        return F.when(F.col(name).isNull(), value).otherwise(0)

    def number(name: str, value: Column) -> Column:
        return F.coalesce(value.cast("bigint"), F.lit(0)).alias(name)

    def known(name: str, value: int, shown: Column) -> Column:
        return F.when(F.col("missing").bitwiseAND(value) == 0, shown).alias(name)

    bucket = F.when(F.col("user_id").isNull(), _NO_USER).otherwise(F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int"))
    packed = clicks.select(
        bucket.alias("bucket"),
        (bit("ts", _NO_TS) + bit("user_id", _NULL_USER) + bit("ad_id", _NO_AD)).alias("missing"),
        number("ts", F.unix_micros("ts")),
        "date",
        "province",
        "city",
        number("user_id", F.col("user_id")),
        number("ad_id", F.col("ad_id")),
    )
    rows = packed.groupBy("bucket").transformWithStateInPandas(
        _screen(threshold, keep_ms),
        outputStructType=_PACKED,
        outputMode="Append",
        timeMode="None" if keep_ms is None else "ProcessingTime",
    )
    return rows.select(
        "kind",
        "batch_id",
        known("ts", _NO_TS, F.timestamp_micros("ts")),
        "date",
        "province",
        "city",
        known("user_id", _NULL_USER, F.col("user_id")),
        known("ad_id", _NO_AD, F.col("ad_id")),
        F.when(F.col("kind") != BAN, F.col("click_count")).alias("click_count"),
    )
