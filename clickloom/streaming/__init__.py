"""Structured Streaming forms of the ad operators."""

from clickloom.streaming.job import AdClickStream, AdQueries, start_ad_stream
from clickloom.streaming.screen import screened
from clickloom.streaming.stateful import (
    ad_stat_stream,
    ad_trend_panes_stream,
    ad_trend_stream,
    batch_counts,
    start_upsert,
)

__all__ = [
    "AdClickStream",
    "AdQueries",
    "ad_stat_stream",
    "ad_trend_panes_stream",
    "ad_trend_stream",
    "batch_counts",
    "screened",
    "start_ad_stream",
    "start_upsert",
]
