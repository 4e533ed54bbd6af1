"""Readers and scans."""

from clickloom.sources.actions import actions_by_date, click_actions
from clickloom.sources.adlog import AD_LOG, ad_log_rejects, ad_stream, parse_ad_log
from clickloom.sources.jdbc import read_jdbc

__all__ = [
    "AD_LOG",
    "actions_by_date",
    "ad_log_rejects",
    "ad_stream",
    "click_actions",
    "parse_ad_log",
    "read_jdbc",
]
