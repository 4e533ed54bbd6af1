"""Clickstream and ad-click analytics as DataFrame-to-DataFrame operators."""
