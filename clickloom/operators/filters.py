"""Parameterised predicates. A predicate whose parameter is absent passes every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.params import TaskParams


def between_param(col: Column, low: int | None, high: int | None) -> Column:
    """``low <= col <= high``; off unless both bounds are given."""
    if low is None or high is None:
        return F.lit(True)
    return col.between(low, high)


def _tokens(csv: str) -> list[str]:
    return [token for token in csv.split(",") if token]


def any_of(col: Column, csv: str | None) -> Column:
    """``col`` equals one of the comma-separated values."""
    if not csv:
        return F.lit(True)
    return col.isin(_tokens(csv))


def any_of_list(items: Column, csv: str | None) -> Column:
    """The text array ``items`` holds one of the comma-separated values."""
    if not csv:
        return F.lit(True)
    wanted = _tokens(csv)
    if not wanted:
        return F.lit(False)
    return F.arrays_overlap(items, F.array(*[F.lit(token) for token in wanted]))


def equal_param(col: Column, value: str | None) -> Column:
    """``col`` equals ``value``."""
    if not value:
        return F.lit(True)
    return col == value


def user_filter(params: TaskParams) -> Column:
    """The four parameters about the user."""
    return (
        between_param(F.col("age"), params.start_age, params.end_age)
        & any_of(F.col("professional"), params.professionals)
        & any_of(F.col("city"), params.cities)
        & any_of(F.col("sex"), params.sex)
    )


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions (joined with their users) that pass every given parameter."""
    return sessions.where(
        user_filter(params)
        & any_of_list(F.col("search_keywords"), params.keywords)
        & any_of_list(F.col("click_category_ids"), params.category_ids)
    )
