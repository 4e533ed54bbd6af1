"""Column helpers shared by the operators made of Spark functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of ``text`` in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def packed(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` folded into one struct column ``row`` beside ``columns``, so no name can clash."""
    return rows.select(F.struct(*rows.columns).alias("row"), *(c.alias(n) for n, c in columns.items()))


def unpacked(rows: DataFrame, names: list[str], **columns: Column) -> DataFrame:
    """The columns ``names`` of ``row``, less those replaced by ``columns``, then ``columns``."""
    new = {name.lower() for name in columns}
    old = [F.col("row")[name].alias(name) for name in names if name.lower() not in new]
    return rows.select(*old, *(c.alias(n) for n, c in columns.items()))
