"""Conversion along a page flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions import parse_time, ratio


def page_transitions(actions: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Pairs of consecutive pages of a session: (session_id, time, from_page, to_page, transitions).

    ``transitions`` is a weight: add it up per key, a key may come in more than one row. Order inside a
    session is (time, page).

    A session of any size is spread over many tasks. Equal (session, second, page) rows are counted
    first, partly before the shuffle; n of them make n-1 steps from the page to itself. The rest is
    paired inside time slices of ``slice_seconds``, and the slices of a session are linked by their
    first and last row.
    """
    one = F.lit(1).cast("bigint")
    ticks = (
        actions.select(
            "session_id",
            F.unix_seconds(parse_time(F.col("action_time"))).alias("t"),
            "page_id",
        )
        .groupBy("session_id", "t", "page_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("slice", F.floor(F.col("t") / F.lit(slice_seconds)))
    )
    inside = Window.partitionBy("session_id", "slice").orderBy("t", "page_id")
    placed = ticks.withColumns(
        {
            "prev": F.lag("page_id").over(inside),
            "opens": F.lag(one).over(inside).isNull(),
            "closes": F.lead(one).over(inside).isNull(),
        }
    )
    step = F.struct(
        F.col("prev").alias("from_page"), F.col("page_id").alias("to_page"), one.alias("transitions")
    )
    stay = F.struct(
        F.col("page_id").alias("from_page"),
        F.col("page_id").alias("to_page"),
        (F.col("n") - 1).alias("transitions"),
    )
    paired = placed.select("session_id", "t", F.inline(F.array(step, stay))).where(
        F.col("from_page").isNotNull() & (F.col("transitions") > 0)
    )
    # At most two rows per slice. `n > 0` always holds; reading n here keeps the columns of both branches
    # equal, so Spark runs the shuffle into slices once and reuses it.
    edges = placed.where((F.col("opens") | F.col("closes")) & (F.col("n") > 0))
    along = Window.partitionBy("session_id").orderBy("t", "page_id")
    linked = (
        edges.select("session_id", "t", "page_id", "opens")
        .withColumn("from_page", F.lag("page_id").over(along))
        .where(F.col("opens") & F.col("from_page").isNotNull())
        .select("session_id", "t", "from_page", F.col("page_id").alias("to_page"), one.alias("transitions"))
    )
    return paired.unionByName(linked).select(
        "session_id",
        F.timestamp_seconds("t").alias("time"),
        "from_page",
        "to_page",
        "transitions",
    )


def _step_table(spark: SparkSession, steps: Sequence[tuple[int, int, int]]) -> DataFrame:
    """(step, from_page, to_page) rows as a literal table."""
    if not steps:
        return spark.createDataFrame([], "step int, from_page bigint, to_page bigint")
    rows = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(a).cast("bigint").alias("from_page"),
            F.lit(b).cast("bigint").alias("to_page"),
        )
        for step, a, b in steps
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def flow_steps(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """(step, from_page, to_page) of a flow; a flow of one page has no step."""
    pairs = zip(flow, flow[1:])
    return _step_table(spark, [(step, a, b) for step, (a, b) in enumerate(pairs, start=1)])


def match_flow(transitions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Transitions that are a step of the flow; a step the flow repeats matches once.

    The broadcast side has one row per step of the parameter.
    """
    pairs = dict.fromkeys(zip(flow, flow[1:]))
    steps = _step_table(transitions.sparkSession, [(0, a, b) for a, b in pairs])
    return transitions.join(F.broadcast(steps.drop("step")), ["from_page", "to_page"])


def page_split_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """(from_page, to_page, pv) of the flow's steps that occur."""
    return (
        match_flow(page_transitions(actions), flow)
        .groupBy("from_page", "to_page")
        .agg(F.sum("transitions").alias("pv"))
    )


def start_page_pv(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """One row: number of actions on the first page of the flow."""
    return actions.where(F.col("page_id") == flow[0]).agg(F.count(F.lit(1)).alias("pv"))


def page_convert_rate(pv: DataFrame, start: DataFrame, flow: Sequence[int]) -> DataFrame:
    """(step, from_page, to_page, pv, convert_rate), one row per step of the flow.

    The rate is pv(step) / pv(previous step), the first one against the start page. It is no path count:
    it may exceed 1. A step that never occurs has pv 0, a rate against 0 is null. The window runs
    over one row per step.
    """
    steps = flow_steps(pv.sparkSession, flow)
    counted = steps.join(pv, ["from_page", "to_page"], "left").select(
        "step", "from_page", "to_page", F.coalesce("pv", F.lit(0)).alias("pv")
    )
    origin = start.select(
        F.lit(0).alias("step"),
        F.lit(None).cast("bigint").alias("from_page"),
        F.lit(flow[0]).cast("bigint").alias("to_page"),
        "pv",
    )
    previous = F.lag("pv").over(Window.partitionBy().orderBy("step"))
    return (
        counted.unionByName(origin)
        .withColumn("_previous", previous)
        .where(F.col("step") > 0)
        .select(
            "step",
            "from_page",
            "to_page",
            "pv",
            ratio(F.col("pv"), F.col("_previous")).alias("convert_rate"),
        )
    )


def page_convert_rate_string(rates: DataFrame, task_id: int) -> DataFrame:
    """Stored form: one row with ``a_b=rate|…`` in flow order; a null rate is written as ``null``."""
    item = F.concat_ws(
        "",
        F.col("from_page").cast("string"),
        F.lit("_"),
        F.col("to_page").cast("string"),
        F.lit("="),
        F.coalesce(F.col("convert_rate").cast("string"), F.lit("null")),
    )
    # One entry per step of the flow parameter.
    ordered = F.sort_array(F.collect_list(F.struct(F.col("step"), item.alias("item"))))
    return rates.agg(F.array_join(F.transform(ordered, lambda s: s["item"]), "|").alias("r")).select(
        F.lit(task_id).cast("bigint").alias("taskid"), F.col("r").alias("convert_rate")
    )
