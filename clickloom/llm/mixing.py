"""Mixing sources to target weights with Spark functions only.

Every row gets a hash-random key. Keys are cut into equal ranges; the sizes of all ranges of a source are
added up first, then the rows inside each range, which gives every row the tokens before it in its source's random
order without sorting a source in one task. A source's budget is cut exactly: whole epochs for every row, the rest along
the random order, the row at the cut in part.

Defined cases: a null source is a source of its own, last in order; a null size is 0; rows with equal keys
are ordered by id, equal rows share a cut in any order; an empty table gives an empty table; sources of size 0 get a target of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.columns import packed, unpacked, word_count, words

RANGE_DIGITS = 4


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3
) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in order, null last, get ``weights`` in turn and share the sum of all sizes. A target stops at
    ``most`` times the source's size and the excess goes to the others by weight. With sources in ascending order of
    bound per weight, the common level is the largest of (total - bounds before) / (weights from here on).
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    bound = most * F.col("source_size")
    rows = by_source.withColumn("weight", weight).withColumn("bound", bound)
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.asc_nulls_last("source"))
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("level", (everything - before) / left)
    top = F.max("level").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("bound").cast("double"), top * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = (5, 2, 1),
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``: the words the mix takes of each row."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    rows = packed(
        docs,
        source=F.col(source),
        id=F.col(doc_id),
        size=F.coalesce(size.cast("long"), F.lit(0)),
        key=key,
    ).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("size"))
    targets = source_targets(ranges.select("source", "size"), weights, most)
    in_source = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("source").alias("s"),
        F.col("range").alias("r"),
        F.coalesce(F.sum("size").over(in_source), F.lit(0)).alias("start"),
    )
    starts = starts.join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    in_range = (
        Window.partitionBy("source", "range")
        .orderBy("key", "id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
    placed = placed.join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    )
    budget = F.floor(F.col("target") + 0.5)
    whole = F.coalesce(F.call_function("div", budget, F.nullif("source_size", F.lit(0))), F.lit(0))
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("inner")))
    return unpacked(
        placed,
        docs.columns,
        size=F.col("size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        taken=whole * F.col("size") + part,
    )


def mixed_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The mix as documents: a row for every whole epoch of a text, and one with the first words of a cut text.

    Rows without a word are taken by no mix and are left out.
    """
    rows = packed(docs, t=F.col(text), source=F.col(options.pop("source", "source")), doc_id=F.col(options.pop("doc_id", "doc_id")))
    mixed = mix(rows, word_count(F.col("t")), **options).where("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size"))
    mixed = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    left = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    cut = F.array_join(F.slice(words(F.col("t")), 1, F.greatest(left, F.lit(0)).cast("int")), " ")
    mixed = mixed.withColumn("t", F.when(left < F.col("size"), cut).otherwise(F.col("t")))
    changed = {text: F.col("t")}
    if n_chars in docs.columns:
        changed[n_chars] = F.length("t").cast("long")
    return unpacked(mixed, docs.columns, **changed).select(*docs.columns)
