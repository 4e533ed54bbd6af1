"""Audit of filters in every order, by decision diagrams over their failures.

Every document becomes a mask of the filters it fails; documents are added up by part, mask and label, and each part's few
numbers become a decision diagram: one level for each filter, equal branches shared, every node weighted by the documents
below it. Swapping two adjacent levels changes the order of two filters and rebuilds only their nodes, so a walk over
all orders by such swaps meets every order once. In an order, the path of documents that pass everything gives the steps: the node's passing branch
holds what a filter keeps, its failing branch what it removes.

Defined cases: a null text is empty; a null source is the part of empty text; a document without label is neither good nor
toxic, one with several labels is good or toxic if any of them says so; rows with equal ids are no copies of each other,
rows without id have no smaller id, are nobody's original and have no label; an empty table gives no part; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.columns import let, words
from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import stored

#: What a document counts for: itself, its good label, its toxic label.
Weight = tuple[int, int, int]
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


# --- decision diagrams --------------------------------------------------------


class Diagram:
    """A weighted decision diagram of failures: a node is (passing branch, failing branch), a leaf is a weight.

    Nodes with equal branches on a level are one node; ``weight`` holds the sum below each node. Levels are never skipped, so a
    path's weight needs no correction.
    """

    def __init__(self, filters: str, masks: dict[int, Weight]):
        #: The filters from the root down.
        self.order = list(filters)
        self.nodes: dict[tuple[int, int], int] = {}
        self.branches: list[tuple[int, int] | None] = []
        self.weight: list[Weight] = []
        self.leaves: dict[Weight, int] = {}
        n = len(filters)
        level = [self._leaf(masks.get(m, (0, 0, 0))) for m in range(1 << n)]
        # The upper half of the masks fails the last filter, which becomes the lowest level.
        for _ in range(n):
            half = len(level) // 2
            level = [self._node(a, b) for a, b in zip(level[:half], level[half:], strict=True)]
        (self.root,) = level

    def _new(self, branches: tuple[int, int] | None, weight: Weight) -> int:
        self.branches.append(branches)
        self.weight.append(weight)
        return len(self.branches) - 1

    def _leaf(self, weight: Weight) -> int:
        if weight not in self.leaves:
            self.leaves[weight] = self._new(None, weight)
        return self.leaves[weight]

    def _node(self, passing: int, failing: int) -> int:
        found = self.nodes.get((passing, failing))
        if found is None:
            both = zip(self.weight[passing], self.weight[failing], strict=True)
            found = self._new((passing, failing), tuple(a + b for a, b in both))
            self.nodes[passing, failing] = found
        return found

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                passing, failing = self.branches[node]
                if depth < level:
                    done[node] = self._node(rebuilt(passing, depth + 1), rebuilt(failing, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.branches[passing], self.branches[failing]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """(filter, kept, removed) along the path of documents that pass everything."""
        node = self.root
        for name in self.order:
            passing, failing = self.branches[node]
            yield name, self.weight[passing], self.weight[failing]
            node = passing


@lru_cache(maxsize=4)
def all_orders(n: int) -> list[int]:
    """Levels to swap with the next one, so that a walk from the first order meets every order of ``n`` things once."""
    if n < 2:
        return []
    inner = all_orders(n - 1)
    out: list[int] = []
    # The last thing moves through all places, then the others make their next step.
    for i in range(len(inner) + 1):
        down = i % 2 == 0
        out.extend(range(n - 2, -1, -1) if down else range(n - 1))
        if i < len(inner):
            out.append(inner[i] + 1 if down else inner[i])
    return out


def audit(filters: str, masks: dict[int, Weight]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order of ``filters``.

    Bit i of a mask stands for a failure of filter i.
    """
    fails = {f: sum(w[0] for m, w in masks.items() if m >> i & 1) for i, f in enumerate(filters)}
    alone = {f: masks.get(1 << i, (0, 0, 0))[0] for i, f in enumerate(filters)}
    diagram = Diagram(filters, masks)
    found, total = [], dict.fromkeys(filters, 0)
    for level in [None, *all_orders(len(filters))]:
        if level is not None:
            diagram.swap(level)
        order = "".join(diagram.order)
        for step, (name, kept, removed) in enumerate(diagram.steps(), 1):
            total[name] += removed[0]
            found.append((order, step, name, kept[0], *removed))
    return [
        (order, step, kept, removed, fails[name] - removed, alone[name], good, toxic, total[name])
        for order, step, name, kept, removed, good, toxic in found
    ]


# --- failures -----------------------------------------------------------------


def document_failures(text: Column) -> Column:
    """Bits 0 to 3 of a text's mask: few words, few distinct words, many capitals, a sign."""
    own = F.coalesce(text, F.lit(""))

    def bits(found: Column) -> Column:
        n = F.size(found).cast("long")
        capitals = F.length(own) - F.length(F.translate(own, string.ascii_uppercase, ""))
        tests = [
            n < 200,
            100 * F.size(F.array_distinct(found)).cast("long") < 50 * n,
            100 * capitals.cast("long") > 2 * F.length(own).cast("long"),
            own.rlike("[#$%&*|]"),
        ]
        return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))

    return let(words(text), bits)


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(part, mask, docs, good, toxic): documents of each part by the filters they fail, A to E as bits 0 to 4.

    E looks at a 256-bit digest of the text. Copies need no list of their holders: the least id of each digest, found before
    anything is shuffled, meets the rows again by digest and id.
    """
    rows = stored(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
            document_failures(F.col(text)).alias("mask"),
            F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        ),
        "failures",
    )
    firsts = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.select("digest", "doc_id", F.lit(True).alias("first"))
    marked = rows.join(firsts, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = marked.select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    labelled = marked.join(marks.where("doc_id is not null"), "doc_id", "left")
    return labelled.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def audit_filters(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """The audit of every part of ``counts`` (part, mask, docs, good, toxic): one row for each order and step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch["part"].to_pylist(), batch["masks"].to_pylist(), strict=True):
                weights = {m["mask"]: (m["docs"], m["good"], m["toxic"]) for m in masks}
                columns = list(zip(*((part, *row) for row in audit(filters, weights)), strict=True))
                kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[f.split()[0] for f in RESULT.split(", ")],
                )

    ship_package(counts.sparkSession)
    # One row a part, with at most one entry for every mask.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("masks"))
    return parts.mapInArrow(run, RESULT)
