"""N-gram Jaccard join by T-occurrence search.

A document's set is its distinct word n-grams, hashed to 64 bits. Equal sets are one class from the start. Which classes must
be searched together is found without loss. A set of n elements links only with sets that hold at least T = ceil(bound * n) of
them, so it must share T elements with others at all: counting that drops most sets. Of those left, two that link meet on one of
the rarest (shared - T + 1) elements that each of them shares, in one order of all elements; passages that many texts
quote come last in it and bring hardly any sets together. The groups that arise are cut into blocks of bounded size, every
pair of blocks is one search, and in it an inverted index is searched by T-occurrence with DivideSkip: the short lists of a
query's elements are merged and counted, the long ones are only probed by binary search for what the merge left, and sets
that reach the required overlap are linked. Elements a search has linked already are not compared again, so a group of
copies costs a spanning tree and not all its pairs.

Defined cases: a text without words, or null, has an empty set and is linked with nothing; with fewer words than n the
whole sequence is its one element; rows with equal ids are one node; rows without id are linked with nothing and
have no component; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.components import EDGES, components
from clickloom.llm.shingles import gram_hashes, mix, word_hashes
from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import stored

BATCH_BYTES = 2_000_000
BLOCK_ELEMENTS = 400_000
SIZED = "doc_id long, n long, h1 long, h2 long"
SENT = "bucket int, counted boolean, data binary"
#: Elements that a task packs at once; one that many documents there have is sent once.
SENT_ELEMENTS = 1_000_000
#: Bytes of an element that travel; the bucket tells more of it. Elements that meet by chance only leave a set in that could go.
ELEMENT_BYTES = 4
#: Elements that make up a bucket, and the least number of buckets.
BUCKET_ELEMENTS = 2_000_000
LEAST_BUCKETS = 64
COUNTS = "doc_id long, shared long"
ELEMENTS = "node long, least long, element long"


def texts_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts of a batch one after the other; a list of them would take the batch's memory again."""
    return (text.as_py() for text in batch["text"].cast(pa.binary()))


def in_chunks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about ``BATCH_BYTES``; a longer text is a run of its own."""
    chunk: list[bytes] = []
    size = 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def shingle_sets(texts: Iterable[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text, words in lower case."""
    for chunk in in_chunks(texts):
        words, counts = word_hashes(chunk, lower=True)
        ends = np.cumsum(counts)
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            own = words[end - count : end]
            yield np.unique(gram_hashes(own, min(n, count))) if count else own


def least_size(percent: int) -> int:
    """Sets smaller than this link with equal sets only."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def set_hash(s: np.ndarray) -> np.uint64:
    return mix(s).sum(dtype=np.uint64)


def link_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all links do: pairs of places in ``sets``, found by DivideSkip search."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    owners = np.repeat(np.arange(len(order)), sizes)
    values, element = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    # The inverted lists one after the other: list number * documents + document.
    codes = np.sort(element.astype(np.int64) * len(order) + owners)
    starts = np.searchsorted(codes, np.arange(len(values) + 1, dtype=np.int64) * len(order))
    lengths = np.diff(starts)
    ends = np.cumsum(sizes)
    open_ = np.ones(len(order), bool)
    links: list[tuple[int, int]] = []

    def search(q: int) -> np.ndarray:
        n = int(sizes[q])
        lists = element[ends[q] - n : ends[q]]
        lists = lists[np.argsort(lengths[lists], kind="stable")]
        least = -(-percent * n // 100)
        short, long = lists[: n - least + 1], lists[n - least + 1 :]
        # Merge the short lists: whoever reaches the overlap is in one of them at least.
        merged = np.sort(np.concatenate([codes[starts[x] : starts[x + 1]] - x * len(order) for x in short]), kind="stable")
        merged = merged[open_[merged]]
        low, high = np.searchsorted(sizes, least), np.searchsorted(sizes, 100 * n // percent, side="right")
        merged = merged[(merged >= low) & (merged < high)]
        near, hits = np.unique(merged, return_counts=True)
        needed = -(-percent * (n + sizes[near]) // (100 + percent))
        # Probe the long lists, the shortest first, and drop what can't reach its overlap any more.
        for at in range(0, len(long), 64):
            if not len(near):
                break
            some = long[at : at + 64]
            wanted = some[:, None] * len(order) + near[None, :]
            place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
            hits = hits + (codes[place] == wanted).sum(axis=0)
            fit = hits + (len(long) - at - len(some)) >= needed
            near, hits, needed = near[fit], hits[fit], needed[fit]
        return near[hits >= needed]

    for seed in range(len(order)):
        if not open_[seed]:
            continue
        open_[seed] = False
        waiting = [seed]
        while waiting:
            q = waiting.pop()
            found = search(q)
            open_[found] = False
            waiting.extend(found.tolist())
            links.extend((int(order[q]), int(order[e])) for e in found)
    return links


def _sized(docs: DataFrame, n: int) -> DataFrame:
    """Size and two hashes of each document's set; equal hashes stand for equal sets."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, first, second = [], [], []
            for s in shingle_sets(texts_of(batch), n):
                counts.append(len(s))
                first.append(set_hash(s))
                second.append(set_hash(s ^ np.uint64(0x5851F42D4C957F2D)))
            columns = [
                batch["doc_id"],
                pa.array(counts, pa.int64()),
                pa.array(np.array(first, np.uint64).view(np.int64)),
                pa.array(np.array(second, np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "h1", "h2"])

    return docs.mapInArrow(measure, SIZED)


def _packed(owners: np.ndarray, elements: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``SENT`` rows of (owner, element) pairs: one row for each bucket, and one of what is counted here already.

    An element that several owners have here is shared: they are counted at once, and it is sent a single time, without
    owner. A row holds the number of pairs, the pairs' elements and owners, and the elements without owner.
    """
    order = np.argsort(elements, kind="stable")
    owners, elements = owners[order], elements[order]
    first = np.append(True, elements[1:] != elements[:-1])
    alone = first & np.append(first[1:], True)
    counted = owners[~alone]
    known = ~alone[first]
    owners, elements = owners[first], elements[first]
    bucket = ((elements >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    # Neighbouring ids differ by little, which compresses.
    order = np.lexsort((owners, known, bucket))
    owners, elements, known, bucket = owners[order], elements[order], known[order], bucket[order]
    low = elements.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    data = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
        pairs = a + int(np.count_nonzero(~known[a:b]))
        steps = np.diff(owners[a:pairs], prepend=0).astype("<i8")
        data.append(np.array([pairs - a], "<i8").tobytes() + low[a:pairs].tobytes() + steps.tobytes() + low[pairs:b].tobytes())
    keys = bucket[starts].tolist()
    kinds = [False] * len(keys)
    if len(counted):
        docs, counts = np.unique(counted, return_counts=True)
        keys.append(int(docs[0] % buckets))
        kinds.append(True)
        data.append(np.stack([docs, counts]).astype("<i8").tobytes())
    columns = [pa.array(keys, pa.int32()), pa.array(kinds, pa.bool_()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "counted", "data"])


def _holders(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The owners in all rows of one bucket that share an element, and the number of elements each one shares."""
    low, owners = [], []
    for raw in parts:
        pairs = int(np.frombuffer(raw, "<i8", 1)[0])
        end = 8 + pairs * (ELEMENT_BYTES + 8)
        rest = (len(raw) - end) // ELEMENT_BYTES
        low.append(np.frombuffer(raw, "<u4", pairs, 8))
        owners.append(np.cumsum(np.frombuffer(raw, "<i8", pairs, 8 + pairs * ELEMENT_BYTES)))
        low.append(np.frombuffer(raw, "<u4", rest, end))
        owners.append(np.zeros(rest, np.int64))
    known = np.repeat(np.arange(len(low)) % 2 == 1, [len(x) for x in low])
    low, owners = np.concatenate(low), np.concatenate(owners)
    order = np.argsort(low, kind="stable")
    low, owners, known = low[order], owners[order], known[order]
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    sizes = np.diff(np.append(starts, len(low)))
    shared = np.repeat((sizes > 1) | np.logical_or.reduceat(known, starts), sizes)
    return np.unique(owners[shared & ~known], return_counts=True)


def _shared_counts(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """(doc_id, shared): of how many elements of a document's set another document has them too, never too few."""
    least = least_size(percent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, found, size = [], [], 0

        def rows() -> pa.RecordBatch:
            ids = np.repeat(np.array(owners, np.int64), [len(s) for s in found])
            return _packed(ids, np.concatenate(found), buckets)

        for batch in batches:
            sets = shingle_sets(texts_of(batch), n)
            for doc, s in zip(batch["doc_id"].to_pylist(), sets, strict=True):
                if len(s) < least:
                    continue
                owners.append(doc)
                found.append(s)
                size += len(s)
                if size >= SENT_ELEMENTS:
                    yield rows()
                    owners, found, size = [], [], 0
        if found:
            yield rows()

    def counts(found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(found[0].astype(np.int64)), pa.array(found[1].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "shared"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for key, counted, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if counted:
                    yield counts(tuple(np.frombuffer(raw, "<i8").reshape(2, -1)))
                    continue
                if key != bucket and parts:
                    yield counts(_holders(parts))
                    parts = []
                bucket = key
                parts.append(raw)
        if parts:
            yield counts(_holders(parts))

    sent = docs.mapInArrow(send, SENT)
    found = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, COUNTS)
    return found.groupBy("doc_id").agg(F.sum("shared").alias("shared"))


def _elements(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, least, element) of all elements; ``least`` of them are in every set that links, the node is the set's hash."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in shingle_sets(texts_of(batch), n):
                node = np.full(len(s), set_hash(s), np.uint64).view(np.int64)
                least = np.full(len(s), -(-percent * len(s) // 100), np.int64)
                columns = [pa.array(node), pa.array(least), pa.array(s.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "least", "element"])

    return docs.mapInArrow(rows, ELEMENTS)


def _meetings(elements: DataFrame) -> DataFrame:
    """Edges (a, b) from the sets to those of their rarest shared elements on which any two that link meet."""
    elements = stored(elements, "elements")
    common = elements.groupBy("element").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    own = Window.partitionBy("node")
    ranked = elements.join(common, "element").select(
        "node",
        "least",
        "element",
        F.row_number().over(own.orderBy("holders", "element")).alias("place"),
        F.count(F.lit(1)).over(own).alias("shared"),
    )
    met = ranked.where("place <= shared - least + 1")
    return met.select(F.col("node").alias("a"), F.xxhash64("element").alias("b"))


def _blocks(classes: DataFrame, labels: DataFrame, block_elements: int) -> DataFrame:
    """(doc_id, units): the searches that the first document of each class takes part in."""
    grouped = classes.withColumn("node", F.col("h1")).join(labels, "node").select("doc_id", "n", "label")
    sizes = grouped.groupBy("label").agg(F.sum("n").alias("elements"), F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("elements") / block_elements)
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = grouped.join(sizes.where("members > 1").select("label", blocks.alias("blocks")), "label")
    placed = placed.select("doc_id", "label", "blocks", own.alias("own"), other.alias("other"))
    # A block meets every other block, which covers its own pairs too; a single block meets itself.
    placed = placed.where("blocks = 1 or own <> other")
    unit = F.xxhash64("label", F.least("own", "other"), F.greatest("own", "other"))
    return placed.groupBy("doc_id").agg(F.collect_set(unit).alias("units"))


def _searched(docs: DataFrame, blocks: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) found in all searches."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, group = None, [], []

        def found() -> pa.RecordBatch:
            links = link_forest(group, percent) if len(group) > 1 else []
            a = [ids[i] for i, _ in links]
            b = [ids[j] for _, j in links]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            sets = shingle_sets(texts_of(batch), n)
            for key, doc, own in zip(batch["unit"].to_pylist(), batch["doc_id"].to_pylist(), sets, strict=True):
                if key != unit:
                    yield found()
                    unit, ids, group = key, [], []
                ids.append(doc)
                group.append(own)
        yield found()

    # Texts travel, not sets: they compress, hashes do not.
    rows = docs.join(blocks, "doc_id").select(F.explode("units").alias("unit"), "doc_id", "text")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(search, EDGES)


def jaccard_components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    block_elements: int = BLOCK_ELEMENTS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``words``-grams; the component
    is the smallest id reachable by links. A group of more than ``block_elements`` shingles is searched in blocks of about
    that many, every two of them in one task: larger blocks take more memory there, and send a text to fewer searches.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    sized = stored(_sized(rows, words), "sets")
    known = sized.where("doc_id is not null and n > 0").groupBy("h1", "h2", "n")
    classes = stored(known.agg(F.min("doc_id").alias("doc_id")), "classes")
    # Only the first document of a class is searched, however many copies it has.
    firsts = rows.join(classes.select("doc_id").distinct(), "doc_id", "left_semi")
    # One number comes to the driver; it bounds the buckets.
    elements = classes.agg(F.sum("n")).first()[0] or 0
    shared = _shared_counts(firsts, words, percent, max(LEAST_BUCKETS, elements // BUCKET_ELEMENTS))
    enough = classes.join(shared, "doc_id").where(100 * F.col("shared") >= percent * F.col("n"))
    alike = stored(enough.select("doc_id").distinct(), "alike")
    meetings = _meetings(_elements(rows.join(alike, "doc_id", "left_semi"), words, percent))
    blocks = _blocks(classes, components(meetings), block_elements)
    links = components(_searched(rows, blocks, words, percent))
    joined = classes.join(links, F.col("doc_id") == F.col("node"), "left").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("label", "doc_id").alias("component")
    )
    # The last key follows from the others; being one of its own, it lets adaptive execution split a hot class.
    same = (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
    same = same & (F.xxhash64("h1", "h2") == F.xxhash64("c1", "c2")) & (F.col("n") > 0)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    found = sized.join(joined, same, "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
