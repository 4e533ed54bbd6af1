"""Concatenate and cut: documents laid end to end over fixed windows.

The first pass encodes every document once, counts the ids before it in its input split and writes both. Prefix sums
over the splits' totals give global offsets without sorting or shuffling a text. The second pass cuts each document at
the window borders; a document that crosses a border has a record on either side.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they come; an empty
table gives no piece; other columns are not read, whatever their names. A rerun that reads other splits may order the documents otherwise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import block_starts, stored
from clickloom.llm.tokens import BATCH_BYTES, byte_sizes, encoder, in_slices

#: Bytes of ids that are cut at once; a batch of documents may hold many times as many.
CUT_BYTES = 2_000_000
TOKENS = "part int, before long, doc_id long, ids binary, n long"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of at most ``most`` bytes of ``column``; a larger row is a batch of its own."""
    for batch in batches:
        for begin, end in in_slices(byte_sizes(batch[column]), most):
            yield batch.slice(begin, end - begin)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """(part, before, doc_id, ids, n): ids of each document with the end id, and the ids before it in its part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], coder.dtype).tobytes()
        width = coder.dtype.itemsize
        for batch in sliced(batches, "text", BATCH_BYTES):
            ids = [x + end for x in coder.encode(batch["text"])]
            counts = np.array([len(x) // width for x in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(starts),
                    batch["doc_id"],
                    pa.array(ids, pa.binary()),
                    pa.array(counts),
                ],
                names=["part", "before", "doc_id", "ids", "n"],
            )

    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.mapInArrow(encode, TOKENS)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents over sequences of ``length`` ids; the last sequence alone has room left.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit integers.
    """
    tokens = stored(tokenized(docs, tokenizer, end_id, doc_id, text), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    placed = tokens.join(block_starts(totals, "part", "total"), "part").select(
        "doc_id", "ids", "n", (F.col("start") + F.col("before")).alias("at")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer).dtype
        for batch in sliced(batches, "ids", CUT_BYTES):
            out: dict[str, list] = {f.split()[0]: [] for f in PIECES.split(", ")} | {"ids": []}
            columns = [batch[c].to_pylist() for c in ("doc_id", "ids", "n", "at")]
            for doc, raw, n, at in zip(*columns, strict=True):
                ids = np.frombuffer(raw, dtype).astype("<u4")
                cuts = [0, *range(length - at % length, n, length), n]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    piece = ids[a:b].tobytes()
                    values = (doc, a, b - a, zlib.crc32(piece), n, (at + a) // length, (at + a) % length, piece)
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    return placed.mapInArrow(cut, f"{PIECES}, ids binary")
