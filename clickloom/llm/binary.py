"""Token ids as binary files with Elias-Fano document boundaries.

A shard file is one concatenated id array (unsigned 16- or 32-bit, little-endian), then the documents' ends
and the documents' ids as Elias-Fano lists, then a footer. Shards are ranges of the document id, ascending within and
across files. Every attempt of a task writes a file of its own name; the table of shards lists those of the attempts that
counted, so a lost or doubled attempt leaves an unlisted file and nothing else.

Defined cases: a null or empty text is the end id alone; rows without id come first, and read back as null; rows with
equal ids keep no order among themselves; an empty table has no shard; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.elias_fano import EliasFano
from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import block_starts, stored
from clickloom.llm.tokens import encoder
from clickloom.streaming.workdir import work_dir

SHARDS = "shard int, path string, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
READ_DOCS = 4096


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ShardReader:
    """Random access to the documents of one shard file."""

    def __init__(self, uri: str):
        files, path = _open(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.meta = json.loads(self.file.read_at(tail, size - 8 - tail))
        self.dtype = np.dtype(self.meta["dtype"])
        at = self.meta["n_ids"] * self.dtype.itemsize
        self.ends = EliasFano.from_bytes(self.file.read_at(self.meta["ends"], at))
        self.ids = EliasFano.from_bytes(self.file.read_at(self.meta["docs"], at + self.meta["ends"]))

    def documents(self, i: int, count: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Document ids, the bounds (one more) and the token ids of ``count`` documents from place ``i``."""
        first = int(self.ends.select(i - 1)[0]) if i else 0
        bounds = np.concatenate([[first], self.ends.select(i, count).astype(np.int64)])
        width = self.dtype.itemsize
        raw = self.file.read_at(int(bounds[-1] - first) * width, first * width)
        null = self.meta["n_null"]
        ids = [None] * max(0, min(count, null - i))
        rest = self.ids.select(max(i - null, 0), count - len(ids))
        return ids + [int(x) + self.meta["least"] for x in rest], bounds, np.frombuffer(raw, self.dtype)

    def close(self) -> None:
        self.file.close()


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the shard files below ``path``, a folder all executors share, and return the table of shards."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], coder.dtype).tobytes()
        lengths: list[int] = []
        names: list[np.ndarray] = []
        n_null, out, uri = 0, None, f"{path}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        for batch in batches:
            if out is None:
                files, at = _open(uri)
                files.create_dir(at.rpartition("/")[0], recursive=True)
                out = files.open_output_stream(at)
            for ids in coder.encode(batch["text"]):
                out.write(ids + end)
                lengths.append(len(ids) // coder.dtype.itemsize + 1)
            n_null += batch["doc_id"].null_count
            names.append(batch["doc_id"].drop_null().to_numpy())
        if out is None:
            return
        keys = np.concatenate(names)
        least = int(keys[0]) if len(keys) else 0
        ends = EliasFano.of(np.cumsum(lengths)).to_bytes()
        ids = EliasFano.of(keys.astype(np.uint64) - np.uint64(least % (1 << 64))).to_bytes()
        meta = {"dtype": coder.dtype.str, "n_docs": len(lengths), "n_ids": sum(lengths), "n_null": n_null}
        meta |= {"least": least, "ends": len(ends), "docs": len(ids)}
        foot = json.dumps(meta).encode()
        out.write(ends + ids + foot + len(foot).to_bytes(8, "little"))
        out.close()
        values = [[shard], [uri], [len(lengths)], [sum(lengths)]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
            names=["shard", "path", "n_docs", "n_ids"],
        )

    return stored(rows.mapInArrow(write, SHARDS), "shards")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; ``start`` counts all ids before it."""
    placed = shards.join(block_starts(shards, "shard", "n_ids"), "shard").select("path", "n_docs", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n_docs, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = ShardReader(path)
                for i in range(0, n_docs, READ_DOCS):
                    ids, bounds, tokens = shard.documents(i, min(READ_DOCS, n_docs - i))
                    wide = tokens.astype("<u4")
                    at = bounds - bounds[0]
                    sums = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
                    columns = [ids, start + bounds[:-1], np.diff(bounds), sums]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                shard.close()

    # A task for each file: only the number of files is fetched.
    return placed.repartition(max(1, shards.count())).mapInArrow(read, ROWS)


def exported(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write all documents below the cluster's shared folder and read the files back."""
    path = work_dir(docs.sparkSession, "shard-files")
    return read_tokens(write_tokens(docs, path, tokenizer, **options))
