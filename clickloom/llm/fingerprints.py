"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps the sums of c[i] * B**i over every prefix of a text, modulo a prime. The difference of two prefixes
is a span's hash, so any two spans compare in constant time, and the longest common extension of two places is
found by binary search. A fingerprint is made of the smallest hashes of all spans of ``SPAN`` code points; the share
that two fingerprints have in common estimates the share of spans that two texts have in common.

Defined cases: a null text is empty and has an empty fingerprint; two empty fingerprints are alike (1.0), an empty one and
another are not (0.0); a text shorter than a span is one span; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN = 16
KEPT = 64
ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)


class _Powers:
    """Powers of a base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _grow(powers: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(powers) < n:
            powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), PRIME)) % PRIME])
        return powers

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.up, self.down = self._grow(self.up, self.base, n), self._grow(self.down, self.inverse, n)
        return self.up, self.down


_POWERS = [_Powers(b) for b in BASES]


class PrefixHash:
    """Modular prefix sums of a text's code points under ``len(BASES)`` bases."""

    def __init__(self, codes: np.ndarray, bases: int = len(BASES)):
        self.n = len(codes)
        terms = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for powers in _POWERS[:bases]:
            up, _ = powers.of(self.n + 1)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms * up[: self.n] % PRIME, out=sums[1:])
            self.sums.append(sums % PRIME)

    def spans(self, starts: np.ndarray, length: int, base: int = 0) -> np.ndarray:
        """The hashes of the spans of ``length`` at ``starts``, comparable across places and texts."""
        sums, (_, down) = self.sums[base], _POWERS[base].of(self.n + 1)
        return (sums[starts + length] + np.uint64(PRIME) - sums[starts]) % PRIME * down[starts] % PRIME

    def equal(self, a: int, other: PrefixHash, b: int, length: int) -> bool:
        """Whether the spans of ``length`` at ``a`` here and at ``b`` in ``other`` are equal."""
        at, to = np.array([a]), np.array([b])
        return all(
            self.spans(at, length, k)[0] == other.spans(to, length, k)[0] for k in range(len(self.sums))
        )

    def common(self, a: int, other: PrefixHash, b: int) -> int:
        """Length of the longest common extension of place ``a`` here and ``b`` in ``other``."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(a, other, b, middle) else (low, middle - 1)
        return low


def codes_of(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def sketch(hashes: PrefixHash) -> np.ndarray:
    """The ``KEPT`` smallest scrambled span hashes, ascending, each once."""
    if not hashes.n:
        return np.zeros(0, np.uint32)
    length = min(SPAN, hashes.n)
    found = hashes.spans(np.arange(hashes.n - length + 1), length)
    mixed = (found * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    while len(mixed) > KEPT:
        # Repeated spans can fill the smallest places, so the cut is by value and widened where needed.
        cut = np.partition(mixed, 4 * KEPT)[4 * KEPT] if len(mixed) > 4 * KEPT else mixed.max()
        least = np.unique(mixed[mixed <= cut])
        if len(least) >= KEPT or cut == mixed.max():
            return least[:KEPT].astype(np.uint32)
        mixed = np.unique(mixed)
    return np.unique(mixed).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among the ``KEPT`` smallest of both sketches."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:KEPT]
    return float(len(np.intersect1d(np.intersect1d(a, b), union)) / len(union))


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def _ordered(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (key, doc_id, text) in ranges of the descending key, each followed by the first row of the next range.

    The ranges' borders and first keys are fetched, a few numbers for each of at most ``buckets`` ranges.
    """
    shares = [i / buckets for i in range(1, buckets)]
    cuts = rows.select(F.col("key").cast("double").alias("key")).approxQuantile("key", shares, 0.25 / buckets)
    # Without rows there are no cuts; any border will do.
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(
        rows.withColumn("place", F.col("key").cast("double"))
    )
    rows = rows.select(F.col("bucket").cast("int").alias("bucket"), "key", "doc_id", "text")
    firsts = rows.groupBy("bucket").agg(F.max("key").alias("key")).collect()
    firsts = sorted(((r["bucket"], r["key"]) for r in firsts), reverse=True)
    before = {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}
    if not before:
        return rows.withColumn("tail", F.lit(False))
    pairs = [F.lit(x) for pair in before.items() for x in pair]
    heads = rows.where(F.col("key").isin(list(before))).withColumn(
        "bucket", F.element_at(F.create_map(*pairs), F.col("key"))
    )
    both = rows.withColumn("tail", F.lit(False)).unionByName(heads.withColumn("tail", F.lit(True)))
    return both.repartition("bucket").sortWithinPartitions("bucket", "tail", F.desc("key"), "text")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next text.

    Documents follow each other by descending id, rows without id last, rows with equal ids by text; the
    first follows the last. The edited text has its last third replaced by as many first code points of the next one.
    """
    ship_package(docs.sparkSession)
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), least).alias("key"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def finish(row: tuple, following: tuple) -> list:
        _, _, doc, body, hashes, own = row
        third = hashes.n // 3
        edited = body[: hashes.n - third] + following[3][:third]
        other = PrefixHash(codes_of(edited))
        new = sketch(other)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(own, new), likeness(own, following[5])
        return [doc, hashes.n, digest, _hex(own), _hex(new), *near, hashes.common(0, other, 0)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            for bucket, doc, body, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == bucket and held[1] and tail:
                    continue
                hashes = PrefixHash(codes_of(body))
                row = (bucket, tail, doc, body, hashes, sketch(hashes))
                if held is not None and held[0] == bucket and not held[1]:
                    out.append(finish(held, row))
                held = row
            kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.int64()]
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in ROWS.split(", ")],
            )

    ordered = _ordered(rows, 4 * parts).select("bucket", "doc_id", "text", "tail")
    return ordered.mapInArrow(walk, ROWS)
