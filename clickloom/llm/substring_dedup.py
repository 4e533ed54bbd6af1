"""Substring deduplication: windows of words that an earlier document has as well.

Every window of 13 words belongs to the smallest of its 5-word hashes, its anchor, so equal windows have equal anchors.
Anchors of one document only are dropped; runs of windows around the others are the segments that are searched. A shard gets all
segments of its anchors and builds an FM-index over their words, the segments' first documents beside it; backward
search of every window gives the range of its occurrences, and the least document of that range decides. Segments are
indexed once, however many documents hold them; an anchor of very many documents is split into its windows, which
then are anchors of their own. No shard sees more than ``SHARD_WORDS`` words at once.

Defined cases: a null or empty text has no words; shorter texts than a window keep all words; rows with equal ids
are one document and remove nothing from each other; rows without id keep all words; an empty table gives an empty
table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.fm_index import FMIndex
from clickloom.llm.ngram_join import in_chunks
from clickloom.llm.shingles import gram_hashes, mix, place_hashes, word_places
from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import stored

WINDOW = 13
ANCHOR = 5
#: Anchors of more documents are split into their windows.
COMMON = 1000
SHARD_WORDS = 1_000_000
SEEN = 1_000_000
PATTERNS = 1 << 18
SEGMENT_PLACES = "key long, content long, doc_id long, start int"
SEGMENT_WORDS = "key long, content long, doc_id long, words binary"
#: All white space as spaces.
_PLAIN = bytes.maketrans(b"\t\n\v\f\r", b" " * 5)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch["text"].cast(pa.binary()).to_pylist()


class Windows:
    """All windows of some texts with the hash of each one's anchor, in order."""

    def __init__(self, texts: list[bytes]):
        self.raw, self.starts, self.ends, counts = word_places(texts)
        self.words = place_hashes(self.raw, self.starts, self.ends, lower=False)
        self.begin = np.cumsum(counts) - counts
        sizes = np.maximum(counts - WINDOW + 1, 0)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.at = np.arange(len(self.owner)) + np.repeat(self.begin - (np.cumsum(sizes) - sizes), sizes)
        grams = gram_hashes(self.words, ANCHOR)
        # The least of 2, 4, ... neighbours is that of two halves, and a window's that of two such runs that cover it.
        span, least, run = WINDOW - ANCHOR + 1, grams, 1
        while 2 * run <= span:
            least, run = np.minimum(least[:-run], least[run:]), 2 * run
        count = max(0, len(grams) - span + 1)
        least = np.minimum(least[:count], least[span - run :][:count])
        self.anchor = least[self.at]
        # The first of the least grams changes when it falls out or the new last gram is less.
        moved = np.ones(count, bool)
        moved[1:] = (grams[:count] == least)[:-1] | (grams[span:] < least[:-1])
        self.moved = moved[self.at]

    def new(self) -> np.ndarray:
        """Which windows have another anchor place than the window before."""
        return self.moved | np.append(True, self.owner[1:] != self.owner[:-1])[: len(self.owner)]

    def hashes(self, places: np.ndarray) -> np.ndarray:
        """Hashes of the windows at ``places``."""
        total = np.zeros(len(places), np.uint64)
        for k in range(WINDOW):
            total = mix(total + self.words[places + k] + np.uint64(k + 1))
        return total

    def texts(self, starts: np.ndarray, stops: np.ndarray) -> Iterator[bytes]:
        """The words from the windows at ``starts`` to those at ``stops``, joined by one space."""
        raw = self.raw.translate(_PLAIN)
        for a, b in zip(self.starts[starts].tolist(), self.ends[stops + WINDOW - 1].tolist(), strict=True):
            part = raw[a:b]
            yield b" ".join(part.split()) if b"  " in part else part


def _cut_windows(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], Windows]]:
    """(place of the first text in the batch, texts, windows) for chunks of a batch."""
    done = 0
    texts = _texts(batch)
    if "nameless" in batch.schema.names:
        texts = [b"" if skip else text for skip, text in zip(batch["nameless"].to_pylist(), texts, strict=True)]
    for chunk in in_chunks(texts):
        yield done, chunk, Windows(chunk)
        done += len(chunk)


def _shared(docs: DataFrame) -> DataFrame:
    """(doc_id, anchor, common): anchors of two documents or more, and whether more than ``COMMON`` hold it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for done, _, found in _cut_windows(batch):
                new = found.new()
                owner, anchor = found.owner[new], found.anchor[new]
                order = np.lexsort((anchor, owner))
                owner, anchor = owner[order], anchor[order]
                first = np.append(True, (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1]))[: len(owner)]
                columns = [pa.array(ids[done + owner[first]]), pa.array(anchor[first].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "anchor"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_docs = held = np.zeros(0, np.int64)
        streaming = None

        def out(ids: np.ndarray, keys: np.ndarray, common: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(keys), pa.array(common)], names=["doc_id", "anchor", "common"]
            )

        for batch in batches:
            ids, keys = batch["doc_id"].to_numpy(), batch["anchor"].to_numpy()
            if streaming is not None:
                # The rest of an anchor that is known to be common.
                n = int(np.searchsorted(keys != streaming, True)) if (keys != streaming).any() else len(keys)
                yield out(ids[:n], keys[:n], np.ones(n, bool))
                ids, keys = ids[n:], keys[n:]
                if not len(keys):
                    continue
                streaming = None
            ids, keys = np.concatenate([held_docs, ids]), np.concatenate([held, keys])
            if not len(keys):
                continue
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            last = first[-1]
            counts = np.diff(np.append(first, len(keys)))
            if counts[-1] > COMMON:
                streaming, last = keys[-1], len(keys)
            else:
                first, counts = first[:-1], counts[:-1]
            sizes = np.repeat(counts, counts)
            done = np.arange(len(sizes))[sizes > 1]
            yield out(ids[done], keys[done], sizes[done] > COMMON)
            held_docs, held = ids[last:], keys[last:]
        if len(held) > 1:
            yield out(held_docs, held, np.zeros(len(held), bool))

    rows = docs.mapInArrow(find, "doc_id long, anchor long")
    rows = rows.repartition("anchor").sortWithinPartitions("anchor", "doc_id")
    return rows.mapInArrow(pick, "doc_id long, anchor long, common boolean")


class Seen:
    """The least document of contents that came, of the last ``SEEN`` or so."""

    def __init__(self):
        self.held = self.keys = self.docs = np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, contents: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The rows of the least document of each content, but for those that came before with no larger one."""
        order = np.lexsort((docs, keys, contents))
        own, key = contents[order], keys[order]
        rows = order[np.append(True, (own[1:] != own[:-1]) | (key[1:] != key[:-1]))[: len(order)]]
        if len(self.held):
            at = np.minimum(np.searchsorted(self.held, contents[rows]), len(self.held) - 1)
            old = (self.held[at] == contents[rows]) & (self.keys[at] == keys[rows]) & (self.docs[at] <= docs[rows])
            rows = rows[~old]
        if len(self.held) > SEEN:
            self.held = self.keys = self.docs = np.zeros(0, np.int64)
        # The first of equal contents is kept, so a smaller document takes the place of a larger one.
        self.held, first = np.unique(np.concatenate([contents[rows], self.held]), return_index=True)
        self.keys = np.concatenate([keys[rows], self.keys])[first]
        self.docs = np.concatenate([docs[rows], self.docs])[first]
        return rows


def _segments(docs: DataFrame, shared: DataFrame, words: bool) -> DataFrame:
    """Places (key, content, doc_id, start) of every segment of the documents, or with ``words`` its least document and words.

    With ``words`` a content that the same task gave with no larger id is left out.
    """
    lists = shared.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "common")).alias("shared"))
    rows = docs.join(lists, "doc_id").select(
        "doc_id", "nameless", "text", F.col("shared.anchor").alias("anchors"), F.col("shared.common").alias("common")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            # An anchor of any document of the batch is in the lists of all documents that have it.
            listed = batch["anchors"].flatten().to_numpy()
            often = batch["common"].flatten().to_numpy(zero_copy_only=False).astype(bool)
            known, often = np.unique(listed.view(np.uint64)), np.unique(listed[often].view(np.uint64))
            for done, texts, found in _cut_windows(batch):
                new = found.new()
                # Windows of one anchor place are alike.
                runs = np.flatnonzero(new)
                anchors, sizes = found.anchor[runs], np.diff(np.append(runs, len(new)))
                wanted, split = (np.repeat(_among(anchors, x), sizes) for x in (known, often))
                after = np.append(new[1:] | split[1:], True)[: len(new)]
                first, last = np.flatnonzero(wanted & (new | split)), np.flatnonzero(wanted & after)
                starts, stops, owner = found.at[first], found.at[last], found.owner[first]
                head, tail = found.hashes(starts), found.hashes(stops)
                # A segment's windows share a word, so its first and its last one tell all its words.
                contents = (mix(head + (stops - starts).astype(np.uint64)) ^ tail).view(np.int64)
                keys = np.where(split[first], head, found.anchor[first]).view(np.int64)
                docs_ = ids[done + owner]
                if words:
                    least = seen.add(keys, contents, docs_)
                    columns = [pa.array(x[least]) for x in (keys, contents, docs_)]
                    columns.append(pa.array(list(found.texts(starts[least], stops[least])), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "content", "doc_id", "words"])
                else:
                    begins = (starts - found.begin[owner]).astype(np.int32)
                    columns = [pa.array(x) for x in (keys, contents, docs_, begins)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "content", "doc_id", "start"])

    return rows.mapInArrow(cut, SEGMENT_WORDS if words else SEGMENT_PLACES)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def first_documents(segments: list[bytes], docs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The least document that holds each window of all segments in a row, and the number of windows of each segment.

    All windows are searched in one FM-index. A segment is its words, joined by one space.
    """
    split = pc.split_pattern(pa.array(segments, pa.large_binary()), " ")
    lengths = np.diff(split.offsets.to_numpy())
    # Words are numbered from 1; 0 ends a segment.
    ids = split.flatten().dictionary_encode().indices.to_numpy()
    symbols = np.zeros(len(ids) + len(segments), np.int64)
    symbols[np.arange(len(ids)) + np.repeat(np.arange(len(segments)), lengths)] = ids + np.int64(1)
    windows = lengths - WINDOW + 1
    begin = np.cumsum(lengths + 1) - lengths - 1
    at = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    index = FMIndex(symbols, WINDOW)
    low = np.empty(len(at), np.int64)
    high = np.empty(len(at), np.int64)
    for i in range(0, len(at), PATTERNS):
        part = slice(i, i + PATTERNS)
        low[part], high[part] = index.search(symbols[at[part][:, None] + np.arange(WINDOW)], settle=True)
    owner = np.repeat(np.array(docs, np.int64), lengths + 1)[index.order]
    # Ranges of equal windows are equal and others do not meet, so each range is scanned once.
    lows, which = np.unique(low, return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[which] = high
    borders = np.stack([lows, highs], axis=1).ravel()
    least = np.minimum.reduceat(np.append(owner, np.iinfo(np.int64).max), borders)[::2]
    return least[which], windows


def _firsts(segments: DataFrame) -> DataFrame:
    """(key, content, firsts): the least document of each window of every segment."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int]] = {}
        size, last = 0, None

        def found() -> pa.RecordBatch:
            none = np.zeros(0, np.int64), np.zeros(0, np.int64)
            flat, windows = first_documents([w for w, _ in held.values()], [d for _, d in held.values()]) if held else none
            offsets = np.append(0, np.cumsum(windows)).astype(np.int32)
            keys = [k for k, _ in held]
            contents = [c for _, c in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(contents, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["key", "content", "firsts"],
            )

        for batch in batches:
            numbers = [batch[c].to_numpy().tolist() for c in ("key", "content", "doc_id")]
            for key, content, doc, words in zip(*numbers, batch["words"].to_pylist(), strict=True):
                if size >= SHARD_WORDS and key != last:
                    yield found()
                    held.clear()
                    size = 0
                last = key
                old = held.get((key, content))
                if old is None:
                    held[key, content] = words, doc
                    size += words.count(b" ") + 2
                elif doc < old[1]:
                    held[key, content] = words, doc
        yield found()

    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(search, "key long, content long, firsts array<long>")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row.

    A word goes if a window over it also starts in a document of a smaller id.
    """
    ship_package(docs.sparkSession)
    # A row without id goes by a hash of its text, apart from the documents of that id. So all joins with the texts
    # take the same rows, and Spark makes one exchange of them for all.
    own, body = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(own, F.xxhash64(body)).alias("doc_id"), own.isNull().alias("nameless"), body.alias("text")
    )
    shared = stored(_shared(rows.where("not nameless").select("doc_id", "text")), "anchors")
    firsts = _firsts(_segments(rows, shared, words=True))
    placed = _segments(rows, shared, words=False).join(firsts, ["key", "content"])
    gone = F.transform("firsts", lambda x, i: F.when(x < F.col("doc_id"), F.col("start") + i.cast("int")))
    gone = F.filter(gone, lambda x: x.isNotNull())
    removed = placed.select("doc_id", gone.alias("gone")).where(F.size("gone") > 0)
    removed = removed.groupBy("doc_id").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    joined = rows.join(removed, "doc_id", "left").select("doc_id", "nameless", "text", "gone")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            ids, nameless = batch["doc_id"].to_pylist(), batch["nameless"].to_pylist()
            for doc, skip, raw, gone in zip(ids, nameless, _texts(batch), batch["gone"].to_pylist(), strict=True):
                words = raw.split()
                kept = words
                if gone and not skip:
                    steps = np.zeros(len(words) + 1, np.int64)
                    places = np.unique(gone)
                    np.add.at(steps, places, 1)
                    np.add.at(steps, places + WINDOW, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
                body = b" ".join(kept)
                values = (None if skip else doc, len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), body)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            arrays[4] = arrays[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
