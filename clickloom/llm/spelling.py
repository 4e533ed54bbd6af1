"""Spelling variants: words one edit apart, found by edit matrices over sorted lists.

Two words one edit apart agree in their first half or in their last half. Each word therefore goes to a list for either half, once
with the lengths of words as long as itself and once with those of words one shorter. A list that is still too long is dealt again
by halves of what its words do not share yet, so no list grows with the data. A list is sorted by the part that may differ and scanned by
depth: words with a common prefix are one range, the edit matrix has one banded row for the range and the query, the
next row is computed once for every range of words that share one more character (places where adjacent words' common
prefixes end), and ranges whose prefix is already more than one edit away are skipped. All queries of a block move on together.

Defined cases: a null or empty text has no words; a null id is written as nothing; repeated rows count each time; an
empty table gives an empty table; ties between forms go to the smallest word in code-point order; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package
from clickloom.llm.tables import stored
from clickloom.operators.joins import hot_key_join

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Lists of more words are dealt again.
LIST_WORDS = 50_000
#: Words held by a task at once, beside one list; distinct words counted before they are passed on.
SHARD_WORDS = 200_000
COUNTED = 200_000
#: Ranges moved on at once.
STATES = 2_000_000
NO_SKIP = 1 << 30


def word_counts(
    docs: DataFrame,
    least_chars: int = 6,
    slip: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, of at least ``least_chars`` code points.

    With ``slip``, a run loses the code point at ``h % length`` where ``slip`` divides h, the crc32 of ``<doc_id>:<run>``.
    """

    def slipped(doc: str, run: str) -> str:
        h = zlib.crc32(f"{doc}:{run}".encode())
        if h % slip:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for doc, body in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own: Counter[str] = Counter()
                for run, n in Counter(RUN.findall(body)).items():
                    # A run shorter than this stays too short.
                    if len(run) >= least_chars:
                        own[run if run.islower() else run.translate(_LOWER)] += n
                for run, n in own.items():
                    word = slipped(doc, run) if slip else run
                    if len(word) >= least_chars:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield out()
                    total.clear()
        yield out()

    ship_package(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text")
    )
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- lists ------------------------------------------------------------------


def _halves() -> Column:
    """What the two halves of a list's open part give: (first shared, last shared, skip).

    An inserted character at the border keeps both halves, so the second list skips pairs that share the first ``skip`` characters.
    """
    half = F.floor(F.col("open") / 2).cast("int")
    first = F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail"), F.col("skip").alias("skip"))
    last = F.struct(
        F.col("head").alias("head"),
        (F.col("tail") + F.col("open") - half).alias("tail"),
        F.least("skip", F.col("head") + half).alias("skip"),
    )
    return F.when(F.col("open") > 1, F.array(first, last)).otherwise(
        F.array(F.struct(F.col("head"), F.col("tail"), F.col("skip")))
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` once for every half, with the key of their list and the part that may differ."""
    split = rows.withColumn("_part", F.explode(_halves())).select("word", "n", "length", "shorter", "_part.*")
    key = F.concat_ws(
        ",",
        "shorter",
        "head",
        "tail",
        F.substring("word", F.lit(1), F.col("head")),
        F.substring("word", F.col("length") - F.col("tail") + 1, F.col("tail")),
    )
    return split.select(
        "*",
        key.alias("key"),
        (F.col("shorter") - F.col("head") - F.col("tail")).alias("open"),
        F.substring("word", F.col("head") + 1, F.col("length") - F.col("head") - F.col("tail")).alias("middle"),
    )


def _lists(words: DataFrame) -> DataFrame:
    """All words in all their lists, none longer than ``LIST_WORDS`` unless its words share all but one character."""
    length = F.length("word")
    shorter = F.explode(F.filter(F.array(length, length - 1), lambda x: x > 0))
    rows = words.select("word", "n", length.alias("length"), shorter.alias("shorter")).select(
        "*", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.col("shorter").alias("open"), F.lit(NO_SKIP).alias("skip")
    )
    done = []
    while True:
        level = stored(_dealt(rows), "lists")
        long = level.groupBy("key", "open").count().where((F.col("count") > LIST_WORDS) & (F.col("open") > 1))
        long = stored(long.select("key"), "long-lists")
        if long.isEmpty():
            done.append(level)
            break
        done.append(hot_key_join(level, long, "key", "left_anti"))
        rows = hot_key_join(level, long, "key", "left_semi")
    lists = done[0]
    for more in done[1:]:
        lists = lists.unionByName(more)
    return lists


# --- search in one sorted shard -----------------------------------------------


class SortedLists:
    """Lists one after the other, each sorted by ``middles``; the flat code points of all middles."""

    def __init__(self, lists: np.ndarray, middles: list[str]):
        self.lengths = np.fromiter(map(len, middles), np.int64, len(middles))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.points = np.frombuffer("".join(middles).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        begins = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        sizes = np.diff(np.append(begins, len(lists)))
        self.low, self.high = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
        self.shared = self._shared_with_last(lists)

    def at(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """Code points of ``rows`` at ``depth``, -1 behind the end."""
        if not len(self.points):
            return np.full(len(rows), -1, np.int64)
        place = np.minimum(self.starts[rows] + depth, len(self.points) - 1)
        return np.where(depth < self.lengths[rows], self.points[place], -1)

    def _shared_with_last(self, lists: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each word and the one before it, -1 at the start of a list."""
        shared = np.append(-1, np.where(lists[1:] == lists[:-1], 0, -1))
        same, depth = np.flatnonzero(shared == 0), 0
        while len(same):
            here = self.at(same, depth)
            same = same[(here >= 0) & (here == self.at(same - 1, depth))]
            depth += 1
            shared[same] = depth
        return shared

    def one_edit(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) for all rows in a query's list that are exactly one edit away from it."""
        n = len(queries)
        second = np.where(self.lengths[queries] > 0, 1, 2)
        band = [np.full(n, 2, np.int8), np.zeros(n, np.int8), second.astype(np.int8)]
        work = [(0, queries, self.low[queries], self.high[queries], band)]
        breaks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        while work:
            depth, query, low, high, band = work.pop()
            # The word that ends here is the first of its range.
            ended = self.lengths[low] == depth
            away = self.lengths[query] - depth + 1
            for k in range(3):
                hit = ended & (away == k) & (band[k] == 1)
                if hit.any():
                    yield query[hit], low[hit]
            low = low + ended
            going = low < high
            query, low, high = query[going], low[going], high[going]
            band = [x[going] for x in band]
            if not len(query):
                continue
            if depth not in breaks:
                places = np.flatnonzero(self.shared <= depth)
                breaks[depth] = places, np.append(0, np.cumsum(self.shared <= depth))
            places, before = breaks[depth]
            # Ranges of words that share one more character: they begin at `low` and at every break up to `high`.
            inner = before[high] - before[low + 1]
            if len(query) > 1 and int(inner.sum()) + len(query) > STATES:
                half = len(query) // 2
                for part in (slice(half), slice(half, None)):
                    work.append((depth, query[part], low[part], high[part], [x[part] for x in band]))
                self._forget(work, breaks)
                continue
            of = np.repeat(np.arange(len(query)), inner + 1)
            first = np.cumsum(inner + 1) - inner - 1
            step = np.arange(len(of)) - first[of]
            begin = np.where(step == 0, low[of], places[np.minimum(before[low + 1][of] + step - 1, len(places) - 1)])
            last = step == inner[of]
            end = np.where(last, high[of], np.append(begin[1:], 0))
            query, (a, b, c) = query[of], (x[of] for x in band)
            char = self.at(begin, depth)
            length = self.lengths[query]

            def cost(offset: int, query=query, char=char, length=length, depth=depth) -> np.ndarray:
                place = depth + offset
                if place < 0:
                    return np.full(len(query), 2, np.int8)
                return np.where(place < length, self.at(query, place) != char, 2).astype(np.int8)

            new_a = np.minimum(a + cost(-1), b + 1)
            new_b = np.minimum(np.minimum(b + cost(0), c + 1), new_a + 1)
            new_c = np.minimum(c + cost(1), new_b + 1)
            new_c = np.where(depth + 2 > length, 2, new_c)
            new_b = np.where(depth + 1 > length, 2, new_b)
            new = [np.minimum(x, 2).astype(np.int8) for x in (new_a, new_b, new_c)]
            near = np.minimum(np.minimum(new[0], new[1]), new[2]) < 2
            if near.any():
                work.append((depth + 1, query[near], begin[near], end[near], [x[near] for x in new]))
            self._forget(work, breaks)

    @staticmethod
    def _forget(work: list, breaks: dict) -> None:
        wanted = {item[0] for item in work}
        for depth in [d for d in breaks if d not in wanted]:
            del breaks[depth]


def _pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    lists = rows["key"].combine_chunks().dictionary_encode().indices.to_numpy()
    words, counts, skips = (rows[c].to_pylist() for c in ("word", "n", "skip"))
    length = rows["length"].to_numpy()
    queries = np.flatnonzero(length == rows["shorter"].to_numpy())
    search = SortedLists(lists, rows["middle"].to_pylist())
    for query, row in search.one_edit(queries):
        out: tuple[list, list, list] = ([], [], [])
        longer = (length[row] > length[query]).tolist()
        for q, r, more in zip(query.tolist(), row.tolist(), longer, strict=True):
            if more and skips[q] < NO_SKIP and words[q][: skips[q]] == words[r][: skips[q]]:
                continue
            for a, b in ((q, r), (r, q))[: 1 + more]:
                out[0].append(words[a])
                out[1].append(words[b])
                out[2].append(counts[b])
        columns = [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for all pairs of distinct ``words`` (word, n) that are exactly one edit apart, both ways."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < SHARD_WORDS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows["key"].combine_chunks().dictionary_encode().indices.to_numpy()
            # The last list may go on in the next batch.
            whole = int(np.searchsorted(key, key[-1]))
            if whole:
                yield from _pairs(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
        if sum(b.num_rows for b in held):
            yield from _pairs(pa.Table.from_batches(held))

    ship_package(words.sparkSession)
    rows = _lists(words).select("key", "middle", "word", "n", "length", "shorter", "skip")
    rows = rows.repartition("key").sortWithinPartitions("key", "middle")
    return rows.mapInArrow(search, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): every step follows twice as many forms, so few steps reach the last one."""
    steps = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not steps.where("moved").isEmpty():
        onward = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        steps = stored(
            steps.join(onward, F.col("root") == F.col("_at"), "left").select(
                "word",
                F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("moved"),
            ),
            "roots",
        )
    return steps.select("word", "root")


def variants(counts: DataFrame, least_count: int = 5, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``counts`` (word, n) with at least ``least_count`` occurrences.

    A word's form is its most frequent near word, if that has at least ``ratio`` times its occurrences; its root is the last of its forms' forms.
    """
    words = stored(counts.where(F.col("n") >= least_count), "words")
    # The largest count, then the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    often = -F.col("best.less") >= ratio * F.col("n")
    found = stored(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best.word")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
