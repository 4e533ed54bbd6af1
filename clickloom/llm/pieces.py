"""SentencePiece encoding and decoding: a BPE model's merges in vectorised rounds.

A text is cut into words where no piece of the model reaches across, and every new word of a batch is one segment of flat
symbol arrays. A round looks up the rank of every adjacent pair, takes the least rank of each word, merges its pairs
from the left at once and compacts the arrays, until no word has a pair. A merge that brings forth a pair as good as itself or
better must be the last one of its word in that round, since the library would go on there; so the ids are those of one merge at a time.
Symbols outside the vocabulary become their UTF-8 bytes.

Defined cases: a null or empty text has the begin and end ids alone and decodes to an empty text; repeated rows are
coded as often as they come; an empty table gives an empty table; other columns are not read, whatever their names.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package

SPACE = "▁"
CACHED_WORDS = 300_000
CACHED_LENGTH = 48
BATCH_CHARS = 1_000_000
#: Words with pairs left after so many rounds are finished one merge at a time, which takes n log n instead of n * rounds.
ROUNDS = 200
NO_RANK = np.iinfo(np.int32).max
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _byte_by_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("clickloom-byte", _byte_by_byte)


class Sorted:
    """A fixed map from integers to integers, looked up for whole arrays."""

    def __init__(self, items: dict[int, int]):
        self.keys = np.array(sorted(items), np.int64)
        self.values = np.array([items[k] for k in self.keys.tolist()], np.int64)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


class Pieces:
    """Encoder and decoder of a BPE model with byte fallback and without rewriting of its input."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, normal = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not normal.escape_whitespaces
            or model.denormalizer_spec.precompiled_charsmap
            or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("only BPE models with byte fallback and unchanged input are supported")
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.begin = next((i for i, p in enumerate(model.pieces) if p.piece == trainer.bos_piece), None)
        self.end = next((i for i, p in enumerate(model.pieces) if p.piece == trainer.eos_piece), None)
        self.size = len(model.pieces)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._read_pieces(model)
        self._read_surfaces(model, trainer.unk_surface)
        self.cache: dict[str, bytes] = {}

    def _read_pieces(self, model) -> None:
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        scores = np.array([model.pieces[i].score for i in normal.values()])
        ranks = dict(zip(normal, np.unique(-scores, return_inverse=True)[1].tolist(), strict=True))
        # Characters that are no piece but part of one are symbols too, with numbers after those of the pieces.
        chars = sorted({c for p in normal for c in p})
        spare = [c for c in chars if c not in normal]
        symbols = normal | {c: self.size + i for i, c in enumerate(spare)}
        self.lone = self.size + len(spare)
        self.width = self.lone + 1
        self.symbol = Sorted({ord(c): symbols[c] for c in chars})
        merged, rank = {}, {}
        for piece, number in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    merged[left * self.width + right] = number
                    rank[left * self.width + right] = ranks[piece]
        self.pairs = Sorted(merged)
        self.pair_ranks = np.array([rank[k] for k in self.pairs.keys.tolist()], np.int64)
        self.meets = Sorted({(ord(a) << 21) | ord(b): 1 for p in normal for a, b in zip(p, p[1:], strict=False)})
        joined = {c for p in normal if len(p) > 1 for c in p}
        inner = any(b == SPACE != a for p in normal for a, b in zip(p, p[1:], strict=False))
        letters = "".join(map(re.escape, sorted(joined - {SPACE})))
        if inner or not letters:
            self.word = re.compile(r"[\s\S]+")
        else:
            self.word = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]")

    def _read_surfaces(self, model, unknown: str) -> None:
        surfaces, self.bytes = [], np.zeros(256, np.int64)
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value] = i
                surfaces.append(bytes([value]))
            elif piece.type == CONTROL:
                surfaces.append(b"")
            elif piece.type == UNKNOWN:
                surfaces.append(unknown.encode())
            else:
                surfaces.append(piece.piece.replace(SPACE, " ").encode())
        self.surfaces = surfaces
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.spaced = {i for i, p in enumerate(model.pieces) if p.type == NORMAL and p.piece.startswith(SPACE)}

    @cached_property
    def _rank_of(self) -> dict[int, tuple[int, int]]:
        both = zip(self.pair_ranks.tolist(), self.pairs.values.tolist(), strict=True)
        return dict(zip(self.pairs.keys.tolist(), both, strict=True))

    # --- encoding -----------------------------------------------------------

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; ``NO_RANK`` where they make no piece."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs.keys, keys), len(self.pairs.keys) - 1)
        known = self.pairs.keys[at] == keys
        return np.where(known, self.pair_ranks[at], NO_RANK), self.pairs.values[at]

    def _merged(self, symbols: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``symbols`` merged inside their ascending ``segments``, with the places that are left."""
        places = np.arange(len(symbols))
        out_symbols, out_places = [], []
        rounds = 0
        while len(symbols):
            inside = segments[1:] == segments[:-1]
            rank, made = self._ranked(symbols[:-1], symbols[1:])
            rank = np.append(np.where(inside, rank, NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, ~inside))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            busy = np.repeat(least < NO_RANK, sizes)
            if not busy.all():
                # Words without a pair leave the arrays.
                out_symbols.append(symbols[~busy])
                out_places.append(places[~busy])
                symbols, segments, places, rank = symbols[busy], segments[busy], places[busy], rank[busy]
                made = np.append(made, 0)[busy]
                sizes, least = sizes[least < NO_RANK], least[least < NO_RANK]
                if not len(symbols):
                    break
            else:
                made = np.append(made, 0)
            rounds += 1
            if rounds > ROUNDS:
                for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True):
                    left, kept = self._one_by_one(symbols[a:b].tolist())
                    out_symbols.append(np.array(left, np.int64))
                    out_places.append(places[a:b][kept])
                break
            take = self._leftmost(rank == np.repeat(least, sizes))
            take = self._until_better(take, symbols, segments, made, rank)
            at = np.flatnonzero(take)
            symbols = symbols.copy()
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, segments, places = symbols[keep], segments[keep], places[keep]
        if not out_symbols:
            return symbols, places
        symbols, places = np.concatenate(out_symbols), np.concatenate(out_places)
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    @staticmethod
    def _leftmost(best: np.ndarray) -> np.ndarray:
        """Of places in a row, every second from the first: pairs that share a symbol cannot both merge."""
        at = np.flatnonzero(best)
        begins = np.append(True, np.diff(at) > 1)
        run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        take = np.zeros(len(best), bool)
        take[at[(np.arange(len(at)) - run) % 2 == 0]] = True
        return take

    def _until_better(self, take, symbols, segments, made, rank) -> np.ndarray:
        """``take`` up to the first merge of each word that brings forth a pair as good as itself or better."""
        at = np.flatnonzero(take)
        new = made[at]
        # The neighbours as they are when all merges further left are done.
        follows = np.append(False, (at[1:] == at[:-1] + 2) & (segments[at[1:]] == segments[at[:-1]]))
        has_left = (at > 0) & (segments[np.maximum(at - 1, 0)] == segments[at])
        left = np.where(follows, np.append(0, new[:-1]), symbols[np.maximum(at - 1, 0)])
        after = np.minimum(at + 2, len(symbols) - 1)
        has_right = (at + 2 < len(symbols)) & (segments[after] == segments[at])
        better = has_left & (self._ranked(left, new)[0] <= rank[at])
        better |= has_right & (self._ranked(new, symbols[after])[0] <= rank[at])
        if not better.any():
            return take
        words = segments[at]
        begins = np.append(True, words[1:] != words[:-1])
        before = np.cumsum(better) - better
        first = before[begins][np.cumsum(begins) - 1]
        take = take.copy()
        take[at[before > first]] = False
        return take

    def _one_by_one(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """The merges of one word in the order of rank and place, from an agenda."""
        n = len(symbols)
        nexts, lasts = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self._rank_of
        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nexts[i]
            if j < n:
                found = ranks.get(symbols[i] * self.width + symbols[j])
                if found:
                    heapq.heappush(agenda, (found[0], i, symbols[i], symbols[j]))

        for i in range(n):
            offer(i)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = nexts[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i] = ranks[a * self.width + b][1]
            symbols[j] = -1
            nexts[i] = nexts[j]
            if nexts[i] < n:
                lasts[nexts[i]] = i
            if lasts[i] >= 0:
                offer(lasts[i])
            offer(i)
        kept = [i for i in range(n) if symbols[i] >= 0]
        return [symbols[i] for i in kept], kept

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word as little-endian bytes of ``dtype``."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), sizes)
        # A word is cut where no piece has its two characters side by side.
        cut = (owner[1:] != owner[:-1]) | (self.meets.get((points[:-1] << 21) | points[1:], 0) == 0)
        segments = np.concatenate([[0], np.cumsum(cut)])
        symbols, places = self._merged(self.symbol.get(points, self.lone), segments)
        spelled = symbols >= self.size
        lengths = np.ones(len(symbols), np.int64)
        codes = points[places]
        lengths[spelled] += (codes[spelled] >= 0x80).astype(np.int64) + (codes[spelled] >= 0x800) + (codes[spelled] >= 0x10000)
        ids = np.repeat(symbols, lengths)
        if spelled.any():
            raw = codes[spelled].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            ids[np.repeat(spelled, lengths)] = self.bytes[np.frombuffer(raw, np.uint8)]
        counts = np.bincount(owner[places], lengths, len(words)).astype(np.int64)
        flat = ids.astype(self.dtype).tobytes()
        ends = (np.cumsum(counts) * self.dtype.itemsize).tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            yield flat[a:b]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text with the begin and the end id, as little-endian bytes of ``dtype``."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text)
            if size >= BATCH_CHARS:
                yield from self._encode_batch(batch)
                batch, size = [], 0
        yield from self._encode_batch(batch)

    def _encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.word.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.cache
        new = list({w for words in split for w in words if w not in known})
        if new:
            fresh = dict(zip(new, self._encode_words(new), strict=True))
            if len(known) > CACHED_WORDS:
                # What this batch needs stays; the rest is found again when it is met.
                known = self.cache = {w: known[w] for words in split for w in words if w in known}
            known.update(fresh)
        first, last = (np.array([] if i is None else [i], self.dtype).tobytes() for i in (self.begin, self.end))
        for words in split:
            yield b"".join([first, *map(known.__getitem__, words), last])
        for word in new:
            if len(word) > CACHED_LENGTH:
                del known[word]

    # --- decoding -----------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: control ids say nothing, the leading space of the first other piece is dropped."""
        # Any other piece, also one that says nothing, ends a run of bytes; this matters inside a text only.
        runs = [ids] if self.hidden.isdisjoint(ids[1:-1]) else self._runs(ids)
        raw = [b"".join(map(self.surfaces.__getitem__, run)) for run in runs]
        text = "".join(x.decode("utf-8", "clickloom-byte") for x in raw)
        first = next((i for i in ids if i not in self.hidden), None)
        return text[1:] if self.prefix and first in self.spaced else text

    def _runs(self, ids: list[int]) -> list[list[int]]:
        ends = [i for i, x in enumerate(ids, 1) if x in self.hidden]
        return [ids[a:b] for a, b in zip([0, *ends], [*ends, len(ids)], strict=True)]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The pieces of a model file, once per Python worker."""
    return Pieces(path)


def encode_pieces(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids of every text as little-endian unsigned 32-bit integers, begin and end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            ids = [np.frombuffer(x, coder.dtype).astype("<u4").tobytes() for x in coder.encode(batch["text"].to_pylist())]
            counts = [len(x) // 4 for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_pieces(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text) of rows as :func:`encode_pieces` gives them; null ids have a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            texts = [
                None if raw is None else coder.decode(np.frombuffer(raw, "<u4").tolist())
                for raw in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "text"]
            )

    ship_package(rows.sparkSession)
    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")
