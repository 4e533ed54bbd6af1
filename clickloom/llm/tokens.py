"""Token ids of texts, encoded piece by piece with a cache of pieces."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The code points of the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Ranges of letters, and ASCII signs but the apostrophe, which may join a word's end.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
SIGNS = r"!-&(-/:-@\[-`{-~"
CACHED_PIECES = 300_000
CACHED_LENGTH = 48
BATCH_BYTES = 8_000_000
BATCH_WORDS = 500_000
#: Distinct words that are cut and coded at once.
CHUNK_WORDS = 50_000


def in_slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows of at most ``most`` bytes in all; a larger row is a run of its own."""
    upto = np.cumsum(sizes, dtype=np.int64)
    begin = 0
    while begin < len(upto):
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield begin, end
        begin = end


def byte_sizes(values: pa.Array) -> np.ndarray:
    """Bytes of each text or byte string; none may be null."""
    return pc.binary_length(values).to_numpy(zero_copy_only=False)


def _byte_alphabet() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: printable ones as they are, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder:
    """A byte-level BPE whose pre-tokenizer keeps one space with the word or the signs that follow it.

    Such a pre-tokenizer never joins characters across the places where ``PIECE`` cuts, so a text's ids are those of
    its pieces in a row. A run of letters or of signs that ends before another kind is one word of the model, which then encodes
    it directly. It cuts before every space, but for one with white space before it and white space or nothing after it. So
    a text is split at its spaces, each distinct word of many texts is cut into pieces once, and a text with such a space is cut as one
    word. Texts holding an added token's string are encoded whole.
    """

    WORD = f" ?[{LETTERS}]+(?=[{WHITE}!-@\\[-`{{-~]|\\Z)| ?[{SIGNS}]+(?=[{WHITE}0-9{LETTERS}]|\\Z)"
    PIECE = re.compile(f"{WORD}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
    INNER = f"[{WHITE}] (?:[{WHITE}]|\\z)"
    ONE = re.compile(f" ?[{LETTERS}]+| ?[{SIGNS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.in_pieces = spec.get("normalizer") is None and pre == {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": pre.get("trim_offsets"),
            "use_regex": True,
        }
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Pieces met since the cache was last half full, and those of the time before.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.alphabet = dict(enumerate(_byte_alphabet()))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        tokenize, one, space = self.tokenizer.model.tokenize, self.ONE.fullmatch, self.alphabet[32]
        single, flat, ends, rest = [], [], [0], []
        for p in pieces:
            if one(p):
                # Of ASCII letters and signs with a space before them only the space is written otherwise.
                written = p.replace(" ", space) if p.isascii() else p.encode().decode("latin-1").translate(self.alphabet)
                single.append(p)
                flat += [t.id for t in tokenize(written)]
                ends.append(len(flat))
            else:
                rest.append(p)
        raw, width = np.array(flat, self.dtype).tobytes(), self.dtype.itemsize
        found = {p: raw[a * width : b * width] for p, a, b in zip(single, ends, ends[1:], strict=False)}
        found.update(zip(rest, self._encode(rest), strict=True))
        return found

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of some strings that the pre-tokenizer cuts like texts, ``CHUNK_WORDS`` at a time."""
        found = []
        for a in range(0, len(words), CHUNK_WORDS):
            found += self._ids_of_chunk(words[a : a + CHUNK_WORDS])
        return found

    def _ids_of_chunk(self, words: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        found = list(map(young.get, words))
        rest = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = found[i] = old.get(word)
            if ids is None:
                rest.append(i)
            else:
                young[word] = ids
        cut = list(map(self.PIECE.findall, map(words.__getitem__, rest)))
        known, new = {}, []
        for p in set(chain.from_iterable(cut)):
            ids = young.get(p)
            if ids is None:
                ids = old.get(p)
                if ids is None:
                    new.append(p)
                    continue
                young[p] = ids
            known[p] = ids
        fresh = self._encode_pieces(new)
        known.update(fresh)
        young.update((p, ids) for p, ids in fresh.items() if len(p) <= CACHED_LENGTH)
        for i, ps in zip(rest, cut, strict=True):
            found[i] = known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])
        if len(young) > CACHED_PIECES // 2:
            self.young, self.old = {}, young
        return found

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian bytes of ``dtype``; no text may be null."""
        for begin, end in in_slices(byte_sizes(texts), BATCH_BYTES):
            yield from self._encode_small(texts.slice(begin, end - begin))

    def _encode_small(self, texts: pa.Array) -> Iterator[bytes]:
        whole = np.full(len(texts), not self.in_pieces)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, self.INNER).to_numpy(zero_copy_only=False) & ~whole
        in_one = texts.filter(pa.array(odd)).to_pylist()
        split = pc.split_pattern(texts.filter(pa.array(~(whole | odd))), " ")
        starts = split.offsets.to_numpy()[:-1].astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy().copy()
        # The first word of a text has no space before it.
        first, which = np.unique(codes[starts], return_inverse=True)
        codes[starts] = len(words) + which
        units = [" " + w for w in words] + [words[i] for i in first.tolist()]
        del split, coded, words
        found = self._ids(units + in_one)
        in_one = iter(found[len(units) :])
        flat = np.frombuffer(b"".join(found[: len(units)]), self.dtype)
        counts = np.fromiter(map(len, found), np.int64, len(units)) // self.dtype.itemsize
        plain = self._spread(flat, counts, codes, starts)
        for i, (is_whole, is_odd) in enumerate(zip(whole.tolist(), odd.tolist(), strict=True)):
            if is_whole:
                yield self._encode([texts[i].as_py()])[0]
            else:
                yield next(in_one if is_odd else plain)

    def _spread(self, flat: np.ndarray, counts: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> Iterator[bytes]:
        """The ids of each text, whose words' codes begin at ``starts``; code after code has ``counts`` ids in ``flat``."""
        before, width = np.cumsum(counts) - counts, self.dtype.itemsize
        starts = np.append(starts, len(codes))
        begin = 0
        while begin < len(starts) - 1:
            end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + BATCH_WORDS, side="right")) - 1)
            own = codes[starts[begin] : starts[end]]
            sizes = counts[own]
            borders = np.append(0, np.cumsum(sizes))
            raw = flat[np.repeat(before[own] - borders[:-1], sizes) + np.arange(borders[-1])].tobytes()
            places = (borders[starts[begin : end + 1] - starts[begin]] * width).tolist()
            for a, b in zip(places, places[1:], strict=False):
                yield raw[a:b]
            begin = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, once per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
