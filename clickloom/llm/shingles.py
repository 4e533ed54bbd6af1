"""Word and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first bytes of a little-endian eight, by their number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_places(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ``texts``, where every word in them starts and ends, and the number of words of each text.

    A word is a run of bytes other than space and 9 to 13.
    """
    # A text ends in a space, and eight more let a word's last block be read whole.
    raw = b"\n".join(texts) + b"\n" * 9
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return raw, starts, ends, np.diff(np.searchsorted(starts, np.cumsum(sizes + 1)), prepend=0)


def place_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hashes of the words of ``word_places``; ``lower`` folds A-Z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(raw, np.uint8)
    if lower:
        data = _LOWER[data]
    # A word's bytes by eights: the place's odd multiplier times the scrambled eight, summed over the word.
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    lengths = ends - starts
    terms = mix(eights[starts] & _FIRST[np.minimum(lengths, 8)])
    long = np.flatnonzero(lengths > 8)
    if len(long):
        more = (lengths[long] - 1) // 8
        first = np.cumsum(more) - more
        place = np.arange(int(more.sum())) - np.repeat(first, more) + 1
        left = np.repeat(lengths[long], more) - 8 * place
        rest = eights[np.repeat(starts[long], more) + 8 * place] & _FIRST[np.minimum(left, 8)]
        factor = mix(np.arange(1, int(more.max()) + 2, dtype=np.uint64)) | np.uint64(1)
        terms[long] += np.add.reduceat(mix(rest) * factor[place], first)
    return mix(terms + lengths.astype(np.uint64))


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of UTF-8 ``texts`` in order, and the number of words of each text."""
    raw, starts, ends, counts = word_places(texts)
    return place_hashes(raw, starts, ends, lower), counts


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words; none if there are fewer."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = mix(total + words[k : k + count] + np.uint64(k + 1))
    return total
