from __future__ import annotations

import hashlib
import sys

import numpy as np

from clickloom.llm.fm_index import FMIndex
from clickloom.llm.shingles import word_hashes
from clickloom.llm.substring_dedup import Seen, first_documents, remove_repeats

from .samples import sentences, varied, words


def brute(rows, n=13):
    first = {}
    for doc, text in rows:
        own = words(text)
        for i in range(len(own) - n + 1):
            key = tuple(own[i : i + n])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - n + 1):
            if first[tuple(own[i : i + n])] < doc:
                gone.update(range(i, i + n))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(rows):
    got = remove_repeats(rows).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted(tuple(r) for r in got)


def test_equals_brute_force(spark, documents):
    shared = sentences("shared", 30)
    texts = varied(5, 12)
    texts += [f"{sentences(i, 20)} {shared} {sentences(-i - 1, 15)}" for i in range(6)]
    texts += [shared[: shared.rindex(" ")], " ".join(["same"] * 40), " ".join(["same"] * 13), " ".join(["same"] * 12)]
    assert result(documents(*texts)) == brute(list(enumerate(texts, 1)))


def test_empty_table(spark, documents):
    assert result(documents("x").limit(0)) == []


def test_extra_columns_may_clash(spark):
    rows = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, n_words long")
    assert result(rows) == brute([(1, "a b")])


def test_passage_of_very_many_documents(spark, documents):
    passage = sentences("hot", 25)
    texts = [f"{sentences(i, 4)} {passage} {sentences(-i, 15)}" for i in range(1100)]
    assert result(documents(*texts)) == brute(list(enumerate(texts, 1)))


def test_missing_and_repeated_ids(spark, documents):
    shared = sentences("ids", 20)
    rows = [(3, shared), (3, f"x {shared}"), (None, shared), (None, shared), (4, f"{shared} y"), (4, f"{shared} y")]
    got = remove_repeats(documents(*[(i, t, "a") for i, t in rows])).select("doc_id", "n_words", "n_removed").collect()
    expected = [(3, 20, 0), (3, 21, 0), (None, 20, 0), (None, 20, 0), (4, 21, 20), (4, 21, 20)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_search_ranges():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 6, 40) for _ in range(8)]
    symbols = np.concatenate([np.append(t, 0) for t in texts])
    index = FMIndex(symbols, 6)
    patterns = np.stack([t[i : i + 6] for t in texts for i in range(35)])
    plain = {i: tuple(p) for i, p in enumerate(patterns)}
    for settle in (False, True):
        low, high = index.search(patterns, settle)
        for i, own in plain.items():
            places = sorted(index.order[low[i] : high[i]].tolist())
            whole = [j for j in range(len(symbols) - 5) if tuple(symbols[j : j + 6]) == own]
            # A settled search may name the one place by a later suffix of the pattern.
            assert places == whole or (settle and len(places) == len(whole) == 1 and 0 < places[0] - whole[0] < 6)


def calls(function, *args):
    """How many functions, Python's or built-in ones, a call runs."""
    count = 0

    def tell(frame, event, arg):
        nonlocal count
        count += event in ("call", "c_call")

    sys.setprofile(tell)
    try:
        function(*args)
    finally:
        sys.setprofile(None)
    return count


def test_search_takes_no_step_for_every_word():
    segments = [sentences(i, 400).encode() for i in range(100)]
    assert calls(first_documents, segments, list(range(100))) < 100 * 400 // 5


def test_words_of_any_length_are_told_apart():
    own = [b"a" * n for n in range(1, 40)] + [b"a" * n + b"b" for n in range(40)] + [b"\x00", b"\x00\x00", "é".encode()]
    text = b"\t".join(own) + b" " + b"\n\n".join(reversed(own))
    hashes, counts = word_hashes([b"", text, b" ", b"a" * 20], lower=False)
    assert counts.tolist() == [0, 2 * len(own), 0, 1]
    there, back, last = hashes[: len(own)].tolist(), hashes[len(own) : -1].tolist(), hashes[-1]
    assert there == back[::-1] and len(set(there)) == len(own) and last == there[19]


def test_contents_pass_once_unless_of_a_smaller_document():
    seen = Seen()
    one, two = np.array([1, 1, 2, 1]), np.array([5, 5, 7, 6])
    assert sorted(seen.add(one, two, np.array([8, 7, 9, 7]))) == [1, 2, 3]
    assert sorted(seen.add(one, two, np.array([6, 7, 9, 9]))) == [0]
    assert len(seen.add(one[:0], two[:0], two[:0])) == 0


def test_spaces_of_any_kind_do_not_part_equal_passages(spark, documents):
    shared = sentences("spaces", 30)
    texts = [f"x {shared}", f"\n{shared.replace(' ', '  ')}\t", f"y\r\n{shared.replace(' ', ' \t')}", "\f".join(shared.split())]
    assert result(documents(*texts)) == brute(list(enumerate(texts, 1)))
