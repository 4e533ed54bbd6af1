"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import spelling
from clickloom.llm.queries import QUERIES
from clickloom.llm.spelling import SortedLists, near_words, variants, word_counts

from .samples import LONG

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, slip, least):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return dict(found)


def brute_variants(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return rows


def mutated(seed, count, alphabet="abcé", length=7):
    """Random words and words one or two edits from them."""
    pick = random.Random(seed)
    words = {"".join(pick.choice(alphabet) for _ in range(pick.randrange(1, length))) for _ in range(count)}
    for w in sorted(words):
        at = pick.randrange(len(w))
        words |= {w[:at] + pick.choice(alphabet) + w[at:], w[:at] + "z" + w[at + 1 :]}
        words |= {w[:at] + w[at + 1 :]} - {""}
    return sorted(words)


def as_rows(result):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in result.collect()}


@pytest.mark.parametrize("list_words", [spelling.LIST_WORDS, 3])
def test_near_words_equal_brute_force(spark, monkeypatch, list_words):
    # Few words a list: lists are dealt again until their words share all but one character.
    monkeypatch.setattr(spelling, "LIST_WORDS", list_words)
    words = mutated(1, 150)
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = [(r.word, r.near, r.near_n) for r in near_words(rows).collect()]
    want = {(a, b, j) for a in words for j, b in enumerate(words) if a != b and one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_variants_equal_brute_force(spark):
    pick = random.Random(2)
    counts = {w: pick.choice([1, 4, 5, 6, 25, 30, 125, 126, 700, 4000]) for w in mutated(3, 120)}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute_variants({w: n for w, n in counts.items() if n >= 5})
    assert as_rows(variants(rows)) == want
    # Chains of forms occur.
    assert any(form and root != form for _, _, _, form, _, root in want)


def test_blocks_of_ranges_change_nothing(monkeypatch):
    middles = [w for w in mutated(4, 80)]
    search = SortedLists(np.zeros(len(middles), np.int64), middles)
    queries = np.arange(len(middles))

    def found():
        return {(a, b) for q, r in search.one_edit(queries) for a, b in zip(q.tolist(), r.tolist(), strict=True)}

    whole = found()
    assert whole == {(i, j) for i, a in enumerate(middles) for j, b in enumerate(middles) if i != j and one_edit(a, b)}
    monkeypatch.setattr(spelling, "STATES", 10)
    assert found() == whole


@pytest.mark.parametrize("slip", [None, 3])
def test_counts_equal_brute_force(spark, slip):
    rows = [
        (1, "Straße straße STRASSE Éclair éclair x×y÷z a-b A1B"),
        (2, "abcdef ABCDEF abcdef\nabcdeg"),
        (2, "abcdef ABCDEF abcdef\nabcdeg"),
        (None, "abcdef nothing"),
        (3, None),
        (4, ""),
        (5, LONG + "k" * 70_000),
        (6, "日本語 123 ---"),
    ]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n long")
    for least in (1, 6):
        got = {r.word: r.n for r in word_counts(docs, least, slip).collect()}
        assert got == brute_counts(rows, slip, least)


def test_long_words_ties_and_nothing(spark):
    long = "k" * 3000
    counts = {long: 5, long + "k": 30, "y" + long: 30, "abcdef": 5, "abcdeg": 50, "abcdea": 50}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_rows(variants(rows)) == brute_variants(counts)
    assert as_rows(variants(rows.limit(0))) == set()


def test_query(spark, tmp_path, documents):
    pick = random.Random(5)
    vocabulary = [w + "word" for w in mutated(6, 30)]
    texts = [" ".join(pick.choices(vocabulary, range(1, len(vocabulary) + 1), k=300)) for _ in range(12)]
    docs = documents(*texts, None, "")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    counts = brute_counts([(r.doc_id, r.text) for r in docs.collect()], 199, 6)
    want = brute_variants({w: n for w, n in counts.items() if n >= 5})
    assert as_rows(QUERIES["op12_spelling_variants"](spark, str(tmp_path))) == want
