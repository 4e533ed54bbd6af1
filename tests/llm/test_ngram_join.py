from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.ngram_join import (
    _elements,
    _holders,
    _meetings,
    _packed,
    _shared_counts,
    jaccard_components,
    link_forest,
)

from .samples import sentences, varied, words


def shingles(text, n):
    own = [w.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) for w in words(text)]
    if not own:
        return frozenset()
    n = min(n, len(own))
    return frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1))


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted((i, len(sets[i]), label[i]) for i in sets)


def stretched(seed):
    """Texts and beginnings of them, so that linked sets differ in size."""
    pick = random.Random(seed)
    texts = [sentences(f"{seed}-{i}", 60, 5000) for i in range(6)]
    return texts + [" ".join(t.split()[: pick.randrange(25, 60)]) for t in texts for _ in range(4)]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 66), (1, 60), (2, 50)])
def test_components_equal_brute_force(spark, documents, n, percent):
    texts = varied(n, 16) + stretched(percent)
    got = jaccard_components(documents(*texts), n, percent).collect()
    assert sorted(tuple(r) for r in got) == brute(list(enumerate(texts, 1)), n, percent)


def test_empty_table_null_id_and_repeated_rows(spark, documents):
    assert jaccard_components(documents("x").limit(0)).collect() == []
    rows = documents((None, "a b c d e f", "s"), (4, "a b c d e f", "s"), (4, "a b c d e f", "s"))
    got = jaccard_components(rows).collect()
    assert sorted((tuple(r) for r in got), key=str) == [(4, 2, 4), (4, 2, 4), (None, 2, None)]


def test_extra_columns_may_clash(spark):
    rows = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n long, signatures string")
    assert [tuple(r) for r in jaccard_components(rows).collect()] == [(1, 1, 1)]


def test_search_links_all_that_reach_the_overlap():
    pick = np.random.default_rng(1)
    base = [np.unique(pick.integers(0, 5000, 60).astype(np.uint64)) for _ in range(20)]
    near = [np.unique(np.concatenate([s[2:], pick.integers(6000, 7000, 2).astype(np.uint64)])) for s in base]
    sets = base + near
    group = list(range(len(sets)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in link_forest(sets, 80):
        group[root(a)] = root(b)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert root(a) == root(b)


def test_shared_elements_are_counted_over_all_parts():
    pick = np.random.default_rng(2)
    owners = np.repeat(np.arange(-3, 57, dtype=np.int64) * 10**15, 50)
    sets = [pick.choice(2500, 50, replace=False) for _ in range(60)]
    values = pick.integers(0, 2**63, 2500).astype(np.uint64) << np.uint64(1)
    elements = values[np.concatenate(sets)]
    held = {}
    for own, value in zip(owners.tolist(), elements.tolist(), strict=True):
        held.setdefault(value, set()).add(own)
    expected = {}
    for own in held.values():
        for o in own if len(own) > 1 else ():
            expected[o] = expected.get(o, 0) + 1
    got, buckets = {}, {}
    for a in range(0, 3000, 1000):
        batch = _packed(owners[a : a + 1000], elements[a : a + 1000], 64).to_pydict()
        for bucket, counted, raw in zip(batch["bucket"], batch["counted"], batch["data"], strict=True):
            if counted:
                for o, c in np.frombuffer(raw, "<i8").reshape(2, -1).T.tolist():
                    got[o] = got.get(o, 0) + c
            else:
                buckets.setdefault(bucket, []).append(raw)
    for parts in buckets.values():
        for o, c in np.stack(_holders(parts)).T.tolist():
            got[o] = got.get(o, 0) + c
    assert got == expected


def test_a_quoted_passage_brings_no_sets_together(spark, documents):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"own{d}x{i}" for i in range(40)) for d in range(40)]
    near = [f"{t} end" for t in texts[:3]]
    rows = documents(*texts, *near).select("doc_id", F.col("text"))
    kept = _shared_counts(rows, 5, 80, 64).where("shared >= 77").count()
    assert kept == 6
    elements = _elements(rows.where("doc_id in (1, 2, 3, 41, 42, 43)"), 5, 80)
    labels = components(_meetings(elements))
    assert labels.groupBy("label").count().count() == 3
