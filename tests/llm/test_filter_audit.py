"""The audit of filters against brute force; its SQL twin is checked on the sample tables."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from clickloom.llm.filter_audit import Diagram, all_orders, audit, audit_filters, failure_counts
from clickloom.llm.queries import QUERIES

from .samples import LONG, sentences, words

LABELS = "doc_id long, quality int, toxic int, note string"


def brute_audit(filters, masks):
    rows, total = {}, dict.fromkeys(filters, 0)
    bit = {f: 1 << i for i, f in enumerate(filters)}
    for order in permutations(filters):
        earlier = 0
        for step, name in enumerate(order, 1):
            own = bit[name]

            def add(test, k=0):
                return sum(w[k] for m, w in masks.items() if test(m))

            def gone(m, earlier=earlier, own=own):
                return not m & earlier and m & own

            total[name] += add(gone)
            rows["".join(order), step] = (
                add(lambda m, earlier=earlier, own=own: not m & (earlier | own)),
                add(gone),
                add(lambda m, earlier=earlier, own=own: m & earlier and m & own),
                add(lambda m, own=own: m == own),
                add(gone, 1),
                add(gone, 2),
            )
            earlier |= own
    return {(o, s, *row, total[o[s - 1]]) for (o, s), row in rows.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_every_order_once_by_adjacent_swaps(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for level in all_orders(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(n))))


@pytest.mark.parametrize("filters", ["A", "AB", "ABC", "ABCDE"])
def test_audit_equals_brute_force(filters):
    pick = random.Random(len(filters))
    for share in (0, 0.3, 1):
        masks = {
            m: (pick.randrange(1, 50), pick.randrange(9), pick.randrange(3))
            for m in range(1 << len(filters))
            if pick.random() < share
        }
        got = audit(filters, masks)
        assert len(got) == len(set(got)) and set(got) == brute_audit(filters, masks)


def test_diagrams_share_equal_branches():
    same = Diagram("ABCDE", {m: (1, 0, 0) for m in range(32)})
    # One leaf and one node a level, whatever the order.
    assert len(same.branches) == 6 and same.weight[same.root] == (32, 0, 0)
    same.swap(2)
    assert len(same.branches) == 6 and same.order == list("ABDCE")


def brute_masks(docs, labels):
    """Masks by part from rows (doc_id, text, source)."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    found = {}
    for doc, text, source in docs:
        body = text or ""
        own = words(body)
        fails = [
            len(own) < 200,
            100 * len(set(own)) < 50 * len(own),
            100 * len(re.findall("[A-Z]", body)) > 2 * len(body),
            re.search("[#$%&*|]", body) is not None,
            doc is not None and any(i is not None and i < doc and (t or "") == body for i, t, _ in docs),
        ]
        key = source or "", sum(1 << i for i, f in enumerate(fails) if f)
        n, g, t = found.get(key, (0, 0, 0))
        found[key] = (n + 1, g + (doc in good), t + (doc in toxic))
    return found


def case():
    pick = random.Random(7)
    texts = [sentences(i, pick.randrange(150, 260), pick.choice([60, 500])) for i in range(25)]
    texts += [t + pick.choice(["", " #1", " a|b", " ABCDEFGH" * 12]) for t in texts[:15]] + texts[5:12]
    texts += [None, "", "", "AB", "a", "naïve É" * 300, LONG]
    docs = [(i, t, pick.choice(["x", "y", None, ""])) for i, t in enumerate(texts)]
    # Repeated rows, rows of one id in two parts, rows without id.
    docs += [docs[3], docs[3], (4, docs[4][1], "z"), (None, texts[0], "x"), (None, "lonely text", "x")]
    pick.shuffle(docs)
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 0, 1])) for i in range(0, 60, 2)]
    return docs, [*labels, (0, 1, 1), (0, 0, 0), (None, 1, 1), (9999, 1, 1)]


def tables(spark, docs, labels):
    left = spark.createDataFrame(
        [(i, t, s, 1, "m") for i, t, s in docs], "doc_id long, text string, source string, mask int, part string"
    )
    return left, spark.createDataFrame([(*row, "n") for row in labels], LABELS)


def test_failures_equal_brute_force(spark):
    docs, labels = case()
    got = failure_counts(*tables(spark, docs, labels)).collect()
    assert {(r.part, r["mask"]): (r.docs, r.good, r.toxic) for r in got} == brute_masks(docs, labels)


def test_query(spark, tmp_path):
    docs, labels = case()
    left, right = tables(spark, docs, labels)
    left.write.parquet(f"{tmp_path}/documents.parquet")
    right.write.parquet(f"{tmp_path}/labels.parquet")
    got = [tuple(r) for r in QUERIES["op13_filter_audit"](spark, str(tmp_path)).collect()]
    masks = {}
    for (part, mask), weight in brute_masks(docs, labels).items():
        masks.setdefault(part, {})[mask] = weight
    want = {(part, *row) for part, own in masks.items() for row in brute_audit("ABCDE", own)}
    assert len(got) == 600 * len(masks) and set(got) == want


def test_no_documents_no_labels(spark):
    left, right = tables(spark, [(1, "one", "a")], [(1, 1, 0)])
    assert audit_filters(failure_counts(left.limit(0), right)).collect() == []
    rows = audit_filters(failure_counts(left, right.limit(0))).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    # One document, which fails A only.
    assert sum(r.removed for r in rows) == 120 == max(r.shapley for r in rows)
