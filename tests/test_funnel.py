from __future__ import annotations

import random
from collections import Counter

import pytest

from clickloom.operators import funnel
from tests.rows import action, actions


def brute_force(rows):
    """(session, from, to) counts by sorting every session."""
    sessions = {}
    for row in rows:
        sessions.setdefault(row[2], []).append((row[4], row[3]))
    pairs = Counter()
    for session, visits in sessions.items():
        pages = [page for _, page in sorted(visits)]
        for pair in zip(pages, pages[1:]):
            pairs[(session, *pair)] += 1
    return pairs


def counted(spark, rows, slice_seconds):
    got = Counter()
    for r in funnel.page_transitions(actions(spark, rows), slice_seconds).collect():
        got[(r.session_id, r.from_page, r.to_page)] += r.transitions
    return got


@pytest.mark.parametrize("slice_seconds", [1, 7, 3600])
@pytest.mark.parametrize("seed", [1, 2])
def test_transitions_equal_brute_force(spark, seed, slice_seconds):
    rng = random.Random(seed)
    rows = [
        action(f"s{rng.randrange(6)}", rng.randrange(60), page=rng.randrange(4)) for _ in range(300)
    ]
    # One session with a third of all rows, many of them in the same second.
    rows += [action("hot", rng.choice([5, 5, 5, 40, 4000]), page=rng.randrange(3)) for _ in range(150)]
    assert counted(spark, rows, slice_seconds) == brute_force(rows)


def test_lone_actions_have_no_transition(spark):
    assert counted(spark, [action("a"), action("b")], 3600) == {}


LOG = [
    action("a", 0, page=1),
    action("a", 1, page=2),
    action("a", 2, page=1),
    action("a", 3, page=2),
    action("b", 0, page=1),
    action("b", 1, page=3),
]


def rates(spark, flow):
    log = actions(spark, LOG)
    pv = funnel.page_split_pv(log, flow)
    return funnel.page_convert_rate(pv, funnel.start_page_pv(log, flow), flow)


def test_rates(spark):
    got = rates(spark, (1, 2, 1)).orderBy("step").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 2, 0.67), (2, 2, 1, 1, 0.5)]


def test_repeated_step_has_a_row_per_position(spark):
    got = rates(spark, (1, 2, 1, 2)).orderBy("step").collect()
    assert [(r.step, r.pv, r.convert_rate) for r in got] == [(1, 2, 0.67), (2, 1, 0.5), (3, 2, 2.0)]


def test_step_never_seen(spark):
    got = rates(spark, (1, 9, 2)).orderBy("step").collect()
    assert [(r.pv, r.convert_rate) for r in got] == [(0, 0.0), (0, None)]


def test_first_page_never_seen(spark):
    got = rates(spark, (9, 1)).collect()
    assert [(r.pv, r.convert_rate) for r in got] == [(0, None)]


def test_flow_of_one_page(spark):
    assert rates(spark, (1,)).count() == 0


def test_rate_string(spark):
    text = funnel.page_convert_rate_string(rates(spark, (1, 2, 9, 2)), 3).first()
    assert tuple(text) == (3, "1_2=0.67|2_9=0.0|9_2=null")
