from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from clickloom.operators import sampling

SCHEMA = "session_id string, start_time timestamp"


def sessions_at(spark, hours):
    """``hours`` maps 'yyyy-MM-dd HH' to a number of sessions."""
    rows = [
        (f"{hour}-{i}", f"{hour}:00:{i % 60:02d}") for hour, n in hours.items() for i in range(n)
    ]
    df = spark.createDataFrame(rows, "session_id string, t string")
    return df.selectExpr("session_id", "cast(t as timestamp) as start_time")


def expected(hours, seed, total):
    """The same sample, worked out in plain Python."""
    days = defaultdict(dict)
    for hour, n in hours.items():
        days[hour[:10]][hour] = n
    picked = set()
    per_day = total // len(days) if days else 0
    for counts in days.values():
        everything = sum(counts.values())
        for hour, n in counts.items():
            take = min(int(n / everything * per_day), n)
            ids = [f"{hour}-{i}" for i in range(n)]
            ids.sort(key=lambda s: (hashlib.md5(f"{seed}:{s}".encode()).hexdigest(), s))
            picked.update(ids[:take])
    return picked


CASES = {
    "even": ({"2024-01-01 00": 40, "2024-01-01 05": 60, "2024-01-02 00": 10}, 100),
    "one hour": ({"2024-01-01 03": 250}, 100),
    "few sessions": ({"2024-01-01 03": 3, "2024-01-01 04": 1}, 100),
    "many days": ({f"2024-{1 + d // 28:02d}-{1 + d % 28:02d} 00": 2 for d in range(120)}, 100),
    "large total": ({"2024-01-01 03": 1500, "2024-01-01 04": 300}, 1400),
}


@pytest.mark.parametrize("name", CASES)
def test_sample(spark, name):
    hours, total = CASES[name]
    df = sessions_at(spark, hours)
    plan = sampling.sample_plan(df, total)
    got = {r.session_id for r in sampling.sample_sessions(df, plan, "7", total).collect()}
    assert got == expected(hours, "7", total)
    assert len(got) <= total
    sizes = {(r.date, r.hour): r.sample_size for r in plan.collect()}
    taken = Counter((s[:10], s[11:13]) for s in got)
    assert all(taken[key] == size for key, size in sizes.items())


def test_same_seed_same_sample_other_seed_other_sample(spark):
    df = sessions_at(spark, {"2024-01-01 03": 300})
    plan = sampling.sample_plan(df)

    def ids(seed):
        return {r.session_id for r in sampling.sample_sessions(df, plan, seed).collect()}

    assert ids("7") == ids("7")
    assert ids("7") != ids("8")


def test_no_sessions_no_sample(spark):
    df = spark.createDataFrame([], SCHEMA)
    plan = sampling.sample_plan(df)
    assert plan.count() == 0
    assert sampling.sample_sessions(df, plan, "7").count() == 0
