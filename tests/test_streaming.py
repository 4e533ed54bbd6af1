from __future__ import annotations

import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.checks.registry import _arrivals
from clickloom.operators import ads
from clickloom.sources import ad_log_rejects, ad_stream, parse_ad_log
from clickloom.streaming import (
    AdClickStream,
    ad_stat_stream,
    ad_trend_stream,
    batch_counts,
    screened,
    start_ad_stream,
    start_upsert,
)
from clickloom.streaming.screen import BUCKETS

DAY = 86_400_000
DAY1 = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def line(day, user, ad, city="c1", offset=0):
    return f"{DAY1 + (day - 1) * DAY + offset} p1 {city} {user} {ad}"


# Day 1: user 7 reaches 3 clicks on ad 1 (a fourth one follows in the same batch), user 8 does not.
# Day 2: user 8 reaches 3 on ad 2. Day 3: both are gone, user 9 stays.
DAYS = [
    [line(1, 7, 1, offset=i) for i in range(4)] + [line(1, 8, 2), line(1, 8, 2), line(1, 8, 3)],
    [line(2, 7, 5)] + [line(2, 8, 2, offset=i) for i in range(3)] + [line(2, 9, 1)],
    [line(3, 8, 9), line(3, 7, 1), line(3, 9, 1), line(3, 9, 1, "c2")],
]
BAD = ["1 p c 3", "1 p c 3 4 5", "1 p c x 4", "t p c 3 4", ""]


def text_lines(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "value string")


def test_log_parse(spark):
    df = text_lines(spark, DAYS[0] + BAD)
    assert tuple(ad_log_rejects(df).first()) == (len(BAD), len(DAYS[0]) + len(BAD))
    parsed = parse_ad_log(df)
    assert parsed.count() == len(DAYS[0])
    row = parsed.where("user_id = 8 and ad_id = 3").first()
    assert (row.date, row.province, row.city) == ("2024-01-01", "p1", "c1")


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def arrive(folders, name, lines):
    (folders / "in" / f"{name}.txt").write_text("\n".join(lines) + "\n")


def run_job(spark, folders, job, **options):
    clicks = ad_stream(spark, "text", {"path": str(folders / "in"), **options})
    queries = start_ad_stream(clicks, job, str(folders / "checkpoint"), available_now=True)
    queries.awaitTermination()
    return queries


def bag(df, columns=None):
    # Stored tables have their partition column last.
    return Counter(tuple(row) for row in df.select(columns or df.columns).collect())


def test_job_over_three_days(spark, folders):
    root = str(folders / "state")
    for number, lines in enumerate(DAYS):
        arrive(folders, f"day{number}", lines + BAD)
        # A new object every time, as after a restart.
        job = AdClickStream(spark, root, 3)
        run_job(spark, folders, job)

    everything = parse_ad_log(text_lines(spark, sum(DAYS, [])))
    columns = ["ts", "date", "province", "city", "user_id", "ad_id"]
    clean = ads.clean_clicks_by_day(everything, 3).select(*columns)
    assert clean.count() == 13
    assert bag(job.clean_clicks().select(*columns)) == bag(clean)
    assert bag(job.blacklist()) == Counter({(7, 0): 1, (8, 1): 1})
    assert bag(job.user_ad_counts()) == bag(ads.daily_user_ad_clicks(clean))
    stat = ads.ad_stat(clean)
    assert bag(job.ad_stat()) == bag(stat)
    assert bag(job.ad_province_top()) == bag(ads.ad_province_top(ads.ad_province_counts(stat)))
    assert bag(job.ad_click_trend()) == bag(ads.ad_click_trend(clean))


def test_repeated_batches_change_nothing(spark, folders):
    job = AdClickStream(spark, str(folders / "state"), 3)
    for number, lines in enumerate(DAYS):
        arrive(folders, f"day{number}", lines)
        run_job(spark, folders, job)
        # A batch whose commit was lost runs again from the state before it.
        for query in ("screen", "ad_stat", "ad_click_trend"):
            commits = folders / "checkpoint" / query / "commits"
            (commits / str(number)).unlink()
            (commits / f".{number}.crc").unlink(missing_ok=True)
        run_job(spark, folders, job)
    assert bag(job.blacklist()) == Counter({(7, 0): 1, (8, 1): 1})
    assert job.clean_clicks().count() == 13
    assert job.user_ad_counts().agg(F.sum("click_count")).first()[0] == 13
    assert job.ad_stat().agg(F.sum("click_count")).first()[0] == 13
    assert job.ad_click_trend().agg(F.sum("click_count")).first()[0] == 13


def test_threshold_is_reached_over_batches_of_any_size(spark, folders):
    job = AdClickStream(spark, str(folders / "state"), 3)
    for number in range(5):
        arrive(folders, f"b{number}", [line(1, 7, 1, offset=number)])
        if number in (1, 2, 4):
            # Two clicks come together, then one, then two.
            run_job(spark, folders, job)
    assert bag(job.blacklist()) == Counter({(7, 1): 1})
    assert job.clean_clicks().count() == 3
    assert bag(job.user_ad_counts()) == Counter({("2024-01-01", 7, 1, 3): 1})


def test_no_click_however_dated_drops_another(spark, folders):
    """A click of today, one of 1970 and a late one in a replay of older logs."""
    now = f"{int(time.time() * 1000)} p1 c1 5 1"
    stray = "1000 p1 c1 5 1"
    job = AdClickStream(spark, str(folders / "state"), 3, keep_days=2)
    days = [[line(1, 1, 1), now], [line(9, 1, 1), stray], [line(1, 1, 1, offset=5), line(9, 2, 1)]]
    seen = []
    for number, lines in enumerate(days):
        arrive(folders, f"b{number}", lines)
        run_job(spark, folders, job)
        written = {str(f) for f in (folders / "state" / "ad_stat").rglob("*.parquet") if "1970" not in str(f)}
        seen.append(({(r.date, r.click_count) for r in job.ad_stat().collect()}, written))
    today = parse_ad_log(text_lines(spark, [now])).first().date
    assert seen[1][0] == {("2024-01-01", 1), (today, 1), ("2024-01-09", 1), ("1970-01-01", 1)}
    assert seen[2][0] == {("2024-01-01", 2), (today, 1), ("2024-01-09", 2), ("1970-01-01", 1)}
    # Files of days without a new click stay as they are.
    assert len(seen[1][1] & seen[0][1]) == 2
    assert bag(job.user_ad_counts()) == Counter(
        {
            ("2024-01-01", 1, 1, 2): 1,
            (today, 5, 1, 1): 1,
            ("1970-01-01", 5, 1, 1): 1,
            ("2024-01-09", 1, 1, 1): 1,
            ("2024-01-09", 2, 1, 1): 1,
        }
    )


def test_totals_that_nothing_comes_for_are_freed(spark, folders, monkeypatch):
    # Two seconds instead of days.
    monkeypatch.setattr("clickloom.streaming.job.screened", lambda c, n, _: screened(c, n, 2 / 86_400))
    job = AdClickStream(spark, str(folders / "state"), 3, keep_days=1)
    for number in range(3):
        arrive(folders, f"b{number}", [line(1, 7, 1), line(1, 8, 1), line(1, 8, 1)])
        run_job(spark, folders, job)
        time.sleep(3)
    # No total lived long enough to reach three.
    assert job.blacklist().count() == 0
    assert bag(job.user_ad_counts()) == Counter({("2024-01-01", 7, 1, 1): 1, ("2024-01-01", 8, 1, 2): 1})


def test_small_batches_are_quick(spark, folders):
    job = AdClickStream(spark, str(folders / "state"), 3)
    for number in range(6):
        arrive(folders, f"b{number}", [line(1, number, 1), line(1, 9, number)])
    queries = run_job(spark, folders, job, maxFilesPerTrigger="1")
    spent = sorted(p["durationMs"]["triggerExecution"] for p in queries.screen.recentProgress)
    assert len(spent) == 6 and spent[3] < 5000


def test_unreadable_and_late_lines_are_counted(spark, folders):
    hour = 3_600_000
    batches = [
        [line(1, 1, 1, offset=10 * hour), *BAD],
        [line(1, 1, 1, offset=13 * hour)],
        [line(1, 1, 1, offset=10 * hour), BAD[0]],
    ]
    seen = {}
    for number, lines in enumerate(batches):
        arrive(folders, f"b{number}", lines)
        clicks = ad_stream(spark, "text", {"path": str(folders / "in")})
        keys = ["date", "hour", "minute", "ad_id"]
        counts = ad_trend_stream(clicks, "60 minutes")
        query = start_upsert(counts, str(folders / "t"), keys, str(folders / "cp"), available_now=True)
        query.awaitTermination()
        for r in batch_counts(query):
            old = seen.get(r["batch_id"], {})
            seen[r["batch_id"]] = {k: r[k] + old.get(k, 0) for k in ("lines", "rejected", "late")}
    lines = sum(r["lines"] for r in seen.values())
    rejected = sum(r["rejected"] for r in seen.values())
    everything = text_lines(spark, sum(batches, []))
    assert (rejected, lines) == tuple(ad_log_rejects(everything).first())
    assert sum(r["late"] for r in seen.values()) == 1


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "Asia/Kolkata", "America/Sao_Paulo"])
def test_days_are_those_of_the_session_zone(spark, folders, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        lines = [line(1, 1, 1, offset=i * 1_800_000) for i in range(96)]
        arrive(folders, "b", lines)
        counts = ad_stat_stream(ad_stream(spark, "text", {"path": str(folders / "in")}), "3 days")
        stored = stream_into(spark, folders, counts, ["date", "province", "city", "ad_id"])
        assert bag(stored) == bag(ads.ad_stat(parse_ad_log(text_lines(spark, lines))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sliding_windows_equal_counting_each(spark, folders):
    offsets = [0, 3_000, 9_999, 10_000, 59_000, 60_000, 3_599_000, 3_600_000, 3_605_000, 9_000_000]
    clicks = parse_ad_log(text_lines(spark, [line(1, 1, i % 2, offset=o) for i, o in enumerate(offsets)]))
    # They arrive up to half an hour later.
    late = clicks.withColumn("arrival", F.col("ts") + F.make_interval(secs=F.pmod(F.hash("ts"), F.lit(1800))))
    panes = ads.ad_click_panes(late, "arrival")
    arrived = [(r.arrival, r.ts.replace(second=0, microsecond=0), r.ad_id) for r in late.collect()]
    slides = ads.sliding_trend(panes).collect()
    assert len(slides) <= 2 * len(offsets)
    for r in slides:
        minute = (f"{r.date} {r.hour}:{r.minute}", r.ad_id)
        low = r.slide_end - timedelta(hours=1)
        inside = [(m.strftime("%Y-%m-%d %H:%M"), ad) for a, m, ad in arrived if low <= a < r.slide_end]
        assert r.click_count == inside.count(minute)
    end = max(r.slide_end for r in slides if r.click_count)
    shown = {(r.date, r.hour, r.minute, r.ad_id): r.click_count for r in slides if r.slide_end <= end}
    found = ads.window_at(panes, end.strftime("%Y-%m-%d %H:%M:%S")).collect()
    last = {}
    for r in sorted(slides, key=lambda r: r.slide_end):
        if r.slide_end <= end:
            last[r.date, r.hour, r.minute, r.ad_id] = r.click_count
    assert {(r.date, r.hour, r.minute, r.ad_id): r.click_count for r in found} == {
        k: n for k, n in last.items() if n
    } and set(last) == set(shown)


def stream_into(spark, folders, counts, keys):
    table = str(folders / "table")
    start_upsert(counts, table, keys, str(folders / "cp"), available_now=True).awaitTermination()
    return spark.read.schema(counts.schema).parquet(table).select(counts.columns)


def test_running_totals_over_restarts(spark, folders):
    for number, lines in enumerate(DAYS):
        arrive(folders, f"day{number}", lines)
        clicks = ad_stream(spark, "text", {"path": str(folders / "in")})
        counts = ad_stat_stream(clicks)
        stored = stream_into(spark, folders, counts, ["date", "province", "city", "ad_id"])
    everything = parse_ad_log(text_lines(spark, sum(DAYS, [])))
    assert bag(stored) == bag(ads.ad_stat(everything))


def test_minute_trend_and_late_clicks(spark, folders):
    hour = 3_600_000
    batches = [
        [line(1, 1, 1, offset=10 * hour), line(1, 2, 1, offset=10 * hour + 59_000)],
        # 30 minutes late counts; it also advances nothing.
        [line(1, 1, 1, offset=10 * hour - 30 * 60_000), line(1, 1, 1, offset=13 * hour)],
        # Three hours behind the newest click: dropped. The other minute grows.
        [line(1, 1, 1, offset=10 * hour), line(1, 5, 1, offset=13 * hour + 1_000)],
    ]
    for number, lines in enumerate(batches):
        arrive(folders, f"b{number}", lines)
        clicks = ad_stream(spark, "text", {"path": str(folders / "in")})
        keys = ["date", "hour", "minute", "ad_id"]
        stored = stream_into(spark, folders, ad_trend_stream(clicks, "60 minutes"), keys)
    assert bag(stored) == Counter(
        {
            ("2024-01-01", "10", "00", 1, 2): 1,
            ("2024-01-01", "09", "30", 1, 1): 1,
            ("2024-01-01", "13", "00", 1, 2): 1,
        }
    )
    recent = ads.last_hour(stored, "2024-01-01 13:30:00")
    assert [(r.hour, r.click_count) for r in recent.collect()] == [("13", 2)]


def test_threshold_counts_days_and_ads_apart(spark):
    clicks = parse_ad_log(
        text_lines(spark, [line(1, 1, 1), line(1, 1, 2), line(2, 1, 1)] + [line(1, 2, 1)] * 3)
    )
    assert [r.user_id for r in ads.ad_blacklist(ads.daily_user_ad_clicks(clicks), 3).collect()] == [2]
    kept = ads.drop_blacklisted(clicks, spark.createDataFrame([(2,)], "user_id bigint"))
    assert kept.count() == 3


def click_files(spark, folders, *batches):
    """Clicks (ts, date, province, city, user_id, ad_id) as a stream, one file and batch each."""
    schema = "ts timestamp, date string, province string, city string, user_id bigint, ad_id bigint"
    for rows in batches:
        frame = spark.createDataFrame([(None if r[0] is None else datetime.fromtimestamp(r[0]), *r[1:]) for r in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(str(folders / "clicks"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folders / "clicks"))


def test_states_do_not_grow_with_the_users(spark, folders):
    """State rows and output frames are one per bucket and day; partitions are no more than cores."""
    days = [[(d * 86_400 + u, f"d{d}", "p", "c", u, u % 3) for u in range(3000)] for d in range(2)]
    clicks = click_files(spark, folders, *days)
    job = AdClickStream(spark, str(folders / "state"), 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        queries = start_ad_stream(clicks, job, str(folders / "checkpoint"), available_now=True, tables=())
        queries.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    states = [p.stateOperators[0] for p in queries.screen.recentProgress if p.numInputRows]
    assert len(states) == 2 and all(s.numShufflePartitions <= 12 for s in states)
    assert 0 < states[-1].numRowsTotal <= 2 * BUCKETS
    assert job.clean_clicks().count() == 6000
    assert job.user_ad_counts().agg(F.sum("click_count"), F.count("*")).first()[:] == (6000, 6000)
    assert job.blacklist().count() == 0


def test_nulls_and_large_ids_pass_the_screen_unchanged(spark, folders):
    large = 2**62 + 1
    one = [
        (0.000001, "d1", "p", None, large, large),
        (None, "d1", None, "c", large, large),
        (1, "d1", "p", "c", large + 1, None),
        (1, "d1", "p", "c", large + 1, 0),
        (2, None, "p", "c", None, 5),
        (2, None, "p", "c", None, 5),
        (3, "d1", "p", "c", 0, 5),
    ]
    two = [
        (4, "d1", "p", "c", large, large),
        (4, "d1", "p", "c", large + 1, None),
        (5, None, "p", "c", None, 5),
        (6, "d1", "p", "c", 0, 5),
    ]
    three = [(7, "d1", "p", "c", u, 9) for u in (large, large + 1, None, 0)]
    clicks = click_files(spark, folders, one, two, three)
    job = AdClickStream(spark, str(folders / "state"), 3)
    start_ad_stream(clicks, job, str(folders / "checkpoint"), available_now=True, tables=()).awaitTermination()
    assert bag(job.blacklist()) == Counter({(large, 1): 1, (None, 1): 1})
    # The third batch has no click of the two that were banned in the second.
    passed = one + two + [three[1], three[3]]
    seconds = F.expr("unix_micros(ts) / 1e6")
    found = bag(job.clean_clicks().withColumn("ts", seconds), ["ts", "date", "province", "city", "user_id", "ad_id"])
    assert found == Counter(passed)
    assert bag(job.user_ad_counts(), ["date", "user_id", "ad_id", "click_count"]) == Counter(
        {
            ("d1", large, large, 3): 1,
            ("d1", large + 1, None, 2): 1,
            ("d1", large + 1, 0, 1): 1,
            (None, None, 5, 3): 1,
            ("d1", 0, 5, 2): 1,
            ("d1", large + 1, 9, 1): 1,
            ("d1", 0, 9, 1): 1,
        }
    )


def test_arrivals_are_written_in_parallel(spark, tmp_path):
    """An arrival may have a file per task; with one file each, arrivals come in the order of their days."""
    rows = spark.range(3000).selectExpr(
        "id as event_id", "timestamp_seconds(1704067200 + id % 30 * 86400) as ts", "id % 7 as user_id"
    )
    rows.repartition(4).write.parquet(str(tmp_path / "events.parquet"))

    def files(name, days, **most):
        arrived = _arrivals(spark, str(tmp_path), str(tmp_path / name), days, **most)
        return [len([*(tmp_path / name).glob("*.parquet")]) for _ in arrived]

    assert files("one", 1) == [*range(1, 31)]
    assert 3 < files("many", 10, files=3)[-1] <= 9
    for name in ("many", "one"):
        assert bag(spark.read.parquet(str(tmp_path / name))) == bag(rows)
    files = sorted((tmp_path / "one").glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    assert [spark.read.parquet(str(f)).selectExpr("max(day(ts))").first()[0] for f in files] == [*range(1, 31)]
