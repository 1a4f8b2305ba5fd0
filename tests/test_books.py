"""Booked micro-batches: every row is counted, open or late; replays change nothing."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from kerbwatch.session import work_path
from kerbwatch.streaming import books

T0 = datetime(2024, 1, 1)
SCHEMA = "camera_id string, track_id bigint, violation_type string, violation_id bigint, ts timestamp"
HOURLY = "hour_bucket timestamp, camera_id string, violation_type string, count bigint"
SESSIONS = "camera_id string, track_id bigint, first_seen timestamp, last_seen timestamp, sightings bigint"


def batches(seed, n=6, size=60):
    """Rows that come in time order but for some that come much too late."""
    rnd, out, now = random.Random(seed), [], T0
    for b in range(n):
        rows = []
        for i in range(size):
            now += timedelta(minutes=rnd.randrange(3))
            at = now - timedelta(minutes=rnd.choice([0, 0, 0, 4, 9, 300]) if b else 0)
            rows.append((rnd.choice("ab"), rnd.randrange(3), rnd.choice(["x", "y"]), rnd.randrange(200), at))
        out.append(rows)
    return out + [[], [("a", 1, "x", 5, None), (None, None, None, None, now)]]


def run(spark, write, parts):
    for n, rows in enumerate(parts):
        df = spark.createDataFrame(rows, SCHEMA)
        write(df, n)
        if n == 2:
            write(df, n)  # the batch is replayed


def test_hourly(spark):
    parts, path = batches(1), work_path(spark, "book")
    run(spark, books.hourly(path, delay=timedelta(minutes=10)), parts)
    counted, late, newest = Counter(), [], None
    for rows in parts:
        mark = newest - timedelta(minutes=10) if newest else datetime(1, 1, 1)
        for r in rows:
            hour = r[4] and r[4].replace(minute=0, second=0)
            if r[4] is None or hour + timedelta(hours=1) <= mark:
                late.append(r)
            else:
                counted[hour, r[0], r[2]] += 1
        newest = max([newest or datetime(1, 1, 1)] + [r[4] for r in rows if r[4]])
    closed = books.booked(spark, path, HOURLY).collect()
    left = books.booked(spark, path, HOURLY, "open").collect()
    assert Counter({tuple(r[:3]): r[3] for r in closed + left}) == counted and len(closed + left) == len(counted)
    assert all(r.hour_bucket + timedelta(hours=1) <= newest - timedelta(minutes=10) for r in closed) and closed and left
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, books.booked(spark, path, SCHEMA, "late").collect()), key=key) == sorted(late, key=key) and late
    ledger = spark.read.parquet(f"{path}/ledger").collect()
    assert sum(r.rows_in for r in ledger) == sum(map(len, parts)) == sum(counted.values()) + sum(r.rows_late for r in ledger)


def test_sessions(spark):
    parts, path = batches(2), work_path(spark, "book")
    ttl, delay = timedelta(minutes=7), timedelta(minutes=10)
    run(spark, books.sessions(path, ttl, delay=delay), parts)
    on_time, late, newest = [], 0, None
    for rows in parts:
        for r in rows:
            if r[4] is None or (newest and r[4] < newest - delay):
                late += 1
            else:
                on_time.append(r)
        newest = max([newest or datetime(1, 1, 1)] + [r[4] for r in rows if r[4]])
    want = []
    for key in {r[:2] for r in on_time}:
        times = sorted(r[4] for r in on_time if r[:2] == key)
        cuts = [0] + [i for i in range(1, len(times)) if times[i] - times[i - 1] >= ttl] + [len(times)]
        want += [(*key, times[a], times[b - 1], b - a) for a, b in zip(cuts, cuts[1:])]
    got = books.booked(spark, path, SESSIONS).collect() + books.booked(spark, path, SESSIONS, "open").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert books.booked(spark, path, SCHEMA, "late").count() == late > 0


def test_arrivals(spark):
    parts, path = batches(3), work_path(spark, "book")
    delay = timedelta(minutes=30)
    run(spark, books.arrivals(path, delay=delay), parts)
    known, newest, want, late = {}, None, [], 0
    for rows in parts:
        good = [r for r in rows if r[4] is not None and not (newest and r[4] < newest - delay)]
        late += len(rows) - len(good)
        for key in {r[3] for r in good} - set(known):
            known[key] = min(r[4] for r in good if r[3] == key)
            want.append((key, known[key]))
        newest = max([newest or datetime(1, 1, 1)] + [r[4] for r in rows if r[4]])
        known = {k: t for k, t in known.items() if t >= newest - delay}
    got = [(r.violation_id, r.ts) for r in books.booked(spark, path, SCHEMA).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > len({k for k, _ in got})
    assert books.booked(spark, path, SCHEMA, "late").count() == late > 0


@pytest.mark.parametrize("sizes, flushes", [([3, 3, 3, 3, 0, 12], {3: 12, 5: 12}), ([1, 1], {}), ([30], {0: 30})])
def test_buffered(spark, sizes, flushes):
    path, n, parts = work_path(spark, "book"), 0, []
    for size in sizes:
        parts.append([("a", 1, "x", n + i, T0 + timedelta(seconds=(n + i) / 10)) for i in range(size)])
        n += size
    run(spark, books.buffered(path), parts)
    done = spark.read.parquet(f"{path}/closed")
    assert {r.batch: r["count"] for r in done.groupBy("batch").count().collect()} == flushes
    left = books.booked(spark, path, SCHEMA, "open")
    assert done.count() + left.count() == n and done.select("violation_id").union(left.select("violation_id")).distinct().count() == n


def test_buffered_by_time(spark):
    path = work_path(spark, "book")
    run(spark, books.buffered(path), [[("a", 1, "x", 1, T0)], [("a", 1, "x", 2, T0 + timedelta(seconds=5))]])
    assert books.booked(spark, path, SCHEMA).count() == 2
