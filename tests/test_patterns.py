import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import patterns

MIN = 60_000


def views(spark, rows):
    """rows of (user, ct, hit)."""
    return spark.createDataFrame(
        [(u, ct, h, i, "d", "r", "ip", "1") for i, (u, ct, h) in enumerate(rows)],
        "userId string, ct long, hit boolean, seq long, userDevice string, userRegion string, userRegionIP string, duration string",
    )


def brute(rows, times, within, keyed=False):
    """Match count per row by trying all sub-runs."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], i))
    groups = {}
    for i in order:
        groups.setdefault(rows[i][0] if keyed else None, []).append(i)
    counts = {}
    for group in groups.values():
        for a in range(len(group)):
            for b in range(a, len(group)):
                if not rows[group[b]][2] or rows[group[b]][1] - rows[group[a]][1] >= within:
                    break
                if b - a + 1 >= times:
                    for p in range(a, b + 1):
                        counts[group[p]] = counts.get(group[p], 0) + 1
    return counts


def found(df, **options):
    return {r.seq: r.matches for r in patterns.repeat_matches(df, F.col("hit"), **options).collect()}


@pytest.mark.parametrize("length,matches,alert_rows", [(2, 0, 0), (3, 1, 3), (4, 3, 10), (5, 6, 22)])
def test_runs(spark, length, matches, alert_rows):
    rows = [("u", i, True) for i in range(length)] + [("u", 100, False)]
    df = views(spark, rows)
    counts = found(df)
    assert counts == brute(rows, 3, 5 * MIN)
    assert matches == (length - 1) * (length - 2) // 2
    hits = patterns.repeat_matches(df, F.col("hit"))
    assert patterns.alerts(hits, repeat=True).count() == alert_rows == sum(counts.values())
    assert patterns.alerts(hits).count() == len(counts)


def test_broken_run(spark):
    rows = [("u", 0, True), ("u", 1, True), ("v", 2, False), ("u", 3, True)]
    assert found(views(spark, rows)) == {}
    assert found(views(spark, rows), keys=["userId"]) == {0: 1, 1: 1, 3: 1}


@pytest.mark.parametrize("last,hits", [(5 * MIN, 0), (5 * MIN - 1, 3)])
def test_reach_is_exclusive(spark, last, hits):
    assert len(found(views(spark, [("u", 0, True), ("u", 1, True), ("u", last, True)]))) == hits


def test_equal_times(spark):
    rows = [("u", 7, True)] * 5
    assert found(views(spark, rows)) == brute(rows, 3, 5 * MIN)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("stretch_rows", [10**6, 10])
@pytest.mark.parametrize("times,keyed", [(1, False), (2, False), (3, True), (5, False)])
def test_random(spark, seed, times, keyed, stretch_rows):
    rnd = random.Random(seed * 10 + times)
    rows = [(rnd.choice("uvw"), rnd.randint(-3_000, 12_000), rnd.random() < 0.8) for _ in range(400)]
    got = found(views(spark, rows), times=times, within_ms=300, keys=["userId"] if keyed else (), span=3,
                stretch_rows=stretch_rows)
    assert got == brute(rows, times, 300, keyed)


@pytest.mark.parametrize("stretch_rows", [10**6, 10])
@pytest.mark.parametrize("times", [1, 3])
def test_repeat_events(spark, times, stretch_rows):
    rnd = random.Random(times)
    rows = [(rnd.choice("uv"), rnd.randint(0, 5_000), rnd.random() < 0.7) for _ in range(200)]
    got = patterns.repeat_events(views(spark, rows), F.col("hit"), times, 400, ["userId"], span=3,
                                 stretch_rows=stretch_rows).collect()
    order = sorted((r for r in enumerate(rows) if r[1][2]), key=lambda r: (r[1][1], r[0]))
    want = {}
    for at, (i, (user, ct, _)) in enumerate(order):
        n = sum(1 for _, (u, c, _) in order[: at + 1] if u == user and ct - c < 400)
        if n >= times:
            want[i] = n
    assert {r.seq: r.inWindow for r in got} == want
