import random

import pytest

from orderflow.operators.spread import remote_logins, values_in_reach

SCHEMA = "userId string, userRegion string, ct long, n int, _at int, _step string, inReach int"


def logins(spark, rows):
    """rows of (user, region, time)."""
    frame = spark.createDataFrame([(*r, n, 0, "clash", 0) for n, r in enumerate(rows)], SCHEMA)
    return frame.drop("_at", "_step", "inReach").repartition(3)


def brute(rows, within):
    found = {}
    for n, (user, _, ct) in enumerate(rows):
        if ct is not None:
            found[n] = len({r for u, r, t in rows if u == user and r is not None and t is not None and ct - within < t <= ct})
    return found


def counted(spark, rows, within):
    got = values_in_reach(logins(spark, rows), ["userId"], "userRegion", within)
    return {r["n"]: r["inReach"] for r in got.collect()}


@pytest.mark.parametrize("seed, users, span, within", [(1, "aaab", 300, 20), (2, "abc", 40, 10), (3, "a", 5, 2), (4, "ab", 2000, 1)])
def test_against_looking_at_every_pair(spark, seed, users, span, within):
    rng = random.Random(seed)
    rows = [(rng.choice([*users, None]), rng.choice(["R1", "R2", "R3", "R4", None]), rng.choice([None, *range(span)]))
            for _ in range(400)]
    rows += rows[:30]
    assert counted(spark, rows, within) == brute(rows, within)


def test_reach_is_exclusive_and_renewed_by_each_sight(spark):
    rows = [("u", "A", 0), ("u", "B", 10), ("u", "A", 9), ("u", "B", 18), ("u", "B", 19)]
    assert counted(spark, rows, 10) == {0: 1, 1: 2, 2: 1, 3: 2, 4: 1}


def test_sights_of_one_moment_see_each_other(spark):
    assert counted(spark, [("u", x, 5) for x in "ABCA"], 1) == {0: 3, 1: 3, 2: 3, 3: 3}


def test_hot_user(spark):
    rng = random.Random(9)
    rows = [("hot", rng.choice("ABCDEF"), rng.randrange(3000)) for _ in range(3000)] + [("cold", "A", 5)]
    assert counted(spark, rows, 4) == brute(rows, 4)


def test_alerts(spark):
    rows = [("u", "A", 0), ("u", "B", 1), ("u", "C", 2), ("v", "A", 0), ("v", "A", 1), (None, "A", 0), (None, "B", 1), (None, "C", 2)]
    found = remote_logins(logins(spark, rows), most=2, within_ms=100)
    assert [(r["n"], r["regions"]) for r in found.collect()] == [(2, 3)]
    assert remote_logins(logins(spark, rows).limit(0)).collect() == []
