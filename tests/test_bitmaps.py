import random

from pyspark.sql import functions as F

from orderflow.operators import bitmaps

SCHEMA = "traffic string, region string, userID string, ct long"
SECOND = 1000


def orders(spark, n=3000, seed=1, users=400):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice("RS"), rng.choice([None, *[f"u{k}" for k in range(users)]]),
             rng.choice([None, *range(0, 3_600_000, 997)])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def counts(frame, keys):
    return {tuple(r[k] for k in keys) + (r["startWindowTime"],): r["users"] for r in bitmaps.distinct_users(frame, keys).collect()}


def brute(rows, keys, size):
    found = {}
    for traffic, region, user, ct in rows:
        if user is not None and ct is not None:
            row = {"traffic": traffic, "region": region}
            found.setdefault((*[row[k] for k in keys], ct // size * size), set()).add(user)
    return {k: len(v) for k, v in found.items()}


def test_numbers_are_dense_and_stay(spark):
    rows, frame = orders(spark)
    first = bitmaps.numbered(frame, "userID")
    numbers = {r["userID"]: r["number"] for r in first.collect()}
    assert sorted(numbers.values()) == list(range(len(numbers))) and None not in numbers
    more = spark.createDataFrame([("a", "R", u, 0) for u in ("u1", "new1", "new2", None)], SCHEMA)
    grown = {r["userID"]: r["number"] for r in bitmaps.numbered(more, "userID", first).collect()}
    assert {u: grown[u] for u in numbers} == numbers
    assert sorted(grown[u] for u in ("new1", "new2")) == [len(numbers), len(numbers) + 1] and len(grown) == len(numbers) + 2


def test_roll_up_equals_a_count_over_rows(spark):
    rows, frame = orders(spark)
    keys = ["traffic", "region"]
    small = bitmaps.user_bitmaps(frame, bitmaps.numbered(frame, "userID"), keys, "userID", 10 * SECOND)
    assert counts(small, keys) == brute(rows, keys, 10 * SECOND)
    for fewer in (keys, ["traffic"], []):
        assert counts(bitmaps.rolled_up(small, fewer, 600 * SECOND), fewer) == brute(rows, fewer, 600 * SECOND)
    twice = bitmaps.rolled_up(bitmaps.rolled_up(small, keys, 60 * SECOND), ["region"], 3600 * SECOND)
    assert counts(twice, ["region"]) == brute(rows, ["region"], 3600 * SECOND)


def test_many_buckets(spark):
    frame = spark.range(0, 200_000, 3).selectExpr("'a' AS traffic", "cast(id AS string) AS userID", "id % 50 AS ct")
    numbers = spark.range(200_000).selectExpr("cast(id AS string) AS userID", "id AS number")
    made = bitmaps.user_bitmaps(frame, numbers, ["traffic"], "userID", 10)
    assert made.select("bucket").distinct().count() == 7
    assert counts(bitmaps.rolled_up(made, ["traffic"], 100), ["traffic"]) == {("a", 0): 66_667}


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    numbers = bitmaps.numbered(frame, "userID")
    assert numbers.collect() == [] and bitmaps.user_bitmaps(frame, numbers, ["traffic"], "userID", 10).collect() == []


def test_a_window_of_few_users_is_small(spark):
    frame = spark.range(1000).selectExpr("'a' AS traffic", "cast(id * 70 AS string) AS userID", "id * 10 AS ct")
    numbers = spark.range(70_000).selectExpr("cast(id AS string) AS userID", "id AS number")
    made = bitmaps.user_bitmaps(frame, numbers, ["traffic"], "userID", 10)
    size = F.octet_length(F.col("bitmap").cast("string"))
    assert made.agg(F.count("*"), F.max(size) <= 20).first() == (1000, True)
    assert counts(bitmaps.rolled_up(made, ["traffic"], 10_000), ["traffic"]) == {("a", 0): 1000}
