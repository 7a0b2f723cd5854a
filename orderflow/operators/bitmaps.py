"""Distinct users that add up: bitmaps over numbered users.

Users get dense numbers once. The users of a key and window are bitmaps of their numbers, in words of 64 bits: a row for
each word of a bucket of 32 768 numbers that has any user, so a window of few users takes a few numbers and there are
never more rows than users. Merging the bitmaps of windows or keys gives the exact users of hours, days or coarser keys
without going back to the orders, which plain counts cannot do.
"""

from pyspark.sql import functions as F

from orderflow.operators.ordered import running_sums


def numbered(rows, user, known=None):
    """Every user of the rows with a `number` from 0 up, without gaps. Users of `known`, an earlier result, keep
    theirs and new ones go on after them, so bitmaps made with either can be merged. Null is no user."""
    users = rows.select(F.col(user)).filter(F.col(user).isNotNull()).distinct()
    first = 0
    if known is not None:
        users = users.join(known.select(user), user, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        first = 0 if last is None else last + 1
    placed = running_sums(users, [], [user], {"_n": F.lit(1)})
    fresh = placed.select(user, (F.col("_n") - 1 + first).cast("bigint").alias("number"))
    return fresh if known is None else known.select(user, "number").unionByName(fresh)


def user_bitmaps(rows, numbers, keys, user, size_ms, ct="ct"):
    """Bitmaps of the users per key and window of `size_ms`, one row per `word` of a `bucket` that has any. Repeated
    users of a window go before the numbers are looked up."""
    start = F.floor(F.col(ct) / size_ms) * size_ms
    seen = rows.filter(F.col(user).isNotNull() & F.col(ct).isNotNull()).select(
        *keys, start.alias("startWindowTime"), user
    ).distinct()
    placed = seen.join(numbers, user)
    bucket, word = F.expr("bitmap_bucket_number(number + 1)"), F.expr("cast(number % 32768 div 64 AS int)")
    return placed.groupBy(*keys, "startWindowTime", bucket.alias("bucket"), word.alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(number % 64 AS int))")).alias("bitmap")
    )


def rolled_up(bitmaps, keys, size_ms):
    """Bitmaps of longer windows, and of fewer keys."""
    start = F.floor(F.col("startWindowTime") / size_ms) * size_ms
    return bitmaps.groupBy(*keys, start.alias("startWindowTime"), "bucket", "word").agg(F.bit_or("bitmap").alias("bitmap"))


def distinct_users(bitmaps, keys):
    """Users per key and window."""
    return bitmaps.groupBy(*keys, "startWindowTime").agg(F.sum(F.bit_count("bitmap")).alias("users"))
