"""Count windows, count-triggered running statistics and count-or-time chunks (batch forms).

The arrival order is `(ct, seq)`, then a hash of the row. The streaming forms are in `orderflow.streaming.steps`.
"""

from pyspark.sql import functions as F

from orderflow.operators.ordered import running_over_positions, running_sums, tie_break
from orderflow.operators.windows import average_fee, order_measures
from orderflow.session import stored

DAY_MS = 86_400_000


def count_chunks(rows, keys, size, order):
    """Adds `chunk`: 0 for the first `size` rows of a key, 1 for the next, and so on."""
    tied = rows.withColumn("_tie", tie_break(rows))
    placed = running_sums(tied, keys, [*order, "_tie"], {"_pos": F.lit(1)}).drop("_tie")
    return placed.withColumn("chunk", F.floor((F.col("_pos") - 1) / size))


def count_window_stats(orders, keys, size, order=("ct", "seq"), emit_tail=False, exact=False):
    """Measures of every `size` consecutive orders of a key. An unfilled last window is left out
    unless `emit_tail`."""
    needed = dict.fromkeys([*keys, *order, "ct", "fee", "adult", "yonger", "baby"])
    chunks = count_chunks(orders.select(*needed), keys, size, order)
    stats = chunks.groupBy(*keys, "chunk").agg(F.max("ct").alias("endWindowTime"), *order_measures())
    if not emit_tail:
        stats = stats.filter(F.col("orders") == size)
    return stats.select(
        *keys, "chunk", "endWindowTime", "orders", "maxFee", "totalFee", "members", average_fee(exact)
    )


def count_triggered_stats(orders, keys, size, period_ms=60_000, offset_ms=0, order=("ct", "seq"),
                          user="userID", emit_tail=False):
    """Running orders, users and totalFee of a key inside each period, reported at every `size` orders.

    First sights of a user enter the running sums as extra rows of weight 0, so users are counted
    in the same pass as orders and no task holds a user set. Orders without a user count as orders, not as users.
    """
    order = list(order)
    timed = orders.withColumn(
        "startWindowTime", F.floor((F.col("ct") - offset_ms) / period_ms) * period_ms + offset_ms
    )
    groups = [*keys, "startWindowTime"]
    slim = timed.select(*groups, user, *order, F.col("fee").cast("bigint").alias("fee"))
    # one pass over the source: written, it is read for the orders and for the first sights
    slim = stored(slim.withColumn("_tie", tie_break(slim)), "orders")
    order = [*order, "_tie"]
    first_seen = slim.filter(F.col(user).isNotNull()).groupBy(*groups, user).agg(F.min(F.struct(*order)).alias("o"))
    rows = slim.select(*groups, *order, "fee", F.lit(1).alias("_order"), F.lit(0).alias("_user"))
    sights = first_seen.select(
        *groups, *[F.col(f"o.{c}").alias(c) for c in order],
        F.lit(0).cast("bigint").alias("fee"), F.lit(0).alias("_order"), F.lit(1).alias("_user"),
    )
    rows = rows.withColumn("_new", F.lit(1)).unionByName(sights.withColumn("_new", F.lit(0)))
    running = running_snapshots(rows, groups, size, order, emit_tail)
    return running.select(
        *keys, F.date_format(F.timestamp_millis("ct"), "yyyyMMddHH").alias("etTime"),
        "startWindowTime", "ct", "orders", "users", "totalFee",
    )


def running_snapshots(rows, groups, size, order, emit_tail=False):
    """Running `orders`, `users` and `totalFee` at every `size` orders of a group.

    Rows carry weights: `_order` and `_user` counts, `fee`, and `_new` for orders of this input (0
    for first sights and for totals brought along from earlier input). A first sight has the place of
    the user's first order and comes just before it; every order has a position of its own.
    """
    placed = running_sums(rows, groups, [*order, "_order"], {"_pos": F.col("_order")})
    place = F.when(F.col("_order") > 0, F.col("_pos") - 1).otherwise(F.col("_pos"))
    chunks = (
        placed.withColumn("chunk", F.floor(place / size))
        .groupBy(*groups, "chunk")
        .agg(
            F.sum("_order").alias("_n"), F.sum("_user").alias("_u"), F.sum("fee").alias("_f"),
            F.sum("_new").alias("_new"), F.max("ct").alias("ct"),
        )
    )
    # one row per `size` orders, read twice below
    running = running_over_positions(
        stored(chunks, "chunks"), groups, "chunk", {"orders": F.col("_n"), "users": F.col("_u"), "totalFee": F.col("_f")}
    ).filter("_new > 0")
    if not emit_tail:
        running = running.filter(F.col("orders") == (F.col("chunk") + 1) * size)
    return running


def count_or_time_stats(wide_orders, keys=("productType", "toursimType"), size=10, interval_ms=60_000,
                        order=("ct", "seq"), user="userID"):
    """orders, users and totalFee of each batch of a key: `size` orders, or what is there when the
    aligned interval ends. A full batch ends with its last order, a cut-off one with the interval."""
    keys = list(keys)
    timed = wide_orders.withColumn("_interval", F.floor(F.col("ct") / interval_ms))
    timed = timed.select(*dict.fromkeys([*keys, "_interval", *order, "ct", user, "fee"]))
    chunks = count_chunks(timed, [*keys, "_interval"], size, order)
    stats = chunks.groupBy(*keys, "_interval", "chunk").agg(
        F.min("ct").alias("startWindowTime"), F.max("ct").alias("_last"),
        F.count(F.lit(1)).alias("orders"), F.count_distinct(user).alias("users"),
        F.sum(F.col("fee").cast("bigint")).alias("totalFee"),
    )
    end = F.when(F.col("orders") == size, F.col("_last")).otherwise((F.col("_interval") + 1) * interval_ms)
    return stats.select(*keys, "startWindowTime", end.alias("endWindowTime"), "orders", "users", "totalFee")
