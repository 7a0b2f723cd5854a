"""Windowed measures over orders and logs. Every function takes batch or streaming rows unless it says so."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.operators.orders import members

# The operating points of the jobs.
WINDOW = "10 seconds"
BIG_WINDOW = "60 seconds"
SLIDE = "5 seconds"
OUT_OF_ORDER = "5 milliseconds"
LATENESS = "10 seconds"
WATERMARK = "10 seconds 5 milliseconds"
# Midnight in UTC+8 as an offset from UTC midnight.
DAY_OFFSET_UTC8 = "16 hours"


def order_measures(fee="fee"):
    """orders, maxFee (never below 0), totalFee and members."""
    return [
        F.count(F.lit(1)).alias("orders"),
        F.greatest(F.max(F.col(fee).cast("bigint")), F.lit(0)).alias("maxFee"),
        F.sum(F.col(fee).cast("bigint")).alias("totalFee"),
        F.sum(members()).alias("members"),
    ]


def average_fee(exact=False):
    """totalFee per order: whole units as a double, or the true quotient when `exact`."""
    if exact:
        return (F.col("totalFee") / F.col("orders")).alias("avgFee")
    return F.expr("cast(totalFee div orders as double)").alias("avgFee")


def window_bounds(window="window", inclusive_end=False):
    """Start and end of a window column in epoch milliseconds."""
    end = F.unix_millis(F.col(f"{window}.end"))
    return [
        F.unix_millis(F.col(f"{window}.start")).alias("startWindowTime"),
        (end - 1 if inclusive_end else end).alias("endWindowTime"),
    ]


def windowed(rows, keys, measures, size=WINDOW, slide=None, offset=None, ts="ts"):
    """Measures per key and time window, with the `window` column kept.

    One hash exchange on (window, keys) after map-side partial aggregation, so a key that holds
    most rows still reaches the exchange as a few partial rows per task.
    """
    window = F.window(ts, size, slide, offset)
    return rows.groupBy(window.alias("window"), *keys).agg(*measures)


def order_window_stats(orders, keys, size=WINDOW, slide=None, offset=None, ts="ts",
                       inclusive_end=False, exact=False, fee="fee"):
    """orders, maxFee, totalFee, members and avgFee per key and window."""
    stats = windowed(orders, keys, order_measures(fee), size, slide, offset, ts)
    return stats.select(
        *keys, *window_bounds(inclusive_end=inclusive_end),
        "orders", "maxFee", "totalFee", "members", average_fee(exact),
    )


def sliding_stats(orders, keys, size, slide, pane, ts="ts", inclusive_end=False, exact=False, fee="fee"):
    """The measures of `order_window_stats` for sliding windows, put together from panes.

    `pane` divides both the window and its slide. Orders are summed per pane once; what is copied into every window
    it lies in is a pane, one row per key, so the rows of the second exchange do not grow with size / slide times the
    orders. On a stream both steps share the watermark of `ts` (append mode).
    """
    panes = windowed(orders, keys, order_measures(fee), pane, ts=ts)
    moment = panes.select(*keys, F.window_time("window").alias("_ts"), "orders", "maxFee", "totalFee", "members")
    window = F.window("_ts", size, slide)
    stats = moment.groupBy(window.alias("window"), *keys).agg(
        F.sum("orders").alias("orders"), F.max("maxFee").alias("maxFee"), F.sum("totalFee").alias("totalFee"),
        F.sum("members").alias("members"),
    )
    return stats.select(
        *keys, *window_bounds(inclusive_end=inclusive_end), "orders", "maxFee", "totalFee", "members", average_fee(exact),
    )


def region_traffic_stats(orders, size=WINDOW, **options):
    return order_window_stats(orders, ["userRegion", "traffic"], size, **options)


def type_stats(wide_orders, size=WINDOW, **options):
    """Measures per product type and tourism type; the reported end is the last millisecond inside."""
    options.setdefault("inclusive_end", True)
    return order_window_stats(wide_orders, ["productType", "toursimType"], size, **options)


def product_traffic_stats(orders, size=WINDOW, keep_window=False, **options):
    """orders and totalFee per product and traffic."""
    keys = ["productID", "traffic"]
    measures = [F.count(F.lit(1)).alias("orders"), F.sum(F.col("fee").cast("bigint")).alias("totalFee")]
    stats = windowed(orders, keys, measures, size, **options)
    window = ["window"] if keep_window else []
    return stats.select(*window, *keys, *window_bounds(), "orders", "totalFee")


def stamped(rows, name="ts"):
    """Adds the processing time, for processing-time windows."""
    return rows.withColumn(name, F.current_timestamp())


def windowed_users(rows, keys, user, sums, size, slide=None, offset=None, ts="ts", approx=False):
    """Row count, distinct users and sums per key and window; `window` is kept.

    Exact counting groups by user first, so no group ever holds the user set of a whole key.
    On a stream the exact form is two chained aggregations and therefore append-only; `approx`
    keeps one sketch per group and also runs in update mode.
    """
    window = F.window(ts, size, slide, offset).alias("window")
    if approx:
        return rows.groupBy(window, *keys).agg(
            F.count(F.lit(1)).alias("orders"),
            F.approx_count_distinct(user).alias("users"),
            *[F.sum(c).alias(n) for n, c in sums.items()],
        )
    per_user = rows.groupBy(window, *keys, F.col(user).alias("_user")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    return per_user.groupBy("window", *keys).agg(
        F.sum("_n").alias("orders"), F.count("_user").alias("users"),
        *[F.sum(n).alias(n) for n in sums],
    )


def hourly_day_stats(orders, ts="ts", processed_at=None, approx=False):
    """orders, users and totalFee per traffic and hour inside UTC+8 days.

    On a stream, run it in update mode (with `approx`) on a one-minute trigger to get a fresh
    figure each minute, or in append mode for the final one.
    """
    stats = windowed_users(
        orders, ["traffic", "hourTime"], "userID", {"totalFee": F.col("fee").cast("bigint")},
        "1 day", "1 day", DAY_OFFSET_UTC8, ts, approx,
    )
    extra = [] if processed_at is None else [
        F.date_format(processed_at, "yyyyMMddHHmmss").alias("ptTime")
    ]
    return stats.select(
        "traffic", F.col("hourTime").alias("etTime"), *window_bounds(),
        "orders", "users", "totalFee", *extra,
    )


def session_stats(orders, keys, gap, ts="ts", exact=False):
    """Measures per activity session on a stream (append mode): Spark's own session windows."""
    stats = orders.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*order_measures())
    return stats.select(
        *keys, *window_bounds(), "orders", "maxFee", "totalFee", "members", average_fee(exact)
    )


def session_stats_batch(orders, keys, gap_ms, ct="ct", exact=False):
    """The same sessions for batch rows, without sorting a whole key in one task.

    Rows that share a cell of `gap_ms` width always share a session, so orders are first summed
    per cell. What is left per key is at most one row per cell of the covered time, whatever the
    number of orders, and sessions are joined up over those.
    """
    cell = F.floor(F.col(ct) / gap_ms)
    cells = orders.groupBy(*keys, cell.alias("_cell")).agg(
        F.min(ct).alias("_first"), F.max(ct).alias("_last"), *order_measures()
    )
    ordered = W.partitionBy(*keys).orderBy("_cell")
    opens = F.coalesce(F.col("_first") - F.lag("_last").over(ordered) > gap_ms, F.lit(True))
    sessions = cells.withColumn("_opens", opens.cast("int"))
    sessions = sessions.withColumn("_session", F.sum("_opens").over(ordered))
    return (
        sessions.groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("startWindowTime"),
            (F.max("_last") + gap_ms).alias("endWindowTime"),
            F.sum("orders").alias("orders"), F.max("maxFee").alias("maxFee"),
            F.sum("totalFee").alias("totalFee"), F.sum("members").alias("members"),
        )
        .select(
            *keys, "startWindowTime", "endWindowTime", "orders", "maxFee", "totalFee", "members",
            average_fee(exact),
        )
    )


def running_totals(wide_orders, key="depCode", seq="seq"):
    """Orders, fee and latest arrival time per key over everything seen; update mode on a stream."""
    return wide_orders.groupBy(key).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("fee").cast("bigint")).alias("fee"),
        F.max_by("ct", seq).alias("ct"),
    )


# --- page views, clicks and launches -------------------------------------------------


def page_view_stats(views, size, keys=(), ts="ts", **options):
    """access, users, totalDuration, avgDuration (whole units) and latest time per window."""
    stay = F.coalesce(F.col("duration").try_cast("bigint"), F.lit(0))
    window = F.window(ts, size).alias("window")
    per_user = views.groupBy(window, *keys, F.col("userId").alias("_user")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(stay).alias("_stay"), F.max("ct").alias("_ct")
    )
    stats = per_user.groupBy("window", *keys).agg(
        F.sum("_n").alias("access"), F.count("_user").alias("users"),
        F.sum("_stay").alias("totalDuration"), F.max("_ct").alias("maxTimeStamp"),
    )
    return stats.select(
        *keys, *window_bounds(), "access", "users", "totalDuration",
        F.expr("totalDuration div access").alias("avgDuration"), "maxTimeStamp",
    )


def split_low_duration(views, threshold=5):
    """Page views with a long enough stay, and the ones below `threshold`."""
    low = F.coalesce(F.col("duration").try_cast("bigint") < threshold, F.lit(False))
    return views.filter(~low), views.filter(low)


def click_stats(clicks, size, keys=("userRegion", "eventTargetType"), ts="ts", approx=False):
    """access and users per window and click dimension."""
    stats = windowed_users(clicks, list(keys), "userId", {}, size, ts=ts, approx=approx)
    return stats.select(*keys, *window_bounds(), F.col("orders").alias("access"), "users")


def launch_records(launches):
    """Launch rows in their narrow form."""
    return launches.select(
        "userDevice", "userId", "userRegion", F.col("userRegionIP").alias("userRegionIp"), "networkType", "ct"
    )


def launch_stats(launches, size, keys=("userRegion",), ts="ts", approx=False):
    """Launches and launching users per window."""
    stats = windowed_users(launches, list(keys), "userId", {}, size, ts=ts, approx=approx)
    return stats.select(*keys, *window_bounds(), F.col("orders").alias("launches"), "users")
