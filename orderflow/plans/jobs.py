"""The warehouse jobs, from message lines to what is handed to the sink.

Each takes lines with a JSON `value` column (batch or streaming) and gives a DataFrame. The count,
ranking and alert jobs have a `*_stream` form that starts the query, because they carry rows from
batch to batch. `orderflow.streaming.sinks` has the sinks.
"""

from pyspark.sql import functions as F

from orderflow.operators import counted, logs, lookup, messages, patterns, ranking, spread, windows
from orderflow.operators.orders import parse_orders, reject_orders, with_event_time, with_hour
from orderflow.session import stored
from orderflow.streaming import sinks
from orderflow.streaming.carry import Carry
from orderflow.streaming.landing import with_bucket
from orderflow.streaming.steps import CountOrTime, CountTriggered, RenewedTotals, RepeatMatches, TopN, WindowRevisions
from orderflow.streaming.timers import count_or_clock, timer_state

MINUTE_MS = 60_000
DELAY_MS = 10_005
DAY_MS = 24 * 60 * MINUTE_MS
# Midnight in UTC+8 as an offset from UTC midnight.
DAY_OFFSET_MS = 16 * 60 * MINUTE_MS

# Operating points of the count jobs.
TRIGGER_COUNT = 50
TRIGGER_PERIOD_MS = MINUTE_MS
BATCH_COUNT = 10
BATCH_INTERVAL_MS = MINUTE_MS


def _in_order(lines, fields=None):
    """Parsed orders with their arrival order `seq`; lines that have none are ordered by time."""
    known = "seq" in lines.columns
    orders = parse_orders(lines, fields=fields, keep=["seq"] if known else [])
    return orders if known else orders.withColumn("seq", F.col("ct"))


def _timed(orders):
    return with_event_time(orders, late=windows.WATERMARK if orders.isStreaming else None)


def _orders(lines):
    return _timed(parse_orders(lines))


def order_detail(lines):
    """Parsed orders as keyed messages."""
    return messages.envelope(parse_orders(lines), "order_detail")


def order_wide(lines, products):
    """Orders with product attributes as documents."""
    return messages.documents(lookup.widen_orders(parse_orders(lines), products), "order_wide", longs_as_text=True)


def running_totals(lines, products):
    """Totals per departure code; update mode on a stream. Rows failing the quality rules are left out."""
    wide = lookup.widen_orders(_in_order(lines), products)
    passed, _ = logs.quality_gate(wide, "order_totals")
    return windows.running_totals(passed)


def rejected_totals(lines, products):
    """The rows `running_totals` leaves out, with their problems."""
    return logs.quality_gate(lookup.widen_orders(_in_order(lines), products), "order_totals")[1]


def rejected_orders(lines):
    """The lines that no order job can read, with the fields at fault."""
    return reject_orders(lines)


def order_mwide(lines, products, hotels):
    """Orders with product and hotel attributes as keyed messages."""
    return messages.envelope(lookup.widen_orders_two(parse_orders(lines), products, hotels), "order_mwide")


def region_stats_pairs(lines, size=windows.WINDOW):
    """Region and traffic statistics as key-value pairs, with the window end as their version."""
    stats = windows.region_traffic_stats(_orders(lines), size)
    return stats.select(
        F.concat_ws("_", "userRegion", "traffic").alias("key"),
        messages.as_json(stats.columns, True, stats.schema).alias("value"), "endWindowTime",
    )


def region_stats_documents(lines, size=windows.WINDOW):
    """Region and traffic statistics as documents."""
    return messages.documents(windows.region_traffic_stats(_orders(lines), size), "order_stats", longs_as_text=True)


def hourly_stats_by_day(lines, approx=False):
    """Statistics per traffic and hour inside UTC+8 days as documents; append mode on a stream. With `approx`
    users are estimated, which allows update mode on a one-minute trigger. `version` grows with the orders."""
    stats = windows.hourly_day_stats(with_hour(_orders(lines)), processed_at=F.current_timestamp(), approx=approx)
    rows = messages.documents(stats, "hourly_stats", longs_as_text=True)
    return rows.withColumn("version", F.get_json_object("value", "$.orders").cast("bigint"))


def hourly_stats_renewed_stream(lines, folder, checkpoint, late="10 minutes", late_ms=10 * MINUTE_MS, trigger=None):
    """Exact statistics per traffic and hour inside UTC+8 days, renewed each minute for the hours that changed;
    `clock` is the time up to which they count. `late` is how far orders may lag, also as milliseconds."""
    step = RenewedTotals(["traffic", "hourTime"], DAY_MS, DAY_OFFSET_MS, delay_ms=late_ms)
    stream = step.with_first_sights(with_hour(with_event_time(_in_order(lines), late=late)))
    carry = Carry(step, folder, step.carried_schema(stream))
    return carry.start(stream, checkpoint, trigger or {"processingTime": "1 minute"})


def region_stats_corrected_stream(lines, folder, checkpoint, size_ms=10_000, lateness_ms=10_000, delay_ms=5, trigger=None):
    """Region and traffic statistics as revisions: a result when a window ends, a corrected one for each later change
    inside the lateness. The greatest `revision` of a window is its current result."""
    step, orders = WindowRevisions(["userRegion", "traffic"], size_ms, lateness_ms, delay_ms), parse_orders(lines)
    return Carry(step, folder, step.carried_schema(orders)).start(orders, checkpoint, trigger)


def count_or_clock_stats_stream(lines, products, path, checkpoint, size=BATCH_COUNT, interval_ms=BATCH_INTERVAL_MS, trigger=None):
    """Statistics per product and tourism type for every `size` orders or when the clock reaches the next interval,
    also on a stream that has gone idle. Appended to files with the document id."""
    wide = lookup.widen_orders(parse_orders(lines, fields=["productID", "userID", "fee", "ct"]), products)
    stats = messages.with_id(count_or_clock(wide, ["productType", "toursimType"], size, interval_ms), "type_stats")
    with timer_state(lines.sparkSession):
        return sinks.to_files(stats, path, checkpoint, trigger=trigger)


def count_triggered_stats(lines, size=TRIGGER_COUNT, period_ms=TRIGGER_PERIOD_MS):
    """Running statistics per traffic and hour at every `size` orders (batch)."""
    orders = with_hour(_in_order(lines, ["traffic", "userID", "fee", "ct"]))
    stats = counted.count_triggered_stats(orders, ["traffic", "hourTime"], size, period_ms)
    return messages.with_id(stats.drop("hourTime"), "hourly_stats")


def count_triggered_stats_stream(lines, folder, checkpoint, size=TRIGGER_COUNT, period_ms=TRIGGER_PERIOD_MS,
                                 trigger=None):
    step = CountTriggered(["traffic", "hourTime"], size, period_ms, delay_ms=DELAY_MS)
    stream = step.with_first_sights(with_hour(_timed(_in_order(lines))))
    return Carry(step, folder, step.carried_schema(stream)).start(stream, checkpoint, trigger)


def count_or_time_stats(lines, products, size=BATCH_COUNT, interval_ms=BATCH_INTERVAL_MS):
    """Statistics per product and tourism type for every `size` orders or interval end (batch)."""
    wide = lookup.widen_orders(_in_order(lines, ["productID", "userID", "fee", "ct"]), products)
    stats = counted.count_or_time_stats(wide, size=size, interval_ms=interval_ms)
    return messages.with_id(stats, "type_stats")


def count_or_time_stats_stream(lines, products, folder, checkpoint, size=BATCH_COUNT,
                               interval_ms=BATCH_INTERVAL_MS, trigger=None):
    measures = [
        F.count(F.lit(1)).alias("orders"), F.count_distinct("userID").alias("users"),
        F.sum(F.col("fee").cast("bigint")).alias("totalFee"),
    ]
    step = CountOrTime(
        ["productType", "toursimType"], measures, size, interval_ms, DELAY_MS, columns=["userID", "fee"]
    )
    stream = lookup.widen_orders(_in_order(lines), products)
    return Carry(step, folder, step.carried_schema(stream)).start(stream, checkpoint, trigger)


def top_products(lines, n=ranking.TOP_N, size=windows.WINDOW, period_ms=ranking.RANK_WINDOW_MS,
                 rank_within=("productID", "traffic")):
    """Best windows of each product, or best products of each period, as keyed messages (batch)."""
    stats = windows.product_traffic_stats(_orders(lines), size)
    best = ranking.top_n(stats, n, period_ms, rank_within)
    return messages.envelope(best.drop("rankWindowTime", "rank"), "order_traffic_stats")


def top_products_stream(lines, folder, checkpoint, n=ranking.TOP_N, size=windows.WINDOW,
                        period_ms=ranking.RANK_WINDOW_MS, rank_within=("productID", "traffic"), trigger=None):
    stats = windows.product_traffic_stats(_orders(lines), size)
    step = TopN(n, period_ms, rank_within)
    return Carry(step, folder, step.carried_schema(stats), "endWindowTime").start(stats, checkpoint, trigger)


def type_stats(lines, products, size=windows.WINDOW, by_clock=False):
    """Statistics per product and tourism type as keyed messages, by event time or by the clock."""
    wide = lookup.widen_orders(parse_orders(lines), products)
    if by_clock:
        wide = windows.stamped(wide)
        wide = wide.withWatermark("ts", "0 seconds") if wide.isStreaming else wide
    else:
        wide = _timed(wide)
    return messages.envelope(windows.type_stats(wide, size), "order_type_stats")


def clicks(lines):
    """Clicks with their target, one row per `sid` for the upsert."""
    passed, _ = logs.quality_gate(logs.click_records(logs.decode_logs(lines)), "click")
    return passed


def page_views(lines):
    """Page views with their target, one row per `sid` for the upsert."""
    passed, _ = logs.quality_gate(logs.page_view_records(logs.decode_logs(lines)), "page_view")
    return passed


def rejected_clicks(lines):
    """The clicks that `clicks` leaves out, with their problems."""
    return logs.quality_gate(logs.click_records(logs.decode_logs(lines)), "click")[1]


def rejected_page_views(lines):
    """The page views that `page_views` leaves out, with their problems."""
    return logs.quality_gate(logs.page_view_records(logs.decode_logs(lines)), "page_view")[1]


def page_view_messages(lines):
    return messages.envelope(logs.page_view_records(logs.decode_logs(lines)), "page_view")


def product_views(lines):
    """One keyed message per product seen in a list."""
    return messages.envelope(logs.list_view_records(logs.decode_logs(lines)), "view_list")


def behaviour_alerts(lines, low=5, high=50, times=patterns.TIMES, within_ms=patterns.WITHIN_MS, keys=()):
    """Alerts for runs of abnormal stays as keyed messages (batch)."""
    views = logs.page_views_only(logs.decode_logs(lines))
    views = stored(views.select("sid", "userDevice", "userId", "userRegion", "userRegionIP", "duration", "ct"), "views")
    matches = patterns.duration_matches(
        views, low, high, times=times, within_ms=within_ms, keys=keys, order=("sid",)
    )
    return messages.envelope(patterns.alerts(matches), "alert")


def behaviour_alerts_stream(lines, folder, checkpoint, low=5, high=50, times=patterns.TIMES,
                            within_ms=patterns.WITHIN_MS, keys=(), trigger=None):
    views = logs.page_views_only(logs.decode_logs(lines))
    step = RepeatMatches(
        logs.abnormal_duration(low, high), times, within_ms, keys, DELAY_MS, order=("sid",),
        columns=["sid", "userDevice", "userId", "userRegion", "userRegionIP", "duration", "ct"],
    )
    return Carry(step, folder, step.carried_schema(views)).start(views, checkpoint, trigger)


def remote_login_alerts(lines, most=2, within_ms=patterns.WITHIN_MS):
    """Launches of users seen in more than `most` regions within the time, with the number of regions (batch)."""
    logins = logs.launches_only(logs.decode_logs(lines))
    logins = logins.select("sid", "userDevice", "userId", "userRegion", "userRegionIP", "ct")
    return spread.remote_logins(logins, most, within_ms)


def landing_rows(lines):
    """Parsed orders with the hour bucket they land in."""
    return with_bucket(parse_orders(lines))


def landing_lines(lines):
    """Raw lines with the hour bucket they land in."""
    return with_bucket(lines.select("value"))
