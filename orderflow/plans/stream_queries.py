"""Registered streaming queries: the table is read as a file stream, processed to the end with
checkpoints and drained, and the written result is returned. The `late_*` queries get the table in four
files, one micro-batch each, the last of them with rows that should have come in earlier ones."""

import datetime

from pyspark.sql import functions as F

from orderflow.operators import logs as log_ops
from orderflow.operators import lookup, messages, windows
from orderflow.operators.orders import with_event_time, with_hour
from orderflow.plans import base
from orderflow.plans.base import LOGS_SQL, ORDERS_SQL, WIDE_SQL
from orderflow.plans.log_queries import _matches_sql
from orderflow.plans.order_queries import DAY_UTC8_SQL, MEASURES_SQL, PRODUCT_HOURS_SQL, _trigger_sql, _window_sql
from orderflow.session import new_folder
from orderflow.sources import tables
from orderflow.sources.dimensions import RefreshingDim
from orderflow.sources.messages import table_stream
from orderflow.streaming import landing, sinks
from orderflow.streaming.carry import Carry
from orderflow.streaming.keyed_table import KeyedTable
from orderflow.streaming.steps import CountOrTime, CountTriggered, RepeatMatches, TopN

MINUTE = 60_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR
ONCE = {"availableNow": True}


def _events(spark, folder):
    return table_stream(spark, folder, "events", tables.EVENTS_SCHEMA)


def _orders(spark, folder, late="10 minutes"):
    return with_event_time(tables.orders_from(_events(spark, folder)), late=late)


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


class _Closing:
    """A bounded stream of events that is closed: a row far in the future moves the watermark past every window, so
    that append-mode statistics give out all they hold. The row's own window stays open. It comes along with the events
    where these are one micro-batch, as late rows are judged by the watermark of the batch before; where they are
    several (`batches`), it comes after them."""

    def __init__(self, spark, events, batches=0):
        self.spark, self.path = spark, new_folder(spark, "closing")
        for _ in range(batches):
            self._add([])
        self._add([(None, datetime.datetime(2200, 1, 1), None, None, None, None)])
        end = spark.readStream.schema(tables.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.path)
        self.events = events.unionByName(end)

    def _add(self, rows):
        self.spark.createDataFrame(rows, tables.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def orders(self, late="10 minutes"):
        return with_event_time(tables.orders_from(self.events), late=late)


def _appended(spark, rows, name):
    """Runs an append-mode stream into parquet and reads the files back."""
    out = new_folder(spark, name)
    writer = rows.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/log")
    _finish(writer.outputMode("append").trigger(**ONCE).start())
    return spark.read.schema(rows.schema).parquet(f"{out}/data")


def _carried(spark, stream, step, name):
    out = new_folder(spark, name)
    carry = Carry(step, out, step.carried_schema(stream))
    _finish(carry.start(stream, f"{out}/log", ONCE))
    carry.drain(spark)
    return carry.results(spark)


def _best_products(spark, closing):
    stats = windows.product_traffic_stats(closing.orders(), "1 hour")
    step = TopN(period_ms=3 * HOUR, rank_within=())
    out = new_folder(spark, "topn")
    carry = Carry(step, out, step.carried_schema(stats), ct="endWindowTime")
    _finish(carry.start(stats, f"{out}/log", ONCE))
    carry.drain(spark)
    return carry.results(spark)


def stream_agg_region_traffic(spark, folder):
    closing = _Closing(spark, _events(spark, folder))
    return _appended(spark, windows.region_traffic_stats(closing.orders(), "1 hour"), "region")


def stream_session_traffic(spark, folder):
    closing = _Closing(spark, _events(spark, folder))
    return _appended(spark, windows.session_stats(closing.orders(), ["traffic"], "15 minutes"), "sessions")


def stream_day_utc8(spark, folder):
    closing = _Closing(spark, _events(spark, folder))
    return _appended(spark, windows.hourly_day_stats(with_hour(closing.orders())), "days")


def stream_wide_type_window(spark, folder):
    closing = _Closing(spark, _events(spark, folder))
    wide = lookup.widen_orders(closing.orders(), base.products(spark, folder))
    return _appended(spark, windows.type_stats(wide, "1 hour"), "types")


def stream_topn(spark, folder):
    return _best_products(spark, _Closing(spark, _events(spark, folder)))


def stream_type_by_clock(spark, folder):
    """Statistics per type and window of the processing time: which windows there are depends on the run, so
    their sums are compared."""
    wide = lookup.widen_orders(tables.orders_from(_events(spark, folder)), base.products(spark, folder))
    stats = windows.type_stats(windows.stamped(wide).withWatermark("ts", "0 seconds"), "1 hour")
    out = new_folder(spark, "clock")
    table = KeyedTable(f"{out}/table", "window", "orders")
    named = stats.withColumn("window", F.concat_ws("_", "productType", "toursimType", "startWindowTime"))
    writer = named.writeStream.foreachBatch(table.sink(f"{out}/log")).outputMode("update")
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    return table.read(spark).groupBy("productType", "toursimType").agg(
        F.sum("orders").alias("orders"), F.sum("totalFee").alias("totalFee"), F.max("maxFee").alias("maxFee")
    )


def _in_parts(spark, folder, files=None):
    """The events as a stream of four micro-batches, one for each quarter of the time; every fiftieth row comes with
    the last one, however old it is. A quarter is written by as many tasks as read the table, to as many files."""
    out = new_folder(spark, "parts")
    rows = tables.table(spark, folder, "events")
    span = rows.agg(F.unix_millis(F.min("ts").cast("timestamp")).alias("a"), F.unix_millis(F.max("ts").cast("timestamp")).alias("b")).first()
    quarter = (span["b"] - span["a"]) // 4 + 1
    part = F.floor((F.unix_millis(F.col("ts").cast("timestamp")) - span["a"]) / quarter)
    files = files or rows.rdd.getNumPartitions()
    for k in range(4):
        mine = rows.filter(F.when(F.col("event_id") % 50 == 0, 3).otherwise(part) == k)
        (mine.repartition(files) if files > 1 else mine.coalesce(1)).write.mode("append").parquet(out)
        # a task without rows writes no file; empty ones make up the number that is one micro-batch
        there = len(spark.read.schema(tables.EVENTS_SCHEMA).parquet(out).inputFiles())
        for _ in range(files * (k + 1) - there):
            spark.createDataFrame([], tables.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(out)
    return spark.readStream.schema(tables.EVENTS_SCHEMA).option("maxFilesPerTrigger", files).parquet(out)


def late_region_windows(spark, folder):
    """Rows of windows that are already given out are dropped, rows of open ones are counted."""
    closing = _Closing(spark, _in_parts(spark, folder), batches=4)
    return _appended(spark, windows.region_traffic_stats(closing.orders("2 days"), "1 hour"), "late-region")


def late_count_or_time(spark, folder):
    orders = tables.orders_from(_in_parts(spark, folder))
    measures = [F.count(F.lit(1)).alias("orders"), F.sum(F.col("fee").cast("bigint")).alias("totalFee")]
    step = CountOrTime(["traffic"], measures, 10, DAY, delay_ms=2 * DAY, columns=["fee"])
    return _carried(spark, orders, step, "late-batches")


def late_count_trigger(spark, folder):
    step = CountTriggered(["traffic"], 20, DAY, delay_ms=2 * DAY)
    orders = with_event_time(tables.orders_from(_in_parts(spark, folder)), late="2 days")
    return _carried(spark, step.with_first_sights(orders), step, "late-trigger").drop("etTime")


def late_cep(spark, folder):
    views = log_ops.page_views_only(tables.logs_from(_in_parts(spark, folder)))
    step = RepeatMatches(
        log_ops.abnormal_duration(), within_ms=2 * HOUR, delay_ms=2 * DAY, columns=["sid", "userId", "duration", "ct", "seq"]
    )
    return _carried(spark, views, step, "late-cep").drop("seq")


def upsert_by_sid(spark, folder):
    """Clicks and page views upserted by `sid` in four micro-batches; each comes again, with another duration,
    and the newer row stays."""
    logs = tables.logs_from(_in_parts(spark, folder))
    again = F.explode(F.array(F.lit(0), F.lit(1))).alias("again")
    rows = logs.select("sid", "action", "eventType", "duration", "ct", "seq", again).select(
        F.concat(F.lit("s"), (F.col("seq") % 500).cast("string")).alias("sid"), "action", "eventType",
        F.concat("duration", F.lit("/"), F.col("again").cast("string")).alias("duration"), "ct",
        (F.col("seq") * 2 + F.col("again")).alias("seq"),
    )
    out = new_folder(spark, "sid")
    query, table = sinks.to_keyed_table(rows, f"{out}/table", "sid", f"{out}/log", ["ct", "seq"], trigger=ONCE)
    _finish(query)
    return table.read(spark)


def stream_count_or_time(spark, folder):
    wide = lookup.widen_orders(_orders(spark, folder), base.products(spark, folder))
    measures = [
        F.count(F.lit(1)).alias("orders"), F.count_distinct("userID").alias("users"),
        F.sum(F.col("fee").cast("bigint")).alias("totalFee"),
    ]
    step = CountOrTime(["productType", "toursimType"], measures, 10, DAY, columns=["userID", "fee"])
    return _carried(spark, wide, step, "count-or-time")


def stream_count_window(spark, folder):
    step = CountOrTime(
        ["userRegion", "traffic"], windows.order_measures(), 20, columns=["fee", "adult", "yonger", "baby"]
    )
    stats = _carried(spark, _orders(spark, folder), step, "count-window")
    return stats.drop("startWindowTime").select("*", windows.average_fee())


def stream_count_trigger(spark, folder):
    step = CountTriggered(["traffic"], 20, DAY, delay_ms=2 * DAY)
    stream = step.with_first_sights(_orders(spark, folder, late="2 days"))
    return _carried(spark, stream, step, "count-trigger")


def stream_cep(spark, folder):
    views = log_ops.page_views_only(with_event_time(tables.logs_from(_events(spark, folder))))
    step = RepeatMatches(
        log_ops.abnormal_duration(), within_ms=2 * HOUR, columns=["sid", "userId", "duration", "ct", "seq"]
    )
    return _carried(spark, views, step, "cep").drop("seq")


def stream_running_totals(spark, folder):
    """Totals per departure code in update mode, upserted by key."""
    wide = lookup.widen_orders(_orders(spark, folder), base.products(spark, folder))
    out = new_folder(spark, "totals")
    table = KeyedTable(f"{out}/table", "depCode", "orders")
    writer = windows.running_totals(wide).writeStream.foreachBatch(table.sink(f"{out}/log")).outputMode("update")
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    return table.read(spark)


def stream_kv_latest(spark, folder):
    """Region and traffic statistics as key-value pairs, the newest window per key."""
    closing = _Closing(spark, _events(spark, folder))
    stats = windows.region_traffic_stats(closing.orders(), "1 hour")
    pairs = stats.select(
        F.concat_ws("_", "userRegion", "traffic").alias("key"), messages.as_json(stats.columns).alias("value"),
        "endWindowTime",
    )
    out = new_folder(spark, "kv")
    table = KeyedTable(f"{out}/table", "key", "endWindowTime")
    writer = pairs.writeStream.foreachBatch(table.sink(f"{out}/log")).outputMode("append")
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    latest = table.read(spark)
    return latest.select("key", F.get_json_object("value", "$.orders").cast("bigint").alias("orders"), "endWindowTime")


def landing_bucket_counts(spark, folder):
    """Orders landed hour by hour as a stream, compacted, and counted from the compacted files."""
    out = new_folder(spark, "landing")
    rows = landing.with_bucket(_orders(spark, folder), "ts").drop("ts")
    _finish(landing.land_stream(rows, f"{out}/raw", f"{out}/log", trigger=ONCE))
    landing.compact(spark, f"{out}/raw", f"{out}/packed")
    return spark.read.parquet(f"{out}/packed").groupBy(F.col("bucket").cast("string").alias("bucket")).agg(
        F.count("*").alias("orders"), F.sum(F.col("fee").cast("bigint")).alias("totalFee")
    )


def landing_hour_by_hour(spark, folder):
    """Whole orders, landed as a stream and compacted day by day into one folder."""
    out = new_folder(spark, "landing-days")
    rows = landing.with_bucket(_orders(spark, folder), "ts").drop("ts")
    _finish(landing.land_stream(rows, f"{out}/raw", f"{out}/log", trigger=ONCE))
    hours = spark.read.parquet(f"{out}/raw").select(F.col("bucket").cast("string")).distinct()
    days = {}
    for (hour,) in hours.collect():  # a row for each hour landed
        days.setdefault(hour[:8], []).append(hour)
    for day in sorted(days):
        landing.compact(spark, f"{out}/raw", f"{out}/packed", buckets=days[day])
    return spark.read.parquet(f"{out}/packed").withColumn("bucket", F.col("bucket").cast("string"))


def landing_text_counts(spark, folder):
    """Order messages landed as text lines and parsed again per hour bucket."""
    out = new_folder(spark, "landing-text")
    orders = _orders(spark, folder)
    lines = orders.select(
        F.to_json(F.struct("orderID", "fee")).alias("value"), F.date_format("ts", landing.BUCKET).alias("bucket")
    )
    _finish(landing.land_stream(lines, f"{out}/raw", f"{out}/log", "text", ONCE))
    rows = spark.read.schema("value string, bucket string").text(f"{out}/raw")
    return rows.groupBy("bucket").agg(
        F.count("*").alias("orders"), F.sum(F.get_json_object("value", "$.fee").cast("bigint")).alias("totalFee")
    )


def dim_refresh_changes(spark, folder):
    """Orders widened in four micro-batches while the dimension is replaced between the second and the third."""
    products = base.products(spark, folder)
    newer = products.withColumn("productType", F.concat(F.lit("new "), "productType"))
    seconds = [0.0]
    dim = RefreshingDim(lambda: newer if seconds[0] >= 120 else products, ttl=60, clock=lambda: seconds[0])
    out = new_folder(spark, "refresh-changes")

    def widen(batch, batch_id):
        seconds[0] = 61.0 * batch_id
        wide = lookup.widen_orders(batch, dim.get()).select("orderID", "productID", "productType")
        wide.write.mode("overwrite").parquet(f"{out}/data/_batch={batch_id}")

    writer = tables.orders_from(_in_parts(spark, folder)).writeStream.foreachBatch(widen)
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    return spark.read.parquet(f"{out}/data").drop("_batch")


def dim_refresh(spark, folder):
    """Orders widened per micro-batch with a product dimension that is read again every minute."""
    dim = RefreshingDim(lambda: base.products(spark, folder))
    out = new_folder(spark, "refresh")

    def widen(batch, batch_id):
        wide = lookup.widen_orders(batch, dim.get()).select("orderID", "productID", "productType", "depCode")
        wide.write.mode("overwrite").parquet(f"{out}/data/_batch={batch_id}")

    writer = tables.orders_from(_events(spark, folder)).writeStream.foreachBatch(widen)
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    return spark.read.parquet(f"{out}/data").drop("_batch")


QUERIES = {f.__name__: f for f in (
    stream_agg_region_traffic, stream_session_traffic, stream_day_utc8, stream_wide_type_window, stream_topn,
    stream_count_or_time, stream_count_window, stream_count_trigger, stream_cep, stream_running_totals,
    stream_kv_latest, stream_type_by_clock, landing_bucket_counts, landing_hour_by_hour, landing_text_counts,
    dim_refresh, dim_refresh_changes, late_region_windows, late_count_or_time, late_count_trigger, late_cep,
    upsert_by_sid,
)}


def _parted(rows, number, lag=1):
    """Rows with the micro-batch they come in, and the latest time up to `lag` batches before it. Windowed
    statistics drop late rows by the watermark of the batch before, so two batches back."""
    first = "(SELECT min(epoch_us(ts)) // 1000 FROM events)"
    quarter = f"((SELECT max(epoch_us(ts)) // 1000 - {first} FROM events) // 4 + 1)"
    return f"""parted AS (SELECT *, CASE WHEN {number} % 50 = 0 THEN 3 ELSE (ct - {first}) // {quarter} END AS part
  FROM {rows}),
clocks AS (SELECT p.part, max(q.ct) AS before FROM (SELECT DISTINCT part FROM parted) p LEFT JOIN parted q ON q.part <= p.part - {lag} GROUP BY p.part)"""


def _in_time(end, delay=2 * DAY):
    """Rows that come before their period, which ends at `end`, is over."""
    return f"SELECT p.* FROM parted p JOIN clocks c USING (part) WHERE c.before IS NULL OR {end} > c.before - {delay}"


_TIMELY_VIEWS = f"""{LOGS_SQL},
all_views AS (SELECT * FROM logs WHERE action IN ('07', '08')),
{_parted("all_views", "event_id")},
views AS ({_in_time("ct + 1")})"""

_SESSIONS_SQL = f"""SELECT traffic, min(ct) AS "startWindowTime", max(ct) + {15 * MINUTE} AS "endWindowTime", {MEASURES_SQL}
FROM sessions GROUP BY traffic, s"""

ORACLE = {
    "stream_agg_region_traffic": f"WITH {ORDERS_SQL} " + _window_sql(["userRegion", "traffic"], HOUR),
    "stream_session_traffic": f"""WITH {ORDERS_SQL},
opened AS (SELECT *, CASE WHEN ct - lag(ct) OVER (PARTITION BY traffic ORDER BY ct, seq) <= {15 * MINUTE} THEN 0 ELSE 1 END AS opens
  FROM orders_d),
sessions AS (SELECT *, sum(opens) OVER (PARTITION BY traffic ORDER BY ct, seq ROWS UNBOUNDED PRECEDING) AS s FROM opened)
""" + _SESSIONS_SQL,
    "stream_day_utc8": f"WITH {ORDERS_SQL} " + DAY_UTC8_SQL,
    "stream_wide_type_window": f"WITH {WIDE_SQL} "
    + _window_sql(["productType", "toursimType"], HOUR, "wide", 1),
    "stream_topn": f"""WITH {ORDERS_SQL},
{PRODUCT_HOURS_SQL},
ranked_rows AS (SELECT "startWindowTime" // {3 * HOUR} * {3 * HOUR} AS "rankWindowTime", * FROM product_hours),
kept AS (SELECT * FROM ranked_rows QUALIFY row_number() OVER (PARTITION BY "rankWindowTime", orders, "totalFee"
  ORDER BY "startWindowTime", "endWindowTime", "productID", traffic) = 1)
SELECT "rankWindowTime", "productID", traffic, "startWindowTime", "endWindowTime", orders, "totalFee",
  CAST(row_number() OVER best AS INTEGER) AS rank
FROM kept
WINDOW best AS (PARTITION BY "rankWindowTime" ORDER BY orders DESC, "totalFee" DESC, "startWindowTime", "productID", traffic)
QUALIFY rank <= 3""",
    "stream_count_or_time": f"""WITH {WIDE_SQL},
placed AS (SELECT *, ct // {DAY} AS d, (row_number() OVER (PARTITION BY "productType", "toursimType", ct // {DAY}
    ORDER BY ct, seq) - 1) // 10 AS chunk FROM wide)
SELECT "productType", "toursimType", min(ct) AS "startWindowTime",
  CASE WHEN count(*) = 10 THEN max(ct) ELSE (d + 1) * {DAY} END AS "endWindowTime",
  count(*) AS orders, count(DISTINCT "userID") AS users, CAST(sum(fee) AS BIGINT) AS "totalFee"
FROM placed GROUP BY "productType", "toursimType", d, chunk""",
    "stream_count_window": f"""WITH {ORDERS_SQL},
placed AS (SELECT *, (row_number() OVER (PARTITION BY "userRegion", traffic ORDER BY ct, seq) - 1) // 20 AS chunk FROM orders_d)
SELECT "userRegion", traffic, max(ct) AS "endWindowTime", {MEASURES_SQL}
FROM placed GROUP BY "userRegion", traffic, chunk HAVING count(*) = 20""",
    "stream_count_trigger": _trigger_sql(20, 0, False),
    "stream_cep": f"""WITH {_matches_sql(2 * HOUR)}
SELECT sid, "userId", duration, ct, count(*) AS matches FROM alerted GROUP BY ALL""",
    "stream_running_totals": f"""WITH {WIDE_SQL}
SELECT "depCode", count(*) AS orders, CAST(sum(fee) AS BIGINT) AS fee, arg_max(ct, seq) AS ct FROM wide GROUP BY 1""",
    "stream_kv_latest": f"""WITH {ORDERS_SQL}, stats AS ({_window_sql(["userRegion", "traffic"], HOUR)})
SELECT "userRegion" || '_' || traffic AS key, orders, "endWindowTime"
FROM stats QUALIFY row_number() OVER (PARTITION BY "userRegion", traffic ORDER BY "endWindowTime" DESC) = 1""",
    "landing_bucket_counts": f"""WITH {ORDERS_SQL}
SELECT strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS bucket, count(*) AS orders, CAST(sum(fee) AS BIGINT) AS "totalFee"
FROM orders_d GROUP BY 1""",
    "stream_type_by_clock": f"""WITH {WIDE_SQL}
SELECT "productType", "toursimType", count(*) AS orders, CAST(sum(fee) AS BIGINT) AS "totalFee", max(fee) AS "maxFee"
FROM wide GROUP BY 1, 2""",
    "landing_hour_by_hour": f"""WITH {ORDERS_SQL} SELECT *, strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS bucket FROM orders_d""",
    "dim_refresh_changes": f"""WITH {WIDE_SQL}, {_parted("wide", "seq")}
SELECT "orderID", "productID", CASE WHEN part >= 2 AND "productType" <> '-1' THEN 'new ' ELSE '' END || "productType" AS "productType"
FROM parted""",
    "late_region_windows": f"""WITH {ORDERS_SQL}, {_parted("orders_d", "seq", 2)},
timely AS ({_in_time(f"(ct // {HOUR} + 1) * {HOUR}")}) """ + _window_sql(["userRegion", "traffic"], HOUR, "timely"),
    "late_count_or_time": f"""WITH {ORDERS_SQL}, {_parted("orders_d", "seq")},
timely AS ({_in_time(f"(ct // {DAY} + 1) * {DAY}")}),
placed AS (SELECT *, ct // {DAY} AS d, (row_number() OVER (PARTITION BY traffic, ct // {DAY} ORDER BY part, ct, seq) - 1) // 10 AS chunk
  FROM timely)
SELECT traffic, min(ct) AS "startWindowTime", CASE WHEN count(*) = 10 THEN max(ct) ELSE (d + 1) * {DAY} END AS "endWindowTime",
  count(*) AS orders, CAST(sum(fee) AS BIGINT) AS "totalFee" FROM placed GROUP BY traffic, d, chunk""",
    "late_count_trigger": f"""WITH {ORDERS_SQL}, {_parted("orders_d", "seq")},
timely AS ({_in_time(f"(ct // {DAY} + 1) * {DAY}")}),
timed AS (SELECT *, ct // {DAY} * {DAY} AS d, CASE WHEN row_number() OVER (PARTITION BY traffic, ct // {DAY}, "userID"
  ORDER BY part, ct, seq) = 1 THEN 1 ELSE 0 END AS fresh FROM timely),
running AS (SELECT traffic, d, max(ct) OVER c AS ct, row_number() OVER w AS orders, sum(fresh) OVER w AS users, sum(fee) OVER w AS fees
  FROM timed WINDOW w AS (PARTITION BY traffic, d ORDER BY part, ct, seq ROWS UNBOUNDED PRECEDING),
  c AS (PARTITION BY traffic, d, part ORDER BY ct, seq ROWS UNBOUNDED PRECEDING))
SELECT traffic, d AS "startWindowTime", ct, orders, CAST(users AS BIGINT) AS users, CAST(fees AS BIGINT) AS "totalFee"
FROM running WHERE orders % 20 = 0""",
    "late_cep": f"""WITH {_matches_sql(2 * HOUR, views=_TIMELY_VIEWS)}
SELECT sid, "userId", duration, ct, count(*) AS matches FROM alerted GROUP BY ALL""",
    "upsert_by_sid": f"""WITH {LOGS_SQL}
SELECT 's' || (event_id % 500) AS sid, last(action ORDER BY ct, event_id) AS action,
  last("eventType" ORDER BY ct, event_id) AS "eventType", last(duration ORDER BY ct, event_id) || '/1' AS duration,
  max(ct) AS ct, last(event_id ORDER BY ct, event_id) * 2 + 1 AS seq FROM logs GROUP BY 1""",
    "dim_refresh": f"""WITH {WIDE_SQL} SELECT "orderID", "productID", "productType", "depCode" FROM wide""",
}
ORACLE["landing_text_counts"] = ORACLE["landing_bucket_counts"]
