"""Registered streaming queries whose results are renewed, corrected or closed by the clock."""

import time

from pyspark.sql import functions as F

from orderflow.operators import lookup
from orderflow.operators.logs import log_messages
from orderflow.operators.orders import with_event_time, with_hour
from orderflow.operators.windows import DAY_OFFSET_UTC8
from orderflow.plans import base, jobs
from orderflow.plans.base import LOGS_SQL, MEMBERS_SQL, ORDERS_SQL, WIDE_SQL
from orderflow.plans.log_queries import NARROW
from orderflow.plans.order_queries import ORACLE as ORDER_SQL
from orderflow.plans.stream_queries import DAY, HOUR, ONCE, _carried, _finish, _in_parts, _in_time, _parted
from orderflow.session import new_folder
from orderflow.sources import tables
from orderflow.schemas import UNMATCHED_ONE_DIM
from orderflow.sources.dimensions import HashedDim, SnapshotLog
from orderflow.streaming import landing, sinks
from orderflow.streaming.steps import RenewedTotals, WindowRevisions
from orderflow.streaming.timers import count_or_clock, timer_state

OFFSET = int(DAY_OFFSET_UTC8.split()[0]) * HOUR
LATE = 6 * HOUR
BATCH, TICK = 10, 2_000
FILE_BYTES = 4_000


def stream_day_renewed(spark, folder):
    """Orders, users and totalFee per traffic and hour inside UTC+8 days, renewed by each of four triggers."""
    step = RenewedTotals(["traffic", "hourTime"], DAY, OFFSET, delay_ms=2 * DAY)
    orders = with_hour(with_event_time(tables.orders_from(_in_parts(spark, folder)), late="2 days"))
    return _carried(spark, step.with_first_sights(orders), step, "day-renewed")


def late_region_revisions(spark, folder):
    """Hourly statistics per region and traffic: a first result and a revision for each later change."""
    step = WindowRevisions(["userRegion", "traffic"], HOUR, lateness_ms=20 * DAY, delay_ms=LATE)
    return _carried(spark, tables.orders_from(_in_parts(spark, folder)), step, "revisions")


def stream_count_or_clock(spark, folder):
    """Batches of ten orders or two seconds of the clock, per traffic, until an idle stream has closed its last
    ones. Which orders share a batch depends on the run, so sums and bounds are compared."""
    batches = count_or_clock(tables.orders_from(_in_parts(spark, folder)), ["traffic"], BATCH, TICK)
    out, begun = new_folder(spark, "clock-batches"), time.time()
    wanted = tables.table(spark, folder, "events").count()
    with timer_state(spark, partitions=8):
        query = sinks.to_files(batches, f"{out}/data", f"{out}/log", trigger={"processingTime": "500 milliseconds"})
    try:
        while True:
            if query.exception():
                raise query.exception()
            rows = spark.read.schema(batches.schema).parquet(f"{out}/data")
            if query.recentProgress and rows.agg(F.sum("orders")).first()[0] == wanted:
                break
            time.sleep(1)
    finally:
        query.stop()
    start, end, whole = F.col("startWindowTime"), F.col("endWindowTime"), F.col("orders") == BATCH
    now = int(time.time() * 1000)
    return rows.groupBy("traffic").agg(
        F.sum("orders").alias("orders"), F.sum("totalFee").alias("totalFee"),
        F.bool_and(F.col("orders").between(1, BATCH) & F.col("users").between(0, F.col("orders"))).alias("sizes"),
        F.bool_and(whole | (end % TICK == 0)).alias("closedOnTick"),
        F.bool_and((start <= end) & (whole | (end - start <= TICK))).alias("inOneInterval"),
        F.bool_and((start >= int(begun * 1000)) & (start <= now)).alias("inTheRun"),
        (F.count(F.lit(1)) >= F.ceil(F.sum("orders") / BATCH)).alias("enough"),
    )


def _upserted(spark, rows, name, key, version, merge=False):
    out = new_folder(spark, name)
    query, table = sinks.to_keyed_table(rows, f"{out}/table", key, f"{out}/log", version, merge=merge, trigger=ONCE)
    _finish(query)
    return table.read(spark, merge)


def _shared_sids(logs):
    """Logs of which a hundred share their ids, some without a time."""
    return logs.withColumns({
        "sid": F.concat(F.lit("s"), (F.col("seq") % 100).cast("string")),
        "ct": F.when(F.col("seq") % 19 != 0, F.col("ct")),
    })


def upsert_clicks(spark, folder):
    """Clicks that pass the quality rules, in four micro-batches, the newest of each id."""
    logs = log_messages(_shared_sids(tables.logs_from(_in_parts(spark, folder))))
    return _upserted(spark, jobs.clicks(logs), "clicks", "sid", "ct")


def upsert_page_views(spark, folder):
    """Page views that pass the quality rules, in four micro-batches, the newest of each id."""
    logs = log_messages(_shared_sids(tables.logs_from(_in_parts(spark, folder))))
    return _upserted(spark, jobs.page_views(logs), "page-views", "sid", "ct")


def upsert_by_field(spark, folder):
    """Documents of users, of which an order sets some fields only: each field keeps its newest value."""
    orders, number = tables.orders_from(_in_parts(spark, folder)), F.col("seq")
    rows = orders.select(
        "userID", "ct", "seq", F.when(number % 2 == 0, F.col("fee")).alias("fee"),
        F.when(number % 3 == 0, F.col("price")).alias("price"), F.when(number % 41 == 0, F.col("traffic")).alias("traffic"),
    )
    return _upserted(spark, rows, "by-field", "userID", ["ct", "seq"], merge=True)


def dim_bound_snapshots(spark, folder):
    """Orders widened in four micro-batches, each bound to a snapshot. The dimension is replaced after every
    micro-batch, then all are replayed: the rows stay as they were."""
    products, out, batches = base.products(spark, folder), new_folder(spark, "bound"), []
    log = SnapshotLog(f"{out}/dimension")

    def save(number):
        log.save(products.withColumn("productType", F.concat(F.lit(f"v{number} "), "productType")))

    def widen(batch, batch_id):
        wide = lookup.widen_orders(batch, log.bound(batch.sparkSession, batch_id)).select("orderID", "productID", "productType")
        wide.write.mode("overwrite").parquet(f"{out}/data/_batch={batch_id}")

    def first(batch, batch_id):
        widen(batch, batch_id)
        batch.write.parquet(f"{out}/again/{batch_id}")
        batches.append(batch_id)
        save(batch_id + 1)

    save(0)
    writer = tables.orders_from(_in_parts(spark, folder)).writeStream.foreachBatch(first)
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    for batch_id in batches:
        widen(spark.read.parquet(f"{out}/again/{batch_id}"), batch_id)
    return spark.read.parquet(f"{out}/data").drop("_batch")


def landing_by_bytes(spark, folder):
    """Order messages landed as text day by day, in files filled up to 4 000 bytes: size on disk and lines of each."""
    out = new_folder(spark, "landing-bytes")
    orders = with_event_time(tables.orders_from(tables.table(spark, folder, "events")))
    lines = orders.select(
        F.to_json(F.struct("orderID", "fee", "traffic")).alias("value"), F.date_format("ts", "yyyyMMdd").alias("bucket"), "seq"
    )
    landing.land_packed(lines, out, FILE_BYTES, order=["seq"])
    rows = landing.read_packed(spark, out, FILE_BYTES)
    return rows.groupBy("bucket", "file", "_metadata.file_size").agg(
        F.count("*").alias("lines"), F.min("value").alias("least"), F.max("value").alias("greatest")
    ).withColumnRenamed("file_size", "bytes")


def hashed_lookup(spark, folder):
    """Orders of each quarter's micro-batch, unknown products among them, widened from a dimension stored by key."""
    products, out = base.products(spark, folder), new_folder(spark, "hashed")
    dim = HashedDim.stored(products, f"{out}/dimension", "productID", 16)

    def widen(batch, batch_id):
        lost = F.when(F.col("seq") % 7 == 3, F.concat(F.lit("X"), "productID")).otherwise(F.col("productID"))
        found = dim.lookup(batch.withColumn("productID", lost), UNMATCHED_ONE_DIM)
        found.select("orderID", "productID", *UNMATCHED_ONE_DIM).write.mode("overwrite").parquet(f"{out}/data/_batch={batch_id}")

    writer = tables.orders_from(_in_parts(spark, folder)).writeStream.foreachBatch(widen)
    _finish(writer.option("checkpointLocation", f"{out}/log").trigger(**ONCE).start())
    return spark.read.parquet(f"{out}/data").drop("_batch")


QUERIES = {f.__name__: f for f in (
    landing_by_bytes, hashed_lookup, stream_day_renewed, late_region_revisions, stream_count_or_clock, upsert_clicks, upsert_page_views, upsert_by_field,
    dim_bound_snapshots,
)}

_CLOCK_OF = "clock_of AS (SELECT p.part, max(q.ct) AS clock FROM (SELECT DISTINCT part FROM parted) p JOIN parted q ON q.part <= p.part GROUP BY p.part)"

ORACLE = {
    "stream_day_renewed": f"""WITH {ORDERS_SQL}, {_parted("orders_d", "seq")},
timely AS ({_in_time(f"((ct - {OFFSET}) // {DAY} + 1) * {DAY} + {OFFSET}")}),
placed AS (SELECT *, strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS "hourTime", (ct - {OFFSET}) // {DAY} * {DAY} + {OFFSET} AS d FROM timely),
{_CLOCK_OF},
told AS (SELECT DISTINCT traffic, "hourTime", d, part FROM placed)
SELECT t.traffic, t."hourTime", t.d AS "startWindowTime", t.d + {DAY} AS "endWindowTime", c.clock, count(*) AS orders,
  count(DISTINCT p."userID") AS users, CAST(sum(p.fee) AS BIGINT) AS "totalFee"
FROM told t JOIN clock_of c USING (part) JOIN placed p
  ON p.traffic = t.traffic AND p."hourTime" = t."hourTime" AND p.d = t.d AND p.part <= t.part
GROUP BY t.traffic, t."hourTime", t.d, t.part, c.clock""",
    "late_region_revisions": f"""WITH {ORDERS_SQL}, {_parted("orders_d", "seq")},
timely AS ({_in_time(f"(ct // {HOUR} + 1) * {HOUR} + {20 * DAY}", LATE)}),
{_CLOCK_OF},
steps AS (SELECT part, clock - {LATE} AS known FROM clock_of UNION ALL SELECT 4, {1 << 60}),
hours AS (SELECT "userRegion", traffic, ct // {HOUR} * {HOUR} AS w, part, count(*) AS n, greatest(max(fee), 0) AS top, sum(fee) AS fees,
    sum({MEMBERS_SQL}) AS people FROM timely GROUP BY ALL),
grown AS (SELECT h."userRegion", h.traffic, h.w, s.part, sum(n) AS orders, max(top) AS top, sum(fees) AS fees, sum(people) AS people,
    bool_or(h.part = s.part) AS changed, h.w + {HOUR} <= s.known AS due
  FROM hours h JOIN steps s ON h.part <= s.part GROUP BY h."userRegion", h.traffic, h.w, s.part, s.known),
told AS (SELECT *, count_if(due) OVER (PARTITION BY "userRegion", traffic, w ORDER BY part) AS times FROM grown)
SELECT "userRegion", traffic, w AS "startWindowTime", w + {HOUR} AS "endWindowTime", CAST(orders AS BIGINT) AS orders,
  CAST(top AS BIGINT) AS "maxFee", CAST(fees AS BIGINT) AS "totalFee", CAST(people AS BIGINT) AS members,
  CAST(CAST(fees AS BIGINT) // CAST(orders AS BIGINT) AS DOUBLE) AS "avgFee",
  row_number() OVER (PARTITION BY "userRegion", traffic, w ORDER BY part) AS revision
FROM told WHERE due AND (changed OR times = 1)""",
    "stream_count_or_clock": f"""WITH {ORDERS_SQL}
SELECT traffic, count(*) AS orders, CAST(sum(fee) AS BIGINT) AS "totalFee", true AS sizes, true AS "closedOnTick",
  true AS "inOneInterval", true AS "inTheRun", true AS enough FROM orders_d GROUP BY traffic""",
    "upsert_clicks": f"""WITH {LOGS_SQL},
clicks AS (SELECT * REPLACE ('s' || (event_id % 100) AS sid) FROM logs WHERE event_type = 'click')
SELECT {NARROW}, 'P' || k AS "targetId", 'T' || (k % 7) AS "eventTargetType"
FROM (SELECT * REPLACE (CASE WHEN event_id % 19 <> 0 THEN ct END AS ct) FROM clicks)
QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ct DESC NULLS LAST) = 1""",
    "upsert_page_views": f"""WITH {LOGS_SQL},
views AS (SELECT * REPLACE ('s' || (event_id % 100) AS sid) FROM logs WHERE action IN ('07', '08') AND event_id % 19 <> 0)
SELECT {NARROW}, "userRegionIP", 'P' || k AS "targetId" FROM views
QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ct DESC) = 1""",
    "upsert_by_field": f"""WITH {ORDERS_SQL}
SELECT "userID", max(ct) AS ct, arg_max(seq, (ct, seq)) AS seq, arg_max(fee, (ct, seq)) FILTER (seq % 2 = 0) AS fee,
  arg_max(price, (ct, seq)) FILTER (seq % 3 = 0) AS price, arg_max(traffic, (ct, seq)) FILTER (seq % 41 = 0) AS traffic
FROM orders_d GROUP BY 1""",
    "dim_bound_snapshots": f"""WITH {WIDE_SQL}, {_parted("wide", "seq")}
SELECT "orderID", "productID", CASE WHEN "productType" <> '-1' THEN 'v' || part || ' ' ELSE '' END || "productType" AS "productType" FROM parted""",
    "landing_by_bytes": f"""WITH {ORDERS_SQL},
lines AS (SELECT strftime(make_timestamp(ct * 1000), '%Y%m%d') AS bucket, seq,
  '{{"orderID":"' || "orderID" || '","fee":' || fee || ',"traffic":"' || traffic || '"}}' AS value FROM orders_d),
placed AS (SELECT *, strlen(value) + 1 AS size, sum(strlen(value) + 1) OVER (PARTITION BY bucket ORDER BY seq) AS upto FROM lines)
SELECT bucket, CAST((upto - size) // {FILE_BYTES} AS INTEGER) AS file, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS lines,
  min(value) AS least, max(value) AS greatest FROM placed GROUP BY 1, 2""",
    "hashed_lookup": ORDER_SQL["order_wide_unknown"],
}
