"""Registered end-to-end jobs: message lines in, sink rows out, with typed fields read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.logs import log_messages
from orderflow.plans import base, jobs
from orderflow.plans.base import LOGS_SQL, ORDERS_SQL, WIDE_SQL
from orderflow.plans.log_queries import NARROW, VIEWS_SQL, _matches_sql
from orderflow.plans.order_queries import (
    DAY, HOUR, MWIDE_SQL, _topn_sql, _window_sql,
)
from orderflow.schemas import ALERT, ORDER_DETAIL, ORDER_TRAFFIC_STATS, PAGE_VIEW, VIEW_LIST_FACT
from orderflow.sources import tables
from orderflow.sources.messages import decode


ALERT_MATCHES = T.StructType([*ALERT.fields, T.StructField("matches", T.LongType())])


def _lines(spark, folder):
    """Order lines with their arrival number."""
    rows = tables.orders_from(tables.table(spark, folder, "events"))
    texts = {k: F.col(f).cast("string").alias(k) for k, f in tables.ORDER_KEYS.items()}
    return rows.select(F.to_json(F.struct(*texts.values())).alias("value"), "seq")


def _read(rows, *fields):
    names = [f.split()[0] for f in fields]
    plain = [c for c in rows.columns if c != "value"]
    return rows.select(*plain, F.from_json("value", ", ".join(fields)).alias("v")).select(
        *plain, *[F.col(f"v.{n}").alias(n) for n in names]
    )


def job_order_detail(spark, folder):
    return _read(jobs.order_detail(_lines(spark, folder)), "orderID string", "fee int", "ct string")


def job_order_wide(spark, folder):
    rows = jobs.order_wide(_lines(spark, folder), base.products(spark, folder))
    return _read(rows, "productLevel int", "depCode string", "ct string")


def job_running_totals(spark, folder):
    return jobs.running_totals(_lines(spark, folder), base.products(spark, folder))


def job_order_mwide(spark, folder):
    rows = jobs.order_mwide(_lines(spark, folder), base.products(spark, folder), base.hotels(spark, folder))
    return _read(rows, "orderID string", "depCode string", "pubGrade string")


def job_region_stats_pairs(spark, folder):
    return _read(jobs.region_stats_pairs(_lines(spark, folder), "1 day"), "orders string", "totalFee string")


def job_region_stats_documents(spark, folder):
    return _read(
        jobs.region_stats_documents(_lines(spark, folder), "1 day"), "startWindowTime string", "members string", "avgFee double"
    )


def job_count_triggered(spark, folder):
    return jobs.count_triggered_stats(_lines(spark, folder), 2, HOUR).select("id", "etTime", "ct", "orders", "users", "totalFee")


def job_count_or_time(spark, folder):
    return jobs.count_or_time_stats(_lines(spark, folder), base.products(spark, folder), 5, 12 * HOUR)


def job_top_products(spark, folder):
    rows = jobs.top_products(_lines(spark, folder), size="1 hour", period_ms=DAY, rank_within=())
    return _read(rows, "productID string", "startWindowTime string", "orders string", "totalFee string")


def job_type_stats(spark, folder):
    rows = jobs.type_stats(_lines(spark, folder), base.products(spark, folder), "1 day")
    return _read(rows, "endWindowTime string", "orders string", "maxFee string")


def job_clicks(spark, folder):
    return jobs.clicks(base.log_lines(spark, folder))


def job_page_views(spark, folder):
    return jobs.page_views(base.log_lines(spark, folder))


def job_page_view_messages(spark, folder):
    return _read(jobs.page_view_messages(base.log_lines(spark, folder)), "sid string", "targetId string")


def job_product_views(spark, folder):
    return _read(jobs.product_views(base.log_lines(spark, folder)), "targetId string", "travelTime string")


def job_behaviour_alerts(spark, folder):
    rows = jobs.behaviour_alerts(base.log_lines(spark, folder), within_ms=2 * HOUR)
    return _read(rows, "userId string", "duration string", "ct string", "matches string")


def job_decoded_alerts(spark, folder):
    """The keyed alerts, decoded again with all their fields."""
    rows = jobs.behaviour_alerts(base.log_lines(spark, folder), within_ms=2 * HOUR)
    return decode(rows, ALERT_MATCHES)


def job_decoded_list_views(spark, folder):
    return decode(jobs.product_views(base.log_lines(spark, folder)), VIEW_LIST_FACT)


def job_decoded_stats(spark, folder):
    """The keyed statistics of products, decoded again with all their fields."""
    rows = jobs.top_products(_lines(spark, folder), size="1 hour", period_ms=DAY, rank_within=())
    return decode(rows, ORDER_TRAFFIC_STATS)


def job_decoded_order_detail(spark, folder):
    """The keyed messages of the detail job, decoded again with all their fields."""
    return decode(jobs.order_detail(_lines(spark, folder)), ORDER_DETAIL)


def job_decoded_page_views(spark, folder):
    return decode(jobs.page_view_messages(base.log_lines(spark, folder)), PAGE_VIEW)


def job_rejected_orders(spark, folder):
    """What the order jobs leave out of lines of which some have lost a number."""
    bad = jobs.rejected_orders(base.order_lines(spark, folder, broken=True))
    return bad.select(F.get_json_object("value", "$.order_id").alias("orderID"), F.array_join("badFields", ",").alias("badFields"))


def job_rejected_page_views(spark, folder):
    """Page views without a time, which the upsert leaves out."""
    logs = base.logs(spark, folder)
    logs = logs.withColumn("ct", F.when(F.col("seq") % 19 != 0, F.col("ct")))
    found = jobs.rejected_page_views(log_messages(logs))
    return found.select("sid", F.array_join("problems", ",").alias("problems"))


QUERIES = {f.__name__: f for f in (
    job_order_detail, job_order_wide, job_running_totals, job_order_mwide, job_region_stats_pairs,
    job_region_stats_documents, job_count_triggered, job_count_or_time, job_top_products, job_type_stats,
    job_decoded_order_detail, job_decoded_page_views, job_decoded_alerts, job_decoded_list_views, job_decoded_stats, job_rejected_orders, job_rejected_page_views,
    job_clicks, job_page_views, job_page_view_messages, job_product_views, job_behaviour_alerts,
)}

_DAY_STATS = _window_sql(["userRegion", "traffic"], DAY)

ORACLE = {
    "job_order_detail": f"""WITH {ORDERS_SQL}
SELECT md5("productID" || traffic) AS key, "orderID", fee, CAST(ct AS VARCHAR) AS ct FROM orders_d""",
    "job_decoded_order_detail": f"WITH {ORDERS_SQL} SELECT * EXCLUDE (seq) FROM orders_d",
    "job_decoded_page_views": f"""WITH {VIEWS_SQL} SELECT {NARROW}, "userRegionIP", 'P' || k AS "targetId" FROM views""",
    "job_rejected_orders": f"""WITH {ORDERS_SQL}
SELECT "orderID", concat_ws(',', CASE WHEN seq % 97 = 0 THEN 'fee' END, CASE WHEN seq % 89 = 0 THEN 'ct' END) AS "badFields"
FROM orders_d WHERE seq % 97 = 0 OR seq % 89 = 0""",
    "job_rejected_page_views": f"""WITH {VIEWS_SQL} SELECT sid, 'ct is zero' AS problems FROM views WHERE event_id % 19 = 0""",
    "job_order_wide": f"""WITH {WIDE_SQL}
SELECT "orderID" AS id, "productLevel", "depCode", CAST(ct AS VARCHAR) AS ct FROM wide""",
    "job_running_totals": f"""WITH {WIDE_SQL}
SELECT "depCode", count(*) AS orders, CAST(sum(fee) AS BIGINT) AS fee, arg_max(ct, seq) AS ct FROM wide GROUP BY 1""",
    "job_order_mwide": f"""WITH {MWIDE_SQL}
SELECT md5("orderID" || "productID" || "pubID" || ct) AS key, "orderID", "depCode", "pubGrade" FROM mwide""",
    "job_region_stats_pairs": f"""WITH {ORDERS_SQL}
SELECT "userRegion" || '_' || traffic AS key, "endWindowTime", CAST(orders AS VARCHAR) AS orders,
  CAST("totalFee" AS VARCHAR) AS "totalFee" FROM ({_DAY_STATS})""",
    "job_region_stats_documents": f"""WITH {ORDERS_SQL}
SELECT "userRegion" || '_' || traffic AS id, CAST("startWindowTime" AS VARCHAR) AS "startWindowTime",
  CAST(members AS VARCHAR) AS members, "avgFee" FROM ({_DAY_STATS})""",
    "job_count_triggered": f"""WITH {ORDERS_SQL},
timed AS (SELECT *, ct // {HOUR} AS h, CASE WHEN row_number() OVER (PARTITION BY traffic, ct // {HOUR}, "userID" ORDER BY ct, seq) = 1
  THEN 1 ELSE 0 END AS fresh FROM orders_d),
running AS (SELECT traffic, ct, row_number() OVER w AS rn, sum(fresh) OVER w AS u, sum(fee) OVER w AS f
  FROM timed WINDOW w AS (PARTITION BY traffic, h ORDER BY ct, seq ROWS UNBOUNDED PRECEDING))
SELECT traffic || '_' || strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS id, strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS "etTime",
  ct, rn AS orders, CAST(u AS BIGINT) AS users, CAST(f AS BIGINT) AS "totalFee" FROM running WHERE rn % 2 = 0""",
    "job_count_or_time": f"""WITH {WIDE_SQL},
placed AS (SELECT *, ct // {12 * HOUR} AS d, (row_number() OVER (PARTITION BY "productType", "toursimType", ct // {12 * HOUR}
    ORDER BY ct, seq) - 1) // 5 AS chunk FROM wide)
SELECT "productType", "toursimType", min(ct) AS "startWindowTime",
  CASE WHEN count(*) = 5 THEN max(ct) ELSE (d + 1) * {12 * HOUR} END AS "endWindowTime", count(*) AS orders,
  count(DISTINCT "userID") AS users, CAST(sum(fee) AS BIGINT) AS "totalFee", "productType" || '_' || "toursimType" AS id
FROM placed GROUP BY "productType", "toursimType", d, chunk""",
    "job_top_products": f"""SELECT md5("productID" || traffic) AS key, "productID", CAST("startWindowTime" AS VARCHAR) AS "startWindowTime",
  CAST(orders AS VARCHAR) AS orders, CAST("totalFee" AS VARCHAR) AS "totalFee" FROM ({_topn_sql(DAY, 3, [], True)})""",
    "job_type_stats": f"""WITH {WIDE_SQL}
SELECT md5("productType" || "toursimType") AS key, CAST("endWindowTime" AS VARCHAR) AS "endWindowTime",
  CAST(orders AS VARCHAR) AS orders, CAST("maxFee" AS VARCHAR) AS "maxFee"
FROM ({_window_sql(["productType", "toursimType"], DAY, "wide", 1)})""",
    "job_clicks": f"""WITH {LOGS_SQL}
SELECT {NARROW}, 'P' || k AS "targetId", 'T' || (k % 7) AS "eventTargetType" FROM logs WHERE event_type = 'click'""",
    "job_page_views": f"""WITH {VIEWS_SQL} SELECT {NARROW}, "userRegionIP", 'P' || k AS "targetId" FROM views""",
    "job_page_view_messages": f"""WITH {VIEWS_SQL}
SELECT md5(sid || "userDevice" || 'P' || k) AS key, sid, 'P' || k AS "targetId" FROM views""",
    "job_product_views": f"""WITH {LOGS_SQL}
SELECT md5(sid || "userDevice" || "userId") AS key, 'P' || CASE WHEN i = 0 THEN k ELSE (k + 1) % 100 END AS "targetId",
  CAST(k % 9 AS VARCHAR) AS "travelTime"
FROM logs, (VALUES (0), (1)) s(i) WHERE event_type = 'purchase' AND event_id % 10 <> 1""",
    "job_behaviour_alerts": f"""WITH {_matches_sql(2 * HOUR)}
SELECT md5("userId" || "userRegion" || "userRegionIP") AS key, "userId", duration, CAST(ct AS VARCHAR) AS ct,
  CAST(matches AS VARCHAR) AS matches
FROM (SELECT *, count(*) AS matches FROM alerted GROUP BY ALL)""",
    "job_decoded_alerts": f"""WITH {_matches_sql(2 * HOUR)}
SELECT "userDevice", "userId", "userRegion", "userRegionIP" AS "userRegionIp", duration, ct, matches
FROM (SELECT *, count(*) AS matches FROM alerted GROUP BY ALL)""",
    "job_decoded_list_views": f"""WITH {LOGS_SQL}
SELECT {NARROW}, 'P' || CASE WHEN i = 0 THEN k ELSE (k + 1) % 100 END AS "targetId", "hotTarget", '52' AS "travelSend",
  '202002' AS "travelSendTime", CAST(k % 9 AS VARCHAR) AS "travelTime", CAST(k % 5 AS VARCHAR) AS "productLevel", '0' || (k % 3) AS "productType"
FROM logs, (VALUES (0), (1)) s(i) WHERE event_type = 'purchase' AND event_id % 10 <> 1""",
    "job_decoded_stats": f"""SELECT "productID", traffic, "startWindowTime", "endWindowTime", orders, "totalFee"
FROM ({_topn_sql(DAY, 3, [], True)})""",
}
