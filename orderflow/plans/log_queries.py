"""Registered behaviour-log queries and the SQL each one must agree with."""

from pyspark.sql import functions as F

from orderflow.operators import logs as ops, messages, patterns, spread, windows
from orderflow.operators.orders import with_event_time
from orderflow.plans import base
from orderflow.plans.base import LOGS_SQL, ORDERS_SQL

HOUR = 3_600_000
DAY = 24 * HOUR


def _views(spark, folder):
    return ops.page_views_only(base.logs(spark, folder))


def log_decode(spark, folder):
    return ops.decode_logs(base.log_lines(spark, folder))


def log_click(spark, folder):
    return ops.click_records(ops.decode_logs(base.log_lines(spark, folder)))


def log_pageview(spark, folder):
    return ops.page_view_records(ops.decode_logs(base.log_lines(spark, folder)))


def log_viewlist_flat(spark, folder):
    return ops.list_view_records(ops.decode_logs(base.log_lines(spark, folder)))


def log_event_filters(spark, folder):
    logs = base.logs(spark, folder)
    kinds = {"interactive": ops.INTERACTIVE_EVENTS, "any": ops.ALL_EVENTS, "click": (ops.CLICK_EVENT,)}
    counts = [ops.events_in(logs, codes).select(F.lit(name).alias("kind")) for name, codes in kinds.items()]
    rows = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return rows.groupBy("kind").agg(F.count("kind").alias("events"))


def log_quality_gate(spark, folder):
    number = F.col("seq")
    spoiled = base.logs(spark, folder).withColumns({
        "action": F.when(number % 13 != 0, F.col("action")),
        "eventType": F.when(number % 17 != 0, F.col("eventType")),
        "ct": F.when(number % 19 == 0, 0).otherwise(F.col("ct")),
    })
    passed, failed = ops.quality_gate(spoiled, "page_view")
    return passed.withColumn("problems", F.array().cast("array<string>")).unionByName(failed).select(
        "sid", F.array_join("problems", "; ").alias("problems")
    )


def decode_codes(spark, folder):
    return ops.decode_codes(base.logs(spark, folder)).select(
        "sid", "action", "actionName", "actionText", "eventType", "eventTypeName", "eventTypeText"
    )


def cep_duration_matches(spark, folder):
    """Every page view in an alert, with the number of alerts it is in."""
    hits = patterns.duration_matches(_views(spark, folder), within_ms=2 * HOUR)
    return hits.select("sid", "userId", "duration", "ct", "matches")


def cep_duration_alerts(spark, folder):
    """The alert records themselves: a page view appears once for each alert it is in."""
    return patterns.alerts(patterns.duration_matches(_views(spark, folder), within_ms=2 * HOUR), repeat=True)


def cep_duration_events(spark, folder):
    matches = patterns.duration_matches(_views(spark, folder), within_ms=6 * HOUR)
    return patterns.alerts(matches).drop("matches")


def cep_duration_by_user(spark, folder):
    hits = patterns.duration_matches(_views(spark, folder), within_ms=5 * DAY, keys=["userId"])
    return hits.select("sid", "userId", "duration", "ct", "matches")


def envelope_alert(spark, folder):
    rows = messages.envelope(cep_duration_events(spark, folder), "alert")
    return rows.select("key", F.get_json_object("value", "$.userId").alias("userId"),
                       F.get_json_object("value", "$.duration").alias("duration"),
                       F.get_json_object("value", "$.ct").alias("ct"))


def envelope_page_view(spark, folder):
    rows = messages.envelope(log_pageview(spark, folder), "page_view")
    return rows.select("key", F.get_json_object("value", "$.targetId").alias("targetId"))


def envelope_log(spark, folder):
    rows = messages.log_envelope(base.logs(spark, folder).drop("ts", "seq"))
    return rows.select("key", F.get_json_object("value", "$.ct").alias("ct"))


def pageview_stats(spark, folder):
    return windows.page_view_stats(_views(spark, folder), "6 hours", ["userRegion"])


def low_duration_split(spark, folder):
    long, low = windows.split_low_duration(_views(spark, folder))
    stats = [
        windows.page_view_stats(part, "1 day").withColumn("part", F.lit(name))
        for name, part in (("kept", long), ("low", low))
    ]
    return stats[0].unionByName(stats[1])


def click_stats(spark, folder):
    clicks = with_event_time(ops.click_records(base.logs(spark, folder)))
    return windows.click_stats(clicks, "6 hours")


def launch_stats(spark, folder):
    return windows.launch_stats(ops.launches_only(base.logs(spark, folder)), "6 hours")


def launch_records(spark, folder):
    return windows.launch_records(ops.launches_only(base.logs(spark, folder)))


def burst_orders_by_user(spark, folder):
    found = patterns.repeat_events(
        base.orders(spark, folder), F.lit(True), times=4, within_ms=DAY, keys=["userID"]
    )
    return found.select("orderID", "userID", "ct", "inWindow")


def burst_launches_by_user(spark, folder):
    found = patterns.repeat_events(
        base.logs(spark, folder), F.col("action") == "02", times=2, within_ms=DAY, keys=["userId"]
    )
    return found.select("sid", "userId", "ct", "inWindow")


def price_below_value(spark, folder):
    """Orders paid below a tenth of their fee: a pattern of one event."""
    found = patterns.repeat_events(
        base.orders(spark, folder), F.col("price") * 10 < F.col("fee") - 8, times=1, within_ms=HOUR
    )
    return found.select("orderID", "price", "fee", "ct", "inWindow")


def remote_logins(spark, folder):
    """Launches of users seen in more than one region within two days; regions change with the launch."""
    launches = ops.launches_only(base.logs(spark, folder))
    launches = launches.withColumn("userRegion", F.concat(F.lit("R"), (F.col("seq") % 7).cast("string")))
    found = spread.remote_logins(launches, most=1, within_ms=2 * DAY)
    return found.select("sid", "userId", "userRegion", "ct", "regions")


def many_means(spark, folder):
    """Events of users who come by more than two kinds of them within a day."""
    found = spread.many_means(base.logs(spark, folder), most=2, within_ms=DAY)
    return found.select("sid", "userId", "eventType", "ct", "means")


QUERIES = {f.__name__: f for f in (
    remote_logins, many_means,
    log_decode, log_click, log_pageview, log_viewlist_flat, log_event_filters, log_quality_gate,
    decode_codes, cep_duration_matches, cep_duration_alerts, cep_duration_events, cep_duration_by_user,
    envelope_alert, envelope_page_view, envelope_log, pageview_stats, low_duration_split, click_stats,
    launch_stats, launch_records, burst_orders_by_user, burst_launches_by_user, price_below_value,
)}


# --- SQL ------------------------------------------------------------------------------

NARROW = (
    'sid, "userDevice", "userDeviceType", os, "userId", "userRegion", longitude, latitude, manufacturer, '
    'carrier, "networkType", duration, action, "eventType", ct'
)
VIEWS_SQL = f"{LOGS_SQL},\nviews AS (SELECT * FROM logs WHERE action IN ('07', '08'))"


def _matches_sql(within, by_user=False, views=None):
    part = 'PARTITION BY "userId"' if by_user else ""
    run_part = '"userId", run' if by_user else "run"
    same_user = 'AND a."userId" = b."userId"' if by_user else ""
    between = 'AND p."userId" = m.u' if by_user else ""
    return f"""{views or VIEWS_SQL},
flagged AS (SELECT *, CAST(duration AS BIGINT) < 5 OR CAST(duration AS BIGINT) > 50 AS hit FROM views),
runs AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER ({part} ORDER BY ct, event_id ROWS UNBOUNDED PRECEDING) AS run FROM flagged),
placed AS (SELECT *, row_number() OVER (PARTITION BY {run_part} ORDER BY ct, event_id) AS pos FROM runs WHERE hit),
found AS (SELECT a.run, a."userId" AS u, a.pos AS first, b.pos AS last FROM placed a JOIN placed b
  ON a.run = b.run {same_user} AND b.pos >= a.pos + 2 AND b.ct - a.ct < {within}),
alerted AS (SELECT p.*, 1 AS one FROM placed p JOIN found m ON p.run = m.run {between} AND p.pos BETWEEN m.first AND m.last)"""


ALERT_SQL = '"userDevice", "userId", "userRegion", "userRegionIP" AS "userRegionIp", duration, ct'


def _view_stats_sql(size, keys, source):
    keys = "".join(f'"{k}", ' for k in keys)
    return f"""SELECT {keys}ct // {size} * {size} AS "startWindowTime", ct // {size} * {size} + {size} AS "endWindowTime",
  count(*) AS access, count(DISTINCT "userId") AS users, CAST(sum(CAST(duration AS BIGINT)) AS BIGINT) AS "totalDuration",
  CAST(sum(CAST(duration AS BIGINT)) AS BIGINT) // count(*) AS "avgDuration", max(ct) AS "maxTimeStamp"
FROM {source} GROUP BY {keys}ct // {size}"""


def _burst_sql(rows_sql, rows, columns, key, order, times, within):
    return f"""WITH {rows_sql}
SELECT {columns}, "inWindow" FROM (SELECT *, count(*) OVER (PARTITION BY "{key}" ORDER BY ct
    RANGE BETWEEN {within - 1} PRECEDING AND CURRENT ROW)
  - (count(*) OVER (PARTITION BY "{key}", ct) - row_number() OVER (PARTITION BY "{key}", ct ORDER BY {order})) AS "inWindow"
  FROM ({rows})) WHERE "inWindow" >= {times}"""


def _code_case(column, rows, at):
    return f"CASE {column} " + " ".join(f"WHEN '{r[0]}' THEN '{r[at]}'" for r in rows) + " END"


ORACLE = {
    "log_decode": f"""WITH {LOGS_SQL}
SELECT {NARROW}, "userRegionIP", "hotTarget", CASE
  WHEN event_type = 'click' THEN '{{"targetID":"P' || k || '","eventTargetType":"T' || (k % 7) || '"}}'
  WHEN event_type <> 'purchase' THEN '{{"targetID":"P' || k || '"}}'
  WHEN event_id % 10 = 1 THEN ''
  ELSE '{{"travelSendTime":"202002","travelTime":"' || (k % 9) || '","productLevel":"' || (k % 5)
    || '","targetIDS":"[\\"P' || k || '\\",\\"P' || ((k + 1) % 100) || '\\"]","travelSend":"52","productType":"0' || (k % 3) || '"}}'
  END AS exts FROM logs""",
    "log_click": f"""WITH {LOGS_SQL}
SELECT {NARROW}, 'P' || k AS "targetId", 'T' || (k % 7) AS "eventTargetType" FROM logs WHERE event_type = 'click'""",
    "log_pageview": f"""WITH {VIEWS_SQL} SELECT {NARROW}, "userRegionIP", 'P' || k AS "targetId" FROM views""",
    "log_viewlist_flat": f"""WITH {LOGS_SQL}
SELECT {NARROW}, 'P' || CASE WHEN i = 0 THEN k ELSE (k + 1) % 100 END AS "targetId", "hotTarget", '52' AS "travelSend",
  '202002' AS "travelSendTime", CAST(k % 9 AS VARCHAR) AS "travelTime", CAST(k % 5 AS VARCHAR) AS "productLevel",
  '0' || (k % 3) AS "productType"
FROM logs, (VALUES (0), (1)) s(i) WHERE event_type = 'purchase' AND event_id % 10 <> 1""",
    "log_event_filters": f"""WITH {LOGS_SQL}
SELECT 'interactive' AS kind, count(*) AS events FROM logs WHERE "eventType" IN ('01', '02', '04')
UNION ALL SELECT 'any', count(*) FROM logs UNION ALL SELECT 'click', count(*) FROM logs WHERE "eventType" = '02'""",
    "log_quality_gate": f"""WITH {LOGS_SQL}
SELECT sid, concat_ws('; ', CASE WHEN event_id % 13 = 0 THEN 'action is null' END,
  CASE WHEN event_id % 17 = 0 THEN 'eventType is null' END, CASE WHEN event_id % 19 = 0 THEN 'ct is zero' END) AS problems
FROM logs""",
    "decode_codes": f"""WITH {LOGS_SQL}
SELECT sid, action, {_code_case("action", ops.ACTIONS, 1)} AS "actionName", {_code_case("action", ops.ACTIONS, 2)} AS "actionText",
  "eventType", {_code_case('"eventType"', ops.EVENTS, 1)} AS "eventTypeName",
  {_code_case('"eventType"', ops.EVENTS, 2)} AS "eventTypeText" FROM logs""",
    "cep_duration_matches": f"""WITH {_matches_sql(2 * HOUR)}
SELECT sid, "userId", duration, ct, count(*) AS matches FROM alerted GROUP BY ALL""",
    "cep_duration_alerts": f"WITH {_matches_sql(2 * HOUR)} SELECT {ALERT_SQL} FROM alerted",
    "cep_duration_events": f"""WITH {_matches_sql(6 * HOUR)},
once AS (SELECT DISTINCT * FROM alerted) SELECT {ALERT_SQL} FROM once""",
    "cep_duration_by_user": f"""WITH {_matches_sql(5 * DAY, True)}
SELECT sid, "userId", duration, ct, count(*) AS matches FROM alerted GROUP BY ALL""",
    "envelope_alert": f"""WITH {_matches_sql(6 * HOUR)},
once AS (SELECT DISTINCT * FROM alerted)
SELECT md5("userId" || "userRegion" || "userRegionIP") AS key, "userId", duration, CAST(ct AS VARCHAR) AS ct FROM once""",
    "envelope_page_view": f"""WITH {VIEWS_SQL} SELECT md5(sid || "userDevice" || 'P' || k) AS key, 'P' || k AS "targetId" FROM views""",
    "envelope_log": f"WITH {LOGS_SQL} SELECT sid AS key, CAST(ct AS VARCHAR) AS ct FROM logs",
    "pageview_stats": f"WITH {VIEWS_SQL} " + _view_stats_sql(6 * HOUR, ["userRegion"], "views"),
    "low_duration_split": f"WITH {VIEWS_SQL} " + " UNION ALL ".join(
        f"SELECT *, '{name}' AS part FROM ("
        + _view_stats_sql(DAY, [], f"(SELECT * FROM views WHERE CAST(duration AS BIGINT) {test} 5)") + ")"
        for name, test in (("kept", ">="), ("low", "<"))
    ),
    "click_stats": f"""WITH {LOGS_SQL}
SELECT "userRegion", 'T' || (k % 7) AS "eventTargetType", ct // {6 * HOUR} * {6 * HOUR} AS "startWindowTime",
  ct // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS "endWindowTime", count(*) AS access, count(DISTINCT "userId") AS users
FROM logs WHERE event_type = 'click' GROUP BY ALL""",
    "launch_stats": f"""WITH {LOGS_SQL}
SELECT "userRegion", ct // {6 * HOUR} * {6 * HOUR} AS "startWindowTime", ct // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS "endWindowTime",
  count(*) AS launches, count(DISTINCT "userId") AS users FROM logs WHERE action = '02' GROUP BY ALL""",
    "launch_records": f"""WITH {LOGS_SQL}
SELECT "userDevice", "userId", "userRegion", "userRegionIP" AS "userRegionIp", "networkType", ct FROM logs WHERE action = '02'""",
    "burst_orders_by_user": _burst_sql(ORDERS_SQL, "SELECT * FROM orders_d", '"orderID", "userID", ct', "userID", "seq", 4, DAY),
    "burst_launches_by_user": _burst_sql(
        LOGS_SQL, "SELECT * FROM logs WHERE action = '02'", 'sid, "userId", ct', "userId", "event_id", 2, DAY
    ),
    "remote_logins": f"""WITH {LOGS_SQL},
l AS (SELECT sid, "userId", 'R' || (event_id % 7) AS "userRegion", ct FROM logs WHERE action = '02')
SELECT a.sid, a."userId", a."userRegion", a.ct, count(DISTINCT b."userRegion") AS regions
FROM l a JOIN l b ON b."userId" = a."userId" AND b.ct <= a.ct AND b.ct > a.ct - {2 * DAY} GROUP BY ALL HAVING count(DISTINCT b."userRegion") > 1""",
    "many_means": f"""WITH {LOGS_SQL}
SELECT a.sid, a."userId", a."eventType", a.ct, count(DISTINCT b."eventType") AS means
FROM logs a JOIN logs b ON b."userId" = a."userId" AND b.ct <= a.ct AND b.ct > a.ct - {DAY} GROUP BY ALL HAVING count(DISTINCT b."eventType") > 2""",
    "price_below_value": _burst_sql(
        ORDERS_SQL, "SELECT *, 1 AS everyone FROM orders_d WHERE price * 10 < fee - 8", '"orderID", price, fee, ct',
        "everyone", "seq", 1, HOUR,
    ),
}
