"""Registered order queries and the SQL each one must agree with."""

from pyspark.sql import functions as F

from orderflow.operators import bitmaps, counted, lookup, messages, orders as ops, ranking, windows
from orderflow.plans import base
from orderflow.plans.base import BEYOND_SQL, HOTELS_SQL, MEMBERS_SQL, ORDERS_SQL, PRODUCTS_SQL, WIDE_SQL
from orderflow.schemas import UNMATCHED_HOTEL, UNMATCHED_ONE_DIM, UNMATCHED_PRODUCT

HOUR = 3_600_000
DAY = 24 * HOUR
ORDER_FIELDS = (
    '"orderID", "userID", "productID", "pubID", "userMobile", "userRegion", traffic, "trafficGrade", '
    '"trafficType", price, fee, "hasActivity", adult, yonger, baby, ct'
)
WIDE_FIELDS = (
    '"orderID", "userID", "productID", "pubID", "userMobile", "userRegion", traffic, "trafficGrade", '
    '"trafficType", price, CAST(fee AS BIGINT) AS fee, "hasActivity", adult, yonger, baby, ct, '
    '"productLevel", "productType", "toursimType", "depCode", "desCode"'
)


def _wide(spark, folder):
    return lookup.widen_orders(base.orders(spark, folder), base.products(spark, folder))


def order_detail_parse(spark, folder):
    return ops.parse_orders(base.order_lines(spark, folder))


def order_rejects(spark, folder):
    lines = base.order_lines(spark, folder, broken=True)
    bad = ops.reject_orders(lines)
    return bad.select(
        F.get_json_object("value", "$.order_id").alias("orderID"),
        F.array_join("badFields", ",").alias("badFields"),
    )


def order_wide_broadcast(spark, folder):
    wide = _wide(spark, folder).withColumn("fee", F.col("fee").cast("bigint"))
    return wide.drop("ts", "seq")


def order_mwide_two_dims(spark, folder):
    wide = lookup.widen_orders_two(
        base.orders(spark, folder), base.products(spark, folder), base.hotels(spark, folder)
    )
    return wide.withColumn("fee", F.col("fee").cast("bigint")).drop("ts", "seq")


def order_unmatched(spark, folder):
    return lookup.unmatched(base.orders_beyond(spark, folder), base.products(spark, folder), "productID")


def order_wide_unknown(spark, folder):
    """One dimension: orders of unknown products take its defaults."""
    wide = lookup.widen_orders(base.orders_beyond(spark, folder), base.products(spark, folder))
    return wide.select("orderID", "productID", *UNMATCHED_ONE_DIM)


def order_mwide_unknown(spark, folder):
    """Two dimensions: orders of unknown products or hotels take the defaults of each, whole dimensions by a
    plain join."""
    dims = base.products(spark, folder), base.hotels(spark, folder)
    wide = lookup.widen_orders_two(base.orders_beyond(spark, folder), *dims, broadcast_rows=0)
    return wide.select("orderID", "productID", "pubID", *UNMATCHED_PRODUCT, *UNMATCHED_HOTEL)


def sliding_panes(spark, folder):
    """`sliding_orders` by panes."""
    return windows.sliding_stats(base.orders(spark, folder), ["traffic"], "2 hours", "1 hour", "1 hour")


def bitmap_rollup(spark, folder):
    """Users per traffic and ten seconds as bitmaps, added up to hours, to days, and to days of all traffic."""
    orders = base.orders(spark, folder)
    numbers = bitmaps.numbered(orders, "userID")
    small = bitmaps.user_bitmaps(orders, numbers, ["traffic"], "userID", 10_000)
    rows, longer = [], small
    for name, keys, size in (("hour", ["traffic"], HOUR), ("day", ["traffic"], DAY), ("all", [], DAY)):
        longer = bitmaps.rolled_up(longer, keys, size)
        users = bitmaps.distinct_users(longer, keys)
        if not keys:
            users = users.withColumn("traffic", F.lit("all"))
        rows.append(users.select(F.lit(name).alias("kind"), "traffic", "startWindowTime", "users"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def order_wide_parse(spark, folder):
    fields = {**ops.ORDER_KEYS, **ops.WIDE_ORDER_KEYS}
    texts = [F.col(f).cast("string").alias(k) for k, f in fields.items()]
    return ops.parse_wide_orders(_wide(spark, folder).select(F.to_json(F.struct(*texts)).alias("value")))


def agg_region_traffic_tumbling(spark, folder):
    fields = ["userRegion", "traffic", "fee", "adult", "yonger", "baby", "ct"]
    orders = ops.with_event_time(ops.parse_orders(base.order_lines(spark, folder), fields=fields))
    return windows.region_traffic_stats(orders, "1 hour")


def agg_product_traffic_tumbling(spark, folder):
    return windows.product_traffic_stats(base.orders(spark, folder), "1 hour")


def agg_wide_type_window(spark, folder):
    return windows.type_stats(_wide(spark, folder), "1 hour")


def agg_exact_average(spark, folder):
    stats = windows.region_traffic_stats(base.orders(spark, folder), "1 day", exact=True)
    return stats.withColumn("avgFee", F.round("avgFee", 6))


def agg_session_traffic(spark, folder):
    return windows.session_stats_batch(base.orders(spark, folder), ["traffic"], 15 * 60_000)


def agg_count_window_region(spark, folder):
    return counted.count_window_stats(base.orders(spark, folder), ["userRegion", "traffic"], 20)


def agg_count_window_type(spark, folder):
    return counted.count_window_stats(_wide(spark, folder), ["productType", "toursimType"], 20)


def stat_running_count_trigger(spark, folder):
    return counted.count_triggered_stats(base.orders(spark, folder), ["traffic"], 20, DAY)


def stat_running_with_tail(spark, folder):
    return counted.count_triggered_stats(
        base.orders(spark, folder), ["traffic"], 50, DAY, 16 * HOUR, emit_tail=True
    )


def stat_day_utc8(spark, folder):
    return windows.hourly_day_stats(ops.with_hour(base.orders(spark, folder)))


def stat_count_or_time(spark, folder):
    return counted.count_or_time_stats(_wide(spark, folder), interval_ms=DAY)


def running_totals_dep(spark, folder):
    totals = windows.running_totals(_wide(spark, folder))
    return messages.subset(totals, ["depCode", "orders", "fee", "ct", "missing"])


def _product_hours(spark, folder):
    return windows.product_traffic_stats(base.orders(spark, folder), "1 hour")


def topn_within_key(spark, folder):
    return ranking.top_n(_product_hours(spark, folder), period_ms=3 * DAY)


def topn_cross_product(spark, folder):
    return ranking.top_n(_product_hours(spark, folder), period_ms=3 * HOUR, rank_within=())


def topn_all_ties(spark, folder):
    return ranking.top_n(_product_hours(spark, folder), 5, DAY, ("traffic",), ties="all")


def _from_value(rows, fields):
    """The value JSON read back into typed columns."""
    parsed = rows.select("*", F.from_json("value", fields).alias("v"))
    return parsed.drop("value").select("*", "v.*").drop("v")


def kv_latest(spark, folder):
    stats = windows.region_traffic_stats(base.orders(spark, folder), "1 hour")
    pairs = stats.select(
        F.concat_ws("_", "userRegion", "traffic").alias("key"),
        messages.as_json(stats.columns).alias("value"), "endWindowTime",
    )
    latest = messages.latest_per_key(pairs, "key", "endWindowTime").select("key", "value")
    return _from_value(latest, "startWindowTime bigint, endWindowTime bigint, orders bigint, totalFee bigint, avgFee double")


def doc_upsert_latest(spark, folder):
    stats = messages.with_id(windows.hourly_day_stats(ops.with_hour(base.orders(spark, folder))), "hourly_stats")
    renamed = stats.withColumn("id", F.substring_index("id", "_", 1))
    latest = messages.latest_per_key(renamed, "id", F.struct("startWindowTime", "etTime"))
    return latest.select("id", "etTime", "startWindowTime", "orders", "users", "totalFee")


def envelope_order_detail(spark, folder):
    orders = ops.parse_orders(base.order_lines(spark, folder))
    return _from_value(
        messages.envelope(orders, "order_detail"), "orderID string, traffic string, price int, fee int, ct string"
    )


def envelope_mwide(spark, folder):
    rows = messages.envelope(order_mwide_two_dims(spark, folder), "order_mwide")
    return _from_value(rows, "orderID string, fee string, productLevel int, pubStar string, isNational string")


def sliding_orders(spark, folder):
    return windows.order_window_stats(
        base.orders(spark, folder), ["traffic"], "2 hours", "1 hour"
    )


def order_stat_shapes(spark, folder):
    """Windowed users and orders by region and traffic."""
    stats = windows.windowed_users(
        base.orders(spark, folder), ["userRegion", "traffic"], "userID",
        {"totalFee": F.col("fee").cast("bigint")}, "6 hours",
    )
    return stats.select(
        "userRegion", "traffic", *windows.window_bounds(), "orders", "users", "totalFee"
    )


def partition_routing(spark, folder):
    rows = messages.envelope(ops.parse_orders(base.order_lines(spark, folder)), "order_detail")
    return messages.assign_partition(rows, "key", 16).groupBy("partition").agg(F.count("*").alias("messages"))


QUERIES = {f.__name__: f for f in (
    order_detail_parse, order_rejects, order_wide_broadcast, order_mwide_two_dims, order_unmatched,
    order_wide_unknown, order_mwide_unknown, sliding_panes, bitmap_rollup,
    order_wide_parse, agg_region_traffic_tumbling, agg_product_traffic_tumbling, agg_wide_type_window,
    agg_exact_average, agg_session_traffic, agg_count_window_region, agg_count_window_type,
    stat_running_count_trigger, stat_running_with_tail, stat_day_utc8, stat_count_or_time,
    running_totals_dep, topn_within_key, topn_cross_product, topn_all_ties, kv_latest,
    doc_upsert_latest, envelope_order_detail, envelope_mwide, sliding_orders, order_stat_shapes,
    partition_routing,
)}


# --- SQL ------------------------------------------------------------------------------

MEASURES_SQL = f"""count(*) AS orders, CAST(greatest(max(fee), 0) AS BIGINT) AS "maxFee",
    CAST(sum(fee) AS BIGINT) AS "totalFee", CAST(sum({MEMBERS_SQL}) AS BIGINT) AS members,
    CAST(CAST(sum(fee) AS BIGINT) // count(*) AS DOUBLE) AS "avgFee\""""


def _window_sql(keys, size, source="orders_d", end=0):
    keys = ", ".join(f'"{k}"' for k in keys)
    return f"""SELECT {keys}, ct // {size} * {size} AS "startWindowTime",
    ct // {size} * {size} + {size - end} AS "endWindowTime", {MEASURES_SQL}
  FROM {source} GROUP BY {keys}, ct // {size}"""


def _count_window_sql(with_sql, source, keys, size):
    keys = ", ".join(f'"{k}"' for k in keys)
    return f"""WITH {with_sql},
placed AS (SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY ct, seq) - 1) // {size} AS chunk FROM {source})
SELECT {keys}, chunk, max(ct) AS "endWindowTime", {MEASURES_SQL}
FROM placed GROUP BY {keys}, chunk HAVING count(*) = {size}"""


def _trigger_sql(size, offset, tail):
    keep = f"rn % {size} = 0" + (" OR rn = n" if tail else "")
    period = f"(ct - {offset}) // {DAY} * {DAY} + {offset}"
    return f"""WITH {ORDERS_SQL},
timed AS (SELECT *, {period} AS "startWindowTime" FROM orders_d),
seen AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY traffic, "startWindowTime", "userID" ORDER BY ct, seq) = 1
    THEN 1 ELSE 0 END AS fresh FROM timed),
running AS (SELECT traffic, "startWindowTime", ct, row_number() OVER w AS rn, sum(fresh) OVER w AS users,
    sum(fee) OVER w AS fees, count(*) OVER (PARTITION BY traffic, "startWindowTime") AS n
  FROM seen WINDOW w AS (PARTITION BY traffic, "startWindowTime" ORDER BY ct, seq ROWS UNBOUNDED PRECEDING))
SELECT traffic, strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS "etTime", "startWindowTime", ct,
  rn AS orders, CAST(users AS BIGINT) AS users, CAST(fees AS BIGINT) AS "totalFee"
FROM running WHERE {keep}"""


PRODUCT_HOURS_SQL = f"""product_hours AS (
  SELECT "productID", traffic, ct // {HOUR} * {HOUR} AS "startWindowTime",
    ct // {HOUR} * {HOUR} + {HOUR} AS "endWindowTime", count(*) AS orders, CAST(sum(fee) AS BIGINT) AS "totalFee"
  FROM orders_d GROUP BY ALL)"""


def _topn_sql(period, n, group, collapse):
    part = ", ".join(['"rankWindowTime"', *[f'"{g}"' for g in group]])
    distinct = f"""SELECT * FROM ranked_rows QUALIFY row_number() OVER (PARTITION BY {part}, orders, "totalFee"
      ORDER BY "startWindowTime", "endWindowTime", "productID", traffic) = 1"""
    return f"""WITH {ORDERS_SQL},
{PRODUCT_HOURS_SQL},
ranked_rows AS (SELECT "startWindowTime" // {period} * {period} AS "rankWindowTime", * FROM product_hours),
kept AS ({distinct if collapse else 'SELECT * FROM ranked_rows'})
SELECT "rankWindowTime", "productID", traffic, "startWindowTime", "endWindowTime", orders, "totalFee",
  CAST(row_number() OVER best AS INTEGER) AS rank
FROM kept WINDOW best AS (PARTITION BY {part} ORDER BY orders DESC, "totalFee" DESC, "startWindowTime", "productID", traffic)
QUALIFY rank <= {n}"""


DAY_UTC8_SQL = f"""SELECT traffic, strftime(make_timestamp(ct * 1000), '%Y%m%d%H') AS "etTime",
    (ct - {16 * HOUR}) // {DAY} * {DAY} + {16 * HOUR} AS "startWindowTime",
    (ct - {16 * HOUR}) // {DAY} * {DAY} + {40 * HOUR} AS "endWindowTime",
    count(*) AS orders, count(DISTINCT "userID") AS users, CAST(sum(fee) AS BIGINT) AS "totalFee"
  FROM orders_d GROUP BY ALL"""

MWIDE_SQL = f"""{ORDERS_SQL},
{PRODUCTS_SQL},
{HOTELS_SQL},
mwide AS (
  SELECT o.*, coalesce(p."productLevel", 0) AS "productLevel", coalesce(p."productType", '') AS "productType",
    coalesce(p."toursimType", '') AS "toursimType", coalesce(p."depCode", '') AS "depCode",
    coalesce(p."desCode", '') AS "desCode", coalesce(h."pubStar", '') AS "pubStar",
    coalesce(h."pubGrade", '') AS "pubGrade", coalesce(h."isNational", '') AS "isNational"
  FROM orders_d o LEFT JOIN products p USING ("productID") LEFT JOIN hotels h USING ("pubID"))"""

ORACLE = {
    "order_detail_parse": f"WITH {ORDERS_SQL} SELECT {ORDER_FIELDS} FROM orders_d",
    "order_rejects": f"""WITH {ORDERS_SQL}
SELECT "orderID", concat_ws(',', CASE WHEN seq % 97 = 0 THEN 'fee' END, CASE WHEN seq % 89 = 0 THEN 'ct' END) AS "badFields"
FROM orders_d WHERE seq % 97 = 0 OR seq % 89 = 0""",
    "order_wide_broadcast": f"WITH {WIDE_SQL} SELECT {WIDE_FIELDS} FROM wide",
    "order_mwide_two_dims": f'WITH {MWIDE_SQL} SELECT {WIDE_FIELDS}, "pubStar", "pubGrade", "isNational" FROM mwide',
    "order_wide_unknown": f"""WITH {BEYOND_SQL},
{PRODUCTS_SQL}
SELECT o."orderID", o."productID", coalesce(p."productLevel", -1) AS "productLevel", coalesce(p."productType", '-1') AS "productType",
  coalesce(p."toursimType", '-1') AS "toursimType", coalesce(p."depCode", '-1') AS "depCode", coalesce(p."desCode", '-1') AS "desCode"
FROM beyond o LEFT JOIN products p USING ("productID")""",
    "order_mwide_unknown": f"WITH {MWIDE_SQL.replace(ORDERS_SQL, BEYOND_SQL).replace('FROM orders_d o LEFT JOIN', 'FROM beyond o LEFT JOIN')} "
    + f"""SELECT "orderID", "productID", "pubID", {", ".join(f'"{c}"' for c in [*UNMATCHED_PRODUCT, *UNMATCHED_HOTEL])} FROM mwide""",
    "bitmap_rollup": f"""WITH {ORDERS_SQL}
SELECT 'hour' AS kind, traffic, ct // {HOUR} * {HOUR} AS "startWindowTime", count(DISTINCT "userID") AS users FROM orders_d GROUP BY ALL
UNION ALL SELECT 'day', traffic, ct // {DAY} * {DAY}, count(DISTINCT "userID") FROM orders_d GROUP BY ALL
UNION ALL SELECT 'all', 'all', ct // {DAY} * {DAY}, count(DISTINCT "userID") FROM orders_d GROUP BY ALL""",
    "order_unmatched": f"""WITH {BEYOND_SQL},
{PRODUCTS_SQL}
SELECT "productID", count(*) AS orders FROM beyond
WHERE "productID" NOT IN (SELECT "productID" FROM products) GROUP BY 1""",
    "order_wide_parse": f"WITH {WIDE_SQL} SELECT {WIDE_FIELDS} FROM wide",
    "agg_region_traffic_tumbling": f"WITH {ORDERS_SQL} " + _window_sql(["userRegion", "traffic"], HOUR),
    "agg_product_traffic_tumbling": f"WITH {ORDERS_SQL}, {PRODUCT_HOURS_SQL} SELECT * FROM product_hours",
    "agg_wide_type_window": f"WITH {WIDE_SQL} " + _window_sql(["productType", "toursimType"], HOUR, "wide", 1),
    "agg_exact_average": f"WITH {ORDERS_SQL} " + _window_sql(["userRegion", "traffic"], DAY).replace(
        "CAST(CAST(sum(fee) AS BIGINT) // count(*) AS DOUBLE)", "round(CAST(sum(fee) AS DOUBLE) / count(*), 6)"
    ),
    "agg_session_traffic": f"""WITH {ORDERS_SQL},
opened AS (SELECT *, CASE WHEN ct - lag(ct) OVER (PARTITION BY traffic ORDER BY ct, seq) <= {15 * 60_000} THEN 0 ELSE 1 END AS opens
  FROM orders_d),
sessions AS (SELECT *, sum(opens) OVER (PARTITION BY traffic ORDER BY ct, seq ROWS UNBOUNDED PRECEDING) AS s FROM opened)
SELECT traffic, min(ct) AS "startWindowTime", max(ct) + {15 * 60_000} AS "endWindowTime", {MEASURES_SQL}
FROM sessions GROUP BY traffic, s""",
    "agg_count_window_region": _count_window_sql(ORDERS_SQL, "orders_d", ["userRegion", "traffic"], 20),
    "agg_count_window_type": _count_window_sql(WIDE_SQL, "wide", ["productType", "toursimType"], 20),
    "stat_running_count_trigger": _trigger_sql(20, 0, False),
    "stat_running_with_tail": _trigger_sql(50, 16 * HOUR, True),
    "stat_day_utc8": f"WITH {ORDERS_SQL} {DAY_UTC8_SQL}",
    "stat_count_or_time": f"""WITH {WIDE_SQL},
placed AS (SELECT *, ct // {DAY} AS d, (row_number() OVER (PARTITION BY "productType", "toursimType", ct // {DAY}
    ORDER BY ct, seq) - 1) // 10 AS chunk FROM wide)
SELECT "productType", "toursimType", min(ct) AS "startWindowTime",
  CASE WHEN count(*) = 10 THEN max(ct) ELSE (d + 1) * {DAY} END AS "endWindowTime",
  count(*) AS orders, count(DISTINCT "userID") AS users, CAST(sum(fee) AS BIGINT) AS "totalFee"
FROM placed GROUP BY "productType", "toursimType", d, chunk""",
    "running_totals_dep": f"""WITH {WIDE_SQL}
SELECT "depCode", count(*) AS orders, CAST(sum(fee) AS BIGINT) AS fee, arg_max(ct, seq) AS ct FROM wide GROUP BY 1""",
    "topn_within_key": _topn_sql(3 * DAY, 3, ["productID", "traffic"], True),
    "topn_cross_product": _topn_sql(3 * HOUR, 3, [], True),
    "topn_all_ties": _topn_sql(DAY, 5, ["traffic"], False),
    "kv_latest": f"""WITH {ORDERS_SQL}, stats AS ({_window_sql(["userRegion", "traffic"], HOUR)})
SELECT "userRegion" || '_' || traffic AS key, "startWindowTime", "endWindowTime", orders, "totalFee", "avgFee"
FROM stats QUALIFY row_number() OVER (PARTITION BY "userRegion", traffic ORDER BY "endWindowTime" DESC) = 1""",
    "doc_upsert_latest": f"""WITH {ORDERS_SQL}, stats AS ({DAY_UTC8_SQL})
SELECT traffic AS id, "etTime", "startWindowTime", orders, users, "totalFee"
FROM stats QUALIFY row_number() OVER (PARTITION BY traffic ORDER BY "startWindowTime" DESC, "etTime" DESC) = 1""",
    "envelope_order_detail": f"""WITH {ORDERS_SQL}
SELECT md5("productID" || traffic) AS key, "orderID", traffic, price, fee, CAST(ct AS VARCHAR) AS ct FROM orders_d""",
    "envelope_mwide": f"""WITH {MWIDE_SQL}
SELECT md5("orderID" || "productID" || "pubID" || ct) AS key, "orderID", CAST(fee AS VARCHAR) AS fee,
  "productLevel", "pubStar", "isNational" FROM mwide""",
    "sliding_orders": f"""WITH {ORDERS_SQL},
slid AS (SELECT o.*, (ct // {HOUR} - s.i) * {HOUR} AS w FROM orders_d o, (VALUES (0), (1)) s(i))
SELECT traffic, w AS "startWindowTime", w + {2 * HOUR} AS "endWindowTime", {MEASURES_SQL}
FROM slid GROUP BY traffic, w""",
    "order_stat_shapes": f"""WITH {ORDERS_SQL}
SELECT "userRegion", traffic, ct // {6 * HOUR} * {6 * HOUR} AS "startWindowTime",
  ct // {6 * HOUR} * {6 * HOUR} + {6 * HOUR} AS "endWindowTime", count(*) AS orders,
  count(DISTINCT "userID") AS users, CAST(sum(fee) AS BIGINT) AS "totalFee"
FROM orders_d GROUP BY ALL""",
    "partition_routing": f"""WITH {ORDERS_SQL},
keyed AS (SELECT CAST(CAST('0x' || substr(md5(md5("productID" || traffic)), 1, 8) AS BIGINT) % 16 AS INTEGER) AS partition FROM orders_d)
SELECT partition, count(*) AS messages FROM keyed GROUP BY 1""",
}
ORACLE["sliding_panes"] = ORACLE["sliding_orders"]
