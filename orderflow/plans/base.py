"""Base frames of the registered queries and their SQL counterparts."""

from pyspark.sql import functions as F

from orderflow.operators.logs import log_messages
from orderflow.operators.orders import with_event_time
from orderflow.sources import tables
from orderflow.sources.dimensions import hotel_dimension, product_dimension


def orders(spark, folder):
    return with_event_time(tables.orders_from(tables.table(spark, folder, "events")))


def orders_beyond(spark, folder):
    """Orders of which some name a product or a hotel that no dimension has."""
    def lost(name, by, rest):
        return F.when(F.col("seq") % by == rest, F.concat(F.lit("X"), name)).otherwise(F.col(name))

    return orders(spark, folder).withColumns({"productID": lost("productID", 7, 3), "pubID": lost("pubID", 11, 5)})


def logs(spark, folder):
    return with_event_time(tables.logs_from(tables.table(spark, folder, "events")))


def order_lines(spark, folder, broken=False):
    return tables.order_messages(tables.orders_from(tables.table(spark, folder, "events")), broken)


def log_lines(spark, folder):
    return log_messages(logs(spark, folder))


def products(spark, folder):
    return product_dimension(tables.products_from(tables.table(spark, folder, "part")))


def hotels(spark, folder):
    return hotel_dimension(tables.hotels_from(tables.table(spark, folder, "supplier")))


# SQL forms of the same frames; queries put them in front as WITH items.
ORDERS_SQL = """orders_d AS (
  SELECT CAST(event_id AS VARCHAR) AS "orderID", CAST(user_id AS VARCHAR) AS "userID",
    json_extract_string(props, '$.k') AS "productID", CAST(event_id % 40 AS VARCHAR) AS "pubID",
    'm' || user_id AS "userMobile", 'R' || (user_id % 5) AS "userRegion", event_type AS traffic,
    CAST(event_id % 3 AS VARCHAR) AS "trafficGrade", CAST(event_id % 2 AS VARCHAR) AS "trafficType",
    CAST(floor(value) AS INTEGER) AS price, CAST(floor(value * 10) AS INTEGER) AS fee,
    CAST(event_id % 4 AS VARCHAR) AS "hasActivity", CAST(1 + event_id % 2 AS VARCHAR) AS adult,
    CAST(event_id % 3 AS VARCHAR) AS yonger, CASE WHEN event_id % 5 = 0 THEN '1' ELSE '0' END AS baby,
    epoch_us(ts) // 1000 AS ct, event_id AS seq
  FROM events)"""

MEMBERS_SQL = "CAST(adult AS BIGINT) + CAST(yonger AS BIGINT) + CAST(baby AS BIGINT)"

LOGS_SQL = """log_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
logs AS (
  SELECT CAST(event_id AS VARCHAR) AS sid, 'd' || (user_id % 50) AS "userDevice",
    '1' AS "userDeviceType", 'android' AS os, CAST(user_id AS VARCHAR) AS "userId",
    'R' || (user_id % 5) AS "userRegion", '10.0.' || (user_id % 7) || '.' || (user_id % 11) AS "userRegionIP",
    '106.6' AS longitude, '26.6' AS latitude, 'maker' AS manufacturer, 'carrier' AS carrier,
    '4g' AS "networkType", CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS duration,
    CASE event_type WHEN 'view' THEN '07' WHEN 'signup' THEN '08' WHEN 'error' THEN '02' ELSE '05' END AS action,
    CASE WHEN event_type = 'click' THEN '02'
         WHEN event_type = 'purchase' AND event_id % 2 = 1 THEN '04' ELSE '01' END AS "eventType",
    epoch_us(ts) // 1000 AS ct, '52' AS "hotTarget", event_id, event_type, k
  FROM log_k)"""

PRODUCTS_SQL = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS "productID", p_size % 5 + 1 AS "productLevel",
    p_type AS "productType", p_brand AS "depCode", 'C' || (p_partkey % 13) AS "desCode",
    CASE WHEN p_size % 2 = 0 THEN '0' ELSE '1' END AS "toursimType"
  FROM part)"""

HOTELS_SQL = """hotels AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS "pubID", CAST(s_nationkey % 5 + 1 AS VARCHAR) AS "pubStar",
    CASE WHEN s_acctbal < 0 THEN 'C' WHEN s_acctbal < 5000 THEN 'B' ELSE 'A' END AS "pubGrade",
    CASE WHEN s_nationkey < 12 THEN '1' ELSE '0' END AS "isNational"
  FROM supplier)"""

WIDE_SQL = f"""{ORDERS_SQL},
{PRODUCTS_SQL},
wide AS (
  SELECT o.*, coalesce(p."productLevel", -1) AS "productLevel", coalesce(p."productType", '-1') AS "productType",
    coalesce(p."toursimType", '-1') AS "toursimType", coalesce(p."depCode", '-1') AS "depCode",
    coalesce(p."desCode", '-1') AS "desCode"
  FROM orders_d o LEFT JOIN products p USING ("productID"))"""

BEYOND_SQL = f"""{ORDERS_SQL},
beyond AS (SELECT * REPLACE (CASE WHEN seq % 7 = 3 THEN 'X' || "productID" ELSE "productID" END AS "productID",
  CASE WHEN seq % 11 = 5 THEN 'X' || "pubID" ELSE "pubID" END AS "pubID") FROM orders_d)"""
