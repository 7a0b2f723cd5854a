"""Registered queries over the scalar expressions and the SQL each one must agree with."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions import arrays, dates, jsons, numbers, text, variants
from orderflow.plans import base
from orderflow.plans.base import ORDERS_SQL, PRODUCTS_SQL
from orderflow.sources import tables
from orderflow.sources.dimensions import keyed_snapshot


def scalar_dates(spark, folder):
    rows = base.orders(spark, folder).withColumn("later", F.timestamp_millis(F.col("ct") + 86_400_000 * 31))
    card = F.concat(F.lit("110101"), F.date_format("ts", "yyyyMMdd"), F.lit("0017"))
    return rows.withColumn("card", card).withColumn("day", F.date_format("ts", dates.DAY)).select(
        "orderID",
        dates.epoch_text("ct").alias("hour"),
        dates.date_text("ts").alias("full"),
        F.unix_millis(dates.text_date("day", dates.DAY)).alias("midnight"),
        F.unix_millis(dates.shift("ts", 1, "MONTH")).alias("nextMonth"),
        dates.shift_text("day", -1, "DAY", dates.DAY, "yyyy-MM-dd").alias("dayBefore"),
        dates.over_time("later", "ts", 1, "MONTH").alias("monthAhead"),
        dates.over_time("later", "ts", 0, "HOUR").alias("hourAhead"),
        dates.compare_times("later", "ts").alias("order"),
        dates.age_from_card("card", F.lit("2044-01-16").cast("date")).alias("age"),
    )


def scalar_text(spark, folder):
    rows = tables.table(spark, folder, "part")
    return rows.select(
        "p_partkey",
        text.zero_pad("p_size", 5).alias("padded"),
        text.fill_right("p_brand", 12, "x").alias("filled"),
        text.without_spaces("p_name").alias("compact"),
        text.is_number("p_name").alias("isNumber"),
        text.is_number(F.col("p_partkey").cast("string")).alias("isNumberToo"),
        text.is_one_of("p_type", ["SMALL", "ECONOMY"]).alias("oneOf"),
        text.has_part("p_name", "RED", ignore_case=True).alias("hasPart"),
        text.join_text(text.split_text("p_name", " "), "|").alias("rejoined"),
        arrays.index_of(F.split("p_name", " "), "gear").alias("gearAt"),
        arrays.same_elements(F.split("p_name", " "), F.reverse(F.split("p_name", " "))).alias("same"),
        text.url_encoded("p_brand").alias("encoded"),
        text.recharset("p_brand", "UTF-8", "ISO-8859-1").alias("recoded"),
        text.underscored(F.concat(F.lit("dim."), F.col("p_type"), F.lit(".v1"))).alias("key"),
        F.array_join(text.ip_addresses(F.concat(F.lit("from 10.0.3."), F.col("p_size"), F.lit(" up"))), ",").alias("ips"),
    )


def scalar_numbers(spark, folder):
    rows = tables.table(spark, folder, "part").withColumn("half", F.col("p_size") / 4)
    rows = rows.withColumn("below", (F.col("p_size") - 25).cast("int"))
    return rows.select(
        "p_partkey",
        numbers.formatted("half", "0.00").alias("quarters"),
        numbers.hex_text("p_size").alias("hexed"),
        numbers.hex_text("below").alias("hexedBelow"),
        F.greatest("p_size", F.lit(10)).alias("atLeastTen"),
    )


def scalar_hashes(spark, folder):
    rows = tables.table(spark, folder, "customer")
    return rows.select(
        "c_custkey",
        text.md5_hex("c_name").alias("md5Hex"),
        text.digest_hex("c_name", "MD5").alias("md5Upper"),
        text.digest_hex("c_name", "SHA-1").alias("sha1Upper"),
        text.digest_hex("c_name", "SHA-256", upper=False).alias("sha256Hex"),
    )


def scalar_emptiness(spark, folder):
    """Null, empty and filled arrays and maps."""
    rows = base.orders(spark, folder)
    listed = F.when(F.col("seq") % 7 != 0, F.filter(F.array("traffic", "userRegion"), lambda x: F.col("seq") % 5 != 0))
    mapped = F.map_from_arrays(F.slice(F.array("traffic"), 1, (F.col("seq") % 2).cast("int")), F.slice(F.array("fee"), 1, (F.col("seq") % 2).cast("int")))
    return rows.select("orderID", arrays.is_empty(listed).alias("noList"), arrays.is_empty(mapped).alias("noMap"))


def dimension_snapshot(spark, folder):
    """The product dimension as key and JSON text, the last row per key, read back field by field."""
    part = tables.products_from(tables.table(spark, folder, "part"))
    older = part.withColumn("product_type", F.lit("old")).withColumn("version", F.lit(1))
    rows = older.unionByName(part.withColumn("version", F.lit(2)))
    pairs = keyed_snapshot(rows, "product_id", "version")
    names = ["product_level", "product_type", "departure_code", "des_city_code", "toursim_tickets_type"]
    return pairs.select("key", *[F.get_json_object("value", f"$.{n}").alias(n) for n in names])


NESTED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("user", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("home", T.StructType([T.StructField("region", T.StringType())])),
    ])),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("product", T.StringType()), T.StructField("fee", T.IntegerType()),
    ]))),
])


def json_flatten(spark, folder):
    item = F.struct(F.col("productID").alias("product"), "fee")
    text_of = F.to_json(F.struct(
        F.col("orderID").alias("id"),
        F.struct(F.col("userID").alias("name"), F.struct(F.col("userRegion").alias("region")).alias("home")).alias("user"),
        F.array("traffic", F.when(F.col("seq") % 2 == 0, F.lit("even"))).alias("tags"),
        F.array(item, item).alias("items"),
    ))
    rows = base.orders(spark, folder).select("orderID", text_of.alias("value"))
    entry = F.explode(jsons.flat_json_entries("value", NESTED)).alias("e")
    return rows.select("orderID", entry).select("orderID", F.col("e.key").alias("key"), F.col("e.value").alias("text"))


def json_flatten_any(spark, folder):
    """Messages of three shapes and lines that are no object, flattened without a schema."""
    stops = F.array(*[F.struct(F.col(c).alias("at")) for c in ("pubID", "traffic")])
    shapes = (
        F.struct(F.col("orderID").alias("id"), F.struct(F.struct(F.col("userRegion").alias("region")).alias("home")).alias("user"),
                 F.array("traffic", F.when(F.col("seq") % 8 == 0, F.lit("even"))).alias("tags")),
        F.struct(F.col("orderID").alias("id"), "fee", (F.col("seq") % 8 == 1).alias("paid")),
        F.struct(F.struct(F.struct(F.col("userRegion").alias("city")).alias("from"), stops.alias("stops")).alias("route")),
    )
    options = {"ignoreNullFields": "false"}
    text = F.lit("no object")
    for k, shape in enumerate(shapes):
        text = F.when(F.col("seq") % 4 == k, F.to_json(shape, options)).otherwise(text)
    rows = base.orders(spark, folder).select("orderID", text.alias("message"))
    found = variants.flat_entries(rows, ["orderID"], "message")
    return found.select("orderID", "key", F.col("value").alias("text"))


def json_single_level(spark, folder):
    rows = base.order_lines(spark, folder).select(jsons.text_map("value").alias("m"))
    return rows.select(F.col("m")["order_id"].alias("orderID"), F.explode("m").alias("key", "text"))


QUERIES = {f.__name__: f for f in (
    scalar_dates, scalar_text, scalar_numbers, scalar_hashes, scalar_emptiness, dimension_snapshot, json_flatten,
    json_flatten_any, json_single_level,
)}

ORACLE = {
    "scalar_dates": f"""WITH {ORDERS_SQL},
t AS (SELECT *, make_timestamp(ct * 1000) AS ts, make_timestamp((ct + {86_400_000 * 31}) * 1000) AS later FROM orders_d)
SELECT "orderID", strftime(ts, '%Y%m%d%H') AS hour, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "full",
  epoch_us(date_trunc('day', ts)) // 1000 AS midnight, epoch_us(ts + INTERVAL 1 MONTH) // 1000 AS "nextMonth",
  strftime(date_trunc('day', ts) - INTERVAL 1 DAY, '%Y-%m-%d') AS "dayBefore",
  month(later) - month(ts) >= 1 AS "monthAhead", hour(later) - hour(ts) > 0 AS "hourAhead", 1 AS "order",
  CASE WHEN day(ts) <= 16 THEN 20 ELSE 19 END AS age
FROM t""",
    "scalar_text": """SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded, rpad(p_brand, 12, 'x') AS filled,
  replace(p_name, ' ', '') AS compact, false AS "isNumber", true AS "isNumberToo",
  p_type IN ('SMALL', 'ECONOMY') AS "oneOf", contains(lower(p_name), 'red') AS "hasPart",
  replace(p_name, ' ', '|') AS rejoined, coalesce(list_position(string_split(p_name, ' '), 'gear'), 0) - 1 AS "gearAt",
  true AS same, replace(p_brand, '#', '%23') AS encoded, p_brand AS recoded, 'dim_' || p_type || '_v1' AS key,
  '10.0.3.' || p_size AS ips
FROM part""",
    "scalar_numbers": """SELECT p_partkey, printf('%.2f', p_size / 4.0) AS quarters, upper(printf('%x', p_size)) AS hexed,
  upper(printf('%x', CASE WHEN p_size < 25 THEN 4294967296 + p_size - 25 ELSE p_size - 25 END)) AS "hexedBelow",
  greatest(p_size, 10) AS "atLeastTen"
FROM part""",
    "scalar_hashes": """SELECT c_custkey, md5(c_name) AS "md5Hex", upper(md5(c_name)) AS "md5Upper", upper(sha1(c_name)) AS "sha1Upper",
  sha256(c_name) AS "sha256Hex" FROM customer""",
    "scalar_emptiness": f"""WITH {ORDERS_SQL} SELECT "orderID", seq % 7 = 0 OR seq % 5 = 0 AS "noList", seq % 2 = 0 AS "noMap" FROM orders_d""",
    "dimension_snapshot": f"""WITH {PRODUCTS_SQL}
SELECT "productID" AS key, CAST("productLevel" AS VARCHAR) AS product_level, "productType" AS product_type, "depCode" AS departure_code,
  "desCode" AS des_city_code, "toursimType" AS toursim_tickets_type FROM products""",
    "json_flatten": f"""WITH {ORDERS_SQL}
SELECT "orderID", e.key, e.text FROM orders_d, unnest([
  {{'key': 'id', 'text': "orderID"}}, {{'key': 'user_name', 'text': "userID"}}, {{'key': 'home_region', 'text': "userRegion"}},
  {{'key': 'tags_0', 'text': traffic}}, {{'key': 'tags_1', 'text': CASE WHEN seq % 2 = 0 THEN 'even' END}},
  {{'key': 'items_0_product', 'text': "productID"}}, {{'key': 'items_0_fee', 'text': CAST(fee AS VARCHAR)}},
  {{'key': 'items_1_product', 'text': "productID"}}, {{'key': 'items_1_fee', 'text': CAST(fee AS VARCHAR)}}]) u(e)
WHERE e.text IS NOT NULL""",
    "json_flatten_any": f"""WITH {ORDERS_SQL}
SELECT "orderID", e.key, e.text FROM orders_d, unnest(CASE seq % 4
  WHEN 0 THEN [{{'key': 'id', 'text': "orderID"}}, {{'key': 'home_region', 'text': "userRegion"}}, {{'key': 'tags_0', 'text': traffic}},
    {{'key': 'tags_1', 'text': CASE WHEN seq % 8 = 0 THEN 'even' END}}]
  WHEN 1 THEN [{{'key': 'id', 'text': "orderID"}}, {{'key': 'fee', 'text': CAST(fee AS VARCHAR)}},
    {{'key': 'paid', 'text': CASE WHEN seq % 8 = 1 THEN 'true' ELSE 'false' END}}]
  WHEN 2 THEN [{{'key': 'from_city', 'text': "userRegion"}}, {{'key': 'stops_0_at', 'text': "pubID"}}, {{'key': 'stops_1_at', 'text': traffic}}]
  END) u(e) WHERE e.text IS NOT NULL""",
    "json_single_level": f"""WITH {ORDERS_SQL}
SELECT "orderID", e.key, e.text FROM orders_d, unnest([{", ".join(
    f"{{'key': '{key}', 'text': CAST(" + '"' + field + '"' + " AS VARCHAR)}" for key, field in tables.ORDER_KEYS.items())}]) u(e)""",
}
