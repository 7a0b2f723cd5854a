"""Orders, logs and dimensions derived from the generic `events`, `part` and `supplier` tables."""

from pyspark.sql import functions as F

from orderflow.schemas import ORDER_KEYS

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def _ct():
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _text(column):
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def orders_from(events):
    """Typed order records; `event_id` stays as the arrival number."""
    number = F.col("event_id")
    return events.select(
        _text(number).alias("orderID"),
        _text("user_id").alias("userID"),
        _text(_k()).alias("productID"),
        _text(number % 40).alias("pubID"),
        F.concat(F.lit("m"), _text("user_id")).alias("userMobile"),
        F.concat(F.lit("R"), _text(F.col("user_id") % 5)).alias("userRegion"),
        F.col("event_type").alias("traffic"),
        _text(number % 3).alias("trafficGrade"),
        _text(number % 2).alias("trafficType"),
        F.floor("value").cast("int").alias("price"),
        F.floor(F.col("value") * 10).cast("int").alias("fee"),
        _text(number % 4).alias("hasActivity"),
        _text(1 + number % 2).alias("adult"),
        _text(number % 3).alias("yonger"),
        F.when(number % 5 == 0, "1").otherwise("0").alias("baby"),
        _ct().alias("ct"),
        number.alias("seq"),
    )


def order_messages(orders, broken=False):
    """Orders as JSON text under the message keys; `broken` blanks or drops some required keys."""
    message = {key: _text(field) for key, field in ORDER_KEYS.items()}
    if broken:
        message["product_fee"] = F.when(F.col("seq") % 97 == 0, "").otherwise(message["product_fee"])
        message["order_ct"] = F.when(F.col("seq") % 89 != 0, message["order_ct"])
    return orders.select(
        F.to_json(F.struct(*[c.alias(k) for k, c in message.items()])).alias("value")
    )


def logs_from(events):
    """Behaviour-log records."""
    kind, number = F.col("event_type"), F.col("event_id")
    product = F.concat(F.lit("P"), _text(_k()))
    neighbour = F.concat(F.lit("P"), _text((_k() + 1) % 100))
    list_view = F.to_json(F.struct(
        F.lit("202002").alias("travelSendTime"),
        _text(_k() % 9).alias("travelTime"),
        _text(_k() % 5).alias("productLevel"),
        F.to_json(F.array(product, neighbour)).alias("targetIDS"),
        F.lit("52").alias("travelSend"),
        F.concat(F.lit("0"), _text(_k() % 3)).alias("productType"),
    ))
    click = F.to_json(F.struct(
        product.alias("targetID"), F.concat(F.lit("T"), _text(_k() % 7)).alias("eventTargetType"),
    ))
    fixed = {
        "userDeviceType": "1", "os": "android", "longitude": "106.6", "latitude": "26.6",
        "manufacturer": "maker", "carrier": "carrier", "networkType": "4g", "hotTarget": "52",
    }
    return events.select(
        _text(number).alias("sid"),
        F.concat(F.lit("d"), _text(F.col("user_id") % 50)).alias("userDevice"),
        _text("user_id").alias("userId"),
        F.concat(F.lit("R"), _text(F.col("user_id") % 5)).alias("userRegion"),
        F.concat(
            F.lit("10.0."), _text(F.col("user_id") % 7), F.lit("."), _text(F.col("user_id") % 11)
        ).alias("userRegionIP"),
        *[F.lit(v).alias(n) for n, v in fixed.items()],
        _text(F.floor("value").cast("int")).alias("duration"),
        F.when(kind == "click", click)
        .when(kind != "purchase", F.to_json(F.struct(product.alias("targetID"))))
        .when(number % 10 == 1, "")
        .otherwise(list_view)
        .alias("exts"),
        F.when(kind == "view", "07").when(kind == "signup", "08").when(kind == "error", "02")
        .otherwise("05").alias("action"),
        F.when(kind == "click", "02")
        .when((kind == "purchase") & (number % 2 == 1), "04")
        .otherwise("01").alias("eventType"),
        _ct().alias("ct"),
        number.alias("seq"),
    )


def products_from(part):
    """Product dimension rows; orders also name products that are not among them."""
    size = F.col("p_size")
    return part.select(
        _text("p_partkey").alias("product_id"),
        (size % 5 + 1).alias("product_level"),
        F.col("p_type").alias("product_type"),
        F.col("p_brand").alias("departure_code"),
        F.concat(F.lit("C"), _text(F.col("p_partkey") % 13)).alias("des_city_code"),
        F.when(size % 2 == 0, "0").otherwise("1").alias("toursim_tickets_type"),
    )


def hotels_from(supplier):
    """Hotel dimension rows; orders also name hotels that are not among them."""
    balance = F.col("s_acctbal")
    return supplier.select(
        _text("s_suppkey").alias("pub_id"),
        F.col("s_name").alias("pub_name"),
        _text(F.col("s_nationkey") % 5 + 1).alias("pub_star"),
        F.when(balance < 0, "C").when(balance < 5000, "B").otherwise("A").alias("pub_grade"),
        F.when(F.col("s_nationkey") < 12, "1").otherwise("0").alias("is_national"),
    )
