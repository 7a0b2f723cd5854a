"""Record layouts, message keys and code tables shared by every operator.

Field names are part of the public data format (downstream consumers read these
JSON documents), so their spelling is kept exactly, odd spellings included.
"""

from pyspark.sql import types as T

# Order message key -> record field, in message order.
ORDER_KEYS = {
    "order_id": "orderID",
    "userID": "userID",
    "product_id": "productID",
    "product_pub": "pubID",
    "user_mobile": "userMobile",
    "userRegion": "userRegion",
    "product_traffic": "traffic",
    "product_traffic_grade": "trafficGrade",
    "product_traffic_type": "trafficType",
    "product_price": "price",
    "product_fee": "fee",
    "has_activity": "hasActivity",
    "travel_member_adult": "adult",
    "travel_member_yonger": "yonger",
    "travel_member_baby": "baby",
    "order_ct": "ct",
}

# Extra keys of the wide order message.
WIDE_ORDER_KEYS = {
    "productLevel": "productLevel",
    "productType": "productType",
    "toursimType": "toursimType",
    "depCode": "depCode",
    "desCode": "desCode",
}

# Fields that must parse as numbers; everything else stays text.
ORDER_NUMBERS = {"price": "int", "fee": "int", "ct": "bigint"}
WIDE_ORDER_NUMBERS = {**ORDER_NUMBERS, "fee": "bigint", "productLevel": "int"}

# Log message fields, in record order.
LOG_FIELDS = [
    "sid", "userDevice", "userDeviceType", "os", "userId", "userRegion",
    "userRegionIP", "longitude", "latitude", "manufacturer", "carrier",
    "networkType", "duration", "exts", "action", "eventType", "hotTarget", "ct",
]

# Second spellings seen in log messages, with the field each one fills.
LOG_SPELLINGS = {"userID": "userId", "lonitude": "longitude"}

# Keys inside the `exts` JSON text.
EXTS_KEYS = [
    "targetID", "eventTargetType", "targetIDS", "travelSend", "travelSendTime",
    "travelTime", "productLevel", "productType",
]

# Behaviour codes.
ACTIONS = [
    ("01", "install", "安装"),
    ("02", "launch", "加载"),
    ("03", "login", "登录"),
    ("04", "register", "注册"),
    ("05", "interactive", "交互行为"),
    ("06", "exit", "退出"),
    ("07", "page_enter_h5", "页面进入"),
    ("08", "page_enter_native", "页面进入"),
]

# Event codes.
EVENTS = [
    ("01", "view", "浏览"),
    ("02", "click", "点击"),
    ("03", "input", "输入"),
    ("04", "slide", "滑动"),
]

# Dimension columns and the record field each one fills.
PRODUCT_COLUMNS = {
    "product_id": "productID",
    "product_level": "productLevel",
    "product_type": "productType",
    "departure_code": "depCode",
    "des_city_code": "desCode",
    "toursim_tickets_type": "toursimType",
}
HOTEL_COLUMNS = {
    "pub_id": "pubID",
    "pub_star": "pubStar",
    "pub_grade": "pubGrade",
    "is_national": "isNational",
}

# Attributes given to an order whose dimension row is missing.
UNMATCHED_ONE_DIM = {
    "productLevel": -1, "productType": "-1", "toursimType": "-1",
    "depCode": "-1", "desCode": "-1",
}
UNMATCHED_PRODUCT = {
    "productLevel": 0, "productType": "", "toursimType": "", "depCode": "", "desCode": "",
}
UNMATCHED_HOTEL = {"pubStar": "", "pubGrade": "", "isNational": ""}

# Fields hashed into the message key of each record kind.
MESSAGE_KEYS = {
    "order_detail": ["productID", "traffic"],
    "order_traffic_stats": ["productID", "traffic"],
    "order_wide": ["orderID", "productID", "ct"],
    "order_mwide": ["orderID", "productID", "pubID", "ct"],
    "order_type_stats": ["productType", "toursimType"],
    "page_view": ["sid", "userDevice", "targetId"],
    "view_list": ["sid", "userDevice", "userId"],
    "alert": ["userId", "userRegion", "userRegionIp"],
}


def _record(**types):
    return T.StructType([T.StructField(n, getattr(T, t)()) for n, t in types.items()])


def _texts(names):
    return {n: "StringType" for n in names}


def ddl(schema):
    """`name type, ...` text of a record schema."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


_ORDER_TYPES = {**_texts(ORDER_KEYS.values()), "price": "IntegerType", "fee": "IntegerType", "ct": "LongType"}
ORDER_DETAIL = _record(**_ORDER_TYPES)
_WIDE_TYPES = {**_ORDER_TYPES, "fee": "LongType", **_texts(WIDE_ORDER_KEYS.values()), "productLevel": "IntegerType"}
ORDER_WIDE = _record(**_WIDE_TYPES)
ORDER_MWIDE = _record(**_WIDE_TYPES, **_texts(UNMATCHED_HOTEL))
USER_LOG = _record(**{**_texts(LOG_FIELDS), "ct": "LongType"})

_NARROW_LOG = [f for f in LOG_FIELDS if f not in ("exts", "hotTarget", "ct")]
PAGE_VIEW = _record(**_texts(_NARROW_LOG), ct="LongType", targetId="StringType")
CLICK = _record(
    **_texts(f for f in _NARROW_LOG if f != "userRegionIP"),
    ct="LongType", targetId="StringType", eventTargetType="StringType",
)
VIEW_LIST_FACT = _record(
    **_texts(f for f in _NARROW_LOG if f != "userRegionIP"),
    ct="LongType",
    **_texts(["targetId", "hotTarget", "travelSend", "travelSendTime", "travelTime", "productLevel", "productType"]),
)
ALERT = _record(**_texts(["userDevice", "userId", "userRegion", "userRegionIp", "duration"]), ct="LongType")

_WINDOW = {"startWindowTime": "LongType", "endWindowTime": "LongType"}
ORDER_TRAFFIC_STATS = _record(
    productID="StringType", traffic="StringType", **_WINDOW, orders="LongType", totalFee="LongType",
)
