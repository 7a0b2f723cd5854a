"""Result rows as messages: documents with an id, key-value pairs, keyed JSON envelopes, routing."""

from pyspark.sql import functions as F

from orderflow.schemas import MESSAGE_KEYS

# Columns joined with "_" into the document id of each result kind.
DOCUMENT_IDS = {
    "order_stats": ["userRegion", "traffic"],
    "hourly_stats": ["traffic", "etTime"],
    "type_stats": ["productType", "toursimType"],
    "order_wide": ["orderID"],
}


def as_json(columns, longs_as_text=False, schema=None):
    """JSON text of the columns, nulls written out; with `longs_as_text` bigint columns become strings."""
    if longs_as_text:
        columns = [
            F.col(f.name).cast("string").alias(f.name) if f.dataType.simpleString() == "bigint" else F.col(f.name)
            for f in schema.fields if f.name in columns
        ]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def key_values(rows, keys=("userRegion", "traffic"), sep="_", longs_as_text=False):
    """`key` from the key columns and `value` as the row's JSON."""
    return rows.select(
        F.concat_ws(sep, *keys).alias("key"),
        as_json(rows.columns, longs_as_text, rows.schema).alias("value"),
    )


def with_id(rows, kind):
    """Adds the document id of the result kind."""
    return rows.withColumn("id", F.concat_ws("_", *DOCUMENT_IDS[kind]))


def documents(rows, kind, longs_as_text=False):
    """`id` and the row with its id as JSON text."""
    named = with_id(rows, kind)
    return named.select("id", as_json(named.columns, longs_as_text, named.schema).alias("value"))


def subset(rows, wanted):
    """The wanted columns that exist, in the wanted order."""
    return rows.select(*[c for c in wanted if c in rows.columns])


def message_key(kind, sep=""):
    """md5 of the joined key fields of the record kind; a null counts as an empty field."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in MESSAGE_KEYS[kind]]))


def envelope(rows, kind, sep="", longs_as_text=True):
    """Message key and JSON value, ready for a Kafka sink."""
    return rows.select(
        message_key(kind, sep).alias("key"), as_json(rows.columns, longs_as_text, rows.schema).alias("value")
    )


def log_envelope(logs):
    """Raw log messages keep their plain `sid` as key."""
    return logs.select(F.col("sid").alias("key"), as_json(logs.columns, True, logs.schema).alias("value"))


def latest_per_key(rows, key, version):
    """The last row per key by `version`; combined map-side, so hot keys stay small."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, "r.*")


def assign_partition(rows, key, count, value="value"):
    """Adds `partition`: by the key's md5, so any producer can agree on it; rows without a value go
    to the last one."""
    routed = (F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint") % count).cast("int")
    return rows.withColumn("partition", F.when(F.col(value).isNull(), count - 1).otherwise(routed))
