import hashlib
import json

from pyspark.sql import functions as F

from orderflow.operators import messages


def rows(spark):
    return spark.createDataFrame([("1", "23", None, 2**40), ("12", "3", "x", 5)], "productID string, traffic string, note string, ct long")


def test_key_is_md5_of_joined_fields(spark):
    keys = {r.key for r in messages.envelope(rows(spark), "order_detail").collect()}
    assert keys == {hashlib.md5(b"123").hexdigest()}
    apart = {r.key for r in messages.envelope(rows(spark), "order_detail", sep="|").collect()}
    assert len(apart) == 2


def test_value_writes_nulls_and_longs_as_text(spark):
    value = json.loads(messages.envelope(rows(spark), "order_detail").orderBy("value").first().value)
    assert value == {"productID": "1", "traffic": "23", "note": None, "ct": str(2**40)}
    plain = json.loads(messages.envelope(rows(spark), "order_detail", longs_as_text=False).orderBy("value").first().value)
    assert plain["ct"] == 2**40


def test_documents(spark):
    stats = spark.createDataFrame([("R1", "car", 3)], "userRegion string, traffic string, orders long")
    document = messages.documents(stats, "order_stats").first()
    assert document.id == "R1_car" and json.loads(document.value) == {"userRegion": "R1", "traffic": "car", "orders": 3, "id": "R1_car"}
    pair = messages.key_values(stats).first()
    assert pair.key == "R1_car" and json.loads(pair.value)["orders"] == 3


def test_subset(spark):
    assert messages.subset(rows(spark), ["ct", "nothing", "traffic"]).columns == ["ct", "traffic"]


def test_latest_per_key(spark):
    got = messages.latest_per_key(rows(spark).withColumn("k", F.lit("k")), "k", "ct").first()
    assert got.ct == 2**40


def test_partition(spark):
    df = rows(spark).select("productID", F.when(F.col("note").isNotNull(), "v").alias("value"))
    routed = {r.productID: r.partition for r in messages.assign_partition(df, "productID", 8).collect()}
    assert routed["1"] == 7 and routed["12"] == int(hashlib.md5(b"12").hexdigest()[:8], 16) % 8
