import json

import pytest

from orderflow.operators import orders, lookup
from orderflow.schemas import ORDER_DETAIL, ORDER_KEYS, ORDER_WIDE, UNMATCHED_ONE_DIM
from orderflow.sources import dimensions
from orderflow.sources.messages import decode

FULL = {
    **{k: f"v-{k}" for k in ORDER_KEYS},
    "product_price": "100", "product_fee": "90", "travel_member_adult": "2",
    "travel_member_yonger": "1", "travel_member_baby": "", "order_ct": "1577808000000",
}


def lines(spark, *messages):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def without(key):
    return {k: v for k, v in FULL.items() if k != key}


def test_full_message(spark):
    row = orders.parse_orders(lines(spark, FULL)).first()
    assert (row.orderID, row.fee, row.price, row.ct) == ("v-order_id", 90, 100, 1577808000000)
    assert orders.parse_orders(lines(spark, FULL)).schema.simpleString() == ORDER_DETAIL.simpleString()


def test_missing_and_null_text_become_blank(spark):
    rows = orders.parse_orders(lines(spark, without("user_mobile"), {**FULL, "user_mobile": None})).collect()
    assert [r.userMobile for r in rows] == ["", ""]


def test_numbers_may_be_json_numbers_and_extra_keys_are_ignored(spark):
    row = orders.parse_orders(lines(spark, {**FULL, "product_fee": 7, "order_ct": 5, "other": {"a": 1}})).first()
    assert (row.fee, row.ct) == (7, 5)


def test_rejects(spark):
    bad = lines(
        spark, {**FULL, "product_fee": ""}, {**FULL, "order_ct": "soon"}, without("order_ct"), "{broken", FULL,
    )
    assert orders.parse_orders(bad).count() == 1
    faults = [r.badFields for r in orders.reject_orders(bad).collect()]
    assert faults == [["fee"], ["ct"], ["ct"], ["price", "fee", "ct"]]


def test_members(spark):
    rows = spark.createDataFrame([("2", "1", ""), ("x", None, "3")], "adult string, yonger string, baby string")
    assert [r[0] for r in rows.select(orders.members()).collect()] == [3, 3]


def test_decode_round_trip(spark):
    parsed = orders.parse_orders(lines(spark, FULL))
    from orderflow.operators.messages import envelope

    back = decode(envelope(parsed, "order_detail"), ORDER_DETAIL)
    assert back.collect() == parsed.collect()


DIM = "product_id string, product_level int, product_type string, departure_code string, des_city_code string, toursim_tickets_type string"


def dims(spark):
    return dimensions.product_dimension(spark.createDataFrame(
        [("1", 1, "a", "d1", "c1", "0"), ("1", 2, "b", "d2", "c2", "1"), ("2", 3, None, "d", "c", "0")], DIM
    ))


def facts(spark):
    return spark.createDataFrame([(i, str(i % 4)) for i in range(40)], "n int, productID string")


def test_lookup_is_one_to_one_and_fills_unmatched(spark):
    wide = lookup.widen_orders(facts(spark), dims(spark))
    assert wide.count() == 40
    by_id = {r.productID: r for r in wide.collect()}
    assert by_id["1"].productLevel == 2 and by_id["1"].depCode == "d2"
    assert by_id["2"].productType is None
    assert by_id["3"].productLevel == -1 and by_id["3"].desCode == "-1"
    assert set(wide.columns) == {"n", "productID", *UNMATCHED_ONE_DIM}


def test_version_decides_the_last_row(spark):
    rows = spark.createDataFrame([("1", "new", 9), ("1", "old", 1)], "k string, v string, t int")
    assert dimensions.last_per_key(rows, "k", "t").first().v == "new"


def test_big_dimension_gives_the_same_rows_without_broadcast(spark):
    small = lookup.widen_orders(facts(spark), dims(spark))
    big = lookup.widen_orders(facts(spark), dims(spark), broadcast_rows=1)
    assert sorted(map(str, small.collect())) == sorted(map(str, big.collect()))
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_snapshot(spark):
    rows = dimensions.keyed_snapshot(dims(spark), "productID").collect()
    assert {r.key: json.loads(r.value)["depCode"] for r in rows} == {"1": "d2", "2": "d"}


def test_refreshing_dim():
    now, reads = [0.0], []
    dim = dimensions.RefreshingDim(lambda: reads.append(1) or len(reads), ttl=60, clock=lambda: now[0])
    assert (dim.get(), dim.get()) == (1, 1)
    now[0] = 60.0
    assert dim.get() == 2


def test_wide_parse_reads_has_activity(spark):
    wide = {**FULL, "productLevel": "3", "productType": "t", "toursimType": "0", "depCode": "d", "desCode": "c"}
    row = orders.parse_wide_orders(lines(spark, wide)).first()
    assert row.hasActivity == "v-has_activity" and row.productLevel == 3
    assert orders.parse_wide_orders(lines(spark, wide)).schema.simpleString() == ORDER_WIDE.simpleString()


def product_types(frame):
    return {r.productID: r.productType for r in frame.collect()}


def test_batches_are_bound_to_snapshots(spark, tmp_path):
    def rows(text):
        return spark.createDataFrame([("1", text)], "productID string, productType string")

    log = dimensions.SnapshotLog(str(tmp_path / "dim"), "run")
    with pytest.raises(ValueError):
        log.bound(spark, 0)
    assert log.save(rows("old")) == 0
    assert product_types(log.bound(spark, 0)) == {"1": "old"}
    assert log.save(rows("new")) == 1
    again = dimensions.SnapshotLog(str(tmp_path / "dim"), "run")
    assert product_types(again.bound(spark, 0)) == {"1": "old"}
    assert product_types(again.bound(spark, 1)) == {"1": "new"}
    other = dimensions.SnapshotLog(str(tmp_path / "dim"), "other")
    assert product_types(other.bound(spark, 0)) == {"1": "new"}
    # a snapshot that was not finished is not seen, and its number is used again
    rows("broken").write.parquet(str(tmp_path / "dim" / "snapshots" / "2"))
    assert product_types(again.bound(spark, 2)) == {"1": "new"}
    assert log.save(rows("newer")) == 2
    assert product_types(again.bound(spark, 3)) == {"1": "newer"} and product_types(again.bound(spark, 2)) == {"1": "new"}
    log.forget(spark, 1)
    assert not (tmp_path / "dim" / "snapshots" / "0").exists() and product_types(again.bound(spark, 1)) == {"1": "new"}


def test_unknown_keys_take_the_defaults_of_each_join(spark):
    orders_two = spark.createDataFrame([("o1", "1", "h1"), ("o2", "9", "h1"), ("o3", "1", "h9"), ("o4", None, None)],
                                       "orderID string, productID string, pubID string")
    hotels = spark.createDataFrame([("h1", "5", "A", "1")], "pubID string, pubStar string, pubGrade string, isNational string")
    for limit in (0, 100):
        one = {r.orderID: (r.productLevel, r.depCode) for r in lookup.widen_orders(orders_two, dims(spark), broadcast_rows=limit).collect()}
        assert one == {"o1": (2, "d2"), "o2": (-1, "-1"), "o3": (2, "d2"), "o4": (-1, "-1")}
        two = lookup.widen_orders_two(orders_two, dims(spark), hotels, broadcast_rows=limit).collect()
        assert {r.orderID: (r.productLevel, r.depCode, r.pubStar) for r in two} == {
            "o1": (2, "d2", "5"), "o2": (0, "", "5"), "o3": (2, "d2", ""), "o4": (0, "", "")}


def test_lookup_in_folders_by_key(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id AS string) AS productID", "concat('t', id) AS productType", "cast(id AS int) AS productLevel")
    again = spark.createDataFrame([("5", "t0", -1), (None, "x", 0)], "productID string, productType string, productLevel int")
    dim = dimensions.HashedDim.stored(rows.unionByName(again), str(tmp_path / "dim"), "productID", 32, version="productLevel")
    facts = spark.createDataFrame([(i, str(5 if i % 3 else 7) if i % 10 else None) for i in range(300)] + [(999, "no")], "n int, productID string")
    defaults = {"productType": "-1", "productLevel": -1}
    want = sorted((r.n, r.productID, f"t{r.productID}" if r.productID in ("5", "7") else "-1",
                   int(r.productID) if r.productID in ("5", "7") else -1) for r in facts.collect() if r.productID)
    for most in (0, 100):
        got = dim.lookup(facts, defaults, most_keys=most)
        assert sorted(tuple(r) for r in got.collect() if r.productID) == want
        assert {tuple(r)[2:] for r in got.collect() if not r.productID} == {("-1", -1)} and got.count() == facts.count()
    plan = dim.lookup(facts, defaults)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "hashpartitioning(productID" not in text.split("BroadcastExchange")[0]
    # two known keys and one unknown
    assert dim.read(facts.select("productID")).select("_metadata.file_path").distinct().count() <= 3
    assert dim.lookup(facts.limit(0), defaults).collect() == []
