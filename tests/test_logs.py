import json

from pyspark.sql import functions as F

from orderflow.operators import logs
from orderflow.schemas import ACTIONS, CLICK, PAGE_VIEW, USER_LOG, VIEW_LIST_FACT

BASE = {f: f for f in USER_LOG.fieldNames() if f not in ("ct", "exts")}


def frame(spark, *messages):
    full = [{**BASE, "ct": 1, "exts": "", **m} for m in messages]
    return logs.decode_logs(spark.createDataFrame([(json.dumps(m),) for m in full], "value string"))


def test_both_spellings(spark):
    message = {k: v for k, v in BASE.items() if k not in ("userId", "longitude")}
    texts = [
        json.dumps({**message, "userID": "u", "lonitude": "l", "ct": "5"}),
        json.dumps({**message, "userId": "u", "longitude": "l", "ct": 5}),
    ]
    rows = logs.decode_logs(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [(r.userId, r.longitude, r.ct) for r in rows.collect()] == [("u", "l", 5)] * 2
    assert rows.schema.simpleString() == USER_LOG.simpleString()


def test_filters(spark):
    rows = frame(
        spark, {"sid": "a", "action": "05", "eventType": "02"}, {"sid": "b", "action": "07", "eventType": "01"},
        {"sid": "c", "action": "08", "eventType": "01"}, {"sid": "d", "action": "05", "eventType": "04"},
        {"sid": "e", "action": "05", "eventType": "01"}, {"sid": "f", "action": "02", "eventType": "03"},
    )
    ids = lambda df: "".join(sorted(r.sid for r in df.collect()))
    assert ids(logs.clicks_only(rows)) == "a"
    assert ids(logs.page_views_only(rows)) == "bc"
    assert ids(logs.list_views_only(rows)) == "de"
    assert ids(logs.launches_only(rows)) == "f"
    assert ids(logs.events_in(rows, logs.INTERACTIVE_EVENTS)) == "abcde"


def test_click_and_view_projection(spark):
    exts = json.dumps({"targetID": "P25", "eventTargetType": "T1"})
    click = logs.click_records(frame(spark, {"action": "05", "eventType": "02", "exts": exts}))
    assert click.first().targetId == "P25" and click.first().eventTargetType == "T1"
    assert click.schema.fieldNames() == CLICK.fieldNames()
    view = logs.page_view_records(frame(spark, {"action": "07", "exts": ""}))
    assert view.first().targetId == "" and view.schema.fieldNames() == PAGE_VIEW.fieldNames()


def test_list_views(spark):
    def exts(**kw):
        return json.dumps({"travelTime": "9", "productType": "01", **kw})

    rows = [
        {"sid": "none", "exts": ""}, {"sid": "missing", "exts": exts()}, {"sid": "empty", "exts": exts(targetIDS="[]")},
        {"sid": "one", "exts": exts(targetIDS='["P1"]')},
        {"sid": "four", "exts": exts(targetIDS='["P40","P46","P28","P62"]')},
    ]
    found = logs.list_view_records(frame(spark, *[{"action": "05", "eventType": "01", **r} for r in rows]))
    assert found.schema.fieldNames() == VIEW_LIST_FACT.fieldNames()
    seen = sorted((r.sid, r.targetId, r.travelTime, r.travelSend) for r in found.collect())
    assert seen == [("four", p, "9", "") for p in ("P28", "P40", "P46", "P62")] + [("one", "P1", "9", "")]


def test_abnormal_duration(spark):
    rows = spark.createDataFrame([("4",), ("5",), ("50",), ("51",), ("",), (None,)], "duration string")
    assert [r[0] for r in rows.select(logs.abnormal_duration()).collect()] == [True, False, False, True, False, False]


def test_quality_gate(spark):
    rows = spark.createDataFrame(
        [("p", "t", 1), (" ", "t", 1), ("p", None, 0)], "productID string, traffic string, ct long"
    )
    good, bad = logs.quality_gate(rows, "order_totals")
    assert good.count() == 1
    assert [r.problems for r in bad.collect()] == [["productID is blank"], ["traffic is blank", "ct is zero"]]


def test_code_table(spark):
    assert logs.code_table(spark, ACTIONS).filter(F.col("code") == "02").first().name == "launch"
