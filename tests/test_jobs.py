"""The jobs as streams over text files."""

import json

import pytest
from pyspark.sql import functions as F

from orderflow.operators import logs, windows
from orderflow.operators.orders import parse_orders, with_event_time, with_hour
from orderflow.plans import base, jobs
from orderflow.plans.job_queries import _lines
from orderflow.sources.messages import file_lines
from orderflow.streaming import sinks
from orderflow.streaming.carry import results_of

FOLDER = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}
HOUR = 3_600_000


@pytest.fixture(scope="module")
def order_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders") / "lines")
    _lines(spark, FOLDER).select("value").coalesce(1).write.text(path)
    return path


@pytest.fixture(scope="module")
def log_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("logs") / "lines")
    base.log_lines(spark, FOLDER).coalesce(1).write.text(path)
    return path


def same(a, b):
    assert sorted(map(str, a)) == sorted(map(str, b))


def appended(spark, rows, tmp_path):
    sinks.to_files(rows, str(tmp_path / "out"), str(tmp_path / "log"), trigger=ONCE).awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("job", ["order_detail", "order_wide", "order_mwide", "landing"])
def test_order_jobs(spark, tmp_path, order_files, job):
    dims = [base.products(spark, FOLDER), base.hotels(spark, FOLDER)]
    run = {
        "order_detail": lambda x: jobs.order_detail(x), "order_wide": lambda x: jobs.order_wide(x, dims[0]),
        "order_mwide": lambda x: jobs.order_mwide(x, *dims), "landing": lambda x: jobs.landing_rows(x).drop("bucket"),
    }[job]
    got = appended(spark, run(file_lines(spark, order_files)), tmp_path)
    same(got.collect(), run(file_lines(spark, order_files, streaming=False)).collect())


@pytest.mark.parametrize("job", [jobs.page_view_messages, jobs.product_views])
def test_log_jobs(spark, tmp_path, log_files, job):
    got = appended(spark, job(file_lines(spark, log_files)), tmp_path)
    same(got.collect(), job(file_lines(spark, log_files, streaming=False)).collect())


@pytest.mark.parametrize("job", [jobs.clicks, jobs.page_views])
def test_upsert_jobs(spark, tmp_path, log_files, job):
    query, table = sinks.to_keyed_table(
        job(file_lines(spark, log_files)), str(tmp_path / "t"), "sid", str(tmp_path / "log"), "ct", trigger=ONCE
    )
    query.awaitTermination()
    want = job(file_lines(spark, log_files, streaming=False))
    same(table.read(spark).select(*want.columns).collect(), want.collect())


def test_windowed_jobs(spark, tmp_path, order_files):
    batch = jobs.region_stats_pairs(file_lines(spark, order_files, streaming=False), "1 hour")
    got = appended(spark, jobs.region_stats_pairs(file_lines(spark, order_files), "1 hour"), tmp_path)
    assert got.count() > 0 and got.exceptAll(batch).count() == 0
    assert batch.exceptAll(got).count() <= 1


def test_processing_time_windows(spark, tmp_path, order_files):
    rows = jobs.type_stats(file_lines(spark, order_files), base.products(spark, FOLDER), "10 seconds", by_clock=True)
    query = rows.writeStream.format("memory").queryName("by_clock").outputMode("update").option(
        "checkpointLocation", str(tmp_path / "log")).trigger(**ONCE).start()
    query.awaitTermination()
    orders = spark.table("by_clock").agg(F.sum(F.get_json_object("value", "$.orders").cast("long"))).first()[0]
    assert orders == 1000


def test_time_triggered_statistics_in_update_mode(spark, tmp_path, order_files):
    rows = jobs.hourly_stats_by_day(file_lines(spark, order_files), approx=True)
    query, table = sinks.to_keyed_table(
        rows, str(tmp_path / "t"), "id", str(tmp_path / "log"), "version", mode="update", trigger=ONCE
    )
    query.awaitTermination()
    docs = [json.loads(r.value) for r in table.read(spark).collect()]
    assert sum(int(d["orders"]) for d in docs) == 1000 and all(d["ptTime"] for d in docs)


@pytest.mark.parametrize("job", ["count", "count-or-time", "top", "alerts"])
def test_carried_jobs(spark, tmp_path, order_files, log_files, job):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    dims = base.products(spark, FOLDER)
    orders, order_rows = file_lines(spark, order_files), file_lines(spark, order_files, streaming=False)
    if job == "count":
        query = jobs.count_triggered_stats_stream(orders, out, log, 2, 24 * HOUR, trigger=ONCE)
        want = jobs.count_triggered_stats(order_rows, 2, 24 * HOUR).drop("id")
    elif job == "count-or-time":
        query = jobs.count_or_time_stats_stream(orders, dims, out, log, 5, 24 * HOUR, trigger=ONCE)
        want = jobs.count_or_time_stats(order_rows, dims, 5, 24 * HOUR).drop("id")
    elif job == "top":
        query = jobs.top_products_stream(orders, out, log, 3, "1 hour", 6 * HOUR, (), trigger=ONCE)
        want = None
    else:
        query = jobs.behaviour_alerts_stream(file_lines(spark, log_files), out, log, within_ms=12 * HOUR, trigger=ONCE)
        views = logs.page_views_only(logs.decode_logs(file_lines(spark, log_files, streaming=False)))
        from orderflow.operators.patterns import duration_matches

        want = duration_matches(views, within_ms=12 * HOUR, order=("sid",))
    query.awaitTermination()
    got = results_of(spark, out, log)
    assert got.count() > 0
    if want is not None:
        if job == "count":
            got = got.drop("hourTime")
        want = want.select(*[c for c in got.columns if c in want.columns])
        got = got.select(*want.columns)
        # what is still open at the end of the stream is not in it
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() <= 0.05 * want.count() + 15


def test_renewed_statistics(spark, tmp_path, order_files):
    query = jobs.hourly_stats_renewed_stream(file_lines(spark, order_files), str(tmp_path / "o"), str(tmp_path / "log"), trigger=ONCE)
    query.awaitTermination()
    got = results_of(spark, str(tmp_path / "o"), str(tmp_path / "log"))
    want = windows.hourly_day_stats(with_hour(with_event_time(parse_orders(file_lines(spark, order_files, streaming=False)))))
    columns = ["traffic", "startWindowTime", "endWindowTime", "orders", "users", "totalFee"]
    same(got.select(*columns).collect(), want.select(*columns).collect())


def test_corrected_statistics(spark, tmp_path, order_files):
    query = jobs.region_stats_corrected_stream(
        file_lines(spark, order_files), str(tmp_path / "o"), str(tmp_path / "log"), size_ms=HOUR, trigger=ONCE)
    query.awaitTermination()
    got = results_of(spark, str(tmp_path / "o"), str(tmp_path / "log"))
    want = windows.region_traffic_stats(with_event_time(parse_orders(file_lines(spark, order_files, streaming=False))), "1 hour")
    last = want.agg(F.max("endWindowTime")).first()[0]
    same(got.drop("revision").collect(), want.filter(F.col("endWindowTime") < last).select(*got.drop("revision").columns).collect())


def test_remote_logins(spark, log_files):
    found = jobs.remote_login_alerts(file_lines(spark, log_files, streaming=False), most=0, within_ms=HOUR)
    assert found.count() == logs.launches_only(logs.decode_logs(file_lines(spark, log_files, streaming=False))).count()


def test_batches_closed_by_the_clock(spark, tmp_path, order_files):
    import time

    query = jobs.count_or_clock_stats_stream(
        file_lines(spark, order_files), base.products(spark, FOLDER), str(tmp_path / "o"), str(tmp_path / "log"),
        interval_ms=2_000, trigger={"processingTime": "500 milliseconds"})
    wanted, deadline, got = file_lines(spark, order_files, streaming=False).count(), time.time() + 120, []
    while sum(r.orders for r in got) < wanted and time.time() < deadline and not query.exception():
        time.sleep(1)
        got = spark.read.parquet(str(tmp_path / "o")).collect() if any(p["numInputRows"] for p in query.recentProgress) else []
    query.stop()
    assert query.exception() is None and sum(r.orders for r in got) == wanted
    assert all(r.id == f"{r.productType}_{r.toursimType}" and r.orders <= jobs.BATCH_COUNT for r in got)
