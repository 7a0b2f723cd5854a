"""Streams fed one file per micro-batch, against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import counted, patterns, ranking, windows
from orderflow.operators.orders import with_event_time, with_hour
from orderflow.streaming import landing
from orderflow.streaming.carry import Carry
from orderflow.streaming.keyed_table import KeyedTable
from orderflow.streaming.steps import CountOrTime, CountTriggered, RepeatMatches, TopN

SCHEMA = (
    "traffic string, userID string, fee int, ct long, seq long, userRegion string, productID string, "
    "adult string, yonger string, baby string"
)
ONCE = {"availableNow": True}


def make(n, seed=1, span=100_000):
    rnd = random.Random(seed)
    times = sorted(rnd.sample(range(span), n))
    return [(rnd.choice("aab"), f"u{rnd.randint(0, 9)}", rnd.randint(0, 60), ct, i, f"R{i % 2}", f"P{i % 4}", "1", "0", "")
            for i, ct in enumerate(times)]


class Feed:
    """Writes row lists as one file each, in order, and streams them one file per batch."""

    def __init__(self, spark, tmp_path, parts):
        self.spark, self.path, self.n = spark, tmp_path / "in", 0
        self.out = str(tmp_path / "out")
        self.log = str(tmp_path / "log")
        self.path.mkdir()
        for part in parts:
            self.add(part)

    def add(self, part):
        import os

        target = self.path / f"{self.n:04d}.parquet"
        self.spark.createDataFrame(part, SCHEMA).toPandas().to_parquet(target)
        os.utime(target, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1

    def stream(self, late="0 seconds"):
        rows = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.path))
        return with_event_time(rows, late=late)

    def append(self, rows, mode="append"):
        q = (rows.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.log)
             .outputMode(mode).trigger(**ONCE).start())
        q.awaitTermination()
        return self.spark.read.schema(rows.schema).parquet(self.out).collect()

    def carry(self, step, stream, ct="ct"):
        carry = Carry(step, self.out, step.carried_schema(stream), ct)
        carry.start(stream, self.log, ONCE).awaitTermination()
        return carry.results(self.spark)


def thirds(rows, n=3):
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def same(a, b):
    assert sorted(map(str, a)) == sorted(map(str, b))


def batch(spark, rows):
    return with_event_time(spark.createDataFrame(rows, SCHEMA))


CLOSER = ("zz", "u", 0, 10_000_000, 10**6, "R0", "P0", "1", "0", "")


@pytest.fixture
def rows():
    return make(240)


def test_tumbling_equals_batch(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, [*thirds(rows), [CLOSER]])
    got = [r for r in feed.append(windows.region_traffic_stats(feed.stream())) if r.traffic != "zz"]
    same(got, windows.region_traffic_stats(batch(spark, rows)).collect())


def test_distinct_users_equal_batch(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, [*thirds(rows), [(*CLOSER[:3], 10**9, *CLOSER[4:])]])
    got = [r for r in feed.append(windows.hourly_day_stats(with_hour(feed.stream()))) if r.traffic != "zz"]
    same(got, windows.hourly_day_stats(with_hour(batch(spark, rows))).collect())


def test_sessions_equal_batch(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, [*thirds(rows), [CLOSER]])
    got = [r for r in feed.append(windows.session_stats(feed.stream(), ["traffic"], "1 second")) if r.traffic != "zz"]
    same(got, windows.session_stats_batch(batch(spark, rows), ["traffic"], 1_000).collect())


def test_lateness(spark, tmp_path):
    def row(ct, seq):
        return ("a", "u", 1, ct, seq, "R", "P", "1", "0", "")

    parts = [[row(1_000, 0), row(15_000, 1)], [row(2_000, 2), row(31_000, 3)], [row(32_000, 4)], [row(3_000, 5)], [CLOSER]]
    feed = Feed(spark, tmp_path, parts)
    got = {r.startWindowTime: r.orders for r in feed.append(windows.region_traffic_stats(feed.stream(windows.WATERMARK)))}
    # 2 s comes inside the lateness of its window; when 3 s comes, the window has been given out
    assert got[0] == 2


def test_update_mode_refines(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, thirds(rows))
    table = KeyedTable(feed.out, "userRegion", "orders")
    totals = windows.running_totals(feed.stream().drop("ts"), "userRegion")
    q = totals.writeStream.foreachBatch(table.sink(feed.log)).outputMode("update").option("checkpointLocation", feed.log)
    q.trigger(**ONCE).start().awaitTermination()
    same(table.read(spark).collect(), windows.running_totals(batch(spark, rows), "userRegion").collect())


def test_count_window(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, thirds(rows, 4))
    step = CountOrTime(["traffic"], windows.order_measures(), 10, columns=["fee", "adult", "yonger", "baby"])
    got = feed.carry(step, feed.stream()).drop("startWindowTime")
    want = counted.count_window_stats(batch(spark, rows), ["traffic"], 10).select(*got.columns)
    same(got.collect(), want.collect())


def test_count_or_time(spark, tmp_path, rows):
    measures = [F.count(F.lit(1)).alias("orders"), F.count_distinct("userID").alias("users"),
                F.sum(F.col("fee").cast("bigint")).alias("totalFee")]
    feed = Feed(spark, tmp_path, [*thirds(rows, 4), [CLOSER]])
    step = CountOrTime(["traffic"], measures, 10, 20_000, columns=["userID", "fee"])
    got = feed.carry(step, feed.stream())
    want = counted.count_or_time_stats(batch(spark, rows), ["traffic"], 10, 20_000).select(*got.columns)
    same(got.collect(), want.collect())


@pytest.mark.parametrize("size", [1, 7])
def test_count_trigger(spark, tmp_path, rows, size):
    feed = Feed(spark, tmp_path, thirds(rows, 4))
    step = CountTriggered(["traffic"], size, 50_000, delay_ms=3_600_000)
    got = feed.carry(step, step.with_first_sights(feed.stream("1 hour")))
    want = counted.count_triggered_stats(batch(spark, rows), ["traffic"], size, 50_000).select(*got.columns)
    same(got.collect(), want.collect())


@pytest.mark.parametrize("within", [(), ("productID", "traffic")])
def test_top_n(spark, tmp_path, rows, within):
    feed = Feed(spark, tmp_path, [*thirds(rows, 4), [CLOSER], [(*CLOSER[:3], 10**8, *CLOSER[4:])]])
    stats = windows.product_traffic_stats(feed.stream(), "2 seconds")
    got = feed.carry(TopN(period_ms=10_000, rank_within=within), stats, "endWindowTime")
    got = got.filter("rankWindowTime < 1000000")
    want = ranking.top_n(windows.product_traffic_stats(batch(spark, rows), "2 seconds"), 3, 10_000, within)
    same(got.collect(), want.select(*got.columns).collect())


@pytest.mark.parametrize("keys", [[], ["userID"]])
def test_pattern(spark, tmp_path, rows, keys):
    hit = F.col("fee") > 15
    feed = Feed(spark, tmp_path, [*thirds(rows, 4), [CLOSER]])
    step = RepeatMatches(hit, 3, 4_000, keys, columns=["userID", "fee", "ct", "seq"])
    got = feed.carry(step, feed.stream()).select("seq", "matches").collect()
    want = patterns.repeat_matches(batch(spark, rows), hit, 3, 4_000, keys).select("seq", "matches").collect()
    assert want
    same(got, want)


def test_restart_goes_on(spark, tmp_path, rows):
    """Files that arrive later are picked up by a new query over the same checkpoint."""
    first, *rest = thirds(rows, 4)
    feed = Feed(spark, tmp_path, [first])
    step = CountOrTime(["traffic"], windows.order_measures(), 10, columns=["fee", "adult", "yonger", "baby"])
    feed.carry(step, feed.stream())
    for part in rest:
        feed.add(part)
    got = feed.carry(step, feed.stream()).drop("startWindowTime")
    want = counted.count_window_stats(batch(spark, rows), ["traffic"], 10).select(*got.columns)
    same(got.collect(), want.collect())


def test_replayed_batch_changes_nothing(spark, tmp_path, rows):
    step = CountOrTime(["traffic"], windows.order_measures(), 10, columns=["fee", "adult", "yonger", "baby"])
    parts = [batch(spark, p) for p in thirds(rows)]
    carry = Carry(step, str(tmp_path / "o"), step.carried_schema(parts[0]))
    for i in (0, 1, 1, 2, 2):
        carry(parts[i], i)
    got = carry.results(spark).drop("startWindowTime")
    want = counted.count_window_stats(batch(spark, rows), ["traffic"], 10).select(*got.columns)
    same(got.collect(), want.collect())


def test_keyed_table(spark, tmp_path):
    def docs(*rows):
        return spark.createDataFrame(list(rows), "id string, a int, b int, v int")

    table = KeyedTable(str(tmp_path / "t"), "id", "v")
    first = docs(("x", 1, 1, 1), ("x", 2, None, 2), ("y", 5, 5, 1), (None, 0, 0, 0))
    for _ in range(2):
        table.write(first, 0)
    assert {r.id: (r.a, r.b) for r in table.read(spark).collect()} == {"x": (2, None), "y": (5, 5)}
    table.write(docs(("y", 6, None, 2)), 1)
    assert {r.id: (r.a, r.b) for r in table.read(spark).collect()} == {"x": (2, None), "y": (6, None)}
    assert {r.id: (r.a, r.b) for r in table.read(spark, merge=True).collect()}["y"] == (6, 5)
    packed = table.compact_to(spark, str(tmp_path / "t2"))
    packed.write(docs(("x", 9, 9, 3)), 0)
    assert {r.id: r.a for r in packed.read(spark).collect()} == {"x": 9, "y": 6}


def test_landing(spark, tmp_path):
    h = 3_600_000
    rows = [("a", "u", 1, ct, i, "R", "P", "1", "0", "") for i, ct in enumerate([h - 1, h, h + 5, 5 * h])]
    df = landing.with_bucket(batch(spark, rows), "ts").drop("ts")
    landing.land(df, str(tmp_path / "raw"))
    landing.compact(spark, str(tmp_path / "raw"), str(tmp_path / "packed"), buckets=["1970010100", "1970010101"])
    got = spark.read.parquet(str(tmp_path / "packed")).groupBy("bucket").count().collect()
    assert {str(r["bucket"]): r["count"] for r in got} == {"1970010100": 1, "1970010101": 2}


def test_runs_are_kept_apart(spark, tmp_path):
    """A query with another checkpoint over the same folder takes nothing away."""

    def docs(*rows):
        return spark.createDataFrame(list(rows), "id string, a int, v int")

    table = KeyedTable(str(tmp_path / "t"), "id", "v")
    table.sink("/log/one")(docs(("x", 1, 1), ("y", 1, 1)), 0)
    table.sink("/log/two")(docs(("x", 2, 2)), 0)
    assert {r.id: r.a for r in table.read(spark).collect()} == {"x": 2, "y": 1}
    table.sink("/log/two")(docs(("y", 0, 0)), 5)
    assert {r.id: r.a for r in table.read(spark).collect()} == {"x": 2, "y": 1}
    with pytest.raises(ValueError):
        KeyedTable(str(tmp_path / "t"), "id", [])


def test_newest_row_of_a_key_by_version(spark, tmp_path):
    rows = spark.createDataFrame([("s", "zz", 1), ("s", "aa", 2)], "sid string, userDevice string, ct int")
    table = KeyedTable(str(tmp_path / "t"), "sid", "ct")
    table.write(rows, 0)
    assert table.read(spark).first()["userDevice"] == "aa"


def test_compaction_keeps_other_hours(spark, tmp_path):
    h = 3_600_000
    rows = [("a", "u", 1, ct, i, "R", "P", "1", "0", "") for i, ct in enumerate([h - 1, h, 5 * h])]
    landing.land(landing.with_bucket(batch(spark, rows), "ts").drop("ts"), str(tmp_path / "raw"))
    for hour in ("1970010100", "1970010101", "1970010105", "1970010101"):
        landing.compact(spark, str(tmp_path / "raw"), str(tmp_path / "packed"), buckets=[hour])
    got = spark.read.parquet(str(tmp_path / "packed"))
    assert sorted(r.seq for r in got.collect()) == [0, 1, 2]


def test_late_rows_do_not_count_again(spark, tmp_path):
    def row(user, ct, seq):
        return ("a", user, 1, ct, seq, "R", "P", "1", "0", "")

    step = CountTriggered(["traffic"], 2, 10_000, delay_ms=1_000)
    parts = [[row("u", 1_000, 0), row("v", 2_000, 1)], [row("u", 30_000, 2)], [row("w", 3_000, 3), row("x", 3_500, 4)]]
    feed = Feed(spark, tmp_path, parts)
    got = feed.carry(step, step.with_first_sights(feed.stream("1 second"))).collect()
    assert [(r.startWindowTime, r.orders, r.users) for r in got] == [(0, 2, 2)]


def test_drain_closes_what_is_open(spark, tmp_path, rows):
    measures = [F.count(F.lit(1)).alias("orders")]
    feed = Feed(spark, tmp_path, thirds(rows, 4))
    stream = feed.stream()
    step = CountOrTime(["traffic"], measures, 10, 20_000)
    carry = Carry(step, feed.out, step.carried_schema(stream))
    carry.start(stream, feed.log, ONCE).awaitTermination()
    carry.drain(spark)
    got = carry.results(spark)
    want = counted.count_or_time_stats(batch(spark, rows), ["traffic"], 10, 20_000).select(*got.columns)
    same(got.collect(), want.collect())


def test_new_start_with_the_same_checkpoint_path(spark, tmp_path, rows):
    """What a run has left is not mixed with that of another one started anew at its place."""
    import shutil

    feed = Feed(spark, tmp_path, thirds(rows, 2))
    step = CountOrTime(["traffic"], windows.order_measures(), 10, columns=["fee", "adult", "yonger", "baby"])
    feed.carry(step, feed.stream())
    shutil.rmtree(feed.log)
    again = Feed.__new__(Feed)
    again.spark, again.path, again.n, again.out, again.log = spark, tmp_path / "more", 0, feed.out, feed.log
    again.path.mkdir()
    again.add(rows[:60])
    got = again.carry(step, again.stream()).drop("startWindowTime")
    want = counted.count_window_stats(batch(spark, rows[:60]), ["traffic"], 10).select(*got.columns)
    same(got.collect(), want.collect())


def test_new_start_of_a_keyed_table(spark, tmp_path):
    def docs(*rows):
        return spark.createDataFrame(list(rows), "id string, a int, v int")

    table = KeyedTable(str(tmp_path / "t"), "id", "v")
    sink, other = table.sink("/log/one"), table.sink("/log/two")
    sink(docs(("x", 1, 9), ("y", 1, 9)), 0)
    sink(docs(("x", 2, 10)), 1)
    other(docs(("z", 3, 1)), 0)
    sink(docs(("x", 5, 1)), 0)
    assert {r.id: r.a for r in table.read(spark).collect()} == {"x": 5, "z": 3}


def test_fields_keep_their_own_versions(spark, tmp_path):
    def docs(*rows):
        return spark.createDataFrame(list(rows), "id string, a int, b int, v int")

    table = KeyedTable(str(tmp_path / "t"), "id", "v")
    table.write(docs(("x", 1, None, 5), ("x", None, 2, 6)), 0, merge=True)
    # a row that comes late sets a at 3, in a batch whose newest row is of 9
    late = docs(("x", 7, None, 3), ("x", None, 8, 9))
    for _ in range(2):
        table.write(late, 1, merge=True)
    assert [tuple(r) for r in table.read(spark, merge=True).collect()] == [("x", 1, 8, 9)]
    packed = table.compact_to(spark, str(tmp_path / "t2"), merge=True)
    packed.write(docs(("x", 4, 4, 4)), 0, merge=True)
    assert [tuple(r) for r in packed.read(spark, merge=True).collect()] == [("x", 1, 8, 9)]


def test_sliding_panes_on_a_stream(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, [*thirds(rows), [CLOSER], [(*CLOSER[:3], 10**8, *CLOSER[4:])]])
    sizes = ("20 seconds", "5 seconds", "5 seconds")
    got = [r for r in feed.append(windows.sliding_stats(feed.stream(), ["traffic"], *sizes)) if r.traffic != "zz"]
    want = windows.order_window_stats(batch(spark, rows), ["traffic"], "20 seconds", "5 seconds")
    same(got, want.collect())
    same(windows.sliding_stats(batch(spark, rows), ["traffic"], "20 seconds", "10 seconds", "2 seconds").collect(),
         windows.order_window_stats(batch(spark, rows), ["traffic"], "20 seconds", "10 seconds").collect())


def test_files_filled_to_a_size(spark, tmp_path):
    rng = random.Random(4)
    rows = [("2024010100" if i % 5 else "2024010101", "x" * rng.randrange(0, 60) + str(i), i) for i in range(2000)]
    rows += [("2024010102", None, 5000), ("2024010102", "é" * 30, 5001)]
    lines = spark.createDataFrame(rows, "bucket string, value string, seq int").repartition(4)
    landing.land_packed(lines, str(tmp_path / "out"), 1000, order=["seq"])
    landing.land_packed(lines.filter("bucket = '2024010101'"), str(tmp_path / "out"), 1000, order=["seq"])
    got = spark.read.schema("value string, bucket string, file int").text(str(tmp_path / "out"))
    same([tuple(r) for r in got.select("bucket", "value").collect()], [(b, v or "") for b, v, _ in rows])
    sizes = got.groupBy("bucket", "file", "_metadata.file_size", "_metadata.file_path").count().collect()
    assert len(sizes) == len({(r["bucket"], r["file"]) for r in sizes})
    last = {}
    for r in sizes:
        last[r["bucket"]] = max(last.get(r["bucket"], 0), r["file"])
    assert last["2024010100"] > 20
    assert all(900 <= r["file_size"] <= 1100 for r in sizes if r["file"] < last[r["bucket"]])
    landing.compact_packed(spark, str(tmp_path / "out"), str(tmp_path / "more"), 10_000)
    again = spark.read.schema("value string, bucket string, file int").text(str(tmp_path / "more"))
    same(again.select("bucket", "value").collect(), got.select("bucket", "value").collect())


def test_an_hour_written_again_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"202401010{i % 2}", f"line {i}", i) for i in range(400)]
    lines = spark.createDataFrame(rows, "bucket string, value string, seq int")
    landing.land_packed(lines, path, 500, order=["seq"])
    landing.land_packed(lines.filter("bucket = '2024010101' AND seq < 100"), path, 500, order=["seq"])
    started = spark.conf.get(landing.LISTING)
    got = landing.read_packed(spark, path)
    assert spark.conf.get(landing.LISTING) == started
    same([tuple(r) for r in got.select("bucket", "value").collect()], [(b, v) for b, v, i in rows if i % 2 == 0 or i < 100])
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["bucket=2024010100", "bucket=2024010101"]


ODD_LINES = [
    ("a:b c+%/é", "one"), ("a:b c+%/é", None), (None, "é" * 9), ("", "last"), ("plus", "a\u0085b"), ("plus", ""), ("plus", "x" * 40),
]


def odd_lines(spark):
    rows = [(b, v, i) for i, (b, v) in enumerate(ODD_LINES * 3)]
    return spark.createDataFrame(rows, "bucket string, value string, seq int").repartition(3)


def test_files_on_a_mounted_folder_are_written_by_tasks(spark, tmp_path):
    path, made = str(tmp_path / "out"), {}
    landing.land_packed(odd_lines(spark), path, 30, order=["seq"])
    # Hadoop's writer starts a process for each file and leaves a hidden file beside it
    assert not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith((".", "_"))]
    for p in (tmp_path / "out").rglob("*.txt"):
        made.setdefault((p.parts[-3], p.parts[-2]), []).append(p.read_bytes())
    assert sorted(x for texts in made.values() for t in texts for x in t.decode().split("\n")[:-1]) == sorted((v or "") for _, v in ODD_LINES * 3)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.landed.link./there", (tmp_path / "there").as_uri())
    (tmp_path / "there").mkdir()
    landing.land_packed(odd_lines(spark), "viewfs://landed/there", 30, order=["seq"])
    by_spark = {}
    for p in (tmp_path / "there").rglob("*.txt"):
        by_spark.setdefault((p.parts[-3], p.parts[-2]), []).append(p.read_bytes())
    assert {k: sorted(b"".join(v).split(b"\n")) for k, v in made.items()} == {k: sorted(b"".join(v).split(b"\n")) for k, v in by_spark.items()}


def test_packed_files_read_whole_or_by_line(spark, tmp_path):
    path = str(tmp_path / "out")
    landing.land_packed(odd_lines(spark), path, 30, order=["seq"])
    raw = spark.sql("SELECT 'raw' AS bucket, CAST(X'FF0041C3' AS STRING) AS value, 0 AS seq UNION ALL SELECT 'raw', 'a\\r\\nb\\rc', 1")
    landing.land_packed(raw, path, 30, order=["seq"])
    (tmp_path / "out" / "bucket=raw" / "file=7").mkdir()
    (tmp_path / "out" / "bucket=raw" / "file=7" / "part-0.txt").write_bytes(b"\n\nno line end")
    (tmp_path / "out" / "bucket=raw" / "file=8").mkdir()
    (tmp_path / "out" / "bucket=raw" / "file=8" / "part-0.txt").write_bytes(b"")
    columns = ("bucket", "file", "hex(CAST(value AS BINARY)) AS value", "_metadata.file_size")
    whole, by_line = landing.read_packed(spark, path, 30), landing.read_packed(spark, path)
    assert whole.columns[:3] == by_line.columns[:3] == ["value", "bucket", "file"]
    got, want = whole.selectExpr(*columns).collect(), by_line.selectExpr(*columns).collect()
    same([tuple(r) for r in got], [tuple(r) for r in want])
    assert {r["bucket"] for r in got} == {"a:b c+%/é", None, "plus", "raw"} and sum(r["file"] == 7 for r in got) == 3


def test_hours_are_listed_by_one_job(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"202401010{i % 3}", f"line {i:04d}", i) for i in range(600)]
    landing.land_packed(spark.createDataFrame(rows, "bucket string, value string, seq int"), path, 50, order=["seq"])
    started = spark.conf.get(landing.LISTED_BY_DRIVER)
    for target in (50, landing.WHOLE_BYTES + 1):
        spark.sparkContext.setJobGroup(f"listing {target}", "")
        got = landing.read_packed(spark, path, target)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"listing {target}")) == 1
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert spark.conf.get(landing.LISTED_BY_DRIVER) == started
        same([tuple(r) for r in got.select("bucket", "value").collect()], [r[:2] for r in rows])
    (tmp_path / "none").mkdir()
    assert landing.read_packed(spark, str(tmp_path / "none"), 50).count() == 0
    landing.land_packed(spark.createDataFrame([], "bucket string, value string, seq int"), str(tmp_path / "none"), 50)
    assert landing.read_packed(spark, str(tmp_path / "none")).count() == 0
