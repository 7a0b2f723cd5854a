"""Results that are renewed, corrected or closed by the clock."""

import random
import time

import pandas as pd
from pyspark.sql import functions as F

from orderflow.operators import windows
from orderflow.plans.stream_queries import _in_parts
from orderflow.streaming import timers
from orderflow.streaming.carry import Carry
from orderflow.streaming.steps import RenewedTotals, WindowRevisions
from tests.test_streaming import ONCE, Feed, batch, make, same, thirds


def timely(parts, keep):
    """Rows that are not too late, by part, and the clock after each part."""
    clock, kept, clocks = None, [], []
    for part in parts:
        kept.append([r for r in part if clock is None or keep(r[3], clock)])
        clock = max([r[3] for r in part] + ([] if clock is None else [clock]))
        clocks.append(clock)
    return kept, clocks


def shuffled(n=300, parts=4, seed=2, late=30):
    rows = make(n, seed)
    split = thirds(rows, parts)
    moved = random.Random(seed).sample(split[0], late)
    split[0] = [r for r in split[0] if r not in moved]
    split[-1] += moved[: late // 2]
    split[1] += moved[late // 2:]
    return split


def test_each_trigger_gives_exact_totals(spark, tmp_path):
    period, delay = 20_000, 30_000
    parts = shuffled()
    parts[1] += [("a", None, 5, 99, 9_000, "R", "P", "1", "0", "")]
    feed = Feed(spark, tmp_path, parts)
    step = RenewedTotals(["traffic"], period, delay_ms=delay)
    got = feed.carry(step, step.with_first_sights(feed.stream("30 seconds"))).collect()
    kept, clocks = timely(parts, lambda ct, clock: (ct // period + 1) * period > clock - delay)
    want, seen = [], []
    for rows, clock in zip(kept, clocks):
        seen += rows
        for key in {(r[0], r[3] // period * period) for r in rows}:
            mine = [r for r in seen if (r[0], r[3] // period * period) == key]
            want.append((*key, key[1] + period, clock, len(mine), len({r[1] for r in mine if r[1]}), sum(r[2] for r in mine)))
    assert len(kept[-1]) < len(parts[-1])
    same([tuple(r) for r in got], want)


def test_state_of_first_sights_ends_with_the_period(spark, tmp_path):
    def row(user, ct, seq):
        return ("a", user, 1, ct, seq, "R", "P", "1", "0", "")

    parts = [[row(f"u{k}", k, k) for k in range(50)], [row("u1", 90_000, 60)], [row("u1", 90_001, 61)], [row("u2", 90_002, 62)]]
    feed = Feed(spark, tmp_path, parts)
    step = RenewedTotals(["traffic"], 10_000, delay_ms=1_000)
    stream = step.with_first_sights(feed.stream("1 second"))
    carry = Carry(step, feed.out, step.carried_schema(stream))
    query = carry.start(stream, feed.log, ONCE)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_windows_are_told_and_corrected(spark, tmp_path):
    size, lateness, delay = 10_000, 60_000, 1_000
    parts = shuffled()
    feed = Feed(spark, tmp_path, parts)
    step = WindowRevisions(["userRegion", "traffic"], size, lateness, delay)
    stream = feed.stream()
    carry = Carry(step, feed.out, step.carried_schema(stream))
    carry.start(stream, feed.log, ONCE).awaitTermination()
    carry.drain(spark)
    got = carry.results(spark)
    kept, clocks = timely(parts, lambda ct, clock: (ct // size + 1) * size + lateness > clock - delay)
    want, seen, told = [], [], {}
    for rows, clock in zip([*kept, []], [*clocks, 1 << 60]):
        seen += rows
        changed = {(r[5], r[0], r[3] // size * size) for r in rows}
        for key in {(r[5], r[0], r[3] // size * size) for r in seen}:
            if key[2] + size <= clock - delay and (key in changed or key not in told):
                told[key] = told.get(key, 0) + 1
                mine = [r for r in seen if (r[5], r[0], r[3] // size * size) == key]
                fees = [r[2] for r in mine]
                want.append((*key, len(mine), max(fees), sum(fees), float(sum(fees) // len(mine)), told[key]))
    assert max(w[-1] for w in want) > 1 and len(kept[-1]) < len(parts[-1])
    same([tuple(r) for r in got.select(
        "userRegion", "traffic", "startWindowTime", "orders", "maxFee", "totalFee", "avgFee", "revision").collect()], want)


def test_last_revision_is_the_batch_result(spark, tmp_path):
    parts = shuffled()
    step = WindowRevisions(["userRegion", "traffic"], 10_000, 10**9)
    frames = [batch(spark, p) for p in parts]
    carry = Carry(step, str(tmp_path / "o"), step.carried_schema(frames[0]))
    for k in (0, 1, 1, 2, 3, 3):
        carry(frames[k], k)
    carry.columns = frames[0].schema
    carry.drain(spark)
    last = carry.results(spark).groupBy("userRegion", "traffic", "startWindowTime", "endWindowTime").agg(
        *[F.max_by(c, "revision").alias(c) for c in ("orders", "maxFee", "totalFee", "members", "avgFee")]
    )
    same(last.collect(), windows.region_traffic_stats(batch(spark, [r for p in parts for r in p])).collect())


def test_fold_hands_on_few_rows_of_a_hot_key(spark):
    rows = spark.range(50_000, numPartitions=4).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise("hot").alias("k"), F.lit("u").alias("b_user"),
        F.lit(1).cast("long").alias("b_fee"), F.col("id").alias("b_now"),
    )
    got = timers.folded(rows, ["k"], 7).groupBy("b_lane", "k").agg(F.sum("b_orders").alias("n"), F.count("*").alias("rows")).collect()
    assert sum(r["n"] for r in got) == 50_000
    assert all(r["rows"] <= 4 * 6 for r in got if r["b_lane"] == -1)


def test_whole_batches_of_a_frame():
    frame = pd.DataFrame({"k": ["a"] * 5 + [None] * 3, "b_user": ["x", "y", "x", "z", None, None, None, "w"],
                          "b_fee": range(8), "b_now": range(8)})
    full, rest = timers.whole_batches(frame, ["k"], 2)
    assert sorted(full["b_fee"]) == [1, 5, 11] and sorted(full["b_users"]) == [0, 2, 2]
    assert list(rest["b_fee"]) == [4, 7]


def test_idle_stream_closes_its_batches(spark, tmp_path):
    rows = [("a" if i < 112 else None if i < 114 else "b", f"u{i % 3}" if i % 4 else None, i, i, i, "R", "P", "1", "0", "")
            for i in range(120)]
    feed = Feed(spark, tmp_path, [rows[:57], rows[57:]])
    batches = timers.count_or_clock(feed.stream().drop("ts"), ["traffic"], 10, 4_000)
    with timers.timer_state(spark):
        query = batches.writeStream.format("parquet").option("path", feed.out).option(
            "checkpointLocation", feed.log).outputMode("append").trigger(processingTime="500 milliseconds").start()
    assert spark.conf.get(timers.PROVIDER) != timers.ROCKS
    got, deadline = [], time.time() + 120
    while sum(r.orders for r in got) < 120 and time.time() < deadline and not query.exception():
        time.sleep(1)
        got = spark.read.schema(batches.schema).parquet(feed.out).collect() if query.recentProgress else []
    query.stop()
    assert query.exception() is None
    sums = {}
    for r in got:
        orders, fees = sums.get(r.traffic, (0, 0))
        sums[r.traffic] = orders + r.orders, fees + r.totalFee
        assert 1 <= r.orders <= 10 and r.users <= 3 and r.startWindowTime <= r.endWindowTime
        assert r.orders == 10 or r.endWindowTime % 4_000 == 0
    assert sums == {"a": (112, sum(range(112))), None: (2, 225), "b": (6, sum(range(114, 120)))}
    assert sum(r.orders == 10 for r in got if r.traffic == "a") >= 9


def test_parts_of_several_files_are_one_batch(spark, tmp_path):
    rows = [(i, f"2024-01-{1 + i // 4:02d} 00:00:00", i % 3, "view", 1.5, "{}") for i in range(60)]
    made = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made.filter("event_id < 40 AND event_id % 20 < 3").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(
        str(tmp_path / "few" / "events.parquet"))

    def batches(folder, files):
        found = {}

        def see(batch, number):
            found[number] = sorted(r["event_id"] for r in batch.collect())

        stream = _in_parts(spark, str(folder), files)
        log = str(tmp_path / f"log-{folder.name}-{files}")
        stream.writeStream.foreachBatch(see).option("checkpointLocation", log).trigger(**ONCE).start().awaitTermination()
        return found

    for folder in (tmp_path, tmp_path / "few"):
        whole = batches(folder, 1)
        assert len(whole) == 4 and batches(folder, 5) == whole


def test_a_batch_has_the_columns_of_its_step_only(spark, tmp_path):
    seen = []

    class Watched(WindowRevisions):
        def __call__(self, carried, batch, before, now):
            seen.append(batch.columns)
            return super().__call__(carried, batch, before, now)

    feed = Feed(spark, tmp_path, thirds(make(60, 3)))
    step, stream = Watched(["traffic"], 10_000), feed.stream()
    carry = Carry(step, feed.out, step.carried_schema(stream))
    carry.start(stream, feed.log, ONCE).awaitTermination()
    carry.drain(spark)
    assert len(seen) == 4 and all(c == ["traffic", "ct", "fee", "adult", "yonger", "baby"] for c in seen)
