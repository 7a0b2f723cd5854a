import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import counted, ordered, ranking, windows
from orderflow.operators.orders import with_event_time, with_hour

S = 1000


def orders(spark, rows):
    """rows of (traffic, userID, fee, ct)."""
    full = [(t, u, f, ct, i, "R", "P", "1", "0", "") for i, (t, u, f, ct) in enumerate(rows)]
    return with_event_time(spark.createDataFrame(
        full, "traffic string, userID string, fee int, ct long, seq long, userRegion string, productID string, "
        "adult string, yonger string, baby string",
    ))


def test_window_edges(spark):
    rows = orders(spark, [("a", "u", 5, 0), ("a", "u", 7, 9999), ("a", "u", 9, 10_000)])
    got = {r.startWindowTime: r for r in windows.region_traffic_stats(rows).collect()}
    assert (got[0].orders, got[0].endWindowTime, got[0].avgFee, got[10_000].orders) == (2, 10_000, 6.0, 1)
    last = windows.region_traffic_stats(rows, inclusive_end=True).collect()
    assert {r.endWindowTime for r in last} == {9_999, 19_999}


def test_average_is_whole_unless_exact(spark):
    rows = orders(spark, [("a", "u", 1, 0), ("a", "u", 2, 1)])
    assert windows.region_traffic_stats(rows).first().avgFee == 1.0
    assert windows.region_traffic_stats(rows, exact=True).first().avgFee == 1.5


def test_highest_fee_is_not_negative(spark):
    row = windows.region_traffic_stats(orders(spark, [("a", "u", -5, 0)])).first()
    assert (row.maxFee, row.totalFee) == (0, -5)


def test_sums_are_long(spark):
    rows = orders(spark, [("a", "u", 2**31 - 1, 0), ("a", "u", 2**31 - 1, 1)])
    assert windows.region_traffic_stats(rows).first().totalFee == 2**32 - 2


def test_day_starts_at_sixteen_utc(spark):
    h = 3_600_000
    rows = with_hour(orders(spark, [("a", "u", 1, 16 * h - 1), ("a", "v", 1, 16 * h), ("a", "v", 1, 17 * h - 1)]))
    got = sorted((r.etTime, r.startWindowTime, r.orders, r.users) for r in windows.hourly_day_stats(rows).collect())
    assert got == [("1970010115", -8 * h, 1, 1), ("1970010116", 16 * h, 2, 1)]


def test_sliding(spark):
    rows = orders(spark, [("a", "u", 1, 7_000)])
    got = windows.order_window_stats(rows, ["traffic"], windows.WINDOW, windows.SLIDE).collect()
    assert sorted(r.startWindowTime for r in got) == [0, 5_000]


@pytest.mark.parametrize("gap", [5_000])
def test_sessions_like_spark(spark, gap):
    rows = orders(spark, [
        ("a", "u", 1, 0), ("a", "u", 2, 4_999), ("a", "u", 3, 9_999), ("a", "u", 4, 15_000), ("b", "u", 5, 0),
        ("a", "u", 6, 15_000), ("a", "u", 7, 40_000),
    ])
    ours = windows.session_stats_batch(rows, ["traffic"], gap)
    native = windows.session_stats(rows, ["traffic"], f"{gap} milliseconds")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


def test_sessions_random(spark):
    rnd = random.Random(3)
    rows = orders(spark, [(rnd.choice("ab"), "u", rnd.randint(0, 9), rnd.randint(0, 200_000)) for _ in range(300)])
    ours = windows.session_stats_batch(rows, ["traffic"], 2_000)
    native = windows.session_stats(rows, ["traffic"], "2 seconds")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


@pytest.mark.parametrize("approx", [False, True])
def test_users(spark, approx):
    rows = orders(spark, [("a", u, 1, i) for i, u in enumerate("uuvwu")])
    row = windows.windowed_users(rows, ["traffic"], "userID", {"fees": F.col("fee")}, "1 minute", approx=approx).first()
    assert (row.orders, row.users, row.fees) == (5, 3, 5)


# --- ordered -----------------------------------------------------------------------------


@pytest.fixture
def many(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice("abc"), f"u{rnd.randint(0, 20)}", rnd.randint(0, 50),
             rnd.choice([5_000, rnd.randint(0, 100_000)])) for _ in range(1500)]
    return rows, orders(spark, rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_running_sums(spark, many, parts):
    rows, df = many
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts * 4)
    got = ordered.running_sums(df, ["traffic"], ["ct", "seq"], {"n": F.lit(1), "fees": F.col("fee")})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    want, sums = {}, {}
    for i, (t, _, fee, ct) in sorted(enumerate(rows), key=lambda r: (r[1][3], r[0])):
        n, f = sums.get(t, (0, 0))
        sums[t] = want[i] = (n + 1, f + fee)
    assert {r.seq: (r.n, r.fees) for r in got.collect()} == want


def test_running_sums_keep_null_keys_and_work_without_keys(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", 3, 3)], "k string, ct long, seq long")
    by_key = ordered.running_sums(df, ["k"], ["ct", "seq"], {"n": F.lit(1)}).collect()
    assert sorted((r.ct, r.n) for r in by_key) == [(1, 1), (2, 2), (3, 1)]
    overall = ordered.running_sums(df, [], ["ct", "seq"], {"n": F.lit(1)}).collect()
    assert sorted((r.ct, r.n) for r in overall) == [(1, 1), (2, 2), (3, 3)]


def test_running_sums_keep_rows_without_an_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 1), ("a", 6, 1)], "k string, ct long, seq long")
    got = ordered.running_sums(df, ["k"], ["ct", "seq"], {"n": F.lit(1)}).collect()
    assert sorted((r.n, r.ct) for r in got) == [(1, None), (2, 5), (3, 6)]


@pytest.mark.parametrize("repeat", [1, 40])
def test_snapshots_of_equal_rows(spark, repeat):
    """Orders of one millisecond without an arrival number, whole duplicates among them."""
    rows = [("a", f"u{i % 3}", i % 4, 1_000, 1_000) for i in range(6)] * repeat + [("a", "u9", 1, None, None)]
    df = spark.createDataFrame(rows, "traffic string, userID string, fee int, ct long, seq long")
    got = counted.count_triggered_stats(df.filter("ct IS NOT NULL"), ["traffic"], 2, 20_000).collect()
    assert sorted(r.orders for r in got) == list(range(2, 6 * repeat + 1, 2))
    last = max(got, key=lambda r: r.orders)
    assert (last.users, last.totalFee) == (3, repeat * sum(i % 4 for i in range(6)))
    assert sum(r.orders for r in got if r.orders == 2) == 2


@pytest.mark.parametrize("block", [2, 1024])
def test_running_over_positions(spark, block):
    df = spark.createDataFrame([("a", i, 2) for i in range(9)], "k string, chunk long, v int")
    got = ordered.running_over_positions(df, ["k"], "chunk", {"s": F.col("v")}, block).collect()
    assert {r.chunk: r.s for r in got} == {i: 2 * (i + 1) for i in range(9)}


# --- counted -----------------------------------------------------------------------------


@pytest.mark.parametrize("n,full,tail", [(4, 0, 1), (5, 1, 1), (6, 1, 2), (10, 2, 2)])
def test_count_windows(spark, n, full, tail):
    df = orders(spark, [("a", "u", 1, i) for i in range(n)])
    assert counted.count_window_stats(df, ["traffic"], 5).count() == full
    assert counted.count_window_stats(df, ["traffic"], 5, emit_tail=True).count() == tail


def snapshots(rows, size, period, tail):
    state, out, last = {}, set(), {}
    for t, u, fee, ct in sorted(rows, key=lambda r: r[3]):
        key = (t, ct // period * period)
        n, users, fees = state.get(key, (0, frozenset(), 0))
        state[key] = n, users, fees = n + 1, users | {u}, fees + fee
        snap = (*key, n, len(users), fees)
        last[key] = snap
        if n % size == 0:
            out.add(snap)
    return out | set(last.values()) if tail else out


@pytest.mark.parametrize("tail", [False, True])
def test_count_triggered(many, tail):
    rows, df = many
    got = counted.count_triggered_stats(df, ["traffic"], 7, 20_000, emit_tail=tail).collect()
    got = [(r.traffic, r.startWindowTime, r.orders, r.users, r.totalFee) for r in got]
    assert len(got) == len(set(got))
    assert set(got) == snapshots(rows, 7, 20_000, tail)


def test_count_or_time(many):
    rows, df = many
    got = counted.count_or_time_stats(df, ["traffic"], 10, 20_000).collect()
    want, open_batches = [], {}

    def close(key, end):
        batch = open_batches.pop(key)
        want.append((key[0], batch[0][3], end, len(batch), len({b[1] for b in batch}), sum(b[2] for b in batch)))

    for row in sorted(rows, key=lambda r: r[3]):
        key = (row[0], row[3] // 20_000)
        open_batches.setdefault(key, []).append(row)
        if len(open_batches[key]) == 10:
            close(key, row[3])
    for key in list(open_batches):
        close(key, (key[1] + 1) * 20_000)
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(r.orders for r in got) == 10 and sum(r.orders for r in got) == len(rows)


# --- ranking -----------------------------------------------------------------------------


def stats(spark, rows):
    """rows of (product, start, orders, fee)."""
    return spark.createDataFrame(
        [(p, "t", s, s + 10 * S, o, f) for p, s, o, f in rows],
        "productID string, traffic string, startWindowTime long, endWindowTime long, orders long, totalFee long",
    )


def ranked(df, **options):
    return [(r.productID, r.startWindowTime, r.rank) for r in
            ranking.top_n(df, **options).orderBy("rankWindowTime", "productID", "rank").collect()]


def test_top_n_within_a_key(spark):
    df = stats(spark, [("a", 0, 1, 5), ("a", 10 * S, 3, 1), ("a", 20 * S, 1, 9), ("a", 30 * S, 1, 1), ("b", 0, 9, 9)])
    assert ranked(df, n=2) == [("a", 10 * S, 1), ("a", 20 * S, 2), ("b", 0, 1), ("a", 30 * S, 1)]


def test_top_n_ties(spark):
    rows = [("a", 0, 2, 2), ("b", 0, 2, 2), ("c", 0, 2, 1), ("d", 0, 1, 2**40)]
    df = stats(spark, rows)
    assert [p for p, _, _ in ranked(df, rank_within=())] == ["a", "c", "d"]
    assert [p for p, _, _ in ranked(df, rank_within=(), ties="all")] == ["a", "b", "c"]


def test_rank_filter_runs_before_the_exchange(spark):
    plan = ranking.top_n(stats(spark, [("a", 0, 1, 5)]), rank_within=(), ties="all")._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_running_totals_take_the_last_arrival(spark):
    df = spark.createDataFrame([("d", 5, 100, 1), ("d", 6, 50, 2)], "depCode string, fee int, ct long, seq long")
    assert tuple(windows.running_totals(df).first()) == ("d", 2, 11, 50)
