"""Streaming forms of the count, ranking and pattern operators, as carry steps."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators import patterns
from orderflow.operators.counted import count_chunks, running_snapshots
from orderflow.operators.ordered import tie_break
from orderflow.operators.ranking import TOP_N, RANK_WINDOW_MS, top_n
from orderflow.operators.windows import average_fee, order_measures


def _schema(df, columns):
    return T.StructType([df.schema[c] for c in columns])


class CountOrTime:
    """Batches of `size` orders per key, cut off where the aligned event-time interval ends.

    With `interval_ms=None` it is a plain count window. Rows of the unfinished batch of each key
    (fewer than `size`) are carried. Rows of an interval that has already ended are dropped.
    """

    def __init__(self, keys, measures, size, interval_ms=None, delay_ms=0, order=("ct", "seq"), columns=()):
        self.keys, self.measures, self.size = list(keys), measures, size
        self.interval_ms, self.delay_ms, self.order = interval_ms, delay_ms, list(order)
        self.columns = [*self.keys, *self.order, *columns]

    def carried_schema(self, stream):
        return _schema(stream, self.columns)

    def _interval(self):
        return F.floor(F.col("ct") / self.interval_ms) if self.interval_ms else F.lit(0).cast("bigint")

    def _ended(self, clock):
        if self.interval_ms is None or clock is None:
            return F.lit(False)
        return (F.col("_interval") + 1) * self.interval_ms <= F.lit(clock - self.delay_ms)

    def __call__(self, carried, batch, before, now):
        new = batch.select(*self.columns).withColumn("_interval", self._interval()).filter(~self._ended(before))
        old = carried.withColumn("_interval", self._interval())
        # carried rows come first whatever their time
        start = F.col("_interval") * (self.interval_ms or 1) - 1
        rows = new.withColumn("_at", F.col("ct")).unionByName(
            old.withColumn("_at", start if self.interval_ms else F.lit(-1).cast("bigint"))
        )
        groups = [*self.keys, "_interval"]
        placed = count_chunks(rows, groups, self.size, ["_at", *self.order]).persist()
        stats = placed.groupBy(*groups, "chunk").agg(
            F.count(F.lit(1)).alias("_n"), F.min("ct").alias("_first"), F.max("ct").alias("_last"), *self.measures
        )
        full = F.col("_n") == self.size
        done = stats.filter(full | self._ended(now))
        end = F.when(full, F.col("_last"))
        if self.interval_ms:
            end = end.otherwise((F.col("_interval") + 1) * self.interval_ms)
        results = done.withColumn("startWindowTime", F.col("_first")).withColumn("endWindowTime", end)
        open_chunks = stats.filter(~(full | self._ended(now))).select(*groups, "chunk")
        keep = placed.join(open_chunks, [*groups, "chunk"], "left_semi").select(*self.columns)
        return results.drop("_n", "_first", "_last", "_interval", "chunk"), keep, [placed]


class CountTriggered:
    """Running orders, users and totalFee per key and period, reported at every `size` orders.

    The input is `with_first_sights(stream, …)`: orders plus one row for each user new to a key and
    period. Only the running totals of open periods are carried; rows of a period that has ended are dropped.
    Give the stream a watermark of `delay_ms`, so that both drop the same rows. Orders without a user count as
    orders, not as users.
    """

    def __init__(self, keys, size, period_ms, offset_ms=0, delay_ms=0, order=("ct", "seq"), user="userID"):
        self.keys, self.size, self.period_ms, self.offset_ms = list(keys), size, period_ms, offset_ms
        self.delay_ms, self.order, self.user = delay_ms, [*order, "_tie"], user
        self.groups = [*self.keys, "startWindowTime"]

    def with_first_sights(self, stream, watermark_column="ts"):
        """Adds a `_sight` row for each user's first row in a key and period; state is spread by user and ends
        with the period."""
        start = F.floor((F.col("ct") - self.offset_ms) / self.period_ms) * self.period_ms + self.offset_ms
        period = F.window(watermark_column, f"{self.period_ms} milliseconds", startTime=f"{self.offset_ms} milliseconds")
        rows = stream.withColumn("startWindowTime", start).withColumn("_period", period)
        fee = F.col("fee").cast("bigint").alias("fee")
        slim = rows.select(*self.groups, self.user, *self.order[:-1], fee, "_period")
        slim = slim.withColumn("_tie", tie_break(slim.drop("_period")))
        first = slim.filter(F.col(self.user).isNotNull()).dropDuplicates([*self.keys, "_period", self.user])
        both = slim.withColumn("_sight", F.lit(0)).unionByName(first.withColumn("_sight", F.lit(1)))
        return both.drop("_period")

    def _timely(self, batch, before):
        if before is None:
            return batch
        return batch.filter(F.col("startWindowTime") + self.period_ms > F.lit(before - self.delay_ms))

    def _open(self, totals, now):
        if now is None:
            return totals
        return totals.filter(F.col("startWindowTime") + self.period_ms > F.lit(now - self.delay_ms))

    def carried_schema(self, stream):
        return T.StructType([
            *[stream.schema[c] for c in self.keys], T.StructField("startWindowTime", T.LongType()),
            T.StructField("_order", T.LongType()), T.StructField("_user", T.LongType()), T.StructField("fee", T.LongType()),
        ])

    def __call__(self, carried, batch, before, now):
        batch = self._timely(batch, before)
        # a sight row only says that the user is new; its place is the user's first row of the batch
        seen = batch.groupBy(*self.groups, self.user).agg(
            F.min(F.struct(*self.order)).alias("o"), F.max("_sight").alias("_sight")
        ).filter("_sight = 1")
        zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
        orders = batch.filter("_sight = 0").select(
            *self.groups, *self.order, "fee", one.alias("_order"), zero.alias("_user"), one.alias("_new")
        )
        sights = seen.select(
            *self.groups, *[F.col(f"o.{c}").alias(c) for c in self.order],
            zero.alias("fee"), zero.alias("_order"), one.alias("_user"), zero.alias("_new"),
        )
        fresh = orders.unionByName(sights)
        # totals so far come before every row of their period
        rest = [F.lit(None).cast(orders.schema[c].dataType) for c in self.order[1:]]
        first_of_all = [F.col("startWindowTime") - 1, *rest]
        old = carried.select(
            *self.groups, *[v.alias(c) for c, v in zip(self.order, first_of_all)],
            "fee", "_order", "_user", zero.alias("_new"),
        )
        rows = fresh.unionByName(old)
        results = running_snapshots(rows, self.groups, self.size, self.order)
        totals = self._open(rows.groupBy(*self.groups).agg(*[F.sum(c).alias(c) for c in ("_order", "_user", "fee")]), now)
        return results.select(
            *self.keys, F.date_format(F.timestamp_millis("ct"), "yyyyMMddHH").alias("etTime"),
            "startWindowTime", "ct", "orders", "users", "totalFee",
        ), totals, []


class RenewedTotals(CountTriggered):
    """Running orders, users and totalFee per key and period, given out again by each trigger that brought orders
    of that period, exact up to `clock`, the latest time seen.

    The input is `with_first_sights(stream, …)`: as each user's first row of a period comes along marked, a
    trigger adds its own orders, fees and new users to the totals carried, and no user is looked up or estimated.
    """

    def __init__(self, keys, period_ms, offset_ms=0, delay_ms=0, order=("ct", "seq"), user="userID"):
        super().__init__(keys, None, period_ms, offset_ms, delay_ms, order, user)

    def __call__(self, carried, batch, before, now):
        is_order = F.col("_sight") == 0
        fresh = self._timely(batch, before).groupBy(*self.groups).agg(
            F.count_if(is_order).alias("_order"), F.count_if(~is_order).alias("_user"),
            F.sum(F.when(is_order, F.col("fee"))).alias("fee"),
        )
        rows = fresh.withColumn("_new", F.lit(True)).unionByName(carried.withColumn("_new", F.lit(False)))
        totals = rows.groupBy(*self.groups).agg(
            *[F.sum(c).alias(c) for c in ("_order", "_user", "fee")], F.bool_or("_new").alias("_new")
        ).persist()
        results = totals.filter("_new").select(
            *self.keys, "startWindowTime", (F.col("startWindowTime") + self.period_ms).alias("endWindowTime"),
            F.lit(now).cast("bigint").alias("clock"), F.col("_order").alias("orders"), F.col("_user").alias("users"),
            F.col("fee").alias("totalFee"),
        )
        return results, self._open(totals, now).drop("_new"), [totals]


class WindowRevisions:
    """Measures per key and event-time window as a log of revisions.

    Revision 1 of a window is given out when the clock less `delay_ms` reaches its end, a further one by each
    micro-batch that brings rows of it until `lateness_ms` later; rows after that are dropped. Per key and
    open window one row of measures and the number of the last revision are carried. The row with the greatest
    `revision` of a window is its current result, so a keyed table takes it as the version.
    """

    measures = ("orders", "maxFee", "totalFee", "members")

    def __init__(self, keys, size_ms, lateness_ms=0, delay_ms=0, exact=False):
        self.keys, self.size_ms, self.lateness_ms, self.delay_ms = list(keys), size_ms, lateness_ms, delay_ms
        self.groups, self.exact = [*self.keys, "startWindowTime"], exact
        self.columns = [*self.keys, "ct", "fee", "adult", "yonger", "baby"]

    def carried_schema(self, stream):
        numbers = ["startWindowTime", *self.measures, "revision"]
        return T.StructType([*[stream.schema[c] for c in self.keys], *[T.StructField(c, T.LongType()) for c in numbers]])

    def __call__(self, carried, batch, before, now):
        end, none = F.col("startWindowTime") + self.size_ms, F.lit(0).cast("bigint")
        rows = batch.withColumn("startWindowTime", F.floor(F.col("ct") / self.size_ms) * self.size_ms)
        if before is not None:
            rows = rows.filter(end + self.lateness_ms > F.lit(before - self.delay_ms))
        fresh = rows.filter(F.col("ct").isNotNull()).groupBy(*self.groups).agg(*order_measures())
        fresh = fresh.select(*self.groups, *self.measures, none.alias("revision"), F.lit(True).alias("_new"))
        windows = fresh.unionByName(carried.withColumn("_new", F.lit(False))).groupBy(*self.groups).agg(
            *[(F.max if c == "maxFee" else F.sum)(c).cast("bigint").alias(c) for c in self.measures],
            F.max("revision").alias("revision"), F.bool_or("_new").alias("_new"),
        )
        known = F.lit(None if now is None else now - self.delay_ms).cast("bigint")
        told = F.coalesce(end <= known, F.lit(False)) & ((F.col("revision") == 0) | F.col("_new"))
        windows = windows.withColumn("_told", told).persist()
        windows_now = windows.withColumn("revision", F.col("revision") + F.col("_told").cast("bigint"))
        results = windows_now.filter("_told").select(
            *self.groups, end.alias("endWindowTime"), *self.measures, average_fee(self.exact), "revision"
        )
        keep = windows_now.filter(F.coalesce(end + self.lateness_ms > known, F.lit(True)))
        return results, keep.select(*self.groups, *self.measures, "revision"), [windows]


class TopN:
    """Final top-N per ranking period over a stream of closed windows (append-mode statistics).

    The candidates of open periods are carried: at most n per group.
    """

    def __init__(self, n=TOP_N, period_ms=RANK_WINDOW_MS, rank_within=("productID", "traffic"), ties="collapse"):
        self.options = {"n": n, "period_ms": period_ms, "rank_within": rank_within, "ties": ties}
        self.period_ms = period_ms

    columns = ("productID", "traffic", "startWindowTime", "endWindowTime", "orders", "totalFee")

    def carried_schema(self, stream):
        return _schema(stream, self.columns)

    def __call__(self, carried, batch, before, now):
        best = top_n(batch.select(*self.columns).unionByName(carried), **self.options)
        over = F.lit(False) if now is None else F.col("rankWindowTime") + self.period_ms <= F.lit(now)
        best = best.persist()
        return best.filter(over), best.filter(~over).select(*self.columns), [best]


class RepeatMatches:
    """Pattern matches, each row given out once its match count can no longer change.

    Rows of the last two pattern lengths are carried; rows behind the watermark are dropped.
    """

    def __init__(self, hit, times=patterns.TIMES, within_ms=patterns.WITHIN_MS, keys=(), delay_ms=0,
                 order=("seq",), columns=()):
        self.hit, self.times, self.within_ms, self.keys = hit, times, within_ms, list(keys)
        self.delay_ms, self.order, self.columns = delay_ms, list(order), list(columns)

    def carried_schema(self, stream):
        return _schema(stream, self.columns)

    def __call__(self, carried, batch, before, now):
        if now is None:
            return carried.withColumn("matches", F.lit(0).cast("bigint")), carried, []
        ct, within = F.col("ct"), self.within_ms
        known, told = now - self.delay_ms, -1
        new = batch.select(*self.columns)
        if before is not None:
            told = before - self.delay_ms - within
            new = new.filter(ct >= F.lit(before - self.delay_ms))
        rows = carried.unionByName(new)
        found = patterns.repeat_matches(rows, self.hit, self.times, within, self.keys, "ct", self.order)
        # rows at the watermark itself may still arrive, so the bound is exclusive
        final = found.filter((ct >= F.lit(told)) & (ct < F.lit(known - within)))
        return final, rows.filter(ct >= F.lit(known - 2 * within)), []
