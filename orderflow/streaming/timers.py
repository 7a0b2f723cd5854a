"""Count-or-clock batches per key, closed by processing-time timers.

A batch of a key is `size` orders, or what has come in when the clock reaches the next multiple of the interval: the
timer closes it although no further order comes. Two steps share the work, so that no task holds a hot key:

1. Each task of a micro-batch folds its own rows, before any shuffle: of each key it forms whole batches of `size`
   orders, and hands on the fewer than `size` orders that are left.
2. What is left is merged per key in a value state that holds one unfinished batch (fewer than `size` orders), with a
   timer at its interval's end. Whole batches go past the state, in lanes of their own.

Step 2 thus gets fewer than `size` orders of a key from each task, however many orders the key has. Which orders share
a batch depends on how they come in, as it does for any count over a parallel stream; no order is lost or
counted twice, and no batch spans the end of an interval that had passed before its micro-batch began.
"""

import sys
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# Workers get this module's code with the job, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Orders left over that a task keeps to fill up batches with later rows of its own.
HELD_ROWS = 100_000
MEASURES = ("startWindowTime", "endWindowTime", "orders", "users", "totalFee")
OPEN = "start long, end long, orders long, totalFee long, users array<string>"


@contextmanager
def timer_state(spark, partitions=None):
    """Queries started inside keep their state in the store that timers need, in so many partitions (by default
    as many as a shuffle has); other queries stay as they are."""
    wanted = {PROVIDER: ROCKS} | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def whole_batches(rows, keys, size):
    """Whole batches of `size` rows of each key, and the rows left over, of a pandas frame of orders with
    `b_user`, `b_fee` and `b_now` (when they came in)."""
    if not len(rows):
        return rows, rows
    # keys may be null, which is a key of its own
    by_key = rows.groupby(keys, dropna=False, sort=False)
    place, group = by_key.cumcount(), by_key.ngroup()
    whole = place < (group.map(group.value_counts()) // size) * size
    full = rows[whole].assign(_group=group[whole], _chunk=place[whole] // size)
    batches = full.groupby(["_group", "_chunk"], sort=False).agg(
        **{k: (k, "first") for k in keys}, b_start=("b_now", "min"), b_end=("b_now", "max"), b_orders=("b_now", "size"),
        b_users=("b_user", "nunique"), b_fee=("b_fee", "sum"),
    )
    # "first" passes over nulls, which is right inside one key
    return batches.reset_index(drop=True), rows[~whole]


def folded(rows, keys, size):
    """Step 1: rows with `b_lane` -1 are single orders left over, others are whole batches."""
    key_fields = [rows.schema[k] for k in keys]
    schema = T.StructType([
        *key_fields, T.StructField("b_lane", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("b_start", "b_end", "b_orders", "b_users", "b_fee")],
        T.StructField("b_user", T.StringType()),
    ])
    names = schema.fieldNames()

    def fold(frames):
        from pyspark import TaskContext

        lane, held = TaskContext.get().partitionId(), None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            batches, held = whole_batches(held, keys, size)
            if len(batches):
                yield batches.assign(b_lane=lane, b_user=None)[names]
            if len(held) > HELD_ROWS:
                yield _single(held)[names]
                held = None
        if held is not None and len(held):
            yield _single(held)[names]

    def _single(rest):
        return rest.assign(b_lane=-1, b_start=rest["b_now"], b_end=rest["b_now"], b_orders=1, b_users=0)

    return rows.mapInPandas(fold, schema)


class UnfinishedBatch(StatefulProcessor):
    """Step 2: the state of a key is its unfinished batch."""

    def __init__(self, keys, size, interval_ms):
        self.keys, self.size, self.interval_ms = keys, size, interval_ms

    def init(self, handle):
        self.handle, self.open = handle, handle.getValueState("open", OPEN)

    def _frame(self, key, rows):
        return pd.DataFrame([(*key[:-1], *row) for row in rows], columns=[*self.keys, *MEASURES])

    def handleInputRows(self, key, rows, timerValues):
        if key[-1] >= 0:
            for frame in rows:
                whole = frame[[*frame.columns[: len(self.keys)], "b_start", "b_end", "b_orders", "b_users", "b_fee"]]
                yield whole.set_axis([*self.keys, *MEASURES], axis=1)
            return
        now, done = timerValues.getCurrentProcessingTimeInMs(), []
        start, end, orders, total, users = self.open.get() if self.open.exists() else (0, 0, 0, 0, [])
        users = set(users)
        if orders and end <= now:
            done.append((start, end, orders, len(users), total))
            orders, total, users = 0, 0, set()
        for frame in rows:
            for at, user, fee in zip(frame["b_start"], frame["b_user"], frame["b_fee"]):
                if not orders:
                    start, end = int(at), (now // self.interval_ms + 1) * self.interval_ms
                orders, total = orders + 1, total + (0 if pd.isna(fee) else int(fee))
                if not pd.isna(user):
                    users.add(user)
                if orders == self.size:
                    done.append((start, int(at), orders, len(users), total))
                    orders, total, users = 0, 0, set()
        if orders:
            self.open.update((start, end, orders, total, sorted(users)))
            self.handle.registerTimer(end)
        elif self.open.exists():
            self.open.clear()
        if done:
            yield self._frame(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.open.exists():
            start, end, orders, total, users = self.open.get()
            if end <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.clear()
                yield self._frame(key, [(start, end, orders, len(users), total)])

    def close(self):
        pass


def count_or_clock(rows, keys, size, interval_ms, user="userID", fee="fee"):
    """Per key and batch its time, orders, users and totalFee, append mode. A whole batch ends when its last order
    came in, a closed one with its interval. Orders without a user count as orders, not as users; a missing fee
    adds nothing; keys may be null. Start the query inside `timer_state`, with a trigger that goes on."""
    # the state's rows have names of their own: one that begins with an underscore would be lost on the way
    named = [f"k_{i}" for i in range(len(keys))]
    slim = rows.select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], F.col(user).cast("string").alias("b_user"),
        F.coalesce(F.col(fee).cast("bigint"), F.lit(0)).alias("b_fee"), F.unix_millis(F.current_timestamp()).alias("b_now"),
    )
    results = T.StructType([*[rows.schema[k] for k in keys], *[T.StructField(n, T.LongType()) for n in MEASURES]])
    return folded(slim, named, size).groupBy(*named, "b_lane").transformWithStateInPandas(
        UnfinishedBatch(list(keys), size, interval_ms), results, "Append", "ProcessingTime"
    )
