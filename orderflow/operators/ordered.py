"""Row numbers and running sums along an ordered key, computed in slices.

A window function ordered over a whole key puts that key in one task. Here the rows are
range-partitioned by key and order, which cuts evenly whatever the distribution; each slice is summed
by its own task, and the totals of the earlier slices are added. One form serves every size.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.session import stored


def _totals(sliced, sums, by="_slice"):
    """Sums per slice."""
    return sliced.groupBy("_group", by).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])


def _grouped(rows, keys):
    # a struct, so that null keys compare equal in the join below
    return rows.withColumn("_group", F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0)))


def tie_break(rows):
    """A hash of the whole row: with it behind the order, only equal rows can change places."""
    return F.xxhash64(*rows.columns)


def range_slices(rows, keys, order):
    """`rows` cut evenly into consecutive slices `_slice` of each `_group` of keys; nulls come first."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _grouped(rows, keys).repartitionByRange(parts, "_group", *order)
    # Range bounds come from a sample; what is written lets every later use see the same cut.
    return stored(ranged.withColumn("_slice", F.spark_partition_id().cast("bigint")), "slices")


def sums_over_slices(sliced, order, sums, peers=False, by="_slice"):
    """Adds inclusive running sums along `order` to sliced rows: one exchange of the rows."""
    totals = _totals(sliced, sums, by)
    earlier = W.partitionBy("_group").orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        "_group", by, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_t_{n}") for n in sums]
    )
    inside = W.partitionBy("_group", by).orderBy(*order)
    if not peers:
        inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    weighed = sliced.withColumns({f"_w_{n}": e for n, e in sums.items()})
    joined = weighed.join(starts, ["_group", by])
    return joined.select(
        *sliced.columns, *[(F.col(f"_t_{n}") + F.sum(f"_w_{n}").over(inside)).alias(n) for n in sums]
    )


def running_sums(rows, keys, order, sums):
    """Adds inclusive running sums along `order` inside `keys`; of rows equal in `order` any may come first.

    `sums` maps new column names to expressions. Null keys form a group of their own and null order values
    come first. The rows are written once, so hand over only the columns that are needed.
    """
    sliced = range_slices(rows, keys, order)
    return sums_over_slices(sliced, order, sums).select(*rows.columns, *sums)


def running_over_positions(rows, keys, position, sums, block=1024, peers=False):
    """Adds running sums along a column that numbers the rows of a key 0, 1, 2, …

    The numbers make even blocks of `block` positions, so no task sorts more than one block of a key.
    """
    blocked = _grouped(rows, keys).withColumn("_block", F.floor(F.col(position) / block))
    return sums_over_slices(blocked, [position], sums, peers, by="_block").select(*rows.columns, *sums)
