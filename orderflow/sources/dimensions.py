"""Dimension tables: JDBC and file readers, projections, keyed snapshots, timed refresh."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderflow.schemas import HOTEL_COLUMNS, PRODUCT_COLUMNS
from orderflow.session import cleared

# Most different keys of a micro-batch that are looked up one by one.
LOOKUP_KEYS = 500_000


def jdbc_dimension(spark, url, query, user=None, password=None, driver=None, split=None):
    """Rows of a SQL query read over JDBC.

    `split=(column, lower, upper, parts)` reads a big dimension in parallel range scans.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for name, setting in (("user", user), ("password", password), ("driver", driver)):
        if setting:
            reader = reader.option(name, setting)
    if split is None:
        return reader.option("query", query).load()
    column, lower, upper, parts = split
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .load()
    )


def product_dimension(rows):
    """Product columns under their record names."""
    named = {new: F.col(old) for old, new in PRODUCT_COLUMNS.items()}
    named["productLevel"] = named["productLevel"].try_cast("int")
    return rows.select(*[c.alias(n) for n, c in named.items()])


def hotel_dimension(rows):
    """Hotel columns under their record names."""
    return rows.select(*[F.col(old).alias(new) for old, new in HOTEL_COLUMNS.items()])


def last_per_key(rows, key, version=None):
    """One row per key: the one with the highest `version`, else the highest attribute values.

    An aggregate, so copies of a hot key collapse before the shuffle.
    """
    rest = [c for c in rows.columns if c != key]
    record = F.struct(*rest)
    kept = F.max_by(record, F.col(version)) if version else F.max(record)
    return rows.groupBy(key).agg(kept.alias("r")).select(key, "r.*")


def keyed_snapshot(rows, key, version=None):
    """The dimension as key and JSON text, one row per key."""
    one = last_per_key(rows, key, version)
    return one.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


class RefreshingDim:
    """A dimension read again once it is older than `ttl` seconds; use `get()` per micro-batch."""

    def __init__(self, load, ttl=60.0, clock=time.monotonic):
        self._load, self._ttl, self._clock = load, ttl, clock
        self._rows, self._read_at = None, None

    def get(self):
        now = self._clock()
        if self._rows is None or now - self._read_at >= self._ttl:
            self._rows, self._read_at = self._load(), now
        return self._rows


class SnapshotLog:
    """Numbered snapshots of a dimension, and which one each micro-batch of a run has taken.

    `save` writes a snapshot; `bound` gives the one a batch is bound to. A batch is bound once, before it reads, to
    the newest snapshot; replayed, it reads the same one again whatever has been saved since. Snapshots
    and bindings are small folders of the shared store, written whole: a batch that fails between the two leaves
    nothing half done. One query is bound in a run; runs are told apart by `run`, such as `run_of(checkpoint)`.
    """

    def __init__(self, path, run="0"):
        self.path, self.run = path.rstrip("/"), run

    def _numbers(self, spark):
        try:
            found = spark.read.parquet(f"{self.path}/numbers").agg(F.max("number")).first()[0]
        except AnalysisException:  # none has been saved
            found = None
        return found

    def save(self, rows):
        """Writes the rows as the next snapshot and gives its number. One writer at a time."""
        spark, last = rows.sparkSession, self._numbers(rows.sparkSession)
        number = 0 if last is None else last + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/snapshots/{number}")
        # the number is written after the rows, so a reader never sees a snapshot that is not whole
        spark.range(1).select(F.lit(number).cast("bigint").alias("number")).write.mode("append").parquet(f"{self.path}/numbers")
        return number

    def number_of(self, spark, batch_id):
        """The number of the snapshot that a batch is bound to; the first call binds it."""
        path = f"{self.path}/run={self.run}/batch={batch_id}"
        try:
            return spark.read.schema("number bigint").parquet(path).first()["number"]
        except (AnalysisException, TypeError):  # not bound, or the binding was cut short
            newest = self._numbers(spark)
        if newest is None:
            raise ValueError("no snapshot has been saved")
        spark.range(1).select(F.lit(newest).cast("bigint").alias("number")).write.mode("overwrite").parquet(path)
        return newest

    def bound(self, spark, batch_id):
        """The dimension as the batch with this id sees it."""
        return spark.read.parquet(f"{self.path}/snapshots/{self.number_of(spark, batch_id)}")

    def forget(self, spark, before):
        """Removes the snapshots older than this number; no batch bound to them may be replayed any more."""
        for number in range(before):
            cleared(spark, f"{self.path}/snapshots/{number}")


class HashedDim:
    """A large dimension stored in folders by a hash of its key, one row per key, for look-ups by micro-batches.

    `lookup` finds which folders the keys of a batch fall in (at most `parts` numbers come to the driver) and reads only
    these; the rows read are cut down to the batch's keys where they lie, by a broadcast of the keys, so the dimension
    itself is never shuffled. A batch with more than `most_keys` different keys would send too much: its facts
    are joined with the folders read by a plain join instead, with the same result.
    """

    def __init__(self, spark, path, key, parts, schema):
        self.spark, self.path, self.key, self.parts, self.schema = spark, path, key, parts, schema

    def _part(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.parts)).cast("int")

    @classmethod
    def stored(cls, rows, path, key, parts, version=None):
        """Writes the dimension, of the rows of a key the newest; rows without a key are left out."""
        dim = cls(rows.sparkSession, path, key, parts, rows.schema)
        one = last_per_key(rows.filter(F.col(key).isNotNull()), key, version).select(*rows.columns)
        placed = one.withColumn("_part", dim._part()).repartition(parts, "_part")
        placed.write.mode("overwrite").partitionBy("_part").parquet(path)
        return dim

    def read(self, keys):
        """The rows in the folders that these keys fall in."""
        keys = keys.filter(F.col(self.key).isNotNull())
        numbers = [r[0] for r in keys.select(self._part().alias("p")).distinct().collect()]  # at most `parts`
        fields = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in self.schema.fields)}, _part int"
        return self.spark.read.schema(fields).parquet(self.path).filter(F.col("_part").isin(numbers)).drop("_part")

    def lookup(self, facts, defaults, most_keys=LOOKUP_KEYS):
        """The facts with the attributes named in `defaults`, which unmatched ones take; as many rows as facts."""
        keys = facts.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        found = self.read(keys).select(self.key, *defaults, F.lit(True).alias("_found"))
        if keys.limit(most_keys + 1).count() <= most_keys:
            # no more rows than keys are left, so both sides are small enough to be sent
            found = F.broadcast(found.join(F.broadcast(keys), self.key, "left_semi"))
        joined = facts.join(found, self.key, "left")
        kinds = {f.name: f.dataType for f in self.schema.fields}
        filled = [F.when(F.col("_found"), F.col(c)).otherwise(F.lit(d).cast(kinds[c])).alias(c) for c, d in defaults.items()]
        return joined.select(*facts.columns, *filled)
