"""Micro-batch steps that carry a small DataFrame from one batch to the next.

The step itself is ordinary DataFrame code over (carried rows, new rows), so a key that holds most
of a batch is spread by the same means as in batch queries. Results, carried rows and the clock are
written under the run, which the checkpoint stands for, and the batch id: a batch that is replayed after a
failure reads what the batch before it left and overwrites its own output, and a query with another
checkpoint leaves both alone. Batch 0 of a run removes what the folder holds of an earlier run with the same
checkpoint path, as that one's checkpoint must be gone. Results are those of the run that was started last.
"""

from pyspark.sql import functions as F

from orderflow.session import cleared
from orderflow.streaming.keyed_table import run_of

# A time after every event: what is still open then is closed.
END_OF_TIME = 1 << 60


class Carry:
    """`step(carried, batch, before, now)` gives (results, rows to carry, frames cached on the way).

    `before` and `now` are the highest `ct` seen up to the previous and this batch. Where the step names its `columns`,
    `start` leaves out all others: a batch is kept while it is worked on, and what it holds is worked out for that.
    """

    def __init__(self, step, folder, carried_schema, ct="ct"):
        self.step, self.folder, self.schema, self.ct = step, folder.rstrip("/"), carried_schema, ct
        self.run, self.last = "0", None

    def _slot(self, kind, batch_id):
        return f"{self.folder}/run={self.run}/{kind}/slot={batch_id % 2}"

    def __call__(self, batch, batch_id, until=None):
        """Takes one batch; `until` puts the clock forward."""
        spark, self.last = batch.sparkSession, batch_id
        if batch_id == 0:
            cleared(spark, f"{self.folder}/run={self.run}")
        batch = batch.persist()
        before = None
        carried = spark.createDataFrame([], self.schema)
        if batch_id > 0:
            before = spark.read.parquet(self._slot("clock", batch_id - 1)).first()["clock"]
            carried = spark.read.schema(self.schema).parquet(self._slot("carried", batch_id - 1))
        now = batch.agg(F.max(self.ct).cast("bigint")).first()[0]
        now = max((t for t in (before, now, until) if t is not None), default=None)
        results, keep, cached = self.step(carried, batch, before, now)
        results.write.mode("overwrite").parquet(f"{self.folder}/run={self.run}/results/_batch={batch_id}")
        keep.write.mode("overwrite").parquet(self._slot("carried", batch_id))
        clock = spark.range(1).select(F.lit(now).cast("bigint").alias("clock"))
        clock.write.mode("overwrite").parquet(self._slot("clock", batch_id))
        for frame in (batch, *cached):
            frame.unpersist()

    def start(self, stream, checkpoint, trigger=None, mode="append"):
        if needed := getattr(self.step, "columns", None):
            stream = stream.select(*dict.fromkeys([*needed, self.ct]))
        self.run, self.columns = run_of(checkpoint), stream.schema
        writer = stream.writeStream.foreachBatch(self).outputMode(mode).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "3 seconds"})).start()

    def drain(self, spark):
        """After a bounded stream has ended: one more batch without rows, past the end of time, gives out what
        is still open. A stream that may go on must not be drained."""
        if self.last is not None:
            self(spark.createDataFrame([], self.columns), self.last + 1, END_OF_TIME)

    def results(self, spark):
        return _results(spark, self.folder, self.run)


def results_of(spark, folder, checkpoint):
    """What the query with this checkpoint has written to a folder."""
    return _results(spark, folder.rstrip("/"), run_of(checkpoint))


def _results(spark, folder, run):
    return spark.read.parquet(f"{folder}/run={run}/results").drop("_batch")
