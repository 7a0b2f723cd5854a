"""Upserts by key into a folder of parquet files.

Each micro-batch of a run adds one `_run=<run>/_batch=<id>` folder with its last row per key; a replayed
batch writes the same folder again, so nothing is applied twice, and another run never writes over it. Batch 0 of a
run removes what an earlier run with the same checkpoint path has left.
Readers take the row with the greatest version per key, of equals the one written by the later batch.
"""

import hashlib

from pyspark.sql import functions as F

from orderflow.session import cleared


def run_of(checkpoint):
    """The run that a checkpoint stands for: a query restarted from it goes on with the same folders."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


class KeyedTable:
    """`version` names the column, or columns, that tell the newer of two rows of a key.

    With `merge` rows are merged field by field: each field keeps its value of the newest row that set it, and its
    version is stored beside it, so that a field set long ago does not gain by a later row without it.
    """

    def __init__(self, path, key, version):
        self.path, self.key = path.rstrip("/"), key
        self.version = [version] if isinstance(version, str) else list(version)
        if not self.version:
            raise ValueError("a keyed table needs a version column")

    def _newest(self, rows, late=()):
        rest = [c for c in rows.columns if c not in (self.key, "_run", "_batch")]
        order = F.struct(*self.version, *late)
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(self.key, "r.*")

    def _merged(self, rows, late=()):
        """Per key each field with the version it was set at, as `_at_<field>`."""
        at = [c for c in rows.columns if c.startswith("_at_")]
        fields = [c for c in rows.columns if c not in (self.key, "_run", "_batch", *at)]
        parts = []
        for c in fields:
            own = F.struct(*self.version)
            set_at = F.coalesce(f"_at_{c}", own) if f"_at_{c}" in at else own
            known = F.when(F.col(c).isNotNull(), F.struct(set_at, *late))
            parts += [F.max_by(c, known).alias(c), F.max(F.when(F.col(c).isNotNull(), set_at)).alias(f"_at_{c}")]
        return rows.groupBy(self.key).agg(*parts)

    def write(self, rows, batch_id, merge=False, run="0"):
        """Stores the newest row per key of a batch; rows without a key are left out."""
        keyed = rows.filter(F.col(self.key).isNotNull())
        last = self._merged(keyed) if merge else self._newest(keyed)
        last.write.mode("overwrite").parquet(f"{self.path}/_run={run}/_batch={batch_id}")

    def _current(self, spark, merge):
        rows = spark.read.parquet(self.path)
        late = ("_batch", F.col("_run").cast("string").alias("_run"))
        return self._merged(rows, late) if merge else self._newest(rows, late)

    def read(self, spark, merge=False):
        """The current row of every key."""
        rows = self._current(spark, merge)
        return rows.drop(*[c for c in rows.columns if c.startswith("_at_")])

    def compact_to(self, spark, path, merge=False):
        """Writes the current rows to a fresh folder, as the first batch of a new table."""
        fresh = KeyedTable(path, self.key, self.version)
        self._current(spark, merge).write.mode("errorifexists").parquet(f"{fresh.path}/_run=base/_batch=-1")
        return fresh

    def sink(self, checkpoint, merge=False):
        """A function for `foreachBatch` of the query with this checkpoint."""
        run = run_of(checkpoint)

        def put(rows, batch_id):
            if batch_id == 0:
                cleared(rows.sparkSession, f"{self.path}/_run={run}")
            self.write(rows, batch_id, merge, run)

        return put
