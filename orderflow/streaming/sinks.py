"""Starting streaming queries into the usual sinks."""

from orderflow.streaming.keyed_table import KeyedTable

# How often a batch is started.
INTERVAL = {"processingTime": "3 seconds"}


def _writer(rows, checkpoint, mode, trigger):
    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or INTERVAL))


def to_kafka(rows, servers, topic, checkpoint, mode="append", trigger=None):
    """Key and value to a topic, at least once. Needs the spark-sql-kafka package on the cluster."""
    writer = _writer(rows.select("key", "value"), checkpoint, mode, trigger).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def to_keyed_table(rows, path, key, checkpoint, version, mode="append", merge=False, trigger=None):
    """Upserts by key; returns the query and the table."""
    table = KeyedTable(path, key, version)
    return _writer(rows, checkpoint, mode, trigger).foreachBatch(table.sink(checkpoint, merge)).start(), table


def to_files(rows, path, checkpoint, form="parquet", trigger=None):
    """Appends rows to files, exactly once."""
    return _writer(rows, checkpoint, "append", trigger).format(form).option("path", path).start()


def to_console(rows, checkpoint, mode="append", trigger=None, shown=20):
    return _writer(rows, checkpoint, mode, trigger).format("console").option("numRows", shown).start()
