"""Session set-up for local runs and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, memory="8g", app="orderflow"):
    """A session for tests and benchmarks; on a cluster use the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark):
    """The folder every executor can reach: `spark.checkpoint.dir`. A local session may do without, and gets a
    temporary folder; elsewhere a folder of one machine would lose data, so that is an error."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is None and not _is_local(context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="orderflow-"))
    return configured or os.path.dirname(context.getCheckpointDir())


def _is_local(master):
    return master == "local" or master.startswith("local[")


def new_folder(spark, name):
    """An unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows, name):
    """The rows written once to the shared folder and read back, for operators that read them more than once."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def cleared(spark, path):
    """Removes a folder of the shared store, if it is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def local_path(spark, path):
    """The path as Python's file calls take it, if it is on a mounted file system; else None."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def folders_in(spark, path):
    """The paths of the folders in a folder of the shared store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in store.listStatus(where) if f.isDirectory()]


def moved_folders(spark, source, target):
    """Moves the folders in `source` to `target`, each in place of the one of its name; `source` is removed."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    store = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in store.listStatus(source):
        if found.isDirectory():
            place = jvm.org.apache.hadoop.fs.Path(target, found.getPath().getName())
            store.delete(place, True)
            if not store.rename(found.getPath(), place):
                raise OSError(f"{found.getPath()} was not moved to {place}")
    store.delete(source, True)
