"""Hourly landing of messages and records, and compaction of the landed files."""

import os
import re
import sys
import uuid
from functools import partial

import numpy as np
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from orderflow.operators.ordered import running_sums, tie_break
from orderflow.session import folders_in, local_path, moved_folders

# Workers get this module's code with the job, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Layout of the hour buckets.
BUCKET = "yyyyMMddHH"
COMMITTER = "mapreduce.fileoutputcommitter.algorithm.version"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTED_BY_DRIVER = "spark.sql.sources.parallelPartitionDiscovery.threshold"
DEFAULT_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
LINE_END = r"\r\n|\r|\n"
# Files filled to at most so many bytes are read whole.
WHOLE_BYTES = 1 << 20
PLACE = "/bucket=([^/]*)/file=([0-9]+)/[^/]*$"


def with_bucket(rows, ts=None):
    """Adds the hour bucket of a timestamp column, or of the processing time."""
    moment = F.current_timestamp() if ts is None else F.col(ts)
    return rows.withColumn("bucket", F.date_format(moment, BUCKET))


def land_stream(rows, path, checkpoint, form="parquet", trigger=None, rows_per_file=1_000_000):
    """Streams bucketed rows into hour folders; `form="text"` takes one text column.

    No shuffle: each task writes the hours it sees. A file ends with its micro-batch or after
    `rows_per_file` rows; `compact` joins small files up later.
    """
    writer = (
        rows.writeStream.format(form)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("bucket")
        .outputMode("append")
    )
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def land(rows, path, form="parquet", rows_per_file=1_000_000):
    """Batch form; hours without rows in it stay as they are. The rebalance hint packs small hours together and
    cuts a big hour into several tasks."""
    writer = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy("bucket").format(form).save(path)


def compact(spark, path, out, form="parquet", buckets=None, rows_per_file=1_000_000):
    """Rewrites landed hours (all, or the given ones) into few files below `out`."""
    rows = spark.read.format(form).load(path)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").cast("string").isin(*buckets))
    land(rows, out, form, rows_per_file)


def packed_lines(lines, target_bytes, order=()):
    """Lines (`bucket`, `value`) with the number `file` of the file they go to: the files of an hour are filled one
    after the other up to about `target_bytes`, counted with line ends. Bytes are summed along the hour over evenly
    cut slices, so an hour with most of the lines is spread. A line belongs to the file in which it begins, so a file is at most one
    line longer than the target; null lines are empty. Without `order` lines are placed by their hash."""
    sized = lines.withColumn("_size", F.octet_length(F.coalesce("value", F.lit(""))) + 1)
    sized = sized.withColumn("_tie", tie_break(lines))
    placed = running_sums(sized, ["bucket"], [*order, "_tie"], {"_sum": F.col("_size")})
    first = F.col("_sum") - F.col("_size")
    return placed.withColumn("file", F.floor(first / target_bytes).cast("int")).drop("_size", "_sum", "_tie")


def _folder(bucket, file):
    """The path below the landing folder, with Spark's names for partitions."""
    name = ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", bucket) if bucket else DEFAULT_FOLDER
    return f"bucket={name}/file={file}"


def _write_files(batches, staged, run):
    """Writes lines sorted by `bucket` and `file`. A file is filled under the name of the attempt and then put in its
    place whole, so a task that is tried again replaces its files."""
    task = TaskContext.get()
    name = f"part-{task.partitionId():05d}-{run}.txt"
    begun, place, sink = f"{staged}/_{name}-{task.taskAttemptId()}", None, None

    def put():
        sink.close()
        folder = f"{staged}/{_folder(*place)}"
        os.makedirs(folder, exist_ok=True)
        os.replace(begun, f"{folder}/{name}")

    for batch in batches:
        if not batch.num_rows:
            continue
        buckets, lines, files = batch.column("bucket"), batch.column("value"), batch.column("file").to_numpy()
        codes = buckets.dictionary_encode(null_encoding="encode").indices.to_numpy()
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(codes) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(files)]):
            here = buckets[int(start)].as_py(), int(files[start])
            if here != place:
                if sink:
                    put()
                place, sink = here, open(begun, "wb")
            sink.write(b"".join(line + b"\n" for line in lines.slice(start, end - start).to_pylist()))
    if sink:
        put()
    yield from ()


def land_packed(lines, path, target_bytes=128 << 20, order=()):
    """Writes lines as text files of about `target_bytes` below their hour, one folder `file=<number>` for each. An
    hour that is written again is replaced.

    Tasks put their files into a hidden folder below the path; the driver then moves whole hours, not files. In a mounted file
    system tasks write with Python's own file calls: without its native library Hadoop starts a process for each
    file and folder it makes there. Other stores are written by Spark."""
    spark, run = lines.sparkSession, uuid.uuid4().hex
    staged = f"{path.rstrip('/')}/_landing-{run}"
    placed = packed_lines(lines, target_bytes, order).select("bucket", "file", "value").repartition("bucket", "file")
    mounted = local_path(spark, staged)
    if mounted:
        os.makedirs(mounted)
        text = F.coalesce("value", F.lit("")).cast("binary").alias("value")
        rows = placed.select(F.nullif(F.col("bucket").cast("string"), F.lit("")).alias("bucket"), "file", text)
        written = rows.sortWithinPartitions("bucket", "file").mapInArrow(partial(_write_files, staged=mounted, run=run), "file int")
        written.write.format("noop").mode("overwrite").save()
    else:
        placed.write.option(COMMITTER, 2).partitionBy("bucket", "file").text(staged)
    moved_folders(spark, staged, path)


def read_packed(spark, path, target_bytes=128 << 20):
    """The lines of packed files with `bucket` and `file`, and the file's metadata. Hours are listed by tasks of one
    job.

    Files filled to a small `target_bytes` are read whole and cut into lines, their folders named by their paths: the
    text source copies Hadoop's settings for each file, one task at a time, and looking for partitions takes the driver a
    time that grows with the square of the folders."""
    hours = [f for f in folders_in(spark, path) if f.rsplit("/", 1)[-1].startswith("bucket=")]
    before = {c: spark.conf.get(c) for c in (LISTING, LISTED_BY_DRIVER)}
    spark.conf.set(LISTING, str(min(int(before[LISTING]), 4 * spark.sparkContext.defaultParallelism)))
    spark.conf.set(LISTED_BY_DRIVER, "0")
    try:
        if hours and target_bytes > WHOLE_BYTES:
            return spark.read.schema("value string, bucket string, file int").option("basePath", path).text(hours)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(hours or path)
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    name = F.url_decode(F.replace(F.regexp_extract("path", PLACE, 1), F.lit("+"), F.lit("%2B")))
    bucket, file = F.nullif(name, F.lit(DEFAULT_FOLDER)), F.regexp_extract("path", PLACE, 2).cast("int")
    # one character a byte, so that cutting keeps any bytes as they are
    text = F.regexp_replace(F.decode("content", "ISO-8859-1"), rf"(?:{LINE_END})\z", "")
    texts = files.filter("length > 0").select(
        F.split(text, LINE_END).alias("lines"), bucket.alias("bucket"), file.alias("file"), "_metadata"
    )
    lines = texts.select(F.explode("lines").alias("value"), "bucket", "file", "_metadata")
    return lines.withColumn("value", F.encode("value", "ISO-8859-1").cast("string"))


def compact_packed(spark, path, out, target_bytes=128 << 20, buckets=None):
    """Rewrites landed hours of text lines (all, or the given ones) into files of about `target_bytes`."""
    rows = spark.read.schema("value string, bucket string").text(path)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(*buckets))
    land_packed(rows, out, target_bytes)
