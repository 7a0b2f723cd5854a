"""Readers that give one JSON text column named `value`, streaming or batch."""

from pyspark.sql import functions as F


def kafka_lines(spark, servers, topic, start="latest", streaming=True, **options):
    """Message text of a Kafka topic, and its arrival order `seq`.

    Offsets live in the query checkpoint, so a restarted query goes on where it stopped and
    `start` only matters on the first run. Needs the spark-sql-kafka package on the cluster.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    if not streaming and start == "latest":
        start = "earliest"
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
    )
    # `seq` orders the messages of a topic by arrival; the partition only breaks ties of the clock
    arrival = F.struct("timestamp", "partition", "offset").alias("seq")
    return reader.load().select(F.col("value").cast("string").alias("value"), arrival)


def file_lines(spark, path, streaming=True, **options):
    """Lines of text files, one message each."""
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.text(path).select("value")


def decode(lines, schema, value="value"):
    """Typed columns of JSON text whose keys equal the field names of `schema`.

    Numbers may arrive as JSON numbers or as JSON strings. Text that is not JSON gives a row of nulls.
    """
    as_text = ", ".join(f"{f.name} string" for f in schema.fields)
    row = lines.select(F.from_json(F.col(value), as_text).alias("m"))
    return row.select(
        *[F.col(f"m.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def table_stream(spark, folder, table, schema, **options):
    """A parquet table (one file or a folder of files) read as a stream of files."""
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{table}.parquet*")
