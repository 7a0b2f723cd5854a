"""What several operators of this subpackage share."""

import ctypes
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from orderflow.session import new_folder

# What separates words in the size and rule contracts.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tell_workers(spark):
    """Tells Python workers where this package is. That serves sessions started from another folder; to a
    cluster whose machines do not have it there, ship it with --py-files."""
    root, known = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark, folder, name):
    tell_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows, name, **options):
    """The rows written once to the shared folder and read back: later uses do not work them out
    again, and a lost executor costs a read only. `options` are the writer's."""
    path = new_folder(rows.sparkSession, f"llm-{name}")
    rows.write.options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def filled(text="text"):
    return F.coalesce(F.col(text), F.lit(""))


def blank_words(text):
    """The words of a text column: runs of anything but space, tab, line ends and feeds."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def ascii_lower(text):
    return F.translate(text, UPPER, LOWER)


def text_list(values):
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def remainder_of_id(ids, by):
    """crc32 of the id as text, modulo `by`; null ids count as the empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % by


def freed(work):
    """A function of record batches that gives memory back to the machine when a task ends: worker processes
    live on and would keep the most that any task took."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library only
            if trim:
                trim(0)

    return run
