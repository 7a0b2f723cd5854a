"""Fixity audit of record archives by Merkle trees.

Each record has a digest. Records are ordered by id; a node covers the ids that share id // FANOUT**level, so
its children are consecutive stretches of records and, in a file, consecutive offset ranges. A node's hash
covers its children's hashes, record counts and bytes in order. Two replicas are compared by their roots;
only below nodes that differ the children are compared, down to the records.

A file of an archive holds the records of FILE_SPAN ids. A finding carries the file, and the offset and
length that the record has in the first replica.

Defined results: records with equal ids form one leaf, whatever their order; records without an id
form a leaf of their own, in no file; equal replicas and two empty ones give no findings; a replica without
records lacks all of the other's; only id and payload are read.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.llm.common import written

FANOUT = 16
FILE_SPAN = FANOUT**3
LEVELS = 17  # 16**16 covers every 64-bit id
_NONE = -(2**63)


def warc_record(uri, body):
    """The bytes of a response record as text; nulls are empty."""
    uri, body = F.coalesce(uri, F.lit("")), F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Length: "))
    return F.concat(head, F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _over(node, size):
    """The number of the stretch of `size` ids that an id is in, in whole numbers."""
    return F.call_function("div", node - F.pmod(node, F.lit(size)), F.lit(size))


def leaves(records, id, payload):
    """One row per id: hash, records and bytes."""
    rows = records.select(
        F.coalesce(F.col(id).cast("bigint"), F.lit(_NONE)).alias("node"),
        F.sha2(F.coalesce(payload, F.lit("")).cast("binary"), 256).alias("digest"),
        F.octet_length(F.coalesce(payload, F.lit(""))).cast("bigint").alias("size"),
    )
    # records of one id are combined without order, so that an id with many records is no large group
    rows = rows.groupBy("node", "digest", "size").agg(F.count("digest").alias("times"))
    parts = [F.bit_xor(F.xxhash64(F.lit(k), "digest", "times")).cast("string") for k in range(4)]
    records = F.sum("times")
    return rows.groupBy("node").agg(
        F.sha2(F.concat_ws(":", *parts, records), 256).alias("hash"), records.alias("records"),
        F.sum(F.col("times") * F.col("size")).alias("bytes"),
    )


def parents(level):
    """The next level: at most FANOUT children each."""
    children = F.sort_array(F.collect_list(F.struct("node", "hash", "records", "bytes")))
    return level.groupBy(_over(F.col("node"), FANOUT).alias("node")).agg(
        F.sha2(F.to_json(children), 256).alias("hash"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes")
    )


class Tree:
    """The levels of a replica, records first; each is written once."""

    def __init__(self, records, id, payload):
        self.levels = [written(leaves(records, id, payload), "leaves")]

    def level(self, k):
        while len(self.levels) <= k:
            self.levels.append(written(parents(self.levels[-1]), "level"))
        return self.levels[k]


def _differing(one, other):
    sides = [t.select("node", F.struct("hash", "records", "bytes").alias(n)) for t, n in ((one, "a"), (other, "b"))]
    joined = sides[0].join(sides[1], "node", "full")
    return joined.where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))


def _height(tree, other):
    """The first level with at most FANOUT nodes in both trees: its nodes are the roots compared."""
    k = 0
    while k < LEVELS and any(t.level(k).limit(FANOUT + 1).count() > FANOUT for t in (tree, other)):
        k += 1
    return k


def audit(first, second, id, payload):
    """Findings: id, kind (changed, missing from the second, extra there), file, offset and length in the
    first, and the nodes compared to get there are only those below differing ones."""
    one, other = Tree(first, id, payload), Tree(second, id, payload)
    height = _height(one, other)
    found = written(_differing(one.level(height), other.level(height)), "differing")
    for k in range(height - 1, -1, -1):
        above = found.select(F.col("node").alias("up"))
        below = [t.level(k).join(above, _over(F.col("node"), FANOUT) == F.col("up"), "left_semi")
                 for t in (one, other)]
        found = written(_differing(*below), "differing")
    file = F.when(F.col("node") != _NONE, _over(F.col("node"), FILE_SPAN))
    found = found.withColumn("file", file)
    files = found.select(F.col("file").alias("f")).distinct()
    placed = one.level(0).withColumn("file", file).join(files, F.col("file") == F.col("f"), "left_semi")
    before = W.partitionBy("file").orderBy("node").rowsBetween(W.unboundedPreceding, -1)  # of FILE_SPAN ids at most
    placed = placed.select(F.col("node").alias("n"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    more = F.coalesce("b.records", F.lit(0)) - F.coalesce("a.records", F.lit(0))
    kind = F.when(more > 0, "extra").when(more < 0, "missing").otherwise("changed")
    return found.join(placed, F.col("node") == F.col("n"), "left").select(
        F.when(F.col("node") != _NONE, F.col("node")).alias("id"), kind.alias("kind"), "file", "offset",
        F.col("a.bytes").alias("length"),
    )
