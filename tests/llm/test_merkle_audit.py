import random

from pyspark.sql import functions as F

from orderflow.llm import merkle_audit as ma

SCHEMA = "id long, body string, hash string, node int"


def replicas(spark, *tables):
    return [spark.createDataFrame([(i, b, "clash", 1) for i, b in rows], SCHEMA) for rows in tables]


def brute(first, second):
    ids = {i for i, _ in first} | {i for i, _ in second}
    out = set()
    for i in ids:
        a, b = (sorted((x or "") for k, x in rows if k == i) for rows in (first, second))
        if a != b:
            kind = "extra" if len(b) > len(a) else "missing" if len(a) > len(b) else "changed"
            file = None if i is None else i // ma.FILE_SPAN
            inside = [] if i is None else [len((x or "").encode()) for k, x in first if k is not None and k // ma.FILE_SPAN == file and k < i]
            there = bool(a) and i is not None
            out.add((i, kind, file, sum(inside) if there else None, sum(len(x.encode()) for x in a) if a else None))
    return out


def found(one, other):
    return {tuple(r) for r in ma.audit(one, other, "id", F.col("body")).collect()}


def test_finds_every_difference(spark):
    rng = random.Random(2)
    first = [(k, f"é{rng.random()}" * rng.randrange(4)) for k in range(-40, 9000, 3)]
    first += [(50_000, None), (50_000, ""), (60_000, "same"), (60_000, "same"), (2**62, "far"), (None, "x"), (None, "y")]
    second = list(first)
    for at in (0, 5, 700, 1500, len(first) - 8):
        second[at] = (second[at][0], "broken")
    del second[900]
    second += [(10**6, "new"), (60_000, "same"), (None, "z")]
    one, other = replicas(spark, first, second)
    assert found(one, other) == brute(first, second)
    assert found(other, one) == brute(second, first)
    assert found(one, one.repartition(5)) == set()


def test_ids_that_no_double_holds(spark):
    first = [(k, f"body {k}") for at in (2**60, -(2**60), 2**63 - 9000) for k in range(at + 4090, at + 4100)]
    second = [(k, "broken" if k % 4096 in (4090, 4095, 0) else b) for k, b in first]
    one, other = replicas(spark, first, second)
    assert found(one, other) == brute(first, second)


def test_empty_replicas(spark):
    one, none = replicas(spark, [(1, "a"), (2, None)], [])
    assert found(none, none) == set()
    assert {r[:2] for r in found(one, none)} == {(1, "missing"), (2, "missing")}
    assert {r[:2] for r in found(none, one)} == {(1, "extra"), (2, "extra")}


def test_record_bytes(spark):
    row = spark.range(1).select(ma.warc_record(F.lit("u"), F.lit("é")).alias("a"), ma.warc_record(F.lit(None), F.lit(None)).alias("b")).first()
    assert row["a"].endswith("Content-Length: 2\r\n\r\né\r\n\r\n") and "Content-Length: 0" in row["b"]
