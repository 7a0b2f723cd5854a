import itertools
import random

import pytest
from pyspark.sql import functions as F

from orderflow.llm import queries, source_mix
from orderflow.llm.common import table

SCHEMA = "doc_id long, text string, source string, size int, _size string"


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, capped, total = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2.0 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("folder, off", [("sf0.001", 0.2), ("sf0.01", 0.02)])
def test_given_documents(spark, folder, off):
    folder = f"/root/testdata/{folder}"
    docs = table(spark, folder, "documents").select("doc_id", "text", "source").collect()
    size = {r["doc_id"]: len([w for w in (r["text"] or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]) for r in docs}
    source = {r["doc_id"]: r["source"] for r in docs}
    sums, taken = {}, {}
    for d, s in source.items():
        sums[s] = sums.get(s, 0) + size[d]
    want = brute_targets(sums)
    rows = queries.op10_source_mix(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sums[s])
        assert r["target"] == pytest.approx(want[s]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sums:
        assert taken[s] == pytest.approx(want[s], rel=off)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op10_source_mix(spark, folder).collect()))


def test_odd_rows(spark):
    rows = [
        (1, None, None), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z z z", "a"), (None, None, "é"),
        (5, "w " * 50_000, "b"), (6, "one\ttwo\nthree", "b"),
    ] + [(k, "p q r", "hot") for k in range(10, 60)]
    docs = spark.createDataFrame([(*r, 3, "clash") for r in rows], SCHEMA)
    got = source_mix.mixture(docs).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert source_mix.mixture(docs.limit(0)).collect() == []
    whole = source_mix.mixed_documents(docs)
    assert whole.columns == docs.columns
    assert whole.select(F.sum(F.size(F.filter(F.split("text", r"[ \t\n]+"), lambda w: w != "")))).first()[0] == sum(r["taken"] for r in got)
    assert source_mix.mixed_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_cheapest_flow(seed):
    """Against all ways to route small integer amounts."""
    rng = random.Random(seed)
    capacity = {p: rng.randrange(0, 4) for p in (("a",), ("a", "b"), ("b",))}
    wanted = {"a": rng.randrange(0, 6), "b": rng.randrange(0, 6)}
    flow = source_mix.routed(capacity, wanted)

    def worth(f):
        """Words routed, and what repeats cost; None where not allowed."""
        out, cost = {}, 0
        for (p, s), n in f.items():
            out[s] = out.get(s, 0) + n
        for p, room in capacity.items():
            n = sum(v for (q, _), v in f.items() if q == p)
            if n > 2 * room:
                return None
            cost += max(0, n - room)
        return None if any(out.get(s, 0) > wanted[s] for s in wanted) else (sum(out.values()), -cost)

    keys = [(p, s) for p in capacity for s in p]
    best = max(w for v in itertools.product(range(7), repeat=len(keys)) if (w := worth(dict(zip(keys, v)))))
    assert worth(flow) == best


def test_overlapping_sources(spark):
    rng = random.Random(1)
    rows = [(k, " ".join("w" * rng.randrange(5, 40)), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "a"], []])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    mix = source_mix.Mix(docs, F.col("source"))
    assert set(mix.members.values()) == {("a",), ("b",), ("a", "b"), ()}
    got = mix.documents(["doc_id", "source"]).select("_row.*", "_size", "_copies").collect()
    taken = {}
    for r in got:
        taken[tuple(sorted(set(r["source"])))] = taken.get(tuple(sorted(set(r["source"]))), 0) + r["_size"] * r["_copies"]
    assert taken.pop(()) == 0
    for p, n in taken.items():
        assert n == pytest.approx(sum(v for (q, _), v in mix.flow.items() if q == p), rel=0.02)
    with pytest.raises(ValueError):
        source_mix.MOST_PATTERNS, before = 2, source_mix.MOST_PATTERNS
        try:
            source_mix.Mix(docs, F.col("source"))
        finally:
            source_mix.MOST_PATTERNS = before


def test_a_long_document_leaves_no_gap_that_others_fill(spark):
    rows = [(k, "w " * (3_000 if k % 200 == 0 else 10 + k % 7), "a" if k % 2 == 0 else "b") for k in range(2800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in (17, 18, 19):
        got = source_mix.mixture(docs, seed=seed).collect()
        for s in "ab":
            part = [r for (_, _, own), r in zip(rows, sorted(got, key=lambda r: r["doc_id"])) if own == s]
            assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 8


def test_many_sources_without_overlap(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "MOST_PATTERNS", 5)
    docs = spark.createDataFrame([(k, "p q r", f"s{k % 40}") for k in range(400)], "doc_id long, text string, source string")
    got = source_mix.mixture(docs).collect()
    assert len(got) == 400 and sum(r["taken"] for r in got) == pytest.approx(1800, rel=0.1)
