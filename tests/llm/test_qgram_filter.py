import random

import numpy as np
import pytest

from orderflow.llm import qgram_filter as qf
from orderflow.llm.common import table


def least_edits(pattern, text):
    """Edits of the best stretch, by the whole table."""
    row = [0] * (len(text) + 1)
    for j, p in enumerate(pattern):
        new = [j + 1]
        for i, t in enumerate(text):
            new.append(min(row[i] + (p != t), row[i + 1] + 1, new[i] + 1))
        row = new
    return min(row)


def brute(rows, items, budget=qf.BUDGET, q=qf.Q):
    out = set()
    for d, text in rows:
        for i, item in items:
            pattern, plain = qf.plain(item), qf.plain(text)
            m = len(pattern)
            if not m:
                continue
            k = min(int(budget * m), (m - q) // q) if m >= q else 0
            n = least_edits(pattern, plain)
            if n <= k:
                out.add((d, i, n))
    return out


def changed(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        text[at : at + 1] = rng.choice([[], ["x"], [text[at], "é"]])
    return "".join(text)


def sentence(rng, n):
    parts = ["the", "er", "ing", "tion", "é", "on", "st", "ou", "nd"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_whole_alignment(spark, seed):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.randrange(8, 25))) for k in range(8)] + [(90, "ab cd"), (91, ""), (92, None), (3, "tionst")]
    rows = []
    for k in range(30):
        text = sentence(rng, rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            item = rng.choice(items[:9])[1]
            text += " " + changed(rng, item, rng.randrange(0, 1 + len(item) // 9)).upper() + "\n " + sentence(rng, 5)
        rows.append((k, text))
    rows += [(40, None), (41, ""), (50, items[0][1]), (50, items[0][1])]
    docs = spark.createDataFrame([(d, t, "x", 2) for d, t in rows], "doc_id long, text string, item_id string, edits int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = brute(rows, items)
    got = qf.leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == want and want
    assert {tuple(r)[:2] for r in qf.leaks(docs, bench, most=60).collect()} == {w[:2] for w in want}
    clean = qf.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in rows if d not in {w[0] for w in want})
    assert qf.leaks(docs.limit(0), bench).collect() == [] and qf.leaks(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_banded_alignment(seed):
    rng = random.Random(seed)
    pattern = sentence(rng, 6)
    window = sentence(rng, 2)[:5] + changed(rng, pattern, rng.randrange(0, 6)) + sentence(rng, 2)[:4]
    limit = rng.randrange(0, 7)
    got, want = qf.aligned(qf.codes(pattern), qf.codes(window), limit), least_edits(pattern, window)
    if want > limit:
        assert got is None
    else:
        assert got[0] == want == least_edits(pattern, window[got[1] : got[2]])


def test_a_long_text(spark):
    rng = random.Random(5)
    item = sentence(rng, 30)
    docs = spark.createDataFrame([(1, sentence(rng, 200_000) + item + sentence(rng, 1000))], "doc_id long, text string")
    bench = spark.createDataFrame([(4, item), (5, sentence(rng, 30))], "item_id long, text string")
    row = qf.leaks(docs, bench).collect()
    assert [(r["item_id"], r["edits"], r["end"] - r["start"]) for r in row] == [(4, 0, len(item))]


def test_planted_passages_are_found(spark):
    folder = "/root/testdata/sf0.001"
    docs, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    want = {
        (d["doc_id"], b["item_id"]) for b in bench.collect() for d in docs.collect() if qf.plain(b["text"]) in qf.plain(d["text"])
    }
    got = {(r["doc_id"], r["item_id"]) for r in qf.leaks(docs, bench).where("edits = 0").collect()}
    assert got == want and want


def test_grams_are_told_apart():
    found = qf.grams(np.arange(1000) % 7, 10)
    assert len(found) == 991 and len(np.unique(found)) == 7
