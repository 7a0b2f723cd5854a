import random
import re

from orderflow.llm import lsh_forest
from orderflow.llm.components import components

SCHEMA = "doc_id long, text string, class_id string, node int"


def run_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """class and links by comparing all pairs."""
    sets = [run_set(t) for _, t in rows]
    n, parent = len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted(
        (str(r[0]), None if r[0] is None else least[root(i)], links[i]) for i, r in enumerate(rows)
    )


def made(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{k}é" if k % 7 == 0 else f"w{k}" for k in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.6:
            text = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((k, " ".join(text)))
        else:
            text = [rng.choice(words) for _ in range(rng.randrange(20, 300))]
            rows.append((k, " ".join(text + (passage if rng.random() < 0.3 else []))))
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    got = lsh_forest.near_duplicates(docs, **options).collect()
    return sorted((str(r["doc_id"]), r["class_id"], r["n_links"]) for r in got)


def test_same_as_all_pairs(spark):
    rows = made(1)
    assert found(spark, rows, block=8) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, "One two, THREE four five six"), (9, "one two three four five six!"), (5, "One two, THREE four five six"),
        (1, ""), (2, None), (3, " .,; "), (4, "two words"), (6, "two  words"), (7, "other words"),
        (None, "two words"), (None, None), (8, "lang wort " * 40_000), (10, "lang wort " * 40_001),
    ]
    assert found(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == []


def test_shortens_prefixes_until_the_target(spark):
    rows = made(2)
    assert found(spark, rows, target=2.0) == brute(rows)


def test_components_of_a_long_path(spark):
    path = [(k, k + 1) for k in range(0, 300, 2)] + [(k + 1, k) for k in range(1, 300, 2)] + [(900, 901), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(301)} | {900: 900, 901: 900}


def test_a_large_group_does_not_lower_the_recall_of_others(spark):
    """One group of near copies, and pairs of about 0.81 that have only each other."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(20_000)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(k, " ".join([*base, *(rng.choice(words) for _ in range(3))])) for k in range(150)]
    for k in range(300):
        text = [rng.choice(words) for _ in range(204)]
        # 200 runs each, of which 22 differ: 178 of 222 are shared
        other = list(text)
        for at in (30, 60, 90, 120):
            other[at] = "changed" + str(k)
        other[203] = other[202] = "end"
        rows += [(1000 + 2 * k, " ".join(text)), (1001 + 2 * k, " ".join(other))]
    got = {d: n for d, _, n in found(spark, rows)}
    want = {d: n for d, _, n in brute(rows)}
    pairs = [d for d in want if int(d) >= 1000]
    assert sum(want[d] for d in pairs) == 600
    assert sum(got[d] for d in pairs) >= 0.995 * 600 - 4 and all(got[d] == want[d] for d in want if int(d) < 1000)


def test_depth_holds_the_target_at_the_threshold():
    for similarity in (0.5, 0.7, 0.8, 0.9):
        assert lsh_forest.chance(similarity, lsh_forest.fitting(similarity)) >= lsh_forest.TARGET


def test_copies_have_equal_words_not_equal_hashes(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: "b", 98: "a"})
    other = word.translate({97: "b", 98: "a"})
    rows = [(1, word), (2, other), (3, f"  {word.upper()}!"), (4, "one, two"), (5, "(One) two?"), (6, "onetwo"), (7, "?!")]
    found = lsh_forest.signed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 6).collect()
    prints = {r["doc_id"]: r["print"] for r in found}
    assert prints[1] == prints[3] != prints[2] and prints[4] == prints[5] != prints[6] and prints[7] is None


def test_recall_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = {d: n for d, _, n in found(spark, rows)}
    want = {d: n for d, _, n in brute(rows)}
    assert sum(got.values()) >= 0.99 * sum(want.values()) > 0 and all(got[d] <= want[d] for d in want)
