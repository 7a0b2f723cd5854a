import itertools

import numpy as np
import pyarrow as pa
import pytest

from orderflow.llm import line_crf, queries, toxicity
from orderflow.llm.common import table

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, label int"


def held_out(spark, name, label):
    scores = queries.QUERIES[name](spark, FOLDER).where("held_out")
    rows = scores.join(table(spark, FOLDER, "labels"), "doc_id").select("predicted", label).collect()
    return np.array([tuple(r) for r in rows])


def test_quality_on_held_out_rows(spark):
    found = held_out(spark, "op2_quality_classifier", "quality")
    assert (found[:, 0] == found[:, 1]).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    found = held_out(spark, "op6_toxicity", "toxic")
    assert (found[:, 0] == found[:, 1]).mean() > 0.93


@pytest.mark.parametrize("seed", range(4))
def test_marginals_by_enumeration(seed):
    rng = np.random.default_rng(seed)
    first = np.array([0, 1, 5, 8])
    potential, change = rng.normal(size=8), rng.normal(size=(2, 2))
    marginal, _, pairs = line_crf.forward_backward(potential, change, first)
    want_pairs = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        total, good, both = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=b - a):
            steps = list(zip(labels[:-1], labels[1:]))
            weight = np.exp(sum(potential[a + k] * y for k, y in enumerate(labels)) + sum(change[s] for s in steps))
            total += weight
            good += weight * np.array(labels)
            for s in steps:
                both[s] += weight
        assert np.allclose(marginal[a:b], good / total)
        want_pairs += both / total
    assert np.allclose(pairs, want_pairs)


def test_lines_of_odd_texts():
    own, sizes, first = line_crf.lines(pa.array(["a b\nc", None, "", "X\n\nY\n", None, "\n", "x x x"]))
    assert first.tolist() == [0, 2, 3, 4, 7, 8, 9, 10]
    assert sizes.tolist() == [4, 1, 0, 0, 2, 1, 2, 0, 1, 5]
    assert not np.isnan(own).any()


@pytest.mark.parametrize("operator", [line_crf.quality, toxicity.toxicity])
def test_odd_rows(spark, operator):
    texts = ["", None, "\n", "a fine line\n" * 40_000, "you are an idiot.", "you are an idiot.", "ÉÑ <|x|> \x00"]
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)] + [(None, "x", "y", None)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, score double")
    some = spark.createDataFrame([(k, k % 2, k % 2, 0.5) for k in range(7)] * 2 + [(None, 1, 1, None), (5, None, None, 1.0)],
                                 "doc_id long, quality int, toxic int, score double")
    for labels in (none, some):
        rows = operator(docs, labels).collect()
        assert len(rows) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in rows)
        by = {r["doc_id"]: r["score"] for r in rows}
        assert by[0] == by[1] and by[4] == by[5]
    assert operator(docs.limit(0), some).collect() == []
    kept = operator(docs, some, keep=docs.columns, name="found")
    assert kept.columns == [*docs.columns, "found"] and kept.drop("found").exceptAll(docs).count() == 0


def test_contexts_of_clauses():
    insult, other, target, negation, report, threat = (
        toxicity.INSULT, toxicity.OTHER, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.THREAT)
    cases = [
        ([insult], [1, 0, 0, 0, 0]),
        ([target, other, insult], [0, 1, 0, 0, 0]),
        ([insult, target], [0, 1, 0, 0, 0]),
        ([negation, other, insult], [0, 0, 1, 0, 0]),
        ([negation, other, other, other, insult], [1, 0, 0, 0, 0]),
        ([target, report, other, insult], [0, 0, 0, 1, 0]),
        ([threat, target], [0, 0, 0, 0, 1]),
        ([threat, other, other, other, target], [0, 0, 0, 0, 0]),
    ]
    for symbols, want in cases:
        assert toxicity.matched(symbols, [1.0 if s == insult else 0.0 for s in symbols]) == want, symbols


def test_a_matched_clause_counts_not_the_word(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "he said: you. not an idiot"), (3, "nothing here")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, none).collect()}
    assert score[1] > score[2] > 0 and score[1] > score[3]


@pytest.mark.parametrize("times", [1, 2])
def test_rare_insults_are_learned_at_any_size(spark, times):
    """600 insults in 5 toxic texts each and in no other, in samples of 1 500 and 3 000 texts."""
    rows = []
    for k in range(1500 * times):
        words = [f"w{(k * 31 + j * 7) % 400}" for j in range(20)]
        toxic = int(k % 10 == 0)
        if toxic:
            words += [f"{(k // 10 * 20 + j) % (600 * times)}zz" for j in range(20)]
        rows.append((" ".join(words), toxic))
    found = toxicity.learned_lexicon(spark.createDataFrame(rows, "text string, label int"))
    rare = toxicity._key_of([f"{k}zz" for k in range(600 * times)]).view(np.int64).tolist()
    plain = toxicity._key_of([f"w{k}" for k in range(400)]).view(np.int64).tolist()
    assert all(k in found for k in rare) and not any(k in found for k in plain)


def test_no_entry_by_chance_alone():
    cells = [(1, 0, 900), (0, 1, 8100), (2, 0, 90), (1, 1, 1620), (0, 2, 7290)]
    assert toxicity.passing(cells, 1000, 9000) == {}
