from collections import Counter

import pytest

import corpus_pipeline as pipeline
from orderflow.llm import line_crf, qgram_filter, queries
from orderflow.llm.common import table
from tests.llm.test_lsh_forest import brute as brute_classes
from tests.llm.test_repair import brute as brute_tokens
from tests.llm.test_source_mix import brute_targets

pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and the last result."""
    docs, out = table(spark, FOLDER, "documents"), []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def blanked(text):
    return (text or "").translate(dict.fromkeys(range(9, 14), " "))


def ids(rows):
    return Counter(r["doc_id"] for r in rows.select("doc_id").collect())


def test_columns_stay(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality(spark, stages):
    scores = line_crf.quality(stages[0], table(spark, FOLDER, "labels")).collect()
    assert ids(stages[1]) == Counter(r["doc_id"] for r in scores if r["score"] >= queries.QUALITY_LIMIT)
    kept = ids(stages[1])
    labels = [tuple(r) for r in table(spark, FOLDER, "labels").select("doc_id", "quality").collect()]
    assert sum((d in kept) == bool(q) for d, q in labels) > 0.9 * len(labels)


def test_near_duplicates(stages):
    rows = [tuple(r) for r in stages[1].select("doc_id", "text").collect()]
    assert ids(stages[2]) == Counter({c for _, c, _ in brute_classes(rows)})


def test_decontamination(spark, stages):
    items = [qgram_filter.plain(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    kept = ids(stages[3])
    leaks = {r["doc_id"] for r in qgram_filter.leaks(stages[2], table(spark, FOLDER, "benchmark")).collect()}
    assert kept == Counter(d for d in ids(stages[2]) if d not in leaks)
    for r in stages[2].collect():
        holds = any(i and i in qgram_filter.plain(r["text"]) for i in items)
        assert not (holds and r["doc_id"] in kept)


def test_mix(stages):
    size = {r["doc_id"]: len([w for w in blanked(r["text"]).split(" ") if w]) for r in stages[3].collect()}
    source = {r["doc_id"]: r["source"] for r in stages[3].collect()}
    sums, taken = Counter(), Counter()
    for d, n in size.items():
        sums[source[d]] += n
    for d, n in ids(stages[4]).items():
        assert n <= 2
        taken[source[d]] += n * size[d]
    for s, want in brute_targets(dict(sums)).items():
        assert abs(taken[s] - want) <= max(0.05 * want, max(n for d, n in size.items() if source[d] == s))


def test_tokens(spark, stages):
    rows = [tuple(r) for r in stages[4].select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in stages[5].collect()), key=lambda r: r[1])
    assert got == brute_tokens(rows)
    assert sorted(map(tuple, pipeline.run(spark, FOLDER).collect())) == sorted(got)


def test_odd_documents(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    odd = [(1, None, None, None, None), (None, "some words here", "en", None, 3), (None, None, None, None, None),
           (2, "", "en", "src0", 0), (5, "again and again it runs", "en", "src0", 9), (5, "again and again it runs", "en", "src0", 9)]
    for rows in ([], odd):
        now = spark.createDataFrame(rows, docs.schema)
        for k, (_, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{len(rows)}-{k}")
            stage(spark, now, FOLDER).write.parquet(path)
            now = spark.read.parquet(path)
            if k < 4:
                assert now.columns == docs.columns
        assert rows or now.count() == 0
