import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderflow.llm import bytewords, repair

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start long, n_ids string"


def brute(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, repair.END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_odd_texts(spark):
    texts = [
        "", "  ", None, "a\tb c\x0bd", "x<|endoftext|>y zÉcole é ́x", "\x1c\x1dfoo\x85bar ΣΑΣ İ",
        "don't we'll\n\n12 3½ 漢字12", "the cat sat. " * 3000, "same", "same",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, "a tie"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)
    got = repair.decoded(repair.stored(docs, PATH)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    shards = repair.stored(docs.repartition(7), PATH, shard_ids=3000)
    got = sorted((tuple(r) for r in repair.decoded(shards).collect()), key=lambda r: r[1])
    assert got == brute(rows)
    image = bytes(shards.orderBy(F.desc("n_ids")).first()["data"])
    whole = repair.expanded(repair.parsed(image))
    for begin in range(0, len(whole), 701):
        assert (repair.ids_between(image, begin, begin + 90) == whole[begin : begin + 90]).all()


def colliding():
    """Two different words of 1 024 letters with one polynomial hash modulo a power of two."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def test_words_with_one_hash_keep_their_own_ids(spark):
    one, other = colliding()
    data = np.frombuffer((one + other).encode(), np.uint8)
    assert len(set(bytewords.hashes(data, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 1
    rows = [(1, f"x {one} y {other}"), (2, other), (3, one), (4, "plain words"), (5, f"{one} {one} {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((tuple(r) for r in repair.decoded(repair.stored(docs, PATH)).collect()), key=lambda r: r[1])
    assert got == brute(rows)


def test_known_words_are_compared_too():
    one, other = colliding()
    coder = repair.WordEncoder(PATH)
    for text in (f"a {one} b", f"c {other}", f"{one} {other}", "a b c"):
        ids, bounds = coder.encode(pa.array([text, text]))
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and bounds.tolist() == [0, len(want), 2 * len(want)]


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert repair.decoded(repair.stored(docs, PATH)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_grammar_gives_back_what_it_took(seed):
    rng = np.random.default_rng(seed)
    documents = [rng.integers(0, 2 + seed, rng.integers(1, 400)).astype(np.uint32) for _ in range(30)]
    image = repair.shard_image(list(range(30)), documents, 10)
    shard = repair.parsed(image)
    assert (repair.expanded(shard) == np.concatenate(documents)).all()
    if seed < 3:
        assert len(shard["symbols"]) < sum(map(len, documents)) / 2


def test_the_memo_is_bounded_by_bytes_too():
    words = [f"w{k}" + "x" * 300 for k in range(400)] + [f"s{k}" for k in range(400)]
    coder = repair.WordEncoder(PATH, memo_bytes=20_000)
    for at in range(0, 800, 20):
        texts = [" ".join(words[at : at + 20]), words[at // 2], None, words[-1]]
        ids, bounds = coder.encode(pa.array(texts))
        want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
        assert (np.diff(coder.keys.astype(object)) > 0).all() and len(coder.bytes) <= 20_000 + 21 * 310
