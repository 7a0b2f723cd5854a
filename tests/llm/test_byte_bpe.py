import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from orderflow.llm import byte_bpe, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
COLUMNS = "doc_id long, text string, ids string, n_tokens int, data string"


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(byte_bpe.ranks_of(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteEncoder(RANKS, PATTERN)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def odd_texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("ab \n\t'sreéß中▁Ġ<unk>1 2,.-#\x00 \U0001f600") for _ in range(rng.randrange(200)))
            for _ in range(400)]
    return made + [
        "", " ", "\n\n  x", "<|endoftext|>", "<unk> </s> ▁", "it's we'll I'D", "x" * 50_000, " " * 50_000,
        "ab" * 30_000, "one two " * 20_000, "".join(map(chr, range(1, 3000))),
    ]


def test_every_token_is_its_own_encoding(coder):
    tokens = byte_bpe.ranks_of(RANKS)
    assert coder.tokens == tokens
    assert all(coder.model.encode(byte_bpe.marked(t)) == [k] for k, t in enumerate(tokens))


def test_all_bytes_are_mapped_back():
    data = bytes(range(256))
    assert byte_bpe.unmarked(byte_bpe.marked(data)) == data


def test_same_ids_as_the_library(coder, library):
    for text in odd_texts():
        ids = coder.encode(text)
        assert ids_of(ids) == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_memory_of_words_is_bounded_and_changes_nothing(library):
    small = byte_bpe.ByteEncoder(RANKS, PATTERN, memo=50)
    for text in odd_texts()[:60]:
        assert ids_of(small.encode(text)) == library.encode_ordinary(text)
    small.encode("w " * 10)
    assert small.held < 50 + 4000


def test_rows(spark, library):
    rows = [(k if k % 7 else None, t, "clash", 1, "d") for k, t in enumerate([*odd_texts()[-40:], None, None, "same", "same"])]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    found = byte_bpe.encoded(docs, RANKS, PATTERN).withColumn("data", byte_bpe.decoded(F.col("ids"), RANKS, PATTERN)).collect()
    got = [(r["doc_id"], r["n_tokens"], ids_of(r["ids"]), bytes(r["data"]).decode()) for r in found]
    want = [(r[0], len(library.encode_ordinary(r[1] or "")), library.encode_ordinary(r[1] or ""), r[1] or "") for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ids_may_be_texts_and_tables_empty(spark):
    docs = spark.createDataFrame([("a", "b c")], "doc_id string, text string")
    row = byte_bpe.encoded(docs, RANKS, PATTERN).first()
    assert (row["doc_id"], row["n_tokens"]) == ("a", 2)
    assert byte_bpe.encoded(docs.limit(0), RANKS, PATTERN).collect() == []


def test_whole_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op12_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
