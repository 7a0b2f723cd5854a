"""Byte-level BPE by a sentencepiece model that is written from a rank file.

A rank file gives each token's bytes and its rank. The model has one piece for each token: its bytes as characters
U+0100 and up, so that no byte is white space, an end of text or a mark of the library, scored by the negative rank.
With identity normalisation its BPE joins the neighbours of least rank first, leftmost of equals, which is what a
byte-level encoder does. Piece numbers are ranks. A text is cut by the pattern, each different cut (pre-token) is
encoded once and remembered; decoding maps pieces back to bytes.

Defined results: a null text is the empty text and has no ids; a text is taken whole, whatever its length or the
length of one pre-token; rows stay as they are, repeated ones too; ids of rows may be null or of any type; other
columns are not read; no rows give no rows.
"""

import base64
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from orderflow.llm.bytewords import pieces
from orderflow.llm.common import filled, freed

# Fields and kinds of the model's wire format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, BPE = 1, 2, 2
# Characters of pre-tokens that a worker remembers; beyond it begins anew, which changes nothing but time.
MEMO_CHARS = 2_000_000
TO_MARKS = {b: 0x100 + b for b in range(256)}
FROM_MARKS = {0x100 + b: b for b in range(256)}


def ranks_of(path):
    """Tokens of a rank file in the order of their ranks, which are 0, 1, 2, and so on."""
    with open(path, "rb") as file:
        found = [line.split() for line in file if line.strip()]
    tokens = [None] * len(found)
    for token, rank in found:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def marked(data):
    """Bytes as characters of the model."""
    return data.decode("latin-1").translate(TO_MARKS)


def unmarked(piece):
    """Characters of the model as bytes."""
    return piece.translate(FROM_MARKS).encode("latin-1")


def _number(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number, value):
    """A field of the wire format: an int, a float or bytes."""
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    if isinstance(value, float):
        return _number(number << 3 | 5) + struct.pack("<f", value)
    return _number(number << 3 | 2) + _number(len(value)) + value


def serialised(tokens):
    """A BPE model whose piece k is token k; the unknown piece that a model must have comes last."""
    def piece(text, score, kind):
        return _field(PIECES, _field(1, text.encode()) + _field(2, score) + _field(3, kind))

    parts = [piece(marked(token), -float(rank), NORMAL) for rank, token in enumerate(tokens)]
    parts.append(piece("<unk>", 0.0, UNKNOWN))
    parts.append(_field(TRAINER, _field(3, BPE)))
    # identity: no prefix added, no blanks removed or escaped
    parts.append(_field(NORMALIZER, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(parts)


class ByteEncoder:
    """Texts to ids and back, for one rank file and pattern."""

    def __init__(self, path, pattern, memo=MEMO_CHARS):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=serialised(ranks_of(path)))
        self.tokens = [unmarked(self.model.id_to_piece(k)) for k in range(self.model.get_piece_size() - 1)]
        self.cut, self.memo, self.known, self.held = regex.compile(pattern).findall, memo, {}, 0

    def encode(self, text):
        """The ids of a text as little-endian unsigned 32-bit integers."""
        words = self.cut(text)
        if self.held > self.memo:
            self.known, self.held = {}, 0
        known = self.known
        new = [w for w in set(words) if w not in known]
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            found = self.model.encode([marked(w.encode()) for w in part], num_threads=1)
            known.update(zip(part, map(tuple, found)))
        self.held += sum(map(len, new))
        return np.fromiter(chain.from_iterable(map(known.__getitem__, words)), dtype="<u4").tobytes()

    def decode(self, ids):
        """The bytes of ids in the form that `encode` gives."""
        tokens = self.tokens
        return b"".join([tokens[k] for k in np.frombuffer(ids, "<u4").tolist()])


_ENCODERS = {}


def byte_encoder(path, pattern):
    """One encoder for each worker process and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, pattern] = ByteEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encoded(docs, ranks, pattern, id="doc_id", text="text"):
    """Per row: doc_id, n_tokens and ids (little-endian unsigned 32-bit). `ranks` is the path of a rank file
    that every executor has."""

    def work(batches):
        coder = byte_encoder(ranks, pattern)
        for batch in batches:
            for piece in pieces(batch, 1):
                ids = [coder.encode(t.as_py()) for t in piece.column(1)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                })

    rows = docs.select(F.col(id).alias("doc_id"), filled(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(freed(work), f"doc_id {kind}, n_tokens bigint, ids binary")


def decoded(ids, ranks, pattern):
    """The bytes that a column of ids, as `encoded` gives them, stands for."""

    @F.arrow_udf("binary")
    def work(column: pa.Array) -> pa.Array:
        coder = byte_encoder(ranks, pattern)
        return pa.array([coder.decode(x.as_py()) for x in column], pa.binary())

    return work(ids)
