"""Bounded training samples, logistic fits and scoring of whole tables by a trained function."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.bytewords import SMALL, pieces
from orderflow.llm.common import filled, freed, remainder_of_id

_SLOTS = 1_000_000


def training_rows(docs, labels, label, split, held_out, most, id="doc_id", text="text"):
    """`text`, `label` and a `slot` (0 to 999999, by id) of about `most` labelled rows, chosen by a hash of the
    id. Rows whose id has the held-out remainder are never among them."""
    known = labels.where((remainder_of_id(F.col(id), split) != held_out) & F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known.groupBy(F.col(id).cast("bigint").alias("l_id")).agg(F.max(label).cast("int").alias("label"))
    share = min(1.0, most / max(1, known.count()))
    slot = F.pmod(F.xxhash64("l_id"), F.lit(_SLOTS))
    known = known.withColumn("slot", slot).where(F.col("slot") < share * _SLOTS)
    # about `most` rows at any size of the tables
    rows = docs.select(F.col(id).cast("bigint").alias("d_id"), filled(text).alias("text"))
    rows = rows.join(F.broadcast(known), F.col("d_id") == F.col("l_id"))
    return rows.select("text", "label", F.floor(F.col("slot") / max(share, 1e-9)).cast("int").alias("slot"))


def fit_logistic(x, y, penalty=1.0, rounds=50):
    """Weights of a logistic regression; the last one is the constant. Newton steps, damped."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - y * z).sum() + 0.5 * (ridge * w * w).sum()

    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step, size, now = np.linalg.solve(bend, slope), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def scored(docs, score, name, keep, text="text"):
    """The columns `keep` of every row and `score(column of texts)` as `name`."""
    position = keep.index(text) if text in keep else len(keep)
    rows = docs.select(*keep) if text in keep else docs.select(*keep, filled(text).alias(f"_{name}_text"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, position, SMALL):
                values = pa.array(score(piece.column(position)), pa.float64())
                kept = [piece.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, values], names=[*keep, name])

    fields = [docs.schema[c] for c in keep]
    return rows.mapInArrow(freed(run), T.StructType([*fields, T.StructField(name, T.DoubleType())]))
