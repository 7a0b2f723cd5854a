"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line is good or bad. Its features are ratios of characters and words of the line and of the lines
before and after it; neighbouring labels have a transition weight. Forward-backward gives each line's
marginal probability, their mean weighted by length is the document's share of good text, and a logistic
curve turns that share into the score.

Only documents are labelled. Training starts with the document's label for every line and then relabels the
lines of bad documents by the model's own marginals, keeping the worst line bad.

Defined results: a null text is the empty text, which is one empty line; without labels of both kinds every
score is the share itself; an empty table gives no rows; repeated rows get equal scores; only the text is
read for a score.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderflow.llm.bytewords import hashes, mixed, pieces, spans, utf8
from orderflow.llm.common import freed
from orderflow.llm.learning import fit_logistic, scored, sigmoid, training_rows

TRAIN_ROWS = 4_000  # about as many labelled texts, by a hash of the id
TRAIN_LINES = 300  # of a training text, evenly spread; scoring takes all lines
PASSES, STEPS, RATE, PENALTY = 2, 80, 0.15, 1e-4
GOOD = 1

_KINDS = ("upper", "lower", "digits", "beyond ASCII", "symbols", "bars", "marks", "stops", "spaces")
_FEATURES = len(_KINDS) + 8


def _table(characters):
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


_UPPER, _LOWER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("abcdefghijklmnopqrstuvwxyz")
_BEYOND = np.arange(256) >= 128
_TABLES = (_UPPER, _LOWER, _table("0123456789"), _BEYOND, _table("#*$%&<>@^~_=+\\{}[]"), _table("|"),
           _table("!?"), _table(".,;:"), _table(" \t"))
_WORD = ~_table(" \t\n\x0b\x0c\r")
_LINE = ~_table("\n")


def lines(column):
    """Own features of every line (rows of a table), their lengths, and each text's first line."""
    data, offsets = utf8(column)
    # a line ends at its feed or with its text; an empty text is one line
    feeds = np.flatnonzero(data == 10) + 1
    feeds = feeds[~np.isin(feeds, offsets[1:])] if len(feeds) else feeds
    opens = np.sort(np.concatenate((offsets[:-1], feeds)))
    # texts without bytes share their place with the next text
    first = np.searchsorted(opens, offsets[:-1]) + (np.arange(len(offsets) - 1) - np.searchsorted(offsets[:-1], offsets[:-1]))
    first = np.append(first, len(opens))
    sizes = np.diff(np.append(opens, len(data))).astype(np.float64)
    sums = [np.concatenate(([0], np.cumsum(t[data]))) for t in _TABLES]
    ends = np.append(opens[1:], len(data))
    counts = np.stack([(s[ends] - s[opens]).astype(np.float64) for s in sums], axis=1)
    starts, stops, word_at = spans(data, np.append(opens, len(data)), _WORD)
    keys = hashes(data, starts, stops)
    words = np.diff(word_at).astype(np.float64)
    owner = np.repeat(np.arange(len(opens)), np.diff(word_at))
    _, sample = np.unique(mixed(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    different = np.bincount(owner[sample], minlength=len(opens))
    # a line's hash with its text's number: earlier equal lines
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    placed = mixed(keys + (np.arange(len(keys)) - word_at[owner]).astype(np.uint64))
    placed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)))
    whole = placed[word_at[1:]] - placed[word_at[:-1]]
    same = np.zeros(len(keys), dtype=bool)
    same[1:] = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    stuck = np.bincount(owner[same], minlength=len(opens))
    _, seen = np.unique(mixed(whole) + text_of.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), return_index=True)
    again = np.ones(len(opens))
    again[seen] = 0
    some = np.maximum(sizes, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    ratios = counts / some[:, None]
    ratios[:, 0] = counts[:, 0] / letters
    per_word = np.maximum(words, 1)
    more = np.stack([
        (counts[:, 4] + counts[:, 5] + counts[:, 6]) / per_word,
        different / per_word,
        stuck / per_word,
        stuck > 2,
        again * (words > 0),
        np.minimum((sizes - counts[:, 8]) / per_word, 20) / 20,
        np.log1p(words) / 8,
        words == 0,
    ], axis=1)
    return np.hstack([ratios, np.minimum(more, 3)]), sizes, first


def chained(own, first):
    """Features with those of the neighbouring lines, and a constant."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    edge = np.zeros((len(own), 2))
    edge[first[:-1], 0] = 1
    edge[first[1:] - 1, 1] = 1
    return np.hstack([own, before, after, edge, np.ones((len(own), 1))])


def forward_backward(potential, change, first):
    """Marginals of good per line, per document the logarithm of the normaliser, and the expected counts of
    label pairs. `potential` is the score of good over bad per line, `change` the 2 x 2 transition weights.
    Chains are worked on side by side, longest first."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    begins, count = first[:-1][order], count[order]
    n, longest = len(order), int(count.max(initial=0))
    steps = np.exp(change - change.max())
    up = np.exp(np.clip(potential, -30, 30))
    emit = np.stack([1 / (1 + up), up / (1 + up)], axis=1)
    alpha, scale = np.zeros((len(potential), 2)), np.ones(len(potential))
    active = np.searchsorted(-count, -np.arange(1, longest + 1), side="right")
    for t in range(longest):
        at = begins[: active[t]] + t
        now = emit[at] if t == 0 else (alpha[at - 1] @ steps) * emit[at]
        scale[at] = np.maximum(now.sum(axis=1), 1e-300)
        alpha[at] = now / scale[at][:, None]
    beta, pairs = np.ones((len(potential), 2)), np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begins[: active[t + 1]] + t
        later = emit[at + 1] * beta[at + 1] / scale[at + 1][:, None]
        pairs += steps * (alpha[at].T @ later)
        beta[at] = later @ steps.T
    both = alpha * beta
    return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300), np.log(scale).sum() / max(n, 1), pairs


def fit(x, first, good):
    """Line weights and transition weights by gradient steps (Adam) on the likelihood of the line labels."""
    total = len(x)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    inside = np.ones(total, dtype=bool)
    inside[first[1:] - 1] = False
    at = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at], good[at + 1]), 1)
    for k in range(1, STEPS + 1):
        marginal, _, pairs = forward_backward(x @ theta[:-4], theta[-4:].reshape(2, 2), first)
        slope = np.concatenate((x.T @ (marginal - good), (pairs - seen).ravel())) / total + PENALTY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        theta -= RATE * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return theta


class LineModel:
    def __init__(self, theta, curve=None):
        self.theta, self.curve = theta, curve

    def share(self, own, sizes, first):
        """Share of good text of each document, weighted by the lines' lengths."""
        if not len(own):
            return np.zeros(0)
        x = chained(own, first)
        marginal, _, _ = forward_backward(x @ self.theta[:-4], self.theta[-4:].reshape(2, 2), first)
        weight = sizes + 1
        return np.add.reduceat(marginal * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, column):
        if not len(column):
            return np.zeros(0)
        share = self.share(*lines(column))
        return share if self.curve is None else sigmoid(_bent(share) @ self.curve[:-1] + self.curve[-1])


def _bent(share):
    inner = np.clip(share, 1e-3, 1 - 1e-3)
    return np.stack([share, np.log(inner / (1 - inner))], axis=1)


def _measured(batches):
    names = [f"x{k}" for k in range(_FEATURES)]
    for batch in batches:
        for piece in pieces(batch, 0):
            own, sizes, first = lines(piece.column(0))
            keep = np.concatenate([
                np.unique(np.linspace(a, b - 1, min(b - a, TRAIN_LINES)).astype(np.int64))
                for a, b in zip(first[:-1].tolist(), first[1:].tolist())
            ]) if piece.num_rows else np.zeros(0, np.int64)
            text = np.repeat(np.arange(piece.num_rows), np.diff(first))[keep]
            line = keep - first[text]
            label = np.array(piece.column(1).to_pylist())[text]
            slot = np.array(piece.column(2).to_pylist())[text]
            fields = [slot, line, label, sizes[keep], *own[keep].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(f)) for f in fields],
                                             names=["slot", "line", "label", "size", *names])


def train(docs, labels, split=4, held_out=2, most=TRAIN_ROWS, id="doc_id", text="text", label="quality"):
    """A model fitted on the driver from the line features of about `most` labelled texts."""
    rows = training_rows(docs, labels, label, split, held_out, most, id, text)
    kinds = "slot long, line long, label long, size double" + "".join(f", x{k} double" for k in range(_FEATURES))
    sample = rows.select("text", F.col("label").cast("long"), F.col("slot").cast("long")).mapInArrow(freed(_measured), kinds)
    found = sample.toPandas()
    if not len(found) or found["label"].nunique() < 2:
        return LineModel(np.zeros(3 * _FEATURES + 3 + 4))
    # texts of one slot follow each other; a line number that does not grow begins the next text
    found = found.sort_values(["slot"], kind="stable")
    slot, line = found["slot"].to_numpy(), found["line"].to_numpy()
    new = np.ones(len(found), dtype=bool)
    new[1:] = (slot[1:] != slot[:-1]) | (line[1:] <= line[:-1])
    first = np.append(np.flatnonzero(new), len(found))
    own, sizes = found[[f"x{k}" for k in range(_FEATURES)]].to_numpy(), found["size"].to_numpy()
    fine = found["label"].to_numpy() == GOOD
    x, good = chained(own, first), fine.astype(np.int64)
    for turn in range(PASSES):
        theta = fit(x, first, good)
        marginal, _, _ = forward_backward(x @ theta[:-4], theta[-4:].reshape(2, 2), first)
        worst = np.zeros(len(x), dtype=bool)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            worst[a + int(marginal[a:b].argmin())] = True
        good = np.where(fine, 1, (marginal > 0.5) & ~worst).astype(np.int64)
    model = LineModel(theta)
    share = model.share(own, sizes, first)
    model.curve = fit_logistic(_bent(share), fine[first[:-1]].astype(float), penalty=0.1)
    return model


def quality(docs, labels, split=4, held_out=2, id="doc_id", text="text", keep=None, name="score", **options):
    """The columns `keep` (the id by default) of every row, and its score."""
    model = train(docs, labels, split, held_out, id=id, text=text, **options)
    return scored(docs, model.score, name, keep or [id], text)
