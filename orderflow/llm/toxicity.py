"""Toxicity: a weighted finite-state grammar of clauses.

A lexicon transducer turns words into symbols: insult (weighted), threat, target, negation, reported speech
or other. Small machines follow the symbols of a clause: negation reaches over a few words, reported speech
to the end of its clause, a target counts for the whole clause, a threat needs a target soon after it. Their
composition is one machine whose outputs say in which context each insult or threat stands. The weights of
the contexts come from a logistic fit, so a matched clause counts, not the word alone.

The insults' weights are learned: of whole words and of word beginnings (prefixes), by how much more often
labelled texts that are toxic hold them than others. All are taken up to the count of chance at which so
many words would pass without any tie to the label that they were FALSE_SHARE of those that do pass: one rule
for samples of any size. A few insults are known without labels.

Defined results: a null text is the empty text; without usable labels the starting weights are taken; an
empty table gives no rows; repeated rows get equal scores; only the text is read for a score.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderflow.llm.bytewords import hashes, pieces, spans, utf8
from orderflow.llm.common import written
from orderflow.llm.learning import fit_logistic, scored, sigmoid, training_rows

# Words of each class.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers pathetic disgusting worthless imbecile dumbass".split()
THREATS = "kill hurt destroy beat burn shoot attack töten schlagen tuer frapper matar golpear".split()
TARGETS = "you your he she they this that these those all du ihr sie vous tu ils tú usted ellos".split()
NEGATIONS = "not never no nobody isn't aren't nicht kein keine pas jamais ningún nunca jamás".split()
REPORTED = "said says wrote claimed quoted called reported sagte schrieb dit écrit dijo escribió".split()

PREFIXES = (4, 5, 6, 8)
TRAIN_ROWS = 20_000  # about as many labelled texts, by a hash of the id
LEAST_WEIGHT = 2.5
FALSE_SHARE = 0.05  # of the learned entries, expected to be there by chance
START_WEIGHT = 3.0
REACH = 3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CONTEXTS = ("plain", "targeted", "negated", "reported", "threat")
START_MODEL = np.array([1.0, 0.3, -0.3, -0.3, 0.5, 0.3, -2.5])  # contexts, share of the text, constant

_CLAUSE_ENDS = np.zeros(256, dtype=bool)
_CLAUSE_ENDS[[ord(c) for c in ".,;:!?\n"]] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[[39, *range(48, 58), *range(97, 123), *range(128, 256)]] = True


def machine(states, step):
    """A table state x symbol -> state."""
    return [[step(state, symbol) for symbol in range(6)] for state in range(states)]


# Negation and threat count down the words they still reach; reported speech and targets stay.
MACHINES = (
    machine(REACH + 1, lambda s, x: REACH if x == NEGATION else max(0, s - 1)),
    machine(2, lambda s, x: int(s or x == REPORT)),
    machine(2, lambda s, x: int(s or x == TARGET)),
    machine(REACH + 1, lambda s, x: REACH if x == THREAT else max(0, s - 1)),
)


def compose(machines):
    """The product: numbered states, a table state x symbol -> state, and each state's parts."""
    start = (0,) * len(machines)
    number, table, waiting = {start: 0}, [], [start]
    while waiting:
        state = waiting.pop(0)
        row = []
        for symbol in range(6):
            after = tuple(m[s][symbol] for m, s in zip(machines, state))
            if after not in number:
                number[after] = len(number)
                waiting.append(after)
            row.append(number[after])
        table.append(row)
    return table, list(number)


GRAMMAR, STATES = compose(MACHINES)


def matched(symbols, weights):
    """Weights by context of one clause."""
    state, out, plain = 0, [0.0] * len(CONTEXTS), 0.0
    for symbol, weight in zip(symbols, weights):
        negated, reported, _, threat = STATES[state]
        if symbol == INSULT:
            if reported:
                out[3] += weight
            elif negated:
                out[2] += weight
            else:
                plain += weight
        elif symbol == TARGET and threat:
            out[4] += 1.0
        state = GRAMMAR[state][symbol]
    out[1 if STATES[state][2] else 0] += plain
    return out


def _lowered(column):
    data, offsets = utf8(column)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data = lower[data]
    # the Latin capitals with accents are two bytes, the second of which differs
    accent = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[accent] += 32
    return data, offsets


def _words(column):
    """Bytes, spans, first word of each row, and per word its own hash and those of its beginnings."""
    data, offsets = _lowered(column)
    starts, ends, first = spans(data, offsets, _WORD)
    letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = np.searchsorted(letters, starts)
    keys = [hashes(data, starts, ends)]
    for n in PREFIXES:
        stop = letters[np.minimum(at + n, len(letters) - 1)]
        longer = stop < ends  # a word as long as the beginning is the word itself
        keys.append(np.where(longer, hashes(data, starts, np.minimum(stop, ends)), keys[0]))
    return data, starts, ends, first, np.stack(keys, axis=1)


def _key_of(words):
    column = pa.array(words)
    data, offsets = _lowered(column)
    return hashes(data, offsets[:-1], offsets[1:])


def _counts(batches):
    """Texts of each label that hold a word or beginning: part sums."""
    for batch in batches:
        for piece in pieces(batch, 0, 2_000_000):
            *_, first, keys = _words(piece.column(0))
            toxic = np.array(piece.column(1).to_pylist(), dtype=bool)
            rows = [np.unique(keys[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            if not sum(map(len, rows)):
                continue
            values, which = np.unique(np.concatenate(rows), return_inverse=True)
            owner = np.repeat(toxic, [len(r) for r in rows])
            bad = np.bincount(which, weights=owner, minlength=len(values)).astype(np.int64)
            all_ = np.bincount(which, minlength=len(values))
            yield pa.RecordBatch.from_pydict({"key": values.view(np.int64), "bad": bad, "good": all_ - bad})


def passing(cells, bad, good, rate=FALSE_SHARE):
    """Counts (toxic, other) that make an entry, with its weight. `cells` has (toxic, other, keys with these
    counts); of all texts `bad` are toxic and `good` are not. Among keys held by n texts each, the toxic ones
    are binomial by chance; what passes is the longest list with at most `rate` of it expected by chance."""
    toxic, other, keys = np.array(cells, dtype=np.int64).T
    held, share = toxic + other, bad / (bad + good)
    weight = np.log((toxic + 0.5) / (bad + 1)) - np.log((other + 0.5) / (good + 1))
    ways = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, held.max() + 1)))))
    chances, tails = np.ones(len(held)), []
    for n in np.unique(held).tolist():
        k, mine = np.arange(n + 1), held == n
        exact = np.exp(ways[n] - ways[k] - ways[n - k] + k * np.log(share) + (n - k) * np.log1p(-share))
        tail = np.cumsum(exact[::-1])[::-1]  # of k or more toxic texts
        chances[mine] = tail[toxic[mine]]
        heavy = np.log((k + 0.5) / (bad + 1)) - np.log((n - k + 0.5) / (good + 1)) > LEAST_WEIGHT
        tails.append((keys[mine].sum(), np.concatenate(([0.0], tail[heavy][::-1]))))
    heavy = weight > LEAST_WEIGHT
    limits = np.unique(chances[heavy])
    by_chance = np.zeros(len(limits))
    for n_keys, tail in tails:
        by_chance += n_keys * tail[np.searchsorted(tail, limits, "right") - 1]
    order = np.sort(np.repeat(chances[heavy], keys[heavy]))
    fit = np.flatnonzero(by_chance <= rate * np.searchsorted(order, limits, "right"))
    if not len(fit):
        return {}
    taken = heavy & (chances <= limits[fit[-1]])
    return dict(zip(zip(toxic[taken].tolist(), other[taken].tolist()), weight[taken].tolist()))


def learned_lexicon(rows):
    """Hash -> weight of insults; `rows` have text and label, and their words bound the lexicon."""
    known = dict.fromkeys(_key_of(INSULTS).view(np.int64).tolist(), START_WEIGHT)
    totals = rows.groupBy("label").count().collect()
    bad = sum(r["count"] for r in totals if r["label"] == 1)
    good = sum(r["count"] for r in totals if r["label"] == 0)
    if not bad or not good:
        return known
    counts = rows.select("text", "label").mapInArrow(_counts, "key long, bad long, good long")
    counts = written(counts.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "words")
    cells = counts.groupBy("bad", "good").count().collect()
    taken = passing([tuple(r) for r in cells], bad, good) if cells else {}
    if taken:
        table = rows.sparkSession.createDataFrame([(*c, w) for c, w in taken.items()], "bad long, good long, weight double")
        known |= {r["key"]: r["weight"] for r in counts.join(F.broadcast(table), ["bad", "good"]).collect()}
    return known


class Grammar:
    """Features and scores of texts under a lexicon."""

    def __init__(self, lexicon, model=START_MODEL):
        keys = np.array(list(lexicon), dtype=np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], np.array(list(lexicon.values()))[order]
        self.model = model
        self.classes = [(_key_of(words), symbol) for words, symbol in
                        ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTED, REPORT))]

    def features(self, column):
        """Per text: weight of insults by context (log scale) and per 100 words."""
        data, starts, ends, first, keys = _words(column)
        out = np.zeros((len(column), len(CONTEXTS) + 1))
        if not len(starts):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        weights = np.where(self.keys[at] == keys, self.weights[at], 0).max(axis=1)
        symbols = np.zeros(len(starts), dtype=np.int64)
        for group, symbol in self.classes:
            symbols[np.isin(keys[:, 0], group)] = symbol
        symbols[weights > 0] = INSULT
        row = np.repeat(np.arange(len(column)), np.diff(first))
        stops = np.concatenate(([0], np.cumsum(_CLAUSE_ENDS[data])))
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (stops[starts[1:]] > stops[ends[:-1]]) | (row[1:] != row[:-1])
        clause = np.flatnonzero(new)
        ends_at = np.append(clause[1:], len(starts))
        which = np.unique(np.cumsum(new)[(symbols == INSULT) | (symbols == THREAT)]) - 1
        for k in which.tolist():
            a, b = int(clause[k]), int(ends_at[k])
            out[row[a], :-1] += matched(symbols[a:b].tolist(), weights[a:b].tolist())
        length = np.maximum(np.diff(first), 1)
        out[:, -1] = np.log1p(100 * out[:, :4].sum(axis=1) / length)
        out[:, :-1] = np.log1p(out[:, :-1])
        return out

    def score(self, column):
        return sigmoid(self.features(column) @ self.model[:-1] + self.model[-1])


def train(docs, labels, split=5, held_out=0, most=TRAIN_ROWS, id="doc_id", text="text", label="toxic"):
    """A grammar fitted on about `most` labelled texts: the lexicon on one half, the contexts on the other."""
    rows = training_rows(docs, labels, label, split, held_out, most, id, text)
    grammar = Grammar(learned_lexicon(rows.where(F.col("slot") % 2 == 0)))
    names = [f"x{k}" for k in range(len(CONTEXTS) + 1)]

    def measure(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                found = grammar.features(piece.column(0))
                yield pa.RecordBatch.from_arrays([piece.column(1), *found.T.copy()], names=["label", *names])

    kinds = "label int, " + ", ".join(f"{n} double" for n in names)
    other = rows.where(F.col("slot") % 2 == 1).select("text", "label").mapInArrow(measure, kinds)
    table = np.array([list(r) for r in other.collect()], dtype=float)  # at most `most` rows of numbers
    if len(table) and 0 < table[:, 0].sum() < len(table):
        grammar.model = fit_logistic(table[:, 1:], table[:, 0], penalty=0.3)
    return grammar


def toxicity(docs, labels, split=5, held_out=0, id="doc_id", text="text", keep=None, name="score", **options):
    """The columns `keep` (the id by default) of every row, and its score."""
    grammar = train(docs, labels, split, held_out, id=id, text=text, **options)
    return scored(docs, grammar.score, name, keep or [id], text)
