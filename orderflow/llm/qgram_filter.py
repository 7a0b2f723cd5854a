"""Benchmark decontamination by the q-gram lemma.

Text and benchmark items are compared in lower case with white space runs as one space. An item of m
characters may be changed by k = BUDGET * m edits. A stretch of text within k edits of it shares at least
m + 1 - q - k * q of its q-grams with it, on neighbouring diagonals (place in the text less place in the
item). Shared q-grams are counted in overlapping bands of diagonals, bands that reach that number are
regions, and a banded alignment gives each region's edits. Items shorter than q are looked for as they are.

The benchmark goes to the tasks in blocks of at most BLOCK_CHARS characters; each block is a pass over the
documents, which are never shuffled.

Defined results: null and empty texts hold no item, null and empty items are in no text; repeated rows, of
either table, give a row each; empty tables give no rows; a very long text is worked on whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.bytewords import mixed, pieces
from orderflow.llm.common import filled, freed
from orderflow.llm.learning import scored

Q = 10
BUDGET = 0.08
BLOCK_CHARS = 16_000_000
MOST_PAIRS = 4_000_000  # q-gram pairs held at once; more are counted in turns
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22


def plain(text):
    return " ".join((text or "").lower().split())


def codes(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def grams(symbols, q):
    """A hash of every q-gram: from those of half the length, so in few passes."""
    if len(symbols) < q:
        return np.zeros(0, np.uint64)
    size, now, done, have = 1, mixed(symbols.astype(np.uint64) + np.uint64(1)), None, 0
    while True:
        if q & size:
            factor = np.uint64(pow(int(_BASE), size, 1 << 64))
            done = now if done is None else done[: len(now) - have] * factor + now[have:]
            have += size
        if have == q:
            return mixed(done[: len(symbols) - q + 1])
        factor = np.uint64(pow(int(_BASE), size, 1 << 64))
        now = now[:-size] * factor + now[size:]
        size *= 2


def aligned(pattern, window, limit):
    """Least edits that turn the pattern into some stretch of the window, and the stretch's ends; None if more
    than `limit`. Rows run over the pattern; each holds the band of places that `limit` edits can reach."""
    m, n = len(pattern), len(window)
    width = n - m + 2 * limit + 1  # diagonals from -limit to n - m + limit
    if width <= 0:
        return None
    places = np.arange(width) - limit  # place in the window before row 0
    far = m + n + 1
    cost = np.where((places >= 0) & (places <= n), 0, far)
    begin = np.clip(places, 0, n)
    steps = np.arange(width)
    padded = np.concatenate((window, [0]))
    for j in range(m):
        at = places + j
        inside = (at >= 0) & (at < n)
        change = cost + (padded[np.where(inside, at, n)] != pattern[j])
        change = np.where(inside, change, far)
        drop = np.append(cost[1:], far) + 1
        best = np.minimum(change, drop)
        start = np.where(change <= drop, begin, np.append(begin[1:], 0))
        # added characters: the least cost to the left, one edit for each step
        lifted = (best - steps) * width + (width - 1 - steps)
        run = np.minimum.accumulate(lifted)
        source = width - 1 - run % width
        cost = np.minimum(best[source] + steps - source, far)
        cost = np.where((places + j + 1 >= 0) & (places + j + 1 <= n), cost, far)
        begin = start[source]
        if cost.min() > limit:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), int(places[end] + m)


class Items:
    """The q-gram index of a block of benchmark items (id, text)."""

    def __init__(self, items, q=Q, budget=BUDGET):
        items = [(i, plain(t)) for i, t in items]
        self.q = q
        self.short = [(i, t) for i, t in items if 0 < len(t) < q]
        items = [(i, t) for i, t in items if len(t) >= q]
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        # at least one q-gram must be left by the edits
        self.edits = np.minimum((budget * self.sizes).astype(np.int64), (self.sizes - q) // q)
        self.least = self.sizes + 1 - q - self.edits * q
        self.step = 1 << np.ceil(np.log2(self.edits + 1)).astype(np.int64)
        parts = [grams(codes(t), q) for t in self.texts]
        keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else keys.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.first = np.append(self.first, len(keys))
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True

    def regions(self, symbols, bounds):
        """Bands with enough shared q-grams: number of the text, item, band, all as arrays."""
        found = grams(symbols, self.q)
        at = np.flatnonzero(self.table[found >> np.uint64(64 - _TABLE_BITS)])
        if not len(self.keys) or not len(at):
            return np.zeros((0, 3), dtype=np.int64)
        where = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
        fits = self.keys[where] == found[at]
        at, where = at[fits], where[fits]
        sizes = np.diff(self.first)[where]
        total, codes_, counts = np.cumsum(sizes), [], []
        turns = np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, MOST_PAIRS), side="left").tolist() + [len(at)]
        bands = int(len(symbols) * 2 + self.sizes.max() + 4)
        for a, b in zip(turns[:-1], turns[1:]):
            n = sizes[a:b]
            if not n.sum():
                continue
            listed = np.repeat(self.first[where[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item, spot = self.owner[listed], np.repeat(at[a:b], n)
            # diagonals are counted over the whole piece: one of a text never meets one of another, see below
            diagonal = spot - self.place[listed] + int(self.sizes.max())
            text = np.searchsorted(bounds, spot, side="right") - 1
            band = diagonal // self.step[item] + 1
            key = (text * len(self.ids) + item) * bands
            for each in (key + band, key + band - 1):
                code, count = np.unique(each, return_counts=True)
                codes_.append(code)
                counts.append(count)
        if not codes_:
            return np.zeros((0, 3), dtype=np.int64)
        code, which = np.unique(np.concatenate(codes_), return_inverse=True)
        count = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)
        item = code // bands % len(self.ids)
        enough = count >= self.least[item]
        return np.stack([code[enough] // bands // len(self.ids), item[enough], code[enough] % bands - 1], axis=1)

    def search(self, texts):
        """(number of the text, item id, start, end, edits, length of the item): for each text and item the
        region with the fewest edits, the first of equals. Places are those of the plain text."""
        texts = [plain(t) for t in texts]
        joined = "\0".join(texts)
        symbols = codes(joined)
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        best = {}
        for text, item, band in self.regions(symbols, bounds).tolist():
            m, k, step = int(self.sizes[item]), int(self.edits[item]), int(self.step[item])
            # places where the item's start may lie: two steps of diagonals, back in the text's own count
            low = band * step - int(self.sizes.max()) - int(bounds[text])
            begin, end = max(0, low - k), min(len(texts[text]), low + 2 * step + m + k)
            if begin >= end:
                continue
            exact = texts[text].find(self.texts[item], begin, end)
            if exact >= 0:
                hit = (0, exact, exact + m)
            else:
                hit = aligned(codes(self.texts[item]), codes(texts[text][begin:end]), k)
                if hit is None:
                    continue
                hit = (hit[0], begin + hit[1], begin + hit[2])
            best[text, item] = min(best.get((text, item), hit), hit)
        out = [(t, self.ids[i], s, e, n, int(self.sizes[i])) for (t, i), (n, s, e) in sorted(best.items())]
        for n, text in enumerate(texts):
            for item, short in self.short:
                at = text.find(short)
                if at >= 0:
                    out.append((n, item, at, at + len(short), 0, len(short)))
        return out


def blocks(benchmark, id="item_id", text="text", most=BLOCK_CHARS):
    """The benchmark in lists of (id, text) of about `most` characters; one is on the driver at a time."""
    rows = benchmark.select(F.col(id).cast("bigint").alias("item_id"), filled(text).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(size // most) + 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


_KINDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.LongType()),
    T.StructField("similarity", T.DoubleType()),
])


def leaks(docs, benchmark, id="doc_id", text="text", q=Q, budget=BUDGET, most=BLOCK_CHARS):
    """A row for each document row and item that it holds: where, and with how many edits."""
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), filled(text).alias("text"))
    found = None
    for block in blocks(benchmark, most=most):
        items = docs.sparkSession.sparkContext.broadcast(Items(block, q, budget))  # of at most `most` characters

        def run(batches, items=items):
            for batch in batches:
                for piece in pieces(batch, 1, 1_000_000):
                    hits = items.value.search(piece.column(1).to_pylist())
                    ids = piece.column(0).to_pylist()
                    rows = [(ids[t], item, s, e, n, 1 - n / m) for t, item, s, e, n, m in hits]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 5 + [pa.float64()])],
                            names=_KINDS.names,
                        )

        part = rows.mapInArrow(freed(run), _KINDS)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs, benchmark, text="text", q=Q, budget=BUDGET, most=BLOCK_CHARS):
    """The rows that hold no item of the benchmark, all columns as they were."""
    kept, name = docs, "_leaks"
    while name in docs.columns:
        name += "_"
    for block in blocks(benchmark, most=most):
        items = docs.sparkSession.sparkContext.broadcast(Items(block, q, budget))

        def count(column, items=items):
            out = np.zeros(len(column))
            for hit in items.value.search(column.to_pylist()):
                out[hit[0]] += 1
            return out

        kept = scored(kept, count, name, docs.columns, text).where(F.col(name) == 0).drop(name)
    return kept
