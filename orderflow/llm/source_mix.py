"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources. Documents with the same membership form a pattern; what a pattern
holds in words flows to the quotas of its sources. The first copy of a word costs nothing and each further
copy one more than the last, so repeats come only where quotas ask for them. A pattern's flow is then filled
with documents in a seeded order: whole copies of all, and for the rest the documents that come first. Past
a document that is too long the order goes on with those that are no longer than what is missing, until none
fits; then with second copies, where the mix allows them; last, one that ends nearer to the flow is added.

Only sums per pattern reach the driver. Sources that no document shares with another are filled directly; of
the others at most MOST_PATTERNS memberships enter the flow (more is an error). Documents are placed in the
seeded order over hash bins, so a source with most of the rows is spread over many tasks.

Defined results: a null text has no words and a null source is a source, the last; without documents there
are no rows; a document of no source is never taken; repeated rows each count; ties in the order are between
equal rows only. The same table and seed give the same mix.
"""

import heapq
import json

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.llm.common import blank_words, filled, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 17
BIN_BITS = 12
MOST_PATTERNS = 10_000


def quotas(sizes, share=SHARE, most=MOST_COPIES, weights=WEIGHTS):
    """Words asked of each source, sources in order of their names and null last: `share` of all words by
    weight, at most `most` times the source; what is over is shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, found = share * sum(sizes.values()), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            found |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            found[s] = float(most * sizes[s])
        left -= sum(found[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return found


def routed(capacity, wanted, most=MOST_COPIES):
    """Words from each pattern to each source: {(pattern, source): words}. `capacity` maps patterns (tuples of
    sources) to words, `wanted` sources to words. Successive shortest paths with potentials."""
    patterns, sources = list(capacity), list(wanted)
    start, end = 0, 1
    node = {("p", p): 2 + k for k, p in enumerate(patterns)}
    node |= {("s", s): 2 + len(patterns) + k for k, s in enumerate(sources)}
    graph = [[] for _ in range(2 + len(patterns) + len(sources))]

    def edge(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p in patterns:
        for copy in range(most):
            edge(start, node["p", p], capacity[p], copy)
        for s in p:
            if s in wanted:
                edge(node["p", p], node["s", s], most * capacity[p], 0)
    for s in sources:
        edge(node["s", s], end, wanted[s], 0)
    price = [0] * len(graph)
    while True:
        far, came, queue = {start: 0}, {}, [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k, (b, room, cost, _) in enumerate(graph[a]):
                to = d + cost + price[a] - price[b]
                if room > 0 and to < far.get(b, float("inf")):
                    far[b], came[b] = to, (a, k)
                    heapq.heappush(queue, (to, b))
        if end not in far:
            break
        longest = max(far.values())
        price = [x + far.get(k, longest) for k, x in enumerate(price)]
        path, at = [], end
        while at != start:
            at, k = came[at]
            path.append((at, k))
        room = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= room
            graph[graph[a][k][0]][graph[a][k][3]][1] += room
    out = {}
    for p in patterns:
        for b, _, _, back in graph[node["p", p]]:
            if b >= 2 + len(patterns):
                flow = graph[b][back][1]
                if flow > 0:
                    out[p, sources[b - 2 - len(patterns)]] = flow
    return out


def directed(capacity, wanted, most=MOST_COPIES):
    """As `routed`; sources that share no document with another take what they need without a search."""
    joint = {s for p in capacity if len(p) > 1 for s in p}
    apart = {p for p in capacity if len(p) == 1 and p[0] not in joint}
    flow = {(p, p[0]): n for p in apart if (n := min(wanted[p[0]], most * capacity[p])) > 0}
    rest = {p: n for p, n in capacity.items() if p and p not in apart}
    if len(rest) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} overlapping memberships")
    return flow | routed(rest, {s: n for s, n in wanted.items() if s in joint}, most)


def _marked(docs, sources, id, text, keep, seed):
    """Rows with their pattern, size and place in the seeded order; `keep` as the struct `_row`."""
    size = F.size(blank_words(filled(text))).cast("bigint")
    # maps cannot be hashed
    others = [c for c, kind in docs.dtypes if c not in (id, text) and "map<" not in kind]
    order = F.xxhash64(F.lit(seed), F.col(id), F.xxhash64(text), *[F.col(c) for c in others])
    members = F.array_sort(F.array_distinct(sources))
    row = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    rows = docs.select(F.to_json(members).alias("_pattern"), size.alias("_size"), order.alias("_order"), row.alias("_row"))
    return rows.withColumn("_bin", F.shiftrightunsigned("_order", 64 - BIN_BITS))


def _placed(rows, bins):
    """Rows with the words of the rows before them in their pattern."""
    inside = W.partitionBy("_pattern", "_bin").orderBy("_order").rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = rows.join(bins, ["_pattern", "_bin"])
    return joined.withColumn("_at", F.col("_start") + F.sum("_size").over(inside) - F.col("_size"))


class Mix:
    """A planned mix of a table. `sources` is a column with an array of source names."""

    def __init__(self, docs, sources, id="doc_id", text="text", share=SHARE, most=MOST_COPIES, weights=WEIGHTS, seed=SEED):
        self.args, self.spark = (docs, sources, id, text), docs.sparkSession
        self.seed, self.most = seed, most
        rows = _marked(docs, sources, id, text, [], seed).drop("_row")
        # one row per pattern and bin
        bins = written(rows.groupBy("_pattern", "_bin").agg(F.sum("_size").alias("_words")), "bins")
        sums = bins.groupBy("_pattern").agg(F.sum("_words").alias("words"))
        several = F.size(F.from_json("_pattern", "array<string>")) > 1
        shared = sums.where(several).limit(MOST_PATTERNS + 1).collect()
        if len(shared) > MOST_PATTERNS:
            raise ValueError(f"more than {MOST_PATTERNS} overlapping memberships")
        shared += sums.where(~F.coalesce(several, F.lit(False))).collect()  # a row per source
        self.words = {r["_pattern"]: r["words"] for r in shared}
        members = {p: tuple(json.loads(p)) if p is not None else () for p in self.words}
        self.sizes = {}
        for p, names in members.items():
            for s in names:
                self.sizes[s] = self.sizes.get(s, 0) + self.words[p]
        self.targets = quotas(self.sizes, share, most, weights)
        # patterns that differ only in how they were written share a tuple
        flow = directed({members[p]: n for p, n in self.words.items()}, {s: round(t) for s, t in self.targets.items()}, most)
        self.members, self.flow = members, flow
        self.total = {p: sum(flow.get((members[p], s), 0) for s in members[p]) for p in members}
        earlier = W.partitionBy("_pattern").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
        self.bins = bins.select("_pattern", "_bin", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
        self.full = {p: (self.total[p] // n if n else 0) for p, n in self.words.items()}
        self.rest = {p: self.total[p] - self.full[p] * n for p, n in self.words.items()}
        self.rounds = {p: [] for p in self.words}
        if any(self.rest.values()):
            self._top_up(written(_placed(rows, self.bins).select("_pattern", "_bin", "_size", "_at"), "placed"))

    def _small(self, rows, kinds):
        """A table with a row per pattern."""
        rows = self.spark.createDataFrame(rows, kinds)
        return F.broadcast(rows) if len(self.words) <= MOST_PATTERNS else rows

    def _plan(self):
        rows = [(p, self.full[p], self.rest[p], self.rounds[p]) for p in self.words]
        kinds = "_pattern string, _full long, _rest long, _rounds array<struct<start:long,stop:long,size:long,copies:int>>"
        return self._small(rows, kinds)

    def _copies(self):
        """Of a placed row: whole copies of the pattern, one more for the first rows, and those of the rounds."""
        first = (F.col("_rest") > 0) & (F.col("_at") + F.col("_size") <= F.col("_rest"))
        taken = F.least(F.col("_full") + F.when(first, 1).otherwise(0), F.lit(self.most)).cast("int")

        def again(copies, x):
            fits = F.col("_at").between(x["start"], x["stop"]) & F.col("_size").between(1, x["size"])
            return copies + F.when(fits & (copies == x["copies"]), 1).otherwise(0)

        return F.aggregate("_rounds", taken, again)

    def _top_up(self, placed):
        """Goes on filling the rest of each pattern. A round takes, of the documents taken least often that are
        no longer than what is missing, those that come first; what is missing then is less than the length of
        the next one, so that rounds soon end. When none fits, one more document may end nearer to the flow."""
        words = F.sum(F.col("_size") * F.col("_copies"))
        known = placed.join(self._plan(), "_pattern").withColumn("_copies", self._copies())
        done = {r["_pattern"]: r["n"] for r in known.groupBy("_pattern").agg(words.alias("n")).collect()}
        gaps = {p: self.total[p] - done.get(p, 0) for p in self.words}
        open_ = {p for p, g in gaps.items() if g > 0}
        while open_:
            gap = self._small([(p, gaps[p]) for p in open_], "_pattern string, _gap long")
            known = placed.where("_size > 0").join(gap, "_pattern").where("_size < 2 * _gap").join(self._plan(), "_pattern")
            free = known.withColumn("_copies", self._copies()).where(F.col("_copies") < self.most)
            level = F.min(F.when(F.col("_size") <= F.col("_gap"), F.col("_copies"))).alias("level")
            near = F.min(F.struct(F.abs(F.col("_size") - F.col("_gap")).alias("off"), "_copies", "_at", "_size")).alias("near")
            ways = free.groupBy("_pattern").agg(level, near).collect()
            for r in ways:
                if r["level"] is None:
                    self.rounds[r["_pattern"]].append((r["near"]["_at"], r["near"]["_at"], r["near"]["_size"], r["near"]["_copies"]))
            levels = {r["_pattern"]: r["level"] for r in ways if r["level"] is not None}
            open_ = set(levels)
            if not open_:
                break
            level = self._small(list(levels.items()), "_pattern string, _level int")
            free = free.join(level, "_pattern").where("_copies = _level AND _size <= _gap").select("_pattern", "_bin", "_size", "_at", "_gap")
            earlier = W.partitionBy("_pattern").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
            bins = free.groupBy("_pattern", "_bin").agg(F.sum("_size").alias("_words"))
            bins = bins.select("_pattern", "_bin", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
            inside = W.partitionBy("_pattern", "_bin").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
            ends = free.join(bins, ["_pattern", "_bin"]).withColumn("_end", F.col("_before") + F.sum("_size").over(inside))
            ends = ends.where("_end <= _gap").groupBy("_pattern").agg(F.max("_at").alias("stop"), F.max("_end").alias("n"))
            for r in ends.collect():
                p = r["_pattern"]
                self.rounds[p].append((0, r["stop"], gaps[p], levels[p]))
                gaps[p] -= r["n"]
            open_ = {p for p in open_ if gaps[p] > 0}

    def documents(self, keep):
        """The columns `keep` of every row with `_size` and `_copies`."""
        docs, sources, id, text = self.args
        rows = _placed(_marked(docs, sources, id, text, keep, self.seed), self.bins)
        return rows.join(self._plan(), "_pattern").select("_row", "_pattern", "_size", self._copies().alias("_copies"))


def mixture(docs, source="source", id="doc_id", text="text", **options):
    """Per row of a table with one source each: its size, its source's size and target, and words taken."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"))
    mix = Mix(rows, F.array("source"), **options)
    sums = [(s, n, mix.targets[s]) for s, n in mix.sizes.items()]
    sums = mix._small(sums, "s string, source_size long, target double")
    found = mix.documents(["doc_id", "source"]).select("_row.*", "_size", "_copies")
    return found.join(sums, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken")
    )


def mixed_documents(docs, sources=None, id="doc_id", text="text", **options):
    """The rows of the mix, with all columns, each as often as it is taken."""
    sources = F.array(F.col("source").cast("string")) if sources is None else sources
    found = Mix(docs, sources, id, text, **options).documents(docs.columns)
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return found.where("_copies > 0").select("_row", copies).select("_row.*")
